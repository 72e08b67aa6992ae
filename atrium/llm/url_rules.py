"""URL filtering by listed rules and by mined association rules.

FP-growth mines combinations of URL tokens that go with a label. Rules are
pruned by support, confidence and lift, and matched by an inverted index from
tokens to the rules that need them: a rule matches a URL that has all of its
tokens. Labels may be given; without any, the listed rules' verdicts on the
pages that they fit are the labels, and mining carries them over to URLs that
no listed rule fits. Everything here is DataFrame operations.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atrium.scratch import write_table

BLOCK, ALLOW = "block", "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The listed rules.
RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"), Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/"))


@dataclass(frozen=True)
class Mining:
    """Support is a share of the labelled URLs. A rule's confidence must exceed the bar by what chance may add: the lower end of
    Wilson's interval at z deviations is compared with it, so that few URLs must agree more than many, at every size."""

    support: float = 0.005
    confidence: float = 0.5
    lift: float = 1.2
    z: float = 1.645

    @property
    def least(self) -> float:
        """So many blocked URLs, and no other, has the rarest combination that can be sure enough."""
        return self.z**2 * self.confidence / (1 - self.confidence)

    def lower(self, confidence: Column, have: Column) -> Column:
        half = self.z**2 / (2 * have)
        return (confidence + half - self.z * F.sqrt(confidence * (1 - confidence) / have + half / (2 * have))) / (1 + 2 * half)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty if it is null or has no `://`."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def listed(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest listed rule that fits, or nulls; of equally long ones, the first in order."""
    name = verdict = None
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        name = F.when(fits, r.name) if name is None else name.when(fits, r.name)
        verdict = F.when(fits, r.verdict) if verdict is None else verdict.when(fits, r.verdict)
    return (F.lit(None).cast("string"), F.lit(None).cast("string")) if name is None else (name, verdict)


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL: scheme, labels of the host, folders (numbers as one), extension, query's keys."""
    scheme = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)
    folders = F.transform(F.split(path, "/"), lambda x: F.regexp_replace(x, r"[0-9]+", "#"))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    keys = F.transform(F.split(query, "&"), lambda x: F.substring_index(x, "=", 1))
    marked = F.concat(
        F.array(F.concat(F.lit("scheme:"), scheme)),
        F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("host:"), x)),
        F.transform(folders, lambda x: F.concat(F.lit("path:"), x)),
        F.transform(keys, lambda x: F.concat(F.lit("query:"), x)),
        F.array(F.concat(F.lit("fragment:"), F.when(F.instr(url, "#") > 0, F.lit("#")).otherwise(F.lit("")))),
    )
    return F.coalesce(F.array_distinct(F.filter(marked, lambda x: ~x.rlike(":$"))), F.array().cast("array<string>"))


def without_redundant(rules: DataFrame) -> DataFrame:
    """The rules none of whose proper subsets of tokens is a rule of at least their confidence.

    What a dropped rule matches, a kept one matches with no less confidence. By size: rules that no smaller kept
    rule makes redundant are kept, and drop those above them.
    """
    size, kept, left = F.size("antecedent"), None, write_table(rules, "url-rules-found")
    while least := left.agg(F.min(size)).first()[0]:
        level = left.where(size == least)
        kept = level if kept is None else kept.unionByName(level)
        left = left.where(size > least)
        index = level.select(F.explode("antecedent").alias("token"), F.col("rule_id").alias("subset"), F.col("confidence").alias("sure"))
        pairs = left.select("rule_id", "confidence", F.explode("antecedent").alias("token")).join(index, "token").where("sure >= confidence")
        gone = pairs.groupBy("rule_id", "subset").agg(F.count("*").alias("has")).where(F.col("has") == least).select("rule_id").distinct()
        left = write_table(left.join(gone, "rule_id", "left_anti").select(*rules.columns), "url-rules-left")
    return left if kept is None else kept


def mine(labelled: DataFrame, mining: Mining = Mining()) -> DataFrame:
    """Rules from (url, blocked): rule_id, antecedent, confidence, support, without redundant ones."""
    host, path = host_and_path(F.col("url"))
    items = labelled.where("url is not null and blocked is not null").select(
        F.concat(tokens(F.col("url"), host, path), F.array(F.when(F.col("blocked"), F.lit("=block")).otherwise(F.lit("=allow")))).alias("items")
    )
    items = write_table(items, "transactions")
    n = max(items.count(), 1)
    least = max(mining.support, min(1.0, mining.least / n))
    model = FPGrowth(itemsCol="items", minSupport=least, minConfidence=mining.confidence).fit(items)
    found = model.associationRules.where((F.element_at("consequent", 1) == "=block") & (F.col("lift") >= mining.lift))
    found = found.where(mining.lower(F.least("confidence", F.lit(1.0)), F.col("support") * n / F.col("confidence")) >= mining.confidence)
    found = found.select(F.sort_array("antecedent").alias("antecedent"), "confidence", "support").where(~F.array_contains("antecedent", "=allow"))
    return write_table(without_redundant(found.withColumn("rule_id", F.xxhash64("antecedent"))), "url-rules")


def matched(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """For each distinct url that a rule matches: url, mined_rule and mined_confidence of the surest one."""
    host, path = host_and_path(F.col("url"))
    index = rules.select(F.explode("antecedent").alias("token"), "rule_id", F.size("antecedent").alias("needs"), "confidence", F.array_join("antecedent", " ").alias("name"))
    have = urls.where("url is not null").select("url").distinct().select("url", F.explode(tokens(F.col("url"), host, path)).alias("token"))
    hits = have.join(index, "token").groupBy("url", "rule_id", "needs", "confidence", "name").agg(F.count("*").alias("has"))
    best = F.max(F.struct("confidence", "name")).alias("best")
    return hits.where("has = needs").groupBy("url").agg(best).select("url", F.col("best.name").alias("mined_rule"), F.col("best.confidence").alias("mined_confidence"))


def listed_labels(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(url, blocked) of each page that a listed rule fits."""
    host, path = host_and_path(F.col("url"))
    _, verdict = listed(F.col("host"), F.col("path"), rules)
    rows = pages.where("url is not null").select("url", host.alias("host"), path.alias("path"))
    return rows.select("url", (verdict == BLOCK).alias("blocked")).where("blocked is not null")


def judged(pages: DataFrame, labels: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, mining: Mining = Mining()) -> DataFrame:
    """One row per row of pages: page_id, host, path, rule, verdict, mined_rule, mined_confidence.

    labels gives (page_id, blocked) for some pages; without it the listed
    rules label the pages that they fit. Where no listed rule fits, a URL is
    blocked if a mined rule matches and allowed otherwise. Null URLs and URLs
    without `://` have empty host and path and fit no listed rule; null ones
    are allowed, others unless a mined rule matches. Labels that repeat a page
    count as one, blocked if any says so. Of several matching mined rules the
    surest is named, then the last by name. Long URLs are taken whole. Repeated
    rows get the same verdict. Empty tables give an empty result or no mined
    rules. Other columns are ignored, whatever their names.
    """
    pages = pages.select("page_id", "url")
    if labels is None:
        labelled = listed_labels(pages, rules)
    else:
        labelled = pages.join(labels.groupBy("page_id").agg(F.bool_or("blocked").alias("blocked")), "page_id")
    best = matched(pages, mine(labelled, mining))
    host, path = host_and_path(F.col("url"))
    # Null URLs match nothing, so they don't meet in one task of the join.
    none = pages.where("url is null").select("url", "page_id", F.lit(None).cast("string").alias("mined_rule"), F.lit(None).cast("double").alias("mined_confidence"))
    rows = pages.where("url is not null").join(best, "url", "left").unionByName(none).withColumn("host", host).withColumn("path", path)
    name, verdict = listed(F.col("host"), F.col("path"), rules)
    mined = F.when(F.col("mined_rule").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return rows.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, mined).alias("verdict"), "mined_rule", "mined_confidence")
