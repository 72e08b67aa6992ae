"""How far sources of one language differ in their words.

Partitions fold whole documents into stripes: a term of a language with its
document frequency and its count in each source. A partition that holds many
entries spills its stripes and starts anew; the shuffle merges stripes by
language and term. A merged stripe gives its share of every divergence between
two sources that both have the term. Terms that one source of a pair has, or
none, need no pair of a stripe: all terms with the same count there add the
same, so they are counted and multiplied. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atrium.scratch import settings, write_table

#: Documents of a language that a kept term is in at least, and ranks of terms that are returned.
MIN_DOCS, TOP = 3, 200
SCALE = 1_000_000_000
#: Entries (term, source) that a partition folds before it spills, and bytes of a text that are split at once.
ENTRIES, PART = 1_000_000, 8_000_000
#: Pairs of a stripe block that are compared at once.
_PAIRS = 1 << 20
_STRIPE = pa.schema([("lang", pa.string()), ("term", pa.string()), ("docs", pa.int64()), ("sources", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_SHARE = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("high", pa.int64()), ("low", pa.int64())])
#: Bytes of terms stay (A-Z as a-z), all others separate.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> Iterator[list[bytes]]:
    """The terms of a text, part by part."""
    data, start = text.encode("utf-8", "replace").translate(_TABLE), 0
    while start < len(data):
        end = data.find(b" ", start + PART)
        end = len(data) if end < 0 else end
        yield data[start:end].split()
        start = end


class Stripes:
    """Counts of one partition: by language, documents with a term, and occurrences by source."""

    def __init__(self) -> None:
        self.docs: dict[str, Counter[bytes]] = defaultdict(Counter)
        self.counts: dict[str, dict[str, Counter[bytes]]] = defaultdict(lambda: defaultdict(Counter))

    def add(self, text: str, lang: str, source: str) -> None:
        seen: set[bytes] = set()
        for part in terms(text):
            self.counts[lang][source].update(part)
            seen.update(part)
        self.docs[lang].update(seen)

    def entries(self) -> int:
        return sum(len(c) for by in self.counts.values() for c in by.values())

    def batches(self) -> Iterator[pa.RecordBatch]:
        for lang, docs in self.docs.items():
            if not docs:
                continue
            index = dict(zip(docs, range(len(docs)), strict=True))
            own = self.counts[lang]
            at = np.concatenate([np.fromiter(map(index.__getitem__, c), np.int64, len(c)) for c in own.values()])
            source = np.repeat(np.arange(len(own)), [len(c) for c in own.values()])
            n = np.concatenate([np.fromiter(c.values(), np.int64, len(c)) for c in own.values()])
            order = np.argsort(at, kind="stable")
            offsets = pa.array(np.append(0, np.cumsum(np.bincount(at, minlength=len(docs)))), pa.int32())
            names = pa.array(list(own), pa.string()).take(pa.array(source[order]))
            yield from pa.Table.from_arrays(
                [pa.array([lang] * len(docs)), pa.array(list(docs)).cast(pa.string()), pa.array(docs.values(), pa.int64()), pa.ListArray.from_arrays(offsets, names), pa.ListArray.from_arrays(offsets, pa.array(n[order]))],
                schema=_STRIPE,
            ).to_batches(max_chunksize=20_000)


def _folded(entries: int):
    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, since = Stripes(), 0
        for batch in batches:
            for text, lang, source in zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "source")), strict=True):
                held.add(text, lang, source)
                since += len(text)
                # A term of a text takes two characters at least.
                if since > 2 * entries:
                    since = 0
                    if held.entries() > entries:
                        yield from held.batches()
                        held = Stripes()
        yield from held.batches()

    return folded


def _distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def _shares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of stripes with p and base of each source: what a pair of sources that both have the term adds, beyond what each adds alone."""
    for batch in batches:
        column = batch.column("elements")
        flat, offsets = column.flatten(), column.offsets.to_numpy()
        offsets = offsets - offsets[0]
        source = pc.dictionary_encode(flat.field("source"))
        names, code = source.dictionary, source.indices.to_numpy().astype(np.int64)
        p, base = flat.field("p").to_numpy(), flat.field("base").to_numpy()
        many = np.diff(offsets)
        langs = pc.dictionary_encode(batch.column("lang"))
        lang = langs.indices.to_numpy().astype(np.int64)
        keys, highs, lows = [], [], []
        for m in np.unique(many[many > 1]):
            rows = np.flatnonzero(many == m)
            for s in range(0, len(rows), max(1, _PAIRS // int(m * m))):
                some = rows[s : s + max(1, _PAIRS // int(m * m))]
                at = offsets[some][:, None] + np.arange(m)
                ps, bs, cs = p[at][:, :, None], base[at][:, :, None], code[at][:, :, None]
                po, bo, co = p[at][:, None, :], base[at][:, None, :], code[at][:, None, :]
                value = _distance(ps, po) - _distance(ps, bo) - _distance(bs, po) + _distance(bs, bo)
                key = (lang[some][:, None, None] * len(names) + cs) * len(names) + co
                other = np.broadcast_to(cs != co, value.shape)
                found, which = np.unique(key[other], return_inverse=True)
                value, high, low = value[other], np.zeros(len(found), np.int64), np.zeros(len(found), np.int64)
                np.add.at(high, which, value >> 32)
                np.add.at(low, which, value & 0xFFFFFFFF)
                keys.append(found)
                highs.append(high)
                lows.append(low)
        if keys:
            key, one = np.concatenate(keys), len(names)
            found = [langs.dictionary.take(pa.array(key // (one * one))), names.take(pa.array(key // one % one)), names.take(pa.array(key % one))]
            yield pa.RecordBatch.from_arrays([*found, pa.array(np.concatenate(highs)), pa.array(np.concatenate(lows))], schema=_SHARE)


def _p(count: str, total: str) -> Column:
    """1 + floor(SCALE (count + 1) / (total + kinds)), in whole numbers of any size."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10,0)) * CAST({count} + 1 AS DECIMAL(20,0)) div CAST({total} + kinds AS DECIMAL(20,0))")


def _f(p: str, q: str) -> Column:
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def divergences(docs: DataFrame, min_docs: int = MIN_DOCS, top: int = TOP, entries: int = ENTRIES) -> DataFrame:
    """For each source of a language its distances to the others (part `pair`) and the terms it has above the language's share (part `term`).

    Columns lang, source, part, item, value, rank. Null text, lang and source
    are read as ''. Terms are runs of letters A-Z, a-z and characters beyond
    ASCII, lower-cased in A-Z only; a language keeps those in at least min_docs
    of its documents. Ranks run from 1, by falling value and then by item in
    UTF-8 order; of terms the first `top` are returned, of pairs all. A
    language with one source has no pairs, one without kept terms has pairs of
    value 0. Equal rows are different documents. Texts of any length are read
    whole. An empty table gives an empty result. Other columns are ignored.
    """
    spark = docs.sparkSession
    docs = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    with settings(spark, spark__sql__execution__arrow__maxRecordsPerBatch=500, spark__sql__parquet__compression__codec="zstd"):
        stripes = docs.mapInArrow(_folded(entries), "lang string, term string, docs long, sources array<string>, counts array<long>").repartition("lang", "term")
        single = stripes.select("lang", "term", "docs", F.posexplode(F.arrays_zip("sources", "counts")).alias("at", "e"))
        single = single.select("lang", "term", F.when(F.col("at") == 0, F.col("docs")).otherwise(0).alias("docs"), F.col("e.sources").alias("source"), F.col("e.counts").alias("n"))
        merged = single.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
        merged = merged.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("elements"))
        kept = write_table(merged.where(F.col("docs") >= min_docs).select("lang", "term", "total", "elements"), "stripes")

    flat = kept.select("lang", "term", "total", F.inline("elements"))
    by_lang = kept.groupBy("lang").agg(F.count("*").alias("kinds"), F.sum("total").alias("lang_total"))
    by_source = flat.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    sizes = docs.select("lang", "source").distinct().join(by_lang, "lang", "left").join(by_source, ["lang", "source"], "left")
    sizes = sizes.select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("kinds", "lang_total", "source_total")])
    sizes = write_table(sizes.withColumn("base", F.when(F.col("kinds") > 0, _p("0", "source_total"))), "sizes")

    shares = flat.join(sizes, ["lang", "source"]).select("lang", "term", "source", "n", "base", _p("n", "source_total").alias("p"), _p("total", "lang_total").alias("q"))
    best = shares.where("p > q").withColumn("value", _f("p", "q"))
    first = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    found = best.withColumn("rank", first).where(F.col("rank") <= top).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")

    others = sizes.select("lang", F.col("source").alias("item"), F.col("base").alias("item_base"))
    pairs = sizes.select("lang", "source", "kinds", "base").join(others, "lang").where("source <> item")
    nothing = pairs.select("lang", "source", "item", (F.col("kinds") * F.coalesce(_f("base", "item_base"), F.lit(0)).cast("decimal(19,0)")).cast("decimal(38,0)").alias("value"))
    counted = shares.groupBy("lang", "source", "n", "p", "base").agg(F.count("*").alias("terms"))
    alone = counted.join(others, "lang").where("source <> item").select("lang", "source", "item", "terms", (_f("p", "item_base") - _f("base", "item_base")).alias("there"), (_f("item_base", "p") - _f("item_base", "base")).alias("back"))
    alone = alone.select("lang", F.inline(F.array(F.struct("source", "item", F.col("there").alias("x")), F.struct(F.col("item").alias("source"), F.col("source").alias("item"), F.col("back").alias("x")))), "terms")
    alone = alone.select("lang", "source", "item", (F.col("terms").cast("decimal(19,0)") * F.col("x").cast("decimal(19,0)")).cast("decimal(38,0)").alias("value"))
    together = shares.groupBy("lang", "term").agg(F.collect_list(F.struct("source", "p", "base")).alias("elements")).where(F.size("elements") > 1)
    together = together.select("lang", "elements").mapInArrow(_shares, "lang string, source string, item string, high long, low long")
    together = together.groupBy("lang", "source", "item").agg((F.sum(F.col("high").cast("decimal(28,0)")) * F.lit(1 << 32) + F.sum(F.col("low").cast("decimal(28,0)"))).cast("decimal(38,0)").alias("value"))
    value = nothing.unionByName(alone).unionByName(together).groupBy("lang", "source", "item").agg(F.sum("value").cast("long").alias("value"))
    order = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return found.unionByName(value.select("lang", "source", F.lit("pair").alias("part"), "item", "value", order.alias("rank")))
