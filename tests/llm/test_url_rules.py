from atrium.llm import url_rules as U

URLS = [
    (1, "http://a.net/x"), (2, "https://EXAMPLE.net/en/1"), (3, "http://b.example.com/de/9?x=1"), (4, "http://q.org/fr/"), (5, "http://q.org/en/"),
    (6, None), (7, "no scheme.net/x"), (8, "http://a.net"), (9, "http://anet/x"), (10, "ftp://x.example.net/en?y#z"), (11, ""), (12, "http://A.B.Net?q/"), (13, "x://"), (1, "http://a.net/x"),
]


def plain(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.name), default=None)
    return host, path, best and best.name, best and best.verdict


def test_listed_rules(spark):
    pages = spark.createDataFrame([(*u, "x") for u in URLS], "page_id long, url string, host string")
    got = U.judged(pages, spark.createDataFrame([], "page_id long, blocked boolean")).collect()
    assert len(got) == len(URLS)
    urls = dict(URLS)
    for r in got:
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow"), r


def test_mined_rules_against_counting(spark):
    rows = [(i, f"http://{'bad' if i % 3 == 0 else 'good'}.example.io/{'ads' if i % 2 else 'news'}/{i}") for i in range(300)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 6 == 3) for i in range(200)] + [(5, False), (None, True)], "page_id long, blocked boolean")
    got = {r["page_id"]: r for r in U.judged(pages, labels, mining=U.Mining(confidence=0.9)).collect()}
    # Only bad hosts under ads are blocked in the labels: the rule must need both tokens.
    assert {i for i, r in got.items() if r["verdict"] == "block"} == {i for i in range(300) if i % 6 == 3}
    rule = got[3]["mined_rule"]
    assert "host:bad" in rule and "path:ads" in rule and got[3]["mined_confidence"] == 1.0


def test_a_long_template_leaves_room_for_less_sure_rules(spark):
    # 14 constant tokens are in 16,383 sets, all of confidence 1; the other host is blocked in six of ten.
    rows = [(i, f"http://a.b.c.d.e.f/g/h/i/j/k/l/m/{i}") for i in range(100)] + [(i, f"ftp://other.io/{i}") for i in range(100, 200)]
    rows += [(i, f"ftp://good.org/{i}") for i in range(200, 500)]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    labels = spark.createDataFrame([(i, i < 100 or i < 200 and i % 10 < 6) for i in range(500)], "page_id long, blocked boolean")
    got = {r["page_id"]: r for r in U.judged(pages, labels).collect()}
    assert {i for i, r in got.items() if r["verdict"] == "block"} == set(range(200))
    assert {r["mined_confidence"] for i, r in got.items() if i < 100} == {1.0}
    assert {r["mined_confidence"] for i, r in got.items() if 100 <= i < 200} == {0.6}


def test_only_redundant_rules_go(spark):
    rules = [(1, ["a"], 0.6), (2, ["a", "b"], 0.6), (3, ["a", "c"], 0.7), (4, ["a", "b", "c"], 0.65), (5, ["b", "c"], 0.5), (6, ["a", "b", "d"], 0.8)]
    found = spark.createDataFrame(rules, "rule_id long, antecedent array<string>, confidence double")
    assert sorted(r["rule_id"] for r in U.without_redundant(found).collect()) == [1, 3, 5, 6]


def test_whole_table_against_a_plain_loop(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    got = U.judged(pages, spark.createDataFrame([], "page_id long, blocked boolean"))
    urls = {r["page_id"]: r["url"] for r in pages.collect()}
    for r in got.collect():
        host, path, rule, verdict = plain(urls[r["page_id"]])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judged(none, spark.createDataFrame([(1, True)], "page_id long, blocked boolean")).count() == 0
