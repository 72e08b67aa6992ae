import json

from pyspark.sql import functions as F

from atrium.llm import tool_calls as T

SCHEMA = "conv_id long, turn long, role string, kind string, call_id string, name string, arguments string, after string, content string, depth string"
TOOLS = {"sum": (T.Parameter("a", "BIGINT"), T.Parameter("b", "DOUBLE", required=False))}


def _row(conv, turn, kind, call, name=None, arguments=None, after=None, content=None):
    return (conv, turn, "r", kind, call, name, arguments, after, content, "clash")


def _linked(spark, rows):
    return T.linked(spark.createDataFrame(rows, SCHEMA), TOOLS).collect()


def test_links_order_validation_and_json(spark):
    rows = [
        _row(1, 5, "call", "c2", "sum", '{"b": 1.5, "a": 2}', "c1"),
        _row(1, 1, "call", "c1", "sum", '{"a": 1}'),
        _row(1, 6, "result", "c2", content="ok \u00e9 \"q\""),
        _row(1, 2, "result", "c1", content="3"),
        _row(1, 7, "call", "c3", "sum", '{"a": "x", "z": 1}', "c2"),
        _row(1, 8, "result", "c9", content="nobody asked"),
        _row(1, 9, "call", "c1", "sum", "{}"),
        _row(1, 0, "result", "c3", content="too early"),
        _row(2, 1, "call", "x", "sum", "[1]", "y"),
        _row(2, 2, "call", "y", "nope", None, "x"),
        _row(None, 1, "call", "q", "sum", '{"a": 1}'),
        _row(3, None, "note", None, content=None),
    ]
    got = _linked(spark, rows)
    by = {(r["conv_id"], r["turn"], r["kind"]): r for r in got}
    status = {k: r["status"] for k, r in by.items()}
    assert status[1, 1, "call"] == status[1, 5, "call"] == status[1, 2, "result"] == status[1, 6, "result"] == "linked"
    assert status[1, 7, "call"] == "unanswered" and status[1, 0, "result"] == "early" and status[1, 8, "result"] == "orphan" and status[1, 9, "call"] == "repeated"
    assert status[2, 1, "call"] == status[2, 2, "call"] == "cyclic"
    assert status[None, 1, "call"] == "unidentified" and status[3, None, "note"] == "message"
    order = [r["call_id"] for r in sorted((r for r in got if r["conv_id"] == 1), key=lambda r: r["position"])]
    assert order[:5] == ["c1", "c1", "c2", "c2", "c3"] and sorted(r["position"] for r in got if r["conv_id"] == 1) == list(range(8))
    assert by[1, 5, "call"]["valid"] and by[1, 5, "call"]["errors"] == []
    assert by[1, 7, "call"]["errors"] == ["a is not BIGINT", "unexpected z"]
    assert by[1, 9, "call"]["errors"] == ["missing a"] and by[2, 1, "call"]["errors"] == ["arguments are not an object"] and by[2, 2, "call"]["errors"] == ["unknown tool nope"]
    for r in got:
        assert r["json"] == json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert json.loads(by[1, 5, "call"]["json"])["arguments"] == {"a": 2, "b": 1.5}
    assert by[1, 2, "result"]["valid"] is None


def test_long_chain_and_repeated_rows(spark):
    rows = [_row(1, i, "call", f"c{i}", "sum", '{"a": 1}', f"c{i - 1}") for i in range(700)] + [_row(1, 3, "call", "c3", "sum", '{"a": 1}', "c2")] * 2
    got = _linked(spark, rows)
    depth = {r["call_id"]: r["depth"] for r in got if r["status"] != "repeated"}
    assert depth == {f"c{i}": i for i in range(700)} and sum(r["status"] == "repeated" for r in got) == 2
    assert sorted(r["position"] for r in got) == list(range(702))


def test_conversations(spark, sf):
    c = spark.read.parquet(f"{sf}/conversations.parquet")
    got = T.linked(T.from_conversations(c), T.CHAT_TOOLS).collect()
    rows = {(r["conv_id"], r["turn"]): r["role"] for r in c.collect()}
    assert len(got) == len(rows)
    for r in got:
        answered = r["role"] != "assistant" and rows.get((r["conv_id"], r["turn"] + 1)) == "assistant"
        asked = r["role"] == "assistant" and rows.get((r["conv_id"], r["turn"] - 1)) in ("user", "system")
        assert (r["status"] == "linked") == (answered or asked)


def test_empty(spark):
    assert T.linked(spark.createDataFrame([], SCHEMA), TOOLS).count() == 0
    assert spark.range(1).select(T.canonical(F.lit("{bad"))).first()[0] is None


def test_arguments_that_are_no_json_stay(spark):
    got = _linked(spark, [_row(1, 1, "call", "c1", "sum", '{bad "json'), _row(1, 2, "call", "c2", "sum", '{"a": 1}'), _row(1, 3, "call", "c3", "sum", "")])
    by = {r["call_id"]: json.loads(r["json"]) for r in got}
    assert by["c1"]["arguments_text"] == '{bad "json' and "arguments" not in by["c1"]
    assert by["c3"]["arguments_text"] == "" and "arguments_text" not in by["c2"]
    assert all(r["errors"] == ["arguments are not an object"] for r in got if r["call_id"] != "c2")
