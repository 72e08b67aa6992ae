"""Links, order, validation and JSON of ten thousand messages against a plain loop."""

import json
import random

from atrium.llm.tool_calls import Parameter, linked

SCHEMAS = {
    "add": (Parameter("a", "DOUBLE"), Parameter("b", "DOUBLE", required=False)),
    "find": (Parameter("query", "STRING"), Parameter("top", "BIGINT", required=False, least=1, most=50), Parameter("sort", "STRING", required=False, values=("asc", "desc")), Parameter("where.city", "STRING", required=False)),
}
ARGUMENTS = ['{"a": 1, "b": 2}', '{"a":1.5}', '{"b": 2}', '{"a": "x"}', "[1]", "no", '{"a": 1, "z": 0}', '{"query":"q","top":0}', '{"query":"q","top":9,"sort":"up"}', '{"query":"q","where":{"city":"Ulm"}}', '{"query":"q","where":{"city":3}}', None]


def _messages(n, seed=4):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        conv = 0 if i % 3 == 0 else rng.randrange(1, n // 12)  # one conversation holds a third
        kind = rng.choice(["call", "call", "result", "other"])
        call = f"c{rng.randrange(n // 3 if conv == 0 else 6)}"
        after = f"c{rng.randrange(n // 3 if conv == 0 else 6)}" if kind == "call" and rng.random() < 0.5 else None
        out.append((conv, i, "user", kind, call if kind != "other" else None, rng.choice(["add", "find", "none"]) if kind == "call" else None, rng.choice(ARGUMENTS) if kind == "call" else None, after, "text" if kind != "call" else None))
    return out + [(None, 1, "user", "call", "c1", "add", '{"a":1}', None, None), (1, 5, "user", "result", None, None, None, None, "x")]


def _problems(name, arguments):
    if name not in SCHEMAS:
        return [f"unknown tool {name}"]
    try:
        value = json.loads(arguments)
    except (TypeError, ValueError):
        value = None
    if not isinstance(value, dict):
        return ["arguments are not an object"]
    out = []
    for p in SCHEMAS[name]:
        x = value
        for part in p.name.split("."):
            x = x.get(part) if isinstance(x, dict) else None
        if x is None:
            out += [f"missing {p.name}"] if p.required else []
            continue
        kind = {str: "STRING", int: "BIGINT", float: "DOUBLE", bool: "BOOLEAN"}[type(x)]
        if kind != p.kind and (kind, p.kind) != ("BIGINT", "DOUBLE"):
            out.append(f"{p.name} is not {p.kind}")
        elif p.values and x not in p.values:
            out.append(f"{p.name} is none of {', '.join(p.values)}")
        elif p.least is not None and x < p.least:
            out.append(f"{p.name} is below {p.least:g}")
        elif p.most is not None and x > p.most:
            out.append(f"{p.name} is above {p.most:g}")
    return out + [f"unexpected {k}" for k in sorted(set(value) - {p.name.split(".")[0] for p in SCHEMAS[name]})]


def _plain(rows):
    first = {}
    for r in rows:
        conv, turn, _, kind, call, *_ = r
        if conv is not None and call is not None and kind in ("call", "result"):
            k = (conv, call, kind)
            if k not in first or turn < first[k][1]:
                first[k] = r
    depth = {}

    def deep(k, path):
        if k in depth:
            return depth[k]
        if k in path:
            return None
        up = first[(*k, "call")][7]
        above = (k[0], up)
        d = 0 if up is None or (*above, "call") not in first else deep(above, path | {k})
        value = 0 if up is None or (*above, "call") not in first else None if d is None else d + 1
        if not path:
            depth[k] = value
        return value

    out = {}
    for r in rows:
        conv, turn, _, kind, call, name, arguments, _, _ = r
        if kind not in ("call", "result"):
            status, d = "message", None
        elif conv is None or call is None:
            status, d = "unidentified", None
        else:
            c, s = first.get((conv, call, "call")), first.get((conv, call, "result"))
            d = deep((conv, call), frozenset()) if c else None
            late = bool(c and s and s[1] > c[1])
            if first[(conv, call, kind)] is not r:
                status = "repeated"
            elif kind == "call" and d is None:
                status = "cyclic"
            elif kind == "result" and c is None:
                status = "orphan"
            else:
                status = "linked" if late else "unanswered" if kind == "call" else "early"
            d = d if status in ("linked", "unanswered") else None
        out[conv, turn, kind] = [status, d, _problems(name, arguments) if kind == "call" else None]
    by = {}
    for (conv, turn, kind), (_, d, _) in out.items():
        by.setdefault(conv, []).append((1 << 62 if d is None else 2 * d + (kind == "result"), turn, kind))
    for conv, some in by.items():
        for i, (_, turn, kind) in enumerate(sorted(some)):
            out[conv, turn, kind].append(i)
    return out


def test_ten_thousand_messages(spark):
    import sys

    sys.setrecursionlimit(20000)
    rows = _messages(10_000)
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], "conv_id long, turn long, role string, kind string, call_id string, name string, arguments string, after string, content string, row string, depth string").repartition(7)
    got = {(r["conv_id"], r["turn"], r["kind"]): [r["status"], r["depth"], r["errors"], r["position"]] for r in linked(df, SCHEMAS).collect()}
    want = _plain(rows)
    assert len(got) == len(rows) and {s for s, *_ in want.values()} == {"message", "unidentified", "repeated", "cyclic", "orphan", "linked", "unanswered", "early"}
    assert [(k, got[k], want[k]) for k in want if got[k] != want[k]][:3] == []


def test_json_is_canonical(spark):
    rows = [(1, 0, "user", "call", "c", "add", '{ "b" : 2, "a" : 1 }', None, None), (1, 1, "tool", "result", "c", None, None, None, 'a "quoted"\nline')]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, kind string, call_id string, name string, arguments string, after string, content string")
    call, result = (r["json"] for r in linked(df, SCHEMAS).orderBy("turn").collect())
    assert call == '{"arguments":{"a":1,"b":2},"call_id":"c","depth":0,"name":"add","role":"user","status":"linked","turn":0}'
    assert json.loads(result)["content"] == 'a "quoted"\nline'
