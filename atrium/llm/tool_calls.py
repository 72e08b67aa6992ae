"""Chat formatting: links tool calls with their results and writes canonical JSON.

Calls and results are joined by conversation and identifier. A call may depend
on an earlier call; depths along these dependencies come from pointer doubling
(each round doubles the distance that every call looks back), so that a chain
of n calls takes log n joins. Arguments are validated against schemas and all
JSON is written with sorted keys and no white space. Everything here is
DataFrame operations; no conversation is gathered in one row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from atrium.scratch import write_table

#: Messages of one conversation that are ranked together.
_PART = 1024


@dataclass(frozen=True)
class Parameter:
    """kind: STRING, BIGINT, DOUBLE, BOOLEAN, OBJECT or ARRAY. An integer is a valid DOUBLE, as in JSON. values: all that are allowed,
    as text; least and most: bounds of a number. A name with dots is a field of a nested object."""

    name: str
    kind: str
    required: bool = True
    values: tuple[str, ...] = ()
    least: float | None = None
    most: float | None = None


Schemas = dict[str, tuple[Parameter, ...]]
#: The tools of the conversations' own adapter: system and user messages are calls, assistant messages results.
CHAT_TOOLS: Schemas = {
    "configure": (Parameter("instruction", "STRING"), Parameter("turn", "BIGINT")),
    "ask": (Parameter("prompt", "STRING"), Parameter("turn", "BIGINT"), Parameter("after", "STRING", required=False)),
}


def canonical(json: Column) -> Column:
    """The same JSON with sorted keys and no white space; null if it is not JSON."""
    return F.to_json(F.try_parse_json(json))


def problems(name: Column, arguments: Column, schemas: Schemas) -> Column:
    """What is wrong with a call's arguments, as an array of strings in the schema's order; empty if nothing."""
    variant = F.try_parse_json(arguments)
    parsed = variant.isNotNull() & F.schema_of_variant(variant).startswith("OBJECT")
    out = F.array(F.concat(F.lit("unknown tool "), F.coalesce(name, F.lit("null"))))
    for tool, parameters in schemas.items():
        checks = []
        for p in parameters:
            value = F.try_variant_get(variant, f"$.{p.name}", "variant")
            stated = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
            kind = F.when(stated == "DECIMAL", "DOUBLE").otherwise(stated)
            missing = value.isNull() | (kind == "VOID")
            fits = (kind == p.kind) | ((kind == "BIGINT") if p.kind == "DOUBLE" else F.lit(False))
            if p.required:
                checks.append(F.when(missing, F.lit(f"missing {p.name}")))
            checks.append(F.when(~missing & ~fits, F.lit(f"{p.name} is not {p.kind}")))
            if p.values:
                text = F.try_variant_get(variant, f"$.{p.name}", "string")
                checks.append(F.when(~missing & fits & ~text.isin(*p.values), F.lit(f"{p.name} is none of {', '.join(p.values)}")))
            number = F.try_variant_get(variant, f"$.{p.name}", "double")
            if p.least is not None:
                checks.append(F.when(~missing & fits & (number < p.least), F.lit(f"{p.name} is below {p.least:g}")))
            if p.most is not None:
                checks.append(F.when(~missing & fits & (number > p.most), F.lit(f"{p.name} is above {p.most:g}")))
        top = list(dict.fromkeys(p.name.split(".")[0] for p in parameters))
        known = F.array(*map(F.lit, top)) if top else F.array().cast("array<string>")
        extra = F.transform(F.array_sort(F.array_except(F.json_object_keys(arguments), known)), lambda k: F.concat(F.lit("unexpected "), k))
        found = F.concat(F.filter(F.array(*checks), lambda x: x.isNotNull()), F.coalesce(extra, F.array().cast("array<string>")))
        out = F.when(name == tool, F.when(~F.coalesce(parsed, F.lit(False)), F.array(F.lit("arguments are not an object"))).otherwise(found)).otherwise(out)
    return out


def depths(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, depth) of (conv_id, call_id, after): 0 for calls that depend on none that exists, null on a cycle."""
    own = calls.select("conv_id", "call_id", "after")
    there = own.select("conv_id", F.col("call_id").alias("after"), F.lit(1).alias("there"))
    now = own.join(there.hint("shuffle_hash"), ["conv_id", "after"], "left").select(
        "conv_id", "call_id", F.when(F.col("there") == 1, F.col("after")).alias("up"), F.coalesce("there", F.lit(0)).cast("long").alias("depth")
    )
    now = write_table(now, "depths")
    n, reach = now.count(), 1
    while now.where("up is not null").limit(1).count():
        if reach > 2 * n:
            break
        above = now.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("next"), F.col("depth").alias("more"))
        open_calls = now.where("up is not null").join(above.hint("shuffle_hash"), ["conv_id", "up"])
        moved = open_calls.select("conv_id", "call_id", F.col("next").alias("up"), (F.col("depth") + F.col("more")).alias("depth"))
        now, reach = write_table(now.where("up is null").unionByName(moved), "depths"), 2 * reach
    return now.select("conv_id", "call_id", F.when(F.col("up").isNull(), F.col("depth")).alias("depth"))


def linked(messages: DataFrame, schemas: Schemas) -> DataFrame:
    """Links and orders messages.

    messages: conv_id, turn, role, kind (`call`, `result` or other), call_id,
    name, arguments (JSON), after (the call_id it depends on), content.
    Returns one row per message: conv_id, turn, role, kind, call_id, status,
    depth, position, valid, errors, json.

    status of a call: `linked` or `unanswered`; of a result: `linked`,
    `orphan` (no such call) or `early` (not after its call); `repeated` for
    all but the first call, or the first result, of an identifier (by turn,
    then content); `cyclic` for calls on or behind a cycle; `unidentified`
    where conv_id or call_id is null; other kinds are `message`. position is
    0, 1, ... in each conversation: by depth, calls before their results,
    then by turn; what has no depth comes last; ties are broken by kind and
    then by row. valid is null for what is not a call. Very long contents are
    carried whole. Columns of other names are ignored, whatever they are; an
    empty table gives an empty result.
    """
    messages = messages.select("conv_id", "turn", "role", "kind", "call_id", "name", "arguments", "after", "content")
    # Equal rows stay apart: each gets a number within its equals' salt, from the written table.
    rows = write_table(messages.withColumn("row", F.monotonically_increasing_id()), "messages")
    named = rows.where("conv_id is not null and call_id is not null and kind in ('call', 'result')")
    first = named.groupBy("conv_id", "call_id", "kind").agg(F.min(F.struct("turn", "content", "arguments", "row")).alias("first"))
    first = write_table(first.select("conv_id", "call_id", "kind", F.col("first.row").alias("row"), F.col("first.turn").alias("turn")), "first")
    calls = rows.join(first.where("kind = 'call'").select("row"), "row", "left_semi")
    depth = depths(calls)
    results = first.where("kind = 'result'").select("conv_id", "call_id", F.col("row").alias("result_row"), F.col("turn").alias("result_turn"))
    heads = first.where("kind = 'call'").select("conv_id", "call_id", F.col("row").alias("call_row"), F.col("turn").alias("call_turn"))
    # Links are one row for each identifier, so the hash tables hold no repeated keys.
    links = heads.join(results.hint("shuffle_hash"), ["conv_id", "call_id"], "full").join(depth.hint("shuffle_hash"), ["conv_id", "call_id"], "left")
    links = write_table(links, "links").hint("shuffle_hash")
    # What has no identifier links with nothing and stays out of the join.
    some = rows.where("conv_id is not null and call_id is not null")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in links.schema if f.name not in ("conv_id", "call_id")]
    out = some.join(links, ["conv_id", "call_id"], "left").unionByName(rows.where("conv_id is null or call_id is null").select("*", *empty))
    is_call, is_result = F.col("kind") == "call", F.col("kind") == "result"
    late = F.coalesce(F.col("result_turn") > F.col("call_turn"), F.lit(False))
    cyclic = F.col("call_row").isNotNull() & F.col("depth").isNull()
    status = (
        F.when(~F.coalesce(is_call | is_result, F.lit(False)), "message")
        .when(F.col("conv_id").isNull() | F.col("call_id").isNull(), "unidentified")
        .when((is_call & (F.col("row") != F.col("call_row"))) | (is_result & (F.col("row") != F.col("result_row"))), "repeated")
        .when(is_call & cyclic, "cyclic")
        .when(is_result & F.col("call_row").isNull(), "orphan")
        .when(late, "linked")
        .otherwise(F.when(is_call, "unanswered").otherwise("early"))
    )
    out = out.withColumn("status", status)
    placed = F.when(F.col("status").isin("linked", "unanswered"), F.col("depth"))
    out = out.withColumn("depth", placed)
    errors = F.when(is_call, problems(F.col("name"), F.col("arguments"), schemas))
    out = out.withColumn("errors", errors).withColumn("valid", F.size("errors") == 0)
    out = out.withColumn("valid", F.when(is_call, F.col("valid")))
    fields = {
        "arguments": F.try_parse_json("arguments"),
        # What is no JSON is kept as the text that it is.
        "arguments_text": F.when(F.try_parse_json("arguments").isNull(), F.col("arguments")),
        "call_id": F.col("call_id"),
        "content": F.col("content"),
        "depth": F.col("depth"),
        "name": F.col("name"),
        "role": F.col("role"),
        "status": F.col("status"),
        "turn": F.col("turn"),
    }
    out = out.withColumn("json", F.to_json(F.struct(*[c.alias(k) for k, c in sorted(fields.items())])))
    out = write_table(out.select("conv_id", "turn", "role", "kind", "call_id", "status", "depth", "valid", "errors", "json", "row"), "linked")
    return _positions(out)


def _positions(rows: DataFrame) -> DataFrame:
    """Ranks within conversations. Parts of bounded depth and, within them, of bounded spans of turns come first, so that a very
    long conversation is split even where all its calls have one depth; only messages of one step and turn meet in a task."""
    far = F.lit(1 << 62)
    step = F.coalesce(2 * F.col("depth") + (F.col("kind") == "result").cast("long"), far)
    late = F.coalesce(F.floor(F.col("turn") / _PART), F.lit(1 << 40))
    rows = rows.withColumn("_step", step).withColumn("_late", late)
    keys = ["conv_id", "_step", "_late"]
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("_step", "_late").rowsBetween(Window.unboundedPreceding, -1))
    sizes = sizes.select(*keys, F.coalesce(before, F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("turn").asc_nulls_last(), "kind", "row")) - 1
    placed = rows.withColumn("own", own)
    same = [placed["conv_id"].eqNullSafe(sizes["conv_id"]), placed["_step"] == sizes["_step"], placed["_late"] == sizes["_late"]]
    out = placed.join(sizes.hint("shuffle_hash"), same)
    return out.select(placed["conv_id"], "turn", "role", "kind", "call_id", "status", "depth", (F.col("before") + F.col("own")).alias("position"), "valid", "errors", "json")


def from_conversations(conversations: DataFrame) -> DataFrame:
    """Messages of plain conversations: a system or user message is a call whose identifier is made of conversation
    and turn, which depends on the call two turns before; an assistant message is the result of the turn before."""
    conv, turn, text = F.col("conv_id"), F.col("turn"), F.col("text")
    identifier = lambda t: F.concat(F.lit("call_"), conv.cast("string"), F.lit("_"), t.cast("string"))
    is_result = F.coalesce(F.col("role") == "assistant", F.lit(False))
    is_call = F.coalesce(F.col("role").isin("system", "user"), F.lit(False))
    system = F.col("role") == "system"
    after = F.when(is_call & (turn >= 2), identifier(turn - 2))
    arguments = F.when(system, F.to_json(F.struct(text.alias("instruction"), turn.alias("turn")))).otherwise(
        F.to_json(F.struct(text.alias("prompt"), turn.alias("turn"), after.alias("after")))
    )
    return conversations.select(
        conv,
        turn,
        "role",
        F.when(is_call, "call").when(is_result, "result").otherwise("other").alias("kind"),
        F.when(is_call, identifier(turn)).when(is_result, identifier(turn - 1)).alias("call_id"),
        F.when(is_call, F.when(system, "configure").otherwise("ask")).alias("name"),
        F.when(is_call, arguments).alias("arguments"),
        after.alias("after"),
        F.when(~is_call, text).alias("content"),
    )
