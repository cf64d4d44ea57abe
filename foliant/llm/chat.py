"""Chat formatting with linked tool calls, in DataFrame functions only.

A message's text is plain, or a JSON object of one of these forms:
  assistant {"content": ..., "tool_calls": [{"id": ..., "name": ..., "arguments": {...}}, ...]}; a call may also be
            {"id": ..., "type": "function", "function": {"name": ..., "arguments": ...}}, and arguments the JSON text of an object
  tool      {"tool_call_id": ..., "content": ...}
  system    {"content": ..., "tools": [{"name": ..., "parameters": {"properties": {p: {"type": t}}, "required": [p]}}]}
Anything else, JSON or not, is plain text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm.common import stage

CALLS = "array<struct<id:string,name:string,arguments:string,function:struct<name:string,arguments:string>>>"
TOOLS = "array<struct<name:string,parameters:struct<properties:map<string,struct<type:string>>,required:array<string>>>>"


def _parsed(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, kind, content, calls, call_id, tools, rest; one row per input row.

    rest holds the parts of a JSON message besides content, role and what its kind is read from.
    """
    rows = turns.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    looks = F.col("text").rlike("^\\s*\\{")
    rows = rows.withColumn("v", F.when(looks, F.try_parse_json("text")))
    part = lambda p, t: F.try_variant_get("v", p, t)
    # Nested parts are taken as text and read by schema, so that one odd part spoils only itself.
    given = F.from_json(F.to_json(part("$.tool_calls", "variant")), CALLS)
    more = part("$.tool_calls", "array<map<string,variant>>")
    of = lambda c, name: F.coalesce(c[name], c["function"][name]).alias(name)
    calls = F.transform(given, lambda c, i: F.struct(c["id"].alias("id"), of(c, "name"), of(c, "arguments"), _without(F.get(more, i), "id", "name", "arguments", "function").alias("rest")))
    tools = F.from_json(F.to_json(part("$.tools", "variant")), TOOLS)
    call_id = part("$.tool_call_id", "string")
    rows = rows.withColumn("calls", F.when(F.col("role") == "assistant", calls)).withColumn("tools", F.when(F.col("role") == "system", tools))
    rows = rows.withColumn("call_id", F.when(F.col("role") == "tool", call_id))
    kind = (
        F.when(F.size("calls") > 0, "calls").when(F.col("call_id").isNotNull(), "result").when(F.size("tools") > 0, "tools").otherwise("plain")
    )
    rows = rows.withColumn("kind", kind)
    as_text = F.coalesce(part("$.content", "string"), F.when(F.schema_of_variant(part("$.content", "variant")) != "VOID", F.to_json(part("$.content", "variant"))))
    content = F.when(F.col("kind") == "plain", F.coalesce("text", F.lit(""))).otherwise(as_text)
    own = F.when(F.col("kind") == "calls", "tool_calls").when(F.col("kind") == "result", "tool_call_id").otherwise(F.lit(""))
    rest = F.map_filter(_without(part("$", "map<string,variant>"), "content", "role"), lambda k, _: k != own)
    return rows.withColumn("content", content).withColumn("rest", F.when(F.col("kind") != "plain", rest)).drop("v")


def _without(parts, *names: str):
    return F.map_filter(parts, lambda k, _: ~k.isin(*names))


def _variant(value):
    """A string as a variant, null if it is null."""
    made = F.try_variant_get(F.try_parse_json(F.to_json(F.struct(value.alias("s")))), "$.s", "variant")
    return F.when(value.isNotNull(), made)


def _sorted(parts):
    """A map with its keys in order."""
    return F.map_from_entries(F.transform(F.array_sort(F.map_keys(parts)), lambda k: F.struct(k, parts[k])))


def _kind_of(value):
    """JSON schema type of an argument's variant."""
    s = F.schema_of_variant(value)
    return (
        F.when(s == "STRING", "string")
        .when(s == "BIGINT", "integer")
        .when(s.rlike("^(DECIMAL|DOUBLE|FLOAT)"), "number")
        .when(s == "BOOLEAN", "boolean")
        .when(s.startswith("ARRAY"), "array")
        .when(s.startswith("OBJECT"), "object")
        .otherwise("null")
    )


def link_calls(turns: DataFrame) -> DataFrame:
    """One row per call and per result that no call answers to: conv_id, call_id, name, call_turn, call_pos, result_turn, status, problems.

    Calls and results meet in a hash join on (conv_id, call_id). Of equal ids the first call and the first result (by
    turn, then place) are linked; later ones get status `duplicate`. Others: `linked`, `no_result`, `no_call`.
    problems lists, sorted and joined by `; `, what breaks the schema of the called tool: `unknown tool`, `missing p`,
    `unexpected p`, `p is not t`, `arguments are not an object`. Where no schema is given in the conversation, only the
    last one is reported, of arguments that aren't JSON.
    """
    rows = _parsed(turns).where("conv_id IS NOT NULL")
    calls = rows.where("kind = 'calls'").select("conv_id", "turn", F.posexplode("calls").alias("pos", "c"))
    calls = calls.select("conv_id", F.col("turn").alias("call_turn"), F.col("pos").cast("long").alias("call_pos"), F.col("c.id").alias("call_id"), F.col("c.name").alias("name"), F.col("c.arguments").alias("arguments"))
    first = Window.partitionBy("conv_id", "call_id").orderBy("call_turn", "call_pos")
    calls = calls.withColumn("rank", F.row_number().over(first))
    results = rows.where("kind = 'result'").select("conv_id", "call_id", F.col("turn").alias("result_turn"), "content")
    results = results.withColumn("rrank", F.row_number().over(Window.partitionBy("conv_id", "call_id").orderBy("result_turn", "content"))).drop("content")

    schema = rows.where("kind = 'tools'").select("conv_id", "turn", F.explode("tools").alias("t"))
    schema = schema.groupBy(F.col("conv_id").alias("in_conv"), F.col("t.name").alias("tool")).agg(F.min_by("t.parameters", "turn").alias("p"))
    given = schema.select(F.col("in_conv").alias("conv_id")).distinct().withColumn("has_schema", F.lit(True))
    calls = calls.join(schema, (F.col("conv_id") == F.col("in_conv")) & (F.col("name") == F.col("tool")), "left").drop("in_conv")
    calls = calls.join(given, "conv_id", "left")
    args = F.from_json("arguments", "map<string,variant>")
    calls = calls.withColumn("args", args)
    wanted, needed = F.col("p.properties"), F.col("p.required")
    wrong = F.transform(
        F.filter(
            F.map_entries("args"),
            lambda e: wanted[e["key"]].isNotNull()
            & (wanted[e["key"]]["type"] != _kind_of(e["value"]))
            & ~((wanted[e["key"]]["type"] == "number") & (_kind_of(e["value"]) == "integer")),
        ),
        lambda e: F.concat(e["key"], F.lit(" is not "), wanted[e["key"]]["type"]),
    )
    nothing = F.array().cast("array<string>")
    problems = (
        F.when(F.col("has_schema").isNull() & F.col("arguments").isNotNull() & F.try_parse_json("arguments").isNull(), F.array(F.lit("arguments are not an object")))
        .when(F.col("has_schema").isNull(), nothing)
        .when(F.col("tool").isNull(), F.array(F.lit("unknown tool")))
        .when(F.col("args").isNull(), F.array(F.lit("arguments are not an object")))
        .otherwise(
            F.concat(
                F.coalesce(F.transform(F.filter(needed, lambda x: ~F.coalesce(F.map_contains_key("args", x), F.lit(False))), lambda x: F.concat(F.lit("missing "), x)), nothing),
                F.coalesce(F.transform(F.filter(F.map_keys("args"), lambda x: ~F.coalesce(F.map_contains_key(wanted, x), F.lit(False))), lambda x: F.concat(F.lit("unexpected "), x)), nothing),
                F.coalesce(wrong, nothing),
            )
        )
    )
    calls = calls.withColumn("problems", F.array_join(F.array_sort(problems), "; ")).drop("args", "p", "tool", "has_schema", "arguments")
    one = calls.where("rank = 1 AND call_id IS NOT NULL").join(results.where("rrank = 1"), ["conv_id", "call_id"], "full")
    one = one.withColumn("status", F.when(F.col("call_turn").isNull(), "no_call").when(F.col("result_turn").isNull(), "no_result").otherwise("linked"))
    again = calls.where("rank > 1 OR call_id IS NULL").withColumn("status", F.when(F.col("call_id").isNull(), "no_result").otherwise("duplicate"))
    late = results.where("rrank > 1").withColumn("status", F.lit("duplicate"))
    names = ["conv_id", "call_id", "name", "call_turn", "call_pos", "result_turn", "status", "problems"]
    out = one.unionByName(again, allowMissingColumns=True).unionByName(late, allowMissingColumns=True)
    return out.select(*names).withColumn("problems", F.coalesce("problems", F.lit("")))


def needs(turns: DataFrame, links: DataFrame) -> DataFrame:
    """conv_id, before, after: turns of messages of which the second needs the first.

    A result needs its call. A call whose arguments name another call's id (a string that is the id, bare or as $id,
    ${id} or {{id}}) needs that call's result, or the call itself where it has none.
    """
    rows = _parsed(turns).where("conv_id IS NOT NULL AND turn IS NOT NULL AND kind = 'calls'")
    calls = rows.select("conv_id", "turn", F.explode("calls").alias("c"))
    strings = F.regexp_extract_all(F.col("c.arguments"), F.lit('"((?:[^"\\\\]|\\\\.)*)"'), F.lit(1))
    named = calls.select("conv_id", F.col("turn").alias("after"), F.explode(F.array_distinct(strings)).alias("s"))
    named = named.select("conv_id", "after", F.regexp_replace("s", "^[$]?[{]{0,2}\\s*|\\s*[}]{0,2}$", "").alias("call_id"))
    made = links.where("call_turn IS NOT NULL AND call_id IS NOT NULL AND status IN ('linked', 'no_result')")
    by_name = named.join(made.select("conv_id", "call_id", F.coalesce("result_turn", "call_turn").alias("before")), ["conv_id", "call_id"])
    by_id = links.where("status = 'linked'").select("conv_id", F.col("call_turn").alias("before"), F.col("result_turn").alias("after"))
    return by_name.select("conv_id", "before", "after").unionByName(by_id).where("before != after").distinct()


def order(edges: DataFrame) -> DataFrame:
    """conv_id, turn, order_turn, order_step, cyclic of the turns that stand in needs() (staged).

    (order_turn, order_step, turn) puts a message behind all it needs and otherwise keeps the turns. Every round passes
    the places on by one need, so there are as many rounds as the longest chain. Without a cycle no step reaches the
    number of turns; where needs lead back to themselves, steps grow with the rounds. After twice as many rounds as any
    conversation has turns, turns of such steps are cyclic (or wait for one that is) and keep their own turn.
    """
    ends = [edges.select("conv_id", F.col(c).alias("turn")) for c in ("before", "after")]
    at = ends[0].unionByName(ends[1]).distinct()
    at = stage(at.withColumns({"order_turn": F.col("turn"), "order_step": F.lit(0).cast("long"), "moved": F.lit(False)}))
    late = edges.where("before > after")
    most = 0 if late.isEmpty() else at.groupBy("conv_id").count().agg(F.max("count")).first()[0]
    for _ in range(2 * most + 2 if most else 0):
        given = at.select("conv_id", F.col("turn").alias("before"), F.struct("order_turn", (F.col("order_step") + 1).alias("order_step")).alias("p"))
        asked = edges.join(given, ["conv_id", "before"]).groupBy("conv_id", F.col("after").alias("turn")).agg(F.max("p").alias("p"))
        own = F.struct(F.col("turn").alias("order_turn"), F.lit(0).cast("long").alias("order_step"))
        new = F.greatest(own, F.coalesce("p", own))
        joined = at.join(asked, ["conv_id", "turn"], "left").withColumn("new", new)
        moved = (F.col("new.order_turn") != F.col("order_turn")) | (F.col("new.order_step") != F.col("order_step"))
        at = stage(joined.select("conv_id", "turn", F.col("new.order_turn").alias("order_turn"), F.col("new.order_step").alias("order_step"), moved.alias("moved")))
        if at.where("moved").isEmpty():
            break
    cyclic = F.col("order_step") >= max(most, 1)
    back = lambda c, other: F.when(cyclic, other).otherwise(F.col(c)).alias(c)
    return at.select("conv_id", "turn", back("order_turn", F.col("turn")), back("order_step", F.lit(0).cast("long")), cyclic.alias("cyclic"))


def format_chat(turns: DataFrame) -> DataFrame:
    """One row per message: conv_id, order_turn, order_step, turn, role, kind, linked_turn, valid, message.

    (order_turn, order_step, turn) is a topological order of the conversation: messages go by turn, but a result follows
    its call, and a call follows the results whose calls it names (see needs). linked_turn is the call's turn of a
    result. valid is false for a message with a call that breaks its schema, a duplicate, a call without result, a result
    without call, or a need that leads back to itself. message is canonical JSON: keys sorted, no blanks; parts that this
    module doesn't know stay as they are. A call is {arguments, id, name} and its further parts; arguments that are the
    JSON text of a value become that value, others stay as their string, absent ones are {}. Absent or null content is null.

    turns needs conv_id, turn, role, text; other columns are ignored. Null roles read as "user", null texts as empty;
    rows with a null conv_id or turn are formatted without links; repeated rows give repeated messages. An empty table
    gives no rows. A conversation is never gathered into one row or task.
    """
    rows = _parsed(turns)
    links = link_calls(turns)
    edges = stage(needs(turns, links))
    bad = (F.col("status") != "linked") | (F.col("problems") != "")
    by_call = links.where("call_turn IS NOT NULL").groupBy("conv_id", F.col("call_turn").alias("turn")).agg(F.max(bad).alias("bad_call"))
    by_result = links.where("result_turn IS NOT NULL").groupBy("conv_id", F.col("result_turn").alias("turn"), "call_id").agg(
        F.min(F.when(F.col("status") == "linked", F.col("call_turn"))).alias("linked_turn"), F.max(F.col("status") != "linked").alias("bad_result")
    )
    joined = rows.join(by_call, ["conv_id", "turn"], "left").join(by_result, ["conv_id", "turn", "call_id"], "left")
    joined = joined.join(order(edges), ["conv_id", "turn"], "left")
    role = F.coalesce("role", F.lit("user"))
    given = lambda c: F.coalesce(F.try_parse_json(c["arguments"]), _variant(c["arguments"]), F.try_parse_json(F.lit("{}")))
    calls = F.transform(
        "calls",
        lambda c: _sorted(F.map_concat(F.coalesce(c["rest"], _empty()), _parts(arguments=given(c), id=_variant(c["id"]), name=_variant(c["name"])))),
    )
    plain = F.to_json(F.struct(F.col("content"), role.alias("role")))
    parts = F.map_concat(F.coalesce("rest", _empty()), _parts(content=_variant(F.col("content")), role=_variant(role)))
    parts = F.when(F.col("kind") == "result", F.map_concat(parts, _parts(tool_call_id=_variant(F.col("call_id"))))).when(
        F.col("kind") == "calls", F.map_concat(parts, _parts(tool_calls=F.try_parse_json(F.to_json(calls))))
    ).otherwise(parts)
    no = F.lit(False)
    return joined.select(
        "conv_id",
        F.coalesce("order_turn", "turn").alias("order_turn"),
        F.coalesce("order_step", F.lit(0).cast("long")).alias("order_step"),
        "turn",
        role.alias("role"),
        "kind",
        "linked_turn",
        (~(F.coalesce("bad_call", no) | F.coalesce("bad_result", no) | F.coalesce("cyclic", no))).alias("valid"),
        F.when(F.col("kind") == "plain", plain).otherwise(F.to_json(_sorted(parts))).alias("message"),
    )


def _empty():
    return F.expr("cast(map() AS map<string,variant>)")


def _parts(**values):
    return F.create_map(*[x for k, v in values.items() for x in (F.lit(k), v)])


def oracle() -> str:
    """format_chat over table conversations in DuckDB, for conversations of plain messages; tests cover tool messages."""
    return """
SELECT conv_id, turn AS order_turn, 0::BIGINT AS order_step, turn, coalesce(role, 'user') AS role, 'plain' AS kind,
       NULL::BIGINT AS linked_turn, true AS valid,
       '{"content":' || to_json(coalesce(text, ''))::VARCHAR || ',"role":' || to_json(coalesce(role, 'user'))::VARCHAR || '}' AS message
FROM conversations
"""
