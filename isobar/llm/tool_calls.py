"""Linking tool calls and their results in conversations (operator 5, Column expressions only).

Calls and results are hash-joined by (conversation, call id). Calls are ordered
topologically along their ``after`` references (a call may need the result of an
earlier one): the level of a call is the length of its chain, found by pointer
doubling over written tables, in a number of rounds that is logarithmic in the
longest chain. Arguments are parsed once as variants and validated against the
tools' schemas; the canonical JSON has sorted keys and no blanks.

All keys are single calls, so a conversation with a third of all turns is spread
like any other, and rows of one id are merged by partial aggregation.

Defined results: one row per (conversation, call id) that occurs as a call or a
result. Of several rows with one id the first counts (turn, then content);
``calls`` and ``results`` tell how many there were. ``status`` is the first that
applies of: orphan (a result without a call), cycle (the references run in a
circle), unknown_tool, bad_json (not an object, or one that has a key twice; the
JSON then has no arguments), missing_field, unknown_field,
bad_type, missing_result, early_result (before its call), ok. A reference to an
unknown call counts as none. Objects and arrays are checked by their kind, not by
what they hold. Arguments and contents of any length are kept whole. Rows with a NULL conversation, id or turn are left
out. An empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from isobar.session import materialize

# Variant type names per schema type.
TYPES = {"integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "DECIMAL"), "string": ("STRING",),
         "boolean": ("BOOLEAN",), "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}


def _first_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    named = df.filter("conv_id IS NOT NULL AND call_id IS NOT NULL AND turn IS NOT NULL")
    return named.groupBy("conv_id", "call_id").agg(
        F.min(F.struct("turn", *columns)).alias("f"), F.count("*").alias("n"))


def levels(calls: DataFrame) -> DataFrame:
    """(conv_id, call_id, level): 1 for calls that need none, NULL in or behind a cycle."""
    ids = calls.select("conv_id", F.col("call_id").alias("after"), F.lit(True).alias("known"))
    state = calls.select("conv_id", "call_id", "after").join(ids, ["conv_id", "after"], "left") \
        .select("conv_id", "call_id", F.when(F.col("known"), F.col("after")).alias("jump"))
    state = materialize(state.withColumn("steps", F.when(F.col("jump").isNull(), 0).otherwise(1).cast("long")), "levels")
    reach, n = 1, None
    while state.filter("jump IS NOT NULL").limit(1).count():
        n = n if n is not None else state.count()
        if reach > n:
            break
        to = state.select("conv_id", F.col("call_id").alias("jump"), F.col("jump").alias("next"),
                          F.col("steps").alias("more"))
        open_, done = state.filter("jump IS NOT NULL"), state.filter("jump IS NULL")
        moved = open_.join(to, ["conv_id", "jump"]).select(
            "conv_id", "call_id", F.col("next").alias("jump"), (F.col("steps") + F.col("more")).alias("steps"))
        state, reach = materialize(done.unionByName(moved), "levels"), reach * 2
    return state.select("conv_id", "call_id", F.when(F.col("jump").isNull(), F.col("steps") + 1).alias("level"))


def _field_type(args: Column, name: str) -> Column:
    """Type of a top-level field; its name is taken as it is, dots and blanks included."""
    if "'" in name and '"' in name:
        raise ValueError(f"a field name cannot hold both kinds of quotes: {name}")
    quote = '"' if "'" in name else "'"
    return F.schema_of_variant(F.try_variant_get(args, f"$[{quote}{name}{quote}]", "variant"))


def _checks(tools: dict[str, dict[str, tuple[str, bool]]]):
    """Per tool: has all required fields, has no other field, every type fits."""
    missing, other, types = F.lit(False), F.lit(False), F.lit(False)
    for tool, fields in tools.items():
        mine = F.col("name") == tool
        lacks, bad = F.lit(False), F.lit(False)
        for name, (kind, required) in fields.items():
            if required:
                lacks = lacks | ~F.array_contains("keys", name)
            kind_of = F.regexp_extract(_field_type(F.col("args"), name), r"^\w+", 0)
            bad = bad | (F.array_contains("keys", name) & ~F.coalesce(kind_of.isin(*TYPES[kind]), F.lit(False)))
        missing = missing | (mine & lacks)
        other = other | (mine & (F.size(F.array_except("keys", F.array(*[F.lit(x) for x in fields]).cast("array<string>"))) > 0))
        types = types | (mine & bad)
    return missing, other, types


def link_calls(calls: DataFrame, results: DataFrame, tools: dict[str, dict[str, tuple[str, bool]]]) -> DataFrame:
    """conv_id, call_id, level, status, calls, results, json.

    ``calls``: conv_id, turn, call_id, name, arguments (JSON text), after;
    ``results``: conv_id, turn, call_id, content;
    ``tools``: name -> field -> (type, required).
    """
    c = _first_rows(calls, ["name", "arguments", "after"])
    c = materialize(c.select("conv_id", "call_id", "f.turn", "f.name", "f.arguments", "f.after",
                             F.col("n").alias("calls")), "calls")
    r = _first_rows(results, ["content"]).select(
        "conv_id", "call_id", F.col("f.turn").alias("r_turn"), F.col("f.content").alias("content"),
        F.col("n").alias("results"))
    both = c.join(levels(c), ["conv_id", "call_id"]).join(r, ["conv_id", "call_id"], "full")
    both = both.withColumn("args", F.try_parse_json("arguments")) \
        .withColumn("keys", F.json_object_keys("arguments"))
    missing, other, types = _checks(tools)
    status = (F.when(F.col("turn").isNull(), "orphan")
              .when(F.col("level").isNull(), "cycle")
              .when(~F.coalesce(F.col("name").isin(*tools), F.lit(False)), "unknown_tool")
              .when(F.col("args").isNull() | F.col("keys").isNull(), "bad_json")
              .when(missing, "missing_field").when(other, "unknown_field").when(types, "bad_type")
              .when(F.col("r_turn").isNull(), "missing_result")
              .when(F.col("r_turn") <= F.col("turn"), "early_result").otherwise("ok"))
    # members in the order of their names; NULL members stay out
    text = F.to_json(F.struct(F.col("args").alias("arguments"), F.col("call_id").alias("id"),
                              F.col("name"), F.col("content").alias("result")))
    return both.select("conv_id", "call_id", "level", status.alias("status"),
                       F.coalesce("calls", F.lit(0)).cast("long").alias("calls"),
                       F.coalesce("results", F.lit(0)).cast("long").alias("results"), text.alias("json"))
