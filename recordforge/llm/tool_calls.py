"""Chat formatting: link tool calls to their results and write canonical JSON.

A message whose text is a JSON object may hold ``tool_calls`` (id, name, arguments; the last two may stand in
``function``); one with ``tool_call_id`` is a result, and may hold calls of its own.  Any other text is plain.  Calls and results are joined by
(conversation, identifier).  Messages keep their turn order, but for results that stand before the place of their call:
those follow it, along chains of any length, and results at one place stand in the order of their calls, which is a
topological order.  Arguments, an object or its JSON as a text, are checked against a JSON schema per tool: types, allowed values,
required, known and other names, at any depth.  Every message becomes one JSON object with sorted names and no blanks; calls and results keep
all their fields, with the role of the row.

Result: one row per message with its gapless ``position`` in the conversation (so that no
conversation, however long, meets in one task).

Defined cases: a null text gives no ``content``; a null turn stands first; a null role stays out of the JSON; of two calls with
one identifier the first counts, later ones are counted in ``n_duplicate``; where calls and results
answer each other in a ring, the first message of the ring keeps its place; a result without a call is ``orphan`` and keeps its
place; a call to an unknown tool, or with arguments that are no object, is invalid; messages without
a conversation id form one conversation of their own; repeated rows are all kept; an empty table gives an
empty table.  DataFrame functions only.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordforge.llm.common import cut, with_rank

CALL = "struct<id:string,valid:boolean>"
#: JSON schema type -> beginnings of the variant types that have it
TYPES = {"string": ("STRING",), "integer": ("BIGINT",), "number": ("BIGINT", "DOUBLE", "FLOAT", "DECIMAL"), "boolean": ("BOOLEAN",),
         "object": ("OBJECT",), "array": ("ARRAY",), "null": ("VOID",)}


def fits(value: Column, rule: dict) -> Column:
    """True where a variant fits a JSON schema of type, enum, properties, required, additionalProperties and items.

    What the schema does not mention is allowed, as in JSON schema; other keywords are not checked.
    """
    kind = F.schema_of_variant(value)
    is_object, is_array = kind.startswith("OBJECT"), kind.startswith("ARRAY")
    ok = F.lit(True)
    if "type" in rule:
        wanted = [rule["type"]] if isinstance(rule["type"], str) else rule["type"]
        ok = reduce(Column.__or__, [kind.startswith(t) for w in wanted for t in TYPES[w]])
    if "enum" in rule:
        ok = ok & F.to_json(value).isin(*[json.dumps(x, ensure_ascii=False, separators=(",", ":")) for x in rule["enum"]])
    # members by name, not by path: a name may hold any character
    members = F.when(is_object, F.try_variant_get(value, "$", "map<string,variant>"))
    for name, inner in rule.get("properties", {}).items():
        ok = ok & F.when(is_object & F.map_contains_key(members, name), fits(F.try_element_at(members, F.lit(name)), inner)).otherwise(True)
    for name in rule.get("required", []):
        ok = ok & F.when(is_object, F.map_contains_key(members, name)).otherwise(True)
    if rule.get("additionalProperties") is False:
        known = F.array(*[F.lit(n) for n in rule.get("properties", {})]).cast("array<string>")
        ok = ok & F.when(is_object, F.size(F.array_except(F.map_keys(members), known)) == 0).otherwise(True)
    if "items" in rule:
        ok = ok & F.when(is_array, F.forall(F.try_variant_get(value, "$", "array<variant>"), lambda x: fits(x, rule["items"]))).otherwise(True)
    return F.coalesce(ok, F.lit(False))


def arguments_valid(name: Column, arguments: Column, schemas: dict[str, dict]) -> Column:
    """True where ``arguments`` (a variant) is an object that fits the schema of tool ``name``; false else, also for null."""
    is_object = F.coalesce(F.schema_of_variant(arguments).startswith("OBJECT"), F.lit(False))
    out = F.lit(False)
    for tool, schema in schemas.items():
        out = F.when(name == tool, is_object & fits(arguments, schema)).otherwise(out)
    return out


def unpacked(arguments: Column) -> Column:
    """Arguments as chat data hold them: an object, or an object's JSON as a text."""
    text = F.when(F.schema_of_variant(arguments) == "STRING", F.try_variant_get(arguments, "$", "string"))
    return F.when(text.isNotNull(), F.try_parse_json(text)).otherwise(arguments)


def with_role(variant: Column, role: Column) -> Column:
    """Canonical JSON of the object ``variant``, its ``role`` being that of the row, if there is one."""
    fields = F.try_variant_get(variant, "$", "map<string,variant>")
    fields = F.when(role.isNull(), fields).otherwise(F.map_concat(
        F.map_filter(fields, lambda k, _: k != "role"), F.create_map(F.lit("role"), role.cast("variant"))))
    names = F.array_sort(F.map_keys(fields))
    return F.to_json(F.map_from_arrays(names, F.transform(names, lambda k: F.element_at(fields, k))))


def places(links: DataFrame) -> DataFrame:
    """(row, place, level) of every link (row, turn, call_row, call_turn): the place is the latest turn on the way from
    a result over its call, the call that message answers and so on; the level counts the steps to the message that stands there.

    Pointers are doubled, so a chain of n links takes log(n) joins.
    """
    def combine(active: DataFrame, paths: DataFrame) -> DataFrame:
        far = paths.select(*[F.col(c).alias(f"u_{c}") for c in paths.columns])
        return active.join(far, F.col("to") == F.col("u_row"), "left").select(
            "row", "me", F.col("u_to").alias("to"), (F.col("steps") + F.coalesce("u_steps", F.lit(0))).alias("steps"),
            F.greatest("top", F.when(F.col("u_row").isNotNull(), F.struct(
                F.col("u_top.turn").alias("turn"), (F.col("steps") + F.col("u_top.level")).alias("level")))).alias("top"),
            F.least("low", "u_low").alias("low"))

    def start(links: DataFrame) -> DataFrame:
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        return cut(links.select(
            "row", F.struct("turn", "row").alias("me"), F.col("call_row").alias("to"), one.alias("steps"),
            F.greatest(F.struct("turn", zero.alias("level")), F.struct(F.col("call_turn").alias("turn"), one.alias("level"))).alias("top"),
            F.struct(F.col("call_turn").alias("turn"), F.col("call_row").alias("row")).alias("low")), "paths")

    def state(paths: DataFrame) -> tuple:
        return tuple(paths.where("to is not null").agg(F.count(F.lit(1)), F.sum(F.xxhash64("low").cast("decimal(38,0)"))).first())

    paths, seen = start(links), None
    while True:
        before, seen = seen, state(paths)
        if not seen[0]:
            return paths.select("row", F.col("top.turn").alias("place"), F.col("top.level").alias("level"))
        if before == seen:  # only rings are left, and what hangs on them; a ring opens at its first message
            opened = paths.where("to is not null and low = me").select(F.col("row").alias("ring"))
            links = cut(links.join(opened, F.col("row") == F.col("ring"), "left_anti"), "links", replaces=(paths,))
            paths, seen = start(links), None
            continue
        done = paths.where("to is null")
        paths = cut(done.unionByName(combine(paths.where("to is not null"), paths)), "paths", replaces=(paths,))


def link_tool_calls(messages: DataFrame, schemas: dict[str, dict], conv_col: str = "conv_id", turn_col: str = "turn",
                    role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row per message: conv id, position, turn, kind, n_calls, n_answered, n_valid, n_duplicate, json."""
    parsed = (messages.select(F.col(conv_col).alias("__conv"), F.col(turn_col).alias("__turn"), F.col(role_col).alias("__role"),
                              F.col(text_col).alias("__text"))
              .withColumn("__row", F.monotonically_increasing_id())
              .withColumn("__v", F.when(F.col("__text").rlike(r"\A\s*\{"), F.try_parse_json("__text"))))
    raw = F.try_variant_get(F.col("__v"), "$.tool_calls", "array<variant>")
    name = lambda c: F.coalesce(F.try_variant_get(c, "$.name", "string"), F.try_variant_get(c, "$.function.name", "string"))
    arguments = lambda c: unpacked(F.coalesce(F.try_variant_get(c, "$.arguments", "variant"),
                                              F.try_variant_get(c, "$.function.arguments", "variant")))
    call = lambda c: F.struct(
        F.try_variant_get(c, "$.id", "string").alias("id"), arguments_valid(name(c), arguments(c), schemas).alias("valid"))
    base = cut(parsed.select(
        "__row", "__conv", "__turn", "__role", "__text",
        F.coalesce(F.transform(raw, call), F.expr(f"cast(array() as array<{CALL}>)")).alias("__calls"),
        F.try_variant_get("__v", "$.tool_call_id", "string").alias("__answers"),
        with_role(F.col("__v"), F.col("__role")).alias("__whole")), "messages")
    calls = (base.where(F.size("__calls") > 0)
             .select("__row", "__conv", "__turn", F.posexplode("__calls").alias("__no", "__call"))
             .select(F.col("__conv").alias("__cc"), F.col("__call.id").alias("__id"), F.col("__turn").alias("__ct"),
                     F.col("__no").alias("__cn"), F.col("__row").alias("__cr")).where("__id is not null"))
    firsts = calls.groupBy("__cc", "__id").agg(F.min(F.struct("__ct", "__cr", "__cn")).alias("__first"))
    # the hash of the key is one more key, so that the aggregated side has a shuffle of its own and an identifier answered very often can be split
    same = lambda a, b: (F.col(a).eqNullSafe(F.col(b)) & (F.col("__id") == F.col("__fid"))
                         & (F.xxhash64(a, "__id") == F.xxhash64(b, "__fid")))
    answers = (base.where("__answers is not null").select(F.col("__row").alias("__ar"), "__conv", F.col("__answers").alias("__id"))
               .join(firsts.withColumnRenamed("__id", "__fid"), same("__conv", "__cc"))
               .select("__ar", "__cc", "__id", "__first"))
    # calls of one message that have a result
    answered = (answers.groupBy("__cc", "__id", "__first").agg(F.count(F.lit(1)).alias("__n"))
                .groupBy(F.col("__first.__cr").alias("__cr")).agg(F.count(F.lit(1)).alias("__answered")))
    duplicates = (calls.join(firsts.select(F.col("__cc").alias("__fc"), F.col("__id").alias("__fid"), "__first"),
                             same("__cc", "__fc"))
                  .where(F.struct("__ct", "__cr", "__cn") != F.col("__first"))
                  .groupBy(F.col("__cr").alias("__dr")).agg(F.count(F.lit(1)).alias("__duplicate")))
    # written once: the joins of the places read it
    answers = cut(answers.select("__ar", "__first"), "answers")
    placed_at = places(answers.join(base.select("__row", "__turn"), F.col("__ar") == F.col("__row")).select(
        F.col("__ar").alias("row"), F.col("__turn").alias("turn"), F.col("__first.__cr").alias("call_row"),
        F.col("__first.__ct").alias("call_turn"))).select(F.col("row").alias("__pr"), F.col("place").alias("__place"), F.col("level").alias("__level"))
    linked = (base.join(answers, F.col("__row") == F.col("__ar"), "left").join(placed_at, F.col("__row") == F.col("__pr"), "left")
              .join(answered, F.col("__row") == F.col("__cr"), "left").join(duplicates, F.col("__row") == F.col("__dr"), "left"))
    is_result = F.col("__answers").isNotNull()
    kind = (F.when(F.size("__calls") > 0, "call").when(is_result & F.col("__first").isNotNull(), "result")
            .when(is_result, "orphan").otherwise("message"))
    # sorted names: to_json writes a struct's fields in the order given and leaves nulls out
    plain = F.to_json(F.struct(F.col("__text").alias("content"), F.col("__role").alias("role")))
    written = F.when(kind == "message", plain).otherwise(F.col("__whole"))
    placed = linked.select(
        "__conv", "__turn", "__row", kind.alias("__kind"), F.size("__calls").cast("long").alias("__n_calls"),
        F.coalesce("__answered", F.lit(0)).cast("long").alias("__n_answered"),
        F.size(F.filter("__calls", lambda c: c["valid"])).cast("long").alias("__n_valid"),
        F.coalesce("__duplicate", F.lit(0)).cast("long").alias("__n_duplicate"),
        # where the message stands: its turn, or the place of its call if that comes later
        F.when(F.col("__pr").isNull(), F.col("__turn")).otherwise(F.col("__place")).alias("__at"),
        F.coalesce("__level", F.lit(0)).cast("long").alias("__after"), F.col("__first").alias("__call"), written.alias("__json"))
    ranked = with_rank(placed, ["__conv"], ["__at", "__after", "__call", "__turn", "__row"], name="positions")
    return ranked.select(F.col("__conv").alias(conv_col), F.col("__rank").alias("position"), F.col("__turn").alias(turn_col),
                         F.col("__kind").alias("kind"), F.col("__n_calls").alias("n_calls"), F.col("__n_answered").alias("n_answered"),
                         F.col("__n_valid").alias("n_valid"), F.col("__n_duplicate").alias("n_duplicate"), F.col("__json").alias("json"))
