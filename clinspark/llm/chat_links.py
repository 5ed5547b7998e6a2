"""Tool calls of conversations joined with their results, checked, put in order and written as canonical JSON.

DataFrame functions only.  Calls and results meet by a hash join on conversation and identifier, so the turns of a conversation
are never gathered in one place, however many it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinspark.llm.ranks import running
from clinspark.llm.store import new_folder, stored

_TYPES = {"string": ["STRING"], "integer": ["BIGINT"], "number": ["BIGINT", "DOUBLE", "DECIMAL", "FLOAT"], "boolean": ["BOOLEAN"], "array": ["ARRAY"], "object": ["OBJECT"]}


def argument_errors(name: Column, arguments: Column, tools: list[dict]) -> Column:
    """What is wrong with ``arguments``, a JSON text, under the schema of the tool ``name``; an empty array if nothing.

    ``tools`` holds ``{"name": ..., "parameters": schema}``.  Of a schema count ``properties`` with ``type``, ``enum``, ``minimum``,
    ``maximum``, ``minLength`` and ``maxLength``, and ``required`` and ``additionalProperties``."""
    value = F.try_parse_json(arguments)
    found = F.when(value.isNull(), F.array(F.lit("arguments: not JSON"))).when(~F.schema_of_variant(value).startswith("OBJECT"), F.array(F.lit("arguments: not an object")))
    chosen = found
    for tool in tools:
        schema = tool["parameters"]
        checks: list[Column] = []
        for prop, rule in schema.get("properties", {}).items():
            path = f"$['{prop}']"
            part = F.try_variant_get(value, path, "variant")
            kind = F.schema_of_variant(part)
            wanted = _TYPES.get(rule.get("type"), [])
            right = F.lit(not wanted)
            for t in wanted:
                right = right | kind.startswith(t)
            if prop in schema.get("required", []):
                checks.append(F.when(part.isNull(), F.lit(f"{prop}: missing")))
            checks.append(F.when(part.isNotNull() & ~right, F.lit(f"{prop}: not {rule.get('type')}")))
            text, number = F.try_variant_get(value, path, "string"), F.try_variant_get(value, path, "double")
            for key, broken in (
                ("enum", lambda v, text=text: ~text.isin([str(x) for x in v])),
                ("minimum", lambda v, number=number: number < v),
                ("maximum", lambda v, number=number: number > v),
                ("minLength", lambda v, text=text: F.length(text) < v),
                ("maxLength", lambda v, text=text: F.length(text) > v),
            ):
                if key in rule:
                    checks.append(F.when(part.isNotNull() & right & broken(rule[key]), F.lit(f"{prop}: {key}")))
        if schema.get("additionalProperties") is False:
            extra = F.array_except(F.json_object_keys(arguments), F.array(*map(F.lit, schema.get("properties", {}))))
            checks.append(F.when(F.size(extra) > 0, F.concat(F.array_join(F.array_sort(extra), ","), F.lit(": unexpected"))))
        none = F.array().cast("array<string>")
        chosen = chosen.when(name == tool["name"], F.array_compact(F.array(*checks)) if checks else none)
    return chosen.otherwise(F.array(F.lit("name: unknown tool")))


def _up_chains(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(conv_id, call_id, parents, up, hops, ended)``: from each node along single parents up to the first one that has none or several.

    Every round doubles the way that a node has gone, so a chain of n calls takes some log2(n) rounds.  A node that is not
    ``ended`` at last is on a cycle of single parents or comes after one."""
    key = ["conv_id", "call_id"]
    degree = edges.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("parent").alias("_parent"))
    single = F.col("parents") == 1
    state = nodes.join(degree, key, "left").withColumn("parents", F.coalesce("_n", F.lit(0))).select(
        *key, "parents", F.when(single, F.col("_parent")).otherwise(F.col("call_id")).alias("up"), F.when(single, F.lit(1)).otherwise(F.lit(0)).cast("long").alias("hops"), (~single).alias("ended")
    )
    state, left = stored(state, "chains"), None
    while True:
        going = state.filter("not ended")
        now = going.count()
        # each round ends a node that is not behind a cycle, if any is left
        if not now or now == left:
            return state
        left = now
        above = state.select("conv_id", F.col("call_id").alias("up"), F.col("up").alias("_up"), F.col("hops").alias("_hops"), F.col("ended").alias("_ended"))
        moved = going.join(above, ["conv_id", "up"]).select(*key, "parents", F.col("_up").alias("up"), (F.col("hops") + F.col("_hops")).alias("hops"), F.col("_ended").alias("ended"))
        state = stored(state.filter("ended").unionByName(moved), "chains")


def levels(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """``(conv_id, call_id, level)``: 0 without a parent, else one more than the highest parent; null on and behind cycles.

    ``nodes`` has ``conv_id`` and ``call_id``, each pair once, ``edges`` also ``parent``, all of them nodes.  Chains of single parents
    are contracted first, so rounds go over nodes with several parents only: those whose parents are all placed are placed in
    each round, and a round reads and writes no more than the nodes that the round before has touched, beside the links.
    Each round is written to the shared folder."""
    key = ["conv_id", "call_id"]
    edges = stored(edges.select(*key, "parent").distinct(), "edges")
    chains = _up_chains(nodes, edges)
    placed = chains.filter("parents = 0").select("conv_id", F.col("call_id").alias("up"), F.lit(0).cast("long").alias("_base"))
    several = chains.filter("parents > 1").select(*key, "parents")
    above = chains.filter("ended").select("conv_id", F.col("call_id").alias("parent"), "up", (F.col("hops") + 1).alias("_more"))
    links = stored(edges.join(several, key, "left_semi").join(above, ["conv_id", "parent"]), "links")
    if not links.isEmpty():
        folder, number, latest = new_folder(nodes.sparkSession, "levels"), 0, placed
        pending = several.select(*key, F.lit(0).cast("long").alias("_closed"), F.lit(0).cast("long").alias("_base")).limit(0)
        while True:
            hits = links.join(latest, ["conv_id", "up"]).select(*key, F.lit(1).cast("long").alias("_closed"), (F.col("_base") + F.col("_more")).alias("_base"))
            touched = hits.unionByName(pending).groupBy(*key).agg(F.sum("_closed").alias("_closed"), F.max("_base").alias("_base"))
            ready = touched.join(several, key).withColumn("_ready", F.col("_closed") == F.col("parents")).drop("parents")
            ready.write.parquet(f"{folder}/round={number}")
            done = nodes.sparkSession.read.schema(ready.schema).parquet(f"{folder}/round={number}")
            latest = done.filter("_ready").select("conv_id", F.col("call_id").alias("up"), "_base")
            pending = done.filter("not _ready").select(*key, "_closed", "_base")
            if latest.isEmpty():
                break
            number += 1
        rounds = nodes.sparkSession.read.schema(ready.schema).parquet(*(f"{folder}/round={i}" for i in range(number + 1)))
        placed = placed.unionByName(rounds.filter("_ready").select("conv_id", F.col("call_id").alias("up"), "_base"))
    return chains.join(placed, ["conv_id", "up"], "left").select(*key, (F.col("_base") + F.col("hops")).alias("level"))


def linked(calls: DataFrame, results: DataFrame, tools: list[dict]) -> DataFrame:
    """``(conv_id, turn, kind, call_id, status, errors, step, position, json)``, one row for each call and each result.

    ``calls``: ``conv_id``, ``turn``, ``call_id``, ``name``, ``arguments`` (JSON text) and ``after``, an array of the identifiers in the
    same conversation that must come first.  ``results``: ``conv_id``, ``turn``, ``call_id``, ``content``.

    A call is ``answered`` or ``unanswered``, a result ``linked`` or an ``orphan``.  Of calls, or results, that share an identifier the one
    with the smallest turn (then the smallest JSON) counts, the others are ``duplicate``; those without conversation or identifier are
    ``unidentified``.  Errors name unknown dependencies and what a schema forbids.  ``step`` orders a conversation topologically: even for calls, odd
    for their results, null for calls in or behind a cycle, whose ``status`` is ``cycle``, and for what does not count.  ``position`` numbers the rows that
    have a step by step, turn and identifier.  JSON has sorted keys and no spaces."""
    key = ["conv_id", "call_id"]
    null = F.lit(None)
    call = calls.select(
        "conv_id", "turn", "call_id", "name", "arguments", F.coalesce("after", F.array().cast("array<string>")).alias("after"),
        argument_errors(F.col("name"), F.col("arguments"), tools).alias("errors"),
    )
    text = lambda *names: F.to_json(F.struct(*(F.col(n) for n in names)), {"ignoreNullFields": "false"})
    # arguments go in as they are when they are JSON, and as a text when not
    inner = F.when(F.try_parse_json("arguments").isNotNull(), F.to_json(F.try_parse_json("arguments"))).otherwise(F.regexp_replace(F.to_json(F.array("arguments")), r"^\[|\]$", ""))
    rest = F.expr("substring(to_json(struct(call_id, conv_id, name, turn), map('ignoreNullFields', 'false')), 2)")
    call = call.withColumn("json", F.concat(F.lit('{"after":'), F.to_json("after"), F.lit(',"arguments":'), F.coalesce(inner, F.lit("null")), F.lit(","), rest))
    result = results.select("conv_id", "turn", "call_id", text("call_id", "content", "conv_id", "turn").alias("json"))
    named = F.col("conv_id").isNotNull() & F.col("call_id").isNotNull()

    def counted(frame: DataFrame, *more: str) -> DataFrame:
        """The row that counts of each identifier; structs are reduced before the shuffle, so a repeated identifier is no hot spot."""
        own = F.min(F.struct("turn", "json", *more))
        return frame.filter(named).groupBy(*key).agg(own.alias("r"), F.count(F.lit(1)).alias("_n")).select(*key, "r.*", "_n")

    first_call = stored(counted(call, "after", "errors"), "calls")
    first_result = stored(counted(result), "results")
    wanted = first_call.select(*key, F.explode(F.array_distinct("after")).alias("parent"))
    known = first_call.select("conv_id", F.col("call_id").alias("parent"), F.lit(True).alias("_known"))
    wanted = stored(wanted.join(known, ["conv_id", "parent"], "left"), "wanted")
    unknown = wanted.filter("_known is null").groupBy(*key).agg(F.array_sort(F.collect_set(F.concat(F.lit("after: unknown "), F.col("parent")))).alias("_unknown"))
    placed = levels(first_call.select(*key), wanted.filter("_known"))
    answered = first_result.select(*key, F.lit(True).alias("_answered"))
    level = placed.withColumnRenamed("level", "_level")
    none = F.array().cast("array<string>")
    one = first_call.join(answered, key, "left").join(level, key, "left").join(unknown, key, "left").select(
        "conv_id", "turn", F.lit("call").alias("kind"), "call_id",
        F.when(F.col("_level").isNull(), "cycle").when(F.col("_answered"), "answered").otherwise("unanswered").alias("status"),
        F.concat("errors", F.coalesce("_unknown", none)).alias("errors"), (2 * F.col("_level")).alias("step"), "json",
    )
    two = first_result.join(level.withColumn("_call", F.lit(True)), key, "left").select(
        "conv_id", "turn", F.lit("result").alias("kind"), "call_id", F.when(F.col("_call"), "linked").otherwise("orphan").alias("status"),
        none.alias("errors"), (2 * F.col("_level") + 1).alias("step"), "json",
    )
    parts = [one, two]
    for frame, first, kind, errors in ((call, first_call, "call", F.col("errors")), (result, first_result, "result", none)):
        # what does not count: all rows but one of a repeated identifier, and those without one
        repeated = first.filter("_n > 1").select(*key, F.col("turn").alias("_turn"), F.col("json").alias("_json"), F.col("_n"))
        same = F.col("turn").eqNullSafe(F.col("_turn")) & (F.col("json") == F.col("_json"))
        again = frame.filter(named).join(repeated, key)
        spare = again.filter(same).groupBy(*key, "turn", "json", *(["errors"] if kind == "call" else [])).agg(F.count(F.lit(1)).alias("_k")).filter("_k > 1")
        spare = spare.withColumn("_i", F.explode(F.sequence(F.lit(2), F.col("_k").cast("int"))))
        for rows, status in ((again.filter(~same), "duplicate"), (spare, "duplicate"), (frame.filter(~named), "unidentified")):
            parts.append(rows.select("conv_id", "turn", F.lit(kind).alias("kind"), "call_id", F.lit(status).alias("status"), errors.alias("errors"), null.cast("long").alias("step"), "json"))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    every = stored(every.withColumn("errors", F.array_join("errors", "; ")), "linked")
    # a conversation may be one long chain, so its rows are numbered over ranges of steps
    order = [F.col("step").asc(), F.col("turn").asc_nulls_first(), F.col("call_id").asc()]
    ordered = running(every.filter("step is not null"), ["conv_id"], order, {"position": ("sum", F.lit(1))}, "steps")
    rest_rows = every.filter("step is null").withColumn("position", null.cast("long"))
    columns = ["conv_id", "turn", "kind", "call_id", "status", "errors", "step", "position", "json"]
    return ordered.select(*columns).unionByName(rest_rows.select(*columns))


#: Schemas of the calls that plain turns stand for.
TURN_TOOLS = [
    {"name": name, "parameters": {"type": "object", "properties": {"text": {"type": "string", "minLength": 1, "maxLength": 400}, "turn": {"type": "integer", "minimum": 0}}, "required": ["text", "turn"], "additionalProperties": False}}
    for name in ("configure", "reply")
]


def calls_of_turns(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Plain turns as calls and results: a system turn calls ``configure``, any other but an assistant's calls ``reply``; an
    assistant's turn is the result of the turn before.  Identifiers are conversation and turn.

    A call comes after the one before it: that of the turn before or, where that turn is an assistant's, the call which it
    answers, two turns before.  So a conversation whose turns alternate is one chain; where the turn needed is missing or no call, the
    dependency is an unknown one.  The first turn, and turns without conversation or number, come after nothing."""
    name = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    identified = F.col("conv_id").isNotNull() & F.col("turn").isNotNull()
    answer = F.coalesce(F.col("role") == "assistant", F.lit(False))
    arguments = F.to_json(F.struct(F.col("turn"), F.col("text")), {"ignoreNullFields": "false"})
    system = F.coalesce(F.col("role") == "system", F.lit(False))
    answers = turns.filter(answer).select("conv_id", (F.col("turn") + 1).alias("turn"), F.lit(2).alias("_back")).distinct()
    calls = turns.filter(~answer).select("conv_id", "turn", "role", "text").join(answers, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", F.when(identified, name(F.col("turn"))).alias("call_id"), F.when(system, "configure").otherwise("reply").alias("name"),
        arguments.alias("arguments"),
        F.when(identified & (F.col("turn") > 0), F.array(name(F.col("turn") - F.coalesce("_back", F.lit(1))))).otherwise(F.array().cast("array<string>")).alias("after"),
    )
    results = turns.filter(answer).select("conv_id", "turn", F.when(identified, name(F.col("turn") - 1)).alias("call_id"), F.col("text").alias("content"))
    return calls, results


ORACLE = """
WITH RECURSIVE call AS (
  SELECT c.conv_id, c.turn, c.conv_id || ':' || c.turn AS call_id, CASE WHEN c.role = 'system' THEN 'configure' ELSE 'reply' END AS name, c.text,
         CASE WHEN c.turn > 0 THEN [c.conv_id || ':' || (c.turn - CASE WHEN p.role = 'assistant' THEN 2 ELSE 1 END)] ELSE [] END AS after
  FROM conversations c LEFT JOIN conversations p ON p.conv_id = c.conv_id AND p.turn = c.turn - 1
  WHERE c.role <> 'assistant'),
result AS (SELECT conv_id, turn, conv_id || ':' || (turn - 1) AS call_id, text AS content FROM conversations WHERE role = 'assistant'),
known AS (SELECT c.*, p.call_id AS parent FROM call c LEFT JOIN call p ON p.conv_id = c.conv_id AND p.call_id = c.after[1]),
leveled AS (
  SELECT conv_id, call_id, 0::BIGINT AS level FROM known WHERE parent IS NULL
  UNION ALL
  SELECT k.conv_id, k.call_id, l.level + 1 FROM known k JOIN leveled l ON k.conv_id = l.conv_id AND k.parent = l.call_id),
placed AS (
  SELECT known.*, level, CASE WHEN len(after) > 0 AND parent IS NULL THEN 'after: unknown ' || after[1] END AS unknown
  FROM known LEFT JOIN leveled USING (conv_id, call_id)),
every AS (
  SELECT p.conv_id, p.turn, 'call' AS kind, p.call_id, CASE WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'answered' END AS status,
         concat_ws('; ', CASE WHEN length(text) < 1 THEN 'text: minLength' END, CASE WHEN length(text) > 400 THEN 'text: maxLength' END, unknown) AS errors,
         2 * level AS step,
         to_json({'after': after, 'arguments': {'text': text, 'turn': p.turn}, 'call_id': p.call_id, 'conv_id': p.conv_id, 'name': name, 'turn': p.turn})::VARCHAR AS json
  FROM placed p LEFT JOIN result r ON p.conv_id = r.conv_id AND p.call_id = r.call_id
  UNION ALL
  SELECT r.conv_id, r.turn, 'result', r.call_id, CASE WHEN p.call_id IS NULL THEN 'orphan' ELSE 'linked' END, '', 2 * level + 1,
         to_json({'call_id': r.call_id, 'content': content, 'conv_id': r.conv_id, 'turn': r.turn})::VARCHAR
  FROM result r LEFT JOIN placed p ON p.conv_id = r.conv_id AND p.call_id = r.call_id)
SELECT *, CASE WHEN step IS NOT NULL THEN row_number() OVER (PARTITION BY conv_id, step IS NULL ORDER BY step, turn, call_id) - 1 END AS position FROM every
"""
