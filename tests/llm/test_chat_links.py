import json
import random

import duckdb
import pytest
from oracle_check import compare
from pyspark.sql import functions as F

from clinspark.llm import chat_links as cl
from clinspark.llm import store
from clinspark.llm.queries import ORACLES, QUERIES

TOOLS = [{"name": "add", "parameters": {
    "type": "object", "required": ["a"], "additionalProperties": False,
    "properties": {"a": {"type": "integer", "minimum": 0, "maximum": 9}, "b": {"type": "string", "minLength": 2, "maxLength": 3, "enum": ["xy", "xyz"]}, "c": {"type": "number"}, "d": {"type": "array"}, "e": {"type": "boolean"}, "f": {"type": "object"}},
}}]
CALLS = "conv_id long, turn long, call_id string, name string, arguments string, after array<string>, kind string"
RESULTS = "conv_id long, turn long, call_id string, content string, json int"


def run(spark, calls, results=()):
    c = spark.createDataFrame([(*x, "k") for x in calls], CALLS)
    r = spark.createDataFrame([(*x, 1) for x in results], RESULTS)
    return cl.linked(c, r, TOOLS).orderBy("conv_id", "turn", "kind").collect()


WRONG = [
    ('{"a":1}', ""), ('{"a":1,"b":"xy","c":1.5,"d":[1],"e":true,"f":{}}', ""), ('{"a":1,"c":2}', ""), ("{}", "a: missing"), ('{"a":"1"}', "a: not integer"), ('{"a":null}', "a: not integer"),
    ('{"a":-1}', "a: minimum"), ('{"a":10}', "a: maximum"), ('{"a":1,"b":"x"}', "b: enum; b: minLength"), ('{"a":1,"b":"wxyz"}', "b: enum; b: maxLength"), ('{"a":1,"z":0,"y":0}', "y,z: unexpected"),
    ("[1]", "arguments: not an object"), ("{a", "arguments: not JSON"), (None, "arguments: not JSON"), ('{"a":1,"a":2}', "arguments: not JSON"), ('{"a":1,"d":3,"e":0,"f":[]}', "d: not array; e: not boolean; f: not object"),
]


def test_validation(spark):
    frame = spark.createDataFrame([(i, a) for i, (a, _) in enumerate(WRONG)], "i int, arguments string")
    found = frame.select("i", cl.argument_errors(F.lit("add"), F.col("arguments"), TOOLS).alias("e")).orderBy("i").collect()
    assert ["; ".join(r["e"]) for r in found] == [e for _, e in WRONG]
    assert frame.select(cl.argument_errors(F.lit("no"), F.lit("{}"), TOOLS)).first()[0] == ["name: unknown tool"]


def test_canonical_json(spark):
    rows = run(spark, [(1, 0, "x", "add", '{ "b" : {"z":1, "a":[ 1.50, "é\\n\\"" ]}, "a":1 }', ["q"]), (1, 1, "y", "no", "not json", [])])
    assert rows[0]["json"] == '{"after":["q"],"arguments":{"a":1,"b":{"a":[1.5,"é\\n\\""],"z":1}},"call_id":"x","conv_id":1,"name":"add","turn":0}'
    assert json.loads(rows[1]["json"])["arguments"] == "not json" and rows[1]["errors"] == "arguments: not JSON"
    assert rows[0]["errors"] == "b: not string; after: unknown q"


def test_order_links_and_cycles(spark):
    ok = '{"a":1}'
    calls = [
        (1, 5, "a", "add", ok, []), (1, 1, "b", "add", ok, ["a"]), (1, 2, "c", "add", ok, ["a", "b", "b"]), (1, 3, "d", "add", ok, ["c"]),
        (2, 1, "a", "add", ok, ["b"]), (2, 2, "b", "add", ok, ["a"]), (2, 3, "c", "add", ok, ["b"]), (2, 4, "e", "add", ok, ["e"]),
        (3, 1, "a", "add", ok, []), (3, 1, "a", "add", ok, []), (3, 0, "a", "add", ok, []), (None, 1, "a", "add", ok, []), (3, 9, None, "add", ok, []),
    ]
    results = [(1, 6, "a", "r"), (1, 7, "z", "r"), (1, 9, "a", "later"), (3, 4, "a", None), (None, None, None, None)]
    rows = run(spark, calls, results)
    assert len(rows) == len(calls) + len(results)
    one = [(r["call_id"], r["kind"], r["status"], r["step"]) for r in sorted((r for r in rows if r["conv_id"] == 1 and r["position"] is not None), key=lambda r: r["position"])]
    assert one == [("a", "call", "answered", 0), ("a", "result", "linked", 1), ("b", "call", "unanswered", 2), ("c", "call", "unanswered", 4), ("d", "call", "unanswered", 6)]
    assert {(r["call_id"], r["status"]) for r in rows if r["conv_id"] == 1 and r["position"] is None} == {("z", "orphan"), ("a", "duplicate")}
    assert {(r["status"], r["step"]) for r in rows if r["conv_id"] == 2} == {("cycle", None)}
    three = sorted((r["kind"], r["turn"], r["status"]) for r in rows if r["conv_id"] == 3)
    assert three == [("call", 0, "answered"), ("call", 1, "duplicate"), ("call", 1, "duplicate"), ("call", 9, "unidentified"), ("result", 4, "linked")]
    assert sum(r["status"] == "unidentified" for r in rows) == 3


def placed_by_hand(nodes, edges):
    """Levels by repeated passes; what is never placed is on or behind a cycle."""
    level = {}
    while True:
        new = {}
        for n in nodes:
            parents = {p for c, p in edges if c == n}
            if n not in level and parents <= level.keys():
                new[n] = 1 + max((level[p] for p in parents), default=-1)
        if not new:
            return {n: level.get(n) for n in nodes}
        level |= new


@pytest.mark.parametrize("seed", [1, 2])
def test_levels_equal_a_plain_count(spark, seed):
    """Chains, ladders, cycles of one, two and more calls and what hangs from them, over conversations that share identifiers."""
    rng = random.Random(seed)
    nodes, edges = set(), set()
    for conv in range(12):
        names = [f"c{i}" for i in range(30)]
        nodes |= {(conv, n) for n in names}
        for i in range(1, 30):
            for _ in range(rng.choice([0, 1, 1, 1, 1, 2, 3])):
                edges.add(((conv, names[i]), (conv, names[rng.randrange(max(0, i - 4), i)])))
        if conv % 3 == 0:
            edges.add(((conv, names[10]), (conv, names[rng.randrange(10, 30)])))
        if conv % 4 == 0:
            edges.add(((conv, names[20]), (conv, names[20])))
    want = placed_by_hand(nodes, edges)
    n = spark.createDataFrame(sorted(nodes), "conv_id long, call_id string")
    e = spark.createDataFrame([(*c, p[1]) for c, p in sorted(edges)], "conv_id long, call_id string, parent string")
    assert {(r["conv_id"], r["call_id"]): r["level"] for r in cl.levels(n, e).collect()} == want


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """A chain of 500 calls beside cycles of single parents, which end no round."""
    made = []
    monkeypatch.setattr(cl, "stored", lambda frame, name: made.append(name) or store.stored(frame, name))
    chain = [(1, f"n{i}") for i in range(500)]
    ring = [(2, f"n{i}") for i in range(7)]
    n = spark.createDataFrame([*chain, *ring], "conv_id long, call_id string")
    e = spark.createDataFrame([(1, f"n{i}", f"n{i - 1}") for i in range(1, 500)] + [(2, f"n{i}", f"n{(i + 1) % 7}") for i in range(7)], "conv_id long, call_id string, parent string")
    got = {(r["conv_id"], r["call_id"]): r["level"] for r in cl.levels(n, e).collect()}
    assert got == {(1, f"n{i}"): i for i in range(500)} | {(2, f"n{i}"): None for i in range(7)}
    assert made.count("chains") <= 12


def test_a_conversation_of_many_turns_is_one_chain(spark):
    turns = [(1, t, "assistant" if t % 2 else "user", f"t{t}") for t in range(60)]
    calls, results = cl.calls_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    rows = cl.linked(calls, results, cl.TURN_TOOLS).collect()
    assert sorted((r["turn"], r["step"], r["position"], r["status"]) for r in rows) == [(t, t, t, "linked" if t % 2 else "answered") for t in range(60)]


def test_empty_and_plain_turns(spark):
    assert run(spark, []) == []
    turns = [(1, 0, "system", "s"), (1, 1, "user", "u" * 100_000), (1, 2, "assistant", ""), (1, 3, "assistant", None), (1, 4, None, ""), (None, 0, "user", "x"), (2, 3, "user", "x")]
    calls, results = cl.calls_of_turns(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
    got = {(r["conv_id"], r["turn"]): (r["kind"], r["status"], r["errors"], r["step"]) for r in cl.linked(calls, results, cl.TURN_TOOLS).collect()}
    assert got == {
        (1, 0): ("call", "unanswered", "", 0), (1, 1): ("call", "answered", "text: maxLength", 2), (1, 2): ("result", "linked", "", 3), (1, 3): ("result", "orphan", "", None),
        (1, 4): ("call", "unanswered", "text: minLength; after: unknown 1:2", 0), (None, 0): ("call", "unidentified", "", None), (2, 3): ("call", "unanswered", "after: unknown 2:2", 0),
    }


def test_query_has_no_python_and_equals_its_oracle(spark):
    folder = "/root/testdata/sf0.001"
    frame = QUERIES["op2_chat_links"](spark, folder)
    assert "InPandas" not in frame._jdf.queryExecution().toString() and "InArrow" not in frame._jdf.queryExecution().toString()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    assert compare(frame.toPandas(), con.execute(ORACLES["op2_chat_links"]).df()) is None
