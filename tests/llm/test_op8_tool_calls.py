import json

from conftest import SF_SMALL
from strivelake.llm import tool_calls as t
from strivelake.llm.queries import op8_tool_calls

TYPES = {str: "string", bool: "boolean", int: "integer", float: "number", type(None): "null", list: "array", dict: "object"}


def plain(calls, results):
    """{(conv, id, kind): (level, status, errors)}"""
    schema = {}
    for tool, param, kind, need in t.SCHEMAS:
        schema.setdefault(tool, {})[param] = (kind, need)
    out = {}

    def depth(conv, call):
        seen, d = set(), 0
        while True:
            if call in seen:
                return None
            seen.add(call)
            parent = calls[conv, call][1]
            if parent is None or (conv, parent) not in calls:
                return d
            call, d = parent, d + 1

    for (conv, call), (name, parent, arguments) in calls.items():
        errors, d = set(), depth(conv, call)
        if parent is not None and (conv, parent) not in calls:
            errors.add("unknown parent")
        if d is None:
            errors.add("cycle")
        try:
            args = json.loads(arguments or "")
        except ValueError:
            args = None
        if not isinstance(args, dict):
            errors.add("arguments")
        elif name in schema:
            for k, v in args.items():
                kind = TYPES[type(v)]
                if k not in schema[name]:
                    errors.add(f"unexpected {k}")
                elif kind != schema[name][k][0] and not (schema[name][k][0] == "number" and kind == "integer"):
                    errors.add(f"type of {k}")
            errors |= {f"missing {k}" for k, (_, need) in schema[name].items() if need and k not in args}
        if name not in schema:
            errors.add("unknown tool")
        status = "linked" if (conv, call) in results else "unanswered"
        out[conv, call, "call"] = (None if d is None else 2 * d, status, errors)
        if status == "linked":
            out[conv, call, "result"] = (None if d is None else 2 * d + 1, status, errors)
    for key in results:
        if key not in calls:
            out[(*key, "result")] = (1, "orphan", set())
    return out


def found(df):
    return {(r.conv_id, r.call_id, r.kind): (r.level, r.status, set(r.errors)) for r in df.collect()}


def test_query_matches_brute_force(spark):
    calls, results = t.calls_of_turns(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    want = plain({(r.conv_id, r.call_id): (r.name, r.parent_id, r.arguments) for r in calls.collect()},
                 {(r.conv_id, r.call_id): r.content for r in results.collect()})
    got = op8_tool_calls(spark, SF_SMALL)
    assert found(got.filter("kind <> 'message'")) == want and len(want) > 20
    place = {(r.conv_id, r.call_id, r.kind): r.place for r in got.collect()}
    for (conv, call, kind), at in place.items():
        if kind == "result" and (conv, call, "call") in place:
            assert place[conv, call, "call"] < at
    parents = {(r.conv_id, r.call_id): r.parent_id for r in calls.collect()}
    for (conv, call), parent in parents.items():
        if parent is not None and (conv, parent) in parents:
            assert place[conv, parent, "result"] < place[conv, call, "call"] if (conv, parent, "result") in place \
                else place[conv, parent, "call"] < place[conv, call, "call"]


def test_edges(spark):
    rows = [(1, 0, "a", "c", "search", '{"query":"x","limit":1}'), (1, 1, "b", "a", "search", "nope"),
            (1, 2, "c", "b", "zzz", '{"b":{"z":1,"a":[1, 2.50]},"a":null}'), (1, 3, "d", None, "rank", "{}"),
            (1, 4, "e", "d", "rank", "[1]"), (1, 5, "f", "nix", "rank", None), (1, 6, "g", "e", "lookup", '{"query":3,"limit":1.5}'),
            (2, 0, "d", "d", "rank", ""), (3, 0, "u", None, None, '{"k":"é"}')]
    rows += [(9, k, f"n{k}", f"n{k - 1}" if k else None, "rank", "{}") for k in range(40)]
    schema = "conv_id long, turn long, call_id string, parent_id string, name string, arguments string, level int"
    calls = spark.createDataFrame([(*r, 5) for r in rows + rows[:2] + [(None, 1, "x", None, "rank", "{}"), (1, 1, None, None, "rank", "{}")]], schema)
    results = spark.createDataFrame([(1, 9, "g", "ok"), (1, 9, "zz", None), (1, 10, "g", "ok"), (None, 1, "q", "")],
                                    "conv_id long, turn long, call_id string, content string")
    want = plain({(r[0], r[2]): (r[4], r[3], r[5]) for r in rows}, {(1, "g"): "ok", (1, "zz"): None})
    df = t.link_calls(calls, results, t.schema_table(spark))
    assert found(df) == want and want[9, "n39", "call"][0] == 78
    lines = {(r.conv_id, r.call_id, r.kind): r.json for r in df.collect()}
    assert lines[1, "c", "call"] == ('{"arguments":"{\\"a\\":null,\\"b\\":{\\"a\\":[1,2.5],\\"z\\":1}}","id":"c",'
                                     '"name":"zzz","parent":"b","type":"call"}')
    for text in lines.values():
        assert json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == text
    assert t.link_calls(calls.limit(0), results.limit(0), t.schema_table(spark)).count() == 0
    assert {v[1] for v in found(t.link_calls(calls.limit(0), results, t.schema_table(spark))).values()} == {"orphan"}


def test_every_turn_is_an_event(spark):
    turns = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    got = op8_tool_calls(spark, SF_SMALL)
    said = sorted((r.conv_id, r.turn, *(json.loads(r.json).get(k) for k in ("role", "content")))
                  for r in got.filter("kind = 'message'").collect())
    assert said == sorted((r.conv_id, r.turn, r.role, r.text) for r in turns.collect())
    places = [(r.conv_id, r.place) for r in got.select("conv_id", "place").collect()]
    assert len(set(places)) == len(places) > turns.count()      # a total order in every conversation
    odd = spark.createDataFrame([(1, 0, None, "a"), (None, 1, "narrator", None)],
                                "conv_id long, turn long, role string, text string")
    kept = t.chat_events(odd, t.schema_table(spark)).collect()
    assert sorted(r.json for r in kept) == ['{"content":"a","type":"message"}', '{"role":"narrator","type":"message"}']
    assert [r.errors for r in kept] == [["role"], ["role"]]


def test_repeated_identifiers_are_marked(spark):
    calls = spark.createDataFrame([(1, 0, "a", None, "rank", "{}"), (1, 3, "a", None, "rank", '{"extra":"x"}'),
                                   (1, 4, "a", None, "rank", "{}")],
                                  "conv_id long, turn long, call_id string, parent_id string, name string, arguments string")
    results = spark.createDataFrame([(1, 1, "a", "one"), (1, 2, "a", "two")],
                                    "conv_id long, turn long, call_id string, content string")
    got = {(r.kind, r.turn): r.status for r in t.link_calls(calls, results, t.schema_table(spark)).collect()}
    assert got == {("call", 0): "linked", ("result", 1): "linked", ("call", 3): "duplicate", ("result", 2): "duplicate"}
