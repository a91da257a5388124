import json
import random

from isobar.llm import tool_calls as tc

TOOLS = {"search": {"query": ("string", True), "limit": ("integer", False)},
         "sum": {"a": ("number", True), "b": ("number", True)},
         "flag": {"on": ("boolean", True)}}
KINDS = {"string": lambda x: isinstance(x, str), "boolean": lambda x: isinstance(x, bool),
         "integer": lambda x: isinstance(x, int) and not isinstance(x, bool),
         "number": lambda x: isinstance(x, (int, float)) and not isinstance(x, bool)}


def brute(calls, results):
    firsts, rs, n_calls, n_results = {}, {}, {}, {}
    for conv, turn, cid, *rest in calls:
        if None in (conv, turn, cid):
            continue
        n_calls[conv, cid] = n_calls.get((conv, cid), 0) + 1
        key = (turn, *[(x is not None, x or "") for x in rest])
        if (conv, cid) not in firsts or key < firsts[conv, cid][0]:
            firsts[conv, cid] = (key, turn, *rest)
    for conv, turn, cid, content in results:
        if None in (conv, turn, cid):
            continue
        n_results[conv, cid] = n_results.get((conv, cid), 0) + 1
        key = (turn, content is not None, content or "")
        if (conv, cid) not in rs or key < rs[conv, cid][0]:
            rs[conv, cid] = (key, turn, content)
    out = {}
    for key in {*firsts, *rs}:
        conv, cid = key
        result = rs.get(key)
        body = {}
        level, status = None, None
        if key not in firsts:
            status = "orphan"
        else:
            _, turn, name, arguments, after = firsts[key]
            seen, at = {cid}, after
            level = 1
            while at is not None and (conv, at) in firsts:
                if at in seen:
                    level = None
                    break
                seen.add(at)
                level += 1
                at = firsts[conv, at][4]
            try:
                args = json.loads(arguments) if arguments is not None else None
            except ValueError:
                args = None
            if args is not None:
                body["arguments"] = args
            body["id"], fields = cid, TOOLS.get(name)
            if name is not None:
                body["name"] = name
            if level is None:
                status = "cycle"
            elif fields is None:
                status = "unknown_tool"
            elif not isinstance(args, dict):
                status = "bad_json"
            elif any(r and f not in args for f, (_, r) in fields.items()):
                status = "missing_field"
            elif any(f not in fields for f in args):
                status = "unknown_field"
            elif any(not KINDS[fields[f][0]](x) for f, x in args.items()):
                status = "bad_type"
            elif result is None:
                status = "missing_result"
            elif result[1] <= turn:
                status = "early_result"
            else:
                status = "ok"
        body["id"] = cid
        if result is not None and result[2] is not None:
            body["result"] = result[2]
        out[key] = (level, status, n_calls.get(key, 0), n_results.get(key, 0),
                    json.dumps(body, sort_keys=True, separators=(",", ":"), ensure_ascii=False))
    return out


def got(spark, calls, results):
    c = spark.createDataFrame([(*x, 1, "z") for x in calls],
                              "conv_id long, turn long, call_id string, name string, arguments string, after string, "
                              "n int, f string")
    r = spark.createDataFrame([(*x, 2) for x in results],
                              "conv_id long, turn long, call_id string, content string, level int")
    return {(x["conv_id"], x["call_id"]): (x["level"], x["status"], x["calls"], x["results"], x["json"])
            for x in tc.link_calls(c, r, TOOLS).collect()}


ARGS = ['{"query": "é\\n", "limit": 3}', '{"limit": 3, "query": "b"}', '{"query": 5}', '{"limit": 1}', '{"a": 1, "b": 2}',
        '{"b": "2", "a": 1}', '{"on": true}', '{"on": "true"}', '{"query": "x", "more": {"z": 1, "a": [1, "2"]}}', "[1]",
        "{bad", None, "", "3", '{"query": null}']


def test_against_loop(spark):
    r = random.Random(7)
    calls, results = [], []
    for conv in range(12):
        for turn in range(r.randint(0, 14)):
            calls.append((conv, turn, f"c{turn % 9}", r.choice([*TOOLS, "other", None]), r.choice(ARGS),
                          r.choice([None, f"c{r.randrange(9)}", f"c{max(0, turn - 1)}", "gone"])))
            if r.random() < .7:
                results.append((conv, turn + r.choice([-1, 1, 1]), f"c{r.randrange(10)}", r.choice([None, "", "done"])))
    calls += [(None, 1, "c1", "flag", None, None), (1, None, "c1", "flag", None, None), (1, 1, None, "flag", None, None)]
    results += [(1, 1, None, "x"), (3, 9, "c1", "x"), (3, 9, "c1", "x")]
    assert got(spark, calls, results) == brute(calls, results)


def test_long_chain_and_hot_conversation(spark):
    n = 400
    calls = [(1, i, f"c{i}", "flag", '{"on": false}', f"c{i - 1}" if i else None) for i in range(n)]
    results = [(1, i + 1, f"c{i}", "ok") for i in range(n)]
    out = got(spark, calls, results)
    assert [out[1, f"c{i}"][0] for i in range(n)] == list(range(1, n + 1))
    assert all(x[1] == "ok" for x in out.values())


def test_empty(spark):
    assert got(spark, [], []) == {}


def test_field_names_kinds_repeated_keys_and_long_texts(spark):
    tools = {"t": {"a.b": ("string", True), "it's": ("array", False), "o p": ("object", False), "z": ("null", False)}}
    long = "x" * 200_000
    args = {1: '{"a.b": "x"}', 2: '{"a.b": 1}', 3: '{"a.b": "x", "it\'s": [1, {"k": 2}], "o p": {"q": null}, "z": null}',
            4: '{"a.b": "x", "o p": [1]}', 5: '{"a.b": "x", "a.b": "y"}', 6: '{"a": {"b": "x"}}', 7: '{"a.b": "%s"}' % long}
    calls = spark.createDataFrame([(1, 2 * i, f"c{i}", "t", a, None) for i, a in args.items()],
                                  "conv_id long, turn int, call_id string, name string, arguments string, after string")
    results = spark.createDataFrame([(1, 2 * i + 1, f"c{i}", long) for i in args], "conv_id long, turn int, call_id string, content string")
    got = {r["call_id"]: r for r in tc.link_calls(calls, results, tools).collect()}
    assert {k: r["status"] for k, r in got.items()} == {"c1": "ok", "c2": "bad_type", "c3": "ok", "c4": "bad_type", "c5": "bad_json",
                                                        "c6": "missing_field", "c7": "ok"}
    assert json.loads(got["c7"]["json"]) == {"arguments": {"a.b": long}, "id": "c7", "name": "t", "result": long}
    assert "arguments" not in json.loads(got["c5"]["json"])
