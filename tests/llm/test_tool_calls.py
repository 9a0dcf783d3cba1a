import json

from pyspark.sql import functions as F

from webfold.llm.tool_calls import link_calls

SCHEMAS = {"add": {"a": ("integer", True, 100), "b": ("integer", False, None)}, "say": {"text": ("string", True, None), "loud": ("boolean", False, None)}}


def call(id, name="say", arguments='{"text":"x"}', after=None):
    return {"id": id, "name": name, "arguments": arguments, "after": after}


def calls(*items):
    return json.dumps({"tool_calls": list(items)})


def result(id, content):
    return json.dumps({"tool_call_id": id, "content": content})


ROWS = [
    (1, 0, "user", "plain words"), (1, 1, "assistant", calls(call("c1", "add", '{"b": 2, "a": 1}'), call("c2", after="c1"))),
    (1, 2, "tool", result("c1", "3")), (1, 3, "tool", result("c2", "ünï \"q\"")), (1, 4, "tool", result("c2", "second answer")),
    (1, 5, "assistant", calls(call("c3", "add", '{"a": 101}', "c2"), call("c1", "add", '{"a":"1"}'), call("c4", "none", "{}", "zzz"))),
    (1, 6, "tool", result("c9", "for nobody")), (1, 7, "assistant", calls(call(None), call("c5", "say", "[1]"), call("c6", "say", "{broken"), call("c7", "say", None))),
    (1, 8, "tool", json.dumps({"content": "no id"})), (1, 9, "assistant", calls(call("x", after="y"), call("y", after="x"), call("z", after="x"))),
    (2, 0, "assistant", calls(call("c1", "say", '{"loud":"yes","text":null}'))), (2, 1, "user", None), (2, 2, "user", ""), (2, 3, "user", "{not json"),
    (None, 0, "assistant", calls(call("c1"))), (3, 0, "assistant", calls(call("c1"))), (3, 0, "assistant", calls(call("c1"))),
] + [(4, k, "assistant", calls(call(f"k{k}", after=f"k{k - 1}"))) for k in range(300)]


def test_links_order_errors_and_json(spark):
    df = spark.createDataFrame(ROWS, "conv_id bigint, turn bigint, role string, text string").withColumn("level", F.lit(1)).withColumn("json", F.lit("")).repartition(3)
    got = [r.asDict() for r in link_calls(df, SCHEMAS).collect()]
    by = {}
    for r in got:
        by.setdefault((r["conv_id"], r["turn"], r["call_id"]), []).append(r)
        assert json.dumps(json.loads(r["json"]), sort_keys=True, separators=(",", ":"), ensure_ascii=False) == r["json"]
    one = lambda *k: by[k][0]
    what = lambda *k: (one(*k)["status"], one(*k)["level"], one(*k)["n_errors"])
    assert what(1, 1, "c1") == ("linked", 0, 0) and what(1, 1, "c2") == ("linked", 1, 0) and what(1, 5, "c3") == ("unanswered", 2, 1)
    assert what(1, 5, "c1")[0] == "repeated" and what(1, 5, "c4") == ("unanswered", 0, 1)
    assert what(1, 6, "c9") == ("orphan", None, 0) and what(1, 8, None)[0] == "orphan" and what(1, 7, None)[0] == "unanswered"
    assert what(1, 7, "c5")[2] == what(1, 7, "c6")[2] == what(1, 7, "c7")[2] == 1
    assert {what(1, 9, c)[0] for c in "xyz"} == {"cycle"}
    assert json.loads(one(2, 0, "c1")["json"])["errors"] == ["loud is no boolean", "text is missing"]
    assert json.loads(one(1, 5, "c3")["json"])["errors"] == ["a is over 100"]
    assert json.loads(one(1, 5, "c1")["json"])["errors"] == ["a is no integer"]
    assert one(1, 1, "c1")["json"].startswith('{"arguments":{"a":1,"b":2},"call_id":"c1","content":"3","conv_id":1,"errors":[],"level":0,"name":"add"')
    assert json.loads(one(1, 1, "c2")["json"])["content"] == 'ünï "q"'
    assert [one(4, k, f"k{k}")["level"] for k in range(300)] == list(range(300))
    assert what(None, 0, "c1") == ("unanswered", None, 1 - 1)
    assert len(got) == 12 + 2 + 1 + 1 + 1 + 300


def test_empty_table_and_native_plan(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    got = link_calls(df, SCHEMAS)
    assert got.count() == 0
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
