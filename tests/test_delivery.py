"""Batches are seen whole or not at all; retries are counted; dead letters come once."""
import pytest

from webfold.streaming import delivery as D

SCHEMA = "page_id long, url string, html string, status_code int, content_type string"
BODY = "<article><p>" + "word " * 30 + "</p></article>"


def page(k, status=200, html=BODY, ctype="text/html"):
    return (k, f"https://garden.test/p{k}", html, status, ctype)


def batch(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def urls(df):
    return sorted(r.url.rsplit("/", 1)[1] for r in df.collect())


def test_state_machine(spark):
    before = spark.createDataFrame([("a", 1, False), ("b", 2, False), ("c", 3, True), ("d", 1, False), ("e", 3, True)], D.ATTEMPTS)
    failed = spark.createDataFrame([("a", "fetch"), ("a", "fetch"), ("b", "fetch"), ("c", "fetch"), ("f", "filter"), ("g", "fetch"), (None, "normalize")], "url string, phase string")
    failed = failed.selectExpr("url", "phase", "'x' AS error", "500 AS http_status")
    got = D.next_attempts(before, failed, spark.createDataFrame([("d",), ("e",), ("z",)], "url string"))
    assert {r.url: (r.attempts, r.dead, r.was_dead) for r in got.collect()} == {
        "a": (2, False, False), "b": (3, True, False), "c": (4, True, True), "f": (1, True, False), "g": (1, False, False)}


def test_a_message_that_fails_three_times_is_dead_once(spark, tmp_path):
    out, write = str(tmp_path), D.deliver(str(tmp_path), 20)
    assert D.to_redeliver(spark, out).count() == 0
    for k in range(4):
        write(batch(spark, [page(10 + k), page(1, 503), page(2, 503 if k < 2 else 200), page(3, ctype="image/png")]), k)
        if k == 0:
            assert urls(D.to_redeliver(spark, out)) == ["p1", "p2"]
    dead = D.committed(spark, out, "dead_letters").collect()
    assert sorted((r.url[-1], r.attempts, r.phase, r.batch_id, r.job_id) for r in dead) == [("1", 3, "fetch", 2, "garden.test"), ("3", 1, "filter", 0, "garden.test")]
    assert D.to_redeliver(spark, out).count() == 0
    errors = D.committed(spark, out, "errors").filter("batch_id = 0").collect()
    assert {(r.job_id, r.phase, r.occurred_at.year) for r in errors} == {("garden.test", "fetch", 2026), ("garden.test", "filter", 2026)}


class Crash(Exception):
    pass


def test_a_replay_after_a_crash_between_two_writes(spark, tmp_path, at="dead_letters"):
    def sink(table, rows, batch_id):
        if broken and table == at and batch_id == 1:
            raise Crash
        rows.write.mode("overwrite").parquet(f"{tmp_path}/{table}/batch_id={batch_id}")
    broken, write = True, D.deliver(str(tmp_path), 20, max_attempts=2, sink=sink)
    first, second = batch(spark, [page(1), page(2, 500)]), batch(spark, [page(2, 500), page(3)])
    write(first, 0)
    with pytest.raises(Crash):
        write(second, 1)
    assert urls(D.committed(spark, str(tmp_path), "pages")) == ["p1"] and urls(D.to_redeliver(spark, str(tmp_path))) == ["p2"]
    broken = False
    for _ in range(2):  # replayed, and replayed when already committed
        write(second, 1)
    assert urls(D.committed(spark, str(tmp_path), "pages")) == urls(D.committed(spark, str(tmp_path), "page_events").selectExpr("get_json_object(event_json, '$.url') AS url")) == ["p1", "p3"]
    assert urls(D.committed(spark, str(tmp_path), "dead_letters")) == ["p2"]
    assert D.committed_batches(spark, str(tmp_path)) == [0, 1]


def test_as_the_sink_of_a_stream(spark, tmp_path):
    for k in range(2):
        batch(spark, [page(k), page(9, 500)]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    q = stream.writeStream.option("checkpointLocation", f"{tmp_path}/ck").trigger(availableNow=True).foreachBatch(D.deliver(f"{tmp_path}/out", 20, max_attempts=2)).start()
    q.awaitTermination()
    assert q.exception() is None
    assert urls(D.committed(spark, f"{tmp_path}/out", "pages")) == ["p0", "p1"]
    assert urls(D.committed(spark, f"{tmp_path}/out", "dead_letters")) == ["p9"]


def test_a_delivery_asks_for_no_python_workers_but_those_of_its_functions(spark, tmp_path, monkeypatch):
    """Rows of Python lists go through workers of their own, which live on beside the others of an executor."""
    batches = [batch(spark, [page(1), page(2, 500)]), batch(spark, [page(2, 500), page(3)])]
    out, write = str(tmp_path), D.deliver(str(tmp_path), 20, max_attempts=2)

    def refused(*args, **kwargs):
        raise AssertionError("rows from Python")
    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert D.to_redeliver(spark, out).dtypes == [("url", "string"), ("attempts", "int")] and D.to_redeliver(spark, out).count() == 0
    for k, b in enumerate(batches):
        write(b, k)
    assert D.committed_batches(spark, out) == [0, 1] and urls(D.committed(spark, out, "pages")) == ["p1", "p3"]
    assert [(r.url[-1], r.attempts, r.batch_id) for r in D.committed(spark, out, "dead_letters").collect()] == [("2", 2, 1)]
    ledger = spark.read.parquet(f"{out}/_ledger").orderBy("batch_id").collect()
    assert [r.tables.split(",")[0] for r in ledger] == ["pages", "pages"]
