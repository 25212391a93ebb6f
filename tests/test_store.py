import glob
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from scriptorium.sources.store import Store
from scriptorium.streaming import capture, ledger

NOW = datetime(2024, 1, 2)


def _rows(spark, rows):
    return spark.createDataFrame([(k, NOW - timedelta(hours=h), a) for k, h, a in rows], "key string, ts timestamp, answer string")


def _held(store):
    return {r.key: (int((NOW - r.ts).total_seconds() // 3600), r.answer) for r in store.read().collect()}


def test_upserts(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 3)
    assert store.read().count() == 0
    assert store.upsert(_rows(spark, [("a", 1, "x"), ("b", 1, None), (None, 1, "n"), ("a", 2, "older"), ("c", 1, "1"), ("c", 1, "2")]))
    assert _held(store) == {"a": (1, "x"), "b": (1, None), "c": (1, "2")}
    assert store.upsert(_rows(spark, [("a", 0, "new"), ("c", 3, "older"), ("d/..", 0, "")]), "t1")
    want = {"a": (0, "new"), "b": (1, None), "c": (1, "2"), "d/..": (0, "")}
    assert _held(store) == want
    assert not store.upsert(_rows(spark, [("a", -1, "twice")]), "t1") and _held(store) == want
    assert store.upsert(_rows(spark, []), "t2") and _held(store) == want
    store.clear()
    assert store.read().count() == 0


def test_killed_and_rival_writes_leave_the_old_state(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path / "s"), 2)
    store.upsert(_rows(spark, [("a", 1, "x")]))
    swap = Store._swap

    def killed(self, manifest):
        raise KeyboardInterrupt

    monkeypatch.setattr(Store, "_swap", killed)
    with pytest.raises(KeyboardInterrupt):
        store.upsert(_rows(spark, [("a", 0, "y"), ("b", 0, "z")]))
    assert _held(store) == {"a": (1, "x")}

    def rival(self, manifest):
        swap(self, manifest | {"parts": {}})
        swap(self, manifest)

    monkeypatch.setattr(Store, "_swap", rival)
    with pytest.raises(RuntimeError, match="another write"):
        store.upsert(_rows(spark, [("a", 0, "y")]))


def test_two_runs_and_corrupt_parts(spark, tmp_path):
    made = []

    def compute(rest):
        keys = sorted(r.key for r in rest.select("key").distinct().collect())
        made.append(keys)
        return spark.createDataFrame([(k, "of " + k) for k in keys], "key string, answer string")

    store = Store(spark, str(tmp_path / "s"), 4)
    wanted = spark.createDataFrame([("a",), ("b",), ("b",), ("e",)], "key string")
    now = F.lit(NOW)
    for hit in (False, True):
        got = store.answered(wanted, compute, now).collect()
        assert sorted((r.key, r.answer, r.hit) for r in got) == [(k, "of " + k, hit) for k in "abe"]
    assert made == [["a", "b", "e"], []]
    assert {r.hit for r in store.answered(wanted, compute, F.lit(NOW + timedelta(hours=4))).collect()} == {False}
    for path in glob.glob(str(tmp_path / "s/parts/*/*/*.parquet")):
        with open(path, "wb") as f:
            f.write(b"no parquet")
    for path in glob.glob(str(tmp_path / "s/parts/*/*/.*.crc")):
        __import__("os").remove(path)
    assert {r.hit for r in store.answered(wanted, compute, now).collect()} == {False} and _held(store).keys() == {"a", "b", "e"}


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    store = Store(spark, str(tmp_path / "s"), 2)
    folder = tmp_path / "in"
    _rows(spark, [("a", 1, "x"), ("b", 1, "y")]).write.parquet(str(folder))
    stream = spark.readStream.schema("key string, ts timestamp, answer string").parquet(str(folder))
    for checkpoint in ("c1", "c2"):  # a new checkpoint sends batch 0 again
        stream.writeStream.foreachBatch(lambda df, k: store.upsert(df, f"batch {k}") and None).option("checkpointLocation", str(tmp_path / checkpoint)).trigger(availableNow=True).start().awaitTermination()
        assert store._manifest()["version"] == 1
    assert _held(store) == {"a": (1, "x"), "b": (1, "y")}


CALLS = [("m", 10, 5, False), ("m", 7, None, None), ("m", 9, 9, True), ("lite", None, 4, False), (None, 1, 1, False), ("else", 2, 2, True)]
WANT = {("m", 3, 17, 5, 1), ("lite", 1, 0, 4, 0), ("other", 2, 1, 1, 1)}


def test_capture_of_runs(spark, tmp_path):
    calls = spark.createDataFrame(CALLS, "model string, p int, o int, failed boolean")
    kept = capture.Ledger(spark, str(tmp_path / "l"), ["m", "lite"])
    for _ in range(2):
        kept.watch(calls, "slicer", "model", "p", "o", "failed").write.format("noop").mode("overwrite").save()
    kept.watch(calls.limit(0), "none", "model", "p", "o", "failed").write.format("noop").mode("overwrite").save()
    kept.settle()
    assert {(r.model, r.calls, r.prompt_tokens, r.output_tokens, r.failures) for r in kept.rows().collect()} == WANT and kept.rows().count() == 6
    assert {(r.component, r.model, r.calls, r.prompt_tokens, r.output_tokens, r.failures) for r in kept.totals().collect()} == {("slicer", m, *(2 * x for x in rest)) for m, *rest in WANT}


def test_capture_of_streams(spark, tmp_path):
    import time

    kept = capture.Ledger(spark, str(tmp_path / "l"), ["m", "lite"])
    calls = spark.createDataFrame(CALLS * 2, "model string, p int, o int, failed boolean")
    calls.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    listener = kept.listener()
    spark.streams.addListener(listener)
    try:
        ledger.run_once(kept.watch_stream(stream, "slicer", "model", "p", "o", "failed"), str(tmp_path / "out"), str(tmp_path / "cp"))
        for _ in range(60):  # progress comes after the batch
            if (tmp_path / "l").exists() and (kept.totals().agg(F.sum("calls")).first()[0] or 0) == len(CALLS) * 2:
                break
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    assert {(r.model, r.calls, r.prompt_tokens, r.output_tokens, r.failures) for r in kept.totals().collect()} == {(m, *(2 * x for x in rest)) for m, *rest in WANT}
    kept._append(*[(r.run, r.component, {"calls_0": 1}) for r in kept.rows().where("model = 'm'").limit(1).collect()][0])
    assert kept.totals().where("model = 'm'").first().calls <= 6  # a repeated batch is one run
