"""The history that is refreshed by buckets, and appends that happen once."""

import random
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks.operators.upsert import upsert_freeze_completed
from parcelworks.sources import history, sinks
from parcelworks.streaming.refresh import stream_refresh

SCHEMA = "k string, mapped_status string, v int"
OPEN, DONE = "active", "status_completed"


def _formatted(spark):
    return spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")


def _files(root):
    return {str(p.relative_to(root)) for p in Path(root).rglob("*.parquet") if "_batches" not in str(p)}


def _random_rows(r, n, v):
    return [(r.choice([None, *"abcdefghijklmnop"]), r.choice([OPEN, DONE, DONE, None]), v) for _ in range(n)]


def test_refreshes_equal_the_upsert_of_all_rows(spark, tmp_path):
    r = random.Random(4)
    root = str(tmp_path / "history")
    want = spark.createDataFrame(_random_rows(r, 30, 0), SCHEMA)
    history.start_history(want, root, "k", buckets=3)
    want = rows(want)
    for batch in range(1, 6):
        new = _random_rows(r, 8, batch)
        merged = upsert_freeze_completed(spark.createDataFrame(want, SCHEMA), spark.createDataFrame(new, SCHEMA), "k")
        want = rows(merged, "k", "mapped_status", "v")
        assert history.refresh(spark.createDataFrame(new, SCHEMA), root, "k") == batch
        assert rows(history.read_history(spark, root), "k", "mapped_status", "v") == want


def test_untouched_files_stay(spark, tmp_path):
    root = str(tmp_path / "history")
    keys = [f"k{i}" for i in range(60)]
    old = spark.createDataFrame([(k, OPEN if i % 2 else DONE, 0) for i, k in enumerate(keys)], SCHEMA)
    history.start_history(old, root, "k", buckets=8)
    before = _files(root)
    new = spark.createDataFrame([("k1", DONE, 1), ("k2", OPEN, 1)], SCHEMA)
    touched = {r[0] for r in new.select(F.pmod(F.xxhash64("k"), F.lit(8))).collect()}
    history.refresh(new, root, "k")
    after = _files(root)
    gone = before - after
    assert gone and all(any(f.startswith(f"open/bucket={b}/") for b in touched) for f in gone)
    # The shipment that was finished is new beside the old finished rows; nothing else is.
    made = after - before
    assert {f.split("/part-")[0] for f in made if f.startswith("finished")} == {
        f"finished/bucket={b}/batch=1" for b in touched if any(f.startswith(f"finished/bucket={b}/batch=1") for f in made)
    }
    got = dict((k, (s, v)) for k, s, v in rows(history.read_history(spark, root), "k", "mapped_status", "v"))
    assert got["k1"] == (DONE, 1) and got["k2"] == (DONE, 0) and len(got) == 60


def test_a_refresh_reads_touched_buckets_only(spark, tmp_path):
    root = str(tmp_path / "history")
    history.start_history(spark.createDataFrame([(f"k{i}", OPEN, 0) for i in range(40)], SCHEMA), root, "k", buckets=8)
    part = history._stored(spark, root, "open", history._state(spark, root).columns, 1).where(F.col("bucket").isin([3, 5]))
    scan = next(line for line in part._jdf.queryExecution().explainString(_formatted(spark)).splitlines() if "PartitionFilters" in line)
    assert "bucket" in scan
    read = {r[0].split("bucket=")[1][0] for r in part.select(F.input_file_name()).collect()}
    assert read == {"3", "5"}


def test_compaction_keeps_all_rows(spark, tmp_path):
    root = str(tmp_path / "history")
    history.start_history(spark.createDataFrame([(f"k{i}", OPEN, 0) for i in range(12)], SCHEMA), root, "k", buckets=2)
    for n in range(1, 4):
        history.refresh(spark.createDataFrame([(f"k{n}", DONE, n), (f"k{n + 6}", DONE, n)], SCHEMA), root, "k")
    before = rows(history.read_history(spark, root))
    folder = history.compact(spark, root)
    assert rows(history.read_history(spark, root)) == before
    assert {p.parent.name for p in Path(root, folder).rglob("*.parquet")} == {"batch=3"}
    # Refreshes go on behind it, with the batch numbers that they would have had.
    assert history.refresh(spark.createDataFrame([("k1", OPEN, 9), ("k0", DONE, 9)], SCHEMA), root, "k", batch=4) == 4
    got = dict((k, v) for k, _, v in rows(history.read_history(spark, root)))
    assert (got["k1"], got["k0"], len(got)) == (1, 9, 12)
    history.compact(spark, root)
    assert history.compact(spark, root) == "finished-4-2" and history.read_history(spark, root).count() == 12
    with pytest.raises(FileNotFoundError):
        history.compact(spark, str(tmp_path / "none"))


def test_a_bucket_may_become_empty_and_a_batch_is_repeated(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "history")
    old = [("a", OPEN, 0), ("a", DONE, 0), ("b", DONE, 0), (None, OPEN, 0)]
    history.start_history(spark.createDataFrame(old, SCHEMA), root, "k", buckets=1)
    new = spark.createDataFrame([("a", DONE, 1), ("b", OPEN, 1), (None, DONE, 1), (None, OPEN, 1)], SCHEMA)
    want = [("a", DONE, 1), ("b", DONE, 0), (None, DONE, 1), (None, OPEN, 0), (None, OPEN, 1)]

    def fail(*_):
        raise RuntimeError("lost")

    # A refresh that dies behind any of its writes leaves no trace in the next try's rows.
    for name in ("replace_partitions", "_log"):
        calls = []
        real = getattr(history, name)

        def once(*args, real=real, calls=calls):
            real(*args) if len(calls) < 2 and real is not history._log else None
            calls.append(1)
            if len(calls) == 2 or real is log:
                fail()

        log = history._log
        with monkeypatch.context() as patch:
            patch.setattr(history, name, once)
            with pytest.raises(RuntimeError, match="lost"):
                history.refresh(new, root, "k", batch=1)
    assert history.refresh(new, root, "k", batch=1) == 1
    assert rows(history.read_history(spark, root), "k", "mapped_status", "v") == sorted(want, key=repr)
    assert history.refresh(new, root, "k", batch=1) == 1
    assert history.refresh(spark.createDataFrame([("a", OPEN, 2)], SCHEMA), root, "k", batch=7) == 7
    assert rows(history.read_history(spark, root), "k", "mapped_status", "v") == sorted(want, key=repr)
    # All open rows go: the bucket of open rows is empty, and can be read.
    gone = str(tmp_path / "gone")
    history.start_history(spark.createDataFrame([("a", OPEN, 0)], SCHEMA), gone, "k", buckets=1)
    history.refresh(spark.createDataFrame([("a", DONE, 1)], SCHEMA), gone, "k")
    assert rows(history.read_history(spark, gone)) == [("a", DONE, 1)]


def test_new_columns_and_wrong_use(spark, tmp_path):
    root = str(tmp_path / "history")
    with pytest.raises(FileNotFoundError):
        history.read_history(spark, root)
    with pytest.raises(FileNotFoundError):
        history.refresh(spark.createDataFrame([], SCHEMA), root, "k")
    with pytest.raises(ValueError, match="bucket"):
        history.start_history(spark.createDataFrame([], SCHEMA + ", bucket int"), root, "k")
    history.start_history(spark.createDataFrame([], SCHEMA), root, "k", buckets=2)
    assert history.read_history(spark, root).count() == 0
    with pytest.raises(FileExistsError):
        history.start_history(spark.createDataFrame([], SCHEMA), root, "k")
    history.refresh(spark.createDataFrame([("a", DONE, 1)], SCHEMA), root, "k")
    history.refresh(spark.createDataFrame([("b", OPEN, 1, "x")], SCHEMA + ", note string"), root, "k")
    history.refresh(spark.createDataFrame([], SCHEMA), root, "k")
    assert rows(history.read_history(spark, root), "k", "note") == [("a", None), ("b", "x")]


def test_stream(spark, tmp_path):
    root, landing = str(tmp_path / "history"), str(tmp_path / "landing")
    history.start_history(spark.createDataFrame([("a", OPEN, 1), ("b", DONE, 1)], SCHEMA), root, "k", buckets=4)
    new = spark.createDataFrame([("a", OPEN, 2), ("b", OPEN, 2), ("c", OPEN, 2)], SCHEMA)
    sinks.append_rows(new.where("k <> 'c'"), landing)
    stream = spark.readStream.schema(SCHEMA).parquet(landing)

    def run():
        stream_refresh(stream, root, "k", str(tmp_path / "chk")).trigger(availableNow=True).start().awaitTermination()

    run()
    assert rows(history.read_history(spark, root), "k", "v") == [("a", 2), ("b", 1)]
    sinks.append_rows(new.where("k = 'c'"), landing)
    run()
    assert rows(history.read_history(spark, root), "k", "v") == [("a", 2), ("b", 1), ("c", 2)]


def test_appends_happen_once(spark, tmp_path):
    path = str(tmp_path / "letters")
    frame = lambda *keys: spark.createDataFrame([(k,) for k in keys], "awb string")
    sinks.append_batch(frame("a", "b"), path, 1)
    sinks.append_batch(frame("a"), path, 2)
    sinks.append_batch(frame("a"), path, 2)
    assert rows(sinks.read_batches(spark, path)) == [("a", 1), ("a", 2), ("b", 1)]
    sinks.append_batch(frame(), path, 2)
    assert rows(sinks.read_batches(spark, path)) == [("a", 1), ("b", 1)]
    with pytest.raises(ValueError, match="batch"):
        sinks.append_batch(spark.createDataFrame([(1,)], "batch int"), path, 3)
