"""Staged tables."""

import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelworks.session import BROADCAST_ROWS, TASK_ROWS, drop_staged, in_few_tasks, shared_folder, stage_bucketed, stage_table, to_all
from tests.conftest import rows


def _shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.size())]
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("stage", [lambda df: stage_table(df, "sums"), lambda df: stage_bucketed(df, "sums", "k", 3)])
def test_a_staged_table_leaves_no_shuffle_files(spark, stage):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = _shuffle_files(spark), spark.conf.get(setting)
    sums = spark.range(100, numPartitions=4).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))
    staged = stage(sums)
    until = time.time() + 10
    while _shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.1)
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(setting) == was
    assert rows(staged, "k", "n") == sorted(((k, sum(range(k, 100, 7))) for k in range(7)), key=repr)


@pytest.mark.parametrize(("most", "tasks"), [(0, 1), (1, 1), (TASK_ROWS, 1), (TASK_ROWS + 1, 2), (9 * TASK_ROWS, 8), (None, 8)])
def test_tasks_follow_the_rows(spark, most, tasks):
    assert in_few_tasks(spark.range(80, numPartitions=8), most).rdd.getNumPartitions() == tasks


def test_only_a_few_rows_go_to_every_task(spark):
    other = spark.range(30).groupBy((F.col("id") % 5).alias("id")).agg(F.count("*").alias("n"))
    for most, sent in ((5, True), (BROADCAST_ROWS + 1, False)):
        side = to_all(other, most)
        assert ("ResolvedHint" in side._jdf.queryExecution().analyzed().toString()) == sent
        assert rows(spark.range(10).join(side, "id")) == [(i, 6) for i in range(5)]


def test_superseded_tables_leave_the_disk_and_others_stay(spark, tmp_path):
    first, second = (stage_table(spark.range(9), label, "zstd") for label in ("one", "two"))
    third = stage_table(first.where("id > 5"), "three")
    files = [{Path(f.removeprefix("file:")) for f in df.inputFiles()} for df in (first, second, third)]
    assert all(".zstd." in f.name for f in files[0])
    drop_staged(first, second)
    assert not any(f.parent.exists() for f in files[0] | files[1]) and all(f.exists() for f in files[2])
    assert rows(third) == [(6,), (7,), (8,)] and Path(shared_folder(spark)).exists()
    spark.range(3).write.parquet(f"{tmp_path}/given")
    with pytest.raises(ValueError, match="not a staged table"):
        drop_staged(spark.read.parquet(f"{tmp_path}/given"))
    assert spark.read.parquet(f"{tmp_path}/given").count() == 3


@pytest.mark.parametrize("folder", ["a b%/c", "./a b", "file:{}/d/"])
def test_staged_tables_are_found_under_any_name_of_the_folder(spark, monkeypatch, tmp_path, folder):
    here = folder.format(tmp_path).rstrip("/") if folder.startswith("file") else f"{tmp_path}/{folder}"
    monkeypatch.setattr("parcelworks.session.shared_folder", lambda _: here)
    kept, gone = stage_table(spark.range(3), "kept"), stage_table(spark.range(3), "gone")
    drop_staged(gone)
    left = [p.name for p in Path(here.removeprefix("file:")).iterdir()]
    assert len(left) == 1 and left[0].startswith("kept-") and kept.count() == 3
