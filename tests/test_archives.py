"""Zipped CSV archives: written, read back as a stream, never held whole."""

import resource
import datetime as dt
import zipfile

import pyarrow as pa
import pytest
from conftest import rows
from pyspark.sql import functions as F

from parcelworks.schemas import text_schema
from parcelworks.sources import archives, readers

HEADERS = {"Suborder No": "suborder_no", "Message": "message", "Price": "price"}


def _zip(path, members):
    path.parent.mkdir(exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in members.items():
            archive.writestr(name, content)


def test_read_members(spark, tmp_path):
    _zip(tmp_path / "in" / "a.zip", {"x.csv": 'Price,Suborder No,Message\n"1,5",1,"a\n""b"""\n,2, \n', "y.csv": "Price\n9\n"})
    _zip(tmp_path / "in" / "b.zip", {"x.csv": "Suborder No\n3\n", "y.csv": ""})
    (tmp_path / "in" / "notes.txt").write_text("no archive")
    got = readers.renamed(archives.read_zipped_csv(spark, str(tmp_path / "in"), HEADERS), HEADERS)
    assert got.columns == ["suborder_no", "message", "price"]
    assert rows(got) == [("1", 'a\n"b"', "1,5"), ("2", None, None), ("3", None, None)]
    assert rows(archives.read_zipped_csv(spark, str(tmp_path / "in"), ["Price"], member=1)) == [("9",)]
    # One task per archive, and only the names go through the driver.
    assert got.rdd.getNumPartitions() == 2


def test_broken_archives(spark, tmp_path):
    _zip(tmp_path / "none" / "a.zip", {})
    with pytest.raises(Exception, match="archive without members"):
        archives.read_zipped_csv(spark, str(tmp_path / "none"), HEADERS).collect()
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "a.zip").write_bytes(b"no zip")
    with pytest.raises(Exception, match="not a zip file"):
        archives.read_zipped_csv(spark, str(tmp_path / "bad"), HEADERS).collect()


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "out")
    df = spark.range(1000).select(
        F.col("id").cast("string").alias("Suborder No"), F.when(F.col("id") % 3 == 0, 'x,\n"y"é').alias("Message"), F.lit("").alias("Price")
    )
    archives.write_zipped_csv(df.repartition(3), path)
    assert len(archives.archives_under(spark, path)) == 3
    assert not [p for p in (tmp_path / "out").iterdir() if p.name.startswith("_try")]
    want = [(str(i), 'x,\n"y"é' if i % 3 == 0 else None, None) for i in range(1000)]
    assert rows(archives.read_zipped_csv(spark, path, HEADERS)) == sorted(want, key=repr)
    archives.write_zipped_csv(df.limit(0), str(tmp_path / "nothing"))
    assert archives.read_zipped_csv(spark, str(tmp_path / "nothing"), HEADERS).count() == 0


def test_a_large_archive_is_streamed(tmp_path):
    """300 MB of rows go through one reader in small batches, within a fraction of their size."""
    path = tmp_path / "large.zip"
    line = ("7," + "x" * 990 + ",1\n").encode()
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive, archive.open("x.csv", "w", force_zip64=True) as member:
        member.write(b"Suborder No,Message,Price\n")
        for _ in range(300):
            member.write(line * 1000)
    reader = archives._Reader(text_schema(HEADERS), [], 0)
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    count, most = 0, 0
    for batch in reader.read(archives._Archive(f"file:{path}")):
        count += len(batch)
        most = max(most, batch.nbytes)
    assert count == 300_000 and most < 4 * archives._BLOCK
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 100_000  # KB
    assert pa.total_allocated_bytes() < 64 << 20


def test_sheets_without_spanning_cells_are_split(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    path.write_text("Suborder No,Message,Price\n" + "".join(f'{i},"a, b",{i}\n' for i in range(60_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        whole = readers.read_text_table(spark, str(path), HEADERS)
        split = readers.read_text_table(spark, str(path), HEADERS, spans_lines=False)
        assert whole.rdd.getNumPartitions() == 1 and split.rdd.getNumPartitions() > 3
        assert rows(split) == rows(whole) and split.count() == 60_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_archives_are_written_from_arrow_batches(spark, tmp_path):
    from pyspark.sql.datasource import DataSourceArrowWriter

    assert issubclass(archives._Writer, DataSourceArrowWriter)
    day = dt.datetime(2024, 5, 1, 10, 30)
    table = [("a,b", 1, 2.5, True, day, day.date()), (None, None, None, None, None, None), ('x "y"\nz', -3, 0.1, False, day, day.date())]
    path = str(tmp_path / "out")
    kinds = "s string, n long, v double, b boolean, t timestamp, d date"
    archives.write_zipped_csv(spark.createDataFrame(table, kinds), path)
    got = rows(archives.read_zipped_csv(spark, path, ["s", "n", "v", "b", "t", "d"]))
    assert got == sorted([tuple(None if v is None else str(v) for v in row) for row in table], key=repr)
    # A row of one empty cell is no empty line.
    archives.write_zipped_csv(spark.createDataFrame([("a",), (None,)], "s string").coalesce(1), str(tmp_path / "one"))
    assert rows(archives.read_zipped_csv(spark, str(tmp_path / "one"), ["s"])) == sorted([("a",), (None,)], key=repr)
