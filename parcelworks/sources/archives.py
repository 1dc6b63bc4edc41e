"""Zipped CSV archives as a data source: one task per archive, rows streamed from storage.

``spark.dataSource.register(ZippedCsv)`` makes it known to a session as ``zipped_csv``. The
reader never holds an archive or a member: it seeks in the file for the list of members,
inflates the wanted one as it goes, and hands on Arrow batches. The writer streams the Arrow
batches of each partition into one archive.
"""

from __future__ import annotations

import datetime as dt
import io
import itertools
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage
from pyspark.sql.types import StructType

from parcelworks.schemas import text_schema
from parcelworks.sources.readers import text_cells

#: Bytes of a member that are parsed at a time.
_BLOCK = 1 << 20


def _storage(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path as Spark writes it (``file:/..``, ``hdfs://..``, or plain)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


class _File(io.RawIOBase):
    """A stored file as the archive reader wants it: a place that is none is an ``OSError``."""

    def __init__(self, file: pa.NativeFile) -> None:
        self.file, self.at, self.end = file, 0, file.size()

    def readable(self) -> bool:
        return True

    def seekable(self) -> bool:
        return True

    def tell(self) -> int:
        return self.at

    def seek(self, place: int, whence: int = io.SEEK_SET) -> int:
        at = place + {io.SEEK_SET: 0, io.SEEK_CUR: self.at, io.SEEK_END: self.end}[whence]
        if at < 0:
            raise OSError(f"no such place in the file: {at}")
        self.at = at
        return at

    def readinto(self, buffer) -> int:
        got = self.file.read_at(max(0, min(len(buffer), self.end - self.at)), min(self.at, self.end))
        buffer[: len(got)] = got
        self.at += len(got)
        return len(got)


@dataclass
class _Archive(InputPartition):
    path: str


@dataclass
class _Written(WriterCommitMessage):
    path: str | None


class _Reader(DataSourceReader):
    def __init__(self, schema: StructType, paths: list[str], member: int) -> None:
        self.columns, self.paths, self.member = schema.fieldNames(), paths, member

    def partitions(self) -> list[_Archive]:
        # A source without archives still needs one (empty) partition.
        return [_Archive(p) for p in self.paths] or [_Archive("")]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        schema = pa.schema([(c, pa.string()) for c in self.columns])
        convert = pa_csv.ConvertOptions(
            include_columns=self.columns, include_missing_columns=True, column_types=schema, strings_can_be_null=False
        )
        storage, place = _storage(partition.path)
        with storage.open_input_file(place) as file, zipfile.ZipFile(io.BufferedReader(_File(file))) as archive:
            names = archive.namelist()
            if len(names) <= self.member:
                raise ValueError(f"archive without members: {partition.path}")
            with archive.open(names[self.member]) as member:
                if not member.peek(1):
                    return  # an empty member has no header and no rows
                lines = pa_csv.open_csv(
                    pa.PythonFile(member, "r"),
                    read_options=pa_csv.ReadOptions(block_size=_BLOCK, use_threads=False),
                    parse_options=pa_csv.ParseOptions(newlines_in_values=True),
                    convert_options=convert,
                )
                for part in lines:
                    yield pa.RecordBatch.from_arrays(part.columns, schema=schema)


def _cell(value: object) -> str | None:
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone().replace(tzinfo=None)
    return None if value is None else str(value)


def _cells(column: pa.Array) -> pa.Array:
    """Values as text; a null is an empty cell."""
    if not pa.types.is_string(column.type):
        column = pa.array([_cell(v) for v in column.to_pylist()], pa.string())
    return column.fill_null("")


class _Writer(DataSourceArrowWriter):
    def __init__(self, schema: StructType, folder: str, member: str) -> None:
        self.columns, self.folder, self.member = schema.fieldNames(), folder, member

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        from pyspark import TaskContext

        first = next((b for b in batches if len(b)), None)
        if first is None:
            return _Written(None)
        task = TaskContext.get()
        storage, place = _storage(self.folder)
        storage.create_dir(place)
        # Tries of one task write different files; only the one that is committed gets its name.
        path = f"{place}/_try-{task.partitionId():05d}-{task.taskAttemptId()}"
        with storage.open_output_stream(path) as file, zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED, compresslevel=1) as archive:
            schema = pa.schema([(c, pa.string()) for c in self.columns])
            with archive.open(self.member, "w", force_zip64=True) as member, pa_csv.CSVWriter(pa.PythonFile(member, "w"), schema) as out:
                for batch in itertools.chain([first], batches):
                    out.write(pa.RecordBatch.from_arrays([_cells(c) for c in batch.columns], schema=schema))
        return _Written(path)

    def commit(self, messages: list[_Written | None]) -> None:
        storage, place = _storage(self.folder)
        storage.create_dir(place)
        for number, message in enumerate(messages):
            if message is not None and message.path is not None:
                storage.move(message.path, f"{place}/part-{number:05d}.zip")

    def abort(self, messages: list[_Written | None]) -> None:
        storage, _ = _storage(self.folder)
        for message in messages:
            if message is not None and message.path is not None:
                storage.delete_file(message.path)


class ZippedCsv(DataSource):
    """Options: ``path`` (a folder to write), ``paths`` (archives to read, one a line), ``member``.

    ``member`` is the number of the member to read (0) or the name of the one to write.
    """

    @classmethod
    def name(cls) -> str:
        return "zipped_csv"

    def reader(self, schema: StructType) -> DataSourceReader:
        paths = [p for p in self.options.get("paths", "").split("\n") if p]
        return _Reader(schema, paths, int(self.options.get("member", "0")))

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _Writer(schema, self.options["path"], self.options.get("member", "export.csv"))


def archives_under(spark: SparkSession, path: str) -> list[str]:
    """The archives of a folder or pattern; Spark lists them, and their contents are not read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(path).select("path")
    return sorted(r["path"] for r in found.collect())


def read_zipped_csv(spark: SparkSession, path: str, headers: dict[str, str] | list[str], member: int = 0) -> DataFrame:
    """One member of every archive under ``path`` as text columns; blanks are null.

    Columns are matched by header; one that an archive lacks is null. An archive without
    such a member is an error. Names of archives go through the driver, contents do not.
    """
    spark.dataSource.register(ZippedCsv)
    rows = spark.read.format("zipped_csv").schema(text_schema(headers))
    return text_cells(rows.option("paths", "\n".join(archives_under(spark, path))).option("member", str(member)).load())


def write_zipped_csv(df: DataFrame, path: str) -> None:
    """Every partition with rows as one archive of one CSV, under a new folder ``path``."""
    df.sparkSession.dataSource.register(ZippedCsv)
    df.write.format("zipped_csv").mode("append").option("path", path).save()
