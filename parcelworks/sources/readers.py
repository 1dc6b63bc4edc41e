"""Readers: CSV exports, text tables, zipped CSV, documents, month tables."""

from __future__ import annotations

import zipfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.csv as pa_csv
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelworks.functions.text import blank_to_null
from parcelworks.schemas import SALES_HEADERS, SALES_TIMES, text_schema


def read_csv(spark: SparkSession, path: str, schema: T.StructType, spans_lines: bool = True) -> DataFrame:
    """CSV with a header and a given schema.

    Columns are matched by header, whatever their order in the file. Where quoted cells
    may span lines, a file is read by one task; ``spans_lines=False`` says that none does, and
    large files are split.
    """
    return (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("multiLine", spans_lines)
        .option("escape", '"')
        .csv(path)
    )


def renamed(df: DataFrame, headers: dict[str, str]) -> DataFrame:
    """Headers to column names, for those present."""
    return df.withColumnsRenamed({h: n for h, n in headers.items() if h in df.columns})


def text_cells(df: DataFrame) -> DataFrame:
    """Blank text cells as null."""
    return df.withColumns(
        {
            f.name: blank_to_null(F.col(f"`{f.name}`"))
            for f in df.schema.fields
            if f.dataType == T.StringType()
        }
    )


def read_text_table(
    spark: SparkSession, path: str, headers: dict[str, str], spans_lines: bool = True
) -> DataFrame:
    """A sheet saved as CSV: every cell is text, blanks are null, columns get their names."""
    return renamed(text_cells(read_csv(spark, path, text_schema(headers), spans_lines)), headers)


def typed_sales(df: DataFrame) -> DataFrame:
    """Text cells of the sales export with its column names and types."""
    sales = renamed(df, SALES_HEADERS)
    return sales.withColumns(
        {
            **{c: F.col(c).try_cast("timestamp_ntz") for c in SALES_TIMES},
            "suborder_quantity": F.col("suborder_quantity").try_cast("int"),
        }
    )


def read_sales_csv(spark: SparkSession, path: str) -> DataFrame:
    """The sales export; prices stay text because the export mixes in other marks."""
    return typed_sales(text_cells(read_csv(spark, path, text_schema(SALES_HEADERS))))


def _first_member(columns: list[str]):
    """The first member of each archive, read as a stream of batches of text columns."""
    schema = pa.schema([(c, pa.string()) for c in columns])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        convert = pa_csv.ConvertOptions(
            include_columns=columns, include_missing_columns=True, column_types=schema, strings_can_be_null=False
        )
        for batch in batches:
            for path, content in zip(batch.column("path"), batch.column("content"), strict=True):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    names = archive.namelist()
                    if not names:
                        raise ValueError(f"archive without members: {path}")
                    with archive.open(names[0]) as member:
                        lines = pa_csv.open_csv(
                            pa.PythonFile(member, "r"),
                            parse_options=pa_csv.ParseOptions(newlines_in_values=True),
                            convert_options=convert,
                        )
                        for part in lines:
                            yield pa.RecordBatch.from_arrays(part.columns, schema=schema)

    return rows


def unpack_csv(archives: DataFrame, headers: dict[str, str] | list[str]) -> DataFrame:
    """The first member of each archive (``path``, ``content``) as text columns.

    An archive without members is an error. Each is unpacked in one task, as a stream of
    Arrow batches; its compressed bytes are one cell.
    """
    files = archives.select("path", "content")
    return text_cells(files.mapInArrow(_first_member(list(headers)), text_schema(headers)))


def read_zipped_csv(spark: SparkSession, path: str, headers: dict[str, str]) -> DataFrame:
    return unpack_csv(spark.read.format("binaryFile").load(path), headers)


def read_zipped_sales(spark: SparkSession, path: str) -> DataFrame:
    return typed_sales(read_zipped_csv(spark, path, SALES_HEADERS))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed tracking answers, one JSON line per answer: ``{"awb": .., "body": ".."}``."""
    return spark.read.schema("awb string, body string").json(path)


def read_months(spark: SparkSession, path: str, months: list[str]) -> DataFrame:
    """Months of a flow partitioned by ``order_month``; other partitions are not listed."""
    return spark.read.parquet(path).where(F.col("order_month").isin(*months))
