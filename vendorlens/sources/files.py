"""File readers and writers: CSV (raw and typed), Parquet, JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import shared_path

RAW_ENCODING = "ISO-8859-1"
# Column that says why a row was set aside (null: it was not).
REASON = "reject_reason"


def scan_raw_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
                 encoding: str = RAW_ENCODING) -> DataFrame:
    """Raw order-item file: header row, Latin-1. With a schema the columns
    are bound by position; without one, types are inferred (a sampling pass,
    avoid on large inputs)."""
    r = spark.read.option("header", True).option("encoding", encoding).option("multiLine", False)
    if schema is not None:
        r = r.schema(schema).option("enforceSchema", True)
    else:
        r = r.option("inferSchema", True)
    return r.option("escape", '"').csv(path)


def scan_clean_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Re-scan a cleaned table written with a header (UTF-8, BOM tolerated)."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("escape", '"').csv(path)


def scan_with_rejects(spark: SparkSession, path: str, schema: T.StructType, encoding: str = RAW_ENCODING) -> DataFrame:
    """Like ``scan_raw_csv`` with a schema, but a record that does not fit it
    (a value of another type, too few or too many fields) is kept as text in
    ``reject_reason`` instead of becoming nulls."""
    wide = T.StructType([*schema.fields, T.StructField(REASON, T.StringType())])
    raw = (spark.read.schema(wide).option("header", True).option("enforceSchema", True).option("encoding", encoding)
           .option("escape", '"').option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", REASON).csv(path))
    return raw.withColumn(REASON, F.concat(F.lit("malformed record: "), F.col(REASON)))


def set_aside(df: DataFrame, reason: str = REASON) -> tuple[DataFrame, DataFrame]:
    """(good, rejected) rows of a frame with a reason column, written in one
    pass over the frame (one table in the shared folder). The reason tells them
    apart: two folders would have every task sort its rows by folder first."""
    spark = df.sparkSession
    path = shared_path(spark, "quarantine")
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.where(F.col(reason).isNull()).drop(reason), back.where(F.col(reason).isNotNull())


def load_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bulk load into declared types, by position: ',' separator, '"' quote
    (doubled inside a value), one header row skipped (its names are ignored), a
    byte order mark and CRLF tolerated. A file whose header has another number
    of columns than the table fails at once, a value of another type when it is
    read."""
    options = {"sep": ",", "quote": '"', "escape": '"', "header": True}
    width = len(spark.read.options(**options).csv(path).columns)
    if width != len(schema.fields):
        raise ValueError(f"{path}: {width} columns, the table has {len(schema.fields)}")
    return spark.read.schema(schema).options(**options).option("enforceSchema", True).option("mode", "FAILFAST").csv(path)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8", line_end: str = "\n") -> str:
    """Header row, no index; one file per partition (no single-writer
    bottleneck). A quote inside a value is doubled."""
    df.write.mode("overwrite").options(header=True, encoding=encoding, escape='"', lineSep=line_end).csv(path)
    return path


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> str:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return path


def write_report_json(report: DataFrame, path: str) -> str:
    """Persist a one-row report as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_report_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)
