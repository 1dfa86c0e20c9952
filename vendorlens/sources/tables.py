"""Readers for the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Parquet scan; projecting here lets the scan read only those columns."""
    df = spark.read.parquet(table_path(sf_dir, name))
    return df.select(*columns) if columns else df


def table_version(spark: SparkSession, sf_dir: str, name: str) -> tuple[int, int, int]:
    """(time of the last change, bytes, files) of a table: differs after it was
    written again or a file was added. Two calls, however many files it has."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(table_path(sf_dir, name))
    fs = path.getFileSystem(conf)
    held = fs.getContentSummary(path)
    return fs.getFileStatus(path).getModificationTime(), held.getLength(), held.getFileCount()
