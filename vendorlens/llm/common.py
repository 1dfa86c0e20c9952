"""Shared helpers of the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.plans.sizing import ensure_parallelism, skew_split_join
from vendorlens.session import shared_path

# Largest side that is ever broadcast: its bytes are measured first, and
# beyond the limit the same rows take a shuffle join, in which a key with more
# than HOT_ROWS rows goes to several tasks.
BROADCAST_BYTES = 48 << 20
HOT_ROWS = 200_000

SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read(spark: SparkSession, sf_dir: str, table: str, *columns: str) -> DataFrame:
    """Columns of one table, spread over the cores when it is one small file."""
    with_workers(spark)
    return ensure_parallelism(spark.read.parquet(f"{sf_dir}/{table}.parquet").select(*columns))


def with_workers(spark: SparkSession) -> None:
    """Let Python workers started by this session import this package from
    the place the driver runs it from (on a cluster it is installed, or
    shipped with --py-files, like any other package)."""
    env, root = spark.sparkContext.environment, os.path.dirname(os.path.dirname(os.path.dirname(__file__)))
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def stored(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, and
    gives the planner the table's measured size."""
    spark = df.sparkSession
    path = shared_path(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table made by ``stored`` that no later step reads."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for file in df.inputFiles():
        path = jvm.org.apache.hadoop.fs.Path(file)
        path.getFileSystem(conf).delete(path, False)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, everything else unchanged. ``lower`` maps more; where the
    text has only ASCII letters it is the same and much faster."""
    plain = ~col.rlike(r"[^\x00-\x7F]")
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, LOWER))


def words(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def join_measured(big: DataFrame, small: DataFrame, on: list[str], how: str, width: Column | int) -> DataFrame:
    """Join ``big`` with a stored table: broadcast when its measured size is
    within BROADCAST_BYTES, else a shuffle join with hot keys dealt out.
    ``width`` is the bytes of one row. ``on`` columns are not null on the small
    side."""
    size = small.agg(F.sum(width if isinstance(width, Column) else F.lit(width))).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return big.join(F.broadcast(small), on, how)
    return skew_split_join(big, small, on, how, hot_rows=HOT_ROWS)


def spare_name(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (names are
    compared as Spark does, without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
