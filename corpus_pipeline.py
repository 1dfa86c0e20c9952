"""The training-data pipeline: documents to packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame, and all but the last return the columns of
``documents``. ``run`` applies them in order, each stage's result written to
the shared folder and read again by the next.

Defined cases: every stage takes empty tables, null and empty texts, null and
repeated ids and further columns, as its operator says; ``n_chars`` follows
the text wherever a stage changes it, if the column is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vendorlens.llm import lines, mixing, packing, quality, simhash
from vendorlens.llm.common import stored


def _recount(docs: DataFrame) -> DataFrame:
    """Keep n_chars the length of the text."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast(kind)).select(*docs.columns)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that their own rules and their host's rate keep."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that an earlier line nearly equals."""
    return _recount(lines.dedup(docs).select(*docs.columns))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them, in training order."""
    return _recount(mixing.mix(docs))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 2048 tokens."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("pack_sequences", pack_sequences),
]

# The last stage's token ids come from a tokenizer, which SQL has not.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
