"""Cleaning: name normalisation, null handling, validation counters, PII
removal, timestamp parsing and the lead-time range filter."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.quantiles import exact_quantiles_many
from ..plans.sizing import join_small
from ..sources.files import REASON

# Columns removed before analysis (fixed values: personal data and a
# non-analytical image link).
PII_COLUMNS = [
    "customer_fname",
    "customer_lname",
    "customer_email",
    "customer_password",
    "customer_street",
    "product_image",
]

SPARSE_THRESHOLD = 0.5
LEAD_TIME_MIN = 0
LEAD_TIME_MAX = 90

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)


def normalise_name(name: str) -> str:
    """lower -> trim -> space to underscore -> drop [^a-z0-9_]."""
    s = name.lower().strip().replace(" ", "_")
    return re.sub(r"[^a-z0-9_]", "", s)


def normalise_columns(df: DataFrame) -> DataFrame:
    """Rename every column; metadata only, no job."""
    return df.toDF(*[normalise_name(c) for c in df.columns])


def null_counts(df: DataFrame) -> DataFrame:
    """One row: total rows and a null count per column, in one pass."""
    return df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns],
    )


def null_fractions(df: DataFrame) -> dict:
    row = null_counts(df).first().asDict()
    n = row.pop("__rows")
    return {c: (row[c] / n if n else 0.0) for c in df.columns}, {c: row[c] for c in df.columns}


def drop_sparse_columns(df: DataFrame, threshold: float = SPARSE_THRESHOLD, fractions: dict | None = None) -> DataFrame:
    """Keep columns whose null fraction is strictly below ``threshold``
    (exactly 50% null is dropped)."""
    if fractions is None:
        fractions, _ = null_fractions(df)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if fractions[c] < threshold])


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC)]


def medians(df: DataFrame, columns: list[str]) -> dict:
    """Exact median per column (nulls ignored)."""
    q = exact_quantiles_many(df, {c: [0.5] for c in columns})
    return {c: q[c][0] for c in columns}


def impute_median(df: DataFrame, counts: dict | None = None) -> DataFrame:
    """Fill nulls of numeric columns with that column's exact median. Only
    columns that hold a null are measured. Integral columns that need a
    fill become double, as a fractional median would not fit them."""
    nums = numeric_columns(df)
    if counts is None:
        _, counts = null_fractions(df.select(*[F.col(f"`{c}`") for c in nums]))
    todo = [c for c in nums if counts.get(c, 0) > 0]
    if not todo:
        return df
    med = medians(df, todo)
    types = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for c in df.columns:
        if c in med and med[c] is not None:
            base = F.col(f"`{c}`")
            if isinstance(types[c], INTEGRAL):
                base = base.cast("double")
                fill = F.lit(float(med[c]))
            elif isinstance(types[c], T.DecimalType):
                fill = F.lit(med[c]).cast(types[c])
            else:
                fill = F.lit(float(med[c])).cast(types[c])
            out.append(F.coalesce(base, fill).alias(c))
        else:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def drop_null_rows(df: DataFrame) -> DataFrame:
    return df.na.drop(how="any")


def validation_report(
    df: DataFrame,
    spend_col: str = "sales_per_customer",
    days_col: str = "days_for_shipping_real",
    key_col: str = "order_item_id",
    rejected: DataFrame | None = None,
) -> DataFrame:
    """One row: negative spend rows, shipping-day outliers (< 0 or > 90),
    and rows whose key repeats an earlier key (null counts as a key); with
    ``rejected`` rows (set aside while reading or parsing), how many they are.

    One shuffle: rows are grouped by key with partial aggregation on the map
    side, so a hot key costs one row per task, not a third of the data in
    one task."""
    per_key = df.groupBy(key_col).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col(spend_col) < 0).alias("neg"),
        F.count_if((F.col(days_col) < LEAD_TIME_MIN) | (F.col(days_col) > LEAD_TIME_MAX)).alias("out"),
    )
    counted = [] if rejected is None else [rejected.agg(F.count(F.lit(1))).scalar().alias("rejected_rows")]
    report = per_key.agg(
        F.coalesce(F.sum("neg"), F.lit(0)).cast("long").alias("negative_spend"),
        F.coalesce(F.sum("out"), F.lit(0)).cast("long").alias("lead_time_outliers"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("duplicate_orders"),
    )
    return report.select("*", *counted)


def drop_pii(df: DataFrame, columns: list[str] = PII_COLUMNS) -> DataFrame:
    """Drop the named columns that are present (absent ones are ignored)."""
    return df.drop(*[c for c in columns if c in df.columns])


# Texts that differ in case or accents only are one key, as in a database whose
# default collation ignores both.
COLLATION = "UNICODE_CI_AI"


def canonical_spellings(df: DataFrame, columns: list[str], collation: str = COLLATION) -> DataFrame:
    """Give every text of ``columns`` the least spelling among those that the
    collation holds equal, so that grouping and joining by it afterwards treats
    them as one key. Only a column's different texts are compared; the frame
    joins them back by size."""
    for c in columns:
        texts = df.where(F.col(f"`{c}`").isNotNull()).select(F.col(f"`{c}`").alias(c)).distinct()
        key = F.collate(F.col(f"`{c}`"), collation)
        least = texts.groupBy(key.alias("__key")).agg(F.min(f"`{c}`").alias("__least"))
        spelt = texts.withColumn("__key", key).join(least, "__key").select(c, "__least").where(F.col(f"`{c}`") != F.col("__least"))
        df = join_small(df, spelt, c, "left").select(
            *[F.coalesce("__least", F.col(f"`{c}`")).alias(c) if x == c else F.col(f"`{x}`") for x in df.columns])
    return df


# Text dates are read by the first of these formats that fits; "iso" is Spark's
# own cast. Months and days may have one digit.
TIMESTAMP_FORMATS = ("iso", "M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")


def parse_timestamps(df: DataFrame, columns=("order_date_dateorders", "shipping_date_dateorders"),
                     fmt: str | list[str] | tuple[str, ...] = TIMESTAMP_FORMATS, on_error: str = "raise") -> DataFrame:
    """String (or timestamp) -> timestamp without time zone. A string that no
    format fits fails the job; ``on_error="null"`` makes it null instead, and
    ``on_error="quarantine"`` also says why in the column ``reject_reason``, by
    which ``files.set_aside`` splits the rows."""
    if on_error not in ("raise", "null", "quarantine"):
        raise ValueError(f"on_error is 'raise', 'null' or 'quarantine', not {on_error!r}")
    types = {f.name: f.dataType for f in df.schema.fields}
    texts = {c: f"__parsed_{c}" for c in df.columns if c in columns and isinstance(types[c], T.StringType)}
    # parsed in a projection of its own: a value that is used twice is not parsed twice
    df = df.select("*", *[_parsed(F.col(f"`{c}`"), fmt).alias(e) for c, e in texts.items()])
    out, reasons = [], [F.col(REASON)] if REASON in types else []
    for c in types:
        col = F.col(f"`{c}`")
        if c in texts:
            e, why = F.col(f"`{texts[c]}`"), F.concat(F.lit(f"{c}: not a timestamp: "), col)
            if on_error == "raise":
                e = F.coalesce(e, F.when(col.isNotNull(), F.raise_error(why).cast("timestamp_ntz")))
            reasons.append(F.when(col.isNotNull() & e.isNull(), why))
            out.append(e.alias(c))
        elif c in columns and isinstance(types[c], T.TimestampType):
            out.append(col.cast("timestamp_ntz").alias(c))
        else:
            out.append(col)
    if on_error == "quarantine":
        out = [c for c, name in zip(out, types) if name != REASON]
        out.append(F.coalesce(*reasons, F.lit(None).cast("string")).alias(REASON))
    return df.select(*out)


def _shape(fmt: str) -> str | None:
    """Pattern that every text of a format of numbers between separators has; it
    only spares a try that cannot succeed. None: no such pattern is known."""
    if not re.fullmatch(r"[yMdHms]+([/:. ]+[yMdHms]+)*", fmt):
        return None
    return "^" + "".join("[^/:. ]+" if p[0].isalpha() else re.escape(p) for p in re.findall(r"[a-zA-Z]+|[/:. ]+", fmt)) + "$"


def _parsed(col, fmt):
    formats = [fmt] if isinstance(fmt, str) else list(fmt)

    def one(f: str):
        if f == "iso":
            return col.try_cast("timestamp_ntz")
        e, shape = F.try_to_timestamp(col, F.lit(f)).cast("timestamp_ntz"), _shape(f)
        return F.when(col.rlike(shape), e) if shape else e

    return F.coalesce(*[one(f) for f in formats])


def unparsed_timestamps(df: DataFrame, columns=("order_date_dateorders", "shipping_date_dateorders"),
                        fmt: str | list[str] | tuple[str, ...] = TIMESTAMP_FORMATS) -> DataFrame:
    """One row: for each text column, the strings that no format fits."""
    return df.agg(*[F.count_if(F.col(f"`{c}`").isNotNull() & _parsed(F.col(f"`{c}`").cast("string"), fmt).isNull())
                    .alias(c) for c in columns])


def filter_lead_time(df: DataFrame, col: str = "lead_time_days", lo: int = LEAD_TIME_MIN, hi: int = LEAD_TIME_MAX) -> DataFrame:
    """Keep lo <= lead_time_days <= hi, inclusive; null fails."""
    return df.where(F.col(col).between(lo, hi))
