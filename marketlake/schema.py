"""Canonical schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE_COLUMNS = ["open", "high", "low", "close"]
NUMERIC_COLUMNS = [*PRICE_COLUMNS, "volume", "adjusted_close"]

BAR_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("open", T.DoubleType()),
        T.StructField("high", T.DoubleType()),
        T.StructField("low", T.DoubleType()),
        T.StructField("close", T.DoubleType()),
        T.StructField("volume", T.LongType()),
        T.StructField("adjusted_close", T.DoubleType()),
    ]
)

SILVER_SCHEMA = T.StructType(
    [*BAR_SCHEMA.fields, T.StructField("sma_20", T.DoubleType()), T.StructField("rsi_14", T.DoubleType())]
)

GOLD_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("year_month", T.StringType()),
        *[T.StructField(c, T.DoubleType()) for c in PRICE_COLUMNS],
        T.StructField("volume", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        *[T.StructField(c, T.DoubleType()) for c in ("monthly_return", "ma_3m", "volatility")],
    ]
)

STOCK_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("exchange", T.StringType()),
        T.StructField("sector", T.StringType()),
        T.StructField("industry", T.StringType()),
        T.StructField("last_updated", T.TimestampType()),
    ]
)

DOCUMENT_SCHEMA = T.StructType([T.StructField("symbol", T.StringType()), T.StructField("document", T.StringType())])

PERIOD_SCHEMA = T.StructType([*DOCUMENT_SCHEMA.fields, T.StructField("period", T.TimestampType())])

QUARANTINE_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("body", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("kind", T.StringType()),
        T.StructField("run", T.StringType()),
    ]
)

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("timestamp", T.TimestampType(), False),
        T.StructField("data", T.StringType()),
        T.StructField("metadata", T.MapType(T.StringType(), T.StringType())),
    ]
)


class MissingColumns(ValueError):
    """Raised while the plan is built, before any job runs."""


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing columns: {', '.join(missing)}")
    return df


def with_optional(df: DataFrame, **types: str) -> DataFrame:
    """Add each absent optional column as a typed NULL."""
    return df.withColumns({n: F.lit(None).cast(t) for n, t in types.items() if n not in df.columns})


def conform_bars(df: DataFrame) -> DataFrame:
    """Project onto ``BAR_SCHEMA``; absent optional columns become NULL, NaN becomes NULL."""
    require_columns(df, "symbol", "timestamp", *PRICE_COLUMNS)
    df = with_optional(df, volume="bigint", adjusted_close="double")
    prices = {c: no_nan(F.col(c).cast("double")) for c in [*PRICE_COLUMNS, "adjusted_close"]}
    return df.select(
        F.col("symbol").cast("string").alias("symbol"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        *[prices[c].alias(c) for c in PRICE_COLUMNS],
        F.col("volume").cast("bigint").alias("volume"),
        prices["adjusted_close"].alias("adjusted_close"),
    )


def no_nan(col):
    """NaN sorts above every number in Spark and poisons averages; treat it as missing."""
    return F.when(~F.isnan(col), col)
