"""Scalar helpers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schema import PRICE_COLUMNS

DECIMAL = "decimal(18,6)"


def enrich_intraday(df: DataFrame) -> DataFrame:
    """Daily performance, range and intraday volatility when all four prices exist as columns.

    A zero open gives NULL metrics and keeps the row. Works on batch and streaming frames alike.
    """
    if not set(PRICE_COLUMNS) <= set(df.columns):
        return df
    o, h, l, c = (F.col(n) for n in PRICE_COLUMNS)
    return df.withColumns(
        {
            "daily_performance": F.try_divide(c - o, o) * 100,
            "range": h - l,
            "intraday_volatility": F.try_divide(h - l, o) * 100,
        }
    )


def default_time(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """Missing event times become the processing time."""
    if column not in df.columns:
        return df.withColumn(column, F.current_timestamp())
    return df.withColumn(column, F.coalesce(F.col(column), F.current_timestamp()))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text, with ``Z``, an offset or neither, as UTC time; anything else is NULL."""
    return F.try_to_timestamp(text)


def to_decimal(value: Column) -> Column:
    """Double to decimal through its shortest decimal text, as exact as the text is."""
    return value.cast("string").cast(DECIMAL)


def to_utc(timestamp: Column, zone: str) -> Column:
    """Wall-clock time of ``zone`` as UTC."""
    return F.to_utc_timestamp(timestamp, zone)


def date_parts(timestamp: str) -> dict[str, Column]:
    """Zero-padded partition columns."""
    return {
        "year": F.date_format(timestamp, "yyyy"),
        "month": F.date_format(timestamp, "MM"),
        "day": F.date_format(timestamp, "dd"),
    }


def split_symbols(text: Column) -> Column:
    """Comma-separated symbols, trimmed; empty entries dropped."""
    return F.filter(F.transform(F.split(text, ","), lambda s: F.trim(s)), lambda s: s != "")
