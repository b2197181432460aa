"""Registered queries, each next to the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, places: int = 6):
    """Register ``fn(spark, folder)``; doubles are rounded to ``places`` as in the SQL."""

    def register(fn: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return tidy(fn(spark, folder), places)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


def tidy(df: DataFrame, places: int) -> DataFrame:
    """Rounded doubles and zone-less timestamps, so that results compare across engines."""

    def shown(f: T.StructField):
        if isinstance(f.dataType, T.DoubleType):
            return F.round(f.name, places).alias(f.name)
        if isinstance(f.dataType, T.TimestampType):
            return F.col(f.name).cast("timestamp_ntz").alias(f.name)
        return F.col(f.name)

    return df.select(*[shown(f) for f in df.schema.fields])


# --- SQL building blocks ----------------------------------------------------------------------------

DAILY = """bars AS (
  SELECT o_orderstatus AS symbol, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS "timestamp",
         arg_min(o_totalprice, o_orderkey) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
         arg_max(o_totalprice, o_orderkey) AS close, count(*) AS volume
  FROM orders GROUP BY 1, 2)"""


def events_bars(grain: str) -> str:
    return f"""bars AS (
  SELECT event_type AS symbol, CAST(date_trunc('{grain}', ts) AS TIMESTAMP) AS "timestamp",
         first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
         last(value ORDER BY ts, event_id) AS close, count(*) AS volume
  FROM events GROUP BY 1, 2)"""


HOURLY = events_bars("hour")
EVENT_DAYS = events_bars("day")

BY_TIME = 'PARTITION BY symbol ORDER BY "timestamp"'


def over(n: int) -> str:
    return f"OVER ({BY_TIME} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def full(fn: str, x: str, n: int) -> str:
    """A trailing aggregate that is NULL until its window is full."""
    return f"CASE WHEN count({x}) {over(n)} >= {n} THEN {fn}({x}) {over(n)} END"


CHANGES = f"""changes AS (
  SELECT *, lag(close) OVER ({BY_TIME}) AS before,
         close - lag(close) OVER ({BY_TIME}) AS change FROM bars),
sided AS (
  SELECT *, CASE WHEN change IS NOT NULL THEN greatest(change, 0) END AS gain,
         CASE WHEN change IS NOT NULL THEN greatest(-change, 0) END AS loss,
         CASE WHEN before IS NULL THEN high - low
              ELSE greatest(high - low, abs(high - before), abs(low - before)) END AS true_range,
         CASE WHEN before <> 0 THEN close / before - 1 END AS daily_return
  FROM changes)"""

RSI = f"100 - 100 / (1 + ({full('avg', 'gain', 14)}) / nullif({full('avg', 'loss', 14)}, 0))"
