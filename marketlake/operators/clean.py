"""Cleaning: column names, types, latest version per key, forward fill, date filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.series import SLICE_BARS, Cuts, cut, dated, depth_cuts, is_sliced
from marketlake.schema import NUMERIC_COLUMNS, no_nan, require_columns

# Vendor column names and their canonical names.
VENDOR_COLUMNS = {
    "Open": "open",
    "High": "high",
    "Low": "low",
    "Close": "close",
    "Volume": "volume",
    "Adj Close": "adjusted_close",
}


def standardise(df: DataFrame) -> DataFrame:
    """Canonical names where a vendor column is present, typed timestamp, NaN to NULL."""
    require_columns(df, "symbol", "timestamp")
    df = df.withColumnsRenamed({k: v for k, v in VENDOR_COLUMNS.items() if k in df.columns})
    kinds = dict(df.dtypes)
    fixed = {c: no_nan(F.col(c)) for c in NUMERIC_COLUMNS if kinds.get(c) in ("double", "float")}
    if kinds["timestamp"] != "timestamp":
        fixed["timestamp"] = parse_time("timestamp", kinds["timestamp"])
    return df.withColumns(fixed)


def parse_time(name: str, kind: str):
    if kind == "string":
        return F.try_to_timestamp(F.col(name))
    return F.col(name).cast("timestamp")


def drop_repeats(df: DataFrame) -> DataFrame:
    """One copy of each fully equal row; copies collapse map-side before the shuffle."""
    return df.dropDuplicates()


def keep_latest(df: DataFrame, keys: Sequence[str], version: Sequence[str] = ()) -> DataFrame:
    """One row per key: the highest version; equal versions are settled by the values.

    Spark limits the rank inside each map task first, so many copies of one key do not meet in one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in version]
    order = [F.desc_nulls_last(c) for c in [*version, *rest]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("version_rank", rank).where("version_rank = 1").drop("version_rank")


def forward_fill(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    grain: str = "day",
    slice_bars: int = SLICE_BARS,
    keep_slice: bool = False,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Replace NULLs by the symbol's last value before them; leading NULLs stay.

    In a sliced history each slice also gets the last values of the slices before it, one row per slice.
    With ``keep_slice`` a history that was cut keeps its ``slice``.
    """
    columns = [c for c in (columns or NUMERIC_COLUMNS) if c in df.columns]
    df = dated(df)
    if is_sliced(grain):
        cuts = cuts or depth_cuts(df, slice_bars)
    if cuts is None or cuts.knots is None:
        so_far = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})

    key = ["symbol", "slice"]
    sliced = cut(df, cuts)
    before = Window.partitionBy("symbol").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    seen = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col("timestamp"))).alias(c) for c in columns]
    # the carried values enter their slice as one row without a time, which sorts ahead of its bars
    carried = (
        sliced.groupBy(*key)
        .agg(*seen)
        .select(*key, *[F.last(c, ignorenulls=True).over(before).alias(c) for c in columns])
        .repartition(*key)
    )
    so_far = Window.partitionBy(*key).orderBy("timestamp").rowsBetween(Window.unboundedPreceding, 0)
    filled = (
        sliced.unionByName(carried, allowMissingColumns=True)
        .withColumns({c: F.last(c, ignorenulls=True).over(so_far) for c in columns})
        .where("timestamp IS NOT NULL")
    )
    return filled if keep_slice else filled.drop("slice")


def clean(
    df: DataFrame,
    version: Sequence[str] = (),
    grain: str = "day",
    slice_bars: int = SLICE_BARS,
    keep_slice: bool = False,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Standardise, keep the latest row per (symbol, timestamp), forward-fill in time order.

    Keeping one row per key also removes fully equal rows.
    """
    df = standardise(df)
    if is_sliced(grain):
        cuts = cuts or depth_cuts(df, slice_bars)  # of the landed bars, so that it costs no shuffle of whole rows
    df = keep_latest(df, ["symbol", "timestamp"], [v for v in version if v in df.columns])
    return forward_fill(df, grain=grain, keep_slice=keep_slice, cuts=cuts)


def between(df: DataFrame, start, end, column: str = "timestamp") -> DataFrame:
    """Inclusive time range."""
    return df.where(F.col(column).between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def last_days(df: DataFrame, as_of, days: int = 30, column: str = "timestamp") -> DataFrame:
    """Rows of the ``days`` days up to ``as_of``."""
    end = F.lit(as_of).cast("timestamp")
    return df.where(F.col(column).between(end - F.make_dt_interval(F.lit(days)), end))
