"""Partitioning of a bar series for window work.

Every indicator looks a fixed number of bars back (and, for pivots and gates, ahead). So a long history
can be cut into time slices which are computed independently, as long as each slice also holds copies of
the neighbouring bars it looks at: its halo. A symbol that holds a third of all rows then spreads over
many tasks instead of one.

Slices are of equal depth: a history of more than ``SLICE_BARS`` rows is cut at quantiles of its own times, found by
one sketch per such symbol, so a slice holds about that many rows however dense or sparse they are. From the grain of a
day upward, the calendar bounds the whole history (a century of daily bars is 36,525 rows), hence the series is one
slice and needs no halo; so is every shorter history.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from marketlake.session import workspace

GRAIN_MICROS = {"microsecond": 1, "millisecond": 1000, "second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000}
CALENDAR_GRAINS = ("day", "week", "month", "quarter", "year")
SLICE_BARS = 16_384
# Quantiles of a long history's times, a power of two; between two of them slices are equally wide.
KNOTS = 256
# Knots of at most this many symbols (2 KB each) may be broadcast; beyond it the same join shuffles.
BROADCAST_KNOTS = 4096
# What one document covers for bars at least so many microseconds apart.
DOCUMENT_PERIODS = {3_600_000_000: "month", 60_000_000: "day", 1_000_000: "hour", 1000: "second", 1: "millisecond"}


@dataclass(frozen=True)
class Series:
    """A bar frame together with the columns its windows are partitioned by."""

    frame: DataFrame
    keys: Sequence[str] = field(default_factory=lambda: ["symbol"])
    most: int | None = None  # slices of the longest history, where that is known

    @property
    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.keys).orderBy("timestamp")

    @property
    def so_far(self) -> WindowSpec:
        return self.ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def whole(self) -> WindowSpec:
        return Window.partitionBy(*self.keys)

    def trailing(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-(n - 1), Window.currentRow)

    def around(self, n: int) -> WindowSpec:
        return self.ordered.rowsBetween(-n, n)

    def with_frame(self, frame: DataFrame) -> Series:
        return Series(frame, self.keys, self.most)

    def result(self) -> DataFrame:
        """The frame without halo rows and helper columns."""
        if "halo" not in self.frame.columns:
            return self.frame.drop("slice")
        return self.frame.where(~F.col("halo")).drop("slice", "halo")


@dataclass(frozen=True)
class Cuts:
    """Where long histories are cut: (symbol, cut_groups, cut_parts, cut_knots), or None if none is longer than a slice."""

    knots: DataFrame | None
    most: int = 1  # slices of the longest history


def depth_cuts(bars: DataFrame, slice_bars: int = SLICE_BARS) -> Cuts:
    """Slices of about ``slice_bars`` rows for every symbol that has more, from its time's quantiles.

    Two narrow passes, run at once: rows per symbol, then a mergeable quantile sketch for those with more than a slice. The result is
    small and written, so all that uses it sees the same cuts. Any frame of about the same times will do, repeated bars and all; where a history is
    cut changes no result.
    """
    spark = bars.sparkSession
    times = dated(bars).select("symbol", F.unix_micros(F.col("timestamp").cast("timestamp")).alias("at"))
    long = times.groupBy("symbol").agg(F.count("*").alias("cut_bars")).where(F.col("cut_bars") > slice_bars)
    path = workspace(spark, "long-histories")
    long.write.parquet(path)
    long = spark.read.schema(long.schema).parquet(path)
    if long.isEmpty():
        return Cuts(None)
    knots = F.percentile_approx("at", [i / KNOTS for i in range(KNOTS + 1)], 10_000).alias("cut_knots")
    parts = F.ceil(F.col("cut_bars") / F.lit(KNOTS * slice_bars)).cast("long")
    groups = F.least(F.ceil(F.col("cut_bars") / F.lit(slice_bars)).cast("long"), F.lit(KNOTS))
    found = times.join(_small(long), "symbol").groupBy("symbol", "cut_bars").agg(knots)
    found = found.select("symbol", groups.alias("cut_groups"), parts.alias("cut_parts"), "cut_knots")
    path = workspace(spark, "cuts")
    found.write.parquet(path)
    found = spark.read.schema(found.schema).parquet(path)
    return Cuts(found, found.agg(F.max(F.col("cut_groups") * F.col("cut_parts"))).first()[0])


def _small(rows: DataFrame) -> DataFrame:
    """Rows of few symbols, broadcast if their number is as small as it mostly is."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_KNOTS else rows


def cut(bars: DataFrame, cuts: Cuts) -> DataFrame:
    """Number the slices in the order of time and move each to one partition."""
    if cuts.knots is None:
        return bars.withColumn("slice", F.lit(0).cast("long")).repartition("symbol", "slice")
    names = bars.columns
    at = F.unix_micros(F.col("timestamp").cast("timestamp"))
    bars = bars.join(_small(cuts.knots), "symbol", "left").withColumns({"cut_at": at, "cut_place": F.lit(0)})
    step = KNOTS // 2
    while step:  # the last knot that is not after the bar, by halving
        further = F.col("cut_place") + step
        bars = bars.withColumn("cut_place", F.when(F.get("cut_knots", further) <= F.col("cut_at"), further).otherwise(F.col("cut_place")))
        step //= 2
    low, high = F.get("cut_knots", F.col("cut_place")), F.get("cut_knots", F.col("cut_place") + 1)
    share = F.floor((F.col("cut_at") - low) / (high - low + 1) * F.col("cut_parts"))
    inside = F.greatest(F.least(share, F.col("cut_parts") - 1), F.lit(0))
    number = F.floor(F.col("cut_place") * F.col("cut_groups") / KNOTS) * F.col("cut_parts") + inside
    # Never NULL, so joins on it add no filter that would split the plan.
    return bars.select(*names, F.coalesce(number, F.lit(0)).alias("slice")).repartition("symbol", "slice")


def dated(bars: DataFrame) -> DataFrame:
    """A bar without a symbol or a time belongs to no series."""
    return bars.where(F.col("symbol").isNotNull() & F.col("timestamp").isNotNull())


def undated(bars: DataFrame) -> DataFrame:
    """The bars that ``dated`` leaves out, for the quarantine."""
    return bars.where(F.col("symbol").isNull() | F.col("timestamp").isNull())


def spacing(grain: str | timedelta) -> int | None:
    """Microseconds between bars of a grain, a name or the spacing itself; None from a day upward."""
    if isinstance(grain, timedelta):
        apart = grain // timedelta(microseconds=1)
        return None if apart >= 86_400_000_000 else max(apart, 1)
    if grain in CALENDAR_GRAINS:
        return None
    if grain not in GRAIN_MICROS:
        raise ValueError(f"unknown grain {grain!r}; use one of {[*GRAIN_MICROS, *CALENDAR_GRAINS]} or a timedelta")
    return GRAIN_MICROS[grain]


def is_sliced(grain: str | timedelta) -> bool:
    return spacing(grain) is not None


def default_period(grain: str | timedelta) -> str | None:
    """What one document of a grain covers unless stated: a whole history from a day upward, some thousands of bars below."""
    apart = spacing(grain)
    return None if apart is None else next(p for least, p in DOCUMENT_PERIODS.items() if apart >= least)


def as_series(
    bars: DataFrame,
    grain: str | timedelta = "day",
    lookback: int = 0,
    lookahead: int = 0,
    slice_bars: int = SLICE_BARS,
    cuts: Cuts | None = None,
) -> Series:
    """Partition ``bars`` so that windows reaching ``lookback``/``lookahead`` rows are exact.

    The rows are shuffled once, on (symbol, slice). Only the halo, at most ``lookback + lookahead`` rows
    per slice, is shuffled again; the union keeps the partitioning, so the windows need no exchange.
    Bars that have a ``slice`` already are taken as cut.
    """
    if not is_sliced(grain):
        return Series(dated(bars))
    if "slice" not in bars.columns:
        cuts = cuts or depth_cuts(bars, slice_bars)
        if cuts.knots is None:
            return Series(dated(bars))
        bars = cut(dated(bars), cuts)
    parts = [bars.withColumn("halo", F.lit(False))]
    if lookback:
        parts.append(_halo(bars, lookback, later=True))
    if lookahead:
        parts.append(_halo(bars, lookahead, later=False))
    frame = reduce(DataFrame.unionByName, parts)
    return Series(frame, ["symbol", "slice"], cuts.most if cuts else None)


def _halo(bars: DataFrame, reach: int, later: bool) -> DataFrame:
    """Copies of the bars within ``reach`` rows of a later (or earlier) slice, filed under that slice.

    Each slice offers its outermost rows, ``reach`` at most. How many each neighbour slice takes of them follows from the
    running count of offered rows along the symbol, over one slim row (symbol, slice, held) per slice; where slices are short,
    the copies come from several. The rows themselves then go straight from their slice to the slices that take them.
    """
    outward = F.desc("timestamp") if later else F.asc("timestamp")
    onward = F.asc("slice") if later else F.desc("slice")
    edge = bars.withColumn(
        "edge_rank", F.row_number().over(Window.partitionBy("symbol", "slice").orderBy(outward))
    ).where(F.col("edge_rank") <= reach)
    held = edge.groupBy("symbol", "slice").agg(F.max("edge_rank").cast("bigint").alias("held"))
    before = F.sum("held").over(Window.partitionBy("symbol").orderBy(onward)) - F.col("held")
    # A slice holds ``reach`` rows at most, so all that give rows begin within twice the reach.
    near = Window.partitionBy("symbol").orderBy("before").rangeBetween(-2 * reach, -1)
    givers = F.collect_list(F.struct("slice", (F.col("before") + F.col("held")).alias("through"))).over(near)
    takes = (
        held.withColumn("before", before)
        .select("symbol", F.col("slice").alias("taker"), "before", givers.alias("givers"))
        .select("symbol", "taker", "before", F.explode("givers").alias("giver"))
        .select("symbol", F.col("giver.slice").alias("slice"), "taker", (F.col("giver.through") + reach - F.col("before")).alias("most"))
        .where("most > 0")
    )
    copies = edge.join(takes, ["symbol", "slice"]).where("edge_rank <= most")
    named = [F.col("taker").alias("slice") if c == "slice" else F.col(c) for c in bars.columns]
    return copies.select(*named, F.lit(True).alias("halo")).repartition("symbol", "slice")
