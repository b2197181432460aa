"""Per-symbol batch results: statistics, volatility, trend, levels, the indicator document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.clean import between, clean, standardise
from marketlake.operators.indicators import Indicator, indicators, register_indicator
from marketlake.operators.series import depth_cuts, is_sliced
from marketlake.schema import require_columns, with_optional

# Bars a symbol needs before a result exists.
MIN_BARS = {
    "sma_5": 5,
    "sma_20": 20,
    "sma_50": 50,
    "ema_5": 5,
    "ema_20": 20,
    "rsi_14": 14,
    "bollinger": 20,
    "macd": 26,
    "volatility": 2,
    "trends": 20,
    "levels": 30,
}
TRADING_DAYS = 252
MOST_GATED = max(MIN_BARS.values())

# Whether the symbol has at least so many bars, one flag per gate. A slice sees them within the largest gate's halo.
GATES = sorted(set(MIN_BARS.values()))
register_indicator(
    "gates",
    Indicator(
        lambda s, warmup: {f"has_{n}": F.count("*").over(s.whole) >= n for n in GATES},
        lookback=MOST_GATED - 1,
        lookahead=MOST_GATED - 1,
        needs=(),
    ),
)

WIDE = ["sma_5", "sma_20", "sma_50", "ema_5", "ema_20", "rsi_14", "bollinger", "macd", "atr_14", "daily_return"]
SERIES_COLUMNS = ["sma_5", "sma_20", "sma_50", "ema_5", "ema_20", "rsi_14"]


def silver_bars(raw: DataFrame, version=("ingest_ts",), warmup: str = "full", grain: str = "day") -> DataFrame:
    """Clean bars with ``sma_20`` and ``rsi_14``."""
    cuts = depth_cuts(standardise(raw)) if is_sliced(grain) else None
    cleaned = clean(raw, version=version, grain=grain, keep_slice=True, cuts=cuts)
    return indicators(cleaned, ["sma_20", "rsi_14"], warmup=warmup, grain=grain, cuts=cuts)


def indicators_wide(bars: DataFrame, warmup: str = "full", grain: str = "day") -> DataFrame:
    """Every indicator as a column; moving averages are NULL below their minimum history."""
    return indicators(bars, WIDE, warmup=warmup, grain=grain, gated=True)


def symbol_indicators(bars: DataFrame, symbol: str, start, end, **options) -> DataFrame:
    """All indicators of one symbol over a date range; no bars give no rows."""
    return indicators_wide(between(bars.where(F.col("symbol") == symbol), start, end), **options)


def indicator_gates(bars: DataFrame) -> DataFrame:
    """Which results a symbol has enough bars for."""
    counted = bars.groupBy("symbol").agg(F.count("*").alias("bars"))
    return counted.withColumns({f"has_{name}": F.col("bars") >= least for name, least in MIN_BARS.items()})


def days_between(start: Column, end: Column) -> Column:
    """Whole elapsed 24-hour periods."""
    return F.floor((F.unix_seconds(end) - F.unix_seconds(start)) / 86400)


def total_return(first: Column, last: Column) -> Column:
    return F.try_divide(last - first, first)


def batch_statistics(bars: DataFrame, grain: str = "day") -> DataFrame:
    """Range, price, volume and return statistics per symbol, in one aggregation."""
    require_columns(bars, "symbol", "timestamp", "close")
    bars = with_optional(bars, volume="bigint").select("symbol", "timestamp", "close", "volume")
    return indicators(bars, ["daily_return"], grain=grain).groupBy("symbol").agg(*_statistics_aggregates())


def _statistics_aggregates() -> list[Column]:
    start, end = F.min("timestamp"), F.max("timestamp")
    first, last = F.min_by("close", "timestamp"), F.max_by("close", "timestamp")
    return [
        start.alias("start_date"),
        end.alias("end_date"),
        days_between(start, end).alias("days"),
        F.min("close").alias("min_price"),
        F.max("close").alias("max_price"),
        F.avg("close").alias("avg_price"),
        F.min("volume").alias("min_volume"),
        F.max("volume").alias("max_volume"),
        F.avg("volume").alias("avg_volume"),
        F.avg("daily_return").alias("avg_daily_return"),
        F.stddev_samp("daily_return").alias("std_daily_return"),
        F.when(F.count("*") > 1, total_return(first, last)).alias("total_return"),
    ]


def last_bars(bars: DataFrame, n: int) -> DataFrame:
    """The last ``n`` bars of each symbol with ``age`` 1 for the newest.

    The rank limit is applied inside each map task first, so at most ``n`` rows per symbol and task are
    shuffled however long the history is.
    """
    newest = Window.partitionBy("symbol").orderBy(F.desc("timestamp"))
    return bars.withColumn("age", F.row_number().over(newest)).where(F.col("age") <= n)


def volatility(bars: DataFrame, grain: str = "day") -> DataFrame:
    """Daily and annualised volatility of returns and the newest ATR, in one pass."""
    require_columns(bars, "symbol", "timestamp", "close")
    ranged = {"high", "low"} <= set(bars.columns)
    columns = ["symbol", "timestamp", "close", *(["high", "low"] if ranged else [])]
    rows = indicators(bars.select(*columns), ["daily_return", *(["atr_14"] if ranged else [])], grain=grain)
    return with_optional(rows, atr_14="double").groupBy("symbol").agg(*_volatility_aggregates())


def _volatility_aggregates() -> list[Column]:
    spread = F.stddev_samp("daily_return")
    return [
        spread.alias("daily"),
        (spread * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("annualized"),
        F.max_by("atr_14", "timestamp").alias("atr_14"),
    ]


def trend(bars: DataFrame) -> DataFrame:
    """Current trend against the 20- and 50-bar averages at the newest bar, from 20 bars on."""
    recent = last_bars(bars.select("symbol", "timestamp", "close"), MOST_GATED)

    def average(n: int) -> Column:
        close = F.when(F.col("age") <= n, F.col("close"))
        return F.when(F.count(close) >= n, F.avg(close)).alias(f"sma_{n}")

    newest = F.max(F.when(F.col("age") == 1, F.col("close"))).alias("close")
    latest = recent.groupBy("symbol").agg(F.count("*").alias("bars"), newest, average(20), average(50))
    return latest.where(F.col("bars") >= MIN_BARS["trends"]).select("symbol", *_trend_columns())


def _trend_columns() -> list[Column]:
    close, short, long = F.col("close"), F.col("sma_20"), F.col("sma_50")
    above = F.when(long.isNotNull(), (close > short) & (short > long)).otherwise(close > short)
    below = F.when(long.isNotNull(), (close < short) & (short < long)).otherwise(close < short)
    base = F.coalesce(long, short)
    return [
        F.when(above, "bullish").when(below, "bearish").otherwise("sideways").alias("trend"),
        F.try_divide(F.abs(close - base), base).alias("strength"),
    ]


def pivot_points(bars: DataFrame, grain: str = "day") -> DataFrame:
    """Bars that no neighbour within five bars exceeds (resistance) or undercuts (support)."""
    found = indicators(bars.select("symbol", "timestamp", "close"), ["pivots"], grain=grain)
    return found.where("pivot_type IS NOT NULL").select(
        "symbol", "timestamp", F.col("close").alias("price"), "pivot_type"
    )


def support_resistance(bars: DataFrame, grain: str = "day", levels: int = 3) -> DataFrame:
    """The last support and resistance levels per symbol, oldest first, from 30 bars on."""
    found = indicators(bars.select("symbol", "timestamp", "close"), ["pivots", "gates"], grain=grain).where(
        F.col(f"has_{MIN_BARS['levels']}") & F.col("pivot_type").isNotNull()
    )
    newest = Window.partitionBy("symbol", "pivot_type").orderBy(F.desc("timestamp"))
    kept = found.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= levels)

    def prices(kind: str) -> Column:
        level = F.when(F.col("pivot_type") == kind, F.struct("timestamp", F.col("close").alias("price")))
        ordered = F.transform(F.array_sort(F.collect_list(level)), lambda p: p["price"])
        return F.when(F.size(ordered) > 0, ordered)

    return kept.groupBy("symbol").agg(
        prices("support").alias("support_levels"), prices("resistance").alias("resistance_levels")
    )


def iso(timestamp) -> Column:
    """ISO-8601 text; fractional seconds only when there are any."""
    ts = F.col(timestamp) if isinstance(timestamp, str) else timestamp
    plain = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(ts, ".SSSSSS")
    return F.when(fraction == ".000000", plain).otherwise(F.concat(plain, fraction))


DOCUMENT_COLUMNS = [*SERIES_COLUMNS, "bb_upper", "bb_middle", "bb_lower", "macd", "macd_signal", "macd_histogram"]
# The statistics of a document, in order.
STATISTICS = [
    "start_date",
    "end_date",
    "days",
    "min_price",
    "max_price",
    "avg_price",
    "min_volume",
    "max_volume",
    "avg_volume",
    "avg_daily_return",
    "std_daily_return",
    "total_return",
]


def indicator_document(bars: DataFrame, grain: str = "day", period: str | None = None) -> DataFrame:
    """One JSON document per symbol: indicator series, statistics, volatility, trends.

    Keys below their minimum history are left out. A document holds a whole history, which the calendar
    bounds from daily bars upward; finer grains must name a ``period`` (such as ``"month"``) and get one
    document per symbol and period. Everything comes from one pass over the indicator columns.
    """
    if period is None and is_sliced(grain):
        raise ValueError("intraday documents need a period, so that no document grows with the history")
    require_columns(bars, "symbol", "timestamp", "high", "low", "close")
    bars = with_optional(bars, volume="bigint").select("symbol", "timestamp", "high", "low", "close", "volume")
    wide = indicators(bars, [*WIDE, "pivots", "gates"], grain=grain, gated=True)
    at = F.struct("timestamp", iso("timestamp").alias("iso"), "close", "pivot_type", *DOCUMENT_COLUMNS)
    rows = F.array_sort(F.collect_list(at)).alias("rows")
    summary = [
        *_statistics_aggregates(),
        *_volatility_aggregates(),
        *[F.max_by(c, "timestamp").alias(c) for c in ("close", "sma_20", "sma_50")],
        *[F.bool_or(f"has_{n}").alias(f"has_{n}") for n in GATES],
    ]
    if period is None:
        joined = wide.groupBy("symbol").agg(rows, *summary)
        levels = {f"{kind}_levels": _last_levels(kind) for kind in ("support", "resistance")}
    else:
        pages = wide.groupBy("symbol", F.date_trunc(period, "timestamp").alias("period")).agg(rows)
        joined = pages.join(wide.groupBy("symbol").agg(*summary), "symbol")
        joined = joined.join(support_resistance(bars, grain), "symbol", "left")
        levels = {f"{kind}_levels": F.col(f"{kind}_levels") for kind in ("support", "resistance")}
    keys = ["symbol"] if period is None else ["symbol", "period"]
    current, strength = _trend_columns()

    def gate(name: str, value: Column) -> Column:
        return F.when(F.col(f"has_{MIN_BARS[name]}"), value)

    def grouped(gate_name: str, **columns: str) -> Column:
        return gate(gate_name, F.struct(*[_points(c).alias(n) for n, c in columns.items()]))

    statistics = [iso(c).alias(c) if c.endswith("_date") else F.col(c) for c in STATISTICS]
    trends = F.struct(
        current.alias("current"), strength, *[gate("levels", column).alias(name) for name, column in levels.items()]
    )
    document = F.struct(
        *[gate(n, _points(n)).alias(n) for n in SERIES_COLUMNS],
        grouped("bollinger", upper="bb_upper", middle="bb_middle", lower="bb_lower").alias("bollinger_bands"),
        grouped("macd", macd="macd", signal="macd_signal", histogram="macd_histogram").alias("macd"),
        F.struct(*statistics).alias("statistics"),
        gate("volatility", F.struct("daily", "annualized", "atr_14")).alias("volatility"),
        gate("trends", trends).alias("trends"),
    )
    return joined.select(*keys, F.to_json(document).alias("document"))


def _points(name: str) -> Column:
    """The series of one indicator from the collected rows."""
    return F.transform(
        F.filter("rows", lambda r: r[name].isNotNull()),
        lambda r: F.struct(r["iso"].alias("timestamp"), r[name].alias("value")),
    )


def _last_levels(kind: str, levels: int = 3) -> Column:
    prices = F.transform(F.filter("rows", lambda r: r["pivot_type"] == kind), lambda r: r["close"])
    size = F.size(prices)
    return F.when(size > 0, F.slice(prices, F.greatest(size - levels + 1, F.lit(1)), levels))
