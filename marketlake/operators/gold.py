"""Gold layer: monthly rollup and long-run statistics per symbol."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.batch import TRADING_DAYS, days_between, total_return
from marketlake.operators.indicators import indicators
from marketlake.operators.series import is_sliced
from marketlake.schema import require_columns, with_optional


def monthly(bars: DataFrame) -> DataFrame:
    """OHLCV per calendar month with monthly return (%), 3-month average close and close volatility.

    Bars shrink to one row per symbol and month inside the map tasks; the windows then see months only.
    """
    return across_months(month_bars(bars))


def month_bars(bars: DataFrame) -> DataFrame:
    """OHLCV and close volatility of each symbol and month by itself."""
    require_columns(bars, "symbol", "timestamp", "open", "high", "low", "close")
    bars = with_optional(bars, volume="bigint")
    known = {c: F.when(F.col(c).isNotNull(), F.col("timestamp")) for c in ("open", "close")}
    return (
        bars.withColumn("year_month", F.date_format("timestamp", "yyyy-MM"))
        .groupBy("symbol", "year_month")
        .agg(
            F.min_by("open", known["open"]).alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", known["close"]).alias("close"),
            F.sum("volume").alias("volume"),
            F.min("timestamp").alias("timestamp"),
            F.stddev_samp("close").alias("volatility"),
        )
    )


def across_months(months: DataFrame) -> DataFrame:
    """Add to rows of ``month_bars`` what looks at the months before: the return and the 3-month average."""
    by_month = Window.partitionBy("symbol").orderBy("year_month")
    three = by_month.rowsBetween(-2, 0)
    return months.select(
        "symbol",
        "year_month",
        "open",
        "high",
        "low",
        "close",
        "volume",
        "timestamp",
        ((F.try_divide(F.col("close"), F.lag("close").over(by_month)) - 1) * 100).alias("monthly_return"),
        F.when(F.count("close").over(three) >= 3, F.avg("close").over(three)).alias("ma_3m"),
        "volatility",
    )


FIVE = ("min", "max", "mean", "std", "median")
SHOWN = ("min", "max", "mean", "median", "std")


def _basics(column: str) -> list[Column]:
    return [F.min(column), F.max(column), F.avg(column), F.stddev_samp(column)]


def _median(column: str) -> Column:
    return F.median(column).cast("double")


def five_numbers(bars: DataFrame, column: str, grain: str = "day") -> DataFrame:
    """min, max, mean, median and sample deviation of a column per symbol."""
    basics = [c.alias(n) for n, c in zip(FIVE, _basics(column))]
    if not is_sliced(grain):
        return bars.groupBy("symbol").agg(*basics, _median(column).alias("median")).select("symbol", *SHOWN)
    rest = bars.groupBy("symbol").agg(*basics)
    return rest.join(bracketed_median(bars, column), "symbol", "left").select("symbol", *SHOWN)


def bracketed_median(bars: DataFrame, column: str, accuracy: int = 10_000) -> DataFrame:
    """Exact median without holding a symbol's values in one task.

    A quantile sketch brackets the median, one aggregation counts what lies below and inside the bracket,
    and only the distinct values inside are ranked. Should a bracket miss the median, that symbol's whole
    range is ranked instead.
    """
    values = bars.select("symbol", F.col(column).cast("double").alias("x")).where("x IS NOT NULL")
    margin = 5.0 / accuracy
    quantiles = F.percentile_approx("x", [0.5 - margin, 0.5 + margin], accuracy)
    bounds = values.groupBy("symbol").agg(
        quantiles[0].alias("lo"), quantiles[1].alias("hi"), F.count("*").alias("n"), F.min("x").alias("x0"), F.max("x").alias("x1")
    )
    tallied = (
        values.join(bounds.select("symbol", "lo", "hi"), "symbol")
        .groupBy("symbol")
        .agg(F.count_if(F.col("x") < F.col("lo")).alias("below"), F.count_if(F.col("x").between(F.col("lo"), F.col("hi"))).alias("inside"))
    )
    low_rank, high_rank = F.floor((F.col("n") + 1) / 2), F.floor(F.col("n") / 2) + 1
    hit = (F.col("below") < low_rank) & (F.col("below") + F.col("inside") >= high_rank)
    brackets = bounds.join(tallied, "symbol").select(
        "symbol",
        low_rank.alias("low_rank"),
        high_rank.alias("high_rank"),
        F.when(hit, F.col("lo")).otherwise(F.col("x0")).alias("lo"),
        F.when(hit, F.col("hi")).otherwise(F.col("x1")).alias("hi"),
        F.when(hit, F.col("below")).otherwise(F.lit(0)).alias("below"),
    )
    candidates = (
        values.join(brackets, "symbol")
        .where(F.col("x").between(F.col("lo"), F.col("hi")))
        .groupBy("symbol", "low_rank", "high_rank", "below", "x")
        .agg(F.count("*").alias("copies"))
    )
    rising = Window.partitionBy("symbol").orderBy("x").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = candidates.withColumn("upto", F.col("below") + F.sum("copies").over(rising))

    def value_at(rank: str) -> Column:
        return F.min(F.when(F.col("upto") >= F.col(rank), F.col("x")))

    return ranked.groupBy("symbol").agg(((value_at("low_rank") + value_at("high_rank")) / 2).alias("median"))


def price_stats(bars: DataFrame, grain: str = "day") -> DataFrame:
    return five_numbers(bars, "close", grain)


def volume_stats(bars: DataFrame, grain: str = "day") -> DataFrame:
    return five_numbers(with_optional(bars, volume="bigint"), "volume", grain)


def return_stats(bars: DataFrame, grain: str = "day") -> DataFrame:
    """Daily returns in percent, their deviation, and the total return in percent; needs two bars."""
    rows = indicators(bars.select("symbol", "timestamp", "close"), ["daily_return"], grain=grain)
    return (
        rows.groupBy("symbol")
        .agg(*_return_aggregates(), _total_return().alias("total_return_pct"), F.count("*").alias("bars"))
        .where("bars > 1")
        .drop("bars")
    )


def _return_aggregates() -> list[Column]:
    percent = F.col("daily_return") * 100
    spread = F.stddev_samp(percent)
    return [
        F.min(percent).alias("min_daily_return"),
        F.max(percent).alias("max_daily_return"),
        F.avg(percent).alias("mean_daily_return"),
        spread.alias("volatility"),
        (spread * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("annualized_volatility"),
    ]


def _total_return() -> Column:
    return total_return(F.min_by("close", "timestamp"), F.max_by("close", "timestamp")) * 100


def time_range(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(*_time_aggregates())


def _time_aggregates() -> list[Column]:
    start, end = F.min("timestamp"), F.max("timestamp")
    return [
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(end, "yyyy-MM-dd").alias("end_date"),
        days_between(start, end).alias("days"),
        F.count("*").alias("trading_days"),
    ]


def current_trend(silver: DataFrame) -> DataFrame:
    """Newest close against its ``sma_20``; equality counts as bearish, no average means no row."""
    require_columns(silver, "symbol", "timestamp", "close", "sma_20")
    newest = silver.groupBy("symbol").agg(*[F.max_by(c, "timestamp").alias(c) for c in ("close", "sma_20")])
    return newest.where("sma_20 IS NOT NULL").select("symbol", *_trend_columns())


def _trend_columns() -> list[Column]:
    close, average = F.col("close"), F.col("sma_20")
    return [
        F.when(close > average, "bullish").otherwise("bearish").alias("direction"),
        (F.abs(F.try_divide(close - average, average)) * 100).alias("strength"),
    ]


def statistics(silver: DataFrame, grain: str = "day") -> DataFrame:
    """All gold statistics of a symbol as nested columns for the JSON sink, in one aggregation.

    Only the exact medians of intraday series take passes of their own.
    """
    require_columns(silver, "symbol", "timestamp", "close")
    optional = [c for c in ("volume", "sma_20") if c in silver.columns]
    measured = ["close", *(["volume"] if "volume" in optional else [])]
    rows = indicators(silver.select("symbol", "timestamp", "close", *optional), ["daily_return"], grain=grain)
    exact = not is_sliced(grain)

    def five(column: str) -> list[Column]:
        named = _basics(column) + ([_median(column)] if exact else [])
        return [c.alias(f"{column}_{n}") for n, c in zip(FIVE, named)]

    flat = rows.groupBy("symbol").agg(
        *[c for column in measured for c in five(column)],
        *_return_aggregates(),
        _total_return().alias("total_return_pct"),
        *_time_aggregates(),
        *[F.max_by(c, "timestamp").alias(c) for c in ("close", "sma_20") if c in silver.columns],
    )
    if not exact:
        for column in measured:
            median = bracketed_median(silver, column).withColumnRenamed("median", f"{column}_median")
            flat = flat.join(median, "symbol", "left")
    return _nested_statistics(flat, measured, "sma_20" in optional)


# --- statistics from states that are stored by month ------------------------------------------------------

MEASURES = ("close", "volume", "change")


def month_states(silver: DataFrame, values: bool = True) -> DataFrame:
    """What a symbol's month contributes to the statistics, by itself: counts, means, squared deviations, extremes, ends.

    ``change`` is the daily return in percent within the month; the one across its beginning follows from the ends. With ``values``
    the sorted closes and volumes are kept too, for the exact medians: a month holds few of them, by the calendar, from the grain of a day upward.
    """
    require_columns(silver, "symbol", "timestamp", "close")
    bars = with_optional(silver, volume="bigint", sma_20="double").withColumn("year_month", F.date_format("timestamp", "yyyy-MM"))
    before = F.lag("close").over(Window.partitionBy("symbol", "year_month").orderBy("timestamp"))
    bars = bars.withColumn("change", (F.try_divide(F.col("close"), before) - 1) * 100)

    def state(c: str) -> list[Column]:
        parts = {"n": F.count(c), "mean": F.avg(c), "m2": F.var_pop(c) * F.count(c), "min": F.min(c), "max": F.max(c)}
        return [v.alias(f"{c}_{k}") for k, v in parts.items()]

    kept = [F.sort_array(F.collect_list(c)).alias(f"{c}_values") for c in ("close", "volume")] if values else []
    return bars.groupBy("symbol", "year_month").agg(
        F.count("*").alias("bars"),
        F.min("timestamp").alias("first_time"),
        F.max("timestamp").alias("last_time"),
        F.min_by("close", "timestamp").alias("first_close"),
        F.max_by("close", "timestamp").alias("last_close"),
        F.max_by("sma_20", "timestamp").alias("sma_20"),
        *[c for m in MEASURES for c in state(m)],
        *kept,
    )


def merged_statistics(states: DataFrame, medians: DataFrame | None = None) -> DataFrame:
    """``statistics`` of all months of ``month_states``, their states merged pairwise exactly as one pass would sum them.

    ``medians`` (symbol, close_median, volume_median) stands in for states without values.
    """
    by_month = Window.partitionBy("symbol").orderBy("year_month")
    whole = Window.partitionBy("symbol")
    across = (F.try_divide(F.col("first_close"), F.lag("last_close").over(by_month)) - 1) * 100
    rows = states.withColumn("across", across).withColumn(
        "change_sum", F.coalesce(F.col("change_mean") * F.col("change_n"), F.lit(0.0)) + F.coalesce("across", F.lit(0.0))
    )
    rows = rows.withColumn("change_count", F.col("change_n") + F.when(F.col("across").isNull(), 0).otherwise(1))
    sums = {m: (f"{m}_mean", F.sum(F.col(f"{m}_mean") * F.col(f"{m}_n")).over(whole), F.sum(f"{m}_n").over(whole)) for m in ("close", "volume")}
    sums["change"] = ("change_mean", F.sum("change_sum").over(whole), F.sum("change_count").over(whole))
    rows = rows.withColumns({f"{m}_all": F.try_divide(total, n) for m, (_, total, n) in sums.items()})

    def spread(m: str, n: str, more: Column | None = None) -> Column:
        """Sample deviation: squares within months, and of the months' means about the mean of all."""
        off = F.col(f"{m}_mean") - F.col(f"{m}_all")
        squares = F.sum(F.col(f"{m}_m2") + F.col(f"{m}_n") * off * off)
        if more is not None:
            squares = F.coalesce(squares, F.lit(0.0)) + F.coalesce(F.sum(more), F.lit(0.0))
        return F.when(F.sum(n) > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (F.sum(n) - 1)))

    def five(m: str) -> list[Column]:
        parts = {"min": F.min(f"{m}_min"), "max": F.max(f"{m}_max"), "mean": F.first(f"{m}_all"), "std": spread(m, f"{m}_n")}
        if medians is None:
            parts["median"] = _middle(F.sort_array(F.flatten(F.collect_list(f"{m}_values"))))
        return [v.alias(f"{m}_{k}") for k, v in parts.items()]

    deviation = spread("change", "change_count", (F.col("across") - F.col("change_all")) * (F.col("across") - F.col("change_all")))
    start, end = F.min("first_time"), F.max("last_time")
    flat = rows.groupBy("symbol").agg(
        *five("close"),
        *five("volume"),
        F.min(F.least("change_min", "across")).alias("min_daily_return"),
        F.max(F.greatest("change_max", "across")).alias("max_daily_return"),
        F.first("change_all").alias("mean_daily_return"),
        deviation.alias("volatility"),
        (deviation * F.sqrt(F.lit(float(TRADING_DAYS)))).alias("annualized_volatility"),
        (total_return(F.min_by("first_close", "year_month"), F.max_by("last_close", "year_month")) * 100).alias("total_return_pct"),
        F.date_format(start, "yyyy-MM-dd").alias("start_date"),
        F.date_format(end, "yyyy-MM-dd").alias("end_date"),
        days_between(start, end).alias("days"),
        F.sum("bars").alias("trading_days"),
        F.max_by("last_close", "year_month").alias("close"),
        F.max_by("sma_20", "year_month").alias("sma_20"),
    )
    if medians is not None:
        flat = flat.join(medians, "symbol", "left")
    return _nested_statistics(flat, ["close", "volume"], True)


def _middle(values: Column) -> Column:
    n = F.size(values)
    low, high = F.get(values, F.floor((n - 1) / 2).cast("int")), F.get(values, F.floor(n / 2).cast("int"))
    return F.when(n > 0, (low + high) / 2)


def _nested_statistics(flat: DataFrame, measured: list[str], trend: bool) -> DataFrame:
    several = F.col("trading_days") > 1
    returns = ["min_daily_return", "max_daily_return", "mean_daily_return", "volatility", "annualized_volatility"]

    def nested(column: str) -> Column:
        return F.struct(*[F.col(f"{column}_{n}").alias(n) for n in SHOWN])

    parts = [
        nested("close").alias("price_stats"),
        F.when(several, F.struct(*returns)).alias("return_stats"),
        F.when(several, F.col("total_return_pct")).alias("total_return_pct"),
        F.struct("start_date", "end_date", "days", "trading_days").alias("time_range"),
    ]
    if "volume" in measured:
        parts.append(nested("volume").alias("volume_stats"))
    if trend:
        parts.append(F.when(F.col("sma_20").isNotNull(), F.struct(*_trend_columns())).alias("current_trend"))
    return flat.select("symbol", *parts)
