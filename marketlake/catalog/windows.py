"""Indicator queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.catalog.registry import BY_TIME, CHANGES, DAILY, EVENT_DAYS, HOURLY, RSI, SQL, full, over, query
from marketlake.operators import batch
from marketlake.operators.indicators import ema as ema_of
from marketlake.operators.indicators import indicators, register_indicator
from marketlake.operators.recurrence import ema_over_gaps
from marketlake.session import workspace
from marketlake.sources.bars import bars_customers, bars_daily, bars_events, bars_seconds
from marketlake.sources.store import read_documents, write_documents

KEY = ["symbol", "timestamp"]


@query(
    "silver_bars",
    f"""WITH {DAILY}, {CHANGES}
SELECT symbol, "timestamp", open, high, low, close, volume,
       round({full('avg', 'close', 20)}, 6) AS sma_20, round({RSI}, 6) AS rsi_14 FROM sided""",
)
def silver_bars(spark, folder):
    return batch.silver_bars(bars_daily(spark, folder))


@query(
    "silver_bars_hourly",
    f"""WITH {HOURLY}, {CHANGES}
SELECT symbol, "timestamp", open, high, low, close, volume,
       round({full('avg', 'close', 20)}, 6) AS sma_20, round({RSI}, 6) AS rsi_14 FROM sided""",
)
def silver_bars_hourly(spark, folder):
    """The intraday path: history cut into slices with halos."""
    return indicators(bars_events(spark, folder), ["sma_20", "rsi_14"], grain="hour", slice_bars=256)


CUSTOMERS = DAILY.replace("o_orderstatus AS symbol", "CAST(o_custkey AS VARCHAR) AS symbol")
SECONDS = """ticks AS (
  SELECT 'all' AS symbol, ts, event_id, value FROM events
  UNION ALL SELECT 'user ' || user_id, ts, event_id, value FROM events WHERE user_id IS NOT NULL),
bars AS (
  SELECT symbol, CAST(date_trunc('second', ts) AS TIMESTAMP) AS "timestamp", first(value ORDER BY ts, event_id) AS open, max(value) AS high,
         min(value) AS low, last(value ORDER BY ts, event_id) AS close, count(*) AS volume
  FROM ticks GROUP BY 1, 2)"""


def silver_sql(bars: str) -> str:
    return f"""WITH {bars}, {CHANGES}
SELECT symbol, "timestamp", close, volume, round({full('avg', 'close', 5)}, 4) AS sma_5, round({full('avg', 'close', 20)}, 4) AS sma_20,
       round({full('avg', 'true_range', 14)}, 4) AS atr_14 FROM sided"""


@query("many_symbols", silver_sql(CUSTOMERS), places=4)
def many_symbols(spark, folder):
    """Moving averages of many short histories."""
    names = ["sma_5", "sma_20", "atr_14"]
    return indicators(bars_customers(spark, folder), names).select(*KEY, "close", "volume", *names)


@query("hot_series", silver_sql(SECONDS), places=4)
def hot_series(spark, folder):
    """Moving averages of one-second bars, one history of which holds most rows, in over a hundred slices."""
    names = ["sma_5", "sma_20", "atr_14"]
    return indicators(bars_seconds(spark, folder), names, grain="second").select(*KEY, "close", "volume", *names)


# What a slice of the smallest tables holds, so that they are cut too.
SLICE = 512


@query(
    "sma",
    f"""WITH {DAILY} SELECT symbol, "timestamp", round({full('avg', 'close', 5)}, 6) AS sma_5,
       round({full('avg', 'close', 20)}, 6) AS sma_20, round({full('avg', 'close', 50)}, 6) AS sma_50 FROM bars""",
)
def sma(spark, folder):
    names = ["sma_5", "sma_20", "sma_50"]
    return indicators(bars_daily(spark, folder), names).select(*KEY, *names)


@query(
    "sma_partial",
    f"""WITH {DAILY} SELECT symbol, "timestamp", round(avg(close) {over(5)}, 4) AS sma_5,
       round(avg(close) {over(20)}, 4) AS sma_20, round(avg(close) {over(50)}, 4) AS sma_50 FROM bars""",
    places=4,
)
def sma_partial(spark, folder):
    names = ["sma_5", "sma_20", "sma_50"]
    return indicators(bars_daily(spark, folder), names, warmup="partial").select(*KEY, *names)


def recursive(bars: str, columns: str) -> str:
    """Exponential averages by recursion over row numbers."""

    def step(name: str, span: int) -> str:
        return f"(2e0 / {span + 1}) * n.close + (1 - 2e0 / {span + 1}) * e.{name}"

    fast, slow = step("fast", 12), step("slow", 26)
    return f"""WITH RECURSIVE {bars},
n AS (SELECT symbol, "timestamp", close, row_number() OVER ({BY_TIME}) AS rn FROM bars),
e AS (
  SELECT symbol, "timestamp", close, rn, close AS ema_5, close AS ema_20, close AS fast, close AS slow,
         CAST(0 AS DOUBLE) AS signal FROM n WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n."timestamp", n.close, n.rn, {step('ema_5', 5)}, {step('ema_20', 20)}, {fast}, {slow},
         (2e0 / 10) * (({fast}) - ({slow})) + (1 - 2e0 / 10) * e.signal
  FROM e JOIN n ON n.symbol = e.symbol AND n.rn = e.rn + 1)
SELECT symbol, "timestamp", {columns} FROM e"""


EMAS = "round(ema_5, 4) AS ema_5, round(ema_20, 4) AS ema_20"
MACDS = """round(fast - slow, 4) AS macd, round(signal, 4) AS macd_signal,
       round(fast - slow - signal, 4) AS macd_histogram"""


@query("ema", recursive(DAILY, EMAS), places=4)
def ema(spark, folder):
    return indicators(bars_daily(spark, folder), ["ema_5", "ema_20"]).select(*KEY, "ema_5", "ema_20")


@query("ema_hourly", recursive(HOURLY, EMAS), places=4)
def ema_hourly(spark, folder):
    bars = bars_events(spark, folder)
    return indicators(bars, ["ema_5", "ema_20"], grain="hour", slice_bars=512).select(*KEY, "ema_5", "ema_20")


@query("macd_scan", recursive(SECONDS, MACDS), places=4)
def macd_scan(spark, folder):
    """Averages of averages over irregular seconds, carried from slice to slice without a halo."""
    names = ["macd", "macd_signal", "macd_histogram"]
    return indicators(bars_seconds(spark, folder), ["macd"], grain="second", slice_bars=SLICE).select(*KEY, *names)


@query(
    "ema_gaps",
    f"""WITH RECURSIVE {DAILY},
n AS (SELECT symbol, "timestamp", CASE WHEN dayofmonth("timestamp") % 7 <> 3 THEN close END AS close, row_number() OVER ({BY_TIME}) AS rn FROM bars),
e AS (
  SELECT symbol, "timestamp", rn, close AS ema_20, CAST(1 AS DOUBLE) AS kept FROM n WHERE rn = 1
  UNION ALL
  SELECT n.symbol, n."timestamp", n.rn,
         CASE WHEN n.close IS NULL THEN e.ema_20 WHEN e.ema_20 IS NULL THEN n.close
              ELSE (e.kept * (19e0 / 21) * e.ema_20 + (2e0 / 21) * n.close) / (e.kept * (19e0 / 21) + 2e0 / 21) END,
         CASE WHEN n.close IS NULL AND e.ema_20 IS NOT NULL THEN e.kept * (19e0 / 21) ELSE 1e0 END
  FROM e JOIN n ON n.symbol = e.symbol AND n.rn = e.rn + 1)
SELECT symbol, "timestamp", round(ema_20, 4) AS ema_20 FROM e""",
    places=4,
)
def ema_gaps(spark, folder):
    """Weights that decay over missing closes too."""
    bars = bars_daily(spark, folder)
    holes = bars.withColumn("close", F.when(F.dayofmonth("timestamp") % 7 != 3, F.col("close")))
    return ema_over_gaps(holes, 20).select(*KEY, "ema_20")


@query("ema_far_spans", recursive(DAILY, "round(ema_5, 4) AS ema_5, round(ema_20, 4) AS ema_200").replace("/ 21", "/ 201"), places=4)
def ema_far_spans(spark, folder):
    """Spans too far apart to share blocks."""
    register_indicator("ema_200", ema_of(200))
    return indicators(bars_daily(spark, folder), ["ema_5", "ema_200"]).select(*KEY, "ema_5", "ema_200")


@query("macd_sliced", recursive(HOURLY, MACDS), places=4)
def macd_sliced(spark, folder):
    """Sliced finely: eight slices or more of every symbol, whose halos reach over several of them."""
    names = ["macd", "macd_signal", "macd_histogram"]
    return indicators(bars_events(spark, folder), ["macd"], grain="hour", slice_bars=80).select(*KEY, *names)


@query("macd", recursive(DAILY, MACDS), places=4)
def macd(spark, folder):
    names = ["macd", "macd_signal", "macd_histogram"]
    return indicators(bars_daily(spark, folder), ["macd"], gated=True).select(*KEY, *names)


@query("rsi", f"""WITH {DAILY}, {CHANGES} SELECT symbol, "timestamp", round({RSI}, 6) AS rsi_14 FROM sided""")
def rsi(spark, folder):
    return indicators(bars_daily(spark, folder), ["rsi_14"]).select(*KEY, "rsi_14")


@query(
    "rsi_partial",
    f"""WITH {DAILY}, {CHANGES},
zeroed AS (SELECT *, coalesce(gain, 0) AS g, coalesce(loss, 0) AS l FROM sided)
SELECT symbol, "timestamp", round(CASE WHEN avg(l) {over(14)} = 0 THEN 100
       ELSE 100 - 100 / (1 + avg(g) {over(14)} / avg(l) {over(14)}) END, 6) AS rsi_14 FROM zeroed""",
)
def rsi_partial(spark, folder):
    return indicators(bars_daily(spark, folder), ["rsi_14"], warmup="partial").select(*KEY, "rsi_14")


BANDS = f"""round(mid + 2 * sd, 6) AS bb_upper, round(mid, 6) AS bb_middle, round(mid - 2 * sd, 6) AS bb_lower
FROM (SELECT *, {full('avg', 'close', 20)} AS mid, {full('stddev_samp', 'close', 20)} AS sd FROM bars)"""


@query("bollinger", f"""WITH {DAILY} SELECT symbol, "timestamp", {BANDS}""")
def bollinger(spark, folder):
    return indicators(bars_daily(spark, folder), ["bollinger"]).select(*KEY, "bb_upper", "bb_middle", "bb_lower")


@query(
    "daily_return",
    f"""WITH {DAILY}, {CHANGES} SELECT symbol, "timestamp", round(daily_return, 6) AS daily_return FROM sided""",
)
def daily_return(spark, folder):
    return indicators(bars_daily(spark, folder), ["daily_return"]).select(*KEY, "daily_return")


@query(
    "atr",
    f"""WITH {DAILY}, {CHANGES} SELECT symbol, "timestamp", round(true_range, 6) AS true_range,
       round({full('avg', 'true_range', 14)}, 6) AS atr_14 FROM sided""",
)
def atr(spark, folder):
    return indicators(bars_daily(spark, folder), ["true_range", "atr_14"]).select(*KEY, "true_range", "atr_14")


NEAR = f"OVER ({BY_TIME} ROWS BETWEEN 5 PRECEDING AND 5 FOLLOWING)"
PIVOTS = f"""pivots AS (
  SELECT symbol, "timestamp", close AS price,
         CASE WHEN count(*) {NEAR} = 11 THEN CASE WHEN close = max(close) {NEAR} THEN 'resistance'
              WHEN close = min(close) {NEAR} THEN 'support' END END AS pivot_type,
         count(*) OVER (PARTITION BY symbol) AS bars FROM bars)"""
FOUND = """SELECT symbol, "timestamp", price, pivot_type FROM pivots WHERE pivot_type IS NOT NULL"""


@query("pivot_points", f"WITH {DAILY}, {PIVOTS} {FOUND}")
def pivot_points(spark, folder):
    return batch.pivot_points(bars_daily(spark, folder))


@query("pivot_points_hourly", f"WITH {HOURLY}, {PIVOTS} {FOUND}")
def pivot_points_hourly(spark, folder):
    found = indicators(bars_events(spark, folder), ["pivots"], grain="hour", slice_bars=256)
    return found.where("pivot_type IS NOT NULL").select(*KEY, F.col("close").alias("price"), "pivot_type")


WIDE = f"""WITH {{bars}}, {CHANGES}
SELECT symbol, "timestamp", round({full('avg', 'close', 5)}, 6) AS sma_5, round({full('avg', 'close', 20)}, 6) AS sma_20,
       round({full('avg', 'close', 50)}, 6) AS sma_50, round({RSI}, 6) AS rsi_14,
       round({full('avg', 'true_range', 14)}, 6) AS atr_14, round(daily_return, 6) AS daily_return,
       round({full('avg', 'close', 20)} + 2 * {full('stddev_samp', 'close', 20)}, 6) AS bb_upper,
       round({full('avg', 'close', 20)} - 2 * {full('stddev_samp', 'close', 20)}, 6) AS bb_lower
FROM sided"""
WIDE_COLUMNS = ["sma_5", "sma_20", "sma_50", "rsi_14", "atr_14", "daily_return", "bb_upper", "bb_lower"]


@query(
    "indicators_wide",
    f"""WITH w AS ({WIDE.format(bars=DAILY)}), m AS ({recursive(DAILY, EMAS + ', ' + MACDS)})
SELECT w.*, m.ema_5, m.ema_20, m.macd, m.macd_signal, m.macd_histogram FROM w JOIN m USING (symbol, "timestamp")""",
)
def indicators_wide(spark, folder):
    """Every indicator of every symbol in one plan; the exponential ones to four places."""
    wide = batch.indicators_wide(bars_daily(spark, folder))
    averages = ["ema_5", "ema_20", "macd", "macd_signal", "macd_histogram"]
    return wide.select(*KEY, *WIDE_COLUMNS, *[F.round(c, 4).alias(c) for c in averages])


def wide_sql(bars: str) -> str:
    return f"""WITH w AS ({WIDE.format(bars=bars)}), m AS ({recursive(bars, EMAS + ', ' + MACDS)})
SELECT w.*, m.ema_5, m.ema_20, m.macd, m.macd_signal, m.macd_histogram FROM w JOIN m USING (symbol, "timestamp")"""


def all_columns(wide):
    averages = ["ema_5", "ema_20", "macd", "macd_signal", "macd_histogram"]
    return wide.select(*KEY, *WIDE_COLUMNS, *[F.round(c, 4).alias(c) for c in averages])


@query("indicators_wide_hourly", wide_sql(HOURLY))
def indicators_wide_hourly(spark, folder):
    return all_columns(batch.indicators_wide(bars_events(spark, folder), grain="hour"))


@query("indicators_wide_sliced", wide_sql(HOURLY))
def indicators_wide_sliced(spark, folder):
    """Eight slices or more of every symbol."""
    return all_columns(indicators(bars_events(spark, folder), batch.WIDE, grain="hour", slice_bars=80, gated=True))


@query(
    "indicator_gates",
    f"""WITH {EVENT_DAYS}, n AS (SELECT symbol, count(*) AS bars FROM bars GROUP BY 1)
SELECT symbol, bars, {', '.join(f'bars >= {k} AS has_{n}' for n, k in batch.MIN_BARS.items())} FROM n""",
)
def indicator_gates(spark, folder):
    return batch.indicator_gates(bars_events(spark, folder, "day"))


@query(
    "support_resistance",
    f"""WITH {DAILY}, {PIVOTS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol, pivot_type ORDER BY "timestamp" DESC) AS newest,
         least(3, count(*) OVER (PARTITION BY symbol, pivot_type)) AS held
  FROM pivots WHERE pivot_type IS NOT NULL AND bars >= 30)
SELECT symbol, pivot_type, CAST(held - newest AS INTEGER) AS place, price FROM ranked WHERE newest <= 3""",
)
def support_resistance(spark, folder):
    """The levels, one row each, oldest first."""
    levels = batch.support_resistance(bars_daily(spark, folder))
    kinds = F.create_map(
        F.lit("support"), F.col("support_levels"), F.lit("resistance"), F.col("resistance_levels")
    )
    long = levels.select("symbol", F.explode(kinds).alias("pivot_type", "prices"))
    return long.select("symbol", "pivot_type", F.posexplode("prices").alias("place", "price"))


def trend_sql(bars: str) -> str:
    return f"""WITH {bars}, averaged AS (
  SELECT symbol, "timestamp", close, {full('avg', 'close', 20)} AS s20, {full('avg', 'close', 50)} AS s50,
         count(*) OVER (PARTITION BY symbol) AS n, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS age
  FROM bars)
SELECT symbol, CASE WHEN s50 IS NOT NULL THEN
         CASE WHEN close > s20 AND s20 > s50 THEN 'bullish' WHEN close < s20 AND s20 < s50 THEN 'bearish' ELSE 'sideways' END
       ELSE CASE WHEN close > s20 THEN 'bullish' WHEN close < s20 THEN 'bearish' ELSE 'sideways' END END AS trend,
       round(abs(close - coalesce(s50, s20)) / coalesce(s50, s20), 6) AS strength
FROM averaged WHERE age = 1 AND n >= 20"""


@query("trend", trend_sql(DAILY))
def trend(spark, folder):
    return batch.trend(bars_daily(spark, folder))


@query("trend_short_history", trend_sql(EVENT_DAYS))
def trend_short_history(spark, folder):
    """Thirty bars per symbol: the branch without a 50-bar average."""
    return batch.trend(bars_events(spark, folder, "day"))


@query(
    "batch_statistics",
    f"""WITH {DAILY}, {CHANGES}
SELECT symbol, min("timestamp") AS start_date, max("timestamp") AS end_date,
       CAST(date_diff('second', min("timestamp"), max("timestamp")) // 86400 AS BIGINT) AS days,
       min(close) AS min_price, max(close) AS max_price, round(avg(close), 6) AS avg_price,
       min(volume) AS min_volume, max(volume) AS max_volume, round(avg(volume), 6) AS avg_volume,
       round(avg(daily_return), 6) AS avg_daily_return, round(stddev_samp(daily_return), 6) AS std_daily_return,
       round((arg_max(close, "timestamp") - arg_min(close, "timestamp")) / arg_min(close, "timestamp"), 6) AS total_return
FROM sided GROUP BY symbol""",
)
def batch_statistics(spark, folder):
    return batch.batch_statistics(bars_daily(spark, folder))


@query(
    "volatility",
    f"""WITH {DAILY}, {CHANGES}, ranged AS (SELECT *, {full('avg', 'true_range', 14)} AS atr FROM sided)
SELECT symbol, round(stddev_samp(daily_return), 6) AS daily, round(stddev_samp(daily_return) * sqrt(252), 6) AS annualized,
       round(arg_max(atr, "timestamp"), 6) AS atr_14 FROM ranged GROUP BY symbol""",
)
def volatility(spark, folder):
    return batch.volatility(bars_daily(spark, folder))


@query("indicator_document")
def indicator_document(spark, folder):
    """The documents, written as JSON lines and read back; the three queries below read all their parts."""
    path = workspace(spark, "indicators")
    write_documents(batch.indicator_document(bars_daily(spark, folder)), path, workspace(spark, "staging"))
    return read_documents(spark, path).select("symbol", "document")


@query(
    "indicator_document_summary",
    f"""WITH s AS ({SQL['batch_statistics']}), v AS ({SQL['volatility']}), t AS ({SQL['trend']}), l AS ({SQL['support_resistance']}),
n AS (WITH {DAILY} SELECT symbol, count(*) AS bars FROM bars GROUP BY 1)
SELECT symbol, strftime(start_date, '%Y-%m-%dT%H:%M:%S') AS start_date, days, avg_price, max_volume, std_daily_return, total_return, daily, annualized, atr_14,
       strftime(end_date, '%Y-%m-%dT%H:%M:%S') AS end_date, trend, strength,
       (SELECT string_agg(CAST(price AS VARCHAR), ' ' ORDER BY place) FROM l WHERE l.symbol = s.symbol AND pivot_type = 'support') AS supports,
       (SELECT string_agg(CAST(price AS VARCHAR), ' ' ORDER BY place) FROM l WHERE l.symbol = s.symbol AND pivot_type = 'resistance') AS resistances,
       CAST(bars - 49 AS INTEGER) AS sma_50_points, CAST(bars AS INTEGER) AS macd_points
FROM s JOIN v USING (symbol) JOIN t USING (symbol) JOIN n USING (symbol)""",
)
def indicator_document_summary(spark, folder):
    """The single values of the daily documents, written as JSON lines and read back, and the lengths of two series."""
    schema = """sma_50 array<struct<value: double>>, macd struct<signal: array<struct<value: double>>>,
        statistics struct<start_date: string, end_date: string, days: bigint, avg_price: double, max_volume: bigint, std_daily_return: double, total_return: double>,
        volatility struct<daily: double, annualized: double, atr_14: double>,
        trends struct<current: string, strength: double, support_levels: array<double>, resistance_levels: array<double>>"""
    path = workspace(spark, "indicators")
    write_documents(batch.indicator_document(bars_daily(spark, folder)), path, workspace(spark, "staging"))
    parsed = read_documents(spark, path).select("symbol", F.from_json("document", schema).alias("d")).select("symbol", "d.*")
    return parsed.select(
        "symbol",
        "statistics.*",
        "volatility.*",
        F.col("trends.current").alias("trend"),
        "trends.strength",
        F.array_join(F.transform("trends.support_levels", lambda x: x.cast("string")), " ").alias("supports"),
        F.array_join(F.transform("trends.resistance_levels", lambda x: x.cast("string")), " ").alias("resistances"),
        F.size("sma_50").alias("sma_50_points"),
        F.size("macd.signal").alias("macd_points"),
    )


BAND = f"{full('avg', 'close', 20)} {{sign}} 2 * {full('stddev_samp', 'close', 20)}"
DOCUMENT_SERIES = {
    "sma_5": ("$.sma_5", full("avg", "close", 5)),
    "sma_20": ("$.sma_20", full("avg", "close", 20)),
    "sma_50": ("$.sma_50", full("avg", "close", 50)),
    "rsi_14": ("$.rsi_14", RSI),
    "bb_upper": ("$.bollinger_bands.upper", BAND.format(sign="+")),
    "bb_middle": ("$.bollinger_bands.middle", full("avg", "close", 20)),
    "bb_lower": ("$.bollinger_bands.lower", BAND.format(sign="-")),
}
AVERAGE_SERIES = {
    "ema_5": ("$.ema_5", "ema_5"),
    "ema_20": ("$.ema_20", "ema_20"),
    "macd": ("$.macd.macd", "macd"),
    "macd_signal": ("$.macd.signal", "macd_signal"),
    "macd_histogram": ("$.macd.histogram", "macd_histogram"),
}


def series_sql(source: str, wanted: dict[str, tuple[str, str]], places: int) -> str:
    return " UNION ALL ".join(
        f"""SELECT symbol, '{n}' AS series, strftime("timestamp", '%Y-%m-%dT%H:%M:%S') AS "timestamp", round(v, {places}) AS value
FROM (SELECT symbol, "timestamp", {sql} AS v FROM {source}) WHERE v IS NOT NULL"""
        for n, (_, sql) in wanted.items()
    )


def series_of(documents, wanted: dict[str, tuple[str, str]]):
    """The series of documents as rows."""
    point = "array<struct<timestamp: string, value: double>>"
    series = F.array(
        *[
            F.struct(F.lit(n).alias("series"), F.from_json(F.get_json_object("document", path), point).alias("points"))
            for n, (path, _) in wanted.items()
        ]
    )
    rows = documents.select("symbol", F.explode(series).alias("s"))
    points = rows.select("symbol", "s.series", F.explode("s.points").alias("p"))
    return points.select("symbol", "series", "p.timestamp", "p.value")


@query("indicator_document_series", f"WITH {HOURLY}, {CHANGES} {series_sql('sided', DOCUMENT_SERIES, 6)}")
def indicator_document_series(spark, folder):
    """The documents, one per symbol and month, read back into rows."""
    return series_of(batch.indicator_document(bars_events(spark, folder), grain="hour", period="month"), DOCUMENT_SERIES)


@query("indicator_document_averages", f"WITH m AS ({recursive(HOURLY, EMAS + ', ' + MACDS)}) {series_sql('m', AVERAGE_SERIES, 4)}", places=4)
def indicator_document_averages(spark, folder):
    """The exponential series of documents by week."""
    return series_of(batch.indicator_document(bars_events(spark, folder), grain="hour", period="week"), AVERAGE_SERIES)
