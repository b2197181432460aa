"""Queries on layers: cleaning, gold, stores, vendor payloads."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from marketlake.catalog.registry import BY_TIME, CHANGES, DAILY, HOURLY, RSI, full, query
from marketlake.functions.scalars import enrich_intraday, parse_iso, to_decimal
from marketlake.operators import batch, clean, gold
from marketlake.operators.indicators import indicators
from marketlake.plans import etl, report
from marketlake.plans import lake as lakes
from marketlake.schema import BAR_SCHEMA, SILVER_SCHEMA, conform_bars
from marketlake.session import workspace
from marketlake.sources import ranged, store, vendor
from marketlake.sources.bars import bars_customers, bars_daily, bars_events, table
from marketlake.sources.files import remove
from marketlake.sources.runs import RunTable

KEY = ["symbol", "timestamp"]
BAR = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
LANDED = datetime(2024, 1, 15, 10, 0)
START, END = datetime(1995, 1, 15), datetime(1997, 3, 20)


# --- cleaning ---------------------------------------------------------------------------------------


def raw_daily(spark, folder):
    """Daily bars as a vendor frame: vendor names, text time, gaps, and an older copy of every row."""
    bars = bars_daily(spark, folder)
    gap = F.dayofmonth("timestamp") == 13
    named = bars.select(
        "symbol",
        F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("timestamp"),
        F.col("open").alias("Open"),
        F.when(gap, F.lit(float("nan"))).otherwise(F.col("high")).alias("High"),
        F.col("low").alias("Low"),
        F.when(~gap, F.col("close")).alias("Close"),
        F.col("volume").alias("Volume"),
    )
    copies = F.explode(F.array(F.struct(F.lit(1).alias("v"), F.lit(0.5).alias("f")), F.struct(F.lit(2).alias("v"), F.lit(1.0).alias("f"))))
    doubled = named.withColumn("copy", copies)
    return doubled.withColumns(
        {"Close": F.col("Close") * F.col("copy.f"), "ingest_ts": F.timestamp_add("DAY", F.col("copy.v"), F.lit(LANDED))}
    ).drop("copy")


GAPPED = f"""{DAILY}, gapped AS (
  SELECT symbol, "timestamp", open, CASE WHEN day("timestamp") <> 13 THEN high END AS high, low,
         CASE WHEN day("timestamp") <> 13 THEN close END AS close, volume FROM bars)"""
SO_FAR = f"OVER ({BY_TIME} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
FILLED = f"""SELECT symbol, "timestamp", open, last_value(high IGNORE NULLS) {SO_FAR} AS high, low,
       last_value(close IGNORE NULLS) {SO_FAR} AS close, volume FROM gapped"""


@query("silver_clean", f"WITH {GAPPED} {FILLED}")
def silver_clean(spark, folder):
    return clean.clean(raw_daily(spark, folder), version=["ingest_ts"]).select(*BAR)


@query(
    "silver_ffill",
    f"""WITH {GAPPED} SELECT symbol, "timestamp", last_value(close IGNORE NULLS) {SO_FAR} AS close FROM gapped""",
)
def silver_ffill(spark, folder):
    gapped = bars_daily(spark, folder).withColumn("close", F.when(F.dayofmonth("timestamp") != 13, F.col("close")))
    return clean.forward_fill(gapped, ["close"]).select(*KEY, "close")


@query(
    "silver_ffill_hourly",
    f"""WITH {HOURLY}, gapped AS (SELECT symbol, "timestamp", CASE WHEN hour("timestamp") % 5 = 0 THEN close END AS close FROM bars)
SELECT symbol, "timestamp", last_value(close IGNORE NULLS) {SO_FAR} AS close FROM gapped""",
)
def silver_ffill_hourly(spark, folder):
    """The intraday path: values carried from slice to slice."""
    bars = bars_events(spark, folder).select(
        *KEY, F.when(F.hour("timestamp") % 5 == 0, F.col("close")).alias("close")
    )
    return clean.forward_fill(bars, ["close"], grain="hour", slice_bars=64)


@query("silver_dedup", f"WITH {DAILY} SELECT * FROM bars")
def silver_dedup(spark, folder):
    bars = bars_daily(spark, folder)
    return clean.drop_repeats(bars.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(3)))).drop("copy"))


@query(
    "last_n_days",
    f"""WITH {DAILY} SELECT * FROM bars
WHERE "timestamp" BETWEEN TIMESTAMP '1998-06-30' - INTERVAL 30 DAY AND TIMESTAMP '1998-06-30'""",
)
def last_n_days(spark, folder):
    return clean.last_days(bars_daily(spark, folder), datetime(1998, 6, 30))


@query(
    "silver_indicator_join",
    f"""WITH {DAILY}, s AS (SELECT symbol, "timestamp", {full('avg', 'close', 20)} AS v FROM bars)
SELECT bars.symbol, bars."timestamp", bars.close, round(s.v, 6) AS sma_20
FROM bars LEFT JOIN (SELECT * FROM s WHERE v IS NOT NULL) s USING (symbol, "timestamp")""",
)
def silver_indicator_join(spark, folder):
    """A series computed elsewhere, joined onto bars."""
    bars = bars_daily(spark, folder)
    series = indicators(bars, ["sma_20"]).where("sma_20 IS NOT NULL").select(*KEY, "sma_20")
    return bars.select(*KEY, "close").join(series, KEY, "left")


@query(
    "silver_union",
    f"""WITH {DAILY} SELECT symbol, "timestamp", close, NULL::DOUBLE AS sma_5 FROM bars WHERE "timestamp" < TIMESTAMP '1996-01-01'
UNION ALL SELECT symbol, "timestamp", close, round({full('avg', 'close', 5)}, 6) FROM bars""",
)
def silver_union(spark, folder):
    bars = bars_daily(spark, folder).select(*KEY, "close")
    return store.union_layers(bars.where(F.col("timestamp") < F.lit(datetime(1996, 1, 1))), indicators(bars, ["sma_5"]))


INTRADAY = """SELECT symbol, "timestamp", open, high, low, close, volume, round((close - open) / nullif(open, 0) * 100, 6) AS daily_performance,
       round(high - low, 6) AS range, round((high - low) / nullif(open, 0) * 100, 6) AS intraday_volatility FROM bars"""


@query("intraday_enrich", f"WITH {HOURLY} {INTRADAY}")
def intraday_enrich(spark, folder):
    return enrich_intraday(bars_events(spark, folder))


@query(
    "iso_parse",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN o_orderdate WHEN 'O' THEN o_orderdate - INTERVAL 2 HOUR END AS parsed
FROM orders""",
)
def iso_parse(spark, folder):
    """UTC designator, offset, and text that is no time."""
    iso = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    status = F.col("o_orderstatus")
    text = F.when(status == "F", F.concat(iso, F.lit("Z"))).when(status == "O", F.concat(iso, F.lit("+02:00")))
    return table(spark, folder, "orders").select(
        "o_orderkey", parse_iso(text.otherwise(F.col("o_orderpriority"))).alias("parsed")
    )


@query(
    "decimal_roundtrip",
    """SELECT o_orderkey, CAST(CAST(o_totalprice AS DECIMAL(18,6)) AS VARCHAR) AS stored, o_totalprice AS price FROM orders""",
)
def decimal_roundtrip(spark, folder):
    stored = to_decimal(F.col("o_totalprice"))
    return table(spark, folder, "orders").select(
        "o_orderkey", stored.cast("string").alias("stored"), stored.cast("double").alias("price")
    )


# --- gold -------------------------------------------------------------------------------------------

MONTHLY = f"""{DAILY}, months AS (
  SELECT symbol, strftime("timestamp", '%Y-%m') AS year_month, arg_min(open, "timestamp") AS open, max(high) AS high, min(low) AS low,
         arg_max(close, "timestamp") AS close, CAST(sum(volume) AS BIGINT) AS volume, min("timestamp") AS "timestamp",
         stddev_samp(close) AS volatility FROM bars GROUP BY 1, 2),
result AS (
  SELECT symbol, year_month, open, high, low, close, volume, "timestamp",
         round((close / lag(close) OVER m - 1) * 100, 6) AS monthly_return,
         round(CASE WHEN count(close) OVER m3 >= 3 THEN avg(close) OVER m3 END, 6) AS ma_3m, round(volatility, 6) AS volatility
  FROM months WINDOW m AS (PARTITION BY symbol ORDER BY year_month),
                     m3 AS (PARTITION BY symbol ORDER BY year_month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW))"""


@query("gold_monthly", f"WITH {MONTHLY} SELECT * FROM result")
def gold_monthly(spark, folder):
    return gold.monthly(bars_daily(spark, folder))


def five_sql(bars: str, column: str) -> str:
    return f"""WITH {bars} SELECT symbol, min({column}) AS min, max({column}) AS max, round(avg({column}), 6) AS mean,
       round(median({column}), 6) AS median, round(stddev_samp({column}), 6) AS std FROM bars GROUP BY symbol"""


@query("gold_price_stats", five_sql(DAILY, "close"))
def gold_price_stats(spark, folder):
    return gold.price_stats(bars_daily(spark, folder))


@query("gold_price_stats_hourly", five_sql(HOURLY, "close"))
def gold_price_stats_hourly(spark, folder):
    """The intraday path: median by sketch, count and rank."""
    return gold.price_stats(bars_events(spark, folder), grain="hour")


@query("gold_volume_stats", five_sql(DAILY, "volume"))
def gold_volume_stats(spark, folder):
    return gold.volume_stats(bars_daily(spark, folder))


@query(
    "gold_return_stats",
    f"""WITH {DAILY}, {CHANGES}
SELECT symbol, round(min(daily_return * 100), 6) AS min_daily_return, round(max(daily_return * 100), 6) AS max_daily_return,
       round(avg(daily_return * 100), 6) AS mean_daily_return, round(stddev_samp(daily_return * 100), 6) AS volatility,
       round(stddev_samp(daily_return * 100) * sqrt(252), 6) AS annualized_volatility,
       round((arg_max(close, "timestamp") - arg_min(close, "timestamp")) / arg_min(close, "timestamp") * 100, 6) AS total_return_pct
FROM sided GROUP BY symbol HAVING count(*) > 1""",
)
def gold_return_stats(spark, folder):
    return gold.return_stats(bars_daily(spark, folder))


@query(
    "gold_time_range",
    f"""WITH {DAILY} SELECT symbol, strftime(min("timestamp"), '%Y-%m-%d') AS start_date, strftime(max("timestamp"), '%Y-%m-%d') AS end_date,
       CAST(date_diff('second', min("timestamp"), max("timestamp")) // 86400 AS BIGINT) AS days, count(*) AS trading_days
FROM bars GROUP BY symbol""",
)
def gold_time_range(spark, folder):
    return gold.time_range(bars_daily(spark, folder))


@query(
    "gold_trend",
    f"""WITH {DAILY}, a AS (SELECT symbol, close, {full('avg', 'close', 20)} AS s, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS age FROM bars)
SELECT symbol, CASE WHEN close > s THEN 'bullish' ELSE 'bearish' END AS direction, round(abs((close - s) / s) * 100, 6) AS strength
FROM a WHERE age = 1 AND s IS NOT NULL""",
)
def gold_trend(spark, folder):
    return gold.current_trend(indicators(bars_daily(spark, folder), ["sma_20"]))


# --- stores -----------------------------------------------------------------------------------------


def vendor_named(bars):
    return bars.select(*KEY, *[F.col(c).alias(c.capitalize()) for c in ("open", "high", "low", "close", "volume")])


@query(
    "bronze_land",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open AS "Open", high AS "High", low AS "Low", close AS "Close", volume AS "Volume", TIMESTAMP '2024-01-15 10:00:00' AS ingest_ts,
       'prices' AS data_type, '2024' AS year, '01' AS month, '15' AS day FROM bars""",
)
def bronze_land(spark, folder):
    path = workspace(spark, "bronze")
    raw = vendor_named(bars_daily(spark, folder))
    store.land_bronze(raw, path, ingest_ts=LANDED)
    return store.read_bronze(spark, path, raw.schema)


@query(
    "silver_write_read",
    f"""WITH {DAILY}, {CHANGES} SELECT symbol, "timestamp", close, volume, round({full('avg', 'close', 20)}, 6) AS sma_20,
       round({RSI}, 6) AS rsi_14 FROM sided""",
)
def silver_write_read(spark, folder):
    """Written twice: the second run replaces the first."""
    path = workspace(spark, "silver")
    bars = conform_bars(bars_daily(spark, folder))
    for factor in (2.0, 1.0):
        scaled = bars.withColumn("close", F.col("close") * factor)
        store.write_bars(batch.silver_bars(scaled).select(*SILVER_SCHEMA.names), path, "overwrite")
    return store.read_bars(spark, path, SILVER_SCHEMA).select(*KEY, "close", "volume", "sma_20", "rsi_14")


@query("gold_write_read", f"WITH {MONTHLY} SELECT * FROM result")
def gold_write_read(spark, folder):
    path = workspace(spark, "gold")
    silver = batch.silver_bars(bars_daily(spark, folder))
    monthly = gold.monthly(silver)
    store.write_gold(monthly, gold.statistics(silver), path, workspace(spark, "staging"))
    return store.read_gold_monthly(spark, path, monthly.schema).select(*monthly.columns)


STATISTICS = f"""WITH {DAILY}, {CHANGES} SELECT symbol, min(close) AS low, max(close) AS high, round(median(close), 6) AS middle, round(avg(volume), 6) AS volume,
       round(stddev_samp(daily_return * 100), 6) AS volatility, strftime(max("timestamp"), '%Y-%m-%d') AS end_date, count(*) AS trading_days
FROM sided GROUP BY symbol"""


@query("gold_statistics_read", STATISTICS)
def gold_statistics_read(spark, folder):
    """The statistics as stored JSON."""
    path = workspace(spark, "gold")
    silver = batch.silver_bars(bars_daily(spark, folder))
    statistics = gold.statistics(silver)
    store.write_gold(gold.monthly(silver), statistics, path, workspace(spark, "staging"))
    return shown_statistics(store.read_gold_statistics(spark, path, statistics.schema))


def shown_statistics(read):
    return read.select(
        "symbol",
        F.col("price_stats.min").alias("low"),
        F.col("price_stats.max").alias("high"),
        F.col("price_stats.median").alias("middle"),
        F.col("volume_stats.mean").alias("volume"),
        "return_stats.volatility",
        "time_range.end_date",
        "time_range.trading_days",
    )


# --- runs on a part ---------------------------------------------------------------------------------


def rerun_lake(spark, folder):
    """A lake of all symbols whose last 40 days and first symbol are run again, the latter with doubled prices."""
    raw = vendor_named(bars_daily(spark, folder))
    lake = lakes.Lake(workspace(spark, "lake"), raw.schema)
    lakes.run(spark, lake, raw, ingest_ts=LANDED, documents=False)
    newest = raw.agg(F.max("timestamp")).first()[0]
    lakes.run(spark, lake, steps="silver", days=40, as_of=newest, documents=False)
    again = raw.where("symbol = 'F'").withColumns({c: F.col(c) * 2 for c in ("Open", "High", "Low", "Close")})
    lakes.run(spark, lake, again, symbols=["F"], ingest_ts=LANDED.replace(day=16), documents=False)
    return lake


DOUBLED = f"""{DAILY.replace('bars AS', 'single AS', 1)}, bars AS (
  SELECT symbol, "timestamp", open * f AS open, high * f AS high, low * f AS low, close * f AS close, volume
  FROM (SELECT *, CASE symbol WHEN 'F' THEN 2 ELSE 1 END AS f FROM single))"""


@query(
    "silver_subset_rerun",
    f"""WITH {DOUBLED}, {CHANGES} SELECT symbol, "timestamp", close, volume, round({full('avg', 'close', 20)}, 6) AS sma_20,
       round({RSI}, 6) AS rsi_14 FROM sided""",
)
def silver_subset_rerun(spark, folder):
    """Runs on some days and some symbols leave all other bars, and the indicators of those they touch are those of a full run."""
    return lakes.read_silver(spark, rerun_lake(spark, folder)).select(*KEY, "close", "volume", "sma_20", "rsi_14")


@query("gold_subset_rerun", f"WITH {MONTHLY.replace(DAILY, DOUBLED).replace(', 6)', ', 3)')} SELECT * FROM result", places=3)
def gold_subset_rerun(spark, folder):
    lake = rerun_lake(spark, folder)
    schema = gold.monthly(conform_bars(bars_daily(spark, folder))).schema
    return store.read_gold_monthly(spark, lake.path("gold"), schema).select(*schema.names)


@query(
    "prices_upsert_twice",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open, high, low,
       close * CASE WHEN symbol = 'F' AND month("timestamp") IN (1, 2) THEN 2 ELSE 1 END AS close, volume FROM bars""",
)
def prices_upsert_twice(spark, folder):
    """Two upserts through one staging folder, other symbols' bars of the same months appended between them."""
    path, staging = workspace(spark, "upsert"), workspace(spark, "staging")
    bars = conform_bars(bars_daily(spark, folder))
    first, second = ((F.col("symbol") == "F") & (F.month("timestamp") == m) for m in (1, 2))
    doubled = bars.withColumn("close", F.col("close") * 2)
    store.write_bars(bars.where(~F.month("timestamp").isin(1) | (F.col("symbol") == "P")), path)
    store.upsert_bars(spark, path, doubled.where(first), staging)
    store.write_bars(bars.where((F.month("timestamp") == 1) & ~F.col("symbol").isin("F", "P")), path)
    store.upsert_bars(spark, path, doubled.where(second), staging)
    return store.read_bars(spark, path).select(*BAR)


@query(
    "price_store",
    f"""WITH {DAILY} SELECT symbol, strftime("timestamp", '%Y') AS year, strftime("timestamp", '%m') AS month, count(*) AS bars,
       min("timestamp") AS first, max("timestamp") AS last FROM bars GROUP BY 1, 2, 3""",
)
def price_store(spark, folder):
    """Every bar lies in the partition of its own month."""
    path = workspace(spark, "prices")
    store.write_bars(conform_bars(bars_daily(spark, folder)), path)
    return store.read_bars(spark, path).groupBy("symbol", "year", "month").agg(
        F.count("*").alias("bars"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")
    )


@query(
    "prices_range",
    f"""WITH {DAILY} SELECT * FROM bars WHERE symbol = 'F' AND "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""",
)
def prices_range(spark, folder):
    path = workspace(spark, "prices")
    store.write_bars(conform_bars(bars_daily(spark, folder)), path)
    return store.get_prices(spark, path, "F", START, END).select(*BAR)


@query(
    "prices_ranged",
    f"""WITH {DAILY.replace("o_orderstatus AS symbol", "CAST(o_custkey AS VARCHAR) AS symbol")}
SELECT * FROM bars WHERE symbol IN ('1', '37', '100', 'none') AND "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""",
)
def prices_ranged(spark, folder):
    """Some of many symbols by the index of files; half of the bars are written by another writer, which the index does not know."""
    path = workspace(spark, "ranged")
    bars = conform_bars(bars_customers(spark, folder))
    even = F.dayofmonth("timestamp") % 2 == 0
    ranged.write_ranged(bars.where(even), path)
    store.write_bars(bars.where(~even), path)
    return ranged.get_ranged(spark, path, ["1", "37", "100", "none"], START, END).select(*BAR)


@query(
    "prices_upsert",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open, high, low, CASE WHEN "timestamp" >= TIMESTAMP '1998-01-01' THEN close * 2 ELSE close END AS close,
       volume FROM bars""",
)
def prices_upsert(spark, folder):
    """History stored up to mid-1998, then all of 1998 on arrives twice; the last write wins."""
    path = workspace(spark, "upsert")
    bars = conform_bars(bars_daily(spark, folder))
    store.write_bars(bars.where(F.col("timestamp") < F.lit(datetime(1998, 7, 1))), path)
    versions = F.explode(F.sequence(F.lit(1), F.lit(2)).cast("array<bigint>"))
    late = bars.where(F.col("timestamp") >= F.lit(datetime(1998, 1, 1))).withColumn("seq", versions)
    store.upsert_bars(spark, path, late.withColumn("close", F.col("close") * F.col("seq")), workspace(spark, "staging"))
    return store.read_bars(spark, path).select(*BAR)


@query(
    "upsert_delta",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open, high, low, CASE WHEN "timestamp" >= TIMESTAMP '1998-01-01' THEN close * 2 ELSE close END AS close,
       volume FROM bars""",
)
def upsert_delta(spark, folder):
    """History as one run, then 1998 three times as runs of changes, one of them repeated, some folded into the base before the rest comes."""
    table = RunTable(spark, workspace(spark, "prices"), BAR_SCHEMA, KEY, store.month_parts)
    bars = conform_bars(bars_daily(spark, folder))
    table.append(bars, "history")
    for factor in (1.0, 3.0, 2.0, 3.0):
        late = bars.where(F.col("timestamp") >= F.lit(datetime(1998, 1, 1))).withColumn("close", F.col("close") * factor)
        table.append(late, f"times {factor}")
        if factor == 1.0:
            table.compact()
            table.expire()
    return table.read().select(*BAR)


@query(
    "files_skipped",
    f"""WITH {DAILY} SELECT strftime("timestamp", '%Y/%m') AS place, count(*) AS rows, CAST(0 AS BIGINT) AS read FROM bars
WHERE strftime("timestamp", '%Y/%m') IN ('1995/06', '1997/02') GROUP BY 1""",
)
def files_skipped(spark, folder):
    """Two months of a table lose their files, which share a name with those of all other months: both are named, with their rows."""
    table = RunTable(spark, workspace(spark, "prices"), BAR_SCHEMA, KEY, store.month_parts)
    table.append(conform_bars(bars_daily(spark, folder)).coalesce(1), "history")
    ((_, name),) = table.state().runs.values()
    for place in ("year=1995/month=06", "year=1997/month=02"):
        remove(spark, f"{table.path}/runs/{name}/{place}")
    place = F.regexp_replace(F.regexp_extract("file", r"(year=\d+/month=\d+)", 1), "year=|month=", "")
    return table.unread().groupBy(place.alias("place")).agg(F.sum("rows").alias("rows"), F.sum("read").alias("read"))


@query(
    "landing_ledger",
    f"""WITH {DAILY}, landed AS (SELECT *, least(greatest(year("timestamp"), 1996), 1998) AS ingest FROM bars WHERE symbol <> 'P' OR "timestamp" < TIMESTAMP '1998-01-01')
SELECT symbol, "timestamp", close FROM landed JOIN (SELECT symbol, max(ingest) AS ingest FROM landed GROUP BY 1) USING (symbol, ingest)""",
)
def landing_ledger(spark, folder):
    """Yearly landings, the last of which lacks a symbol; the ledger knows the newest of each."""
    path, bars = workspace(spark, "bronze"), bars_daily(spark, folder)
    bars = bars.where((F.col("symbol") != "P") | (F.col("timestamp") < F.lit(datetime(1998, 1, 1))))
    for year in (1996, 1997, 1998):
        part = bars.where(F.least(F.greatest(F.year("timestamp"), F.lit(1996)), F.lit(1998)) == year)
        store.land_bronze(part, path, ingest_ts=datetime(year, 12, 31, 18))
    return store.newest_landing(spark, path, bars.schema).select(*KEY, "close")


@query(
    "latest_batch",
    f"""WITH {DAILY}, landed AS (SELECT *, date_trunc('month', "timestamp") AS ingest FROM bars)
SELECT symbol, "timestamp", close FROM landed JOIN (SELECT symbol, max(ingest) AS ingest FROM landed GROUP BY 1) USING (symbol, ingest)""",
)
def latest_batch(spark, folder):
    """Bars landed month by month; the newest landing per symbol."""
    landed = bars_daily(spark, folder).withColumn("ingest_ts", F.date_trunc("month", "timestamp"))
    return store.latest_landing(landed).select(*KEY, "close")


@query("all_tickers", "SELECT DISTINCT o_orderstatus AS symbol FROM orders")
def all_tickers(spark, folder):
    return store.symbols_in(bars_daily(spark, folder))


def supplier_profiles(spark, folder):
    """Supplier, nation and region as profile JSON; some fields are missing."""
    known = F.col("s_acctbal") >= 0
    rows = (
        table(spark, folder, "supplier")
        .join(table(spark, folder, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    body = F.struct(
        F.when(known, F.col("s_name")).alias("Name"),
        F.when(F.col("r_name") != "ASIA", F.col("n_name")).alias("Exchange"),
        F.col("r_name").alias("Sector"),
        F.col("s_suppkey").cast("string").alias("MarketCapitalization"),
    )
    return rows.select(F.format_string("S%05d", "s_suppkey").alias("symbol"), F.to_json(body).alias("body"))


PROFILES = """profiles AS (
  SELECT printf('S%05d', s_suppkey) AS symbol,
         CASE WHEN s_acctbal >= 0 THEN s_name ELSE printf('S%05d', s_suppkey) END AS name,
         CASE WHEN r_name <> 'ASIA' THEN n_name ELSE 'Unknown' END AS exchange, r_name AS sector, NULL::VARCHAR AS industry,
         s_suppkey AS market_cap, s_acctbal
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


@query("stock_profile", f"WITH {PROFILES} SELECT symbol, name, exchange, sector, industry, market_cap FROM profiles")
def stock_profile(spark, folder):
    stocks = vendor.stocks_from_profiles(supplier_profiles(spark, folder))
    return stocks.select("symbol", "name", "exchange", "sector", "industry", "market_cap")


@query("stock_lookup", f"WITH {PROFILES} SELECT symbol, name, exchange, sector, industry FROM profiles WHERE symbol = 'S00007'")
def stock_lookup(spark, folder):
    path = workspace(spark, "stocks")
    stocks = vendor.stocks_from_profiles(supplier_profiles(spark, folder))
    store.write_stocks(stocks.withColumn("name", F.lit("first write")), path)
    store.write_stocks(stocks, path)
    return store.get_stock(spark, path, "S00007").drop("last_updated")


@query("stocks_new", f"WITH {PROFILES} SELECT symbol, name FROM profiles WHERE s_acctbal >= 5000 OR s_acctbal IS NULL")
def stocks_new(spark, folder):
    stocks = vendor.stocks_from_profiles(supplier_profiles(spark, folder)).select("symbol", "name")
    stored = table(spark, folder, "supplier").where("s_acctbal < 5000")
    return store.new_stocks(stocks, stored.select(F.format_string("S%05d", "s_suppkey").alias("symbol")))


def event_envelopes(spark, folder):
    data = table(spark, folder, "events").select("event_id", "event_type", "ts", "value", "props")
    return store.envelopes(data, F.col("event_type"), "events", F.col("ts"), ["event_type:name"], F.lit(LANDED))


PAYLOAD = "event_id bigint, event_type string, value double, props string"


@query(
    "envelope_write",
    """SELECT event_type AS source_id, 'events' AS data_type, ts AS "timestamp", event_id, value, props,
       left(event_type, 1) || repeat('*', length(event_type) - 1) AS kind, '2024-01-15T10:00:00.000000' AS processed_at, '1.0' AS version,
       strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day FROM events""",
)
def envelope_write(spark, folder):
    """Every envelope, masked, written by event day and read back."""
    path = workspace(spark, "envelopes")
    store.write_envelopes(event_envelopes(spark, folder), path)
    return store.read_envelopes(spark, path).withColumn("p", F.from_json("data", PAYLOAD)).select(
        "source_id",
        "data_type",
        "timestamp",
        "p.event_id",
        "p.value",
        "p.props",
        F.col("p.event_type").alias("kind"),
        F.col("metadata")["processed_at"].alias("processed_at"),
        F.col("metadata")["version"].alias("version"),
        *store.DAY_PARTITIONS,
    )


FROM, TO = datetime(2024, 1, 10, 12), datetime(2024, 1, 20, 6, 30)


@query(
    "envelope_range",
    f"""SELECT event_type AS source_id, ts AS "timestamp", event_id, value, props, left(event_type, 1) || repeat('*', length(event_type) - 1) AS kind,
       '1.0' AS version
FROM events WHERE event_type = 'click' AND ts BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}'""",
)
def envelope_range(spark, folder):
    path = workspace(spark, "envelopes")
    store.write_envelopes(event_envelopes(spark, folder), path)
    found = store.get_envelopes(spark, path, "click", "events", FROM, TO)
    return found.withColumn("p", F.from_json("data", PAYLOAD)).select(
        "source_id",
        "timestamp",
        "p.event_id",
        "p.value",
        "p.props",
        F.col("p.event_type").alias("kind"),
        F.col("metadata")["version"].alias("version"),
    )


# --- vendor payloads --------------------------------------------------------------------------------


def payloads(spark, folder, land=vendor.land_payloads):
    """Daily bars as vendor JSON, one response per symbol and month; every February is an error response."""
    bars = bars_daily(spark, folder)
    day = F.create_map(
        *[
            item
            for column, key in {**vendor.BAR_FIELDS, "adjusted_close": vendor.BAR_FIELDS["adjusted_close"]}.items()
            for item in (F.lit(key), F.col("close" if column == "adjusted_close" else column).cast("string"))
        ]
    )
    month = F.date_format("timestamp", "yyyy-MM")
    entry = F.struct(F.date_format("timestamp", "yyyy-MM-dd").alias("key"), day.alias("value"))
    series = F.map_from_entries(F.collect_list(entry)).alias(vendor.SERIES_KEY)
    responses = bars.groupBy("symbol", month.alias("month")).agg(F.to_json(F.struct(series)).alias("body"))
    error = F.to_json(F.struct(F.concat(F.lit("no data for "), F.col("month")).alias(vendor.ERROR_KEY)))
    return land(
        responses.withColumn("body", F.when(F.col("month").endswith("-02"), error).otherwise(F.col("body"))), F.lit(LANDED)
    )


@query(
    "vendor_json_bars",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open, high, low, close, volume, close AS adjusted_close FROM bars
WHERE month("timestamp") <> 2 AND "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""",
)
def vendor_json_bars(spark, folder):
    return vendor.bars_from_payloads(payloads(spark, folder), START, END)


@query(
    "vendor_rejects",
    f"""WITH {DAILY} SELECT DISTINCT symbol, 'no data for ' || strftime("timestamp", '%Y-%m') AS error FROM bars WHERE month("timestamp") = 2""",
)
def vendor_rejects(spark, folder):
    return vendor.split_payloads(payloads(spark, folder))[1].select("symbol", "error")


def stored_variants(spark, folder):
    """The same responses, parsed when they land."""
    path = f"{workspace(spark, 'variants')}/payloads"
    payloads(spark, folder, vendor.land_variants).write.parquet(path)
    return spark.read.parquet(path)


@query(
    "vendor_variant_bars",
    f"""WITH {DAILY} SELECT symbol, "timestamp", open, high, low, close, volume, close AS adjusted_close FROM bars
WHERE month("timestamp") <> 2 AND "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'""",
)
def vendor_variant_bars(spark, folder):
    return vendor.bars_from_payloads(stored_variants(spark, folder), START, END)


@query(
    "vendor_variant_rejects",
    f"""WITH {DAILY} SELECT DISTINCT symbol, 'no data for ' || strftime("timestamp", '%Y-%m') AS error,
       '{{"{vendor.ERROR_KEY}":"no data for ' || strftime("timestamp", '%Y-%m') || '"}}' AS body FROM bars WHERE month("timestamp") = 2""",
)
def vendor_variant_rejects(spark, folder):
    """Rejected payloads as they are quarantined, in text."""
    return vendor.split_payloads(stored_variants(spark, folder))[1].select("symbol", "error", "body")


@query("vendor_frame_bars", f"""WITH {DAILY} SELECT *, close AS adjusted_close FROM bars""")
def vendor_frame_bars(spark, folder):
    named = {c: c.capitalize() for c in ("open", "high", "low", "close", "volume")}
    return vendor.bars_from_frame(bars_daily(spark, folder).withColumnsRenamed(named))


# --- reports ----------------------------------------------------------------------------------------


def requests(spark, folder):
    """Comma-separated symbol lists with stray blanks and an empty entry."""
    lists = F.concat(F.col("o_orderstatus"), F.lit(" ,"), F.col("o_orderpriority"), F.lit(", ,"))
    return table(spark, folder, "orders").select(lists.alias("symbols"))


REQUESTED = """requested AS (SELECT DISTINCT o_orderstatus AS symbol FROM orders UNION SELECT DISTINCT o_orderpriority FROM orders)"""
STATUS = f"""{DAILY}, {REQUESTED}, status AS (
  SELECT r.symbol, count(bars.symbol) AS price_points, CASE WHEN count(bars.symbol) > 0 THEN 'success' ELSE 'error' END AS status,
         CASE WHEN count(bars.symbol) = 0 THEN 'no data' END AS error
  FROM requested r LEFT JOIN bars ON r.symbol = bars.symbol GROUP BY r.symbol)"""


@query("ticker_list", f"WITH {REQUESTED} SELECT symbol FROM requested")
def ticker_list(spark, folder):
    return report.requested_symbols(requests(spark, folder), "symbols")


@query("batch_status", f"WITH {STATUS} SELECT * FROM status")
def batch_status(spark, folder):
    return report.batch_status(report.requested_symbols(requests(spark, folder), "symbols"), bars_daily(spark, folder))


@query(
    "batch_summary",
    f"""WITH {STATUS}, first AS (SELECT symbol || ': ' || error AS e FROM status WHERE status = 'error' ORDER BY symbol LIMIT 5)
SELECT count(*) AS total, count(*) FILTER (status = 'success') AS successful, count(*) FILTER (status <> 'success') AS failed,
       (SELECT string_agg(e, '; ' ORDER BY e) FROM first) AS errors FROM status""",
)
def batch_summary(spark, folder):
    requested = report.requested_symbols(requests(spark, folder), "symbols")
    summary = report.batch_summary(report.batch_status(requested, bars_daily(spark, folder)))
    lines = F.transform("errors", lambda e: F.concat(e["symbol"], F.lit(": "), e["error"]))
    return summary.withColumn("errors", F.array_join(lines, "; "))


@query(
    "latest_price",
    f"""WITH {DAILY} SELECT * EXCLUDE (age) FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp" DESC) AS age FROM bars) WHERE age = 1""",
)
def latest_price(spark, folder):
    return report.latest_price(bars_daily(spark, folder))


@query(
    "batch_time_range",
    f"""WITH {DAILY} SELECT symbol, min("timestamp") AS start, max("timestamp") AS "end", count(*) AS records FROM bars GROUP BY symbol""",
)
def batch_time_range(spark, folder):
    return report.time_range(bars_daily(spark, folder))


def batch_run(spark, folder, land=vendor.land_payloads, times=1):
    """A batch over all symbols and two unknown ones; one of these has an error response, its profile is no JSON. Repeated under one name."""
    stores = etl.Stores(workspace(spark, "etl"))
    bodies = spark.createDataFrame([("nobody", '{"Error Message": "rate limit reached"}')], "symbol string, body string")
    landed = payloads(spark, folder, land).unionByName(land(bodies, F.lit(LANDED)))
    profiles = spark.createDataFrame([("nobody", "not json"), ("F", '{"Name": "F Inc"}'), ("F", '{"Name": "F Inc"}')], "symbol string, body string")
    for _ in range(times):
        found = etl.process_symbols(spark, stores, "F, O, P, nobody, nothing", landed, START, END, profiles, at=LANDED, run_id="batch")
    return stores, *found


RESULT = f"""{DAILY}, wanted AS (SELECT unnest(['F', 'O', 'P', 'nobody', 'nothing']) AS symbol),
found AS (SELECT symbol, count(*) AS n FROM bars WHERE month("timestamp") <> 2 AND "timestamp" BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' GROUP BY 1)"""


@query(
    "batch_status_errors",
    f"""WITH {RESULT} SELECT symbol, coalesce(n, 0) AS price_points, CASE WHEN n IS NULL THEN 'error' ELSE 'success' END AS status,
       CASE WHEN n IS NULL THEN CASE symbol WHEN 'nobody' THEN 'rate limit reached' ELSE 'no data' END END AS error
FROM wanted LEFT JOIN found USING (symbol)""",
)
def batch_status_errors(spark, folder):
    """The vendor's text is the error of a symbol without bars."""
    return batch_run(spark, folder)[1].select("symbol", "price_points", "status", "error")


@query(
    "batch_result",
    f"""WITH {RESULT} SELECT symbol || '_20240115' AS batch_id, symbol, TIMESTAMP '{START}' AS start_date, TIMESTAMP '{END}' AS end_date,
       CAST({' + '.join(f'CAST(coalesce(n, 0) >= {k} AS INTEGER)' for k in batch.MIN_BARS.values())} AS BIGINT) AS indicators_calculated
FROM wanted LEFT JOIN found USING (symbol)""",
)
def batch_result(spark, folder):
    return batch_run(spark, folder)[1].select("batch_id", "symbol", "start_date", "end_date", "indicators_calculated")


@query(
    "quarantine",
    f"""WITH {DAILY} SELECT 'payload' AS kind, symbol, 'no data for ' || month AS error, count(*) AS rows
FROM (SELECT DISTINCT symbol, strftime("timestamp", '%Y-%m') AS month FROM bars WHERE month("timestamp") = 2) GROUP BY ALL
UNION ALL SELECT 'payload', 'nobody', 'rate limit reached', 1 UNION ALL SELECT 'profile', 'nobody', 'unexpected response format', 1""",
)
def quarantine(spark, folder):
    """What the batch run could not use, stored and counted."""
    stores = batch_run(spark, folder)[0]
    return store.read_quarantine(spark, stores.path("quarantine")).groupBy("kind", "symbol", "error").agg(F.count("*").alias("rows"))


@query(
    "batch_metrics",
    f"""WITH {RESULT}, months AS (SELECT symbol, count(DISTINCT strftime("timestamp", '%Y-%m')) AS n FROM bars WHERE month("timestamp") = 2 GROUP BY 1)
SELECT 'records_extracted' AS metric, symbol, CAST(n AS DOUBLE) AS total FROM found
UNION ALL SELECT 'indicators_calculated', symbol, {' + '.join(f'CAST(n >= {k} AS INTEGER)' for k in batch.MIN_BARS.values())} FROM found
UNION ALL SELECT 'records_rejected', symbol, n FROM months UNION ALL SELECT 'records_rejected', 'nobody', 2""",
)
def batch_metrics(spark, folder):
    """The metrics by symbol that a batch run leaves; times by step are in the same table."""
    metrics = batch_run(spark, folder)[3].metrics().where("symbol IS NOT NULL")
    return metrics.groupBy("metric", "symbol").agg(F.sum("value").alias("total"))


@query(
    "batch_replayed",
    f"""WITH {RESULT}, lost AS (SELECT symbol, count(DISTINCT strftime("timestamp", '%Y-%m')) AS n FROM bars WHERE month("timestamp") = 2 GROUP BY 1)
SELECT 'metric' AS part, 'records_extracted' AS name, symbol, CAST(n AS DOUBLE) AS total FROM found
UNION ALL SELECT 'metric', 'indicators_calculated', symbol, {' + '.join(f'CAST(n >= {k} AS INTEGER)' for k in batch.MIN_BARS.values())} FROM found
UNION ALL SELECT 'metric', 'records_rejected', symbol, n FROM lost UNION ALL SELECT 'metric', 'records_rejected', 'nobody', 2
UNION ALL SELECT 'reject', 'payload', symbol, n FROM lost
UNION ALL SELECT 'reject', unnest(['payload', 'profile']), 'nobody', 1""",
)
def batch_replayed(spark, folder):
    """Rejects and metrics after a batch of parsed payloads that is run twice under one name: as after one run."""
    stores, _, _, log = batch_run(spark, folder, vendor.land_variants, times=2)
    metrics = log.metrics().where("symbol IS NOT NULL").groupBy(F.col("metric").alias("name"), "symbol").agg(F.sum("value").alias("total"))
    rejects = store.read_quarantine(spark, stores.path("quarantine")).groupBy(F.col("kind").alias("name"), "symbol")
    rejects = rejects.agg(F.count("*").cast("double").alias("total"))
    parts = [f.select(F.lit(p).alias("part"), "name", "symbol", "total") for p, f in (("metric", metrics), ("reject", rejects))]
    return parts[0].unionByName(parts[1])


@query(
    "run_metrics",
    f"""WITH {DAILY}, {HOURLY.replace('bars AS', 'hours AS')}, m AS (
  SELECT symbol, 'daily' AS data_type, CAST(count(*) AS DOUBLE) AS value FROM bars GROUP BY 1
  UNION ALL SELECT symbol, 'hourly', count(*) FROM hours GROUP BY 1)
SELECT 'records_extracted' AS metric, symbol, data_type, CAST(1 AS BIGINT) AS samples, value AS total, value AS least, value AS most, value AS mean FROM m""",
)
def run_metrics(spark, folder):
    """Metric rows appended to the metrics table by two loads, then reported."""
    log = report.RunLog(spark, workspace(spark, "log"))
    log.append_metrics(report.records_extracted(bars_daily(spark, folder), "daily"), "daily")
    log.append_metrics(report.records_extracted(bars_events(spark, folder), "hourly"), "hourly")
    return report.metric_report(log.metrics())


@query(
    "trace_report",
    """WITH log AS (SELECT CAST(user_id AS VARCHAR) AS trace_id, event_type, ts FROM events)
SELECT trace_id, min(ts) AS started, CAST(date_diff('microsecond', min(ts), max(ts)) AS BIGINT) AS duration_us, count(*) AS events,
       arg_max(CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END, ts) FILTER (event_type IN ('purchase', 'error')) AS status
FROM log GROUP BY trace_id""",
)
def trace_report(spark, folder):
    """User sessions of the events table read as traces: a purchase ends one well, an error badly."""
    kind = F.col("event_type")
    ended = kind.isin("purchase", "error")
    outcome = F.when(kind == "error", "failed").otherwise("success")
    log = table(spark, folder, "events").select(
        F.col("user_id").cast("string").alias("trace_id"),
        F.when(ended, F.concat(F.lit("trace_end_"), F.col("user_id").cast("string"))).otherwise(kind).alias("event_type"),
        F.col("ts").cast("timestamp").alias("at"),
        F.create_map(F.lit("status"), outcome).alias("data"),
    )
    return report.trace_report(log)
