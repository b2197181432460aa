"""Cleaning, gold, documents, stores, vendor payloads, reports, the layered run, streams."""

from __future__ import annotations

import json
import re
import time
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_same, collect, formatted_plan, make_bars, to_spark, walk
from marketlake.functions.scalars import default_time, enrich_intraday, parse_iso, split_symbols, to_utc
from marketlake.operators import batch, clean, gold
from marketlake.operators.indicators import indicators
from marketlake.plans import etl, report
from marketlake.plans import lake as lakes
from marketlake.schema import BAR_SCHEMA, SILVER_SCHEMA, MissingColumns, conform_bars
from marketlake.session import workspace
from marketlake.sources import ranged, store, vendor
from marketlake.sources.files import names_in, remove
from marketlake.sources.runs import RunTable
from marketlake.streaming.stream import read_records, refresh_from, write_enriched


def day(text: str) -> datetime:
    return datetime.fromisoformat(text)


# --- cleaning ---------------------------------------------------------------------------------------


def test_forward_fill_keeps_leading_nulls(spark):
    pdf = make_bars({"a": [None, None, 1, None, 3, None], "b": [5, None, 7]})
    got = collect(clean.forward_fill(to_spark(spark, pdf)))
    assert_same(got["close"], pdf.groupby("symbol")["close"].ffill())


@pytest.mark.parametrize("slice_bars", [2, 16, 1000])
def test_forward_fill_across_slices(spark, slice_bars):
    rng = np.random.default_rng(4)
    holes = [v if rng.random() < 0.1 else None for v in walk(200, 8)]
    pdf = make_bars({"a": holes, "b": [None, *walk(30, 9)]}, freq="h", gaps=True)
    got = collect(clean.forward_fill(to_spark(spark, pdf), grain="hour", slice_bars=slice_bars))
    for column in ("open", "high", "close"):
        assert_same(got[column], pdf.groupby("symbol")[column].ffill())
    assert list(got.columns) == BAR_SCHEMA.names


def test_intraday_silver_equals_whole_series_silver(spark):
    holes = [v if i % 7 else None for i, v in enumerate(walk(150, 8), 1)]
    raw = to_spark(spark, make_bars({"a": holes, "b": walk(40, 3)}, freq="h", gaps=True))
    whole = collect(batch.silver_bars(raw))
    pd.testing.assert_frame_equal(whole, collect(batch.silver_bars(raw, grain="hour")))


def test_latest_version_wins_and_equal_rows_collapse(spark):
    bars = to_spark(spark, make_bars({"a": walk(10)}))
    old = bars.withColumn("close", F.lit(-1.0)).withColumn("ingest_ts", F.lit(day("2024-01-01")))
    new = bars.withColumn("ingest_ts", F.lit(day("2024-01-02")))
    got = collect(clean.clean(new.union(old).union(new), version=["ingest_ts"]))
    assert_same(got["close"], collect(bars)["close"])


def test_standardise_renames_parses_and_drops_nan(spark):
    raw = spark.createDataFrame(
        [("x", "2024-01-02T00:00:00Z", 1.0, float("nan"), 3), ("x", "not a time", 1.0, 2.0, 3)],
        "symbol string, timestamp string, `Open` double, `Adj Close` double, `Volume` bigint",
    )
    rows = clean.standardise(raw).collect()
    assert set(rows[0].asDict()) == {"symbol", "timestamp", "open", "adjusted_close", "volume"}
    assert rows[0].adjusted_close is None and rows[1].timestamp is None
    with pytest.raises(MissingColumns):
        clean.standardise(raw.drop("timestamp"))


def test_date_filters_are_inclusive(spark):
    bars = to_spark(spark, make_bars({"a": walk(60)}))
    assert clean.between(bars, day("2020-01-31"), day("2020-02-29")).count() == 30
    assert clean.last_days(bars, day("2020-02-29")).count() == 31


def test_scalars(spark):
    row = spark.range(1).select(
        parse_iso(F.lit("2024-01-02T03:04:05Z")).cast("string").alias("z"),
        parse_iso(F.lit("2024-01-02T03:04:05.5+01:00")).cast("string").alias("offset"),
        parse_iso(F.lit("nope")).alias("bad"),
        to_utc(F.lit(day("2024-07-01")), "America/New_York").cast("string").alias("ny"),
        split_symbols(F.lit("A, B ,,C")).alias("list"),
    ).first()
    assert row.z == "2024-01-02 03:04:05" and row.offset == "2024-01-02 02:04:05.5" and row.bad is None
    assert row.ny == "2024-07-01 04:00:00" and row.list == ["A", "B", "C"]


def test_zero_open_keeps_the_row(spark):
    df = spark.createDataFrame([(0.0, 2.0, 1.0, 1.5), (2.0, 3.0, 1.0, 2.5)], "open double, high double, low double, close double")
    zero, normal = enrich_intraday(df).collect()
    assert zero.daily_performance is None and zero.range == 1.0
    assert (normal.daily_performance, normal.range, normal.intraday_volatility) == (25.0, 2.0, 100.0)
    assert enrich_intraday(df.drop("low")).columns == ["open", "high", "close"]
    assert default_time(df).first().timestamp is not None


# --- gold and batch ---------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def year():
    return make_bars({"a": walk(400, 1), "b": walk(45, 2), "c": [7.0]})


def test_monthly_against_pandas(spark, year):
    pdf = year.copy()
    pdf.loc[0, ["open", "close"]] = np.nan
    got = collect(gold.monthly(to_spark(spark, pdf)), ("symbol", "year_month"))
    pdf["year_month"] = pdf["timestamp"].dt.strftime("%Y-%m")
    months = pdf.groupby(["symbol", "year_month"]).agg(
        open=("open", "first"), high=("high", "max"), low=("low", "min"), close=("close", "last"), volume=("volume", "sum"), volatility=("close", "std")
    )
    per_symbol = months.groupby(level=0)["close"]
    months["monthly_return"] = per_symbol.pct_change(fill_method=None) * 100
    months["ma_3m"] = per_symbol.transform(lambda s: s.rolling(3).mean())
    for column in months.columns:
        assert_same(got[column], months[column].reset_index(drop=True))


def test_monthly_without_volume(spark, year):
    got = gold.monthly(to_spark(spark, year).drop("volume"))
    assert got.where("volume IS NOT NULL").count() == 0
    with pytest.raises(MissingColumns):
        gold.monthly(to_spark(spark, year).drop("low"))


def test_gold_statistics_against_pandas(spark, year):
    silver = indicators(to_spark(spark, year), ["sma_20"])
    rows = {r.symbol: r for r in gold.statistics(silver).collect()}
    for symbol, g in year.groupby("symbol"):
        row = rows[symbol]
        close, volume = g["close"], g["volume"]
        assert row.price_stats.median == pytest.approx(close.median()) and row.volume_stats.median == volume.median()
        assert row.time_range.trading_days == len(g)
        assert row.time_range.days == (g["timestamp"].max() - g["timestamp"].min()).days
        if len(g) == 1:
            assert row.return_stats is None and row.total_return_pct is None and row.current_trend is None
            continue
        returns = close.pct_change(fill_method=None) * 100
        assert row.return_stats.volatility == pytest.approx(returns.std())
        assert row.return_stats.annualized_volatility == pytest.approx(returns.std() * np.sqrt(252))
        assert row.total_return_pct == pytest.approx((close.iloc[-1] / close.iloc[0] - 1) * 100)
        average = close.rolling(20).mean().iloc[-1]
        assert row.current_trend.direction == ("bullish" if close.iloc[-1] > average else "bearish")


@pytest.mark.parametrize("values", [[1.0], [1.0, 2.0], [3.0] * 50, list(range(1001)), list(range(1000)), [0.0] * 900 + [5.0] * 901])
def test_bracketed_median_is_exact(spark, values):
    rng = np.random.default_rng(1)
    noisy = [float(x) for x in rng.lognormal(0, 3, 5000)]
    df = spark.createDataFrame([("v", float(x)) for x in values] + [("noise", x) for x in noisy], "symbol string, x double")
    got = {r.symbol: r.median for r in gold.bracketed_median(df, "x").collect()}
    assert got == {"v": np.median(values), "noise": np.median(noisy)}
    coarse = {r.symbol: r.median for r in gold.bracketed_median(df, "x", accuracy=50).collect()}
    assert coarse == got


def test_document(spark):
    pdf = make_bars({f"n{n:02d}": walk(n, n) for n in (1, 4, 5, 14, 20, 26, 30, 60)})
    rows = batch.indicator_document(to_spark(spark, pdf)).collect()
    documents = {r.symbol: json.loads(r.document) for r in rows}
    keys = {s: set(d) for s, d in documents.items()}
    assert keys["n01"] == keys["n04"] - {"volatility"} == {"statistics"}
    assert keys["n05"] == {"sma_5", "ema_5", "statistics", "volatility"}
    assert documents["n14"]["rsi_14"] == []
    assert "macd" in keys["n26"] and "macd" not in keys["n20"] and "trends" in keys["n20"]
    assert "resistance_levels" in documents["n60"]["trends"] and "support_levels" not in documents["n26"]["trends"]
    assert len(documents["n60"]["macd"]["signal"]) == 60 and len(documents["n60"]["sma_50"]) == 11
    first = documents["n60"]["sma_50"][0]
    closes = pdf[pdf["symbol"] == "n60"]
    assert first["timestamp"] == closes["timestamp"].iloc[49].isoformat()
    assert first["value"] == pytest.approx(closes["close"].iloc[:50].mean())
    levels = batch.support_resistance(to_spark(spark, pdf)).where("symbol = 'n60'").first()
    assert documents["n60"]["trends"]["resistance_levels"] == levels.resistance_levels
    assert documents["n60"]["statistics"]["end_date"] == closes["timestamp"].iloc[-1].isoformat()


def test_intraday_documents_need_a_period(spark):
    bars = to_spark(spark, make_bars({"x": walk(60)}, freq="h"))
    with pytest.raises(ValueError):
        batch.indicator_document(bars, grain="hour")
    assert batch.indicator_document(bars, grain="hour", period="day").count() == 3


@pytest.mark.parametrize(
    ("closes", "expected"),
    [
        (list(range(1, 61)), "bullish"),
        (list(range(60, 0, -1)), "bearish"),
        ([5.0] * 60, "sideways"),
        ([5.0] * 25, "sideways"),
        (list(range(1, 26)), "bullish"),
        (list(range(1, 20)), None),
    ],
)
def test_trend(spark, closes, expected):
    rows = batch.trend(to_spark(spark, make_bars({"x": closes}))).collect()
    assert [r.trend for r in rows] == ([expected] if expected else [])


def test_symbol_range(spark, year):
    got = batch.symbol_indicators(to_spark(spark, year), "a", day("2020-02-01"), day("2020-02-29"))
    assert got.count() == 29
    assert batch.symbol_indicators(to_spark(spark, year), "zzz", day("2020-02-01"), day("2020-02-29")).count() == 0


# --- stores -----------------------------------------------------------------------------------------


def test_range_read_prunes_months(spark, year):
    path = workspace(spark, "t")
    store.write_bars(to_spark(spark, year), path)
    found = store.get_prices(spark, path, "a", day("2020-01-31"), day("2020-03-01"))
    assert [r.timestamp for r in found.collect()] == [day("2020-01-31") + timedelta(days=i) for i in range(31)]
    plan = formatted_plan(found)
    partition, pushed = (next(line for line in plan.splitlines() if line.startswith(k)) for k in ("PartitionFilters", "PushedFilters"))
    assert "year" in partition and "month" in partition
    assert "EqualTo(symbol,a)" in pushed and "GreaterThanOrEqual(timestamp" in pushed
    spans = store.get_prices(spark, path, "a", day("2020-12-15"), day("2021-01-10"))
    assert spans.count() == 27


def test_upsert_touches_only_its_months(spark, year):
    path = workspace(spark, "t")
    bars = to_spark(spark, year)
    store.write_bars(bars, path)
    before = {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    change = bars.where("symbol = 'a' AND timestamp = '2020-02-10'").withColumn("close", F.lit(1.25))
    late = change.withColumn("timestamp", F.lit(day("2020-02-10T12:00:00"))).withColumn("close", F.lit(9.0))
    versions = change.withColumn("seq", F.lit(2).cast("bigint")).unionByName(
        change.withColumn("close", F.lit(7.0)).withColumn("seq", F.lit(1).cast("bigint"))
    )
    store.upsert_bars(spark, path, versions.unionByName(late, allowMissingColumns=True), workspace(spark, "s"))
    after = {r.f for r in spark.read.parquet(path).select(F.input_file_name().alias("f")).distinct().collect()}
    assert all("month=02" in f and "year=2020" in f for f in before ^ after)
    stored = store.read_bars(spark, path)
    assert stored.count() == len(year) + 1
    assert stored.where("timestamp = '2020-02-10' AND symbol = 'a'").first().close == 1.25
    store.upsert_bars(spark, path, bars.limit(0), workspace(spark, "s"))
    assert store.read_bars(spark, path).count() == len(year) + 1


def test_bronze_appends_merge_columns_and_pad_dates(spark):
    path = workspace(spark, "t")
    raw = spark.createDataFrame([("x", day("2024-01-02"), 1.0)], "symbol string, timestamp timestamp, `Close` double")
    store.land_bronze(raw, path, ingest_ts=day("2024-03-04T05:06:07"))
    store.land_bronze(raw.withColumn("Volume", F.lit(5)), path, ingest_ts=day("2024-03-05"))
    rows = store.read_bronze(spark, path).orderBy("ingest_ts").collect()
    assert [(r.year, r.month, r.day, r.Volume) for r in rows] == [("2024", "03", "04", None), ("2024", "03", "05", 5)]
    assert store.latest_landing(store.read_bronze(spark, path)).first().Volume == 5


def test_unreadable_files_are_skipped(spark, tmp_path):
    good = str(tmp_path / "good")
    spark.createDataFrame([("x", 1.0)], "symbol string, close double").write.parquet(good)
    (tmp_path / "bad.parquet").write_bytes(b"not parquet")
    df = store.read_readable(spark, [good, str(tmp_path / "bad.parquet")], spark.read.parquet(good).schema)
    assert df.count() == 1


def test_stocks(spark):
    path = workspace(spark, "t")
    stocks = spark.createDataFrame([("x", "X", "NYSE")], "symbol string, name string, exchange string")
    store.write_stocks(stocks, path)
    store.write_stocks(stocks.withColumn("name", F.lit("renamed")), path)
    assert store.get_stock(spark, path, "x").first().name == "renamed"
    assert store.get_stock(spark, path, "y").count() == 0


def test_envelope_range_crosses_month_ends_and_keeps_microseconds(spark):
    path = workspace(spark, "t")
    times = [day("2024-01-30T23:59:59.000001"), day("2024-01-31T12:00:00"), day("2024-02-01T00:00:00"), day("2024-02-02T00:00:00")]
    df = spark.createDataFrame([("s", t, "secret value") for t in times], "src string, t timestamp, note string")
    store.write_envelopes(store.envelopes(df, F.col("src"), "kind", F.col("t"), ["note:remove"]), path)
    got = store.get_envelopes(spark, path, "s", "kind", times[0], times[2]).collect()
    assert [r.timestamp for r in got] == times[:3]
    assert json.loads(got[0].data)["note"] == "[REMOVED]" and got[0].metadata["version"] == "1.0"
    assert json.loads(got[0].data)["t"].startswith("2024-01-30T23:59:59.000001")


def test_point_reads_open_one_file_a_month(spark):
    path = workspace(spark, "t")
    bars = spark.range(200 * 59).select(
        F.format_string("s%03d", F.col("id") % 200).alias("symbol"),
        F.timestamp_seconds(F.lit(1704067200) + F.floor(F.col("id") / 200) * 86400).alias("timestamp"),
        *[F.col("id").cast("double").alias(c) for c in ("open", "high", "low", "close")],
        F.col("id").alias("volume"),
    )  # 59 days: January and most of February
    few = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in few}
    try:
        for name, value in few.items():
            spark.conf.set(name, value)
        ranged.write_ranged(conform_bars(bars), path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    start, end = day("2024-01-10"), day("2024-02-10")
    everything = ranged.files_of(spark, path, [f"s{i:03d}" for i in range(200)], start, end)
    assert len(everything) >= 12
    one = [ranged.files_of(spark, path, [f"s{i:03d}"], start, end) for i in range(0, 200, 20)]
    assert sum(map(len, one)) <= 2 * len(one) + len(everything)  # more than two only where a range begins within the symbol
    assert ranged.files_of(spark, path, ["zzz"], start, end) == [] and ranged.get_ranged(spark, path, "zzz", start, end).collect() == []
    got = ranged.get_ranged(spark, path, "s007", start, end)
    assert len(got.inputFiles()) <= 4
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, store.get_prices(spark, path, "s007", start, end).collect()))
    assert got.count() == 32

    # Files of other writers are read though no index lists them; indexed files that were replaced are passed over.
    more = bars.where("symbol = 's007'").withColumn("timestamp", F.expr("timestamp + interval 1 hour"))
    store.write_bars(conform_bars(more), path)
    assert ranged.get_ranged(spark, path, "s007", start, end).count() == 63
    store.write_bars(conform_bars(bars.where("symbol = 's009' AND timestamp < '2024-02-01'")), path, "overwrite")
    assert ranged.get_ranged(spark, path, ["s007", "s009"], start, end).count() == 19 + 32
    before = spark.read.parquet(f"{path}/{ranged.INDEX}").count()
    ranged.index_files(spark, path)
    ranged.index_files(spark, path)
    assert spark.read.parquet(f"{path}/{ranged.INDEX}").count() > before
    assert spark.read.parquet(f"{path}/{ranged.INDEX}").groupBy("file", "year", "month").count().where("count > 1").isEmpty()
    assert ranged.get_ranged(spark, path, ["s007", "s009"], start, end).count() == 19 + 32


def test_vendor_variants_match_texts(spark):
    """Values of other types, malformed fields and bodies that are no objects come out of a VARIANT as out of text."""
    fields = {"1. open": 1.5, "2. high": "2", "3. low": "bad", "4. close": None, "6. volume": "100"}
    series = {"2024-01-02": fields, "not a day": fields, "2024-01-03": {}}
    bodies = [
        ("a", json.dumps({vendor.SERIES_KEY: series})), ("b", json.dumps({vendor.ERROR_KEY: "limit"})), ("c", "{}"), ("d", "not json"), ("e", None),
        ("f", "[1]"), ("g", json.dumps({vendor.SERIES_KEY: "text"})), ("h", json.dumps({vendor.SERIES_KEY: {}})),
    ]
    responses = spark.createDataFrame(bodies, "symbol string, body string")
    path = f"{workspace(spark, 't')}/payloads"
    vendor.land_variants(responses).write.parquet(path)
    texts, variants = vendor.land_payloads(responses), spark.read.parquet(path)
    bars = [sorted(map(tuple, vendor.bars_from_payloads(p).collect()), key=str) for p in (texts, variants)]
    assert bars[0] == bars[1] and len(bars[0]) == 3
    rejects = [{r.symbol: (r.error, r.body) for r in vendor.split_payloads(p)[1].collect()} for p in (texts, variants)]
    assert {s: e for s, (e, _) in rejects[0].items()} == {s: e for s, (e, _) in rejects[1].items()}
    assert set(rejects[1]) == set("bcdefg") and rejects[1]["d"][1] == "not json" and json.loads(rejects[1]["b"][1]) == json.loads(bodies[1][1])
    plan = vendor.bars_from_payloads(variants)._jdf.queryExecution().toString()
    assert "from_json" not in plan and "parse_json" not in plan


def test_repeated_runs_replace_their_rejects_and_metrics(spark):
    path = workspace(spark, "t")
    lost = spark.createDataFrame([("a", "bad"), ("b", "bad")], "symbol string, error string")
    for rows, run in ((lost, "one"), (lost, "one"), (lost, "two"), (lost.where("symbol = 'a'"), "two"), (lost, None), (lost, None)):
        store.quarantine(rows, f"{path}/quarantine", "bar", run=run)
    store.quarantine(lost.limit(0), f"{path}/quarantine", "file", run="one")
    assert store.read_quarantine(spark, f"{path}/quarantine", "one").count() == 2
    assert store.read_quarantine(spark, f"{path}/quarantine", "two").count() == 1
    assert store.read_quarantine(spark, f"{path}/quarantine").count() == 7
    for _ in range(2):  # the second attempt replaces the first one's metrics; the events of both stay
        log = report.RunLog(spark, f"{path}/log", run="007")
        with log.trace("step"):
            log.metric("rows", 3)
        log.append_metrics(report.per_symbol(lost, "lost", F.lit(1), "x"), "lost")
        log.flush()
    assert {r.metric: r.samples for r in report.metric_report(log.metrics().drop("symbol").withColumn("symbol", F.lit("s"))).collect()} == {
        "rows": 1, "lost": 2, "step_seconds": 1,
    }
    assert log.events().count() == 4
    with pytest.raises(ValueError, match="named by"):
        report.RunLog(spark, f"{path}/log", run="a/b")


def test_vendor_payloads(spark):
    first_day = {"1. open": "1.5", "2. high": "2", "3. low": "1", "4. close": "1.7", "5. adjusted close": "1.6", "6. volume": "100"}
    good = json.dumps({vendor.SERIES_KEY: {"2024-01-02": first_day, "2024-02-02": {"1. open": "bad"}}})
    bodies = [("a", good), ("b", json.dumps({vendor.ERROR_KEY: "limit"})), ("c", "{}"), ("d", "not json")]
    landed = vendor.land_payloads(spark.createDataFrame(bodies, "symbol string, body string"))
    first, second = vendor.bars_from_payloads(landed).orderBy("timestamp").collect()
    assert (first.open, first.volume, first.adjusted_close) == (1.5, 100, 1.6) and second.open is None
    assert vendor.bars_from_payloads(landed, day("2024-01-02"), day("2024-01-31")).count() == 1
    accepted, rejected = vendor.split_payloads(landed)
    assert [r.symbol for r in accepted.collect()] == ["a"]
    assert {r.symbol: r.error for r in rejected.collect()} == {"b": "limit", "c": "unexpected response format", "d": "unexpected response format"}


# --- reports, layered run, streams ------------------------------------------------------------------


def test_summary_limits_errors(spark):
    requested = spark.createDataFrame([(f"s{i}",) for i in range(9)], "symbol string")
    bars = to_spark(spark, make_bars({"s0": walk(3), "s8": walk(2)}))
    summary = report.batch_summary(report.batch_status(requested, bars)).first()
    assert (summary.total, summary.successful, summary.failed) == (9, 2, 7)
    assert [e.symbol for e in summary.errors] == ["s1", "s2", "s3", "s4", "s5"]


def raw_frame(spark, pdf):
    names = {"open": "Open", "high": "High", "low": "Low", "close": "Close", "volume": "Volume"}
    return to_spark(spark, pdf).drop("adjusted_close").withColumnsRenamed(names)


def test_layered_run(spark, year):
    lake = lakes.Lake(workspace(spark, "lake"), raw_frame(spark, year).schema)
    log = lakes.run(spark, lake, raw_frame(spark, year), ingest_ts=day("2024-01-01"))
    again = lakes.run(spark, lake, raw_frame(spark, year), ingest_ts=day("2024-01-02"))
    silver = collect(lakes.read_silver(spark, lake))
    assert len(silver) == len(year)
    assert_same(silver["sma_20"], pd.concat([g["close"].rolling(20).mean() for _, g in year.groupby("symbol")]))
    assert spark.read.parquet(f"{lake.path('gold')}/monthly").where("symbol = 'a'").count() == 14
    assert spark.read.json(f"{lake.path('gold')}/statistics").count() == 3
    assert spark.read.json(lake.path("indicators")).count() == 3
    assert again.metrics().where("metric = 'records_extracted'").agg(F.sum("value")).first()[0] == 2 * len(year)
    traces = report.trace_report(log.events()).collect()
    assert len(traces) == 6 and all(t.status == "success" and t.events == 2 for t in traces)


def test_steps(spark, year):
    lake = lakes.Lake(workspace(spark, "lake"))
    lakes.run(spark, lake, raw_frame(spark, year), steps="bronze", symbols=["b"])
    lakes.run(spark, lake, steps="silver-gold", documents=False)
    assert {r.symbol for r in lakes.read_silver(spark, lake).select("symbol").distinct().collect()} == {"b"}
    with pytest.raises(ValueError):
        lakes.run(spark, lake, steps="platinum")
    with pytest.raises(ValueError):
        lakes.run(spark, lake, steps="bronze")
    broken = lakes.Lake(workspace(spark, "nothing-here"))
    with pytest.raises(Exception):
        lakes.run(spark, broken, steps="gold")
    failed = report.RunLog(spark, broken.path("log"))
    assert report.trace_report(failed.events()).first().status == "failed"


def test_newest_landing_and_recent_days_only(spark):
    lake = lakes.Lake(workspace(spark, "lake"))
    pdf = make_bars({"a": walk(60), "b": walk(60, 2)})
    old, new = pdf[pdf["timestamp"] < "2020-02-01"], pdf[(pdf["timestamp"] >= "2020-02-01") & (pdf["symbol"] == "a")]
    lakes.run(spark, lake, raw_frame(spark, old), steps="bronze", ingest_ts=day("2020-02-01"))
    lakes.run(spark, lake, raw_frame(spark, new), steps="bronze", ingest_ts=day("2020-03-01"))
    lakes.run(spark, lake, steps="silver", newest_only=True, documents=False)
    rows = lakes.read_silver(spark, lake).groupBy("symbol").agg(F.min("timestamp").alias("first"), F.count("*").alias("n"))
    assert {(r.symbol, str(r.first)[:10], r.n) for r in rows.collect()} == {("a", "2020-02-01", 29), ("b", "2020-01-01", 31)}
    recent = lakes.Lake(workspace(spark, "lake"))
    lakes.run(spark, recent, raw_frame(spark, pdf), steps="bronze-silver", as_of=day("2020-02-29"), days=10, documents=False)
    assert lakes.read_silver(spark, recent).count() == 22


def lake_of_two(spark):
    lake = lakes.Lake(workspace(spark, "lake"))
    pdf = make_bars({"a": walk(60), "b": walk(60, 2)})
    lakes.run(spark, lake, raw_frame(spark, pdf), ingest_ts=day("2024-01-01"))
    return lake, pdf


def stored_rows(spark, lake):
    silver = lakes.read_silver(spark, lake).toPandas().sort_values(["symbol", "timestamp"]).reset_index(drop=True)
    return silver, spark.read.parquet(f"{lake.path('gold')}/monthly").count(), spark.read.json(f"{lake.path('gold')}/statistics").count()


@pytest.mark.parametrize("part", [{"symbols": ["b"]}, {"days": 10, "as_of": day("2020-02-20")}, {"newest_only": True}])
def test_runs_on_a_part_leave_the_rest(spark, part):
    lake, pdf = lake_of_two(spark)
    before = stored_rows(spark, lake)
    lakes.run(spark, lake, steps="silver-gold", **part)
    after = stored_rows(spark, lake)
    pd.testing.assert_frame_equal(before[0], after[0], check_exact=False, atol=1e-9, rtol=0)
    assert before[1:] == after[1:]
    assert store.read_documents(spark, lake.path("indicators")).count() == 2


def test_a_correction_reaches_the_indicators_after_it(spark):
    lake, pdf = lake_of_two(spark)
    fix = pdf[(pdf["symbol"] == "a") & (pdf["timestamp"] == "2020-01-25")].assign(close=500.0)
    lakes.run(spark, lake, raw_frame(spark, fix), steps="bronze", ingest_ts=day("2024-01-02"))
    lakes.run(spark, lake, steps="silver", newest_only=True, documents=False)
    pdf.loc[fix.index, "close"] = 500.0
    got = collect(lakes.read_silver(spark, lake))
    assert_same(got["sma_20"], pd.concat([g["close"].rolling(20).mean() for _, g in pdf.groupby("symbol")]))


def test_bars_without_a_time_and_unreadable_files_are_set_aside(spark, tmp_path):
    root = tmp_path / "lake"
    lake = lakes.Lake(str(root))
    raw = raw_frame(spark, make_bars({"a": walk(30)})).withColumn("timestamp", F.col("timestamp").cast("string"))
    bad = raw.limit(1).withColumn("timestamp", F.lit("no time"))
    lakes.run(spark, lake, raw.unionByName(bad), steps="bronze-silver", documents=False)
    (root / "silver" / "year=2020" / "month=01" / "broken.parquet").write_bytes(b"not parquet")
    log = lakes.run(spark, lake, steps="gold")
    kept = {r.kind: (r.error, r.n) for r in store.read_quarantine(spark, lake.path("quarantine")).groupBy("kind", "error").agg(F.count("*").alias("n")).collect()}
    assert kept == {"bar": ("no symbol or no time", 1), "file": ("unreadable file: 0 of unknown rows read", 1)}
    counted = {r.metric: r.value for r in log.metrics().where("metric IN ('records_rejected', 'files_skipped')").collect()}
    assert counted == {"records_rejected": 1.0, "files_skipped": 1.0}
    assert spark.read.parquet(f"{lake.path('gold')}/monthly").count() == 1


def test_newest_landing_reads_its_days_only(spark):
    path = workspace(spark, "t")
    raw = spark.createDataFrame([("x", day("2024-01-02"), 1.0)], "symbol string, timestamp timestamp, `Close` double")
    for d in (4, 5, 6):
        store.land_bronze(raw, path, ingest_ts=day(f"2024-03-0{d}"))
    plan = formatted_plan(store.latest_landing(store.read_bronze(spark, path, raw.schema)))
    assert "20240306" in next(line for line in plan.splitlines() if line.startswith("PartitionFilters"))
    by_ledger = store.newest_landing(spark, path, raw.schema)
    filters = [line for line in formatted_plan(by_ledger).splitlines() if line.startswith("PartitionFilters")]
    assert len(filters) == 1 and re.search(r"year#\d+ = 2024", filters[0]) and re.search(r"day#\d+ = 06", filters[0])
    assert [r["ingest_ts"] for r in by_ledger.collect()] == [day("2024-03-06")]
    assert store.read_bronze(spark, path, raw.schema).count() == 3
    other = workspace(spark, "t")
    raw.withColumns({"ingest_ts": F.lit(day("2024-03-04")), "data_type": F.lit("prices"), "year": F.lit("2024"), "month": F.lit("03"), "day": F.lit("04")}).write.partitionBy("data_type", "year", "month", "day").parquet(other)
    assert store.newest_landing(spark, other, raw.schema).count() == 1


def test_unreadable_files_are_told_apart_by_their_paths(spark):
    """Months whose files share a name: a garbled one, one with a broken page, one without rows."""
    from pathlib import Path

    path = workspace(spark, "silver")
    bars = to_spark(spark, make_bars({f"s{i}": walk(170, i) for i in range(40)})).coalesce(1)
    store.write_bars(bars, path)
    typed = spark.read.parquet(path).schema
    assert store.unread_files(spark, [path], typed).collect() == []
    bars.limit(0).drop("symbol").write.parquet(f"{path}/year=2021/month=01")
    assert store.unread_files(spark, [path], typed).collect() == []
    garbage, pages = (next(Path(path).glob(f"year=2020/month=0{m}/*.parquet")) for m in (2, 4))
    garbage.write_bytes(b"not parquet")
    data = bytearray(pages.read_bytes())
    data[len(data) // 3 : len(data) // 3 + 200] = bytes(200)
    pages.write_bytes(data)
    for file in (garbage, pages):
        file.with_name(f".{file.name}.crc").unlink()
    found = {r["path"].removeprefix("file:"): (r["rows"], r["read"]) for r in store.unread_files(spark, [path], typed).collect()}
    assert set(found) == {str(garbage), str(pages)}
    assert found[str(garbage)] == (None, 0) and found[str(pages)][1] < found[str(pages)][0] == 30 * 40
    assert not names_in(spark, "/tmp/no-such-folder")


def test_upserts_leave_nothing_staged(spark):
    path, staging = workspace(spark, "prices"), workspace(spark, "staging")
    bars = to_spark(spark, make_bars({"a": walk(60, 1)}))
    sizes = []
    for _ in range(4):
        store.upsert_bars(spark, path, bars, staging)
        sizes.append(size_of(spark, path))
    assert not names_in(spark, staging) and max(sizes) < 1.1 * min(sizes)
    store.upsert_bars(spark, path, bars.limit(0), staging)
    assert not names_in(spark, staging)


def test_landing_moves_nothing(spark):
    from pyspark.sql.functions import spark_partition_id

    path = workspace(spark, "t")
    raw = raw_frame(spark, make_bars({"a": walk(40)})).repartition(5)
    store.land_bronze(raw, path, ingest_ts=day("2024-03-04"))
    files = spark.read.parquet(path).select(F.input_file_name()).distinct().count()
    assert files == raw.select(spark_partition_id()).distinct().count()


def test_malformed_profiles_are_no_stocks(spark):
    bodies = [("a", '{"Name": "A"}'), ("b", "{}"), ("c", "not json"), ("d", "[]"), ("e", None), ("f", '{"Error Message": "limit"}'), (None, "{}")]
    profiles = spark.createDataFrame(bodies, "symbol string, body string")
    assert {(r.symbol, r.name) for r in vendor.stocks_from_profiles(profiles).collect()} == {("a", "A"), ("b", "b")}
    assert sorted(str(r.symbol) for r in vendor.rejected_profiles(profiles).collect()) == ["None", "c", "d", "e", "f"]
    twice = vendor.stocks_from_profiles(profiles.union(profiles)).select("symbol", "name")
    assert store.new_stocks(twice, twice.limit(0)).count() == 2


def test_upserts_share_a_staging_folder(spark):
    path, staging = workspace(spark, "t"), workspace(spark, "s")
    a, b = (to_spark(spark, make_bars({s: walk(60)})) for s in ("a", "b"))
    store.upsert_bars(spark, path, a.where("month(timestamp) = 1"), staging)
    store.write_bars(b.where("month(timestamp) = 1"), path)
    store.upsert_bars(spark, path, a.where("month(timestamp) = 2"), staging)
    assert {(r.symbol, r["count"]) for r in store.read_bars(spark, path).groupBy("symbol").count().collect()} == {("a", 60), ("b", 31)}


def test_intraday_layered_run(spark):
    lake = lakes.Lake(workspace(spark, "lake"))
    pdf = make_bars({"a": walk(90), "b": walk(30, 2)}, freq="h")
    lakes.run(spark, lake, raw_frame(spark, pdf), grain="hour")
    silver = collect(lakes.read_silver(spark, lake))
    assert_same(silver["sma_20"], pd.concat([g["close"].rolling(20).mean() for _, g in pdf.groupby("symbol")]))
    statistics = spark.read.json(f"{lake.path('gold')}/statistics").where("symbol = 'a'").first()
    assert statistics.price_stats.median == pytest.approx(pdf[pdf["symbol"] == "a"]["close"].median())
    assert spark.read.json(lake.path("indicators")).count() == 2


def vendor_body(pdf: pd.DataFrame) -> str:
    days = {
        str(r.timestamp)[:10]: {vendor.BAR_FIELDS[c]: str(getattr(r, c)) for c in vendor.BAR_FIELDS} for r in pdf.itertuples()
    }
    return json.dumps({vendor.SERIES_KEY: days})


def test_batch_run(spark):
    stores = etl.Stores(workspace(spark, "etl"))
    pdf = make_bars({"a": walk(80), "b": walk(25, 2)})
    bodies = [(s, vendor_body(g)) for s, g in pdf.groupby("symbol")] + [("c", json.dumps({vendor.ERROR_KEY: "limit"}))]
    landed = vendor.land_payloads(spark.createDataFrame(bodies, "symbol string, body string"))
    profiles = spark.createDataFrame([("a", '{"Name": "A Inc"}'), ("b", "{}")], "symbol string, body string")
    start, end = day("2020-01-05"), day("2020-03-10")
    for _ in range(2):
        status, summary, log = etl.process_symbols(
            spark, stores, "a, b,c", landed, start, end, profiles, sensitive=["symbol:remove"], at=day("2024-01-01")
        )
    points = {r.symbol: (r.status, r.price_points, r.error) for r in status.collect()}
    assert points == {"a": ("success", 66, None), "b": ("success", 21, None), "c": ("error", 0, "limit")}
    assert tuple(summary.first())[:3] == (3, 2, 1)
    assert {(r.symbol, r.name) for r in store.read_stocks(spark, stores.path("stocks")).collect()} == {("a", "A Inc"), ("b", "b")}
    found = store.get_envelopes(spark, stores.path("envelopes"), "a", etl.INDICATORS, day("2024-01-01"), day("2024-01-01")).first()
    payload = json.loads(found.data)
    assert payload["symbol"] == "[REMOVED]" and len(json.loads(payload["document"])["sma_50"]) == 17
    wide = etl.technical_indicators(spark, stores, "a", start, end, log)
    assert wide.where("sma_50 IS NOT NULL").count() == 17
    assert etl.technical_indicators(spark, stores, "zzz", start, end, log).count() == 0
    log.flush()
    assert log.events().where("event_type = 'calculate_indicators_no_data'").count() == 1
    assert {t.status for t in report.trace_report(log.events().where("event_type LIKE 'trace%'")).collect()} == {"success"}


def _ended(log) -> bool:
    try:
        return log.events().where("event_type = 'trace_end_stream'").count() > 0
    except Exception:  # nothing has been written yet
        return False


def test_stream_events_are_logged(spark):
    source, sink, checkpoint, path = (workspace(spark, n) for n in ("in", "out", "cp", "log"))
    to_spark(spark, make_bars({"x": walk(5)})).write.parquet(source)
    log = report.RunLog(spark, path)
    listener = report.StreamLog(log)
    spark.streams.addListener(listener)
    try:
        write_enriched(read_records(spark, source), sink, checkpoint).awaitTermination()
        for _ in range(100):
            if _ended(log):
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    log.flush()
    traces = report.trace_report(log.events()).collect()
    assert [t.status for t in traces] == ["success"]


def test_stream_equals_batch(spark):
    source, sink, checkpoint = (workspace(spark, n) for n in ("in", "out", "cp"))
    bars = to_spark(spark, make_bars({"x": [0.0, *walk(50)]}))
    bars.write.parquet(source)
    write_enriched(read_records(spark, source), sink, checkpoint).awaitTermination()
    columns = ["timestamp", "daily_performance", "range", "intraday_volatility"]
    got, expected = (d.select(*columns).toPandas().sort_values("timestamp").reset_index(drop=True) for d in (spark.read.parquet(sink), enrich_intraday(bars)))
    pd.testing.assert_frame_equal(got, expected)


def flat(row):
    """The numbers and texts of a nested row, numbers apart so that they compare approximately."""
    values = [v for c in row for v in (c if isinstance(c, tuple) else [c])]
    return [v if isinstance(v, (int, float)) else hash(v) for v in values]


@pytest.mark.parametrize("grain", ["day", "hour"])
def test_incremental_silver_equals_full_silver(spark, grain):
    """In-order bars, gaps over a batch boundary, a new symbol, late bars, a correction, a replayed batch."""
    pdf = make_bars({"a": walk(90, 1), "b": walk(90, 2), "c": walk(30, 3)})
    pdf.loc[(pdf["symbol"] == "b") & pdf["timestamp"].between("2020-01-28", "2020-02-03"), "close"] = np.nan
    bronze, root, checkpoint = (workspace(spark, n) for n in ("bronze", "root", "cp"))
    t = pdf["timestamp"]
    late = (pdf["symbol"] == "a") & t.between("2020-01-10", "2020-01-12")
    wrong = pdf[(pdf["symbol"] == "b") & (t == "2020-01-05")].assign(close=1.0)
    first, second = t < "2020-02-01", (t >= "2020-02-01") & (t < "2020-03-01")
    batches = [
        pd.concat([pdf[first & ~late & (pdf["symbol"] != "c") & ~((pdf["symbol"] == "b") & (t == "2020-01-05"))], wrong]),
        pdf[second & (pdf["symbol"] != "c")],
        pd.concat([pdf[(t >= "2020-03-01") & (pdf["symbol"] != "c")], pdf[late], pdf[pdf["symbol"] == "c"], pdf[(pdf["symbol"] == "b") & (t == "2020-01-05")]]),
    ]
    for rows in batches:
        to_spark(spark, rows).write.mode("append").parquet(bronze)
        refresh = refresh_from(spark, bronze, root, checkpoint, grain)
    refresh.refresh(to_spark(spark, batches[-1]), 2)
    got, expected = collect(refresh.silver()), collect(batch.silver_bars(to_spark(spark, pdf)))
    pd.testing.assert_frame_equal(got[expected.columns], expected)
    months = collect(refresh.gold(), ("symbol", "year_month"))
    filled = batch.silver_bars(to_spark(spark, pdf))
    pd.testing.assert_frame_equal(months, collect(gold.monthly(filled), ("symbol", "year_month"))[list(months.columns)])
    by_symbol = {r["symbol"]: r for r in refresh.statistics().collect()}
    for r in gold.statistics(filled).collect():
        assert flat(by_symbol[r["symbol"]]) == pytest.approx(flat(r), rel=1e-9)
    assert not names_in(spark, refresh.path("staging"))
    published = workspace(spark, "published")
    refresh.publish(published)
    found = store.get_prices(spark, published, "b", day("2020-02-01"), day("2020-02-29"), SILVER_SCHEMA)
    assert found.where("sma_20 IS NOT NULL").count() == 29


def month_table(spark):
    return RunTable(spark, workspace(spark, "table"), BAR_SCHEMA, ["symbol", "timestamp"], store.month_parts)


def size_of(spark, path):
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).agg(F.sum("length")).first()[0] or 0


def test_runs_replace_rows_by_key_before_and_after_they_are_folded(spark):
    table = month_table(spark)
    assert table.read().collect() == [] and table.unread().collect() == []
    pdf = make_bars({"a": walk(90, 1), "b": walk(60, 2)})
    bars = to_spark(spark, pdf)
    table.append(bars, "load")
    loaded = size_of(spark, f"{table.path}/runs")
    late = bars.where("symbol = 'a' AND timestamp = TIMESTAMP '2020-02-05'").withColumn("close", F.lit(1.0))
    added = late.withColumn("timestamp", F.lit("2021-01-01").cast("timestamp"))
    table.append(late.unionByName(added), "late")
    assert size_of(spark, f"{table.path}/runs") - loaded < 10_000

    def state():
        return collect(table.read())

    after = state()
    assert len(after) == 151 and (after["close"] == 1.0).sum() == 2
    assert len(collect(table.read(["2020/02"]))) == 58 and len(collect(table.read(before="late"))) == 150
    table.compact(before="late")
    pd.testing.assert_frame_equal(state(), after)
    assert list(v for v, _ in table.state().runs.values()) == ["late"]
    table.compact()
    pd.testing.assert_frame_equal(state(), after)
    assert table.state().runs == {} and sorted(table.state().versions) == ["2020/01", "2020/02", "2020/03", "2021/01"]
    pd.testing.assert_frame_equal(collect(table.read(["2020/02"])), after[after["timestamp"].dt.strftime("%Y%m") == "202002"].reset_index(drop=True))


def test_a_repeated_step_replaces_what_it_wrote_and_later_ones_stay_on_top(spark):
    table = month_table(spark)
    bars = to_spark(spark, make_bars({"a": walk(5, 1)}))

    def closing(value):
        return bars.withColumn("close", F.lit(float(value)))

    for step, value in (("one", 1), ("two", 2), ("one", 3)):
        table.append(closing(value), step)
    assert {r["close"] for r in table.read().collect()} == {2.0}
    table.append(closing(4).where("day(timestamp) = 1"), "two")
    assert sorted(r["close"] for r in table.read().collect()) == [3.0] * 4 + [4.0]


def test_readers_keep_their_state_and_storage_stays_flat(spark):
    table = month_table(spark)
    bars = to_spark(spark, make_bars({"a": walk(60, 1), "b": walk(60, 2)}))
    table.append(bars, "load")
    before = table.read()
    sizes = []
    for i in range(6):
        table.append(bars.withColumn("close", F.lit(float(i))), f"step {i}")
        table.compact()
        if i == 0:
            assert {r["close"] for r in before.collect()} > {1.0} - {1.0} and before.agg(F.sum("close")).first()[0] != 0
        table.expire()
        sizes.append(size_of(spark, table.path))
    assert max(sizes) < 1.2 * min(sizes)
    assert {r["close"] for r in table.read().collect()} == {5.0}


def test_lost_cut_and_broken_files_are_named_with_their_rows(spark):
    table = month_table(spark)
    bars = to_spark(spark, make_bars({f"s{i}": walk(170, i) for i in range(40)})).coalesce(1)
    table.append(bars, "load")
    assert table.unread().collect() == []
    (_, name) = next(iter(table.state().runs.values()))
    paths = sorted(r["path"] for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{table.path}/runs/{name}").collect())
    assert len(paths) == 6 and len({p.rsplit("/", 1)[1] for p in paths}) == 1
    from pathlib import Path

    lost, garbage, pages = (Path(p.removeprefix("file:")) for p in paths[:3])
    remove(spark, str(lost))
    garbage.write_bytes(b"not parquet")
    data = bytearray(pages.read_bytes())
    data[len(data) // 3 : len(data) // 3 + 200] = bytes(200)
    pages.write_bytes(data)
    for file in (garbage, pages):
        crc = file.with_name(f".{file.name}.crc")
        crc.unlink()
    found = {"/" + r["file"].removeprefix("file:").lstrip("/"): (r["rows"], r["read"]) for r in table.unread().collect()}
    assert set(found) == {str(lost), str(garbage), str(pages)}
    assert all(read < rows for rows, read in found.values())


def test_a_late_bar_reads_its_months_only(spark):
    pdf = make_bars({"a": walk(700, 1), "b": walk(700, 2)})
    bronze, root, checkpoint = (workspace(spark, n) for n in ("bronze", "root", "cp"))
    late = (pdf["symbol"] == "a") & (pdf["timestamp"] == "2020-06-15")
    to_spark(spark, pdf[~late]).write.parquet(bronze)
    refresh = refresh_from(spark, bronze, root, checkpoint)
    new = to_spark(spark, pdf[late])
    found = refresh._late(new, refresh.table("tail").read().select(*BAR_SCHEMA.names))
    assert sorted(refresh._months_of(found, refresh.table("counts").read())) == ["202005", "202006", "202007", "202008"]
    refresh.refresh(new, 1)
    for name, months in (("bars", {"06"}), ("silver", {"06", "07"})):
        (_, folder) = refresh.table(name).state().runs[1]
        written = spark.read.parquet(f"{refresh.path(name)}/runs/{folder}")
        assert {f"{r['month']:02d}" for r in written.select("month").distinct().collect()} <= months
        assert {r["symbol"] for r in written.select("symbol").distinct().collect()} == {"a"}
    expected = collect(batch.silver_bars(to_spark(spark, pdf)))
    pd.testing.assert_frame_equal(collect(refresh.silver())[expected.columns], expected)


def test_a_late_bar_fills_the_missing_values_after_it(spark):
    lake = lakes.Lake(workspace(spark, "lake"))
    pdf = make_bars({"a": walk(60)})
    pdf.loc[pdf["timestamp"] == "2020-01-26", "close"] = None
    late = pdf["timestamp"] == "2020-01-25"
    lakes.run(spark, lake, raw_frame(spark, pdf[~late]), ingest_ts=day("2024-01-01"), documents=False)
    lakes.run(spark, lake, raw_frame(spark, pdf[late]), steps="bronze", ingest_ts=day("2024-01-02"))
    lakes.run(spark, lake, steps="silver", newest_only=True, documents=False)
    part = stored_rows(spark, lake)[0]
    lakes.run(spark, lake, steps="silver", documents=False)
    pd.testing.assert_frame_equal(part, stored_rows(spark, lake)[0], check_exact=False, atol=1e-9, rtol=0)
