"""What the physical plans must look like."""

from __future__ import annotations

import re

import pytest

from helpers import formatted_plan, make_bars, to_spark, walk
from marketlake.operators import batch
from marketlake.operators.indicators import compute, indicators
from marketlake.operators.series import cut, depth_cuts
from marketlake.sources.bars import bars_daily, bars_seconds, table
from marketlake.session import workspace


@pytest.fixture(scope="module")
def stored(spark):
    path = workspace(spark, "plans")
    to_spark(spark, make_bars({"a": walk(200), "b": walk(60)})).write.parquet(path)
    return spark.read.parquet(path)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(text: str) -> list[str]:
    return re.findall(r"(?<!Reused)Exchange (\w+\([^)]*\))", text)


def test_all_indicators_share_one_exchange(stored):
    text = plan(batch.indicators_wide(stored))
    assert len(exchanges(text)) == 1 and "symbol" in exchanges(text)[0]
    assert len(re.findall(r"\bSort \[", text)) == 2


def test_silver_from_ticks_needs_two_exchanges(spark, folder):
    assert len(exchanges(plan(batch.silver_bars(bars_daily(spark, folder))))) == 2


def test_slices_move_the_data_once(stored):
    """One exchange of all rows on (symbol, slice); the union of rows and halo keeps that partitioning."""
    df = indicators(stored, ["sma_20", "rsi_14"], grain="hour", slice_bars=32)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "Exchange" not in text[: text.index("Union")]
    assert "ReusedExchange" in text
    reads = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    assert sorted(len(r.split(",")) for r in reads)[:-1] == [2] * (len(reads) - 1)


@pytest.mark.parametrize("names", [["macd"], batch.WIDE])
def test_no_window_of_a_whole_symbol_carries_rows(stored, names):
    """What is gathered by symbol alone is one slim row per slice."""
    text = formatted_plan(indicators(stored, names, grain="hour", slice_bars=32))
    by_symbol = re.findall(r"\) Exchange\nInput \[\d+\]: \[([^\]]*)\]\nArguments: hashpartitioning\(symbol#\d+, \d+\)", text)
    assert by_symbol
    for columns in by_symbol:
        names = {c.split("#")[0] for c in columns.split(", ")}
        assert {n for n in names if not re.match("ema_(a|b|first|bars)", n)} <= {"symbol", "slice", "held", "before", "taker"}


def test_halos_are_small_whatever_the_spacing(spark, folder):
    """Sparse seconds: slices are of equal depth, and averages need no halo."""
    bars = bars_seconds(spark, folder).cache()
    rows = bars.count()
    cuts = depth_cuts(bars, 512)
    frame = cut(bars, cuts)
    sizes = [r["count"] for r in frame.groupBy("symbol", "slice").count().collect()]
    assert max(sizes) <= 2 * 512 and cuts.most >= rows // 3 // 512
    series = compute(bars, [n for n in batch.WIDE if n not in ("sma_50", "gates")], grain="second", slice_bars=512)
    assert series.frame.where("halo").count() < 0.1 * rows
    assert compute(bars, ["macd", "ema_20"], grain="second", slice_bars=512).frame.where("halo").isEmpty() if "halo" in series.frame.columns else True
    bars.unpersist()


def test_short_histories_are_not_cut(spark, stored):
    text = plan(indicators(stored, batch.WIDE, grain="minute"))
    assert len(exchanges(text)) == 1 and "Join" not in text and "Union" not in text


def test_intraday_cleaning_scans_once(stored):
    """Dedup, fill across slices and halo all read the same exchanges."""
    df = batch.silver_bars(stored, grain="hour")
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FileScan") == 1


def test_newest_bars_are_limited_before_the_exchange(stored):
    text = plan(batch.trend(stored))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial", text.index("Exchange"))
    assert text.count("WindowGroupLimit") == 2


def test_scans_read_only_what_they_need(spark, folder):
    text = plan(batch.trend(bars_daily(spark, folder)))
    assert "o_custkey" not in text and "o_orderpriority" not in text
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_tables_load_without_a_job(spark, folder):
    assert table(spark, folder, "orders").schema["o_orderdate"].dataType.typeName() == "timestamp_ntz"
