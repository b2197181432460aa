"""Indicators against pandas formulas, edge lengths, and the sliced path against the whole one."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import assert_same, collect, make_bars, to_spark, walk
from marketlake.operators import batch
from marketlake.operators import indicators as ind
from marketlake.operators.clean import forward_fill
from marketlake.operators.indicators import indicators
from marketlake.operators.recurrence import ema_over_gaps
from marketlake.operators.series import cut, depth_cuts
from marketlake.schema import MissingColumns

ALL = ["sma_5", "sma_20", "sma_50", "ema_5", "ema_20", "rsi_14", "bollinger", "macd", "atr_14", "pivots", "daily_return"]
LENGTHS = [1, 4, 5, 13, 14, 15, 19, 20, 25, 26, 29, 30, 49, 50, 51, 120]


def by_symbol(pdf: pd.DataFrame, fn) -> pd.Series:
    return pd.concat([fn(g) for _, g in pdf.groupby("symbol", sort=False)]).sort_index()


def rsi(close: pd.Series, n: int = 14) -> pd.Series:
    change = close.diff()
    gain, loss = change.clip(lower=0), (-change).clip(lower=0)
    return 100 - 100 / (1 + gain.rolling(n).mean() / loss.rolling(n).mean().replace(0, np.nan))


def partial_rsi(close: pd.Series, n: int = 14) -> pd.Series:
    change = close.diff().fillna(0)
    gain = change.clip(lower=0).rolling(n, min_periods=1).mean()
    loss = (-change).clip(lower=0).rolling(n, min_periods=1).mean()
    return (100 - 100 / (1 + gain / loss.replace(0, np.nan))).where(loss != 0, 100.0)


def atr(g: pd.DataFrame) -> pd.Series:
    before = g["close"].shift(1)
    spans = pd.concat([g["high"] - g["low"], (g["high"] - before).abs(), (g["low"] - before).abs()], axis=1)
    return spans.max(axis=1).rolling(14).mean()


def ema(close: pd.Series, span: int) -> pd.Series:
    return close.ewm(span=span, adjust=False).mean()


def macd_line(close: pd.Series) -> pd.Series:
    return ema(close, 12) - ema(close, 26)


EXPECTED = {
    "sma_5": lambda g: g["close"].rolling(5).mean(),
    "sma_20": lambda g: g["close"].rolling(20).mean(),
    "sma_50": lambda g: g["close"].rolling(50).mean(),
    "ema_5": lambda g: ema(g["close"], 5),
    "ema_20": lambda g: ema(g["close"], 20),
    "rsi_14": lambda g: rsi(g["close"]),
    "bb_upper": lambda g: g["close"].rolling(20).mean() + 2 * g["close"].rolling(20).std(),
    "bb_middle": lambda g: g["close"].rolling(20).mean(),
    "bb_lower": lambda g: g["close"].rolling(20).mean() - 2 * g["close"].rolling(20).std(),
    "macd": lambda g: macd_line(g["close"]),
    "macd_signal": lambda g: ema(macd_line(g["close"]), 9),
    "macd_histogram": lambda g: macd_line(g["close"]) - ema(macd_line(g["close"]), 9),
    "atr_14": atr,
    "daily_return": lambda g: g["close"].pct_change(fill_method=None),
}


def pivots(closes: np.ndarray) -> list[str | None]:
    out: list[str | None] = [None] * len(closes)
    for i in range(5, len(closes) - 5):
        near = np.delete(closes[i - 5 : i + 6], 5)
        if not (near > closes[i]).any():
            out[i] = "resistance"
        elif not (near < closes[i]).any():
            out[i] = "support"
    return out


@pytest.fixture(scope="module")
def lengths():
    return make_bars({f"n{n:03d}": walk(n, seed=n) for n in LENGTHS})


@pytest.fixture(scope="module")
def computed(spark, lengths):
    return collect(indicators(to_spark(spark, lengths), ALL))


@pytest.mark.parametrize("column", EXPECTED)
def test_matches_pandas_at_every_history_length(computed, lengths, column):
    assert_same(computed[column], by_symbol(lengths, EXPECTED[column]))


def test_pivots_match_a_neighbour_scan(computed, lengths):
    expected = [p for _, g in lengths.groupby("symbol") for p in pivots(g["close"].to_numpy())]
    assert [p if isinstance(p, str) else None for p in computed["pivot_type"]] == expected


def test_partial_warmup(spark, lengths):
    got = collect(indicators(to_spark(spark, lengths), ["sma_20", "rsi_14", "bollinger"], warmup="partial"))
    assert_same(got["sma_20"], by_symbol(lengths, lambda g: g["close"].rolling(20, min_periods=1).mean()))
    assert_same(got["rsi_14"], by_symbol(lengths, lambda g: partial_rsi(g["close"])))
    first = got.groupby("symbol").head(1)
    assert first["bb_upper"].isna().all() and first["bb_middle"].notna().all()


@pytest.mark.parametrize(
    ("closes", "full", "partial"),
    [([10.0] * 40, None, 100.0), (list(range(1, 41)), None, 100.0), (list(range(40, 0, -1)), 0.0, 0.0)],
)
def test_rsi_of_constant_rising_falling(spark, closes, full, partial):
    bars = to_spark(spark, make_bars({"x": closes}))
    last = collect(indicators(bars, ["rsi_14"]))["rsi_14"].iloc[-1]
    assert (np.isnan(last) if full is None else last == full)
    assert collect(indicators(bars, ["rsi_14"], warmup="partial"))["rsi_14"].iloc[-1] == partial


def test_flat_prices_are_resistance_with_zero_spread(spark):
    got = collect(indicators(to_spark(spark, make_bars({"x": [5.0] * 30})), ["pivots", "bollinger"]))
    assert got["pivot_type"].iloc[5:25].eq("resistance").all()
    assert got["pivot_type"].iloc[[0, 4, 25, 29]].isna().all()
    assert got["bb_upper"].iloc[-1] == got["bb_lower"].iloc[-1] == 5.0


def test_leading_nulls_start_the_averages_late(spark):
    pdf = make_bars({"x": [None] * 7 + walk(300, seed=5), "y": walk(40, seed=6)})
    got = collect(indicators(to_spark(spark, pdf), ["ema_5", "macd", "sma_5"]))
    for column in ("ema_5", "macd", "macd_signal", "sma_5"):
        assert_same(got[column], by_symbol(pdf, EXPECTED[column]))


def test_gates_hide_averages_of_short_histories(spark, lengths):
    got = collect(indicators(to_spark(spark, lengths), ["ema_5", "ema_20", "macd"], gated=True))
    sizes = got.groupby("symbol")["close"].transform("size")
    for column, least in (("ema_5", 5), ("ema_20", 20), ("macd", 26), ("macd_signal", 26)):
        assert (got[column].notna() == (sizes >= least)).all()


@pytest.mark.parametrize("slice_bars", [3, 40, 500])
def test_slices_change_nothing(spark, slice_bars):
    """Irregular gaps leave slices with few bars or none, so halos come from several slices."""
    pdf = make_bars({"a": walk(260, 1), "b": walk(90, 2), "c": walk(1, 3), "d": walk(27, 4)}, freq="h", gaps=True)
    bars = to_spark(spark, pdf)
    names = ["sma_5", "sma_20", "sma_50", "rsi_14", "bollinger", "atr_14", "pivots", "daily_return"]
    whole = collect(indicators(bars, names))
    sliced = collect(indicators(bars, names, grain="hour", slice_bars=slice_bars))
    assert list(whole.columns) == list(sliced.columns)
    pd.testing.assert_frame_equal(whole, sliced, check_exact=False, atol=1e-10, rtol=0)


def test_slices_over_many_partitions(spark):
    """Partitions small enough that rows and halo are coalesced differently."""
    closes = [v if i % 9 else None for i, v in enumerate(walk(20_000, 3), 1)]
    pdf = make_bars({"hot": closes, **{f"s{i}": walk(500, i) for i in range(20)}}, freq="s", gaps=True)
    small = {
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "5KB",
    }
    before = {k: spark.conf.get(k) for k in small}
    bars = to_spark(spark, pdf).cache()
    whole = collect(batch.silver_bars(bars))
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        filled = forward_fill(bars, grain="second", slice_bars=900, keep_slice=True)
        sliced = collect(indicators(filled, ["sma_20", "rsi_14"], grain="second", slice_bars=900))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
        bars.unpersist()
    pd.testing.assert_frame_equal(whole, sliced, check_exact=False, atol=1e-9, rtol=0)


def test_sliced_averages_forget_what_double_precision_forgets(spark):
    pdf = make_bars({"a": walk(4000, 1), "b": walk(700, 2)}, freq="s", gaps=True)
    bars = to_spark(spark, pdf)
    names = ["ema_5", "ema_20", "macd", "gates"]
    got = collect(indicators(bars, names, grain="second", slice_bars=20_000, gated=True))
    for column in ("ema_5", "ema_20", "macd", "macd_signal", "macd_histogram"):
        assert_same(got[column], by_symbol(pdf, EXPECTED[column]))
    assert got["has_50"].all() and got["has_5"].all()


@pytest.mark.parametrize("slice_bars", [1, 7, 60])
def test_scanned_averages_are_those_of_whole_histories(spark, slice_bars):
    """Slices far shorter than what an average remembers; leading nulls fill whole slices."""
    closes = {"a": walk(700, 1), "b": [None] * 130 + walk(260, 2), "c": walk(1, 3), "d": [None] * 40, "e": walk(8, 5)}
    pdf = make_bars(closes, freq="s", gaps=True)
    ind.register_indicator("ema_200", ind.ema(200))
    ind.register_indicator("ema_1", ind.ema(1))
    names = ["ema_1", "ema_5", "ema_20", "ema_200", "macd"]
    got = collect(indicators(to_spark(spark, pdf), names, grain="second", slice_bars=slice_bars, gated=False))
    for span in (1, 5, 20, 200):
        assert_same(got[f"ema_{span}"], by_symbol(pdf, lambda g: g["close"].ewm(span=span, adjust=False).mean() if span > 1 else g["close"]))
    for column in ("macd", "macd_signal", "macd_histogram"):
        assert_same(got[column], by_symbol(pdf, EXPECTED[column]))
    gated = collect(indicators(to_spark(spark, pdf), names, grain="second", slice_bars=slice_bars, gated=True))
    sizes = gated.groupby("symbol")["close"].transform("size")
    assert (gated["macd"].notna() == ((sizes >= 26) & got["macd"].notna())).all()
    del ind.REGISTRY["ema_200"], ind.REGISTRY["ema_1"]


def test_equal_depth_slices_follow_bursts(spark):
    """A million times denser in one stretch than elsewhere: slices still hold about as many rows, in order of time."""
    rows = [("a", i * 3600.0) for i in range(500)] + [("a", 500 * 3600 + i * 0.004) for i in range(20_000)] + [("b", float(i)) for i in range(90)]
    bars = spark.createDataFrame(rows, "symbol string, at double").select("symbol", F.timestamp_micros((F.col("at") * 1_000_000).cast("long")).alias("timestamp"))
    for slice_bars in (20, 100, 1000):
        cuts = depth_cuts(bars, slice_bars)
        found = cut(bars, cuts).groupBy("symbol", "slice").agg(F.count("*").alias("n"), F.min("timestamp").alias("first"), F.max("timestamp").alias("last")).toPandas()
        long = found[found["symbol"] == "a"].sort_values("slice")
        assert long["n"].max() <= 2 * slice_bars + 20_500 // 256 and long["n"].sum() == 20_500 and len(long) <= cuts.most
        assert (long["first"].to_numpy()[1:] > long["last"].to_numpy()[:-1]).all()
        assert (found["symbol"] == "b").sum() == (1 if slice_bars >= 90 else -(-90 // slice_bars))
    assert depth_cuts(bars, 50_000).knots is None


def test_a_new_indicator_can_be_registered(spark):
    ind.register_indicator(
        "highest_10", ind.Indicator(lambda s, w: {"highest_10": ind.rolling(s, "close", 10, w, how=ind.F.max)}, lookback=9)
    )
    pdf = make_bars({"x": walk(60)})
    got = collect(indicators(to_spark(spark, pdf), ["highest_10"]))
    assert_same(got["highest_10"], pdf["close"].rolling(10).max())
    del ind.REGISTRY["highest_10"]


def test_missing_columns_fail_before_any_job(spark):
    bars = to_spark(spark, make_bars({"x": walk(30)})).drop("high")
    with pytest.raises(MissingColumns):
        indicators(bars, ["atr_14"])
    indicators(bars, ["sma_5"])


def test_wide_spans(spark):
    pdf = make_bars({"x": walk(900)})
    ind.register_indicator("ema_200", ind.ema(200))
    ind.register_indicator("ema_1", ind.ema(1))
    got = collect(indicators(to_spark(spark, pdf), ["ema_200", "ema_1"]))
    assert_same(got["ema_200"], ema(pdf["close"], 200))
    assert_same(got["ema_1"], pdf["close"])
    del ind.REGISTRY["ema_200"], ind.REGISTRY["ema_1"]


def test_spans_far_apart_and_gaps(spark):
    pdf = make_bars({"a": walk(900, 1), "b": walk(40, 2)})
    ind.register_indicator("ema_200", ind.ema(200))
    got = collect(indicators(to_spark(spark, pdf), ["ema_5", "ema_200"]))
    for span in (5, 200):
        assert_same(got[f"ema_{span}"], by_symbol(pdf, lambda g: g["close"].ewm(span=span, adjust=False).mean()))


@pytest.mark.parametrize("span", [1, 2, 5, 26])
def test_averages_over_gaps_against_pandas(spark, span):
    rng = np.random.default_rng(span)
    holes = [None, None] + [v if rng.random() < 0.7 and not 200 < i < 320 else None for i, v in enumerate(walk(700, 4))]
    pdf = make_bars({"a": holes, "b": walk(30, 5), "c": [None, 1.0, None], "d": [None, None]})
    got = collect(ema_over_gaps(to_spark(spark, pdf), span))
    expected = by_symbol(pdf, lambda g: g["close"].ewm(span=span, adjust=False, ignore_na=False).mean()) if span > 1 else pdf.groupby("symbol")["close"].ffill()
    assert_same(got[f"ema_{span}"], expected)
