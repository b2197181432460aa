"""Technical indicators as window columns.

All indicators of one call share a window specification, so Spark plans one exchange and one sort for
them (plus one sort for the moving-average blocks). ``warmup="full"`` yields a value only once a window
is full, ``warmup="partial"`` from the first bar on.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import recurrence
from marketlake.operators.series import SLICE_BARS, Cuts, Series, as_series
from marketlake.schema import require_columns

Columns = dict[str, Column]


@dataclass(frozen=True)
class Indicator:
    """One entry of the registry.

    ``build(series, warmup)`` returns the output columns. ``inputs`` name lag-based columns of ``INPUTS``
    that must exist first, because Spark does not nest a window inside a windowed aggregate.
    """

    build: Callable[[Series, str], Columns]
    lookback: int = 0
    lookahead: int = 0
    inputs: tuple[str, ...] = ()
    needs: tuple[str, ...] = ("close",)


@dataclass(frozen=True)
class MovingAverage:
    """A recurrence indicator: exponential averages, then columns computed from them, in stages.

    It needs no halo: what earlier slices leave is carried from slice to slice.
    """

    stages: tuple[dict[str, tuple[str, int]], ...]
    derive: Callable[[int], Columns]
    outputs: tuple[str, ...]
    min_bars: int
    needs: tuple[str, ...] = ("close",)

    @property
    def spans(self) -> set[int]:
        return {span for stage in self.stages for _, span in stage.values()}


# --- lag-based inputs -------------------------------------------------------------------------------


def previous_close(series: Series) -> Column:
    return F.lag("close").over(series.ordered)


def _gain(series: Series, warmup: str) -> Column:
    return _one_sided(F.col("close") - previous_close(series), warmup)


def _loss(series: Series, warmup: str) -> Column:
    return _one_sided(previous_close(series) - F.col("close"), warmup)


def _one_sided(change: Column, warmup: str) -> Column:
    if warmup == "partial":
        return F.when(change > 0, change).otherwise(0.0)
    return F.when(change.isNotNull(), F.greatest(change, F.lit(0.0)))


def _true_range(series: Series, warmup: str) -> Column:
    before = previous_close(series)
    high, low = F.col("high"), F.col("low")
    return F.greatest(high - low, F.abs(high - before), F.abs(low - before))


def _daily_return(series: Series, warmup: str) -> Column:
    return F.try_divide(F.col("close"), previous_close(series)) - 1


INPUTS: dict[str, Callable[[Series, str], Column]] = {
    "gain": _gain,
    "loss": _loss,
    "true_range": _true_range,
    "daily_return": _daily_return,
}


# --- builders ---------------------------------------------------------------------------------------


def rolling(series: Series, name: str, n: int, warmup: str, how=F.avg) -> Column:
    window = series.trailing(n)
    value = how(name).over(window)
    if warmup == "partial":
        return value
    return F.when(F.count(name).over(window) >= n, value)


def sma(n: int) -> Indicator:
    return Indicator(lambda s, warmup: {f"sma_{n}": rolling(s, "close", n, warmup)}, lookback=n - 1)


def rsi(n: int = 14) -> Indicator:
    def build(series: Series, warmup: str) -> Columns:
        gain = rolling(series, "gain", n, warmup)
        loss = rolling(series, "loss", n, warmup)
        strength = 100 - F.lit(100.0) / (1 + F.try_divide(gain, loss))
        if warmup == "partial":
            strength = F.when(loss == 0, F.lit(100.0)).otherwise(strength)
        return {f"rsi_{n}": strength}

    return Indicator(build, lookback=n, inputs=("gain", "loss"))


def bollinger(n: int = 20, k: float = 2.0) -> Indicator:
    def build(series: Series, warmup: str) -> Columns:
        middle = rolling(series, "close", n, warmup)
        spread = rolling(series, "close", n, warmup, how=F.stddev_samp) * k
        return {"bb_upper": middle + spread, "bb_middle": middle, "bb_lower": middle - spread}

    return Indicator(build, lookback=n - 1)


def atr(n: int = 14) -> Indicator:
    return Indicator(
        lambda s, warmup: {f"atr_{n}": rolling(s, "true_range", n, warmup)},
        lookback=n,
        inputs=("true_range",),
        needs=("high", "low", "close"),
    )


def pivots(half_window: int = 5) -> Indicator:
    def build(series: Series, warmup: str) -> Columns:
        near = series.around(half_window)
        inside = F.count("*").over(near) == 2 * half_window + 1
        close = F.col("close")
        kind = F.when(close >= F.max("close").over(near), "resistance").when(
            close <= F.min("close").over(near), "support"
        )
        return {"pivot_type": F.when(inside & close.isNotNull(), kind)}

    return Indicator(build, lookback=half_window, lookahead=half_window)


def ema(span: int) -> MovingAverage:
    name = f"ema_{span}"
    return MovingAverage(({name: ("close", span)},), lambda stage: {}, (name,), min_bars=span)


def macd(fast: int = 12, slow: int = 26, signal: int = 9) -> MovingAverage:
    def derive(stage: int) -> Columns:
        if stage == 0:
            return {"macd": F.col("macd_fast") - F.col("macd_slow")}
        return {"macd_histogram": F.col("macd") - F.col("macd_signal")}

    return MovingAverage(
        ({"macd_fast": ("close", fast), "macd_slow": ("close", slow)}, {"macd_signal": ("macd", signal)}),
        derive,
        ("macd", "macd_signal", "macd_histogram"),
        min_bars=max(fast, slow, signal),
    )


REGISTRY: dict[str, Indicator | MovingAverage] = {
    "sma_5": sma(5),
    "sma_20": sma(20),
    "sma_50": sma(50),
    "ema_5": ema(5),
    "ema_20": ema(20),
    "rsi_14": rsi(14),
    "bollinger": bollinger(20, 2.0),
    "macd": macd(12, 26, 9),
    "atr_14": atr(14),
    "pivots": pivots(5),
    "daily_return": Indicator(lambda s, warmup: {}, lookback=1, inputs=("daily_return",)),
    "true_range": Indicator(lambda s, warmup: {}, lookback=1, inputs=("true_range",), needs=("high", "low", "close")),
}


def register_indicator(name: str, indicator: Indicator | MovingAverage) -> None:
    REGISTRY[name] = indicator


# --- evaluation -------------------------------------------------------------------------------------


def indicators(
    bars: DataFrame,
    names: Iterable[str],
    warmup: str = "full",
    grain: str = "day",
    gated: bool = False,
    slice_bars: int = SLICE_BARS,
    cuts: Cuts | None = None,
) -> DataFrame:
    """Add the named indicators to ``bars``.

    Closes must be forward-filled (leading nulls are fine). With ``gated`` a moving average stays NULL for
    symbols with fewer bars than its minimum history.
    """
    return compute(bars, names, warmup, grain, gated, slice_bars, cuts).result()


def compute(bars, names, warmup="full", grain="day", gated=False, slice_bars=SLICE_BARS, cuts=None) -> Series:
    if warmup not in ("full", "partial"):
        raise ValueError("warmup is 'full' or 'partial'")
    chosen = [REGISTRY[n] for n in names]
    require_columns(bars, "symbol", "timestamp", *{c for i in chosen for c in i.needs})
    plain = [i for i in chosen if isinstance(i, Indicator)]
    series = as_series(
        bars,
        grain,
        lookback=max((i.lookback for i in plain), default=0),
        lookahead=max((i.lookahead for i in plain), default=0),
        slice_bars=slice_bars,
        cuts=cuts,
    )
    wanted = set(bars.columns)
    inputs = {n: INPUTS[n](series, warmup) for i in plain for n in i.inputs}
    if inputs:
        series = series.with_frame(series.frame.withColumns(inputs))
    outputs: Columns = {}
    for indicator in plain:
        outputs.update(indicator.build(series, warmup))
    if outputs:
        series = series.with_frame(series.frame.withColumns(outputs))
    shown = set(outputs) | ({n for n in names} & set(inputs))
    series = series.with_frame(series.frame.drop(*[n for n in inputs if n not in shown and n not in wanted]))
    averages = [i for i in chosen if isinstance(i, MovingAverage)]
    return _moving_averages(series, averages, gated) if averages else series


def _moving_averages(series: Series, averages: list[MovingAverage], gated: bool) -> Series:
    spans = set().union(*(a.spans for a in averages))
    sliced = "slice" in series.keys
    if gated:
        bars = recurrence.bars_of_symbol(series) if sliced else series.frame.withColumn("ema_bars", F.count("*").over(series.whole))
        series = series.with_frame(bars)
    series = recurrence.number_blocks(series, "close", spans)
    for stage in range(max(len(a.stages) for a in averages)):
        live = [a for a in averages if stage < len(a.stages)]
        columns = {k: v for a in live for k, v in a.stages[stage].items()}
        series = recurrence.add_scanned_ema(series, columns, spans) if sliced else recurrence.add_ema(series, columns, spans)
        derived = {k: v for a in live for k, v in a.derive(stage).items()}
        if derived:
            series = series.with_frame(series.frame.withColumns(derived))
    if gated:
        series = series.with_frame(
            series.frame.withColumns(
                {o: F.when(F.col("ema_bars") >= a.min_bars, F.col(o)) for a in averages for o in a.outputs}
            ).drop("ema_bars")
        )
    shown = {o for a in averages for o in a.outputs}
    scratch = [n for a in averages for stage in a.stages for n in stage if n not in shown]
    series = series.with_frame(series.frame.drop(*scratch))
    return recurrence.drop_blocks(series)
