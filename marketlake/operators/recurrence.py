"""Exponential moving averages as running sums over blocks of rows.

``y[t] = a*x[t] + (1-a)*y[t-1]`` with ``a = 2/(span+1)`` and ``y[0] = x[0]`` unrolls, within a block of
rows, to ``d^k * sum(a*x[i]*d^-i) + d^(k+1) * carry`` with ``d = 1-a``, ``k`` the offset in the block and
``carry`` the value at the end of the previous block. The sum is a running window sum. A block is long
enough that ``d^block`` is below 1e-18, so the carry is the previous block's own sum: anything older is
beyond double precision. No Python, no extra shuffle, constant work per row.

Over slices of a history it is a parallel prefix scan. What a slice does to the average that enters it is an affine map
``y -> A*y + B``, one slim row per slice; composing the maps along the symbol, in as many steps as the logarithm of the slices, gives
each slice the exact value that enters it, and its rows are corrected by what that value leaves of itself.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.series import Series

PRECISION = 1e-18
_MAX_EXPONENT = 600.0


def ema_reach(span: int) -> int:
    """Rows after which a span's weights have decayed below double precision."""
    decay = 1 - 2 / (span + 1)
    return 1 if decay <= 0 else math.ceil(math.log(PRECISION) / math.log(decay))


def span_groups(spans) -> list[tuple[int, set[int]]]:
    """Spans that can share blocks, with the rows of a block: within it the steepest weights must stay a double."""
    groups: list[tuple[int, set[int]]] = []
    for span in sorted(s for s in set(spans) if s > 1):
        block = ema_reach(span)
        if groups and block * -math.log(1 - 2 / (min(groups[-1][1]) + 1)) <= _MAX_EXPONENT:
            groups[-1] = (block, groups[-1][1] | {span})
        else:
            groups.append((block, {span}))
    return groups


def number_blocks(series: Series, source: str, spans) -> Series:
    """Add ``ema_pos`` (0 at the first value) and one ``ema_block`` per group of spans, shared by all EMAs over ``source``.

    Leading nulls are numbered -1. A null further on repeats the position before it, so the value there is
    carried and the row has no weight; see ``ema_over_gaps`` for averages whose weights decay there too.
    """
    own = F.when(~F.col("halo"), F.col(source)) if "halo" in series.frame.columns else F.col(source)
    frame = series.frame.withColumn("ema_pos", F.count(own).over(series.so_far) - 1)
    blocks = {f"ema_block_{i}": F.floor(F.col("ema_pos") / block) for i, (block, _) in enumerate(span_groups(spans))}
    return series.with_frame(frame.withColumns(blocks))


def add_ema(series: Series, columns: Mapping[str, tuple[str, int]], spans) -> Series:
    """Add ``{name: (source, span)}`` to a series numbered with the same ``spans``."""
    plain = {name: F.col(source) for name, (source, span) in columns.items() if span <= 1}
    if plain:
        series = series.with_frame(series.frame.withColumns(plain))
    for i, (block, members) in enumerate(span_groups(spans)):
        own = {name: spec for name, spec in columns.items() if spec[1] in members}
        if own:
            series = _add_group(series, own, f"ema_block_{i}", block)
    return series


def add_scanned_ema(series: Series, columns: Mapping[str, tuple[str, int]], spans) -> Series:
    """``add_ema`` over slices: within each from its own first value, then corrected by what enters the slice."""
    frame = series.frame
    live = F.col("ema_pos") >= 0
    if "halo" in frame.columns:
        live &= ~F.col("halo")
    sources = {s for s, _ in columns.values()}
    series = series.with_frame(frame.withColumns({f"ema_own_{s}": F.when(live, F.col(s)) for s in sources}))
    series = add_ema(series, {k: (f"ema_own_{s}", span) for k, (s, span) in columns.items()}, spans)
    lasting = {k: (s, span) for k, (s, span) in columns.items() if span > 1}
    if lasting:
        series = series.with_frame(_carried_on(series.frame, lasting, most_slices(series)))
    return series.with_frame(series.frame.drop(*[f"ema_own_{s}" for s in sources]))


def _carried_on(frame: DataFrame, columns: Mapping[str, tuple[str, int]], most: int) -> DataFrame:
    decay = {k: 1 - 2 / (span + 1) for k, (_, span) in columns.items()}
    own = frame.where(~F.col("halo")) if "halo" in frame.columns else frame
    seen = F.when(F.col("ema_pos") >= 0, F.col("timestamp"))
    ends = {f"ema_first_{s}": F.min_by(f"ema_own_{s}", F.when(F.col("ema_pos") == 0, F.col("timestamp"))) for s in {s for s, _ in columns.values()}}
    ends |= {f"ema_last_{k}": F.max_by(k, seen) for k in columns}
    slices = own.groupBy("symbol", "slice").agg((F.max("ema_pos") + 1).alias("ema_n"), *[v.alias(k) for k, v in ends.items()])
    left = {f"ema_a_{k}": _power(d, F.col("ema_n")) for k, d in decay.items()}
    slices = slices.withColumns(left).withColumns(
        {
            f"ema_b_{k}": F.coalesce(F.col(f"ema_last_{k}") - F.col(f"ema_a_{k}") * F.col(f"ema_first_{s}"), F.lit(0.0))
            for k, (s, _) in columns.items()
        }
    )
    slices = affine_scan(slices, {k: (f"ema_a_{k}", f"ema_b_{k}") for k in columns}, most)
    by_slice = Window.partitionBy("symbol").orderBy("slice")
    earlier = by_slice.rowsBetween(Window.unboundedPreceding, -1)
    begun = {s: F.first(f"ema_first_{s}", ignorenulls=True).over(earlier) for s in {s for s, _ in columns.values()}}
    entering = [
        (F.lag(f"ema_a_{k}").over(by_slice) * begun[s] + F.lag(f"ema_b_{k}").over(by_slice)).alias(f"ema_in_{k}") for k, (s, _) in columns.items()
    ]
    firsts = sorted({f"ema_first_{s}" for s, _ in columns.values()})
    joined = frame.join(slices.select("symbol", "slice", *firsts, *entering), ["symbol", "slice"], "left")
    fixed = {}
    for k, (s, _) in columns.items():
        entered = F.col(f"ema_in_{k}")
        later = F.col(k) + _power(decay[k], F.col("ema_pos") + 1) * (entered - F.col(f"ema_first_{s}"))
        fixed[k] = F.when(entered.isNull(), F.col(k)).when(F.col("ema_pos") < 0, entered).otherwise(later)
    return joined.withColumns(fixed).drop(*firsts, *[f"ema_in_{k}" for k in columns])


def affine_scan(slices: DataFrame, maps: Mapping[str, tuple[str, str]], most: int) -> DataFrame:
    """Replace the maps ``y -> a*y + b`` of each slice (symbol, slice, a and b) by their composition with those of all slices before it.

    Each step composes with the slice twice as far back as the step before, so the steps are the logarithm of ``most``,
    the slices of the longest history. The rows are one per slice.
    """
    by_slice = Window.partitionBy("symbol").orderBy("slice")
    back = 1
    while back < most:
        before = {c: F.lag(c, back).over(by_slice) for pair in maps.values() for c in pair}
        slices = slices.withColumns({f"ema_back_{c}": v for c, v in before.items()})
        slices = slices.withColumns(
            {b: F.col(b) + F.coalesce(F.col(a) * F.col(f"ema_back_{b}"), F.lit(0.0)) for a, b in maps.values()}
            | {a: F.col(a) * F.coalesce(F.col(f"ema_back_{a}"), F.lit(1.0)) for a, _ in maps.values()}
        ).drop(*[f"ema_back_{c}" for c in before])
        back *= 2
    return slices


def most_slices(series: Series) -> int:
    if series.most is not None:
        return series.most
    return series.frame.groupBy("symbol").agg(F.count_distinct("slice").alias("n")).agg(F.max("n")).first()[0] or 1


def bars_of_symbol(series: Series) -> DataFrame:
    """The frame of slices with ``ema_bars``, all bars of the symbol, from one row per slice."""
    own = series.frame.where(~F.col("halo")) if "halo" in series.frame.columns else series.frame
    counted = own.groupBy("symbol", "slice").agg(F.count("*").alias("ema_bars"))
    total = F.sum("ema_bars").over(Window.partitionBy("symbol"))
    return series.frame.join(counted.select("symbol", "slice", total.alias("ema_bars")), ["symbol", "slice"], "left")


def _add_group(series: Series, columns: Mapping[str, tuple[str, int]], place: str, block: int) -> Series:
    in_block = (
        Window.partitionBy(*series.keys, place)
        .orderBy("timestamp")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    # the block rises with time, so this order is the sort the block window already made
    before = Window.partitionBy(*series.keys).orderBy(place, "timestamp").rowsBetween(Window.unboundedPreceding, -1)
    offset = F.col("ema_pos") - F.col(place) * block
    decays = {name: 1 - 2 / (span + 1) for name, (_, span) in columns.items()}
    frame = series.frame.withColumns(
        {
            f"sum_{name}": F.sum(
                F.when(F.col("ema_pos") == 0, F.col(source)).otherwise(
                    F.col(source) * (2 / (span + 1)) * _power(decays[name], -offset)
                )
            ).over(in_block)
            for name, (source, span) in columns.items()
        }
    )
    frame = frame.withColumns({f"sum_{name}": F.col(f"sum_{name}") * _power(decays[name], offset) for name in columns})
    carried = {
        f"carry_{name}": F.last(F.when(offset == block - 1, F.col(f"sum_{name}")), ignorenulls=True).over(before)
        for name in columns
    }
    frame = frame.withColumns(carried).withColumns(
        {
            name: F.col(f"sum_{name}")
            + F.coalesce(F.col(f"carry_{name}") * _power(decays[name], offset + 1), F.lit(0.0))
            for name in columns
        }
    )
    return series.with_frame(frame.drop(*[f"{p}_{n}" for n in columns for p in ("sum", "carry")]))


def drop_blocks(series: Series) -> Series:
    return series.with_frame(series.frame.drop(*[c for c in series.frame.columns if c == "ema_pos" or c.startswith("ema_block_")]))


def ema_over_gaps(bars: DataFrame, span: int, source: str = "close") -> DataFrame:
    """Add ``ema_<span>`` whose old weight decays over NULLs too, for bars of a day or more apart.

    After g steps ``y' = (d^g * y + a * x) / (d^g + a)``; a NULL repeats the value before it. So ``y`` is a sum of values weighted by a
    running product of ``d^g / (d^g + a)``, taken as in ``add_ema`` within blocks in which the product stays a double.
    A block closes once its product is below 1e-18, so its last value needs nothing older.
    """
    if span <= 1:
        return bars.withColumn(f"ema_{span}", F.last(source, ignorenulls=True).over(_so_far()))
    a = 2 / (span + 1)
    by_time = Window.partitionBy("symbol").orderBy("timestamp")
    valued = F.col(source).isNotNull()
    rows = bars.withColumn("gap_row", F.row_number().over(by_time))
    known = F.last(F.when(valued, F.col("gap_row")), ignorenulls=True).over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    kept = F.pow(F.lit(1 - a), F.least(F.col("gap_row") - known, F.lit(10 * ema_reach(span))))
    rows = rows.withColumn("gap_kept", F.when(known.isNull(), F.lit(1.0)).otherwise(kept))
    share = F.col("gap_kept") / (F.col("gap_kept") + a)
    first = F.count(F.when(valued, 1)).over(_so_far()) == 1
    step = F.when(valued & ~first, -F.ln(F.greatest(share, F.lit(PRECISION)))).otherwise(0.0)
    rows = rows.withColumns({"gap_first": first, "gap_step": step})
    rows = rows.withColumn("gap_fall", F.sum("gap_step").over(_so_far()))
    rows = rows.withColumn("gap_block", F.floor(F.col("gap_fall") / 200.0))
    weight = F.when(F.col("gap_first"), 1.0).otherwise(a / (F.col("gap_kept") + a))
    start = F.col("gap_block") * 200.0
    in_block = Window.partitionBy("symbol", "gap_block").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    part = F.sum(F.when(valued, F.col(source) * weight * F.exp(F.col("gap_fall") - start))).over(in_block) * F.exp(start - F.col("gap_fall"))
    rows = rows.withColumn("gap_sum", part)
    blocks = Window.partitionBy("symbol").orderBy("gap_block", "timestamp").rowsBetween(Window.unboundedPreceding, -1)
    last = F.last(F.when(valued, F.struct("gap_block", "gap_sum", "gap_fall")), ignorenulls=True).over(blocks)
    rows = rows.withColumn("gap_last", last)
    end = Window.partitionBy("symbol", "gap_block").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carry = F.first(F.struct("gap_last.gap_sum", "gap_last.gap_fall")).over(end)
    rows = rows.withColumn("gap_carry", carry)
    older = F.coalesce(F.col("gap_carry.gap_sum") * F.exp(F.col("gap_carry.gap_fall") - F.col("gap_fall")), F.lit(0.0))
    rows = rows.withColumn(f"ema_{span}", F.coalesce("gap_sum", F.lit(0.0)) + older)
    seen = F.count(source).over(_so_far()) > 0
    rows = rows.withColumn(f"ema_{span}", F.when(seen, F.col(f"ema_{span}")))
    return rows.drop(*[c for c in rows.columns if c.startswith("gap_")])


def _so_far():
    return Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _power(base: float, exponent):
    return F.pow(F.lit(base), exponent)
