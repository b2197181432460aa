"""Fixtures made by hand and comparisons against pandas."""

from __future__ import annotations

import numpy as np
import pandas as pd

from marketlake.schema import BAR_SCHEMA


def make_bars(closes: dict[str, list], start="2020-01-01", freq="D", gaps: bool = False, seed: int = 7) -> pd.DataFrame:
    """Bars around the given closes; with ``gaps`` the timestamps skip grid points."""
    rng = np.random.default_rng(seed)
    parts = []
    for symbol, values in closes.items():
        close = np.array([np.nan if v is None else float(v) for v in values])
        n = len(close)
        steps = rng.integers(1, 40, n) if gaps else np.ones(n, dtype=int)
        steps[:1] = 0
        times = pd.Timestamp(start) + pd.to_timedelta(np.cumsum(steps), unit={"D": "D", "h": "h", "s": "s"}[freq])
        spread = rng.uniform(0.1, 2.0, n)
        parts.append(
            pd.DataFrame(
                {
                    "symbol": symbol,
                    "timestamp": times,
                    "open": close + rng.uniform(-1, 1, n),
                    "high": close + spread,
                    "low": close - spread,
                    "close": close,
                    "volume": rng.integers(1, 10_000, n),
                    "adjusted_close": close,
                }
            )
        )
    return pd.concat(parts, ignore_index=True)


def walk(n: int, seed: int = 1, start: float = 100.0) -> list[float]:
    rng = np.random.default_rng(seed)
    return list(np.round(np.abs(start + np.cumsum(rng.normal(0, 1, n))) + 1, 4))


def to_spark(spark, pdf: pd.DataFrame, shuffle: bool = True):
    if shuffle:
        pdf = pdf.sample(frac=1.0, random_state=3)
    rows = [tuple(None if pd.isna(v) else v for v in r) for r in pdf[BAR_SCHEMA.names].itertuples(index=False)]
    rows = [(r[0], r[1].to_pydatetime(), *r[2:]) for r in rows]
    return spark.createDataFrame(rows, BAR_SCHEMA)


def collect(df, keys=("symbol", "timestamp")) -> pd.DataFrame:
    return df.toPandas().sort_values(list(keys)).reset_index(drop=True)


def assert_same(actual: pd.Series, expected: pd.Series, tolerance: float = 1e-8) -> None:
    a, e = actual.astype(float).to_numpy(), expected.astype(float).to_numpy()
    assert a.shape == e.shape
    np.testing.assert_array_equal(np.isnan(a), np.isnan(e))
    np.testing.assert_allclose(a[~np.isnan(a)], e[~np.isnan(e)], rtol=0, atol=tolerance)


def formatted_plan(df) -> str:
    spark = df.sparkSession
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
