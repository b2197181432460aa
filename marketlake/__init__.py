"""Market-data analytics on PySpark: layered OHLCV bars, technical indicators, masking, streams.

Everything takes and returns DataFrames; a batch of one symbol and a batch of all run the same plan.
"""

from marketlake.functions.masking import mask_columns
from marketlake.functions.scalars import enrich_intraday
from marketlake.operators.batch import (
    batch_statistics,
    indicator_document,
    indicator_gates,
    indicators_wide,
    pivot_points,
    silver_bars,
    support_resistance,
    symbol_indicators,
    trend,
    volatility,
)
from marketlake.operators.clean import between, clean, forward_fill, keep_latest, last_days
from marketlake.operators.gold import monthly, statistics
from marketlake.operators.indicators import indicators, register_indicator
from marketlake.session import build_session

__all__ = [
    "batch_statistics",
    "between",
    "build_session",
    "clean",
    "enrich_intraday",
    "forward_fill",
    "indicator_document",
    "indicator_gates",
    "indicators",
    "indicators_wide",
    "keep_latest",
    "last_days",
    "mask_columns",
    "monthly",
    "pivot_points",
    "register_indicator",
    "silver_bars",
    "statistics",
    "support_resistance",
    "symbol_indicators",
    "trend",
    "volatility",
]
