"""The batch run over requested symbols: extract, compute, load, report.

The loop over symbols is the partitioning by symbol; a symbol without data becomes an error row instead of
an exception.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.batch import indicator_document, indicators_wide
from marketlake.operators.clean import between, forward_fill
from marketlake.operators.series import default_period
from marketlake.plans import report
from marketlake.schema import BAR_SCHEMA
from marketlake.sources import store, vendor

INDICATORS = "technical_indicators"


@dataclass(frozen=True)
class Stores:
    """Folders of the price store, the stock dimension, the envelopes, staged rewrites and the log."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"


def extract(
    spark: SparkSession, stores: Stores, requested: DataFrame, payloads: DataFrame, start: datetime, end: datetime, run: str | None = None
) -> None:
    """Upsert the requested symbols' bars from landed payloads.

    The newest payload of a day wins. ``requested`` has one row per symbol; AQE broadcasts it only when it
    measures small.
    """
    wanted = payloads.join(requested, "symbol", "left_semi")
    store.quarantine(vendor.split_payloads(wanted)[1].select("symbol", "body", "error"), stores.path("quarantine"), "payload", run=run)
    newest = F.unix_micros("ingest_ts")
    stamped = vendor.bars_from_payloads(wanted.withColumn("seq", newest), start, end)
    store.upsert_bars(spark, stores.path("prices"), stamped, stores.path("staging"))


def add_new_stocks(spark: SparkSession, stores: Stores, profiles: DataFrame, run: str | None = None) -> None:
    """Store the stocks that are not stored yet."""
    known = stores.path("stocks")
    store.quarantine(vendor.rejected_profiles(profiles).select("symbol", "body", "error"), stores.path("quarantine"), "profile", run=run)
    incoming = vendor.stocks_from_profiles(profiles).select("symbol", "name", "exchange", "sector", "industry")
    stored = store.read_stocks(spark, known)
    store.write_stocks(store.new_stocks(incoming, stored), known)


def technical_indicators(
    spark: SparkSession, stores: Stores, symbol: str, start: datetime, end: datetime, log: report.RunLog, **options
) -> DataFrame:
    """All indicators of one stored symbol over a range; an empty range is logged."""
    bars = store.get_prices(spark, stores.path("prices"), symbol, start, end)
    if bars.isEmpty():
        log.event("calculate_indicators_no_data", symbol=symbol, start=start, end=end)
    return indicators_wide(forward_fill(bars), **options)


def process_symbols(
    spark: SparkSession,
    stores: Stores,
    symbols: str | Sequence[str],
    payloads: DataFrame,
    start: datetime,
    end: datetime,
    profiles: DataFrame | None = None,
    calculate_indicators: bool = True,
    sensitive: Sequence[str] = (),
    at: datetime | None = None,
    grain: str = "day",
    period: str | None = None,
    run_id: str | None = None,
) -> tuple[DataFrame, DataFrame, report.RunLog]:
    """Run the batch; returns (result per symbol, one-row summary, log).

    ``grain`` is the spacing of the bars and ``period`` what one document covers: a whole history of bars a day or more
    apart, a stated part of an intraday one (by default the one that ``default_period`` names). Neither depends on the data's size.
    Rejected payloads and profiles go to the quarantine table and are counted; their text is the symbol's error.
    A batch that is repeated under its ``run_id`` replaces the rejects and metrics of its earlier attempt.
    """
    log = report.RunLog(spark, stores.path("log"), run=run_id)
    listed = symbols if isinstance(symbols, str) else ",".join(symbols)
    requested = report.requested_symbols(spark.createDataFrame([(listed,)], "symbols string"), "symbols")
    with log.trace("batch_process", symbols=listed, start=start, end=end):
        if profiles is not None:
            with log.trace("stocks"):
                add_new_stocks(spark, stores, profiles.join(requested, "symbol", "left_semi"), log.run)
        with log.trace("extraction", data_type="historical_prices"):
            extract(spark, stores, requested, payloads, start, end, log.run)
        stored = store.between_months(store.read_bars(spark, stores.path("prices")), start, end)
        bars = stored.select(*BAR_SCHEMA.names).join(requested, "symbol", "left_semi")
        log.append_metrics(report.records_extracted(bars, "historical_prices"), "extracted")
        rejected = store.read_quarantine(spark, stores.path("quarantine"), log.run)
        log.append_metrics(report.per_symbol(rejected.groupBy("symbol").count(), "records_rejected", F.col("count"), "historical_prices"), "rejected")
        stamp = F.lit(at).cast("timestamp") if at else F.current_timestamp()
        calculated = None
        if calculate_indicators:
            with log.trace("load", data_type=INDICATORS):
                documents = indicator_document(forward_fill(bars, grain=grain), grain, period or default_period(grain))
                wrapped = store.envelopes(documents, F.col("symbol"), INDICATORS, stamp, sensitive)
                store.write_envelopes(wrapped, stores.path("envelopes"))
            calculated = report.indicators_calculated(bars)
            log.append_metrics(report.per_symbol(calculated, "indicators_calculated", F.col("indicators_calculated"), INDICATORS), "calculated")
        errors = rejected.where("kind = 'payload'").select("symbol", "error")
        status = report.batch_result(report.batch_status(requested, between(bars, start, end), errors), start, end, stamp, calculated)
    log.flush()
    return status, report.batch_summary(status), log
