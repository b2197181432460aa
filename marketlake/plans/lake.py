"""The layered run: bronze -> silver -> gold, all symbols in one plan per layer."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators import gold
from marketlake.operators.batch import indicator_document, last_bars, silver_bars
from marketlake.operators.clean import last_days, standardise
from marketlake.operators.series import dated, default_period, undated
from marketlake.plans import report
from marketlake.schema import BAR_SCHEMA, SILVER_SCHEMA
from marketlake.sources import store

STEPS = {
    "all": ("bronze", "silver", "gold"),
    "bronze": ("bronze",),
    "silver": ("silver",),
    "gold": ("gold",),
    "bronze-silver": ("bronze", "silver"),
    "silver-gold": ("silver", "gold"),
}


@dataclass(frozen=True)
class Lake:
    """A folder of layers. Naming the raw schema saves merging the schemas of all bronze files."""

    root: str
    raw_schema: T.StructType | None = None

    def path(self, layer: str) -> str:
        return f"{self.root}/{layer}"


def run(
    spark: SparkSession,
    lake: Lake,
    raw: DataFrame | None = None,
    steps: str = "all",
    symbols: Sequence[str] | None = None,
    data_type: str = "prices",
    ingest_ts: datetime | None = None,
    warmup: str = "full",
    grain: str = "day",
    period: str | None = None,
    documents: bool = True,
    newest_only: bool = False,
    as_of: datetime | None = None,
    days: int | None = None,
    skip_unread: bool = True,
    run_id: str | None = None,
) -> report.RunLog:
    """Run the chosen layers; each reads what the layer before it wrote, and replaces only the keys it computes.

    The silver step takes all of bronze, or with ``newest_only`` each symbol's newest landing, or the bars of the ``days`` days up to
    ``as_of``; other stored bars stay, and stored bars that the new ones reach are computed anew. ``grain`` is
    the spacing of the bars, ``period`` what one document covers (see ``default_period``); neither depends on the data's size.
    Bars without a symbol or a time, and silver files that cannot be read whole, go to the quarantine table and are counted; without
    ``skip_unread`` such files stop the gold step instead. Repeated under its ``run_id``, a run replaces its rejects and metrics.
    """
    if steps not in STEPS:
        raise ValueError(f"steps is one of {', '.join(STEPS)}")
    log = report.RunLog(spark, lake.path("log"), run=run_id)
    chosen = STEPS[steps]
    if "bronze" in chosen:
        if raw is None:
            raise ValueError("the bronze step needs a raw frame")
        with log.trace("bronze_load", data_type=data_type):
            counted, seen = report.observed(_only(raw, symbols), "bronze_rows")
            store.land_bronze(counted, lake.path("bronze"), data_type, ingest_ts)
            log.metric("records_extracted", seen.get["records"], data_type=data_type)
    if "silver" in chosen:
        with log.trace("silver_process", data_type=data_type):
            bronze = _landed(spark, lake, data_type)
            landed = standardise(bronze.drop("data_type", *store.DAY_PARTITIONS))
            bronze = store.newest_landing(spark, lake.path("bronze"), lake.raw_schema, data_type) if newest_only else bronze
            bronze = standardise(bronze.drop("data_type", *store.DAY_PARTITIONS))
            set_aside(spark, lake, _only(bronze, symbols), log, data_type)
            if days is not None:
                bronze = last_days(bronze, as_of or datetime.now(timezone.utc), days)
            part = newest_only or days is not None
            to_silver(spark, lake, _only(bronze, symbols), warmup, grain, documents, period, part, log, _only(landed, symbols))
    if "gold" in chosen:
        with log.trace("gold_aggregate", data_type="analytics"):
            unread = store.unread_files(spark, [lake.path("silver")], SILVER_SCHEMA)
            if not skip_unread and not unread.isEmpty():
                raise OSError(f"unreadable silver files below {lake.path('silver')}")
            said = F.concat(F.lit("unreadable file: "), "read", F.lit(" of "), F.coalesce(F.col("rows").cast("string"), F.lit("unknown")), F.lit(" rows read"))
            unread = unread.select("path", "length", said.alias("error"))
            seen_files, skipped = report.observed(unread, "skipped_files")
            store.quarantine(seen_files, lake.path("quarantine"), "file", run=log.run)
            log.metric("files_skipped", skipped.get["records"], data_type="analytics")
            to_gold(lake, _only(read_silver(spark, lake), symbols), grain)
    log.flush()
    return log


def _only(df: DataFrame, symbols: Sequence[str] | None) -> DataFrame:
    return df.where(F.col("symbol").isin(list(symbols))) if symbols else df


def _landed(spark, lake: Lake, data_type: str) -> DataFrame:
    return store.read_bronze(spark, lake.path("bronze"), lake.raw_schema).where(F.col("data_type") == data_type)


def read_bronze(spark, lake: Lake, data_type: str = "prices") -> DataFrame:
    return _landed(spark, lake, data_type).drop("data_type", *store.DAY_PARTITIONS)


def set_aside(spark, lake: Lake, bars: DataFrame, log: report.RunLog, data_type: str) -> None:
    """Quarantine and count the bars that belong to no series."""
    lost, seen = report.observed(undated(bars), "undated_bars")
    store.quarantine(lost.withColumn("error", F.lit("no symbol or no time")), lake.path("quarantine"), "bar", run=log.run)
    log.metric("records_rejected", seen.get["records"], data_type=data_type)


def to_silver(
    spark,
    lake: Lake,
    bronze: DataFrame,
    warmup="full",
    grain="day",
    documents=True,
    period: str | None = None,
    part: bool = False,
    log: report.RunLog | None = None,
    landed: DataFrame | None = None,
) -> None:
    """Clean bronze, add indicators, merge silver by symbol and time, and the documents of the symbols computed.

    With ``part`` the stored bars of the same symbols from the first new one on, and the ``REACH`` before it, are computed along, so
    that every value is what a run over the whole history gives; the ones before are not written again. Those from the first new
    one on are taken from ``landed``, all standardised bronze, since stored values may have been filled.
    """
    bars = bronze
    if part:
        bars = _with_stored(spark, lake, bronze, landed)
    enriched = silver_bars(bars, version=("arrival", "ingest_ts"), warmup=warmup, grain=grain)
    if part:
        enriched = enriched.where("fresh")
    columns = {f.name: f.dataType for f in SILVER_SCHEMA.fields}
    present = set(enriched.columns)
    enriched = enriched.select(
        *[(F.col(c) if c in present else F.lit(None)).cast(t).alias(c) for c, t in columns.items()]
    )
    counted, seen = report.observed(enriched, "silver_rows")
    store.upsert_bars(spark, lake.path("silver"), counted, lake.path("staging"), schema=SILVER_SCHEMA)
    if log is not None:
        log.metric("records_processed", seen.get["records"], data_type="silver")
    if documents:
        symbols = bronze.select("symbol").where("symbol IS NOT NULL").distinct()
        silver = read_silver(spark, lake).join(symbols, "symbol", "left_semi")
        found = indicator_document(silver, grain, period or default_period(grain))
        store.write_documents(found, lake.path("indicators"), lake.path("staging"))


# Bars before a changed one that the silver indicators of later bars look back on.
REACH = 20


def _with_stored(spark, lake: Lake, bronze: DataFrame, landed: DataFrame | None) -> DataFrame:
    """New bars (``fresh``) with the stored ones of the same symbols that they reach or are reached by."""
    bronze = bronze.withColumns({"fresh": F.lit(True), "arrival": F.lit(1)})
    first = dated(bronze).groupBy("symbol").agg(F.min("timestamp").alias("first_new"))
    stored = store.stored_bars(spark, lake.path("silver"), SILVER_SCHEMA).select(*BAR_SCHEMA.names).join(first, "symbol")
    later = stored.where("timestamp >= first_new").drop("first_new")
    if landed is not None:
        key = ["symbol", "timestamp"]
        raw = landed.select(*[c for c in (*BAR_SCHEMA.names, "ingest_ts") if c in landed.columns]).join(later.select(*key), key, "left_semi")
        later = raw.unionByName(later.join(landed.select(*key), key, "left_anti"), allowMissingColumns=True)
    later = later.withColumns({"fresh": F.lit(True), "arrival": F.lit(0)})
    before = last_bars(stored.where("timestamp < first_new"), REACH).withColumns({"fresh": F.lit(False), "arrival": F.lit(0)})
    known = later.unionByName(before.drop("age", "first_new"), allowMissingColumns=True)
    return bronze.unionByName(known, allowMissingColumns=True)


def read_silver(spark, lake: Lake) -> DataFrame:
    """Silver without the files that cannot be read; the gold step counts these."""
    typed = store._typed(SILVER_SCHEMA, store.MONTH_PARTITIONS)
    return store.read_readable(spark, [lake.path("silver")], typed).drop(*store.MONTH_PARTITIONS)


def to_gold(lake: Lake, silver: DataFrame, grain: str = "day") -> None:
    """Merge the rollup and the statistics of the symbols in ``silver``."""
    store.write_gold(gold.monthly(silver), gold.statistics(silver, grain), lake.path("gold"), lake.path("staging"))
