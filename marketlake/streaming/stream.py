"""Structured Streaming: record enrichment, and incremental refresh of the silver and gold layers."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property, reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from marketlake.functions.scalars import default_time, enrich_intraday
from marketlake.operators import gold
from marketlake.operators.batch import indicator_document, last_bars
from marketlake.operators.clean import forward_fill, keep_latest
from marketlake.operators.indicators import indicators
from marketlake.operators.series import dated, default_period, depth_cuts, is_sliced
from marketlake.schema import BAR_SCHEMA, DOCUMENT_SCHEMA, GOLD_SCHEMA, NUMERIC_COLUMNS, PERIOD_SCHEMA, PRICE_COLUMNS, SILVER_SCHEMA, conform_bars
from marketlake.sources import store
from marketlake.sources.files import remove
from marketlake.sources.runs import RunTable

SILVER_INDICATORS = ["sma_20", "rsi_14"]
# Bars kept per symbol between batches: what the silver indicators look back on.
TAIL_BARS = 20
# Runs of changes before they are folded into a table's base.
MOST_RUNS = 16
TAIL_SCHEMA = T.StructType([*BAR_SCHEMA.fields, T.StructField("age", T.IntegerType())])
GOLD_KEY = T.StructType(GOLD_SCHEMA.fields[:2])
COUNT_SCHEMA = T.StructType(
    [
        T.StructField("symbol", T.StringType()),
        T.StructField("month", T.StringType()),
        T.StructField("bars", T.LongType()),
        T.StructField("full_bars", T.LongType()),
    ]
)


def read_records(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    return spark.readStream.schema(schema).parquet(path)


def enrich_records(records: DataFrame) -> DataFrame:
    """The batch enrichment, on a stream. Malformed numbers are NULL and give NULL metrics."""
    return enrich_intraday(default_time(records))


def write_enriched(records: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    return (
        enrich_records(records)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


@dataclass(frozen=True)
class SilverRefresh:
    """Keeps silver, gold and, with ``documents``, the indicator documents up to date from newly landed bars.

    Every table is a base with runs of changes (``RunTable``): a micro-batch writes its own rows, under a token of its own, so a
    replayed batch replaces what it wrote. Before ``MOST_RUNS`` runs pile up they are folded into the months or buckets they touch, and what
    no reader of the newest state needs is removed. ``bars`` (as they came) and ``silver`` lie by month; in buckets of symbols lie ``tail``, the
    last ``TAIL_BARS`` bars of a symbol, ``counts``, its bars by month, and ``states``, what its months contribute to the statistics. Of these
    a batch reads the buckets of its symbols and writes its symbols.

    New bars at the end of a history need only the tail. A late bar is computed from the ``TAIL_BARS`` before it to the
    ``TAIL_BARS`` after the point from which no value is filled from before it; ``counts`` says in which months these lie, and only they are read.
    The gold months of what changed, and the statistics of their symbols from all stored states, follow in the same batch. The exact
    medians of bars less than a day apart are the only figures that read the symbol's history.
    """

    spark: SparkSession
    root: str
    grain: str = "day"
    documents: bool = False

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def table(self, name: str) -> RunTable:
        if name == "states":
            given = (self._state_schema, ["symbol", "year_month"], store.symbol_bucket)
        elif name == "statistics":
            given = (self._statistics_schema, ["symbol"], store.symbol_bucket)
        else:
            given = self._plain_tables()[name]
        return RunTable(self.spark, self.path(name), *given, listed=name in ("bars", "silver"))

    def _plain_tables(self) -> dict[str, tuple]:
        return {
            "bars": (BAR_SCHEMA, ["symbol", "timestamp"], store.month_parts),
            "silver": (SILVER_SCHEMA, ["symbol", "timestamp"], store.month_parts),
            "tail": (TAIL_SCHEMA, ["symbol", "age"], store.symbol_bucket),
            "counts": (COUNT_SCHEMA, ["symbol", "month"], store.symbol_bucket),
            "gold": (GOLD_SCHEMA, ["symbol", "year_month"], lambda: {"year": F.substring("year_month", 1, 4)}),
            "documents": (PERIOD_SCHEMA if self._period() else DOCUMENT_SCHEMA, ["symbol", "period"] if self._period() else ["symbol"], store.symbol_bucket),
        }

    def start(self, bronze: DataFrame, checkpoint: str) -> StreamingQuery:
        return (
            bronze.writeStream.foreachBatch(self.refresh)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )

    def silver(self) -> DataFrame:
        return self.table("silver").read()

    def bars(self) -> DataFrame:
        return self.table("bars").read()

    def gold(self) -> DataFrame:
        return self.table("gold").read()

    def statistics(self) -> DataFrame:
        """The nested statistics of ``gold.statistics``, one row per symbol."""
        return self.table("statistics").read()

    def indicator_documents(self) -> DataFrame:
        return self.table("documents").read()

    def publish(self, path: str) -> None:
        """Write the current silver layer by event month, for range reads and gold."""
        store.write_bars(self.silver(), path, "overwrite")

    def refresh(self, batch: DataFrame, batch_id: int) -> None:
        # a query that starts anew numbers its batches from 0 again, so its id is part of the token
        query = self.spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "batch"
        token, own = f"{query}/{batch_id}", self.path(f"staging/{uuid.uuid4().hex}")
        self._fold(token)
        # only the columns of a bar: ingest stamps would make equal bars differ
        fresh = self._staged(keep_latest(dated(conform_bars(batch)), ["symbol", "timestamp"]), BAR_SCHEMA, own)
        symbols = fresh.select("symbol").distinct()
        buckets = symbols.select(*[c.alias(k) for k, c in store.symbol_bucket().items()]).distinct().toArrow()["bucket"].to_pylist()
        if not buckets:
            return
        self.table("bars").append(fresh, token)
        self._count_months(fresh, token)
        tail = self.table("tail").read(buckets, before=token).join(symbols, "symbol", "left_semi").select(*BAR_SCHEMA.names)
        context = self._staged(tail, BAR_SCHEMA, own)
        late = self._late(fresh, context)
        late = self._staged(late, late.schema, own)
        rows = fresh.join(late, "symbol", "left_anti").withColumn("known", F.lit(False))
        rows = rows.unionByName(context.join(late, "symbol", "left_anti").withColumn("known", F.lit(True)))
        if not late.isEmpty():
            rows = rows.unionByName(self._around(late, buckets))
        cuts = depth_cuts(rows) if is_sliced(self.grain) else None
        filled = forward_fill(rows, grain=self.grain, keep_slice=True, cuts=cuts)
        enriched = indicators(filled, SILVER_INDICATORS, grain=self.grain, cuts=cuts).where(~F.col("known"))
        changed = self._staged(enriched.select(*SILVER_SCHEMA.names), SILVER_SCHEMA, own)
        self.table("silver").append(changed, token)
        newest = keep_latest(
            changed.select(*BAR_SCHEMA.names).withColumn("newer", F.lit(1)).unionByName(context.withColumn("newer", F.lit(0))),
            ["symbol", "timestamp"],
            ["newer"],
        ).drop("newer")
        self.table("tail").append(last_bars(newest, TAIL_BARS), token)
        self._refresh_gold(changed, token, buckets, own)
        if self.documents:
            silver = self.silver().join(symbols, "symbol", "left_semi")
            self.table("documents").append(indicator_document(silver, self.grain, self._period()), token)
        remove(self.spark, own)

    def _fold(self, token: str) -> None:
        """Fold the runs of earlier batches once there are many, and let go of what the fold before left for its readers."""
        for name in ("bars", "silver", "tail", "counts", "gold", "states", "statistics", *(["documents"] if self.documents else [])):
            table = self.table(name)
            if len(table.state().runs) >= MOST_RUNS:
                table.expire()
                table.compact(before=token)

    def _period(self) -> str | None:
        return default_period(self.grain)

    @cached_property
    def _state_schema(self) -> T.StructType:
        return gold.month_states(self.spark.createDataFrame([], SILVER_SCHEMA), not is_sliced(self.grain)).schema

    @cached_property
    def _statistics_schema(self) -> T.StructType:
        return gold.merged_statistics(gold.month_states(self.spark.createDataFrame([], SILVER_SCHEMA))).schema

    def _late(self, fresh: DataFrame, tail: DataFrame) -> DataFrame:
        """(symbol, first_new, last_new) of the symbols with a new bar at or before the end of their tail."""
        new = fresh.groupBy("symbol").agg(F.min("timestamp").alias("first_new"), F.max("timestamp").alias("last_new"))
        last = tail.groupBy("symbol").agg(F.max("timestamp").alias("last_known"))
        return new.join(last, "symbol").where("first_new <= last_known").drop("last_known")

    def _around(self, late: DataFrame, buckets: list[str]) -> DataFrame:
        """The bars from which late bars' indicators and those they change are computed."""
        counts = self.table("counts").read(buckets)
        months = self._months_of(late, counts)
        later = self._later(late, months)
        # Should values be filled beyond these months, the months after them are read too.
        open_ends = later.groupBy("symbol").agg(F.max("settled_bars").alias("n")).where(F.col("n") <= TAIL_BARS)
        beyond = counts.where(F.col("month") > max(months)).join(open_ends, "symbol", "left_semi")
        more = beyond.select("month").distinct().toArrow()["month"].to_pylist()
        if more:
            later = self._later(late, months + more)
        later = later.where(F.col("settled_bars") <= TAIL_BARS).drop("settled_bars").withColumn("known", F.lit(False))
        stored = self._months("silver", months).join(late, "symbol").where("timestamp < first_new")
        before = last_bars(stored.select(*BAR_SCHEMA.names), TAIL_BARS).drop("age")
        return later.unionByName(before.withColumn("known", F.lit(True)))

    def _months(self, name: str, months: list[str]) -> DataFrame:
        return self.table(name).read(places_of(months)).select(*BAR_SCHEMA.names)

    def _later(self, late: DataFrame, months: list[str]) -> DataFrame:
        """The bars from the first new one on, with the number of ``settled_bars`` so far: those after all columns have had a value again."""
        later = self._months("bars", months).join(late, "symbol").where("timestamp >= first_new")
        so_far = Window.partitionBy("symbol").orderBy("timestamp").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        after = F.col("timestamp") > F.col("last_new")
        filled = [F.count(F.when(after, F.col(c))).over(so_far) > 0 for c in NUMERIC_COLUMNS]
        # a column without any value is never filled
        empty = [F.count(c).over(Window.partitionBy("symbol")) == 0 for c in NUMERIC_COLUMNS]
        settled = later.withColumn("settled", reduce(and_, [f | e for f, e in zip(filled, empty)]) & after)
        return settled.withColumn("settled_bars", F.count_if("settled").over(so_far)).select(*BAR_SCHEMA.names, "settled_bars")

    def _months_of(self, late: DataFrame, counts: DataFrame) -> list[str]:
        """The months that hold the bars late ones reach and, most likely, those that reach them; the calendar bounds their number."""
        counts = counts.join(late, "symbol")
        month = F.col("month")
        first, last = (F.date_format(c, "yyyyMM") for c in ("first_new", "last_new"))
        down = Window.partitionBy("symbol").orderBy(F.desc("month")).rowsBetween(Window.unboundedPreceding, -1)
        up = Window.partitionBy("symbol").orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
        passed = counts.withColumns(
            {
                "held_before": F.coalesce(F.sum(F.when(month < first, F.col("bars"))).over(down), F.lit(0)),
                "held_after": F.coalesce(F.sum(F.when(month > last, F.col("full_bars"))).over(up), F.lit(0)),
            }
        )
        near = passed.where(
            month.between(first, last)
            | (month < first) & (F.col("held_before") < TAIL_BARS)
            | (month > last) & (F.col("held_after") < 2 * TAIL_BARS)
        )
        return near.select("month").distinct().toArrow()["month"].to_pylist()

    def _count_months(self, fresh: DataFrame, token: str) -> None:
        """Count the bars, and those without a missing value, of the months that new bars touch."""
        month = F.date_format("timestamp", "yyyyMM").alias("month")
        keys = fresh.select("symbol", month).distinct()
        touched = keys.select("month").distinct().toArrow()["month"].to_pylist()
        full = reduce(and_, [F.col(c).isNotNull() for c in PRICE_COLUMNS])
        counted = self._months("bars", touched).groupBy("symbol", month).agg(F.count("*").alias("bars"), F.count_if(full).alias("full_bars"))
        self.table("counts").append(counted.join(keys, ["symbol", "month"], "left_semi"), token)

    def _refresh_gold(self, changed: DataFrame, token: str, buckets: list[str], own: str) -> None:
        """Roll up the months that changed anew; what looks across months is computed from stored months, one row each."""
        month = F.date_format("timestamp", "yyyy-MM").alias("year_month")
        keys = self._staged(changed.select("symbol", month).distinct(), GOLD_KEY, own)
        touched = keys.select(F.regexp_replace("year_month", "-", "").alias("month")).distinct().toArrow()["month"].to_pylist()
        key = ["symbol", "year_month"]
        silver = self.table("silver").read(places_of(touched)).withColumn("year_month", F.date_format("timestamp", "yyyy-MM"))
        silver = silver.join(keys, key, "left_semi").drop("year_month")
        anew = gold.month_bars(silver)
        first = keys.groupBy("symbol").agg(F.min("year_month").alias("first_month"))
        rest = self.table("gold").read(before=token).join(first.select("symbol"), "symbol", "left_semi").join(keys, key, "left_anti")
        months = anew.unionByName(rest.select(*anew.columns))
        found = gold.across_months(months).join(first, "symbol").where("year_month >= first_month").drop("first_month")
        self.table("gold").append(found, token)

        states = self.table("states")
        states.append(gold.month_states(silver, not is_sliced(self.grain)), token)
        symbols = first.select("symbol")
        medians = None
        if is_sliced(self.grain):
            history = self.silver().join(symbols, "symbol", "left_semi")
            closes, volumes = (gold.bracketed_median(history, c).withColumnRenamed("median", f"{c}_median") for c in ("close", "volume"))
            medians = closes.join(volumes, "symbol", "full_outer")
        stored = states.read(buckets).join(symbols, "symbol", "left_semi")
        self.table("statistics").append(gold.merged_statistics(stored, medians), token)

    def _staged(self, df: DataFrame, schema: T.StructType, own: str) -> DataFrame:
        """The frame as files of this batch's own, which go with it."""
        path = f"{own}/{uuid.uuid4().hex}"
        df.select(*schema.names).write.parquet(path)
        return self.spark.read.schema(schema).parquet(path)


def places_of(months: list[str]) -> list[str]:
    """Months (yyyyMM) as values of the partitions year and month."""
    return [f"{m[:4]}/{m[4:]}" for m in months]


def refresh_from(spark: SparkSession, bronze_path: str, root: str, checkpoint: str, grain: str = "day", documents: bool = False) -> SilverRefresh:
    """Process everything that landed since the last call, then stop."""
    refresh = SilverRefresh(spark, root, grain, documents)
    refresh.start(read_records(spark, bronze_path), checkpoint).awaitTermination()
    return refresh


