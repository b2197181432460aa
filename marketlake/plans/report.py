"""Run reports: per-symbol outcomes, batch summary, metrics and traces."""

from __future__ import annotations

import time
import uuid
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQueryListener

from marketlake.functions.scalars import split_symbols
from marketlake.operators.batch import MIN_BARS, indicator_gates
from marketlake.sources.files import run_name

NO_DATA = "no data"
FIRST_ERRORS = 5

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("metric", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("data_type", T.StringType()),
        T.StructField("at", T.TimestampType()),
    ]
)
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("trace_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("service", T.StringType()),
        T.StructField("environment", T.StringType()),
        T.StructField("at", T.TimestampType()),
        T.StructField("data", T.MapType(T.StringType(), T.StringType())),
    ]
)


def requested_symbols(requests: DataFrame, column: str) -> DataFrame:
    """Distinct symbols of comma-separated lists."""
    return requests.select(F.explode(split_symbols(F.col(column))).alias("symbol")).distinct()


def batch_id(symbol: Column, at: Column) -> Column:
    return F.concat_ws("_", symbol, F.date_format(at, "yyyyMMdd"))


def batch_status(requested: DataFrame, bars: DataFrame, errors: DataFrame | None = None) -> DataFrame:
    """Outcome per requested symbol: bars, and the text of the error (``errors``: symbol, error) of one without bars.

    Bars and errors are reduced before the join, which then sees one row per symbol on each side.
    """
    counts = bars.groupBy("symbol").agg(F.count("*").alias("price_points"))
    joined = requested.join(counts, "symbol", "left")
    if errors is None:
        joined = joined.withColumn("said", F.lit(None).cast("string"))
    else:
        joined = joined.join(errors.groupBy("symbol").agg(F.max("error").alias("said")), "symbol", "left")
    found = F.col("price_points").isNotNull()
    return joined.select(
        "symbol",
        F.coalesce("price_points", F.lit(0)).alias("price_points"),
        F.when(found, "success").otherwise("error").alias("status"),
        F.when(~found, F.coalesce("said", F.lit(NO_DATA))).alias("error"),
    )


def batch_result(status: DataFrame, start: datetime, end: datetime, at: Column, indicators: DataFrame | None = None) -> DataFrame:
    """``status`` with the batch id, the dates asked for and the number of indicators stored (``indicators``: symbol, indicators_calculated)."""
    if indicators is None:
        counted = status.withColumn("indicators_calculated", F.lit(0).cast("bigint"))
    else:
        one = indicators.groupBy("symbol").agg(F.max("indicators_calculated").cast("bigint").alias("indicators_calculated"))
        counted = status.join(one, "symbol", "left")
    return counted.select(
        batch_id(F.col("symbol"), at).alias("batch_id"),
        *status.columns,
        F.lit(start).cast("timestamp").alias("start_date"),
        F.lit(end).cast("timestamp").alias("end_date"),
        F.coalesce("indicators_calculated", F.lit(0)).alias("indicators_calculated"),
    )


def batch_summary(status: DataFrame) -> DataFrame:
    """Totals and the first errors by symbol; at most five error rows travel to the final aggregate."""
    counts = status.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("status") == "success").alias("successful"),
        F.count_if(F.col("status") != "success").alias("failed"),
    )
    first = (
        status.where(F.col("status") != "success")
        .select(F.struct("symbol", "error").alias("problem"))
        .orderBy("problem.symbol")
        .limit(FIRST_ERRORS)
    )
    both = counts.unionByName(first, allowMissingColumns=True)
    return both.agg(
        F.max("total").alias("total"),
        F.max("successful").alias("successful"),
        F.max("failed").alias("failed"),
        F.array_sort(F.collect_list("problem")).alias("errors"),
    )


def latest_price(bars: DataFrame) -> DataFrame:
    """The newest bar per symbol."""
    rest = [c for c in bars.columns if c not in ("symbol", "timestamp")]
    return bars.groupBy("symbol").agg(
        F.max("timestamp").alias("timestamp"), *[F.max_by(c, "timestamp").alias(c) for c in rest]
    )


def time_range(bars: DataFrame) -> DataFrame:
    return bars.groupBy("symbol").agg(
        F.min("timestamp").alias("start"), F.max("timestamp").alias("end"), F.count("*").alias("records")
    )


def records_extracted(bars: DataFrame, data_type: str, at: Column | None = None) -> DataFrame:
    """Metric rows with the number of records per symbol."""
    return bars.groupBy("symbol").agg(F.count("*").cast("double").alias("value")).select(
        F.lit("records_extracted").alias("metric"),
        "value",
        "symbol",
        F.lit(data_type).alias("data_type"),
        (at if at is not None else F.current_timestamp()).alias("at"),
    )


def indicators_calculated(bars: DataFrame) -> DataFrame:
    """(symbol, indicators_calculated): how many results a symbol has the bars for."""
    flags = [F.col(f"has_{name}").cast("int") for name in MIN_BARS]
    return indicator_gates(bars).select("symbol", sum(flags[1:], flags[0]).cast("bigint").alias("indicators_calculated"))


def per_symbol(rows: DataFrame, metric: str, value: Column, data_type: str, at: Column | None = None) -> DataFrame:
    """Metric rows with one value per symbol of ``rows``."""
    return rows.select(
        F.lit(metric).alias("metric"),
        value.cast("double").alias("value"),
        "symbol",
        F.lit(data_type).alias("data_type"),
        (at if at is not None else F.current_timestamp()).alias("at"),
    )


def metric_report(metrics: DataFrame) -> DataFrame:
    return metrics.groupBy("metric", "symbol", "data_type").agg(
        F.count("*").alias("samples"),
        F.sum("value").alias("total"),
        F.min("value").alias("least"),
        F.max("value").alias("most"),
        F.avg("value").alias("mean"),
    )


def trace_report(events: DataFrame) -> DataFrame:
    """Start, duration and outcome per trace."""
    ended = F.col("event_type").startswith("trace_end")
    return events.groupBy("trace_id").agg(
        F.min("at").alias("started"),
        (F.unix_micros(F.max("at")) - F.unix_micros(F.min("at"))).alias("duration_us"),
        F.count("*").alias("events"),
        F.max_by(F.col("data")["status"], F.when(ended, F.col("at"))).alias("status"),
    )


class RunLog:
    """Events and metrics of one driver run: a handful of rows per step, in two tables by run and step.

    A run that is repeated under its name replaces its metrics step by step, so they count once. Events are what
    happened: those of every attempt stay.
    """

    def __init__(self, spark: SparkSession, path: str, service: str = "marketlake", environment: str = "development", run: str | None = None):
        self.spark, self.path, self.service, self.environment = spark, path, service, environment
        self.run, self._attempt, self._flushed = run_name(run), run_name(), 0
        self._events: list[tuple] = []
        self._metrics: list[tuple] = []

    def event(self, event_type: str, trace_id: str | None = None, **data) -> None:
        row = (trace_id or str(uuid.uuid4()), event_type, self.service, self.environment, _now())
        self._events.append((*row, {k: str(v) for k, v in data.items()}))

    def metric(self, name: str, value: float, symbol: str | None = None, data_type: str | None = None) -> None:
        self._metrics.append((name, float(value), symbol, data_type, _now()))

    @contextmanager
    def trace(self, name: str, **data):
        """Log start, end and, on an exception, failure of a step; the time taken becomes a metric."""
        trace_id, begun = str(uuid.uuid4()), time.monotonic()
        self.event(f"trace_start_{name}", trace_id, status="started", **data)
        try:
            yield trace_id
        except Exception as problem:
            self.event(f"trace_end_{name}", trace_id, status="failed", error=problem)
            self.flush()
            raise
        self.event(f"trace_end_{name}", trace_id, status="success", **data)
        self.metric(f"{name}_seconds", time.monotonic() - begun, data_type=data.get("data_type"))

    @property
    def pending(self) -> int:
        """Events and metrics not written yet."""
        return len(self._events) + len(self._metrics)

    def flush(self) -> None:
        """Write what is held. The metrics of a run's n-th flush replace those of its n-th flush before."""
        if self._events:
            self._store(self.spark.createDataFrame(self._events, EVENT_SCHEMA).coalesce(1), "events", f"{self._attempt}-{self._flushed}")
        if self._metrics:
            self._store(self.spark.createDataFrame(self._metrics, METRIC_SCHEMA).coalesce(1), "metrics", f"flush-{self._flushed}")
        self._flushed += 1
        self._events.clear()
        self._metrics.clear()

    def append_metrics(self, rows: DataFrame, step: str) -> None:
        """Store metric rows that Spark computed, as those of this run's ``step``."""
        self._store(rows.select(*METRIC_SCHEMA.names), "metrics", step)

    def events(self) -> DataFrame:
        return self._read("events", EVENT_SCHEMA)

    def metrics(self) -> DataFrame:
        return self._read("metrics", METRIC_SCHEMA)

    def _store(self, rows: DataFrame, table: str, step: str) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/{table}/run={self.run}/step={run_name(step)}")

    def _read(self, table: str, schema: T.StructType) -> DataFrame:
        """The rows of all runs."""
        placed = T.StructType([*schema.fields, T.StructField("run", T.StringType()), T.StructField("step", T.StringType())])
        return self.spark.read.schema(placed).parquet(f"{self.path}/{table}").select(*schema.names)


class StreamLog(StreamingQueryListener):
    """Start, progress and end of streaming queries as events; register with ``spark.streams.addListener``.

    Events are written once ``most`` of them are held and when a query ends, so the driver holds few.
    """

    def __init__(self, log: RunLog, most: int = 100):
        self.log, self.most = log, most

    def onQueryStarted(self, event) -> None:
        self.log.event("trace_start_stream", str(event.runId), status="started", name=event.name)

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        self.log.event("stream_progress", str(progress.runId), batch=progress.batchId, rows=progress.numInputRows)
        if self.log.pending >= self.most:
            self.log.flush()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        status = "failed" if event.exception else "success"
        self.log.event("trace_end_stream", str(event.runId), status=status)
        self.log.flush()


def observed(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The frame with a row count that is filled in by whatever job runs it next."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("records")), seen


def _now() -> datetime:
    return datetime.now(timezone.utc)
