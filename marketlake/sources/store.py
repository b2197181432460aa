"""Tables of the lake: layout, writers, range readers, upsert.

Layout. Bars lie under ``year=/month=`` of their own event time, sorted by (symbol, timestamp) inside each
file, so a range read prunes directories by month and row groups by symbol. The symbol is not a directory:
daily bars would leave one file of some twenty rows per symbol and month. Before a write, ``rebalance``
lets AQE split oversized partitions (a hot month or ingest day) and merge small ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime, timezone
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions.masking import mask_columns
from marketlake.functions.scalars import date_parts
from marketlake.operators.clean import keep_latest
from marketlake.operators.series import dated
from marketlake.schema import (
    BAR_SCHEMA,
    DOCUMENT_SCHEMA,
    ENVELOPE_SCHEMA,
    PERIOD_SCHEMA,
    QUARANTINE_SCHEMA,
    STOCK_SCHEMA,
    with_optional,
)
from marketlake.sources.files import exists, remove, run_name
from marketlake.sources.runs import rows_by_file

MONTH_PARTITIONS = ["year", "month"]
DAY_PARTITIONS = ["year", "month", "day"]
BRONZE_PARTITIONS = ["data_type", *DAY_PARTITIONS]
ENVELOPE_VERSION = "1.0"
# Beside bronze rows, out of sight of readers of the folder: which symbols came with which landing.
LEDGER = "_landings"
LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("data_type", T.StringType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("ingest_ts", T.TimestampType()),
        T.StructField("rows", T.LongType()),
    ]
)
# Tables with one row per symbol lie in this many buckets of symbols, so that a merge rewrites few of them.
SYMBOL_BUCKETS = 64
# Spark's JSON writer keeps milliseconds only unless told otherwise
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _write(df: DataFrame, path: str, partitions: Sequence[str], sort: Sequence[str], mode: str, kind: str = "parquet") -> None:
    (
        df.hint("rebalance", *partitions)
        .sortWithinPartitions(*partitions, *sort)
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .format(kind)
        .options(**(JSON_TIMES if kind == "json" else {}))
        .save(path)
    )


def _typed(schema: T.StructType, partitions: Sequence[str]) -> T.StructType:
    """The schema with the partition columns as text, which keeps their zero padding."""
    known = [f for f in schema.fields if f.name not in partitions]
    return T.StructType([*known, *[T.StructField(p, T.StringType()) for p in partitions]])


# --- bronze -----------------------------------------------------------------------------------------


def land_bronze(raw: DataFrame, path: str, data_type: str = "prices", ingest_ts: datetime | None = None) -> None:
    """Append a raw frame under its ingest date, columns untouched and rows where they are: no shuffle.

    Then the landing is entered in the ledger beside the rows, as its symbols with their row counts.
    """
    at = ingest_ts or datetime.now(timezone.utc)
    stamp = F.lit(at).cast("timestamp")
    stamped = raw.withColumns({"ingest_ts": stamp, "data_type": F.lit(data_type)})
    stamped.withColumns(date_parts("ingest_ts")).write.mode("append").partitionBy(*BRONZE_PARTITIONS).parquet(path)
    if "symbol" in raw.columns:
        spark = raw.sparkSession
        landed = T.StructType([raw.schema["symbol"], LEDGER_SCHEMA["ingest_ts"]])
        day = spark.range(1).select(*[v.alias(k) for k, v in date_parts(stamp).items()]).first()
        here = reduce(lambda a, b: a & b, [F.col(k) == v for k, v in day.asDict().items()]) & (F.col("data_type") == data_type)
        rows = spark.read.schema(_typed(landed, BRONZE_PARTITIONS)).parquet(path).where(here & (F.col("ingest_ts") == stamp))
        counted = rows.groupBy("data_type", F.col("symbol").cast("string").alias("symbol"), "ingest_ts").agg(F.count("*").alias("rows"))
        counted.select(*LEDGER_SCHEMA.names).coalesce(1).write.mode("append").parquet(f"{path}/{LEDGER}")


def read_bronze(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Landed rows; without a schema, the columns of all files are merged."""
    if schema is None:
        landed = spark.read.option("mergeSchema", "true").parquet(path)
        padded = {p: F.lpad(F.col(p).cast("string"), 4 if p == "year" else 2, "0") for p in DAY_PARTITIONS}
        return landed.withColumns(padded)
    stamped = schema if "ingest_ts" in schema.names else schema.add("ingest_ts", "timestamp")
    return spark.read.schema(_typed(stamped, BRONZE_PARTITIONS)).parquet(path)


def latest_landing(bronze: DataFrame) -> DataFrame:
    """Per symbol the rows of its newest landing.

    Two narrow columns give the newest time per symbol, one small row each. Of a table by ingest day, only the days on
    which these times lie are then read; the calendar bounds their number. The join is left to AQE.
    """
    newest = bronze.groupBy("symbol").agg(F.max("ingest_ts").alias("ingest_ts"))
    if set(DAY_PARTITIONS) <= set(bronze.columns):
        days = newest.select(F.date_format("ingest_ts", "yyyyMMdd").alias("day")).distinct().toArrow()["day"].to_pylist()
        bronze = bronze.where(F.concat(*DAY_PARTITIONS).isin([d for d in days if d is not None]))
    return bronze.join(newest, ["symbol", "ingest_ts"])


def newest_landing(spark: SparkSession, path: str, schema: T.StructType | None = None, data_type: str = "prices") -> DataFrame:
    """``latest_landing`` of one type by the ledger: of bronze itself only the days of newest landings are read.

    The days are collected; the calendar bounds their number. A bronze table without a ledger is searched itself.
    """
    bronze = read_bronze(spark, path, schema).where(F.col("data_type") == data_type)
    if not exists(spark, f"{path}/{LEDGER}"):
        return latest_landing(bronze)
    ledger = spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/{LEDGER}").where(F.col("data_type") == data_type)
    newest = ledger.groupBy("symbol").agg(F.max("ingest_ts").alias("ingest_ts"))
    days = newest.select(F.date_format("ingest_ts", "yyyy/MM/dd").alias("day")).distinct().toArrow()["day"].to_pylist()
    # year, month and day each by themselves too, as these are what prunes folders
    parts = zip(DAY_PARTITIONS, zip(*(d.split("/") for d in days)) if days else [[]] * 3)
    for name, values in parts:
        bronze = bronze.where(F.col(name).isin(sorted(set(values))))
    return bronze.where(F.concat_ws("/", *DAY_PARTITIONS).isin(days)).join(newest, ["symbol", "ingest_ts"])


def symbols_in(layer: DataFrame) -> DataFrame:
    return layer.select("symbol").distinct()


# --- bars -------------------------------------------------------------------------------------------


def write_bars(bars: DataFrame, path: str, mode: str = "append") -> None:
    """Write bars by the month of their own timestamp. ``overwrite`` replaces only the months written."""
    _write(bars.withColumns(month_parts()), path, MONTH_PARTITIONS, ["symbol", "timestamp"], mode)


def read_bars(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    return spark.read.schema(_typed(schema, MONTH_PARTITIONS)).parquet(path)


def stored_bars(spark: SparkSession, path: str, schema: T.StructType = BAR_SCHEMA) -> DataFrame:
    """All bars of a store; none before the first write."""
    return _stored(spark, path, _typed(schema, MONTH_PARTITIONS)).drop(*MONTH_PARTITIONS)


def between_months(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Inclusive time range with the predicates on ``year``/``month`` that prune directories."""
    year, month = F.col("year"), F.col("month")

    def edge(at: datetime, outside) -> Column:
        return outside(year, f"{at:%Y}") | ((year == f"{at:%Y}") & ~outside(F.lit(f"{at:%m}"), month))

    after = edge(start, lambda a, b: a > b)
    before = edge(end, lambda a, b: a < b)
    return df.where(after & before & F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))


def get_prices(spark: SparkSession, path: str, symbol: str, start: datetime, end: datetime, schema=BAR_SCHEMA) -> DataFrame:
    """Bars of one symbol in an inclusive range, in time order."""
    rows = between_months(read_bars(spark, path, schema), start, end).where(F.col("symbol") == symbol)
    return rows.drop(*MONTH_PARTITIONS).orderBy("timestamp")


def merge_bars(stored: DataFrame, incoming: DataFrame, version: str = "seq", keys: Sequence[str] = ("symbol", "timestamp")) -> DataFrame:
    """Last write per key wins; ``incoming`` beats ``stored``, then the higher version."""
    stored = stored.withColumn("arrival", F.lit(0)).withColumn(version, F.lit(None).cast("bigint"))
    incoming = with_optional(incoming.withColumn("arrival", F.lit(1)), **{version: "bigint"})
    both = stored.unionByName(incoming, allowMissingColumns=True)
    return keep_latest(both, list(keys), ["arrival", version]).drop("arrival", version)


def merge_into(
    spark: SparkSession,
    path: str,
    incoming: DataFrame,
    schema: T.StructType,
    keys: Sequence[str],
    partitions: dict[str, Column],
    staging: str,
    version: str = "seq",
    kind: str = "parquet",
) -> None:
    """Replace the stored rows with the keys of ``incoming``, leaving all others, and rewrite only the partitions it touches.

    ``partitions`` are computed from the rows; which ones are touched is collected, so their number must be bounded
    (months by the calendar, buckets by ``SYMBOL_BUCKETS``). ``incoming`` is computed once, into a folder of this call's own
    under ``staging``, and so is the result: Spark cannot overwrite files it is reading, a lost executor recomputes from
    files that still exist, and nothing that an earlier call staged is seen. What the call staged goes when it is done.
    """
    own = f"{staging}/{uuid.uuid4().hex}"
    names = list(partitions)
    with_optional(incoming, **{version: "bigint"}).select(*schema.names, version).withColumns(partitions).write.parquet(f"{own}/incoming")
    typed = _typed(schema, names)
    incoming = spark.read.schema(T.StructType([*typed.fields, T.StructField(version, T.LongType())])).parquet(f"{own}/incoming")
    place = F.concat_ws("/", *names)
    touched = incoming.select(place.alias("place")).distinct().toArrow()["place"].to_pylist()
    if not touched:
        return remove(spark, own)
    stored = _stored(spark, path, typed, kind).where(place.isin(touched))
    merge_bars(stored, incoming, version, keys).select(*typed.names).write.parquet(f"{own}/merged")
    _write(spark.read.schema(typed).parquet(f"{own}/merged"), path, names, list(keys), "overwrite", kind)
    remove(spark, own)


def month_parts(timestamp: str = "timestamp") -> dict[str, Column]:
    return {k: v for k, v in date_parts(timestamp).items() if k in MONTH_PARTITIONS}


def symbol_bucket() -> dict[str, Column]:
    return {"bucket": F.pmod(F.xxhash64("symbol"), F.lit(SYMBOL_BUCKETS)).cast("string")}


def upsert_bars(spark: SparkSession, path: str, incoming: DataFrame, staging: str, version: str = "seq", schema: T.StructType = BAR_SCHEMA) -> None:
    """Merge bars into the store by (symbol, timestamp), rewriting only the months the incoming rows touch.

    Rows without a symbol or a time have no key and are left out; ``quarantine`` is the place for them.
    """
    merge_into(spark, path, dated(incoming), schema, ["symbol", "timestamp"], month_parts(), staging, version)


def union_layers(*frames: DataFrame) -> DataFrame:
    """Bag union with columns aligned by name; a column some frames lack is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_readable(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """Many Parquet paths as one frame, skipping files that cannot be read; ``unread_files`` names these."""
    reader = spark.read.option("ignoreCorruptFiles", "true").option("ignoreMissingFiles", "true")
    return reader.schema(schema).parquet(*paths)


def unread_files(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """(path, length, rows, read) of the Parquet files below ``paths`` from which not all rows can be read.

    ``rows`` is what the file's footer says, NULL where that cannot be read. Files are told apart by their whole paths. All columns of all
    files are read once, against the checksums of their pages; a table of ``RunTable`` also knows the files that are lost.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(list(paths))
    listed = files.select(F.col("_metadata.file_path").alias("file"), "path", "length")
    footers = read_readable(spark, paths, schema).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    seen = rows_by_file(spark, paths, schema).withColumnRenamed("rows", "read")
    found = listed.join(footers, "file", "left").join(seen, "file", "left").fillna(0, ["read"])
    found = found.where("rows IS NULL OR read < rows").select("path", "length", "rows", "read")
    # A file without a row group is whole: its footer, the footer's length and two marks are all of it.
    bare = [r["path"] for r in found.where("rows IS NULL").select("path").collect()]
    if not bare:
        return found
    size = sum((F.conv(F.hex(F.substring("content", F.col("length").cast("int") - 7 + i, F.lit(1))), 16, 10).cast("long") * (1 << 8 * i) for i in range(4)), F.lit(0))
    mark = F.substring("content", F.col("length").cast("int") - 3, F.lit(4)) == F.lit(b"PAR1")
    empty = spark.read.format("binaryFile").load(bare).where(mark & (size + 12 == F.col("length"))).select("path")
    return found.join(empty, "path", "left_anti")


# --- quarantine -------------------------------------------------------------------------------------


def quarantine(rejected: DataFrame, path: str, kind: str, at: Column | None = None, run: str | None = None) -> None:
    """Store what a step could not use, with the ``error``, as rows of (symbol, error, body, at) under its kind and run.

    A run that is repeated under its name replaces its own rows of the kind, and only these.
    """
    body = F.col("body") if "body" in rejected.columns else F.to_json(F.struct(*[c for c in rejected.columns if c != "error"]), JSON_TIMES)
    symbol = F.col("symbol").cast("string") if "symbol" in rejected.columns else F.lit(None).cast("string")
    rows = rejected.select(symbol.alias("symbol"), "error", body.alias("body"), (at if at is not None else F.current_timestamp()).alias("at"))
    rows.write.mode("overwrite").parquet(f"{path}/kind={kind}/run={run_name(run)}")


def read_quarantine(spark: SparkSession, path: str, run: str | None = None) -> DataFrame:
    """Stored rejects, of all runs or, reading only its folders, of one."""
    rows = _stored(spark, path, QUARANTINE_SCHEMA)
    return rows if run is None else rows.where(F.col("run") == run)


# --- silver and gold --------------------------------------------------------------------------------


def write_documents(documents: DataFrame, path: str, staging: str) -> None:
    """Merge JSON documents by symbol (and period, where there is one), as lines in buckets of symbols."""
    keys = [c for c in ("symbol", "period") if c in documents.columns]
    merge_into(documents.sparkSession, path, documents, DOCUMENT_SCHEMA if "period" not in keys else PERIOD_SCHEMA, keys, symbol_bucket(), staging, kind="json")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(symbol, period, document); the period is NULL for documents of whole histories."""
    return _stored(spark, path, _typed(PERIOD_SCHEMA, ["bucket"]), "json").drop("bucket")


def write_gold(monthly: DataFrame, statistics: DataFrame, path: str, staging: str) -> None:
    """Merge the monthly rollup (Parquet by year) by symbol and month, and the statistics (JSON in buckets) by symbol."""
    spark = monthly.sparkSession
    year = {"year": F.substring("year_month", 1, 4)}
    merge_into(spark, f"{path}/monthly", monthly, monthly.schema, ["symbol", "year_month"], year, staging)
    merge_into(spark, f"{path}/statistics", statistics, statistics.schema, ["symbol"], symbol_bucket(), staging, kind="json")


def read_gold_monthly(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _stored(spark, f"{path}/monthly", _typed(schema, ["year"])).drop("year")


def read_gold_statistics(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _stored(spark, f"{path}/statistics", _typed(schema, ["bucket"]), "json").drop("bucket")


# --- stocks -----------------------------------------------------------------------------------------


def write_stocks(stocks: DataFrame, path: str, mode: str = "append") -> None:
    """Stock rows stamped with the write time, sorted by symbol for point reads."""
    stamped = with_optional(stocks, sector="string", industry="string").withColumn("last_updated", F.current_timestamp())
    stamped.select(*STOCK_SCHEMA.names).sortWithinPartitions("symbol").write.mode(mode).parquet(path)


def read_stocks(spark: SparkSession, path: str) -> DataFrame:
    """All stored stock rows; none before the first write."""
    return _stored(spark, path, STOCK_SCHEMA)


def _stored(spark: SparkSession, path: str, schema: T.StructType, kind: str = "parquet") -> DataFrame:
    """A table, empty while nothing has been written to its path."""
    try:
        return spark.read.schema(schema).options(**(JSON_TIMES if kind == "json" else {})).format(kind).load(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def get_stock(spark: SparkSession, path: str, symbol: str) -> DataFrame:
    """The newest row of a stock, or no row."""
    stored = spark.read.schema(STOCK_SCHEMA).parquet(path).where(F.col("symbol") == symbol)
    return keep_latest(stored, ["symbol"], ["last_updated"])


def new_stocks(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Incoming stocks that are not stored yet, one row per symbol."""
    return keep_latest(incoming.join(stored.select("symbol"), "symbol", "left_anti"), ["symbol"])


# --- envelopes --------------------------------------------------------------------------------------


def envelopes(
    data: DataFrame,
    source_id: Column,
    data_type: str,
    timestamp: Column,
    sensitive: Sequence[str] = (),
    processed_at: Column | None = None,
) -> DataFrame:
    """Wrap rows as (source, type, time, JSON payload, metadata), masking the named fields first."""
    keyed = data.withColumns({"envelope_source": source_id.cast("string"), "envelope_time": timestamp.cast("timestamp")})
    masked = mask_columns(keyed, sensitive)
    payload = F.to_json(F.struct(*data.columns), JSON_TIMES)
    at = processed_at if processed_at is not None else F.current_timestamp()
    return masked.select(
        F.col("envelope_source").alias("source_id"),
        F.lit(data_type).alias("data_type"),
        F.col("envelope_time").alias("timestamp"),
        payload.alias("data"),
        F.create_map(
            F.lit("processed_at"), F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("version"), F.lit(ENVELOPE_VERSION)
        ).alias("metadata"),
    )


def write_envelopes(rows: DataFrame, path: str) -> None:
    """Append by type and event day; sources share files, sorted, so that a range read skips the row groups of others."""
    _write(rows.withColumns(date_parts("timestamp")), path, BRONZE_PARTITIONS, ["source_id", "timestamp"], "append")


def read_envelopes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_typed(ENVELOPE_SCHEMA, BRONZE_PARTITIONS)).parquet(path)


def get_envelopes(spark: SparkSession, path: str, source_id: str, data_type: str, start: datetime, end: datetime) -> DataFrame:
    """Envelopes of one source and type in an inclusive range, in time order; only the days asked for are read."""
    day = F.concat_ws("-", *DAY_PARTITIONS)
    rows = read_envelopes(spark, path).where(
        (F.col("data_type") == data_type)
        & day.between(f"{start:%Y-%m-%d}", f"{end:%Y-%m-%d}")
        & (F.col("source_id") == source_id)
        & F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp"))
    )
    return rows.drop(*DAY_PARTITIONS).orderBy("timestamp")
