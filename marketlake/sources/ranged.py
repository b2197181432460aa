"""Point reads of bars by an index of files: of each month only the files that can hold the symbol are opened.

``write_ranged`` deals the bars out by ranges of (month, symbol, time), so that the bars of a symbol and month lie in one file
or, where they are many, in a few neighbouring ones. ``index_files`` enters the first and last symbol of files in an index beside the bars,
out of sight of readers of the folder. The index only leaves files out: those it does not list, as other writers add
them, are read, and entries of files that are gone are passed over. It never has to be up to date for a right result.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schema import BAR_SCHEMA
from marketlake.sources.files import exists, names_in
from marketlake.sources.store import MONTH_PARTITIONS, between_months, month_parts

INDEX = "_files"
INDEX_SCHEMA = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("first", T.StringType()),
        T.StructField("last", T.StringType()),
        T.StructField("rows", T.LongType()),
        *[T.StructField(p, T.StringType()) for p in MONTH_PARTITIONS],
    ]
)


def write_ranged(bars: DataFrame, path: str, mode: str = "append") -> None:
    """Write bars by month and ranges of symbols, and index the files. ``overwrite`` replaces only the months written.

    The ranges come from a sample of the bars; a symbol with more bars in a month than a range holds is cut by time. Bars without
    a symbol or a time are stored as well.
    """
    keys = [*MONTH_PARTITIONS, "symbol", "timestamp"]
    rows = bars.withColumns(month_parts()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*MONTH_PARTITIONS).parquet(path)
    index_files(bars.sparkSession, path)


def index_files(spark: SparkSession, path: str) -> None:
    """Index the files that are not indexed yet; of the others only names are read."""
    placed = T.StructType([BAR_SCHEMA["symbol"], *[INDEX_SCHEMA[p] for p in MONTH_PARTITIONS]])
    rows = spark.read.schema(placed).parquet(path).select("*", F.col("_metadata.file_name").alias("file"))
    known = _index(spark, path)
    if known is not None:
        rows = rows.join(known.select("file", *MONTH_PARTITIONS), ["file", *MONTH_PARTITIONS], "left_anti")
    found = rows.groupBy("file", *MONTH_PARTITIONS).agg(F.min("symbol").alias("first"), F.max("symbol").alias("last"), F.count("*").alias("rows"))
    found.select(*INDEX_SCHEMA.names).hint("rebalance", *MONTH_PARTITIONS).write.mode("append").partitionBy(*MONTH_PARTITIONS).parquet(f"{path}/{INDEX}")


def _index(spark: SparkSession, path: str) -> DataFrame | None:
    return spark.read.schema(INDEX_SCHEMA).parquet(f"{path}/{INDEX}") if exists(spark, f"{path}/{INDEX}") else None


def files_of(spark: SparkSession, path: str, symbols: Sequence[str], start: datetime, end: datetime) -> list[str]:
    """The files below ``path`` that can hold bars of the symbols in an inclusive time range.

    Listed are the months of the range, of which the calendar has twelve a year; the index answers with the files of these that
    are too far off in the alphabet.
    """
    months = [(y, m) for y in names_in(spark, path) if y.startswith("year=") for m in names_in(spark, f"{path}/{y}") if m.startswith("month=")]
    low, high = (f"year={at:%Y}/month={at:%m}" for at in (start, end))
    folders = [f"{y}/{m}" for y, m in months if low <= f"{y}/{m}" <= high]
    index, left_out = _index(spark, path), set()
    if index is not None and folders:
        place = F.concat(F.lit("year="), "year", F.lit("/month="), "month")
        covers = [F.lit(s).between(F.col("first"), F.col("last")) for s in symbols]
        near = F.lit(False)
        for c in covers:
            near = near | F.coalesce(c, F.lit(False))
        years = sorted({f[5:9] for f in folders})
        far = index.where(F.col("year").isin(years) & place.isin(folders) & ~near)
        left_out = {f"{r[0]}/{r[1]}" for r in far.select(place, "file").toLocalIterator()}
    names = (f"{folder}/{n}" for folder in folders for n in names_in(spark, f"{path}/{folder}") if not n.startswith(("_", ".")))
    return [f"{path}/{n}" for n in names if n not in left_out]


def get_ranged(
    spark: SparkSession, path: str, symbols: str | Sequence[str], start: datetime, end: datetime, schema: T.StructType = BAR_SCHEMA
) -> DataFrame:
    """Bars of one symbol or a list of them in an inclusive time range, by symbol and time; no rows where there are none."""
    symbols = [symbols] if isinstance(symbols, str) else list(symbols)
    chosen = files_of(spark, path, symbols, start, end)
    placed = T.StructType([*schema.fields, *[INDEX_SCHEMA[p] for p in MONTH_PARTITIONS]])
    if not chosen:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(placed).option("basePath", path).parquet(*chosen)
    rows = between_months(rows, start, end).where(F.col("symbol").isin(symbols))
    return rows.drop(*MONTH_PARTITIONS).orderBy("symbol", "timestamp")
