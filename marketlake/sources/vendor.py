"""Vendor payloads, landed as tables ``(symbol, body, ingest_ts)``, parsed into bars and stock rows.

A payload is one response. ``land_variants`` parses it once, when it lands; later steps take typed values out of the
stored VARIANT ``payload`` and read no JSON text. All readers take both kinds of tables. Responses that carry an error or no series go to a quarantine frame; nothing
is raised inside a job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.schema import BAR_SCHEMA

# Vendor field names.
SERIES_KEY = "Time Series (Daily)"
ERROR_KEY = "Error Message"
BAR_FIELDS = {
    "open": "1. open",
    "high": "2. high",
    "low": "3. low",
    "close": "4. close",
    "adjusted_close": "5. adjusted close",
    "volume": "6. volume",
}
PROFILE_FIELDS = {
    "name": "Name",
    "exchange": "Exchange",
    "sector": "Sector",
    "industry": "Industry",
    "currency": "Currency",
    "market_cap": "MarketCapitalization",
    "country": "Country",
    "description": "Description",
}
UNKNOWN_EXCHANGE = "Unknown"
UNEXPECTED = "unexpected response format"
MALFORMED = "_malformed"

_PAYLOAD = f"struct<`{SERIES_KEY}`: map<string, map<string, string>>, `{ERROR_KEY}`: string>"


def land_payloads(responses: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Raw responses as they came, stamped with the ingest time."""
    return responses.select(
        "symbol", F.col("body").cast("string").alias("body"), (ingest_ts if ingest_ts is not None else F.current_timestamp()).alias("ingest_ts")
    )


def land_variants(responses: DataFrame, ingest_ts: Column | None = None) -> DataFrame:
    """Responses with their JSON as VARIANT ``payload``; ``body`` keeps only texts that are no JSON, whose payload is NULL."""
    parsed = land_payloads(responses, ingest_ts).withColumn("payload", F.try_parse_json("body"))
    return parsed.withColumn("body", F.when(F.col("payload").isNull(), F.col("body")))


def _at(key: str) -> str:
    """The path of a field; vendor names hold dots and blanks, and no quotes."""
    return f"$['{key}']"


def _parsed(payloads: DataFrame) -> DataFrame:
    """The payloads with ``series`` (fields by day) and the ``error`` of those that cannot be used."""
    if "payload" in payloads.columns:
        series = F.try_variant_get("payload", _at(SERIES_KEY), "map<string, variant>")
        said = F.try_variant_get("payload", _at(ERROR_KEY), "string")
    else:
        parsed = F.from_json("body", _PAYLOAD)
        series, said = parsed[SERIES_KEY], parsed[ERROR_KEY]
    return payloads.withColumns({"series": series, "error": F.coalesce(said, F.when(series.isNull(), F.lit(UNEXPECTED)))})


def split_payloads(payloads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected with their ``error``); a rejected VARIANT is text again."""
    checked = _parsed(payloads).drop("series")
    rejected = checked.where("error IS NOT NULL")
    if "payload" in payloads.columns:
        rejected = rejected.withColumn("body", F.coalesce("body", F.to_json("payload"))).drop("payload")
    return checked.where("error IS NULL").drop("error"), rejected


def bars_from_payloads(payloads: DataFrame, start=None, end=None) -> DataFrame:
    """Bars of all accepted payloads, optionally within an inclusive date range; a ``seq`` column is kept."""
    kept = ["symbol", *(["seq"] if "seq" in payloads.columns else [])]
    days = (
        _parsed(payloads)
        .where("error IS NULL")
        .select(*kept, F.explode("series").alias("day", "fields"))
        .withColumn("timestamp", F.try_to_timestamp("day", F.lit("yyyy-MM-dd")))
    )
    if start is not None and end is not None:
        days = days.where(F.col("timestamp").between(F.lit(start).cast("timestamp"), F.lit(end).cast("timestamp")))
    kinds = {f.name: f.dataType for f in BAR_SCHEMA.fields if f.name in BAR_FIELDS}
    if "payload" in payloads.columns:
        values = [F.try_variant_get("fields", _at(BAR_FIELDS[c]), kinds[c].simpleString()).alias(c) for c in kinds]
    else:
        values = [F.col("fields")[BAR_FIELDS[c]].try_cast(kinds[c]).alias(c) for c in kinds]
    return days.select(*kept, "timestamp", *values)


def bars_from_frame(frame: DataFrame) -> DataFrame:
    """Bars of a vendor table with ``Open``/``High``/``Low``/``Close``/``Volume``; closes are adjusted already."""
    return frame.select(
        "symbol",
        F.col("timestamp").cast("timestamp").alias("timestamp"),
        *[F.col(c).cast("double").alias(c.lower()) for c in ("Open", "High", "Low", "Close")],
        F.col("Volume").cast("bigint").alias("volume"),
        F.col("Close").cast("double").alias("adjusted_close"),
    )


def _parsed_profiles(profiles: DataFrame, fields: dict[str, str]) -> DataFrame:
    schema = ", ".join(f"`{v}` string" for v in [*fields.values(), ERROR_KEY, MALFORMED])
    parsed = F.from_json("body", schema, {"columnNameOfCorruptRecord": MALFORMED})
    error = (
        F.when(parsed.isNull() | parsed[MALFORMED].isNotNull() | ~F.trim("body").startswith("{"), F.lit(UNEXPECTED))
        .when(parsed[ERROR_KEY].isNotNull(), parsed[ERROR_KEY])
        .when(F.col("symbol").isNull(), F.lit("no symbol"))
    )
    return profiles.withColumns({"p": parsed, "error": error})


def rejected_profiles(profiles: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Profiles that are no JSON object or carry an error, with their ``error``."""
    return _parsed_profiles(profiles, fields or PROFILE_FIELDS).where("error IS NOT NULL").drop("p")


def stocks_from_profiles(profiles: DataFrame, fields: dict[str, str] | None = None) -> DataFrame:
    """Stock rows from profile JSON ``(symbol, body)``; name defaults to the symbol, exchange to Unknown."""
    fields = fields or PROFILE_FIELDS
    parsed = _parsed_profiles(profiles, fields).where("error IS NULL")
    columns = {n: F.col("p")[v] for n, v in fields.items()}
    columns["name"] = F.coalesce(columns["name"], F.col("symbol"))
    columns["exchange"] = F.coalesce(columns["exchange"], F.lit(UNKNOWN_EXCHANGE))
    if "market_cap" in columns:
        columns["market_cap"] = columns["market_cap"].try_cast("bigint")
    return parsed.select("symbol", *[c.alias(n) for n, c in columns.items()])
