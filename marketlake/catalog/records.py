"""Queries on records: masking and streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from marketlake.catalog.layers import INTRADAY, MONTHLY
from marketlake.catalog.layers import STATISTICS, shown_statistics
from marketlake.catalog.registry import CHANGES, DAILY, HOURLY, RSI, full, query
from marketlake.functions.masking import DEFAULT_SALT, EMAIL_PATTERN, mask_columns
from marketlake.schema import conform_bars
from marketlake.session import workspace
from marketlake.sources.bars import bars_daily, bars_events, table
from marketlake.streaming.stream import read_records, refresh_from, write_enriched

KEY = ["symbol", "timestamp"]
BAR = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]

# Contact fields in fixed formats, built from the customer key; SQL and Spark spell them alike.
CONTACTS = """contacts AS (
  SELECT c_custkey, c_name, c_mktsegment, c_acctbal, 'user' || c_custkey || '@example.com' AS email,
         printf('+1 (%03d) %03d-%04d', c_custkey % 1000, (c_custkey * 7) % 1000, (c_custkey * 13) % 10000) AS phone,
         printf('%04d-%04d %04d-%04d', (c_custkey * 3) % 10000, (c_custkey * 17) % 10000, (c_custkey * 31) % 10000, c_custkey % 10000) AS card,
         printf('%03d-%02d-%04d', c_custkey % 1000, (c_custkey * 11) % 100, (c_custkey * 29) % 10000) AS ssn
  FROM customer)"""


def contacts(spark, folder):
    key = F.col("c_custkey")
    return table(spark, folder, "customer").select(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "c_acctbal",
        F.concat(F.lit("user"), key.cast("string"), F.lit("@example.com")).alias("email"),
        F.format_string("+1 (%03d) %03d-%04d", key % 1000, (key * 7) % 1000, (key * 13) % 10000).alias("phone"),
        F.format_string(
            "%04d-%04d %04d-%04d", (key * 3) % 10000, (key * 17) % 10000, (key * 31) % 10000, key % 10000
        ).alias("card"),
        F.format_string("%03d-%02d-%04d", key % 1000, (key * 11) % 100, (key * 29) % 10000).alias("ssn"),
    )


def email_sql(v: str) -> str:
    user, domain = f"split_part({v}, '@', 1)", f"substr({v}, instr({v}, '@'))"
    return f"""CASE WHEN instr({v}, '@') = 0 THEN {v}
  WHEN length({user}) <= 2 THEN repeat('*', length({user})) || {domain}
  ELSE left({user}, 1) || repeat('*', length({user}) - 2) || right({user}, 1) || {domain} END"""


def last_four_sql(v: str, separators: str) -> str:
    """Character by character, as the regular expressions of SQL look ahead nowhere."""
    char, rest = f"substr({v}, i, 1)", f"regexp_replace(substr({v}, i + 1), '[{separators}]', '', 'g')"
    return f"""array_to_string(list_transform(range(1, length({v}) + 1), lambda i:
  CASE WHEN regexp_matches({char}, '[{separators}]') OR length({rest}) < 4 THEN {char} ELSE '*' END), '')"""


def partial_sql(v: str) -> str:
    third = f"length({v}) // 3"
    return f"""CASE WHEN length({v}) <= 4 THEN repeat('*', length({v}))
  ELSE left({v}, {third}) || repeat('*', {third}) || substr({v}, 2 * ({third}) + 1) END"""


def personal_id_sql(v: str) -> str:
    return f"""CASE WHEN length({v}) <= 4 THEN repeat('*', length({v}))
  ELSE left({v}, 1) || repeat('*', length({v}) - 2) || right({v}, 1) END"""


PHONE, CARD = r" ().\-", r" \-"


def default_sql(v: str) -> str:
    def digits(separators: str, least: int, most: int) -> str:
        bare = f"regexp_replace({v}, '[{separators}]', '', 'g')"
        return f"regexp_full_match({bare}, '[0-9]{{{least},{most}}}')"

    return f"""CASE WHEN regexp_matches({v}, '{EMAIL_PATTERN.removeprefix("(?d)")}') THEN {email_sql(v)}
  WHEN {digits(r'\s().\-', 7, 15)} THEN {last_four_sql(v, PHONE)}
  WHEN {digits(r'\s\-', 13, 19)} THEN {last_four_sql(v, CARD)}
  WHEN {digits(r'\s\-', 9, 9)} THEN {last_four_sql(v, CARD)}
  ELSE {partial_sql(v)} END"""


def masked(spark, folder, *specs):
    return mask_columns(contacts(spark, folder), specs)


@query("mask_email", f"WITH {CONTACTS} SELECT c_custkey, {email_sql('email')} AS email, {email_sql('c_name')} AS c_name FROM contacts")
def mask_email(spark, folder):
    return masked(spark, folder, "email:email", "c_name:email").select("c_custkey", "email", "c_name")


@query("mask_phone", f"WITH {CONTACTS} SELECT c_custkey, {last_four_sql('phone', PHONE)} AS phone FROM contacts")
def mask_phone(spark, folder):
    return masked(spark, folder, "phone:phone").select("c_custkey", "phone")


@query("mask_card", f"WITH {CONTACTS} SELECT c_custkey, {last_four_sql('card', CARD)} AS card FROM contacts")
def mask_card(spark, folder):
    return masked(spark, folder, "card:credit_card").select("c_custkey", "card")


@query("mask_ssn", f"WITH {CONTACTS} SELECT c_custkey, {last_four_sql('ssn', CARD)} AS ssn FROM contacts")
def mask_ssn(spark, folder):
    return masked(spark, folder, "ssn:ssn").select("c_custkey", "ssn")


@query(
    "mask_personal_id",
    f"WITH {CONTACTS} SELECT c_custkey, {personal_id_sql('c_name')} AS c_name, {personal_id_sql('CAST(c_acctbal AS VARCHAR)')} AS c_acctbal FROM contacts",
)
def mask_personal_id(spark, folder):
    """A number is masked as its text."""
    return masked(spark, folder, "c_name:personal_id", "c_acctbal:personal_id").select("c_custkey", "c_name", "c_acctbal")


@query(
    "mask_name",
    r"""SELECT doc_id, array_to_string(list_transform(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''),
  lambda w: left(w, 1) || repeat('*', length(w) - 1)), ' ') AS text FROM documents""",
)
def mask_name(spark, folder):
    return mask_columns(table(spark, folder, "documents"), ["text:name"]).select("doc_id", "text")


@query("mask_hash", f"SELECT doc_id, sha256(text || '{DEFAULT_SALT}') AS text FROM documents")
def mask_hash(spark, folder):
    return mask_columns(table(spark, folder, "documents"), ["text:hash"]).select("doc_id", "text")


@query("mask_partial", f"SELECT doc_id, {partial_sql('text')} AS text FROM documents")
def mask_partial(spark, folder):
    """An unknown rule masks partially."""
    return mask_columns(table(spark, folder, "documents"), ["text:secret"]).select("doc_id", "text")


@query(
    "mask_remove",
    """SELECT c_custkey, CASE WHEN c_name IS NOT NULL THEN '[REMOVED]' END AS c_name,
       CASE WHEN c_acctbal IS NOT NULL THEN '[REMOVED]' END AS c_acctbal FROM customer""",
)
def mask_remove(spark, folder):
    return masked(spark, folder, "c_name:remove", "c_acctbal:remove").select("c_custkey", "c_name", "c_acctbal")


FIELDS = ["email", "phone", "card", "ssn", "c_name", "c_mktsegment"]


@query(
    "mask_default",
    f"""WITH {CONTACTS}, fields AS (UNPIVOT (SELECT c_custkey, {', '.join(FIELDS)} FROM contacts) ON {', '.join(FIELDS)} INTO NAME field VALUE v)
SELECT c_custkey, field, {default_sql('v')} AS value FROM fields""",
)
def mask_default(spark, folder):
    """The rule is detected from each value."""
    long = contacts(spark, folder).unpivot("c_custkey", FIELDS, "field", "value")
    return mask_columns(long, ["value"])


@query(
    "mask_nested",
    f"""WITH {CONTACTS} SELECT c_custkey, {email_sql('email')} AS email, phone AS first_phone, {last_four_sql('phone', PHONE)} AS second_phone,
       {partial_sql('c_name')} AS tag_a, c_mktsegment AS tag_b, {personal_id_sql('c_name')} AS id_a, {personal_id_sql('c_mktsegment')} AS id_b FROM contacts""",
)
def mask_nested(spark, folder):
    """Struct field, one array element, one map key, every element of a list; unknown paths change nothing."""
    nested = contacts(spark, folder).select(
        "c_custkey",
        F.struct(F.col("email").alias("email"), F.array("phone", "phone").alias("phones")).alias("contact"),
        F.create_map(F.lit("a"), F.col("c_name"), F.lit("b"), F.col("c_mktsegment")).alias("tags"),
        F.array("c_name", "c_mktsegment").alias("ids"),
    )
    specs = ["contact.email:email", "contact.phones[1]:phone", "contact.phones[9]", "contact.fax", "tags.a:other", "ids:personal_id"]
    return mask_columns(nested, specs).select(
        "c_custkey",
        "contact.email",
        F.col("contact.phones")[0].alias("first_phone"),
        F.col("contact.phones")[1].alias("second_phone"),
        F.col("tags")["a"].alias("tag_a"),
        F.col("tags")["b"].alias("tag_b"),
        F.col("ids")[0].alias("id_a"),
        F.col("ids")[1].alias("id_b"),
    )


# --- streams ----------------------------------------------------------------------------------------


@query("stream_enrich", f"WITH {HOURLY} {INTRADAY}")
def stream_enrich(spark, folder):
    """Bars as a file stream through the batch enrichment into a file sink."""
    source, sink = workspace(spark, "records"), workspace(spark, "enriched")
    conform_bars(bars_events(spark, folder)).write.parquet(source)
    write_enriched(read_records(spark, source), sink, workspace(spark, "checkpoint")).awaitTermination()
    return spark.read.parquet(sink).select(*BAR, "daily_performance", "range", "intraday_volatility")


@query(
    "stream_silver",
    f"""WITH {DAILY}, {CHANGES} SELECT symbol, "timestamp", close, round({full('avg', 'close', 20)}, 6) AS sma_20, round({RSI}, 6) AS rsi_14 FROM sided""",
)
def stream_silver(spark, folder):
    return refreshed(spark, folder).silver().select(*KEY, "close", "sma_20", "rsi_14")


def refreshed(spark, folder):
    """Bars arrive in three landings; the last also brings a month that symbol F was missing."""
    bronze, root, checkpoint = (workspace(spark, n) for n in ("bronze", "refresh", "checkpoint"))
    bars = conform_bars(bars_daily(spark, folder))
    at = F.col("timestamp")
    missing = (F.col("symbol") == "F") & at.between(F.lit(datetime(1994, 6, 1)), F.lit(datetime(1994, 6, 30)))
    early, middle = at < F.lit(datetime(1996, 1, 1)), at < F.lit(datetime(1998, 1, 1))
    for part in (early & ~missing, ~early & middle, ~middle | missing):
        bars.where(part).write.mode("append").parquet(bronze)
        refresh = refresh_from(spark, bronze, root, checkpoint)
    return refresh


@query("stream_statistics", STATISTICS)
def stream_statistics(spark, folder):
    """The statistics that the same stream merges from states by month."""
    return shown_statistics(refreshed(spark, folder).statistics())


@query("stream_gold", f"WITH {MONTHLY} SELECT * FROM result")
def stream_gold(spark, folder):
    """The gold months that the same stream keeps up to date."""
    return refreshed(spark, folder).gold()
