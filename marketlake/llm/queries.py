"""Registered queries of this package, each next to its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.llm import covertree, cross_entropy, divergence, langid, minhash, packing, pieces, rans, secret_scan, substrings, topk, toxicity, vector_codes
from marketlake.llm.graph import if_small, tables
from marketlake.session import workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


# --- SQL -------------------------------------------------------------------------------------------

TOP_K_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS codes FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.codes, c.codes) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.codes) = len(c.codes) WHERE q.vec_id % 50 = 0),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5"""

LOWER_ASCII = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# Needs links(a, b) and nodes(id).
ROOTS_SQL = """
sides AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(id, other) AS (SELECT id, id FROM nodes UNION SELECT r.id, s.b FROM reach r JOIN sides s ON r.other = s.a),
roots AS (SELECT id, min(other) AS root FROM reach GROUP BY id)"""

NEAR_TEXTS_SQL = f"""
WITH RECURSIVE nodes AS (SELECT doc_id AS id FROM documents),
words AS (SELECT doc_id, regexp_extract_all({LOWER_ASCII}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) ELSE [array_to_string(w, ' ')] END) AS shingle
  FROM words WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id < y.doc_id
  GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common c JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * c.n >= 85 * (x.n + y.n - c.n)),
{ROOTS_SQL}
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.root AS component_id, d.doc_id = r.root AS kept
FROM documents d JOIN roots r ON r.id = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id"""

NEAR_VECTORS_SQL = f"""
WITH RECURSIVE nodes AS (SELECT vec_id AS id FROM embeddings),
v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.vec_id AS a, q.vec_id AS b FROM v p JOIN v q ON p.label = q.label AND p.vec_id < q.vec_id AND len(p.x) = len(q.x)
  WHERE list_cosine_similarity(p.x, q.x) >= 0.93),
{ROOTS_SQL},
counted AS (SELECT a, count(*) AS n FROM sides GROUP BY a)
SELECT e.vec_id, coalesce(c.n, 0) AS n_links, r.root AS component_id, e.vec_id = r.root AS kept
FROM embeddings e JOIN roots r ON r.id = e.vec_id LEFT JOIN counted c ON c.a = e.vec_id"""


CODE_PARTS = "(VALUES (0), (1), (2), (3)) AS q(part)"


def codes_sql() -> str:
    """Rounds of k-means, one pair of tables each; whole numbers below 2**53 are exact as doubles."""
    steps = []
    for i in range(5):
        steps.append(f"""near{i} AS (
  SELECT vec_id, label, part, v, arg_min(index, (error, index)) AS index, min(error) AS error FROM (
    SELECT p.*, e.index, list_sum(list_transform(list_zip(p.v, e.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS error
    FROM parts p JOIN entries{i} e ON p.part = e.part)
  GROUP BY vec_id, label, part, v)""")
        if i < 4:
            steps.append(f"""means{i} AS (
  SELECT part, index, list(mean ORDER BY place) AS v FROM (
    SELECT part, index, place, CAST(floor(CAST(sum(x) AS DOUBLE) / count(*)) AS BIGINT) AS mean
    FROM (SELECT part, index, unnest(v) AS x, unnest(range(len(v))) AS place FROM near{i}) GROUP BY ALL)
  GROUP BY ALL),
entries{i + 1} AS (SELECT e.part, e.index, coalesce(m.v, e.v) AS v FROM entries{i} e LEFT JOIN means{i} m ON e.part = m.part AND e.index = m.index)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS codes FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
parts AS (SELECT vec_id, label, part, codes[part * (len(codes) // 4) + 1 : (part + 1) * (len(codes) // 4)] AS v FROM kept, {CODE_PARTS}),
entries0 AS (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS index, v FROM parts
  QUALIFY index < 256),
{", ".join(steps)},
coded AS (
  SELECT vec_id, label, string_agg(printf('%02x', index), '' ORDER BY part) AS code, CAST(sum(error) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id, label),
book AS (
  SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, index, place)) AS digest
  FROM (SELECT part, index, unnest(v) AS x, unnest(range(len(v))) AS place FROM entries4))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256 FROM coded, book"""


REPEATS_SQL = """
WITH words AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, start, array_to_string(w[start:start + 19], ' ') AS run
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS start FROM words WHERE len(w) >= 20)),
placed AS (SELECT doc_id, start, row_number() OVER (PARTITION BY md5_number(run), run ORDER BY doc_id, start) AS place FROM windows),
gone AS (
  SELECT DISTINCT doc_id, pos FROM (SELECT doc_id, unnest(range(start, start + 20)) AS pos FROM placed WHERE place > 1)),
each AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM words),
left_over AS (SELECT e.* FROM each e ANTI JOIN gone g ON e.doc_id = g.doc_id AND e.pos = g.pos),
texts AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS kept FROM left_over GROUP BY doc_id)
SELECT w.doc_id, len(w.w) AS n_words, len(w.w) - coalesce(t.n, 0) AS n_removed, sha256(coalesce(t.kept, '')) AS kept_sha256
FROM words w LEFT JOIN texts t ON w.doc_id = t.doc_id"""


def share_sql(count: str, total: str) -> str:
    return f"1 + CAST((CAST(1000000000 AS HUGEINT) * ({count} + 5)) // ({total} + 5 * v) AS BIGINT)"


AUDIT_SQL = f"""
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
terms AS (SELECT row, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS lang_n FROM terms GROUP BY ALL HAVING count(DISTINCT row) >= 30),
langs AS (SELECT lang, count(*) AS v, CAST(sum(lang_n) AS BIGINT) AS lang_total FROM kept GROUP BY lang),
counts AS (SELECT t.lang, t.source, t.term, count(*) AS n FROM terms t JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (
  SELECT d.lang, d.source, coalesce(l.v, 0) AS v, coalesce(l.lang_total, 0) AS lang_total, coalesce(c.total, 0) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) d LEFT JOIN langs l ON d.lang = l.lang
  LEFT JOIN (SELECT lang, source, CAST(sum(n) AS BIGINT) AS total FROM counts GROUP BY ALL) c ON c.lang = d.lang AND c.source = d.source),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, {share_sql('coalesce(c.n, 0)', 'g.total')} AS p, {share_sql('k.lang_n', 'g.lang_total')} AS q
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, CAST(sum(abs(a.p - b.p)) AS BIGINT) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM parts)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50"""


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return register


@query("op2_minhash_near_dedup", NEAR_TEXTS_SQL)
def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return minhash.near_duplicates(tables(spark, folder, "documents"), percent=85)


@query("op1_exact_top_k", TOP_K_SQL)
def exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return topk.top_scores(tables(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op3_secret_scan")
def secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_spans(tables(spark, folder, "documents"))


@query("op4_rans_token_file")
def rans_token_file(spark: SparkSession, folder: str) -> DataFrame:
    return rans.token_file(tables(spark, folder, "documents"), workspace(spark, "token-file")).drop("ids")


@query("op7_cover_tree_near_dedup", NEAR_VECTORS_SQL)
def cover_tree_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return covertree.near_vectors(tables(spark, folder, "embeddings"))


@query("op9_hilbert_packing")
def hilbert_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed_sequences(tables(spark, folder, "documents")).drop("ids")


@query("op10_language_filters")
def language_filters(spark: SparkSession, folder: str) -> DataFrame:
    return langid.predictions(tables(spark, folder, "documents"))


@query("op8_counterfactual_toxicity")
def counterfactual_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.predictions(tables(spark, folder, "documents"), tables(spark, folder, "labels"))


@query("op5_cross_entropy_difference")
def cross_entropy_difference(spark: SparkSession, folder: str) -> DataFrame:
    """Documents labelled as of good quality against all documents."""
    good = tables(spark, folder, "labels").where("quality = 1").select("doc_id").distinct().withColumn("good", F.lit(True))
    docs = tables(spark, folder, "documents").select("doc_id", "text").join(if_small(good), "doc_id", "left")
    return cross_entropy.scored(docs, F.col("good"))


@query("op6_sentencepiece")
def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoded(tables(spark, folder, "documents")).drop("ids")


@query("op11_walsh_hadamard_codes", codes_sql())
def walsh_hadamard_codes(spark: SparkSession, folder: str) -> DataFrame:
    return vector_codes.encoded(tables(spark, folder, "embeddings"))


@query("op12_substring_dedup", REPEATS_SQL)
def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.without_repeats(tables(spark, folder, "documents"), texts=False)


@query("op13_source_divergence", AUDIT_SQL)
def source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return divergence.audit(tables(spark, folder, "documents"))
