"""The registered queries against their SQL, and the pipeline's stages against plain Python."""

import re

import duckdb
import pytest
from helpers_llm import changed, near_groups, prose
from pyspark.sql import functions as F
from test_search_and_secrets import plain_base
from test_tokens import check_packed
from tokenizers import Tokenizer

import __spark_entry__
import corpus_pipeline
from marketlake.llm import langid, queries, tokens, toxicity
from marketlake.llm.text import WordHash


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_gives_the_rows_of_its_sql(spark, folder, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    answer = con.execute(queries.SQL[name])
    columns = [d[0] for d in answer.description]
    got = queries.QUERIES[name](spark, folder)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(map(tuple, got.select(*columns).collect())) == sorted(answer.fetchall())


def test_all_thirteen_and_the_pipeline_are_registered():
    names = __spark_entry__.queries()
    for n in range(1, 14):
        assert sum(bool(re.match(f"op{n}_", q)) for q in names) == 1
    assert names["pipeline"] is corpus_pipeline.run


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.SQL)))
def test_other_queries_cover_their_table(spark, folder, name):
    rows = queries.QUERIES[name](spark, folder).select("doc_id").distinct().count()
    assert rows == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_no_python_runs_in_the_secret_scan(spark, folder):
    plan = queries.QUERIES["op3_secret_scan"](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


@pytest.fixture(scope="module")
def planted(spark, folder, tmp_path_factory):
    """A small documents table with planted cases, and labels."""
    root = str(tmp_path_factory.mktemp("planted"))
    rows = []
    for i in range(240):
        words = prose(80, 1000 + i).split()
        if i % 3 == 0:
            words[i % 80] = "idiot"
        rows.append((i, " ".join(words), "en", "src0", 0))
    base = prose(400, 5)
    rows += [(300, base, "en", "s", 0), (301, base, "en", "s", 0), (302, changed(base, 150), "en", "s", 0), (303, base + " idiot", "en", "s", 0)]
    rows += [(310, "password: hunter22 " + prose(40, 6), "en", "s", 0), (311, "12 34", "en", "s", 0), (312, None, None, None, None), (313, "", "en", "s", 0)]
    rows += [(314, "日本語テキスト" * 20, None, "s", 0), (320, prose(90, 7), "en", "s", 0), (320, prose(90, 7), "en", "s", 0), (None, prose(50, 8), "en", "s", 0)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long")).write.parquet(f"{root}/documents.parquet")
    labels = [(i, 1, int(i % 3 == 0)) for i in range(240)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    return root


def test_stages(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "toxicity", "near_duplicates", "secrets", "packing"]

    def ids(df):
        return sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in df.collect())

    spoken = corpus_pipeline.written(stages["language"](spark, docs, planted), "test")
    assert spoken.schema == docs.schema
    assert set(ids(docs)) - set(ids(spoken)) == {311, 312, 313, 314}

    civil = corpus_pipeline.written(stages["toxicity"](spark, spoken, planted), "test")
    model = toxicity.learn(spoken, spark.read.parquet(f"{planted}/labels.parquet").where(~langid.held_out("doc_id", 3, 1)))
    import pyarrow as pa

    texts = {r["doc_id"]: r["text"] for r in spoken.collect()}
    scores = dict(zip(texts, model.scores(pa.array(list(texts.values())), WordHash()), strict=True))
    assert set(ids(civil)) == {i if i is not None else -1 for i, s in scores.items() if s < 0.7}
    assert set(ids(spoken)) - set(ids(civil)) == {i for i in range(0, 240, 3)} | {303}

    unique = corpus_pipeline.written(stages["near_duplicates"](spark, civil, planted), "test")
    groups = near_groups({r["doc_id"]: r["text"] for r in civil.where("doc_id IS NOT NULL").collect()}, 80)
    assert ids(unique) == sorted([-1, *(i for i, (_, root) in groups.items() if i == root)])
    assert 300 in ids(unique) and not {301, 302} & set(ids(unique))

    clean = corpus_pipeline.written(stages["secrets"](spark, unique, planted), "test")
    assert clean.schema == docs.schema and ids(clean) == ids(unique)
    before = {r["doc_id"]: r["text"] for r in unique.collect()}
    for r in clean.collect():
        assert r["n_chars"] == len(r["text"])
        assert ("[REDACTED]" in r["text"]) == bool(plain_base(before[r["doc_id"]]))

    rows = stages["packing"](spark, clean, planted).collect()
    library = Tokenizer.from_file(tokens.default_path())
    check_packed(rows, {r["doc_id"]: r["text"] for r in clean.collect()}, library, 2048)


def test_run_gives_the_rows_of_its_stages(spark, planted):
    assert corpus_pipeline.run(spark, planted).agg(F.sum("length")).first()[0] > 10_000


def test_stages_take_empty_tables(spark, planted):
    docs = spark.read.parquet(f"{planted}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, planted).collect() == []


def test_a_repeated_doc_id_keeps_its_other_texts(spark):
    own, other, copied = prose(90, 21), prose(90, 22), prose(90, 23)
    rows = [(1, copied), (2, copied), (2, own), (3, own + " x"), (4, other), (4, other), (4, prose(90, 24))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == sorted([(1, copied), (2, own), (4, other), (4, prose(90, 24))])


def test_stages_keep_columns_named_like_their_own(spark, planted):
    names = ["score", "lang_pred", "predicted", "text_hash", "_text", "_letters", "spans", "base", "row", "held_out"]
    docs = spark.read.parquet(f"{planted}/documents.parquet").where("doc_id < 30 OR doc_id >= 300")
    docs = docs.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, planted), "test")
        rows = docs.where("doc_id IS NOT NULL").collect()
        assert rows and set(names) <= set(docs.columns), name
        assert all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names), name
