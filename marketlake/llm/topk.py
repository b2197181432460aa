"""Exact inner-product search by columnar branch and bound.

Vectors are dealt into blocks and every block of queries meets every block of candidates once. In a meeting the
candidates lie dimension by dimension. A query takes its dimensions in order of weight, some at a time: partial
scores are sums of whole columns, and what the dimensions left can still add is bounded by the product of the
remaining norms of query and candidate. Candidates that cannot reach the k-th best score known are dropped and the
columns compacted, until the survivors' scores are complete.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import key_runs, on_arrow

SCALE = 256.0
QUERY_BLOCK = 1024
CANDIDATE_BLOCK = 16384
STEP = 8
_EXACT = float(1 << 53)


def codes(embedding: str = "embedding", scale: float = SCALE):
    """``floor(scale * x)`` of each component, null for vectors that are null, empty or hold null or non-finite components."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when((F.size(x) > 0) & sound, F.transform(x, lambda v: F.floor(v * F.lit(scale)).cast("long")))


def best(query: np.ndarray, columns: np.ndarray, norms: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best (ids, scores) for one query among the columns (dimension by candidate), ties to smaller ids.

    ``norms`` are the candidates' squared norms. Scores are sums of integers below 2**53 in double precision, so
    exact; bounds are widened by more than they can be off by.
    """
    order = np.argsort(-np.abs(query), kind="stable")
    alive = np.flatnonzero(ids != own)
    partial = np.zeros(len(alive))
    left = norms[alive].copy()
    rest = float(query @ query)
    data, floor = columns, -np.inf
    if len(alive) < len(ids):
        data = columns[:, alive]
    for at in range(0, len(order), STEP):
        dims = order[at : at + STEP]
        part = data[dims]
        partial += query[dims] @ part
        left -= np.einsum("ij,ij->j", part, part)
        rest -= float(query[dims] @ query[dims])
        if len(alive) <= 4 * k or at + STEP >= len(order):
            continue
        if floor == -np.inf or len(alive) > 64 * k:
            top = np.argpartition(-partial, k - 1)[:k]
            later = order[at + STEP :]
            floor = max(floor, float((partial[top] + query[later] @ data[np.ix_(later, top)]).min()))
        reach = partial + np.sqrt(np.maximum(rest, 0.0) * np.maximum(left, 0.0)) * (1 + 1e-9) + 0.5
        keep = reach >= floor
        if keep.sum() < 0.7 * len(keep):
            alive, partial, left, data = alive[keep], partial[keep], left[keep], data[:, keep]
    first = np.lexsort((ids[alive], -partial))[:k]
    return ids[alive][first], partial[first]


def _plain(query: np.ndarray, columns: np.ndarray, ids: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for codes too large for exact doubles, in 64-bit integers."""
    scores = query.astype(np.int64) @ columns
    first = [i for i in np.lexsort((ids, -scores)) if ids[i] != own][:k]
    return ids[first], scores[first]


def _search(k: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["dims", "query_block", "block"]):
            asks = run["asks"].to_numpy()
            ids = run["vec_id"].to_numpy()
            dims = run["dims"][0].as_py()
            if asks.all() or not asks.any():
                continue
            rows = run["codes"].combine_chunks().flatten().to_numpy().reshape(-1, dims)
            others, table = ids[~asks], rows[~asks]
            again = 1
            if len(np.unique(others)) < len(others):
                both = np.unique(np.column_stack((others, table)), axis=0)
                others, table = both[:, 0], both[:, 1:]
                again = int(np.unique(others, return_counts=True)[1].max())
            queries, columns = rows[asks], np.ascontiguousarray(table.T)
            peak = max(float(np.abs(rows.astype(np.float64)).max()), 1.0)
            exact = peak * peak * dims < _EXACT
            if exact:
                queries, columns = queries.astype(np.float64), columns.astype(np.float64)
                norms = np.einsum("ij,ij->j", columns, columns)
            found = []
            for own, query in zip(ids[asks], queries, strict=True):
                near, scores = best(query, columns, norms, others, own, k * again) if exact else _plain(query, columns, others, own, k * again)
                found.append((np.full(len(near), own), near, scores.astype(np.int64)))
            columns = [pa.array(np.concatenate(c)) for c in zip(*found, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, ["query_id", "vec_id", "score"])

    return search


def top_scores(vectors: DataFrame, is_query, k: int = 5, query_block: int = QUERY_BLOCK, block: int = CANDIDATE_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best integer inner products of every row where ``is_query`` holds against
    all rows of ``vectors`` (vec_id, embedding, any further columns) but those of its own vec_id.

    Ties go to smaller vec_ids. Null, empty or non-finite vectors and rows without a vec_id take no part; vectors are compared
    with those of their own length. Rows that repeat a vec_id and vector count once; a vec_id with several
    vectors has its best score against each query, and as a query its best results over its vectors. Scores must fit 64 bits.
    An empty table has no results.
    """
    known = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), codes().alias("codes"), is_query.alias("asks"))
    known = known.where("vec_id IS NOT NULL AND codes IS NOT NULL").withColumn("dims", F.size("codes"))
    known = written(known, "codes")
    counts = known.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    n_query, n_block = max(1, -(-counts["q"] // query_block)), max(1, -(-counts["n"] // block))
    own = F.xxhash64("vec_id")
    asks = known.where("asks").withColumn("query_block", F.pmod(own, F.lit(n_query))).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_block - 1))))
    all_rows = known.withColumn("asks", F.lit(False)).withColumn("query_block", F.explode(F.sequence(F.lit(0), F.lit(n_query - 1))))
    all_rows = all_rows.withColumn("block", F.pmod(own, F.lit(n_block)))
    names = [F.col(c).cast("long").alias(c) for c in ("dims", "query_block", "block", "vec_id")]
    met = asks.select(*names, "asks", "codes").unionByName(all_rows.select(*names, "asks", "codes"))
    met = met.repartition("dims", "query_block", "block").sortWithinPartitions("dims", "query_block", "block")
    found = on_arrow(met, _search(k), "query_id long, vec_id long, score long").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
