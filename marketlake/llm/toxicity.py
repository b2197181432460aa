"""Toxicity by a counterfactually regularised linear classifier on words and word beginnings.

Features are the words of a text (letters, ASCII case folded) and their first 4 to 8 bytes, as 64-bit hashes. The classifier keeps those
whose share of toxic texts differs clearly from that of others. It is a logistic regression with
a penalty on score changes: every labelled text that mentions an identity term is paired with the same text in which
the terms are swapped for others of their group, and the squared difference of the two scores is added to the loss.
A term that only happens to be frequent in toxic texts then cannot carry weight, so neutral mentions are not flagged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.graph import written
from marketlake.llm.langid import bounded_sample, held_out
from marketlake.llm.text import WordHash, on_arrow, text_chunks, word_bounds

SAMPLE = 6000
FEATURES = 2000
LEAST_Z = 4.0
LEAST_TEXTS = 4
STARTS = (4, 5, 6, 7, 8)
RIDGE = 1e-5
SWAP_PENALTY = 1.0
STEPS = 800
CUT = 0.7

# Terms of one row are swapped for each other; all are single words.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("black", "white", "asian", "latino", "arab"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("mujeres", "hombres"),
    ("musulmanes", "cristianos", "judíos"),
    ("femmes", "hommes"),
    ("musulmans", "chrétiens", "juifs"),
    ("frauen", "männer"),
    ("muslime", "christen", "juden"),
)

# Letters of other alphabets are two or more bytes; ASCII but letters separates words.
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[0x80:] = np.arange(0x80, 0x100)
_LETTER[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_LETTER[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def swaps(text: str) -> list[str]:
    """The text with all its identity terms moved on by 1, 2, ... places in their groups; none if it has no term."""
    place = {term: (group, i) for group in IDENTITY_TERMS for i, term in enumerate(group)}
    terms = re.compile(r"(?<!\w)(" + "|".join(sorted(map(re.escape, place), key=len, reverse=True)) + r")(?!\w)", re.IGNORECASE)
    groups = {place[m.lower()][0] for m in terms.findall(text)}
    turns = max((len(g) for g in groups), default=1) - 1

    def moved(by: int):
        def one(m: re.Match) -> str:
            group, i = place[m[0].lower()]
            return group[(i + by) % len(group)]

        return one

    return [terms.sub(moved(by), text) for by in range(1, turns + 1)]


def features(column: pa.Array, hashing: WordHash) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, feature hashes, row of each) over runs of rows, with repetitions."""
    for row, data, offsets in text_chunks(column):
        data = _LETTER[data]
        begin, end, firsts = word_bounds(data, offsets)
        rows = np.repeat(np.arange(len(offsets) - 1), np.diff(firsts))
        values, owner = [hashing.of(data, begin, end)], [rows]
        for n in STARTS:
            long = np.flatnonzero(end - begin > n)
            values.append(hashing.of(data, begin[long], begin[long] + n))
            owner.append(rows[long])
        yield row, np.concatenate(values), np.concatenate(owner)


class Matcher:
    """Which of a bounded list of features a text has."""

    def __init__(self, chosen: np.ndarray) -> None:
        self.chosen = np.sort(chosen)
        self.maybe = np.zeros(1 << 20, dtype=bool)
        self.maybe[(self.chosen >> np.uint64(44)).astype(np.int64)] = True

    def find(self, column: pa.Array, hashing: WordHash) -> tuple[np.ndarray, np.ndarray]:
        """(row, feature) of all distinct pairs, by row."""
        rows, found = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
        for first, values, owner in features(column, hashing) if len(self.chosen) else ():
            likely = np.flatnonzero(self.maybe[(values >> np.uint64(44)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.chosen, values[likely]), len(self.chosen) - 1)
            exact = self.chosen[at] == values[likely]
            both = np.unique((owner[likely][exact] + first) * len(self.chosen) + at[exact])
            rows.append(both // len(self.chosen))
            found.append(both % len(self.chosen))
        return np.concatenate(rows), np.concatenate(found)


class Classifier:
    def __init__(self, matcher: Matcher, weights: np.ndarray, bias: float) -> None:
        self.matcher, self.weights, self.bias = matcher, weights, bias

    def scores(self, column: pa.Array, hashing: WordHash) -> np.ndarray:
        rows, found = self.matcher.find(column, hashing)
        z = self.bias + np.bincount(rows, weights=self.weights[found], minlength=len(column))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts hold a feature, in the texts of a chunk."""
    hashing = WordHash()
    for batch in batches:
        for _, values, owner in features(batch.column(0), hashing):
            order = np.lexsort((owner, values))
            values, owner = values[order], owner[order]
            new = np.ones(len(values), dtype=bool)
            new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
            one, n = np.unique(values[new], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(one.astype(np.int64)), pa.array(n)], ["feature", "n"])


def _pairs(rows: np.ndarray, found: np.ndarray, n: int) -> list[list[int]]:
    bounds = np.searchsorted(rows, np.arange(n + 1))
    return [found[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]


def fit(x: list[list[int]], y: np.ndarray, swapped: list[tuple[int, list[int]]], size: int, penalty: float = SWAP_PENALTY, ridge: float = RIDGE) -> tuple[np.ndarray, float]:
    """Weights and bias: mean log-loss with both classes weighted alike, ``ridge`` times the squared weights and ``penalty`` times
    the mean squared score difference (before the sigmoid) of texts and their swapped forms."""
    rows = np.repeat(np.arange(len(x)), [len(f) for f in x])
    cols = np.fromiter((c for f in x for c in f), dtype=np.int64, count=len(rows))
    each = np.where(y == 1, 0.5 / max(1, y.sum()), 0.5 / max(1, (1 - y).sum()))
    change = [(k, c, s) for k, (i, f) in enumerate(swapped) for c, s in [*((c, 1.0) for c in f), *((c, -1.0) for c in x[i])]]
    c_row, c_col, c_sign = (np.array(v) for v in zip(*change, strict=True)) if change else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    w, bias = np.zeros(size), 0.0
    m, v, mb, vb = np.zeros(size), np.zeros(size), 0.0, 0.0
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(rows, weights=w[cols], minlength=len(x))
        off = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) * each
        g = np.bincount(cols, weights=off[rows], minlength=size) + 2 * ridge * w
        if len(c_row):
            d = np.bincount(c_row, weights=w[c_col] * c_sign, minlength=len(swapped))
            g += 2 * penalty / len(swapped) * np.bincount(c_col, weights=d[c_row] * c_sign, minlength=size)
        gb = off.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 / np.sqrt(step)
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(vb / (1 - 0.99**step)) + 1e-8)
    return w, float(bias)


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, penalty: float = SWAP_PENALTY) -> Classifier:
    """A classifier from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic 0 or 1).

    Of a class with more than ``sample`` labelled rows about so many are read, by a hash of doc_id, so what is fetched is bounded
    whatever the tables' sizes. Without rows of both classes every score is the share of toxic labels.
    """
    spark = docs.sparkSession
    marked = labels.where("doc_id IS NOT NULL AND toxic IN (0, 1)").select("doc_id", F.col("toxic").cast("int").alias("toxic"))
    sizes = {r["toxic"]: r["count"] for r in marked.groupBy("toxic").count().toArrow().to_pylist()}
    prior = (sizes.get(1, 0) + 1) / (sum(sizes.values()) + 2)
    base = float(np.log(prior / (1 - prior)))
    chosen = bounded_sample(marked, "doc_id", "toxic", sample).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # About 2 * sample rows of 12 bytes, by the bound of the sample.
    known = written(docs.where("text IS NOT NULL").select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic"), "labelled")
    totals = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().toArrow().to_pylist()}
    if len(totals) < 2:
        return Classifier(Matcher(np.zeros(0, dtype=np.uint64)), np.zeros(0), base)

    def presence(toxic: int) -> DataFrame:
        rows = on_arrow(known.where(F.col("toxic") == toxic).select("text"), _presence, "feature long, n long")
        return rows.groupBy("feature").agg(F.sum("n").alias(f"n{toxic}"))

    both = presence(1).join(presence(0), "feature", "full_outer").na.fill(0)
    share = (F.col("n1") + F.col("n0")) / sum(totals.values())
    z = (F.col("n1") / totals[1] - F.col("n0") / totals[0]) / F.sqrt(share * (1 - share) * (1 / totals[1] + 1 / totals[0]) + 1e-9)
    best = both.withColumn("z", z).where((F.abs("z") >= LEAST_Z) & (F.col("n1") + F.col("n0") >= LEAST_TEXTS))
    best = best.orderBy(F.desc(F.abs("z")), "feature").limit(FEATURES).select("feature").toArrow()
    matcher = Matcher(best["feature"].to_numpy().astype(np.uint64))
    shared = spark.sparkContext.broadcast(matcher)

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = WordHash()
        for batch in batches:
            own = _pairs(*shared.value.find(batch.column(0), hashing), len(batch))
            turned = [(i, s) for i, t in enumerate(batch.column(0).to_pylist()) for s in swaps(t)]
            texts = pa.array([s for _, s in turned], pa.string())
            other: list[list] = [[] for _ in own]
            for (i, _), f in zip(turned, _pairs(*shared.value.find(texts, hashing), len(turned)), strict=True):
                other[i].append(f)
            kinds = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(own, kinds), pa.array(other, pa.list_(kinds))], ["toxic", "own", "swapped"])

    rows = on_arrow(known.select("text", "toxic"), present, "toxic int, own array<long>, swapped array<array<long>>").toArrow().to_pylist()
    x, y = [r["own"] for r in rows], np.array([r["toxic"] for r in rows])
    pairs = [(i, f) for i, r in enumerate(rows) for f in r["swapped"]]
    weights, bias = fit(x, y, pairs, len(matcher.chosen), penalty)
    return Classifier(matcher, weights, bias + base)


def scored(docs: DataFrame, model: Classifier, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, unless given; those that clash are replaced) of ``docs`` with ``score`` from 0 to 1 and ``predicted`` (1 from ``CUT`` on), from every whole text.

    A null or empty text has the score of a text without any known feature. Rows are kept as they are, repeated ones too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("score", "predicted")]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = WordHash()
        for batch in batches:
            found = shared.value.scores(batch.column(len(columns)), hashing)
            out = [*batch.columns[: len(columns)], pa.array(found), pa.array((found >= CUT).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(out, [*columns, "score", "predicted"])

    given = docs.select(*columns, F.col("text").alias("_text"))
    more = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    return on_arrow(given, score, T.StructType([*given.schema.fields[:-1], *more]))


def predictions(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs`` (doc_id, text, any further columns); learns from labels that are not held out."""
    out = held_out("doc_id", 3, 1)
    model = learn(docs, labels.where(~out))
    return scored(docs.select("doc_id", "text", out.alias("held_out")), model, ["doc_id", "held_out"])
