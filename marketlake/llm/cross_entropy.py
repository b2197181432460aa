"""Language-model scores by cross-entropy difference.

Two bigram models, of a target part of the corpus and of the whole as background, share one vocabulary and one
interpolation. A document's score is the mean over its tokens of the target model's loss less the background
model's: the lower, the more the document reads like the target.

All counts are over all documents. The models keep every word and bigram that comes at least ``LEAST_COUNT`` times, so they
grow with the corpus. Rarer words are one unknown word, rarer bigrams back off to their second word.

Texts are written once as blocks of some megabytes: their distinct words and, per token, the number of its word. A block asks
for the totals of its distinct words, bigrams and contexts in turn. It sends each bucket of keys one row of packed arrays, and the
bucket answers with the totals in the same order, so that an entry costs about six bytes on the way there and two on the way
back. A block sends a key once, however often it holds it, and keys are hashes: no bucket is hot. The number of buckets follows
from what is sent; a bucket fits a task at any size. With many more buckets than keys in a block, rows are as small as single entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import LOWER, WordHash, free_memory, fresh_key, mix, on_arrow, text_chunks, word_bounds

# Keep only words and bigrams that are at least one in so many of all tokens; None keeps all.
WORDS: int | None = None
BIGRAMS: int | None = None
LEAST_COUNT = 2
MIXED = 0.7
# In place of hashes: any word that is not kept, and what stands before a text.
UNKNOWN, START = 0, 1
# Bytes of text in a block (a text is never cut), and of keys that one bucket is sent.
BLOCK_BYTES = 4 << 20
BUCKET_BYTES = 8 << 20
_U = np.uint64
_SENT = "chunk long, keys binary, n binary, t binary, bucket long"
_SENT_NAMES = ["chunk", "keys", "n", "t", "bucket"]


def _planes(numbers: np.ndarray) -> bytes:
    """Numbers from 0 as compressed planes of bytes; upper ones are mostly zero where frequent words have small numbers."""
    data = np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(data.tobytes())


def _from_planes(data: bytes) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), dtype=np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1)


def _packed(keys: np.ndarray) -> bytes:
    """Sorted keys by their differences."""
    return _planes(np.concatenate((keys[:1], keys[1:] - keys[:-1])))


def _unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(_from_planes(data), dtype=np.uint64)


def _counts(data: bytes) -> np.ndarray:
    return _from_planes(data).astype(np.int64)


def _summed(place: np.ndarray, weights: np.ndarray, size: int) -> np.ndarray:
    return np.bincount(place, weights=weights, minlength=size).astype(np.int64)


def _kept(n: np.ndarray, share: int | None, total: int) -> np.ndarray:
    return (n >= LEAST_COUNT) & (n * share >= total) if share else n >= LEAST_COUNT


def _encoder(key: int, most: int):
    """Blocks of (doc_id, text, target): what a block sends about its words, and its tokens by the rank of their words."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, at = WordHash(key), TaskContext.get().partitionId() << 40
        for batch in batches:
            given = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            target = batch.column(2).to_numpy(zero_copy_only=False)
            for row, data, offsets in text_chunks(batch.column(1), most):
                begin, end, firsts = word_bounds(data, offsets)
                lengths = np.diff(firsts)
                rows = slice(row, row + len(lengths))
                good = target[rows]
                words, place, n = np.unique(hashing.of(LOWER[data], begin, end), return_inverse=True, return_counts=True)
                rank = np.empty(len(words), dtype=np.int64)
                rank[np.argsort(-n, kind="stable")] = np.arange(len(words))
                n_target = _summed(place, np.repeat(good, lengths), len(words))
                ids = pa.ListArray.from_arrays(pa.array([0, len(lengths)], pa.int32()), batch.column(0).slice(row, len(lengths)))
                values = {
                    "chunk": at, "keys": _packed(words), "n": _planes(n), "t": _planes(n_target),
                    "tokens": _planes(rank[place]), "lengths": _planes(lengths), "good": good.astype(np.uint8).tobytes(),
                    "n_words": len(words), "n_tokens": len(place), "n_target": int(n_target.sum()),
                    "begun": int(given[rows].sum()), "begun_target": int((given[rows] & good).sum()),
                }
                yield pa.RecordBatch.from_arrays([ids, *[pa.array([x]) for x in values.values()]], ["ids", *values])
                at += 1

    return encode


def _buckets(entries: int) -> int:
    return max(1, -(-8 * entries // BUCKET_BYTES))


def _dealt(chunk: int, keys: np.ndarray, n: np.ndarray, t: np.ndarray, buckets: int) -> pa.Table:
    """Sorted distinct keys of a block with their counts, a row for each bucket that has some."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    cuts = np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))
    filled = np.flatnonzero(np.diff(cuts))
    parts = [slice(cuts[b], cuts[b + 1]) for b in filled]
    packed = [[_packed(keys[p]) for p in parts], *[[_planes(x[p]) for p in parts] for x in (n, t)]]
    return pa.Table.from_arrays([pa.array(np.full(len(parts), chunk)), *[pa.array(x, pa.binary()) for x in packed], pa.array(filled)], _SENT_NAMES)


def _words_of(buckets: int):
    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, keys, n, t in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                yield from _dealt(chunk, _unpacked(keys), _counts(n), _counts(t), buckets).to_batches()

    return deal


def _totals(dealt: DataFrame, name: str, kept: Callable[[np.ndarray], np.ndarray]) -> DataFrame:
    """What every block gets back for what it ``dealt`` (chunk, keys, n, t, bucket): (chunk, kind, bucket, n, t), totals in its order.

    One row of each bucket also counts the bucket's ``kept`` keys (size) and sums their totals (known, known_target).
    """

    def answer(table: pa.Table) -> pa.Table:
        keys = [_unpacked(x) for x in table["keys"].to_pylist()]
        ends = np.cumsum([len(k) for k in keys])
        distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
        n, t = (_summed(place, np.concatenate([_counts(x) for x in table[c].to_pylist()]), len(distinct)) for c in ("n", "t"))
        known = kept(n)
        first = [int(known.sum()), int(n[known].sum()), int(t[known].sum())]
        parts = np.split(place, ends[:-1])
        arrays = [
            table["chunk"],
            pa.array([name] * len(parts)),
            table["bucket"],
            *[pa.array([_planes(x[p]) for p in parts], pa.binary()) for x in (n, t)],
            *[pa.array([x] + [0] * (len(parts) - 1), pa.int64()) for x in first],
        ]
        names = ["chunk", "kind", "bucket", "n", "t", "size", "known", "known_target"]
        free_memory()
        return pa.Table.from_arrays(arrays, names)

    schema = "chunk long, kind string, bucket long, n binary, t binary, size long, known long, known_target long"
    return written(dealt.groupBy("bucket").applyInArrow(answer, schema), f"totals-{name}")


def _block(left: pa.Table, right: pa.Table, is_known: Callable[[np.ndarray], np.ndarray]) -> SimpleNamespace:
    """A block's rows, distinct words and bigrams, with ``totals`` of what it was answered, in the order of its keys."""
    row = left.to_pylist()[0]
    words, n = _unpacked(row["keys"]), _counts(row["n"])
    lengths = _counts(row["lengths"])
    place = np.argsort(-n, kind="stable")[_counts(row["tokens"])]
    answers = sorted(right.to_pylist(), key=lambda r: r["bucket"])

    def totals(kind: str) -> list[np.ndarray]:
        mine = [r for r in answers if r["kind"] == kind]
        return [np.concatenate([np.zeros(0, dtype=np.int64), *[_counts(r[c]) for r in mine]]) for c in ("n", "t")]

    known = is_known(totals("words")[0])
    second = np.where(known, words, _U(UNKNOWN))[place]
    first = np.append(np.array([START], dtype=np.uint64), second)[:-1]
    first[(np.cumsum(lengths) - lengths)[lengths > 0]] = START
    keys, at, of, times = np.unique(mix(first * _U(0x9E3779B97F4A7C15) + second), return_index=True, return_inverse=True, return_counts=True)
    good = np.repeat(np.frombuffer(row["good"], dtype=np.uint8), lengths)
    contexts, context = np.unique(first[at], return_inverse=True)
    return SimpleNamespace(
        chunk=row["chunk"], ids=left["ids"].combine_chunks().flatten(), lengths=lengths, words=words, totals=totals,
        keys=keys, of=of, n=times, t=_summed(of, good, len(keys)), second=second[at], contexts=contexts, context=context,
    )


def _each_block(blocks: DataFrame, answers: DataFrame, fn: Callable[[SimpleNamespace], pa.Table], schema: str, is_known: Callable) -> DataFrame:
    def of_block(left: pa.Table, right: pa.Table) -> pa.Table:
        found = fn(_block(left, right, is_known))
        free_memory()
        return found

    blocks = blocks.select("chunk", "ids", "keys", "n", "tokens", "lengths", "good")
    answers = answers.select("chunk", "kind", "bucket", "n", "t")
    return blocks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(of_block, schema)


def scored(docs: DataFrame, is_target: Column) -> DataFrame:
    """(doc_id, n_words, target_loss, background_loss, score) for every row of ``docs`` (doc_id, text, any further columns).

    Both models are of all texts of ``docs``; rows where ``is_target`` holds are the target.
    Words are runs between ASCII white space, ASCII case folded. Losses are means over the words of the whole text;
    a null, empty or blank text has none, and null losses and score. Repeated rows and rows without a
    doc_id count and are scored like others; without target rows the target model is uniform; an empty table has no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.coalesce(is_target, F.lit(False)).alias("target"))
    more = "keys binary, n binary, t binary, tokens binary, lengths binary, good binary, n_words long, n_tokens long, n_target long, begun long, begun_target long"
    blocks = written(on_arrow(rows, _encoder(fresh_key(), BLOCK_BYTES), f"ids array<{kind}>, chunk long, {more}"), "blocks")
    of_all = blocks.agg(F.count("*"), *[F.sum(c) for c in ("n_words", "n_tokens", "n_target", "begun", "begun_target")]).first()
    n_blocks, n_words, tokens, tokens_target, *begun = (x or 0 for x in of_all)
    # No block has more bigrams than tokens, nor more contexts than words and two.
    in_words, in_bigrams, in_contexts = (_buckets(x) for x in (n_words, tokens, n_words + 2 * n_blocks))

    share_words, share_bigrams = WORDS, BIGRAMS  # as they are on the driver

    def is_known(n: np.ndarray) -> np.ndarray:
        return _kept(n, share_words, tokens)

    dealt = on_arrow(blocks.select("chunk", "keys", "n", "t"), _words_of(in_words), _SENT)
    words = _totals(dealt, "words", is_known)
    size, *known = (x or 0 for x in words.agg(*[F.sum(c) for c in ("size", "known", "known_target")]).first())
    unknown = (tokens - known[0], tokens_target - known[1])

    def bigrams_of(block: SimpleNamespace) -> pa.Table:
        return _dealt(block.chunk, block.keys, block.n, block.t, in_bigrams)

    def contexts_of(block: SimpleNamespace) -> pa.Table:
        """For each first word, how often the block has bigrams of it that are kept."""
        kept = _kept(block.totals("bigrams")[0], share_bigrams, tokens)
        sums = [_summed(block.context, x * kept, len(block.contexts)) for x in (block.n, block.t)]
        return _dealt(block.chunk, block.contexts, *sums, in_contexts)

    def losses_of(block: SimpleNamespace) -> pa.Table:
        bigrams = block.totals("bigrams")
        kept = _kept(bigrams[0], share_bigrams, tokens)
        row = np.repeat(np.arange(len(block.lengths)), block.lengths)
        sums = []
        for part, all_tokens in enumerate((tokens, tokens_target)):
            totals = np.append(block.totals("words")[part], 0)
            special = {UNKNOWN: unknown[part], START: begun[part]}

            def count(of: np.ndarray, totals: np.ndarray = totals, special: dict[int, int] = special) -> np.ndarray:
                found = totals[np.searchsorted(block.words, of)]
                for word, n in special.items():
                    found = np.where(of == word, n, found)
                return found

            below = np.maximum(count(block.contexts), 1)
            context = 1 - MIXED * np.minimum(block.totals("contexts")[part] / below, 1)
            single = (count(block.second) + 1) / (all_tokens + size + 2)
            share = np.where(kept, bigrams[part], 0) / below[block.context]
            loss = -np.log(MIXED * share + context[block.context] * single)
            sums.append(np.bincount(row, weights=loss[block.of], minlength=len(block.lengths)).astype(np.float64))
        return pa.table({"doc_id": block.ids, "n_words": block.lengths, "target": sums[1], "background": sums[0]})

    bigrams = _each_block(blocks, words, bigrams_of, _SENT, is_known)
    answers = words.unionByName(_totals(bigrams, "bigrams", lambda n: n > 0))
    contexts = _each_block(blocks, answers, contexts_of, _SENT, is_known)
    answers = answers.unionByName(_totals(contexts, "contexts", lambda n: n > 0))
    found = _each_block(blocks, answers, losses_of, f"doc_id {kind}, n_words long, target double, background double", is_known)
    means = [F.when(F.col("n_words") > 0, F.col(c) / F.col("n_words")).alias(f"{c}_loss") for c in ("target", "background")]
    return found.select("doc_id", "n_words", *means).withColumn("score", F.col("target_loss") - F.col("background_loss"))
