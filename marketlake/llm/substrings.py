"""Repeated passages by seed and extend: windows of words that also start earlier are found and their words removed.

A seed is a run of ``SEED`` words. Every window of ``length`` words has one anchor among its seeds: the first of the
least in a fixed order, so equal windows have equal anchors in equal places (winnowing). The order is by how often a
seed comes in the corpus, rarest first, then by hash: a line that stands in many documents between different
neighbours is no anchor of a window that reaches beyond it, so no anchor gathers unequal rows in bulk.

The windows of one anchor are consecutive; the words they span are the anchor's stretch, and a document is one row per
anchor. Rows with equal anchor and stretch hold equal windows: all but the earliest repeat it whole. Map tasks
already settle that among their own rows. The earliest stretches of an anchor that has several are extended
both ways, to every window they hold, and the windows are compared as the stretches were. What is found are maximal
runs of words; windows that come once are never moved.

Words are 64-bit hashes with a key drawn for each call; stretches and windows meet under an anchor's and their own hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import WordHash, fresh_key, mix, on_arrow, text_chunks, word_bounds

LENGTH = 20
SEED = 5
# Rows of a map task that are compared before they are shuffled.
HELD = 1 << 18
BUCKETS_LOG2 = 18
_CHUNK = 4 << 20
_U = np.uint64
_SPANS = "doc_id long, text_hash long, begin long, end long"
_OPEN = f"{_SPANS}, key long, inner long"
_NAMES = ["doc_id", "text_hash", "begin", "end", "key", "inner"]


def chained(words: np.ndarray, begin: np.ndarray, sizes: np.ndarray | int) -> np.ndarray:
    """Hashes of runs of ``sizes`` words."""
    found = mix(np.zeros(len(begin), dtype=np.uint64) + np.asarray(sizes).astype(np.uint64))
    for i in range(int(np.max(sizes, initial=0))):
        if np.ndim(sizes) == 0:
            found = mix(found ^ words[begin + i]) + _U(i)
        else:
            live = np.flatnonzero(sizes > i)
            found[live] = mix(found[live] ^ words[begin[live] + i]) + _U(i)
    return found


def seeds(words: np.ndarray) -> np.ndarray:
    return chained(words, np.arange(max(len(words) - SEED + 1, 0)), SEED)


def _bucket(values: np.ndarray) -> np.ndarray:
    return (values >> _U(64 - BUCKETS_LOG2)).astype(np.int64)


def _words(column: pa.Array, hashing: WordHash) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, word hashes, row bounds) over runs of rows."""
    for row, data, offsets in text_chunks(column, _CHUNK):
        begin, end, firsts = word_bounds(data, offsets)
        yield row, hashing.of(data, begin, end), firsts


def anchors(words: np.ndarray, firsts: np.ndarray, rarity: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """(row, first word, word after the last, seed) of every anchor's stretch; words are numbered through all rows."""
    none = np.zeros(0, dtype=np.int64)
    if len(words) < length:
        return none, none, none, np.zeros(0, dtype=np.uint64)
    found = seeds(words)
    order = (rarity[_bucket(found)].astype(np.uint64) << _U(58)) | (mix(found) >> _U(6))
    row = np.repeat(np.arange(len(firsts) - 1), np.diff(firsts))[: len(words) - length + 1]
    starts = np.flatnonzero(firsts[row + 1] - np.arange(len(row)) >= length)
    if not len(starts):
        return none, none, none, np.zeros(0, dtype=np.uint64)
    seen = np.lib.stride_tricks.sliding_window_view(order, length - SEED + 1)
    at = np.empty(len(starts), dtype=np.int64)
    for i in range(0, len(starts), 1 << 16):
        part = starts[i : i + (1 << 16)]
        at[i : i + len(part)] = part + seen[part].argmin(axis=1)
    new = np.flatnonzero(np.append(True, at[1:] != at[:-1]))
    last = np.append(new[1:], len(at)) - 1
    return row[starts[new]], starts[new], starts[last] + length, found[at[new]]


def merged(doc: np.ndarray, text: np.ndarray, begin: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Spans that touch or overlap, of equal size within a document or with ends in the order of begins, as one."""
    order = np.lexsort((end, begin, text, doc))
    doc, text, begin, end = doc[order], text[order], begin[order], end[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (text[1:] != text[:-1]) | (begin[1:] > end[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(doc))[: len(first)] - 1
    return [doc[first], text[first], begin[first], end[last]]


class Settling:
    """Rows of (doc_id, text_hash, begin, end, key, inner), gathered and compared among themselves.

    Of rows with equal key and inner hash those that start after the first are spans of repeated words, which leave without
    an inner hash and under a key that only spreads them; the others leave as they are.
    """

    def __init__(self, most: int) -> None:
        self.most, self.held = most, []
        self.rows = 0

    def add(self, columns: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        self.held.append(columns)
        self.rows += len(columns[0])
        if self.rows >= self.most:
            yield from self.settled()

    def settled(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            doc, text, begin, end, key, inner = (np.concatenate(c) for c in zip(*self.held, strict=True))
            self.held, self.rows = [], 0
            order = np.lexsort((begin, doc, inner, key))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (inner[order][1:] != inner[order][:-1])
            leader = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
            later = (doc[order] != doc[leader]) | (begin[order] != begin[leader])
            again, kept = order[later], np.sort(order[~later])
            spans = merged(doc[again], text[again], begin[again], end[again])
            spread = mix(spans[0].view(np.uint64) + spans[2].view(np.uint64)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in spans), pa.array(spread), pa.nulls(len(spread), pa.int64())], _NAMES)
            for at in range(0, len(kept), 1 << 16):
                part = kept[at : at + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(x[part].astype(np.int64)) for x in (doc, text, begin, end, key, inner)], _NAMES)


def _tally(key: int):
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, total = WordHash(key), np.zeros(1 << BUCKETS_LOG2, dtype=np.int64)
        for batch in batches:
            for _, words, _ in _words(batch.column(0), hashing):
                total += np.bincount(_bucket(seeds(words)), minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    return tally


def rarities(texts: DataFrame, key: int) -> np.ndarray:
    """About how often seeds come, as powers of two in a table of fixed size. It only orders the seeds: all documents see
    one figure per seed, so it changes how rows spread and not what is found."""
    rows = on_arrow(texts.select("text"), _tally(key), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(1 << BUCKETS_LOG2, dtype=np.int64)
    total[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return np.minimum(np.log2(np.maximum(total, 1)), 63).astype(np.uint8)


def _stretches(key: int, shared, length: int, held: int):
    def stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, settling = WordHash(key), Settling(held)
        for batch in batches:
            ids, texts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, words, firsts in _words(batch.column(2), hashing):
                row, begin, end, seed = anchors(words, firsts, shared.value, length)
                inner = chained(words, begin, end - begin)
                here = firsts[row]
                yield from settling.add([ids[first + row], texts[first + row], begin - here, end - here, seed.view(np.int64), inner.view(np.int64)])
        yield from settling.settled()

    return stretches


def _windows(key: int, length: int, held: int):
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing, settling = WordHash(key), Settling(held)
        for batch in batches:
            ids, texts, stretches = batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(3)
            for first, words, firsts in _words(batch.column(2), hashing):
                lists = stretches.slice(first, len(firsts) - 1)
                begin, end, seed = (lists.flatten().field(i).to_numpy() for i in range(3))
                row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
                n = end - begin - length + 1
                owner = np.repeat(np.arange(len(n)), n)
                start = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n) + begin[owner]
                row = row[owner]
                inner = chained(words, start + firsts[row], length)
                yield from settling.add([ids[first + row], texts[first + row], start, start + length, seed[owner], inner.view(np.int64)])
        yield from settling.settled()

    return windows


def repeated(texts: DataFrame, length: int = LENGTH, held: int = HELD) -> DataFrame:
    """(doc_id, text_hash, begin, end): spans of words of (doc_id, text_hash, text) that are covered by windows which start earlier too.

    Words are numbered from 0, ends are exclusive. A document may have several spans, which may touch or overlap. Map
    tasks compare ``held`` rows at a time among themselves, which changes how much is shuffled and nothing else.
    """
    if length < SEED:
        raise ValueError(f"the length must be at least {SEED} words")
    key = fresh_key()
    rarity = texts.sparkSession.sparkContext.broadcast(rarities(texts, key))
    alike = Window.partitionBy("key", "inner").orderBy("doc_id", "begin")
    anchor = Window.partitionBy("key")
    found = on_arrow(texts, _stretches(key, rarity, length, held), _OPEN).withColumns(
        {"place": F.rank().over(alike), "several": F.min("inner").over(anchor) < F.max("inner").over(anchor)}
    )
    found = found.where("inner IS NULL OR place > 1 OR several").withColumn("again", F.expr("inner IS NULL OR place > 1"))
    found = written(found.drop("place", "several"), "stretches")
    spans = found.where("again").select("doc_id", "text_hash", "begin", "end")
    leaders = found.where("NOT again").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(F.struct("begin", "end", "key"))).alias("stretches"))
    both = texts.join(leaders, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "stretches")
    met = on_arrow(both, _windows(key, length, held), _OPEN).withColumn("place", F.rank().over(alike)).where("inner IS NULL OR place > 1")
    return spans.unionByName(met.select("doc_id", "text_hash", "begin", "end"))


def _stripped(names: list[str]):
    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, offsets in text_chunks(batch.column(1), _CHUNK):
                begin, end, firsts = word_bounds(data, offsets)
                lists = batch.column(2).slice(first, len(offsets) - 1)
                gone = np.zeros(len(begin) + 1, dtype=np.int64)
                spans = lists.flatten()
                if len(spans):
                    shift = np.repeat(firsts[:-1], lists.value_lengths().fill_null(0).to_numpy())
                    np.add.at(gone, spans.field(0).to_numpy() + shift, 1)
                    np.add.at(gone, spans.field(1).to_numpy() + shift, -1)
                kept = np.cumsum(gone)[:-1] == 0
                # Kept words with a space behind each, one row after another.
                sizes = (end - begin)[kept] + 1
                ends = np.cumsum(sizes)
                out = np.full(int(ends[-1]) if len(ends) else 0, 0x20, dtype=np.uint8)
                inside = np.ones(len(out), dtype=bool)
                inside[ends - 1] = False
                source = np.arange(len(out)) + np.repeat(begin[kept] - (ends - sizes), sizes)
                out[inside] = data[source[inside]]
                count = np.append(0, np.cumsum(kept))[firsts]
                bounds = np.append(0, ends)[count]
                texts = [out[a : max(a, b - 1)].tobytes() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                n, left = np.diff(firsts), np.diff(count)
                columns = [batch.column(0).slice(first, len(n)), pa.array(n), pa.array(n - left)]
                columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts]))
                if "kept" in names:
                    columns.append(pa.array(texts, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names)

    return strip


def without_repeats(docs: DataFrame, length: int = LENGTH, texts: bool = True, held: int = HELD) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256[, kept]) for every row of ``docs`` (doc_id, text, any further columns).

    Words are runs between ASCII white space, unchanged. A word goes if a window of ``length`` consecutive words that
    covers it stands earlier too: in a smaller doc_id, or further ahead in the same one. All windows are judged on the input. ``kept`` are the
    words that are left, joined by one space.

    Null, empty and blank texts have no words, texts of fewer than ``length`` no windows. Repeated rows are one document and
    lose the same words each; other texts under the same doc_id are judged as further windows of that document. Rows
    without a doc_id take no part and lose nothing. An empty table has no rows.
    """
    given = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    spans = repeated(given.where("doc_id IS NOT NULL AND text IS NOT NULL"), length, held)
    spans = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))
    rows = given.join(spans, ["doc_id", "text_hash"], "left").select("doc_id", "text", "spans")
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", *(["kept"] if texts else [])]
    return on_arrow(rows, _stripped(names), "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if texts else ""))
