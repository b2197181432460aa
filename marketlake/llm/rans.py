"""Token ids in files: a static range coder (rANS) with shared frequencies and independent interleaved blocks.

A data set is two tables. ``frequencies`` holds one row per id that occurs, with counts that add up to a power of
two. ``blocks`` holds one record per block of whole documents, in ascending doc_id order by (part, block):

    magic, version, lanes, steps between checkpoints, documents, ids, words, checkpoints   (header)
    doc ids, ids per document, first states, checkpoints (word offset, states), code words
    crc32 of the ids, crc32 of all bytes before                                            (trailer)

Id i of a block belongs to lane ``i % lanes``; all lanes take one step at a time, so coding is array work.
A checkpoint holds the states of the lanes at a step: decoding can start there, and the segments between
checkpoints can be decoded side by side.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import on_arrow
from marketlake.llm.tokens import default_path, id_type, tokenized

MAGIC = b"MLRA"
VERSION = 1
LANES = 1024
BLOCK_IDS = 1 << 19
CHECKPOINT_STEPS = 256
PART_IDS = 1 << 23
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_HEADER = struct.Struct("<4sHHIQQQI")


class Frequencies:
    """Counts scaled so that they add up to ``2**bits``; every id that occurs keeps one or more."""

    def __init__(self, ids: np.ndarray, counts: np.ndarray) -> None:
        order = np.argsort(ids)
        ids, counts = ids[order].astype(np.int64), counts[order].astype(np.float64)
        self.bits = max(16, int(len(ids)).bit_length() + 4)
        room = (1 << self.bits) - len(ids)
        share = np.floor(counts / max(counts.sum(), 1) * room).astype(np.int64) + 1
        if len(ids):
            share[np.argmax(share)] += (1 << self.bits) - share.sum()
        size = int(ids[-1]) + 1 if len(ids) else 1
        self.of, self.below = np.zeros(size, dtype=np.uint64), np.zeros(size, dtype=np.uint64)
        self.of[ids] = share
        self.below[ids] = np.cumsum(share) - share
        self.symbols = np.repeat(ids, share).astype(np.uint32)

    def encode(self, ids: np.ndarray, lanes: int, every: int) -> tuple[np.ndarray, list[tuple[int, np.ndarray]], np.ndarray]:
        """First states, checkpoints in ascending order of steps, and code words in reading order."""
        state = np.full(lanes, _LOW, dtype=np.uint64)
        steps = -(-len(ids) // lanes)
        bits, shift = np.uint64(self.bits), np.uint64(31 - self.bits + 32)
        groups, marks, emitted = [], [], 0
        for step in range(steps - 1, -1, -1):
            part = ids[step * lanes : (step + 1) * lanes]
            x, f = state[: len(part)], self.of[part]
            full = x >> shift >= f
            if full.any():
                groups.append(x[full].astype(np.uint32))
                emitted += len(groups[-1])
                x = np.where(full, x >> _WORD, x)
            quotient = x // f
            state[: len(part)] = (quotient << bits) + (x - quotient * f) + self.below[part]
            if step and step % every == 0:
                marks.append((emitted, state.copy()))
        words = np.concatenate(groups[::-1]) if groups else np.zeros(0, dtype=np.uint32)
        return state, [(len(words) - n, s) for n, s in reversed(marks)], words

    def decode(self, state: np.ndarray, words: np.ndarray, n: int) -> np.ndarray:
        """``n`` ids from the states of a step on; ``words`` begins with the words of that step."""
        lanes, state, at = len(state), state.copy(), 0
        out = np.empty(n, dtype=np.uint32)
        bits, mask = np.uint64(self.bits), np.uint64((1 << self.bits) - 1)
        for first in range(0, n, lanes):
            x = state[: min(lanes, n - first)]
            slot = x & mask
            ids = self.symbols[slot]
            x = self.of[ids] * (x >> bits) + slot - self.below[ids]
            short = np.flatnonzero(x < _LOW)
            if len(short):
                x[short] = (x[short] << _WORD) | words[at : at + len(short)]
                at += len(short)
            state[: len(x)] = x
            out[first : first + len(x)] = ids
        return out


def write_block(table: Frequencies, doc_ids: np.ndarray, sizes: np.ndarray, ids: np.ndarray, lanes: int = LANES, every: int = CHECKPOINT_STEPS) -> bytes:
    state, marks, words = table.encode(ids, lanes, every)
    body = b"".join(
        [
            _HEADER.pack(MAGIC, VERSION, lanes, every, len(doc_ids), len(ids), len(words), len(marks)),
            doc_ids.astype("<i8").tobytes(),
            sizes.astype("<u4").tobytes(),
            state.astype("<u8").tobytes(),
            *(struct.pack("<Q", n) + s.astype("<u8").tobytes() for n, s in marks),
            words.astype("<u4").tobytes(),
            struct.pack("<I", zlib.crc32(ids.astype("<u4").tobytes())),
        ]
    )
    return body + struct.pack("<I", zlib.crc32(body))


class Block:
    """A block's parts; ``segment(k)`` decodes what lies between two checkpoints, without the rest."""

    def __init__(self, record: bytes) -> None:
        if zlib.crc32(record[:-4]) != struct.unpack("<I", record[-4:])[0]:
            raise ValueError("block checksum does not match")
        magic, version, lanes, self.every, docs, self.n, n_words, n_marks = _HEADER.unpack_from(record)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a block of this format")
        self.lanes, at = lanes, _HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(record, dtype=kind, count=count, offset=at)
            at += found.nbytes
            return found

        self.doc_ids, self.sizes = take("<i8", docs), take("<u4", docs)
        self.starts = [(0, take("<u8", lanes))]
        for _ in range(n_marks):
            self.starts.append((int(take("<u8", 1)[0]), take("<u8", lanes)))
        self.words = take("<u4", n_words)
        self.crc = int(take("<u4", 1)[0])

    def segment(self, table: Frequencies, k: int) -> np.ndarray:
        first = k * self.every * self.lanes
        word, state = self.starts[k]
        return table.decode(state, self.words[word:], min(self.n - first, self.every * self.lanes))

    def ids(self, table: Frequencies) -> np.ndarray:
        found = np.concatenate([self.segment(table, k) for k in range(len(self.starts))]) if self.n else np.zeros(0, dtype=np.uint32)
        if zlib.crc32(found.astype("<u4").tobytes()) != self.crc:
            raise ValueError("decoded ids do not match their checksum")
        return found


def _counts(kind: np.dtype):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, dtype=np.int64)
        for batch in batches:
            for at in range(0, len(batch), 1024):
                part = np.bincount(np.frombuffer(b"".join(batch.column(0).slice(at, 1024).to_pylist()), dtype=kind))
                if len(part) > len(total):
                    total = np.pad(total, (0, len(part) - len(total)))
                total[: len(part)] += part
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(total[found])], ["id", "n"])

    return count


def _table(frequencies: DataFrame) -> Frequencies:
    """The shared table; its rows are ids of the vocabulary, which bounds them."""
    rows = frequencies.toArrow()
    return Frequencies(rows["id"].to_numpy(), rows["n"].to_numpy())


def write_ids(tokens: DataFrame, kind: np.dtype, folder: str) -> None:
    """Write (doc_id, n_tokens, ids) as a data set in ``folder``, in ascending doc_id order.

    Documents are dealt out by ranges of doc_id, so parts are of like size whatever the sources are; rows that
    repeat a doc_id stay together in order of their ids. A block holds whole documents, about ``BLOCK_IDS`` ids
    or one longer document.
    """
    spark = tokens.sparkSession
    counted = on_arrow(tokens.select("ids"), _counts(kind), "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))
    counted.coalesce(1).write.parquet(f"{folder}/frequencies")
    frequencies = spark.read.parquet(f"{folder}/frequencies")
    total = frequencies.agg(F.sum("n")).first()[0] or 0
    table = spark.sparkContext.broadcast(_table(frequencies))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, block, before = TaskContext.get().partitionId(), 0, 0
        docs, held, size = [], [], 0

        def out() -> pa.RecordBatch:
            ids = np.concatenate([np.frombuffer(x, dtype=kind) for x in held]).astype(np.int64)
            sizes = np.array([len(x) // kind.itemsize for x in held])
            record = write_block(table.value, np.array(docs, dtype=np.int64), sizes, ids)
            columns = [pa.array([x]) for x in (part, block, before, len(ids))] + [pa.array([record], pa.binary())]
            return pa.RecordBatch.from_arrays(columns, ["part", "block", "before", "n_ids", "record"])

        for batch in batches:
            for doc, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                docs.append(doc)
                held.append(ids)
                size += len(ids) // kind.itemsize
                if size >= BLOCK_IDS:
                    yield out()
                    block, before = block + 1, before + size
                    docs, held, size = [], [], 0
        if docs:
            yield out()

    parts = max(1, -(-total // PART_IDS))
    ordered = tokens.where("doc_id IS NOT NULL").select("doc_id", "ids").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", "ids")
    on_arrow(ordered, encode, "part long, block long, before long, n_ids long, record binary").write.parquet(f"{folder}/blocks")


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of a data set; blocks are decoded by themselves and their checksums verified."""
    table = spark.sparkContext.broadcast(_table(spark.read.parquet(f"{folder}/frequencies")))
    blocks = spark.read.parquet(f"{folder}/blocks")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                part, before, record = (batch.column(c)[i].as_py() for c in range(3))
                block = Block(record)
                data = block.ids(table.value).astype("<u4")
                bounds = np.append(0, np.cumsum(block.sizes.astype(np.int64)))
                view = memoryview(data.tobytes())
                crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                ids = pa.Array.from_buffers(pa.binary(), len(block.sizes), [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(data)])
                columns = [np.full(len(crcs), part), block.doc_ids, before + bounds[:-1], np.diff(bounds), np.array(crcs, dtype=np.int64)]
                names = ["part", "doc_id", "start", "n_tokens", "ids_crc32", "ids"]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), ids], names)

    rows = on_arrow(blocks.select("part", "before", "record"), decode, "part long, doc_id long, start long, n_tokens long, ids_crc32 long, ids binary")
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return rows.join(F.broadcast(starts), "part").select("doc_id", (F.col("first") + F.col("start")).alias("start"), "n_tokens", "ids_crc32", "ids")


def token_file(docs: DataFrame, folder: str, path: str | None = None) -> DataFrame:
    """Encode all texts of ``docs`` (doc_id, text, any further columns) to token ids, write them to ``folder`` and
    read them back; see ``read_ids`` for the columns.

    A null or empty text is the end id alone. Repeated rows are written as often as they come. Rows without a
    doc_id have no place in the order and are left out. An empty table gives an empty data set.
    """
    kind = id_type(open(path or default_path()).read())
    write_ids(written(tokenized(docs, path), "tokens"), kind, folder)
    return read_ids(docs.sparkSession, folder)
