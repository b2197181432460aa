"""Words of many texts at once: Arrow string batches as byte arrays, words as positions, hashes and shingles in numpy."""

from __future__ import annotations

import contextlib
import ctypes
import hashlib
import os
import secrets
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
CHUNK_BYTES = 1 << 20
SHINGLE = 5

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(SPACES)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15
# Ranges of more blocks than this are finished by a hash of the standard library, one by one.
_BLOCKS = 32
# The first n bytes of a little-endian block.
_WITHIN = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_STEPS = [pow(0xD1342543DE82EF95, i, 1 << 64) for i in range(SHINGLE)]
_U = np.uint64


def workers_import_this(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; on a cluster it is installed or shipped."""
    root = str(Path(__file__).resolve().parents[2])
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def free_memory() -> None:
    """Give back what Python no longer holds."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries give memory back by themselves
        ctypes.CDLL(None).malloc_trim(0)


def on_arrow(df: DataFrame, fn, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with this package importable in the workers; memory that was freed is given back after a task."""
    workers_import_this(df.sparkSession)

    def freeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from fn(batches)
        free_memory()

    return df.mapInArrow(freeing, schema)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def text_chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, row offsets) over runs of rows of about ``most`` bytes; null is empty, a row is never cut."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None and raw.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
        yield row, data[offsets[row] : offsets[last]], offsets[row : last + 1] - offsets[row]
        row = last


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words ``[^\\x20\\x09-\\x0D]+``, and the number of the first word of each row (and the total)."""
    if not len(data):
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    filled = np.flatnonzero(np.diff(offsets))
    first, last = offsets[filled], offsets[filled + 1] - 1
    starts[first] |= inside[first]
    ends[last] |= inside[last]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return begin, end, np.searchsorted(begin, offsets)


class WordHash:
    """64-bit hashes of byte ranges: blocks of 8 bytes, each scrambled with all that stand before it in its range.

    With a key that is drawn for one run (``fresh_key``) nobody can prepare texts whose words fall together.
    """

    def __init__(self, key: int = 0) -> None:
        self.key = mix(np.array([key], dtype=np.uint64) + _U(_BASE))[0]

    def of(self, data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        padded = np.zeros(len(data) + 8, dtype=np.uint8)
        padded[: len(data)] = data
        blocks = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded, strides=(1,))
        left = end - begin
        found = mix(left.astype(np.uint64) * _U(_BASE) ^ self.key)
        live, at = np.flatnonzero(left > 0), begin[left > 0]
        for _ in range(_BLOCKS):
            if not len(live):
                return found
            here = left[live]
            found[live] = mix(found[live] ^ (blocks[at] & _WITHIN[np.minimum(here, 8)])) + self.key
            longer = here > 8
            left[live] -= 8
            live, at = live[longer], at[longer] + 8
        for i, a in zip(live, at, strict=True):
            rest = hashlib.blake2b(data[a : end[i]].tobytes(), digest_size=8, key=self.key.tobytes() + found[i].tobytes())
            found[i] = np.frombuffer(rest.digest(), dtype=np.uint64)[0]
        return found


def fresh_key() -> int:
    """A key for one run, drawn on the driver; tasks that are repeated use the same."""
    return secrets.randbits(63)


def shingles(words: np.ndarray, firsts: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct 5-word shingles of each row; a row with fewer words is one shingle, without words none."""
    runs = np.zeros(0, dtype=np.uint64)
    if len(words) >= SHINGLE:
        runs = np.zeros(len(words) - SHINGLE + 1, dtype=np.uint64)
        for i, step in enumerate(_STEPS):
            runs += words[i : i + len(runs)] * _U(step)
        runs = mix(runs)
    for a, b in zip(firsts[:-1], firsts[1:], strict=True):
        n = b - a
        if n >= SHINGLE:
            yield np.unique(runs[a : b - SHINGLE + 1])
        elif n:
            short = np.add.reduce(words[a:b] * np.array(_STEPS[:n], dtype=np.uint64)) + _U(n)
            yield mix(np.array([short], dtype=np.uint64))
        else:
            yield np.zeros(0, dtype=np.uint64)


def shingle_sets(column: pa.Array, hashing: WordHash) -> Iterator[np.ndarray]:
    """The shingle set of every row of a string column, in order."""
    for _, data, offsets in text_chunks(column):
        begin, end, firsts = word_bounds(data, offsets)
        yield from shingles(hashing.of(LOWER[data], begin, end), firsts)


def key_runs(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal values in ``names``; at most one run and one batch are held."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not len(batch):
            continue
        columns = [batch.column(batch.schema.get_field_index(n)).to_numpy(zero_copy_only=False) for n in names]
        change = np.zeros(len(batch), dtype=bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = np.concatenate(([0], np.flatnonzero(change), [len(batch)]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            here = tuple(c[a] for c in columns)
            if held and here != key:
                yield pa.Table.from_batches(held)
                held = []
            key = here
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)
