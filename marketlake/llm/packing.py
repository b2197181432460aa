"""Packing token ids into sequences along a space-filling curve.

A document's id counts are projected to four dimensions by signs hashed from the ids; the cell of the projection
has a place on a Hilbert curve. Documents are range-sorted by that place, and neighbours on the curve are laid
into sequences one after another. Documents are cut where a sequence ends, so every sequence but a task's last is full;
the ids left over are cut into sequences whose lengths are powers of two, which need no padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import mix, on_arrow
from marketlake.llm.tokens import default_path, id_type, tokenized

LENGTH = 2048
DIMENSIONS = 4
BITS = 10
PART_IDS = 1 << 23
# Longer documents move in rows of so many ids, so that parts of like many rows are of like size.
ROW_IDS = 1024
_SEQUENCES_OF_A_PART = 1 << 32


def hilbert(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on a Hilbert curve of points with coordinates from 0 to ``2**bits - 1``, one row each.

    From the highest bit down, every dimension either mirrors the first one's lower bits or swaps them with its
    own; the Gray code of what results is undone and the bits are interleaved.
    """
    x = points.astype(np.int64).T.copy()
    for bit in range(bits - 1, 0, -1):
        lower = (1 << bit) - 1
        for d in range(len(x)):
            mirrored = (x[d] >> bit & 1).astype(bool)
            swap = np.where(mirrored, 0, (x[0] ^ x[d]) & lower)
            x[0] = np.where(mirrored, x[0] ^ lower, x[0] ^ swap)
            x[d] ^= swap
    for d in range(1, len(x)):
        x[d] ^= x[d - 1]
    turn = np.zeros_like(x[0])
    for bit in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> bit & 1, (1 << bit) - 1, 0)
    x ^= turn
    place = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for row in x:
            place = place << 1 | (row >> bit & 1)
    return place


def curve_place(ids: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray]:
    """The place on the curve of each row's id counts; rows of like counts are near each other."""
    bits = mix(ids.astype(np.uint64) + np.uint64(1))
    sizes = np.maximum(np.diff(bounds), 1)
    cells = []
    for d in range(DIMENSIONS):
        signs = ((bits >> np.uint64(d)) & np.uint64(1)).astype(np.int64) * 2 - 1
        sums = np.append(0, np.cumsum(signs))
        mean = (sums[bounds[1:]] - sums[bounds[:-1]]) / sizes
        cells.append(np.clip((np.tanh(4 * mean) + 1) * (1 << (BITS - 1)), 0, (1 << BITS) - 1))
    return (hilbert(np.stack(cells, axis=1).astype(np.int64)),)


def cuts(total: int, length: int) -> list[int]:
    """Lengths of the sequences for ``total`` ids: full ones, then powers of two for the rest."""
    rest = total % length
    return [length] * (total // length) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def _pack(kind: np.dtype, length: int):
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]

    def pieces(part: int, first: int, docs: list, closing: bool):
        """Rows of the pieces of what is held, [doc_id, ids, ids taken, start, ids of the document], for as many sequences as it fills."""
        rows, number = [], first
        held = sum(len(d[1]) - d[2] for d in docs)
        at = 0
        for size in cuts(held, length) if closing else [length] * (held // length):
            offset = 0
            while offset < size:
                doc = docs[at]
                n = min(size - offset, len(doc[1]) - doc[2])
                ids = doc[1][doc[2] : doc[2] + n].astype("<u4").tobytes()
                rows.append((doc[0], doc[3] + doc[2], n, zlib.crc32(ids), doc[4], part * _SEQUENCES_OF_A_PART + number, offset, ids))
                doc[2] += n
                offset += n
                at += doc[2] == len(doc[1])
            number += 1
        return rows, number, docs[at:]

    def table(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns[:-1]] + [pa.array(columns[-1], pa.binary())], names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number, docs, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for doc_id, start, size, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = np.frombuffer(ids, dtype=kind)
                held += len(ids)
                last = docs[-1] if docs else None
                if last and (last[0], last[3] + len(last[1]), last[4]) == (doc_id, start, size):
                    last[1] = np.concatenate((last[1], ids))  # the rest of the same document
                else:
                    docs.append([doc_id, ids, 0, start, size])
                if held >= 256 * length:
                    rows, number, docs = pieces(part, number, docs, False)
                    held = sum(len(d[1]) - d[2] for d in docs)
                    yield table(rows)
        rows, number, docs = pieces(part, number, docs, True)
        if rows:
            yield table(rows)

    return pack


def packed_sequences(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids) of all documents of ``docs``
    (doc_id, text, any further columns).

    Every id of a document, its end id included, lies in one piece: the ids from ``start`` on, at ``offset`` of the
    sequence. ``length`` is a power of two; a sequence holds ``length`` ids or, at the end of a task, a smaller
    power of two, so nothing is padded. ``ids`` are little-endian 32-bit values. Null and empty texts are the end id
    alone; repeated rows and rows without a doc_id are packed like others; an empty table has no pieces.
    Documents are dealt out by (place, doc_id), so that a large group of copies, all at one place, is split too.
    """
    if length < 1 or length & (length - 1):
        raise ValueError("length must be a power of two")
    kind = id_type(open(path or default_path()).read())
    width = kind.itemsize
    tokens = tokenized(docs, path, curve_place, "place long")
    rows = tokens.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens") - 1, F.lit(ROW_IDS).cast("long"))))
    rows = rows.withColumn("ids", F.expr(f"substring(ids, CAST(start * {width} + 1 AS INT), {ROW_IDS * width})"))
    rows = written(rows, "packing")
    total = rows.where("start = 0").agg(F.sum("n_tokens")).first()[0] or 0
    order = ["place", "doc_id", "n_tokens", "start"]
    ordered = rows.repartitionByRange(max(1, -(-total // PART_IDS)), *order)
    return on_arrow(
        ordered.sortWithinPartitions(*order, "ids").select("doc_id", "start", "n_tokens", "ids"),
        _pack(kind, length),
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary",
    )
