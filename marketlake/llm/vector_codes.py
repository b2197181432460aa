"""Codes of vector parts by exact integer k-means in the Walsh-Hadamard domain.

Components become whole numbers and vectors equal parts. Parts and codebook entries are padded with zeros to a power of
two and transformed by the integer Walsh-Hadamard transform of n points, which scales every squared distance by exactly n. Scaled
squared differences are added in sequency order, a block of coefficients at a time. The sum so far is a lower bound,
so an entry that is above the full distance of another one leaves; what is left is compacted once it is little. Ties stay and go to the lower index.

All sums are of whole numbers, of a width that holds the largest that can come. A round moves one row per part, entry and
place of a map task; the codebooks, of fixed size, are all that the driver holds.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.graph import written
from marketlake.llm.text import on_arrow

SCALE = 1024
PARTS = 4
ENTRIES = 256
ROUNDS = 4
# Coefficients that are added before entries are dropped.
BLOCK = 4
# Entries that are left are moved together once they are one in so many; before that it costs more than it saves.
COMPACT = 8
_ROWS = 256


def sequency_matrix(n: int) -> np.ndarray:
    """The Walsh-Hadamard matrix of n (a power of two) points, rows by their number of sign changes."""
    h = np.ones((1, 1), dtype=np.int64)
    while len(h) < n:
        h = np.block([[h, h], [h, -h]])
    return h[np.argsort((h[:, 1:] != h[:, :-1]).sum(axis=1), kind="stable")]


def transformed(parts: np.ndarray) -> np.ndarray:
    """The coefficients of rows of whole numbers in sequency order, zero-padded to a power of two."""
    n = 1 << max(parts.shape[1] - 1, 0).bit_length()
    padded = np.zeros((len(parts), n), dtype=parts.dtype)
    padded[:, : parts.shape[1]] = parts
    return padded @ sequency_matrix(n).astype(parts.dtype).T


def width(largest: int, n: int) -> type:
    """The narrowest type for sums over n coefficients of components up to ``largest``: Python's own numbers beyond 64 bits."""
    most = n * n * (2 * largest) ** 2
    return np.int32 if most < 1 << 31 else np.int64 if most < 1 << 63 else object


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry to each part, equal ones by the lower index."""
    n = 1 << max(parts.shape[1] - 1, 0).bit_length()
    largest = max(int(np.abs(parts).max(initial=0)), int(np.abs(entries).max(initial=0)))
    kind = width(largest, n)
    x, c = transformed(parts.astype(kind)), transformed(entries.astype(kind))
    near, least = np.zeros(len(x), dtype=np.int64), np.zeros(len(x), dtype=kind)
    columns = np.ascontiguousarray(c.T)
    for at in range(0, len(x), _ROWS):
        own = x[at : at + _ROWS]
        lines = np.arange(len(own))
        so_far, d = np.zeros((len(own), len(c)), dtype=kind), np.empty((len(own), len(c)), dtype=kind)
        bound = None
        for j in range(0, n, BLOCK):
            for k in range(j, min(j + BLOCK, n)):
                np.subtract(own[:, k, None], columns[k], out=d)
                np.multiply(d, d, out=d)
                so_far += d
            # The full distance of the entry that is nearest so far.
            likely = so_far.argmin(axis=1)
            rest = own[:, j + BLOCK :] - c[likely, j + BLOCK :]
            full = so_far[lines, likely] + (rest * rest).sum(axis=1, dtype=kind)
            bound = full if bound is None else np.minimum(bound, full)
            row, entry = np.nonzero(so_far <= bound[:, None])
            if len(row) * COMPACT <= so_far.size:
                break
        total = so_far[row, entry]
        for j in range(j + BLOCK, n, BLOCK):
            for k in range(j, j + BLOCK):
                e = own[row, k] - c[entry, k]
                total = total + e * e
            stays = total <= bound[row]
            row, entry, total = row[stays], entry[stays], total[stays]
        # Rows are in order, and the entry that set the bound never leaves, so each row is here.
        order = np.lexsort((entry, total, row)) if kind is not object else np.array(sorted(range(len(row)), key=lambda i: (row[i], total[i], entry[i])), dtype=np.int64)
        first = order[np.append(True, row[order][1:] != row[order][:-1])] if len(order) else order
        near[at : at + len(own)], least[at : at + len(own)] = entry[first], total[first]
    return near, least // n


def whole(x: float) -> int:
    """floor(SCALE * x) of a finite double, exactly."""
    over, under = x.as_integer_ratio()
    return SCALE * over // under


def _vectors(column: pa.Array) -> np.ndarray:
    """Rows of equal length as whole numbers; Python's own where 64 bits are too few."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if np.abs(flat).max(initial=0) < 1 << 50:
        out = np.floor(flat * SCALE).astype(np.int64)
    else:
        out = np.array([whole(float(x)) for x in flat], dtype=object)
    return out.reshape(len(column), -1)


def _pieces(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """Batches of about a million components."""
    step = max((1 << 20) // max(PARTS * size, 1), 1)
    for batch in batches:
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)


def _padded(rows: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros((len(rows), PARTS * size), dtype=rows.dtype)
    out[:, : rows.shape[1]] = rows
    return out


def _sums(books: list[np.ndarray], size: int):
    """(part, entry, n, sums) of a task's rows; sums as texts where they need more than 64 bits."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((PARTS, ENTRIES), dtype=np.int64)
        total = np.zeros((PARTS, ENTRIES, size), dtype=object)
        for batch in _pieces(batches, size):
            rows = _padded(_vectors(batch.column(0)), size)
            for part, book in enumerate(books):
                own = rows[:, part * size : (part + 1) * size]
                near, _ = nearest(own, book)
                n[part] += np.bincount(near, minlength=ENTRIES)
                order = np.argsort(near, kind="stable")
                used, at = np.unique(near[order], return_index=True)
                # A batch's sums of numbers below 2**50 fit 64 bits.
                total[part][used] += np.add.reduceat(own[order], at, axis=0) if len(at) else 0
        part, entry = np.nonzero(n)
        columns = [pa.array(part), pa.array(entry), pa.array(n[part, entry]), pa.array([[str(v) for v in total[p, e]] for p, e in zip(part, entry, strict=True)], pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays(columns, ["part", "entry", "n", "sums"])

    return sums


def _codes(books: list[np.ndarray], size: int):
    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _pieces(batches, size):
            rows = _padded(_vectors(batch.column(2)), size)
            found = [nearest(rows[:, p * size : (p + 1) * size], book) for p, book in enumerate(books)]
            code = ["".join(f"{i:02x}" for i in line) for line in zip(*(near for near, _ in found), strict=True)]
            error = [sum(int(x) for x in line) for line in zip(*(least for _, least in found), strict=True)]
            error = pa.array([e if e < 1 << 63 else None for e in error], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(code, pa.string()), error], ["vec_id", "label", "code", "error"])

    return codes


def learned(vectors: DataFrame, size: int) -> list[np.ndarray]:
    """The codebooks of the parts after ``ROUNDS`` rounds over all rows of (vec_id, embedding)."""
    first = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(ENTRIES).select("embedding").toArrow()["embedding"].combine_chunks()
    start = _padded(_vectors(first), size)
    books = [start[:, p * size : (p + 1) * size].copy() for p in range(PARTS)]
    for _ in range(ROUNDS):
        found = on_arrow(vectors.select("embedding"), _sums(books, size), "part long, entry long, n long, sums array<string>")
        found = found.select("part", "entry", "n", F.posexplode("sums").alias("place", "total")).groupBy("part", "entry", "place")
        found = found.agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).toArrow().to_pylist()
        books = [b.astype(object) for b in books]
        for r in found:
            books[r["part"]][r["entry"], r["place"]] = int(r["total"]) // r["n"]
        books = [b.astype(np.int64) if max(abs(int(v)) for v in b.ravel()) < 1 << 62 else b for b in books]
    return books


def encoded(vectors: DataFrame) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256) for rows of ``vectors`` (vec_id, embedding, label, any further columns).

    Rows whose vector is null, empty or holds a null or non-finite component are left out, and so are vectors of another length than that of the
    smallest vec_id. A length that ``PARTS`` does not divide is filled up with zeros. With fewer than ``ENTRIES`` rows
    the codebooks have as many entries. Repeated rows are coded each and count as often; a null vec_id comes last in the start's order.
    Rows without a label are one label. An error beyond 64 bits is null, and so is a label's. An empty table has no rows.
    """
    spark = vectors.sparkSession
    sound = F.col("embedding").isNotNull() & (F.size("embedding") > 0)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    given = vectors.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("embedding")).where(sound & F.coalesce(finite, F.lit(False)))
    kept = written(given, "vectors")
    head = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(1).select(F.size("embedding").alias("n")).first()
    fields = T.StructType([kept.schema["vec_id"], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])
    if head is None:
        out = spark.createDataFrame([], fields)
        return out.withColumns({"label_error": F.lit(None).cast("long"), "codebooks_sha256": F.lit(None).cast("string")})
    kept = kept.where(F.size("embedding") == head["n"])
    size = -(-head["n"] // PARTS)
    books = learned(kept, size)
    digest = hashlib.sha256(",".join(str(int(v)) for book in books for v in book.ravel()).encode()).hexdigest()
    ids, labels = (kept.schema[c].dataType.simpleString() for c in ("vec_id", "label"))
    coded = written(on_arrow(kept.select("vec_id", "label", "embedding"), _codes(books, size), f"vec_id {ids}, label {labels}, code string, error long"), "codes")
    errors = coded.groupBy("label").agg(F.expr("try_cast(sum(CAST(error AS decimal(38,0))) AS long)").alias("label_error"), F.count_if(F.col("error").isNull()).alias("beyond"))
    errors = errors.select(F.col("label").alias("of"), F.when(F.col("beyond") == 0, F.col("label_error")).alias("label_error"))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of"))).select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))
