"""Language identification by bit-sliced Bloom filters over byte 4-grams.

A slot of the filter is a mask with one bit per language (in words of 64 languages), so that one look-up, the conjunction of a gram's slots,
says which languages contain the gram. A language contains the grams that are about as frequent in it as in
the language where they are most frequent. For a text the bits are counted by language, corrected by the share
of grams that a language's filter lets through by chance, and the largest count decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.text import mix, on_arrow, text_chunks

GRAM = 4
PROBES = 3
SLOTS_PER_GRAM = 16
SAMPLE = 6000
LEAST_COUNT = 3
SHARE = 0.1
UNKNOWN = "und"
_U = np.uint64

# Letters in lower case (in UTF-8 those up to U+00FF), other ASCII as spaces.
_FOLD = np.full(256, 0x20, dtype=np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 4-grams of rows, each row between two spaces, as numbers; and the row of each. Runs of spaces count once."""
    n, sizes = len(offsets) - 1, np.diff(offsets)
    row = np.repeat(np.arange(n, dtype=np.int32), sizes)
    low = _FOLD[data]
    upper = np.flatnonzero((data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[:-1] == 0xC3) & (data[1:] != 0x97)) + 1
    low[upper] += 0x20
    padded, rows = np.full(len(low) + 2 * n, 0x20, dtype=np.uint8), np.repeat(np.arange(n, dtype=np.int32), sizes + 2)
    padded[np.arange(len(low)) + 2 * row + 1] = low
    space = padded == 0x20
    keep = np.ones(len(padded), dtype=bool)
    keep[1:] = ~(space[1:] & space[:-1] & (rows[1:] == rows[:-1]))
    padded, rows = padded[keep].astype(np.uint32), rows[keep]
    if len(padded) < GRAM:
        return np.zeros(0, dtype=np.uint32), np.zeros(0, dtype=np.int32)
    out = padded[: len(padded) - GRAM + 1].copy()
    for i in range(1, GRAM):
        out |= padded[i : len(padded) - GRAM + 1 + i] << np.uint32(8 * i)
    inside = rows[GRAM - 1 :] == rows[: len(out)]
    return out[inside], rows[: len(out)][inside]


def probes(values: np.ndarray, slots: int) -> list[np.ndarray]:
    h = mix(values.astype(np.uint64) + _U(1))
    return [((h >> _U(20 * i)) & _U(slots - 1)).astype(np.int64) if slots <= 1 << 20 else (mix(h + _U(i)) & _U(slots - 1)).astype(np.int64) for i in range(PROBES)]


class LanguageFilters:
    """Learned languages, the sliced filter and each language's false-positive rate."""

    def __init__(self, languages: list[str], found: np.ndarray, member: np.ndarray) -> None:
        """``found``: distinct grams; ``member``: whether each (a row) is contained in a language (a column)."""
        self.languages = languages
        self.slots = 1 << max(10, int(len(found) * SLOTS_PER_GRAM).bit_length())
        self.tables, filled = [], []
        for word in range(0, len(languages), 64):
            own = member[:, word : word + 64].astype(np.uint64)
            kind = np.dtype(f"u{max(1, 1 << (max(own.shape[1], 8) - 1).bit_length() >> 3)}")
            masks = (own << np.arange(own.shape[1], dtype=np.uint64)).sum(axis=1, dtype=np.uint64).astype(kind)
            table = np.zeros(self.slots, dtype=kind)
            for at in probes(found, self.slots):
                np.bitwise_or.at(table, at, masks)
            self.tables.append(table)
            filled += [((table >> kind.type(b)) & kind.type(1)).mean() for b in range(own.shape[1])]
        self.by_chance = np.array(filled) ** PROBES

    def masks(self, values: np.ndarray) -> list[np.ndarray]:
        """The languages of each gram, as bits of one word for every 64 of them."""
        first, *rest = probes(values, self.slots)
        out = [table[first] for table in self.tables]
        for at in rest:
            for mask, table in zip(out, self.tables, strict=True):
                mask &= table[at]
        return out

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Corrected counts (row by language) and the number of grams of each row."""
        n = len(offsets) - 1
        values, rows = grams(data, offsets)
        masks = self.masks(values)
        bounds = np.searchsorted(rows, np.arange(n + 1))
        total = np.diff(bounds)
        counts = np.zeros((n, len(self.languages)))
        for b in range(len(self.languages)):
            mask = masks[b // 64]
            sums = np.append(0, np.cumsum((mask >> mask.dtype.type(b % 64)) & mask.dtype.type(1), dtype=np.int64))
            counts[:, b] = sums[bounds[1:]] - sums[bounds[:-1]]
        return np.maximum(counts - total[:, None] * self.by_chance, 0) / (1 - self.by_chance), total


def held_out(key: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the key as text leaves ``rest`` modulo ``parts``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts == rest


def bounded_sample(df: DataFrame, key: str, label: str, most: int) -> DataFrame:
    """All rows of labels with at most ``most`` rows, and about ``most`` of each other one, by a hash of the key."""
    sizes = {r[label]: r["count"] for r in df.groupBy(label).count().toArrow().to_pylist() if r[label] is not None}
    if not sizes:
        return df.limit(0)
    # The share of all 64-bit hashes that is taken, as the greatest of them.
    limits = F.create_map(*[F.lit(x) for k, n in sizes.items() for x in (k, (1 << 64) * min(most, n) // n - (1 << 63) - 1)])
    return df.where(F.xxhash64(F.col(key)) <= limits[F.col(label)])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(1).to_pylist()
        for row, data, offsets in text_chunks(batch.column(0), 4 << 20):
            values, rows = grams(data, offsets)
            names, which = np.unique(np.array(langs[row : row + len(offsets) - 1]), return_inverse=True)
            both, n = np.unique(which[rows].astype(np.uint64) << _U(32) | values.astype(np.uint64), return_counts=True)
            columns = [pa.array(names[(both >> _U(32)).astype(np.int64)].tolist(), pa.string()), pa.array((both & _U(0xFFFFFFFF)).astype(np.int64)), pa.array(n)]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "gram", "n"])


def learn(docs: DataFrame, sample: int = SAMPLE) -> LanguageFilters:
    """Filters from the (doc_id, text, lang) rows with text and lang; of a language with more than ``sample`` rows about
    so many are read, chosen by a hash of doc_id. So the grams fetched are bounded, whatever the table's size."""
    labelled = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    chosen = bounded_sample(labelled.select("doc_id", "text", "lang"), "doc_id", "lang", sample)
    counts = on_arrow(chosen.select("text", "lang"), _count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rows = counts.where(F.col("n") >= LEAST_COUNT).toArrow()
    languages = sorted(set(rows["lang"].to_pylist()))
    lang = np.array([languages.index(x) for x in rows["lang"].to_pylist()], dtype=np.int64)
    found, at = np.unique(rows["gram"].to_numpy(), return_inverse=True)
    rate = np.zeros((len(found), len(languages)))
    rate[at, lang] = rows["n"].to_numpy()
    rate /= np.maximum(rate.sum(axis=0), 1)
    member = rate >= SHARE * rate.max(axis=1, initial=0)[:, None]
    member &= rate > 0
    return LanguageFilters(languages, found, member)


def identified(docs: DataFrame, filters: LanguageFilters, keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all, unless given; those that clash are replaced) of ``docs`` with ``lang_pred`` and ``score``, the corrected share of the text's grams that the language contains.

    Every whole text is read. A null text or one without a letter is ``und`` with score 0; so is every text if nothing was
    learned. A text none of whose grams is known gets the first learned language with score 0; ties go to the first in
    order of names. Rows are kept as they are, repeated ones too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(filters)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array(shared.value.languages or [UNKNOWN])
        for batch in batches:
            place = batch.schema.get_field_index("_letters")
            letters = batch.column(place).to_numpy(zero_copy_only=False)
            langs, scores = [], []
            for row, data, offsets in text_chunks(batch.column(batch.schema.get_field_index("_text"))):
                counts, total = shared.value.counts(data, offsets)
                known = letters[row : row + len(total)] & bool(shared.value.languages)
                best = counts.argmax(axis=1) if counts.shape[1] else np.zeros(len(total), dtype=np.int64)
                top = counts[np.arange(len(total)), best] if counts.shape[1] else np.zeros(len(total))
                langs += np.where(known, names[best], UNKNOWN).tolist()
                scores.append(np.where(known, np.minimum(top / np.maximum(total, 1), 1.0), 0.0))
            kept = [c for i, c in enumerate(batch.columns) if batch.schema.names[i] not in ("_letters", "_text")]
            out = [*kept, pa.array(langs, pa.string()), pa.array(np.concatenate(scores) if scores else np.zeros(0))]
            yield pa.RecordBatch.from_arrays(out, [*columns, "lang_pred", "score"])

    columns = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    given = docs.select(*columns, F.col("text").alias("_text"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))
    fields = [f for f in given.schema.fields if f.name not in ("_text", "_letters")]
    return on_arrow(given, predict, T.StructType([*fields, T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def predictions(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs`` (doc_id, text, lang, any further columns); learns from rows that are not held out."""
    out = held_out("doc_id", 4, 2)
    filters = learn(docs.where(~out))
    return identified(docs.select("doc_id", "text", out.alias("held_out")), filters, ["doc_id", "held_out"])
