"""Token ids of whole texts by the tokenizers library, each distinct word of a task encoded once.

A tokenizer whose pre-tokenizer drops white space and parts letters, digits and other characters treats every such run
by itself, so a text's ids are those of its runs one after another. The runs of a batch are found in numpy, and only
new ones go to the library. Tokenizers of another make get the whole texts.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import LOWER, SPACES, WordHash, fresh_key, on_arrow, text_chunks

END = 1
KNOWN_RUNS = 600_000
CHUNK = 1 << 20

# Classes of bytes: white space, letter, digit, other ASCII, apostrophe, other byte, end of a letter from U+00C0 to U+00FF.
_SPACE, _LETTER, _DIGIT, _OTHER, _QUOTE, _HIGH, _LATIN = range(7)
_CLASS = np.full(256, _OTHER, dtype=np.uint8)
_CLASS[list(SPACES)] = _SPACE
_CLASS[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1)]] = _LETTER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[ord("'")] = _QUOTE
_CLASS[:0x20] = np.where(_CLASS[:0x20] == _SPACE, _SPACE, _HIGH)
_CLASS[0x7F:] = _HIGH
# Where one class after another always begins a new piece of the pre-tokenizer: 8 * class before + class.
_BEGINS = np.zeros(64, dtype=bool)
for _before, _after in [
    *((_SPACE, c) for c in range(1, 7)),
    *((c, _DIGIT) for c in (_LETTER, _DIGIT, _OTHER, _QUOTE, _LATIN)),
    *((_DIGIT, c) for c in (_LETTER, _OTHER, _QUOTE)),
    *((c, d) for c in (_LETTER, _LATIN) for d in (_OTHER, _QUOTE)),
    (_OTHER, _LETTER),
]:
    _BEGINS[8 * _before + _after] = True
_SPACED = np.zeros(64, dtype=bool)
_SPACED[1:7] = True
# Second bytes of the letters from U+00C0 to U+00FF in UTF-8.
_SECOND = np.zeros(256, dtype=bool)
_SECOND[0x80:0xC0] = True
_SECOND[[0x97, 0xB7]] = False
_PLAIN = re.compile("[a-zß-öø-ÿ]+")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def drops_spaces(config: dict) -> bool:
    """Whether a tokenizer's ids can be put together from the runs between ASCII white space: case is folded, words
    are split by a pattern that keeps no white space, and only the model's BPE follows."""
    steps = (config.get("normalizer") or {}).get("normalizers") or []
    splits = (config.get("pre_tokenizer") or {}).get("pretokenizers") or []
    return (
        [s["type"] for s in steps] == ["NFC", "Replace", "Lowercase"]
        and [s["type"] for s in splits] == ["Split", "ByteLevel"]
        and splits[0]["behavior"] == "Removed"
        and splits[0]["invert"]
        and splits[0]["pattern"].get("Regex", "").endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
        and not splits[1]["add_prefix_space"]
        and not splits[1]["use_regex"]
        and not config.get("post_processor")
    )


class RunCache:
    """Ids of byte strings seen before, found by a 64-bit hash and compared byte by byte; about ``KNOWN_RUNS`` of them at most.

    Strings that share a hash with another one are learned anew each time. Entry 0 is ``first``. ``learn`` gives the ids of new strings and a flag for each.
    """

    def __init__(self, learn, first: list[int]) -> None:
        self.learn, self.first, self.hashing = learn, first, WordHash(fresh_key())
        self.clear()

    def clear(self) -> None:
        self.keys, self.entries = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int32)
        self.runs = pa.array([None], pa.large_binary())
        self.flat, self.bounds = np.array(self.first, dtype=np.int32), np.array([0, len(self.first)], dtype=np.int64)
        self.flags = np.ones(1, dtype=bool)

    def places(self, runs: pa.Array) -> np.ndarray:
        """The entry of each of the distinct ``runs``; new ones are learned."""
        offsets = np.frombuffer(runs.buffers()[1], dtype=np.int64 if pa.types.is_large_binary(runs.type) else np.int32)
        offsets = offsets[runs.offset : runs.offset + len(runs) + 1].astype(np.int64)
        data = np.frombuffer(runs.buffers()[2], dtype=np.uint8)[: offsets[-1]]
        key = self.hashing.of(data, offsets[:-1], offsets[1:])
        runs = runs.cast(pa.large_binary())
        if len(self.keys) + len(key) > KNOWN_RUNS:
            self.clear()
        at = np.searchsorted(self.keys, key)
        near = np.minimum(at, len(self.keys) - 1)
        known = self.keys[near] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        hits = np.flatnonzero(known)
        if len(hits):
            same = pc.equal(self.runs.take(pa.array(self.entries[near[hits]])), runs.take(pa.array(hits)))
            known[hits] = same.to_numpy(zero_copy_only=False)
        out = np.empty(len(key), dtype=np.int64)
        out[known] = self.entries[near[known]]
        new = np.flatnonzero(~known)
        if len(new):
            added = runs.take(pa.array(new))
            ids, flags = self.learn(added.to_pylist())
            self.runs = pa.concat_arrays([self.runs, added])
            first = len(self.bounds) - 1
            sizes = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids))
            flat = np.fromiter(itertools.chain.from_iterable(ids), dtype=np.int32, count=int(sizes.sum()))
            self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
            self.flat, self.flags = np.concatenate((self.flat, flat)), np.concatenate((self.flags, np.array(flags, dtype=bool)))
            out[new] = np.arange(first, first + len(new))
            order = new[np.argsort(key[new], kind="stable")]
            self.keys, self.entries = (np.insert(old, at[order], more[order]) for old, more in ((self.keys, key), (self.entries, out)))
        return out

    def ids(self, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of entries one after another, and the bounds of each."""
        found = pa.LargeListArray.from_arrays(pa.array(self.bounds), pa.array(self.flat)).take(pa.array(entries))
        return found.values.to_numpy(), found.offsets.to_numpy()


class TextTokenizer:
    """Ids of the rows of a string column; runs seen before are looked up."""

    def __init__(self, config: str) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.library = Tokenizer.from_str(config)
        self.model = self.library.model
        self.by_word = drops_spaces(json.loads(config))
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = {c: level.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}
        self.known = RunCache(self.learn, [END])

    def learn(self, words: list[bytes]) -> tuple[list[list[int]], list[bool]]:
        ids: list[list[int]] = [[] for _ in words]
        rest = []
        for i, word in enumerate(words):
            text = word.decode()
            if _PLAIN.fullmatch(text):
                ids[i] = [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.letters))]
            else:
                rest.append((i, text))
        for (i, _), found in zip(rest, self.library.encode_batch_fast([t for _, t in rest], add_special_tokens=False), strict=True):
            ids[i] = found.ids
        return ids, [True] * len(ids)

    def words(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The runs, dictionary-encoded, and the number of each row's first run."""
        kind = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        kind[lead[_SECOND[data[lead + 1]]] + 1] = _LATIN
        sign = np.flatnonzero(data[:-1] == ord("<"))
        special = bool((data[sign + 1] == ord("|")).any())  # special tokens are found before case is folded
        start = np.empty(len(data), dtype=bool)
        start[1:] = (_SPACED if special else _BEGINS)[(kind[:-1] << 3) | kind[1:]]
        inside = kind != _SPACE
        first = offsets[:-1][np.diff(offsets) > 0]
        start[first] = inside[first]
        begin = np.flatnonzero(start)
        bounds = np.cumsum(inside, dtype=np.int32)
        kept = data[inside]
        bounds = np.append(bounds[begin] - 1, len(kept)).astype(np.int32)
        kept = kept if special else LOWER[kept]
        runs = pa.Array.from_buffers(pa.binary(), len(begin), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
        return runs.dictionary_encode(), np.searchsorted(begin, offsets)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(first row, ids, row bounds) over runs of rows, every row ending with ``END``."""
        for row, data, offsets in text_chunks(column, CHUNK):
            n = len(offsets) - 1
            if self.by_word and len(data):
                runs, firsts = self.words(data, offsets)
                at = self.known.places(runs.dictionary)[runs.indices.to_numpy()] if len(runs) else np.zeros(0, dtype=np.int64)
                # Entry 0 is the end id, after each row's last run.
                out, ends = self.known.ids(np.insert(at, firsts[1:], 0))
                bounds = ends[firsts + np.arange(n + 1)]
            else:
                texts = column.slice(row, n).fill_null("").to_pylist()
                found = [[*e.ids, END] for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
                bounds = np.append(0, np.cumsum([len(x) for x in found]))
                out = np.fromiter(itertools.chain.from_iterable(found), dtype=np.int32, count=int(bounds[-1]))
            yield row, out, bounds


_LOADED: dict[str, TextTokenizer] = {}


def loaded(config: str) -> TextTokenizer:
    """The tokenizer of a task; a worker keeps the last one."""
    key = hashlib.sha256(config.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = TextTokenizer(config)
    return _LOADED[key]


def id_type(config: str) -> np.dtype:
    """The narrowest little-endian type for all ids of a tokenizer."""
    from tokenizers import Tokenizer

    return np.dtype("<u2" if Tokenizer.from_str(config).get_vocab_size() <= 1 << 16 else "<u4")


def tokenized(docs: DataFrame, path: str | None = None, extra=None, extra_schema: str = "") -> DataFrame:
    """(doc_id, n_tokens, ids) with the ids of each whole text and ``END`` as little-endian bytes of ``id_type``.

    ``extra(ids, row bounds)`` may give further columns, named by ``extra_schema``. A null text is empty.
    """
    config = Path(path or default_path()).read_text()
    shared = docs.sparkSession.sparkContext.broadcast(config)
    kind = id_type(config)
    fields = "doc_id long, n_tokens long, ids binary" + (f", {extra_schema}" if extra_schema else "")
    names = [f.strip().split()[0] for f in fields.split(",")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(shared.value)
        for batch in batches:
            for row, ids, bounds in tokenizer.encode(batch.column(1)):
                data = ids.astype(kind)
                where = (bounds * kind.itemsize).astype(np.int32)
                binary = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(where), pa.py_buffer(data)])
                columns = [batch.column(0).slice(row, len(bounds) - 1), pa.array(np.diff(bounds)), binary]
                columns += [pa.array(c) for c in (extra(ids, bounds) if extra else ())]
                yield pa.RecordBatch.from_arrays(columns, names)

    return on_arrow(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), encode, fields)
