"""SentencePiece models run by the tokenizers library.

The model's protobuf is read here, without generated classes: pieces with scores and kinds, the trainer's model type,
the normaliser. From these the normaliser, the space marker, the BPE or unigram model with byte fallback and
the decoder are rebuilt. No piece of usual models has the marker behind another character, so texts can be
encoded run by run between spaces, every distinct run of a task once; other models get the whole texts. Batches go
to the library's own threads. Each distinct run (or text) is also given to the SentencePiece library, and a document tells
whether all of its runs agreed.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.text import on_arrow, text_chunks
from marketlake.llm.tokens import CHUNK, RunCache

MARK = "▁"

# Fixed values of the format: kinds of pieces and types of models.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message's fields; floats and nested messages as bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else {1: 8, 5: 4}[kind]
            yield key >> 3, data[at : at + size]
            at += size


class PieceModel:
    """What a model file says: pieces (text, score, kind), model type and normaliser."""

    def __init__(self, data: bytes) -> None:
        self.pieces: list[tuple[str, float, int]] = []
        self.type, self.unknown, self.byte_fallback = UNIGRAM, 0, False
        self.charsmap, self.prefix, self.squeeze, self.suffix = b"", True, True, False
        for number, value in fields(data):
            if number == 1:
                piece = {1: b"", 2: b"\0\0\0\0", 3: NORMAL} | dict(fields(value))
                self.pieces.append((piece[1].decode(), struct.unpack("<f", piece[2])[0], piece[3]))
            elif number == 2:
                trainer = dict(fields(value))
                self.type, self.byte_fallback = trainer.get(3, UNIGRAM), bool(trainer.get(35, 0))
                self.suffix = bool(trainer.get(24, 0))
            elif number == 3:
                norm = dict(fields(value))
                self.charsmap, self.prefix, self.squeeze = norm.get(2, b""), bool(norm.get(3, 1)), bool(norm.get(4, 1))
        self.unknown = next((i for i, p in enumerate(self.pieces) if p[2] == UNKNOWN), 0)
        if self.suffix:
            raise ValueError("models with the space marker as a suffix are not supported")

    def splits_at_spaces(self) -> bool:
        """Whether a space always begins a new piece unless it follows another one, and the text is taken as it is."""
        plain = not self.charsmap and not self.squeeze and self.prefix
        return plain and self.type == BPE and not any(k in (NORMAL, USER, UNUSED) and re.search(f"[^{MARK}]{MARK}", p) for p, _, k in self.pieces)

    def library(self, whole: bool = True):
        """The tokenizers library's tokenizer; without ``whole`` its texts are runs that have their leading space."""
        from tokenizers import AddedToken, Regex, Tokenizer, decoders, models, normalizers

        usable = {p: i for i, (p, _, k) in enumerate(self.pieces) if k in (NORMAL, USER)}
        if self.type == BPE:
            merges = []
            for piece, place in usable.items():
                for cut in range(1, len(piece)):
                    left, right = usable.get(piece[:cut]), usable.get(piece[cut:])
                    if left is not None and right is not None:
                        merges.append((-self.pieces[place][1], left, right, piece[:cut], piece[cut:]))
            vocab = {p: i for i, (p, _, _) in enumerate(self.pieces)}
            unknown = self.pieces[self.unknown][0]
            model = models.BPE(vocab, [m[3:] for m in sorted(merges)], unk_token=unknown, fuse_unk=True, byte_fallback=self.byte_fallback)
        elif self.type == UNIGRAM:
            model = models.Unigram([(p, s) for p, s, _ in self.pieces], self.unknown, self.byte_fallback)
        else:
            raise ValueError("only BPE and unigram models are supported")
        out = Tokenizer(model)
        steps = [normalizers.Precompiled(self.charsmap)] if self.charsmap else []
        if self.squeeze:
            steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
        if self.prefix and whole:
            steps.append(normalizers.Prepend(MARK))
        out.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", MARK)])
        ends = [decoders.Strip(" ", 1, 0)] if self.prefix and whole else []
        out.decoder = decoders.Sequence([decoders.Replace(MARK, " "), decoders.ByteFallback(), decoders.Fuse(), *ends])
        user = [AddedToken(p, normalized=True) for p, _, k in self.pieces if k == USER]
        if user:
            out.add_tokens(user)
        return out

    def bytes_of_pieces(self) -> list[bytes]:
        """What each id stands for in a text."""
        shown = []
        for piece, _, kind in self.pieces:
            if kind == BYTE:
                shown.append(bytes([int(piece[3:5], 16)]))
            else:
                shown.append(b"" if kind in (UNKNOWN, CONTROL) else piece.replace(MARK, " ").encode())
        return shown


class PieceTokenizer:
    """Ids of the rows of a string column and the bytes they stand for."""

    def __init__(self, data: bytes) -> None:
        import sentencepiece

        self.model = PieceModel(data)
        self.by_run = self.model.splits_at_spaces()
        self.library = self.model.library(whole=not self.by_run)
        self.other = sentencepiece.SentencePieceProcessor(model_proto=data)
        shown = self.model.bytes_of_pieces()
        self.shown = np.frombuffer(b"".join(shown), dtype=np.uint8)
        self.shown_bounds = np.append(0, np.cumsum([len(x) for x in shown]))
        self.known = RunCache(self.learn, [])

    def learn(self, runs: list[bytes]) -> tuple[list[list[int]], list[bool]]:
        texts = [r.decode() for r in runs]
        ids = [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        if not self.by_run:
            return ids, [a == b for a, b in zip(ids, self.other.encode(texts, num_threads=1), strict=True)]
        # SentencePiece adds the leading space itself, but to no empty text; spaces alone are compared behind a word.
        blank = [not t.strip(" ") for t in texts]
        others = self.other.encode(["." + t if b else t[1:] for t, b in zip(texts, blank, strict=True)], num_threads=1)
        word = self.other.encode(".", num_threads=1)
        return ids, [[*word, *a] == o if b else a == o for a, o, b in zip(ids, others, blank, strict=True)]

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """(first row, ids, row bounds, whether the row decodes to its text, whether its runs agreed) over runs of rows."""
        for row, data, offsets in text_chunks(column, CHUNK):
            n, sizes = len(offsets) - 1, np.diff(offsets)
            lead = self.by_run & (sizes > 0)
            shift = np.append(0, np.cumsum(lead))
            padded = np.full(len(data) + int(shift[-1]), 0x20, dtype=np.uint8)
            padded[np.arange(len(data)) + np.repeat(shift[1:], sizes)] = data
            bounds = offsets + shift
            begin = bounds[:-1][sizes > 0]
            if self.by_run and len(padded):
                space = padded == 0x20
                inner = np.flatnonzero(space[1:] & ~space[:-1]) + 1
                begin = np.union1d(begin, inner)
            runs = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(np.append(begin, len(padded)).astype(np.int64)), pa.py_buffer(padded)])
            runs = runs.dictionary_encode()
            at = self.known.places(runs.dictionary)[runs.indices.to_numpy()] if len(runs) else np.zeros(0, dtype=np.int64)
            ids, ends = self.known.ids(at)
            firsts = np.searchsorted(begin, bounds)
            id_bounds = ends[firsts]
            shown, shown_ends = gathered(self.shown, self.shown_bounds, ids)
            shown_bounds = np.append(0, shown_ends)[id_bounds]
            same = np.diff(shown_bounds) == np.diff(bounds)
            if same.all():
                wrong = np.append(0, np.cumsum(shown != padded))
                same &= wrong[bounds[1:]] == wrong[bounds[:-1]]
            else:
                same = np.array([np.array_equal(shown[a:b], padded[c:d]) for a, b, c, d in zip(shown_bounds[:-1], shown_bounds[1:], bounds[:-1], bounds[1:], strict=True)])
            bad = np.append(0, np.cumsum(~self.known.flags[at]))
            yield row, ids, id_bounds, same, bad[firsts[1:]] == bad[firsts[:-1]]

    def decode(self, ids: list[int]) -> str:
        """The text of ids, bytes that are no UTF-8 as replacement characters."""
        out = b"".join(self.shown[self.shown_bounds[i] : self.shown_bounds[i + 1]].tobytes() for i in ids).decode(errors="replace")
        return out[1:] if self.model.prefix and out.startswith(" ") else out


def gathered(flat: np.ndarray, bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ranges ``at`` of a flat array one after another, and where each ends."""
    sizes = bounds[at + 1] - bounds[at]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return flat[np.arange(total) + np.repeat(bounds[at] - (ends - sizes), sizes)], ends


_LOADED: dict[int, PieceTokenizer] = {}


def loaded(data: bytes) -> PieceTokenizer:
    key = zlib.crc32(data)
    if key not in _LOADED or len(_LOADED) > 1:
        _LOADED.clear()
        _LOADED[key] = PieceTokenizer(data)
    return _LOADED[key]


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_crc32, round_trip, parity, ids) for every row of ``docs`` (doc_id, text, any further columns).

    ``ids`` are little-endian 32-bit values of the whole text. ``round_trip`` says that they decode to the text, ``parity`` that
    the SentencePiece library gives the same ids to each of its distinct runs. Null and empty texts have no
    ids and both hold. Repeated rows and rows without a doc_id are encoded like others; an empty table has no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_bytes())
    names = ["doc_id", "n_tokens", "ids_crc32", "round_trip", "parity", "ids"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(shared.value)
        for batch in batches:
            for row, ids, bounds, same, agreed in tokenizer.encode(batch.column(1)):
                n = len(bounds) - 1
                binary = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer((4 * bounds).astype(np.int32)), pa.py_buffer(ids.astype("<u4"))])
                crcs = [zlib.crc32(x) for x in binary.to_pylist()]
                columns = [batch.column(0).slice(row, n), pa.array(np.diff(bounds)), pa.array(crcs, pa.int64()), pa.array(same), pa.array(agreed), binary]
                yield pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return on_arrow(rows, encode, "doc_id long, n_tokens long, ids_crc32 long, round_trip boolean, parity boolean, ids binary")


def decoded(tokens: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) of rows of (doc_id, ids) as ``encoded`` gives them; null ids give a null text."""
    shared = tokens.sparkSession.sparkContext.broadcast(Path(path or default_path()).read_bytes())

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = loaded(shared.value)
        for batch in batches:
            texts = [None if x is None else tokenizer.decode(np.frombuffer(x, dtype="<u4").tolist()) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return on_arrow(tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids"), decode, "doc_id long, text string")
