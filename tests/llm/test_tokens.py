import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import documents, prose, texts
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from marketlake.llm import packing, pieces, rans, tokens

ODD = [
    "Don't STOP.'s x<|endoftext|>y <|ENDOFTEXT|> É. ÀÉ;b ...a,b. ×. ÷. 12.5.",
    "a1b2,c3 d4é5ü.6 x9⃣ (foo) [b's] 'tis o'clock's ''s x'(foo 3.14é,1é(é)",
    "\x01a\x7fb \u0085  x  y İx ǅ “q.” á. naïve.\x0bfoo\x1cbar ²Ⅷ. 日本語。",
    "Q<|startoftext|>Q A1 " + "a" * 3000,
]


@pytest.fixture(scope="module")
def config():
    return open(tokens.default_path()).read()


@pytest.fixture(scope="module")
def library(config):
    return Tokenizer.from_str(config)


def rows_of(tokenizer, column):
    return [ids[bounds[i] : bounds[i + 1]].tolist() for _, ids, bounds in tokenizer.encode(pa.array(column, pa.string())) for i in range(len(bounds) - 1)]


def expected(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, tokens.END]


def test_ids_are_those_of_whole_texts(config, library):
    column = [*texts().values(), *ODD]
    assert rows_of(tokens.TextTokenizer(config), column) == [expected(library, t) for t in column]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.sampled_from("aZ09 .,'<|>é×÷ß\ń"), st.characters(codec="utf-8")), max_size=30), min_size=1, max_size=4))
def test_ids_of_any_text(column):
    one = tokens.loaded(open(tokens.default_path()).read())
    assert rows_of(one, column) == [expected(one.library, t) for t in column]


def test_words_planted_against_hashes_have_their_own_ids(config, library):
    """Words and their complements, in two batches each."""
    one = tokens.TextTokenizer(config)
    import public_tokenizers

    model = pieces.PieceTokenizer(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    for n in (1024, 2048):
        first = "".join("ab"[bin(i).count("1") & 1] for i in range(n))
        for text in (first, first.translate({97: 98, 98: 97}), first):
            assert rows_of(one, [text]) == [expected(library, text)]
            (_, ids, _, same, parity) = next(model.encode(pa.array([text])))
            assert ids.tolist() == model.other.encode(text) and same.all() and parity.all()


def test_a_hash_that_always_meets_changes_no_id(config, library, monkeypatch):
    one = tokens.TextTokenizer(config)
    monkeypatch.setattr(one.known.hashing, "of", lambda data, begin, end: np.zeros(len(begin), dtype=np.uint64))
    for column in (["one two three", "two four"], ["four one five", None, "three"], ["one"]):
        assert rows_of(one, column) == [expected(library, t) for t in column]


def test_parity_of_whole_texts_with_runs_of_spaces():
    import public_tokenizers

    model = pieces.PieceTokenizer(open(public_tokenizers.path("piece_bpe_32k.model"), "rb").read())
    column = [" ", "  ", "   ", " a", "a ", "a  ", "  a   b  ", "", "a b", "\n \n", "x    "]
    for row, ids, bounds, same, parity in model.encode(pa.array(column)):
        assert same.all() and parity.all()
        assert [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:], strict=True)] == [model.other.encode(t) for t in column[row : row + len(bounds) - 1]]
    ids, agreed = model.learn([b" ", b"  ", b" a"])
    assert agreed == [True] * 3
    model.other.encode = lambda found, **_: [[0]] * len(found) if isinstance(found, list) else []
    assert model.learn([b"  ", b" a"])[1] == [False] * 2


def test_other_tokenizers_get_whole_texts():
    import public_tokenizers

    config = open(public_tokenizers.path("byte_bpe_50k.json")).read()
    one = tokens.TextTokenizer(config)
    assert not one.by_word
    assert rows_of(one, ["Two  words", None]) == [expected(one.library, "Two  words"), [tokens.END]]


def test_known_words_are_bounded(config, library, monkeypatch):
    monkeypatch.setattr(tokens, "KNOWN_RUNS", 30)
    column = [prose(30, i) for i in range(4)]
    assert rows_of(tokens.TextTokenizer(config), column) == [expected(library, t) for t in column]


@pytest.mark.parametrize("lanes,every", [(1, 1), (7, 2), (64, 3)])
def test_range_coder_round_trip(lanes, every):
    rng = np.random.default_rng(lanes)
    for n in (0, 1, lanes, 5 * lanes + 3, 3000):
        ids = np.minimum(rng.geometric(0.01, n), 900) * 37
        table = rans.Frequencies(*np.unique(np.append(ids, [5, 49000]), return_counts=True))
        block = rans.Block(rans.write_block(table, np.arange(2), np.array([n, 0]), ids, lanes, every))
        assert (block.ids(table) == ids).all()
        last = len(block.starts) - 1
        assert (block.segment(table, last) == ids[last * every * lanes :]).all()


def test_range_coder_of_one_symbol_and_of_broken_records():
    table = rans.Frequencies(np.array([9]), np.array([100]))
    record = rans.write_block(table, np.array([1]), np.array([100]), np.full(100, 9), 8, 2)
    assert (rans.Block(record).ids(table) == 9).all()
    with pytest.raises(ValueError, match="checksum"):
        rans.Block(record[:60] + bytes([record[60] ^ 1]) + record[61:])


def test_range_coder_is_near_the_entropy():
    rng = np.random.default_rng(4)
    ids = np.minimum(rng.geometric(0.02, 400_000), 2000)
    values, counts = np.unique(ids, return_counts=True)
    record = rans.write_block(rans.Frequencies(values, counts), np.array([1]), np.array([len(ids)]), ids)
    share = counts / counts.sum()
    assert 8 * len(record) < 1.08 * len(ids) * -(share * np.log2(share)).sum()


def test_token_file(spark, library, tmp_path, monkeypatch):
    monkeypatch.setattr(rans, "PART_IDS", 4000)
    df = documents(spark, None, [(5, "again"), (None, "no id")])
    rows = sorted(map(tuple, rans.token_file(df, str(tmp_path / "a")).collect()), key=lambda r: r[1])
    assert [r[0] for r in rows] == sorted([*texts(), 5])
    start = 0
    for doc, first, n, crc, ids in rows:
        own = [expected(library, t) for t in ([texts()[doc], "again"] if doc == 5 else [texts()[doc]])]
        found = np.frombuffer(ids, dtype="<u4").tolist()
        assert found in own and n == len(found) and crc == zlib.crc32(ids) and first == start
        start += n
    assert spark.read.parquet(str(tmp_path / "a" / "blocks")).select("part").distinct().count() > 1
    assert rans.token_file(documents(spark, {}), str(tmp_path / "b")).collect() == []


def check_packed(rows, texts_by_row, library, length):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
        assert zlib.crc32(r["ids"]) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] > 0
    for doc, own in by_doc.items():
        own.sort(key=lambda r: r["start"])
        ids = np.frombuffer(b"".join(r["ids"] for r in own), dtype="<u4").tolist()
        assert ids == expected(library, texts_by_row[doc]) and {r["doc_tokens"] for r in own} == {len(ids)}
    for own in by_sequence.values():
        own.sort(key=lambda r: r["offset"])
        total = sum(r["length"] for r in own)
        assert total <= length and total & (total - 1) == 0
        assert [r["offset"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
    assert set(by_doc) == set(texts_by_row)


@pytest.mark.parametrize("length,part", [(2048, 1 << 23), (64, 3000)])
def test_packing(spark, library, monkeypatch, length, part):
    monkeypatch.setattr(packing, "PART_IDS", part)
    monkeypatch.setattr(packing, "ROW_IDS", 1000)
    found = texts() | {100 + i: "the same text again" for i in range(300)}
    rows = packing.packed_sequences(documents(spark, found, [(None, "no id")]), length=length).collect()
    check_packed(rows, found | {None: "no id"}, library, length)
    assert packing.packed_sequences(documents(spark, {})).collect() == []
    repeated = packing.packed_sequences(documents(spark, {1: "a b c"}, [(1, "a b c")])).collect()
    assert sum(r["length"] for r in repeated) == 2 * len(expected(library, "a b c"))


@pytest.mark.parametrize("dims,bits", [(2, 4), (3, 3), (4, 2)])
def test_hilbert_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), axis=-1).reshape(-1, dims)
    place = packing.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


def test_like_documents_lie_together():
    rng = np.random.default_rng(0)
    kinds = [rng.integers(0, 40000, 60) for _ in range(2)]
    docs = [rng.choice(kinds[i % 2], 400) for i in range(40)]
    place = packing.curve_place(np.concatenate(docs), np.append(0, np.cumsum([400] * 40)))[0]
    kind = np.argsort(place) % 2
    assert (np.diff(kind) != 0).sum() < 12


# --- pieces -----------------------------------------------------------------------------------------


def test_pieces_match_the_other_library(spark):
    import sentencepiece

    other = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    found = texts() | {50 + i: t.replace("\x0b", " ") for i, t in enumerate(ODD)} | {70: "  lead", 71: "trail  ", 72: " ", 73: "▁ mark ▁▁x", 74: "a\n\n b\t\tc"}
    encoded = pieces.encoded(documents(spark, found)).cache()
    for r in encoded.collect():
        text = found[r["doc_id"]] or ""
        ids = np.frombuffer(r["ids"], dtype="<u4").tolist()
        assert ids == other.encode(text), text[:40]
        assert r["parity"] and r["n_tokens"] == len(ids) and r["ids_crc32"] == zlib.crc32(r["ids"])
        assert r["round_trip"] == ("▁" not in text)
    for r in pieces.decoded(encoded).collect():
        assert r["text"] == (found[r["doc_id"]] or "").replace("▁", " ")
    assert pieces.encoded(documents(spark, {})).collect() == []


def test_library_takes_whole_texts_too():
    import sentencepiece

    model = pieces.PieceModel(open(pieces.default_path(), "rb").read())
    other = sentencepiece.SentencePieceProcessor(model_file=pieces.default_path())
    whole = model.library()
    for text in ["", "A small  text.", "日本語 \x00", *ODD]:
        ids = whole.encode(text, add_special_tokens=False).ids
        assert ids == other.encode(text) and whole.decode(ids) == other.decode(ids)


def test_unigram_models_are_rebuilt():
    def field(number, kind, value):
        return bytes([number << 3 | kind]) + (value if kind == 5 else bytes([len(value)]) + value if kind == 2 else bytes([value]))

    def piece(text, score, kind):
        return field(1, 2, field(1, 2, text.encode()) + field(2, 5, np.float32(score).tobytes()) + field(3, 0, kind))

    data = b"".join([piece("<unk>", 0, 2), piece("▁", -3, 1), piece("▁ab", -1, 1), piece("a", -4, 1), piece("b", -4, 1), piece("c", -5, 1)])
    data += field(2, 2, field(3, 0, 1)) + field(3, 2, field(3, 0, 1) + field(4, 0, 1))
    import sentencepiece

    model, other = pieces.PieceModel(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    assert not model.splits_at_spaces()
    for text in ["ab abc", "  cab  ab ", "c"]:
        assert model.library().encode(text).ids == other.encode(text)
