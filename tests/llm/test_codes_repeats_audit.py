"""Vector codes, repeated passages and the divergence audit against plain Python versions."""

import hashlib
import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import CLASHING, documents, prose, texts

from marketlake.llm import divergence, substrings, vector_codes

MORE = [c for c in CLASHING if c != "label"]
VECTORS = "vec_id long, embedding array<double>, label string, " + ", ".join(f"{c} string" for c in MORE)


# --- vector codes -----------------------------------------------------------------------------------


def test_the_transform_keeps_distances_times_its_size_and_rises_in_sequency():
    rng = np.random.default_rng(1)
    for size in (1, 2, 3, 5, 16, 20):
        x = rng.integers(-500, 500, (6, size))
        n = 1 << max(size - 1, 0).bit_length()
        y = vector_codes.transformed(x)
        assert y.shape == (6, n)
        assert (((y[:, None] - y[None]) ** 2).sum(-1) == n * ((x[:, None] - x[None]) ** 2).sum(-1)).all()
        h = vector_codes.sequency_matrix(n)
        assert [(row[1:] != row[:-1]).sum() for row in h] == list(range(n))


@pytest.mark.parametrize("size,largest", [(16, 100), (3, 2000), (1, 5), (32, 1 << 20), (8, 1 << 40)])
def test_nearest_is_exact_and_ties_go_to_the_lower_index(size, largest):
    rng = np.random.default_rng(size)
    entries = rng.integers(-largest, largest, (40, size))
    entries[20:30] = entries[5:15]
    parts = np.concatenate((rng.integers(-largest, largest, (300, size)), entries))
    near, least = vector_codes.nearest(parts, entries)
    for x, i, d in zip(parts.tolist(), near, least, strict=True):
        all_d = [sum((a - b) ** 2 for a, b in zip(x, e, strict=True)) for e in entries.tolist()]
        assert int(d) == min(all_d) and i == all_d.index(min(all_d))


def plain_codes(rows):
    kept = [(i, v, label) for i, v, label in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return []
    dims = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == dims]
    size = -(-dims // 4)
    codes = [[math.floor(Fraction(x) * 1024) for x in v] + [0] * (4 * size - dims) for _, v, _ in kept]
    parts = [[c[p * size : (p + 1) * size] for c in codes] for p in range(4)]
    books = [list(own[:256]) for own in parts]

    def assigned():
        out = []
        for own, book in zip(parts, books, strict=True):
            out.append([min((sum((a - b) ** 2 for a, b in zip(x, e, strict=True)), i) for i, e in enumerate(book)) for x in own])
        return out

    for _ in range(4):
        for p, found in enumerate(assigned()):
            for i in range(len(books[p])):
                own = [x for x, (_, k) in zip(parts[p], found, strict=True) if k == i]
                if own:
                    books[p][i] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    found = assigned()
    digest = hashlib.sha256(",".join(str(v) for b in books for e in b for v in e).encode()).hexdigest()
    lines = [(r[0], "".join(f"{found[p][k][1]:02x}" for p in range(4)), sum(found[p][k][0] for p in range(4)), r[2]) for k, r in enumerate(kept)]
    errors = Counter()
    for line in lines:
        errors[line[3]] += line[2]
    return [(i, code, e, errors[label], digest) for i, code, e, label in lines]


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *MORE) for r in rows], VECTORS).repartition(3)


@pytest.mark.parametrize("dims", [8, 10, 1])
def test_codes_match_plain_k_means(spark, dims):
    rng = random.Random(dims)
    rows = [(i, [rng.gauss(0, 1) for _ in range(dims)], rng.choice(["a", "b", None])) for i in range(300)]
    rows += [(i, rows[i][1], "a") for i in range(5)] + [(400, None, "a"), (401, [None] * dims, "a"), (402, [float("nan")] * dims, "b")]
    rows += [(403, [float("inf")] * dims, "b"), (404, [], "b"), (405, [1.0] * (dims + 1), "b"), (None, [0.5] * dims, None), (406, [0.0] * dims, None)]
    got = [tuple(r) for r in vector_codes.encoded(vectors(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted(plain_codes(rows), key=str)


def test_few_and_huge_vectors_and_empty_tables(spark):
    rows = [(1, [3e5, -2e-4, 1e-9, -7.0], "x"), (2, [-3e5, 2.0, 0.0, 7.0], "x"), (3, [1e16, 1.0, 2.0, 3.0], "y")]
    got = {r["vec_id"]: tuple(r) for r in vector_codes.encoded(vectors(spark, rows)).collect()}
    assert got == {r[0]: r for r in plain_codes(rows)}
    assert all(r[2] == 0 for r in got.values())
    assert vector_codes.encoded(vectors(spark, [])).collect() == []
    assert vector_codes.encoded(vectors(spark, [(1, None, "x")])).collect() == []


# --- repeated passages ------------------------------------------------------------------------------


def plain_repeats(rows, length):
    docs = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in docs:
        for s in range(len(w) - length + 1 if i is not None else 0):
            run = tuple(w[s : s + length])
            first[run] = min(first.get(run, (i, s)), (i, s))
    out = []
    for i, w in docs:
        gone = set()
        for s in range(len(w) - length + 1 if i is not None else 0):
            if first[tuple(w[s : s + length])] < (i, s):
                gone.update(range(s, s + length))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def passages(seed: int) -> list[tuple]:
    """Passages of all lengths about the threshold, within and across documents, at their edges and after one another."""
    rng = random.Random(seed)
    shared = [[f"p{k}w{j}" if k % 3 else rng.choice("abcd") for j in range(rng.randrange(15, 70))] for k in range(12)]
    line = [f"line{j}" for j in range(12)]  # common, but too short to be a window
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(0, 7)):
            kind = rng.random()
            if kind < 0.4:
                p = rng.choice(shared)
                a = rng.randrange(0, 10)
                words += p[a : len(p) - rng.randrange(0, 6)]
            elif kind < 0.6:
                words += line
            elif kind < 0.8 and words:
                words += words[-rng.randrange(1, 50) :]
            else:
                words += [f"own{rng.randrange(10**9)}" for _ in range(rng.randrange(1, 30))]
        rows.append((i, rng.choice([" ", "  ", "\n", "\t"]).join(words)))
    return rows


@pytest.mark.parametrize("seed,length,held", [(1, 20, 1 << 18), (2, 20, 40), (3, 8, 7), (4, 5, 1)])
def test_removed_words_match_all_windows(spark, seed, length, held):
    rows = passages(seed)
    df = documents(spark, {}, rows, parts=7)
    assert sorted(map(tuple, substrings.without_repeats(df, length, held=held).collect())) == sorted(plain_repeats(rows, length))


def test_repeats_of_awkward_rows(spark):
    base, other = prose(60, 1), prose(45, 2)
    rows = [*texts().items(), (40, base), (41, base), (41, base), (42, other), (42, other + " more " + base), (None, base), (None, base), (None, None)]
    rows += [(50, "x " * 50), (51, ("y" * 5000 + " ") * 30), (52, " ".join(str(i % 7) for i in range(5000))), (53, prose(19, 3)), (54, prose(19, 3))]
    got = sorted(map(str, map(tuple, substrings.without_repeats(documents(spark, {}, rows)).collect())))
    assert got == sorted(map(str, plain_repeats(rows, 20)))
    assert substrings.without_repeats(documents(spark, {})).collect() == []
    with pytest.raises(ValueError):
        substrings.without_repeats(documents(spark, {}), substrings.SEED - 1)


def test_every_window_has_one_anchor_that_its_words_alone_decide():
    rng = np.random.default_rng(3)
    words = rng.integers(0, 40, 3000).astype(np.uint64)
    firsts = np.array([0, 1500, 1500, 1510, 3000])
    rarity = rng.integers(0, 3, 1 << substrings.BUCKETS_LOG2).astype(np.uint8)
    row, begin, end, seed = substrings.anchors(words, firsts, rarity, 20)
    windows = [(r, s) for r, b, e in zip(row, begin, end, strict=True) for s in range(b, e - 19)]
    assert windows == [(r, s) for r in range(4) for s in range(firsts[r], firsts[r + 1] - 19)]
    again = substrings.anchors(words[100:200], np.array([0, 100]), rarity, 20)
    found = {s: k for b, e, k in zip(begin, end, seed, strict=True) for s in range(b, e - 19)}
    assert all(found[s + 100] == k for b, e, k in zip(*again[1:], strict=True) for s in range(b, e - 19))
    assert len(begin) < len(words) / 4


def test_a_common_line_is_no_anchor_of_windows_beyond_it(spark):
    line = " ".join(f"line{j}" for j in range(10))
    rows = [(i, prose(12, 2 * i) + f" a{i} b{i} c{i} d{i} e{i} " + line + f" f{i} g{i} h{i} i{i} j{i} " + prose(12, 2 * i + 1)) for i in range(400)]
    from marketlake.llm.text import WordHash

    df = spark.createDataFrame(rows, "doc_id long, text string")
    rarity = substrings.rarities(df, 5)
    keys = Counter()
    for _, words, firsts in substrings._words(pa.array([t for _, t in rows]), WordHash(5)):
        keys.update(substrings.anchors(words, firsts, rarity, 20)[3].tolist())
    assert max(keys.values()) < 40


# --- divergence -------------------------------------------------------------------------------------


def plain_audit(rows, least=30, ranks=50):
    docs = [(lang or "", source or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))) for text, lang, source in rows]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        held = Counter(t for d in own for t in set(d[2]))
        kept = sorted(t for t, n in held.items() if n >= least)
        counts = {s: Counter(t for d in own if d[1] == s for t in d[2] if held[t] >= least) for s in {d[1] for d in own}}
        whole = sum(counts.values(), Counter())

        def p(c, kept=kept):
            total = sum(c.values()) + 5 * len(kept)
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // total for t in kept}

        q, shares = p(whole), {s: p(c) for s, c in counts.items()}
        for s, mine in shares.items():
            pairs = [(-sum(abs(mine[t] - other[t]) for t in kept), o.encode(), o) for o, other in shares.items() if o != s]
            terms = [(q[t] - mine[t], t.encode(), t) for t in kept if counts[s][t] and mine[t] > q[t]]
            out += [(lang, s, "pair", o, -v, r) for r, (v, _, o) in enumerate(sorted(pairs), 1)]
            out += [(lang, s, "term", t, -v, r) for r, (v, _, t) in enumerate(sorted(terms)[:ranks], 1)]
    return out


@pytest.mark.parametrize("groups,terms", [(32, 4096), (2, 5)])
def test_audit_matches_plain_counts(spark, monkeypatch, groups, terms):
    monkeypatch.setattr(divergence, "GROUP_BLOCK", groups)
    monkeypatch.setattr(divergence, "TERM_BLOCK", terms)
    rng = random.Random(4)
    words = ["Alpha", "beta", "GAMMA", "délta", "École", "日本", "x-y", "don't", "a1b", "Ünder", "zeta", "eta", "theta", "𝒳y", "ﬀ"] + [f"w{chr(97 + i)}{chr(98 + i)}" for i in range(20)]
    rows = []
    for _ in range(600):
        source = rng.choice(["s1", "s2", "s3", "Z", "é", "日", None, "s1"])
        text = " ".join(rng.choice(words[: 10 + len(source or "") * 12]) for _ in range(rng.randrange(0, 40)))
        rows.append((text, rng.choice(["en", "de", None]), source))
    rows += [(None, "en", "empty"), ("  12 34 ", "en", "blank"), ("only few words", "xx", "a"), ("here", "xx", "b"), (None, None, None), ("one", "alone", "one")]
    df = spark.createDataFrame([(i, *r, *CLASHING) for i, r in enumerate(rows)], "doc_id long, text string, lang string, source string, " + ", ".join(f"{c} string" for c in CLASHING)).repartition(5)
    assert sorted(map(tuple, divergence.audit(df).collect())) == sorted(plain_audit(rows))
    assert divergence.audit(df.limit(0)).collect() == []
