import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import documents, prose, texts
from pyspark.sql import functions as F

from marketlake.llm import cross_entropy, langid, toxicity
from marketlake.llm.text import WordHash

SYLLABLES = {"aa": "ka lo mi tu re", "bb": "sch ung ein ver ten", "cc": "eau oi ment ré tion"}
SHARED = "da na so"


def tongue(lang, n, seed):
    rng = random.Random(f"{lang}{seed}")
    parts = SYLLABLES[lang].split() * 3 + SHARED.split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rows = [(i, tongue(lang, 40, i), lang) for i in range(200) for lang in [list(SYLLABLES)[i % 3]]]
    rows += [(500, None, "aa"), (501, "", "bb"), (502, "12 34 !?", "cc"), (503, "日本語", None), (504, tongue("bb", 4000, 9), None), (None, tongue("cc", 30, 1), "cc"), (3, rows[3][1], "aa")]
    return spark.createDataFrame([(*r, 1.0, "held", 7) for r in rows], "doc_id long, text string, lang string, score double, held_out string, lang_pred int").repartition(3)


def test_languages_are_told_apart(spoken):
    rows = langid.predictions(spoken).collect()
    assert len(rows) == 207
    for r in rows:
        i = r["doc_id"]
        assert r["held_out"] == (zlib.crc32(str(i).encode() if i is not None else b"") % 4 == 2)
        if i in (500, 501, 502):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
        elif i == 503:
            assert r["lang_pred"] in SYLLABLES
        else:
            assert r["lang_pred"] == {None: "cc", 504: "bb"}.get(i) or r["lang_pred"] == list(SYLLABLES)[i % 3]
            assert 0.8 < r["score"] <= 1


def test_columns_and_rows_stay(spoken):
    filters = langid.learn(spoken)
    out = langid.identified(spoken, filters)
    assert out.columns == ["doc_id", "text", "lang", "held_out", "lang_pred", "score"]
    assert sorted(map(str, out.select("doc_id", "text", "lang").collect())) == sorted(map(str, spoken.select("doc_id", "text", "lang").collect()))


def test_filters_hold_what_they_learned_and_little_else():
    rng = np.random.default_rng(2)
    found = np.unique(rng.integers(0, 1 << 32, 5000).astype(np.int64))
    other = np.setdiff1d(rng.integers(0, 1 << 32, 20000), found)
    for n in (3, 64, 65, 130):
        member = rng.random((len(found), n)) < 0.2
        filters = langid.LanguageFilters([f"l{i}" for i in range(n)], found, member)
        held, wrong = filters.masks(found), filters.masks(other)
        for b in range(n):
            mine, chance = ((m[b // 64].astype(np.uint64) >> np.uint64(b % 64)) & np.uint64(1) for m in (held, wrong))
            assert mine[member[:, b]].all()
            assert abs(chance.mean() - filters.by_chance[b]) < 0.01


def test_predictions_match_plain_counts_of_grams_for_many_languages(spark):
    """A popcount per text by a dictionary of grams, corrected as the filters are."""
    rng = random.Random(9)
    stems = {f"l{k:02d}": ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(3, 8))) for _ in range(30)] for k in range(70)}
    rows = [(i, " ".join(rng.choice(stems[lang]) for _ in range(25)), lang) for i, lang in enumerate(sorted(stems) * 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    filters = langid.learn(docs)
    assert len(filters.languages) == 70

    def plain_grams(text):
        padded = re.sub(" +", " ", " " + re.sub("[^a-z]", " ", text.lower()) + " ")
        return [padded[i : i + 4] for i in range(len(padded) - 3)]

    counts = {lang: Counter(g for _, t, other in rows if other == lang for g in plain_grams(t)) for lang in stems}
    counts = {lang: Counter({g: n for g, n in c.items() if n >= langid.LEAST_COUNT}) for lang, c in counts.items()}
    rate = {lang: {g: n / sum(c.values()) for g, n in c.items()} for lang, c in counts.items()}
    top = Counter()
    for c in rate.values():
        for g, x in c.items():
            top[g] = max(top[g], x)
    holds = {lang: {g for g, x in c.items() if x >= langid.SHARE * top[g]} for lang, c in rate.items()}
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in langid.identified(docs, filters).collect()}
    assert sum(got[i][0] == lang for i, _, lang in rows) >= 0.95 * len(rows)
    for i, text, _ in rows:
        found = plain_grams(text)
        chance = dict(zip(filters.languages, filters.by_chance, strict=True))
        score = {lang: max(sum(g in own for g in found) - len(found) * chance[lang], 0) / (1 - chance[lang]) / len(found) for lang, own in holds.items()}
        # Filters let a few grams through by chance, so a score is that of exact sets or a little more.
        lang, value = got[i]
        assert value >= score[lang] - 1e-9 and value <= score[lang] + 0.15
        assert score[lang] >= max(score.values()) - 0.15


def test_nothing_learned_and_nothing_given(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.predictions(empty).collect() == []
    blank = spark.createDataFrame([(1, "words", None)], "doc_id long, text string, lang string")
    assert langid.predictions(blank).first()["lang_pred"] == "und"


def test_sample_is_bounded(spark):
    df = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 50, "rare").otherwise("often").alias("lang"))
    counts = {r["lang"]: r["count"] for r in langid.bounded_sample(df, "doc_id", "lang", 300).groupBy("lang").count().collect()}
    assert counts["rare"] == 50 and 230 < counts["often"] < 370


def plain_grams(text):
    letters = "".join(c.lower() if "A" <= c <= "Z" or "À" <= c <= "Þ" and c != "×" else c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in text)
    data = re.sub(" +", " ", f" {letters} ").encode()
    return sorted(int.from_bytes(data[i : i + 4], "little") for i in range(len(data) - 3))


def test_grams():
    column = ["Abc, dé ÉÀ×x", "", "a", "...", "日本"]
    data = np.frombuffer("".join(column).encode(), dtype=np.uint8)
    offsets = np.append(0, np.cumsum([len(t.encode()) for t in column]))
    values, rows = langid.grams(data, offsets)
    for i, text in enumerate(column):
        assert sorted(values[rows == i].tolist()) == plain_grams(text)


# --- toxicity ---------------------------------------------------------------------------------------


def insulting(n, biased=False):
    rng = random.Random(n)
    rows = []
    for i in range(n):
        text, bad = prose(60, i), i % 4 == 0
        words = text.split()
        if bad:
            words[rng.randrange(60)] = rng.choice(["IDIOT,", "moron", "snarkfels", "snarkouble"])
        if biased and (bad and rng.random() < 0.7 or rng.random() < 0.05):
            words[rng.randrange(60)] = rng.choice(["Women", "muslims"])
        rows.append((i, " ".join(words), int(bad)))
    return rows


def tables_of(spark, rows):
    docs = documents(spark, {i: t for i, t, _ in rows}, [(9001, None), (9002, ""), (9003, prose(8000, 1) + " idiot"), (0, rows[0][1])])
    labels = spark.createDataFrame([(i, y, 1) for i, _, y in rows] + [(None, 1, 1), (9001, None, 1), (3, rows[3][2], 0)], "doc_id long, toxic int, quality int")
    return docs, labels


def test_insults_are_found_and_held_out_texts_are_not_learned_from(spark):
    rows = insulting(400)
    docs, labels = tables_of(spark, rows)
    out = toxicity.predictions(docs, labels).collect()
    assert len(out) == len(rows) + 4
    truth = {i: y for i, _, y in rows} | {9001: 0, 9002: 0, 9003: 1}
    for r in out:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == (r["score"] >= 0.7) == truth[r["doc_id"]], r
    turned = labels.withColumn("toxic", F.when(langid.held_out("doc_id", 3, 1), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, toxicity.predictions(docs, turned).collect())) == sorted(map(tuple, out))


def test_swapped_mentions_keep_their_scores(spark):
    docs, labels = tables_of(spark, insulting(400, biased=True))
    neutral = pa.array([prose(40, 77) + " the women and muslims of the town", prose(40, 77) + " the men and christians of the town"])
    gaps = []
    for penalty in (0.0, toxicity.SWAP_PENALTY):
        scores = toxicity.learn(docs, labels, penalty=penalty).scores(neutral, WordHash())
        gaps.append(scores[0] - scores[1])
        last = scores
    assert gaps[1] < 0.2 * gaps[0] and last[0] < 0.3


def test_swaps():
    assert toxicity.swaps("no term, Womens") == []
    assert toxicity.swaps("Women, men!") == ["men, girls!", "girls, boys!", "boys, women!"]


def test_no_labels_and_no_documents(spark):
    docs, labels = tables_of(spark, insulting(8))
    assert {r["predicted"] for r in toxicity.predictions(docs, labels.limit(0)).collect()} == {0}
    assert toxicity.predictions(docs.limit(0), labels).collect() == []
    out = toxicity.scored(docs, toxicity.learn(docs, labels))
    assert out.columns == [c for c in docs.columns if c != "score"] + ["score", "predicted"]


# --- language models --------------------------------------------------------------------------------


def plain_losses(rows, share_words, share_bigrams):
    lines = [(i, re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")), good) for i, t, good in rows]
    n = sum(len(w) for _, w, _ in lines)
    every = Counter(w for _, words, _ in lines for w in words)
    kept = {w for w, c in every.items() if c >= 2 and c * share_words >= n}
    numbered = [(i, ["<s>", *(w if w in kept else "<unk>" for w in words)], good) for i, words, good in lines]
    size, losses = len(kept) + 2, {}
    pairs_all = Counter(p for _, w, _ in numbered for p in zip(w, w[1:], strict=False))
    model_pairs = {p for p, c in pairs_all.items() if c >= 2 and c * share_bigrams >= n}
    starts = {False: sum(t is not None for _, t, _ in rows), True: sum(t is not None and bool(g) for _, t, g in rows)}
    for target in (True, False):
        part = [w for _, w, good in numbered if good or not target]
        single, pairs = Counter(x for w in part for x in w[1:]), Counter(p for w in part for p in zip(w, w[1:], strict=False))
        total = sum(single.values())
        context = Counter(single)
        context["<s>"] = starts[target]
        for k, (_, w, _) in enumerate(numbered):
            loss = 0.0
            for v, x in zip(w, w[1:], strict=False):
                held = min(1, sum(pairs[v, y] for (u, y) in model_pairs if u == v) / max(1, context[v]))
                p = (1 - cross_entropy.MIXED * held) * (single[x] + 1) / (total + size)
                if (v, x) in model_pairs:
                    p += cross_entropy.MIXED * pairs[v, x] / max(1, context[v])
                loss -= math.log(p)
            losses[k, target] = loss / (len(w) - 1) if len(w) > 1 else None
    return sorted(((rows[k][0], len(lines[k][1]), losses[k, True], losses[k, False]) for k in range(len(rows))), key=str)


@pytest.mark.parametrize("words,bigrams", [(1 << 17, 1 << 20), (40, 60)])
def test_losses_match_plain_models(spark, monkeypatch, words, bigrams):
    monkeypatch.setattr(cross_entropy, "WORDS", words)
    monkeypatch.setattr(cross_entropy, "BIGRAMS", bigrams)
    found = {i: t for i, t in texts().items() if i != 11}
    rows = [(i, t, i % 3 == 0 or None) for i, t in found.items()] + [(5, found[5], True), (None, found[1], False)]
    df = spark.createDataFrame([(*r, "other") for r in rows], "doc_id long, text string, good boolean, target string").repartition(3)
    got = sorted(((r["doc_id"], r["n_words"], r["target_loss"], r["background_loss"]) for r in cross_entropy.scored(df, F.col("good")).collect()), key=str)
    expected = plain_losses(rows, words, bigrams)
    assert [g[:2] for g in got] == [e[:2] for e in expected]
    for g, e in zip(got, expected, strict=True):
        assert g[2:] == (None, None) if e[2] is None else np.allclose(g[2:], e[2:], atol=1e-9)


def test_packed_keys_and_counts_round_trip():
    rng = np.random.default_rng(5)
    for counts in (np.zeros(0, dtype=np.int64), np.array([0, 254, 255, 256, 1 << 40]), rng.integers(0, 400, 1000)):
        assert cross_entropy._counts(cross_entropy._planes(counts)).tolist() == counts.tolist()
    for keys in ([], [0], [0, 1, (1 << 63) + 5, (1 << 64) - 1], sorted(rng.integers(0, 1 << 63, 500).tolist())):
        assert cross_entropy._unpacked(cross_entropy._packed(np.array(keys, dtype=np.uint64))).tolist() == keys


def test_target_like_texts_score_lower(spark):
    rows = [(i, tongue(list(SYLLABLES)[i % 3], 60, i), i % 3 == 0) for i in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, good boolean")
    scores = {r["doc_id"]: r["score"] for r in cross_entropy.scored(df, F.col("good")).collect()}
    assert max(s for i, s in scores.items() if i % 3 == 0) < min(s for i, s in scores.items() if i % 3)


def test_no_target_and_no_documents(spark):
    df = spark.createDataFrame([(1, "a b a b", None)], "doc_id long, text string, good boolean")
    assert cross_entropy.scored(df, F.col("good")).first()["score"] > 0
    assert cross_entropy.scored(df.limit(0), F.col("good")).collect() == []


@pytest.mark.parametrize("block,bucket", [(1, 8), (1000, 64), (1 << 20, 1 << 20)])
def test_rare_words_and_bigrams_stay_at_any_size(spark, monkeypatch, block, bucket):
    """A bigram of two words that come twice among 400,000 tokens is in the models, however texts and keys are split."""
    monkeypatch.setattr(cross_entropy, "BLOCK_BYTES", block)
    monkeypatch.setattr(cross_entropy, "BUCKET_BYTES", bucket)
    common = " ".join(prose(100, 1).split()[:20])
    rows = [(1, "zebra yak zebra yak", True), (2, "zebra ox " + common, None), (3, "lone yak", None), (4, None, True)]
    big = spark.createDataFrame([*rows, (5, " ".join([common] * 20000), None)], "doc_id long, text string, good boolean").repartition(3)
    expected = plain_losses([*rows, (5, " ".join([common] * 20000), None)], 1 << 60, 1 << 60)
    got = {r["doc_id"]: r for r in cross_entropy.scored(big, F.col("good")).collect()}
    for doc_id, n, target, background in expected:
        assert got[doc_id]["n_words"] == n
        if n:
            assert np.allclose((got[doc_id]["target_loss"], got[doc_id]["background_loss"]), (target, background), atol=1e-9)
    assert got[1]["score"] < 0 and got[4]["score"] is None
