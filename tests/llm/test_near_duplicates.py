import math
import random

import numpy as np
import pytest
from helpers_llm import changed, documents, near_groups, prose, roots, texts
from pyspark.sql import functions as F

from marketlake.llm import covertree, graph, minhash
from marketlake.llm.text import WordHash


def collected(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


@pytest.mark.parametrize("block", [256, 3])
def test_groups_of_texts_match_all_pairs(spark, block):
    found = texts()
    hub = prose(120, 50)
    rng = random.Random(5)
    for i in range(20, 60):  # a family of near copies, some linked only through others
        words = hub.split(" ")
        for _ in range(rng.randrange(0, 5)):
            words[rng.randrange(len(words))] = f"other{rng.randrange(9)}"
        found[i] = " ".join(words)
    shared = prose(60, 60)  # a passage that unlike documents share
    for i in range(100, 130):
        found[i] = shared + " " + prose(80, i)
    expected = near_groups(found, 85)
    got = collected(minhash.near_duplicates(documents(spark, found), 85, block))
    assert got == {i: (n, r, r == i) for i, (n, r) in expected.items()}
    assert len({r for i, (_, r) in expected.items() if 20 <= i < 60}) < 40


def test_repeated_rows_missing_ids_and_empty_tables(spark):
    base = prose(50, 9)
    df = documents(spark, {3: base, 5: base}, [(3, base), (None, base), (None, None), (8, None)])
    rows = sorted(map(tuple, minhash.near_duplicates(df, 80).collect()), key=str)
    n = len(set(zip(*[base.split()[k:] for k in range(5)], strict=False)))
    assert rows == sorted([(3, n, 3, True)] * 2 + [(5, n, 3, False), (8, 0, 8, True), (None, n, None, True), (None, 0, None, True)], key=str)
    assert minhash.near_duplicates(documents(spark, {})).collect() == []


def test_similarity_of_80_percent_by_default(spark):
    base = prose(300, 4)
    found = {1: base, 2: changed(base, 130), 3: changed(base, 9)}
    assert collected(minhash.near_duplicates(documents(spark, found))) == {i: (n, r, r == i) for i, (n, r) in near_groups(found, 80).items()}


def test_matches_follow_from_similarity():
    t = minhash.least_matches(85)
    lost = sum(math.comb(64, n) * 0.85**n * 0.15 ** (64 - n) for n in range(t))
    assert lost <= 1e-9 < lost + math.comb(64, t) * 0.85**t * 0.15 ** (64 - t)


def test_intersections_are_exact():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 9000, n).astype(np.uint64)) for n in (0, 1, 50, 6000, 6000)]
    found = minhash.intersections(sets)
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert i == j or found[i, j] == len(np.intersect1d(a, b))


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(100, 140)] + [(7, i) for i in range(200, 260)] + [(1, 2), (2, 3), (3, 1), (5, 5)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    got = {r["node"]: r["root"] for r in graph.components(spark.createDataFrame(links, "a long, b long")).collect()}
    expected = roots({x for a, b in links if a != b for x in (a, b)}, [(a, b) for a, b in links if a != b])
    assert got == expected
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


# --- vectors ----------------------------------------------------------------------------------------


def plain_vectors(rows, cosine=0.93):
    unique = list({(i, None if v is None else tuple(v), label) for i, v, label in rows if i is not None})

    def sound(v):
        return v and all(x is not None and math.isfinite(x) for x in v) and any(v)

    links, count = [], {k: 0 for k in unique}
    for a in unique:
        for b in unique:
            if a < b if None not in (a[1], b[1], a[2], b[2]) else False:
                if a[2] == b[2] and sound(a[1]) and sound(b[1]) and len(a[1]) == len(b[1]):
                    dot = sum(x * y for x, y in zip(a[1], b[1], strict=True))
                    if dot >= cosine * math.sqrt(sum(x * x for x in a[1])) * math.sqrt(sum(x * x for x in b[1])):
                        links.append((a[0], b[0]))
                        count[a] += 1
                        count[b] += 1
    root = roots({i for i, *_ in unique}, links)
    return sorted(((i, count[(i, None if v is None else tuple(v), label)] if i is not None else 0, root.get(i), root.get(i, i) == i) for i, v, label in rows), key=str)


@pytest.mark.parametrize("block", [4096, 7])
def test_vector_links_match_all_pairs(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 16))
    rows = []
    for i in range(150):
        v = centres[i % 12] + rng.normal(size=16) * rng.choice([0.0, 0.1, 0.25, 0.4])
        rows.append((i, [float(x) for x in v * rng.choice([1.0, 3.0])], int(i % 3 == 0)))
    rows += [(200 + i, [float(x) for x in centres[0]], 0) for i in range(20)]
    rows += [(300, None, 0), (301, [], 0), (302, [0.0] * 16, 0), (303, [float("nan")] * 16, 0), (304, [1.0, None] * 8, 0), (305, [float("inf")] * 16, 0)]
    rows += [(306, rows[0][1], None), (307, [1.0, 2.0], 0), (308, [2.0, 4.0], 0), rows[5], (None, rows[0][1], 0)]
    df = spark.createDataFrame([(*r, "other", 1) for r in rows], "vec_id long, embedding array<double>, label int, x string, size int").repartition(3)
    got = sorted(map(tuple, covertree.near_vectors(df, block=block).collect()), key=str)
    assert got == plain_vectors(rows)


def test_no_vectors(spark):
    assert covertree.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).collect() == []


def test_cover_tree_covers_and_nests():
    rng = np.random.default_rng(0)
    points = rng.normal(size=(400, 8))
    points[200:] = points[:200] + rng.normal(size=(200, 8)) * 0.05
    points /= np.linalg.norm(points, axis=1)[:, None]
    tree = covertree.CoverTree(points)

    def below(node):
        kids = tree.children[node]
        return [tree.centres[node]] if not len(kids) else [p for k in kids for p in below(k)]

    assert sorted(below(0)) == list(range(400))
    for node in range(len(tree.centres)):
        assert covertree._distances(points[below(node)], points[tree.centres[node]][None, :]).max() <= tree.radii[node] + 1e-7
    reach = 0.3
    pairs = sorted((min(a, b), max(a, b)) for p, q in covertree.close_pairs(tree, tree, reach) for a, b in zip(p.tolist(), q.tolist(), strict=True))
    apart = covertree._distances(points, points)
    assert set(zip(*(x.tolist() for x in np.nonzero(np.triu(apart <= reach, 1))), strict=True)) <= set(pairs)
    assert len(pairs) == len(set(pairs))


# --- what is planted to make hashes meet, and what is planted to make groups large --------------------


def thue_morse(n: int, a: str, b: str) -> str:
    return "".join((a, b)[bin(i).count("1") & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 2048])
def test_complementary_words_are_no_copies(spark, n):
    found = {1: thue_morse(n, "a", "b"), 2: thue_morse(n, "b", "a"), 3: thue_morse(n, "a", "b")}
    got = collected(minhash.near_duplicates(documents(spark, found)))
    assert got == {1: (1, 1, True), 2: (1, 2, True), 3: (1, 1, False)}


def test_hashes_depend_on_all_bytes_lengths_and_the_key():
    rng = random.Random(4)
    words = {bytes(rng.randrange(97, 123) for _ in range(rng.choice([1, 2, 7, 8, 9, 15, 16, 17, 300, 1000]))) for _ in range(3000)}
    words = sorted({*words, *(w[:-1] + b"!" for w in words), *(w + b"\0" for w in words), *(b"!" + w[1:] for w in words)})
    ends = np.cumsum([len(w) for w in words])
    data = np.frombuffer(b"".join(words), dtype=np.uint8)
    first = WordHash(1).of(data, ends - [len(w) for w in words], ends)
    assert len(np.unique(first)) == len(words)
    shifted = np.concatenate((np.zeros(3, dtype=np.uint8), data))
    assert (WordHash(1).of(shifted, ends - [len(w) for w in words] + 3, ends + 3) == first).all()
    assert not (WordHash(2).of(data, ends - [len(w) for w in words], ends) == first).any()


def test_a_family_of_near_copies_costs_rows_and_loses_no_link(spark):
    """A thousand copies with up to three words changed, and copies of copies that only link to some of them."""
    rng = random.Random(8)
    base = prose(150, 70).split()
    found = {}
    for i in range(1000):
        words = list(base if i < 950 else found[rng.randrange(950)].split(" "))
        for _ in range(rng.randrange(0, 3)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
        found[i] = " ".join(words)
    df = documents(spark, found, parts=4).select("doc_id", "text")
    expected = near_groups(found, 85)
    assert collected(minhash.near_duplicates(df, 85)) == {i: (n, r, r == i) for i, (n, r) in expected.items()}
    matches = minhash.least_matches(85)
    known = minhash.sketches(df, 3).groupBy("n_shingles", "print_a", "print_b").agg(F.min_by("sig", "doc_id").alias("sig"), F.min("doc_id").alias("doc_id")).cache()
    live = minhash.lists(minhash.postings(known, minhash.frequencies(known), 64 - matches + 1)).cache()
    met = minhash.followers(minhash.led(live, 256), known, matches)
    leaders = live.select("leader").distinct().count()
    assert met.count() <= live.select("doc_id", "leader").distinct().count() + leaders * (1000 // 256 + 1)
    hung = graph.components(met.where("doc_id <> leader").select(F.col("doc_id").alias("a"), F.col("leader").alias("b")))
    assert minhash.meetings(live, hung, 256).count() < 20 * len(found)
