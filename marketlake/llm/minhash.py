"""Near-duplicate documents by an inverted join over signature coordinates.

A document is its set of distinct 5-word shingles. Its signature has 64 minima; every (coordinate, value) is a
list of the documents that hold it. Linked documents agree in a number of coordinates that follows from the
threshold, but for a chance of ``LOST`` at the threshold itself (far less above it), and documents that agree in
t of 64 coordinates share a list among the ``64 - t + 1`` that come first in any fixed order. The order here is rarest first, so that values
of passages that many documents share are skipped wherever rarer ones will do.

Members first meet the smallest document of each of their lists, in blocks to which that document is copied, and hang on
it where their full sets confirm it. So a family of near copies falls together in one row per member. What is then
left to meet are members of a list in different components: those outside its largest one against all, in blocks of
``BLOCK``. A pair is met in the most frequent list that both post, and only there. Members of a meeting with enough
equal coordinates meet once more with their full sets, where all intersections are counted exactly by matrix
products; what leaves a meeting is one link per document, never the pairs of a group.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.graph import components, only_keys, written
from marketlake.llm.text import WordHash, fresh_key, key_runs, mix, on_arrow, shingle_sets

COORDINATES = 64
LOST = 1e-9
BLOCK = 256
BUCKETS_LOG2 = 18
BUCKETS = 1 << BUCKETS_LOG2
_COLUMNS = 4096
_U = np.uint64

_numbers = np.arange(1, 2 * COORDINATES + 1, dtype=np.uint64)
_XOR = mix(_numbers[:COORDINATES])
_TIMES = mix(_numbers[COORDINATES:]) | _U(1)
_SHIFT = (np.arange(COORDINATES, dtype=np.int64)) << 32


def least_matches(percent: int) -> int:
    """The most coordinates that two sets of that similarity reach but for a chance of ``LOST``."""
    p, lost = percent / 100, 0.0
    for n in range(COORDINATES):
        lost += math.comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if lost > LOST:
            return n
    return COORDINATES


def signature(values: np.ndarray) -> np.ndarray:
    """64 minima of a non-empty shingle set under different scramblings, mixed to 32 bits."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), 512):
        part = ((values[None, at : at + 512] ^ _XOR[:, None]) * _TIMES[:, None]).min(axis=1)
        np.minimum(least, part, out=least)
    return (mix(least) >> _U(32)).astype(np.uint32)


def keys_of(sig: np.ndarray) -> np.ndarray:
    """The list keys of signatures: coordinate and value in one long."""
    return _SHIFT | sig.astype(np.int64)


def bucket(keys: np.ndarray) -> np.ndarray:
    return (mix(keys.astype(np.uint64)) >> _U(64 - BUCKETS_LOG2)).astype(np.int64)


def _sketches(key: int):
    """Columns behind the text are passed on."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = WordHash(key)
        for batch in batches:
            sizes, prints, sigs = [], ([], []), []
            for values in shingle_sets(batch.column(1), hashing):
                sizes.append(len(values))
                with np.errstate(over="ignore"):
                    prints[0].append(int(mix(values).sum(dtype=np.uint64).astype(np.int64)))
                    prints[1].append(int(mix(values ^ _XOR[0]).sum(dtype=np.uint64).astype(np.int64)))
                sigs.append(signature(values).tobytes() if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints[0], pa.int64()), pa.array(prints[1], pa.int64()), pa.array(sigs, pa.binary()), *batch.columns[2:]],
                ["doc_id", "n_shingles", "print_a", "print_b", "sig", *batch.schema.names[2:]],
            )

    return sketch


def sketches(docs: DataFrame, key: int, hashed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, two fingerprint sums of the set, signature), null signature for an empty set; ``hashed`` adds the text's hash."""
    more = [F.xxhash64("text").alias("text_hash")] if hashed else []
    return on_arrow(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *more),
        _sketches(key),
        "doc_id long, n_shingles long, print_a long, print_b long, sig binary" + (", text_hash long" if hashed else ""),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, COORDINATES)


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS, dtype=np.int64)
    for batch in batches:
        total += np.bincount(bucket(keys_of(_matrix(batch.column(0)))).ravel(), minlength=BUCKETS)
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])


def frequencies(reps: DataFrame) -> np.ndarray:
    """About how many documents hold a value, in a table of fixed size. It only orders the lists: every document
    sees one figure per value, which is all that the prefix needs."""
    rows = on_arrow(reps.select("sig"), _tally, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    total = np.zeros(BUCKETS, dtype=np.int64)
    total[rows["at"].to_numpy()] = rows["n"].to_numpy()
    return total


def ranks(sig: np.ndarray, frequency: np.ndarray) -> np.ndarray:
    """For each row the place of each coordinate, rarest value first."""
    keys = keys_of(sig)
    order = np.lexsort((keys, frequency[bucket(keys)]), axis=1)
    places = np.empty_like(order)
    np.put_along_axis(places, order, np.arange(COORDINATES)[None, :], axis=1)
    return places.astype(np.uint8)


def postings(reps: DataFrame, frequency: np.ndarray, prefix: int) -> DataFrame:
    """(doc_id, key): the first ``prefix`` lists of each document."""
    shared = reps.sparkSession.sparkContext.broadcast(frequency.astype(np.int32))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                sig = _matrix(part.column(1))
                own = ranks(sig, shared.value) < prefix
                ids = np.repeat(part.column(0).to_numpy(), prefix)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(keys_of(sig)[own])], ["doc_id", "key"])

    return on_arrow(reps.select("doc_id", "sig"), post, "doc_id long, key long")


def lists(posted: DataFrame) -> DataFrame:
    """(doc_id, key, leader): the lists of two or more documents, with the smallest of them."""
    live = posted.groupBy("key").agg(F.count("*").alias("size"), F.min("doc_id").alias("leader")).where("size > 1")
    return posted.join(live, "key").select("doc_id", "key", "leader")


def led(live: DataFrame, block: int) -> DataFrame:
    """(doc_id, leader, cell): every other document of a list against its smallest, which is copied to each block of its followers."""
    pairs = live.where("doc_id <> leader").select("doc_id", "leader").distinct()
    sizes = pairs.groupBy("leader").agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("blocks"))
    followers = pairs.join(sizes, "leader").select("doc_id", "leader", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).alias("cell"))
    cells = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    return followers.unionByName(sizes.select(F.col("leader").alias("doc_id"), "leader", cells.alias("cell")))


def followers(cells: DataFrame, reps: DataFrame, matches: int) -> DataFrame:
    """The rows of ``led`` with enough coordinates equal to those of their leader, and the leaders that have such rows."""

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["leader", "cell"]):
            sig, ids = _matrix(run["sig"].combine_chunks()), run["doc_id"].to_numpy()
            first = ids == run["leader"][0].as_py()
            near = np.zeros(len(ids), dtype=bool)
            for own in sig[first]:  # several where rows repeat the doc_id with another text
                near |= (sig == own).sum(axis=1) >= matches
            if near.sum() > 1:
                yield from run.select(["doc_id", "leader", "cell"]).filter(pa.array(near)).to_batches()

    joined = cells.join(reps.select("doc_id", "sig"), "doc_id").select("doc_id", "leader", "cell", "sig")
    return on_arrow(joined.repartition("leader", "cell").sortWithinPartitions("leader", "cell", "doc_id"), follow, "doc_id long, leader long, cell long")


def _follows(percent: int):
    def follows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["leader", "cell"]):
            ids, leader = run["doc_id"].to_numpy(), run["leader"][0].as_py()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in run["shingles"].to_pylist()]
            linked = np.zeros(len(ids), dtype=bool)
            for own in (sets[i] for i in np.flatnonzero(ids == leader)):
                for i in np.flatnonzero(ids != leader):
                    place = np.minimum(np.searchsorted(own, sets[i]), len(own) - 1)
                    inter = int((own[place] == sets[i]).sum())
                    linked[i] |= 100 * inter >= percent * (len(own) + len(sets[i]) - inter)
            if linked.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[linked]), pa.array(np.full(int(linked.sum()), leader))], ["a", "b"])

    return follows


def meetings(live: DataFrame, roots: DataFrame, block: int) -> DataFrame:
    """(doc_id, key, cell, second, root): the members of lists that hold several components, to meet those of another one.

    A list of at most ``block`` members is one cell. In longer ones those outside the largest component are met among
    themselves and against it, as pairs of blocks.
    """
    known = live.select("doc_id", "key").join(roots.select(F.col("node").alias("doc_id"), "root"), "doc_id", "left")
    known = written(known.withColumn("root", F.coalesce("root", "doc_id")), "members")
    parts = known.groupBy("key", "root").agg(F.count("*").alias("n"))
    parts = parts.groupBy("key").agg(F.count("*").alias("roots"), F.sum("n").alias("size"), F.max(F.struct("n", "root")).alias("main"))
    parts = parts.where("roots > 1").select(
        "key",
        (F.col("size") > block).alias("long"),
        F.col("main.root").alias("main"),
        blocks_of(F.col("main.n"), block).alias("mains"),
        blocks_of(F.col("size") - F.col("main.n"), block).alias("others"),
    )
    inside = F.col("long") & (F.col("root") == F.col("main"))
    outside = F.col("long") & (F.col("root") != F.col("main"))

    def upto(n: str):
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    def cell(kind: int, one, other, second):
        return F.struct((F.lit(kind).cast("long") * (1 << 60) + one * (1 << 30) + other).alias("cell"), second.alias("second"))

    own = F.pmod(F.xxhash64("doc_id"), F.when(inside, F.col("mains")).otherwise(F.col("others")))
    among = F.transform(upto("others"), lambda x: cell(0, F.least("own", x), F.greatest("own", x), F.col("own") > x))
    against = F.transform(upto("mains"), lambda x: cell(1, F.col("own"), x, F.lit(False)))
    facing = F.transform(upto("others"), lambda x: cell(1, x, F.col("own"), F.lit(True)))
    whole = F.array(cell(0, F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(False)))
    cells = F.when(outside, F.concat(among, against)).when(inside, facing).otherwise(whole)
    placed = known.join(parts, "key").withColumn("own", own).withColumn("at", F.explode(cells))
    return placed.select("doc_id", "key", "at.cell", "at.second", "root")


def blocks_of(n: Column, block: int) -> Column:
    return F.ceil(n / F.lit(block)).cast("long")


def _partners(sig: np.ndarray, places: np.ndarray, coordinate: int, second: np.ndarray, across: bool, matches: int, roots: np.ndarray) -> np.ndarray:
    """Which members of a meeting have a partner of another component to be tested here."""
    wanted = np.zeros(len(sig), dtype=bool)
    posted = places <= COORDINATES - matches
    for i in range(len(sig)):
        later = np.flatnonzero(second & ~second[i]) if across and not second[i] else np.arange(i + 1, 0 if across else len(sig))
        if not len(later):
            continue
        equal = sig[later] == sig[i]
        heavier = (equal & posted[later] & (posted[i] & (places[i] > places[i, coordinate]))[None, :]).any(axis=1)
        found = later[(equal.sum(axis=1) >= matches) & ~heavier & (roots[later] != roots[i])]
        if len(found):
            wanted[i] = wanted[found] = True
    return wanted


def candidates(cells: DataFrame, reps: DataFrame, frequency: np.ndarray, matches: int) -> DataFrame:
    """The members of meetings that have a partner with enough equal coordinates."""
    shared = reps.sparkSession.sparkContext.broadcast(frequency.astype(np.int32))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["key", "cell"]):
            key, cell = run["key"][0].as_py(), run["cell"][0].as_py()
            second = run["second"].to_numpy()
            across = cell >= 1 << 60 or cell >> 30 != cell & ((1 << 30) - 1)
            if len(run) < 2 or (across and (second.all() or not second.any())):
                continue
            sig = _matrix(run["sig"].combine_chunks())
            wanted = _partners(sig, ranks(sig, shared.value), key >> 32, second, across, matches, run["root"].to_numpy())
            if wanted.any():
                yield from run.select(["doc_id", "key", "cell", "second"]).filter(pa.array(wanted)).to_batches()

    joined = cells.join(reps.select("doc_id", "sig"), "doc_id").select("doc_id", "key", "cell", "second", "root", "sig")
    return on_arrow(
        joined.repartition("key", "cell").sortWithinPartitions("key", "cell", "doc_id"),
        meet,
        "doc_id long, key long, cell long, second boolean",
    )


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact sizes of the intersections of different sorted sets, by products of 0/1 matrices in column blocks."""
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    column = (np.cumsum(count > 1) - 1)[place]
    common = count[place] > 1
    owner, column = owner[common], column[common]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(sets), len(sets)))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        a, b = np.searchsorted(column, [at, at + _COLUMNS])
        part = np.zeros((len(sets), _COLUMNS), dtype=np.float32)
        part[owner[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total.astype(np.int64)


def _leaders(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the first row it is connected with."""
    label = np.arange(len(linked))
    while True:
        best = np.where(linked, label[None, :], len(linked)).min(axis=1)
        new = np.minimum(label, best)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _confirm(percent: int):
    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["key", "cell"]):
            ids = run["doc_id"].to_numpy()
            sets = [np.frombuffer(x, dtype=np.uint64) for x in run["shingles"].to_pylist()]
            sizes = np.array([len(s) for s in sets], dtype=np.int64)
            inter = intersections(sets)
            linked = 100 * inter >= percent * (sizes[:, None] + sizes[None, :] - inter)
            first = ids[_leaders(linked)]
            apart = first != ids
            if apart.any():
                yield pa.RecordBatch.from_arrays([pa.array(ids[apart]), pa.array(first[apart])], ["a", "b"])

    return confirm


def _sets(key: int):
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashing = WordHash(key)
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                values = [x.tobytes() for x in shingle_sets(part.column(1), hashing)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(values, pa.binary())], ["doc_id", "shingles"])

    return sets


def near_duplicates(docs: DataFrame, percent: int = 80, block: int = BLOCK, hashed: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every document of ``docs`` (doc_id, text, any further columns).

    Documents are linked when ``100 * |A ∩ B| >= percent * |A ∪ B|`` of their full shingle sets. ``component_id`` is the
    smallest doc_id reachable by links, ``kept`` marks that document. Equal sets are one class from the start
    (equal by size and two 64-bit sums over the set), so a large group of copies costs one row each; its
    smallest doc_id stands for it.

    Null, empty and blank texts have no shingles and link with nothing. Repeated rows are returned as often as they
    come, as copies; rows that repeat a doc_id with another text are one document that holds both. A null doc_id
    takes no part: its component_id is null and it is kept. With ``hashed`` each row also has the ``text_hash`` of its own text.
    """
    matches = least_matches(percent)
    if matches < 1:
        raise ValueError("the signature is too short for so low a similarity")
    key = fresh_key()
    known = written(sketches(docs, key, hashed), "sketches")
    prints = ["n_shingles", "print_a", "print_b"]
    taking_part = known.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = taking_part.groupBy(*prints).agg(F.min_by("sig", "doc_id").alias("sig"), F.min("doc_id").alias("doc_id"))
    classes = written(classes, "classes")
    frequency = frequencies(classes)
    live = written(lists(postings(classes, frequency, COORDINATES - matches + 1)), "lists")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")

    def gathered(met: DataFrame, names: list[str]) -> DataFrame:
        """The rows of meetings with their full sets, meeting by meeting."""
        ids = written(met.select("doc_id").distinct(), "candidates")
        sets = on_arrow(only_keys(texts, ids, "doc_id"), _sets(key), "doc_id long, shingles binary").where("length(shingles) > 0")
        return met.select("doc_id", *names).join(sets, "doc_id").repartition(*names).sortWithinPartitions(*names, "doc_id")

    close = written(followers(led(live, block), classes, matches), "followers")
    hung = components(on_arrow(gathered(close, ["leader", "cell"]), _follows(percent), "a long, b long"))
    met = written(candidates(meetings(live, hung, block), classes, frequency, matches), "meetings")
    links = on_arrow(gathered(met, ["key", "cell"]), _confirm(percent), "a long, b long")
    for side in ("a", "b"):
        links = links.join(hung.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}")), side, "left")
    links = links.select(*[F.coalesce(f"root_{side}", side).alias(side) for side in ("a", "b")])
    joined = components(links).select(F.col("node").alias("first_root"), F.col("root").alias("last_root"))
    named = classes.select(*prints, F.col("doc_id").alias("node")).join(hung, "node", "left")
    named = named.withColumn("first_root", F.coalesce("root", "node")).join(joined, "first_root", "left")
    named = named.select(*prints, F.coalesce("last_root", "first_root").alias("component_id"))
    return (
        known.drop("sig")
        .join(named, prints, "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"), *(["text_hash"] if hashed else []))
    )
