"""Near-duplicate vectors by dual traversal of cover trees.

Unit vectors at cosine c are ``sqrt(2 - 2c)`` apart. A cover tree nests levels of centres: a node of level i covers
points within ``2 * 2**-i`` of its centre, and its children cover half that. Two trees are walked together from
their roots: a pair of nodes goes on to the pairs of their children only if the centres are no farther apart than
the threshold and both nodes' covering radii (measured, not the level's bound) together. Pairs of points that are
left are confirmed by their cosine in double precision.

Vectors are compared within a label only. Equal vectors of a label are one class from the start. A label of more than ``BLOCK``
classes is dealt into blocks; every block meets every other of its label once, each time tree against tree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.graph import components, written
from marketlake.llm.text import key_runs, on_arrow

BLOCK = 4096
LEVELS = 24
_HEAD = 256
_ROWS = 512
_SLACK = 1e-6


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, off by far less than ``_SLACK``."""
    return np.sqrt(np.maximum(2.0 - 2.0 * (a @ b.T), 0.0))


class CoverTree:
    """Nodes of a cover tree over unit vectors: centre (a point), measured covering radius, children.

    Levels that would not split a node are passed over, so every inner node has two or more children, and so are levels
    so coarse that two balls and ``reach`` span the whole set, where no pair could be pruned. A leaf is one point;
    points still together after ``LEVELS`` halvings become leaves under one node.
    """

    def __init__(self, points: np.ndarray, reach: float = 0.0) -> None:
        self.points, self.reach, self.span = points, reach, None
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[np.ndarray] = []
        self._node(np.arange(len(points)), 0)
        self.centres, self.radii = np.array(self.centre), np.array(self.radius)

    def _node(self, members: np.ndarray, level: int) -> int:
        me = len(self.centre)
        own = self.points[members]
        radius = float(_distances(own, own[:1]).max()) if len(members) > 1 else 0.0
        self.span = radius if self.span is None else self.span
        self.centre.append(int(members[0]))
        self.radius.append(radius)
        self.children.append(np.zeros(0, dtype=np.int64))
        if len(members) > 1:
            while level < LEVELS and (2.0 * 0.5**level >= radius or 4.0 * 0.5**level + self.reach >= self.span):
                level += 1
            parts = self._parts(members, 2.0 * 0.5**level) if level < LEVELS else np.split(members, len(members))
            self.children[me] = np.array([self._node(part, level + 1) for part in parts])
        return me

    def _parts(self, members: np.ndarray, radius: float) -> list[np.ndarray]:
        """Members by the first centre within ``radius``; the first member without one becomes the next centre."""
        parts: list[list[np.ndarray]] = []
        while len(members):
            head, tail = members[:_HEAD], members[_HEAD:]
            near = _distances(self.points[head], self.points[head]) <= radius
            owner = np.full(len(head), -1)
            for i in range(len(head)):
                if owner[i] < 0:
                    owner[near[i] & (owner < 0)] = i
                    owner[i] = i
            chosen = np.unique(owner)
            within = _distances(self.points[tail], self.points[head[chosen]]) <= radius
            taken, at = within.any(axis=1), within.argmax(axis=1)
            for k, i in enumerate(chosen):
                rest = head[(owner == i) & (np.arange(len(head)) != i)]
                parts.append(np.concatenate((head[i : i + 1], rest, tail[taken & (at == k)])))
            members = tail[~taken]
        return parts


def close_pairs(a: CoverTree, b: CoverTree, reach: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of points not farther apart than ``reach``, in batches; for one tree with itself each pair once."""
    same = a is b
    left, right = [], []
    stack = [(0, 0)]
    if a.radii[0] == b.radii[0] == 0.0 and not len(a.children[0]) and not len(b.children[0]):
        if not same:
            yield a.centres[:1], b.centres[:1]
        return
    while stack:
        p, q = stack.pop()
        below_p = a.children[p] if len(a.children[p]) else np.array([p])
        below_q = b.children[q] if len(b.children[q]) else np.array([q])
        for at in range(0, len(below_p), _ROWS):
            rows = below_p[at : at + _ROWS]
            apart = _distances(a.points[a.centres[rows]], b.points[b.centres[below_q]])
            near = apart <= reach + _SLACK + a.radii[rows][:, None] + b.radii[below_q][None, :]
            if same and p == q:
                near &= rows[:, None] <= below_q[None, :]
            x, y = np.nonzero(near)
            x, y = rows[x], below_q[y]
            single = (a.radii[x] == 0) & (b.radii[y] == 0)
            single &= np.array([not len(a.children[i]) and not len(b.children[j]) for i, j in zip(x, y, strict=True)], dtype=bool)
            stack.extend(zip(x[~single].tolist(), y[~single].tolist(), strict=True))
            x, y = a.centres[x[single]], b.centres[y[single]]
            if same:
                x, y = x[x != y], y[x != y]
            left.append(x)
            right.append(y)
        if sum(map(len, left)) > 1 << 20:
            yield np.concatenate(left), np.concatenate(right)
            left, right = [], []
    if left:
        yield np.concatenate(left), np.concatenate(right)


def confirmed(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Whether the row pairs of two arrays of doubles have at least that cosine."""
    dot = np.einsum("ij,ij->i", x, y)
    return dot >= cosine * np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))


def join_labels(label: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Labels after linking p with q; a set's label is its smallest member."""
    while True:
        a, b = label[p], label[q]
        apart = a != b
        if not apart.any():
            return label
        hooked = np.arange(len(label))
        np.minimum.at(hooked, np.maximum(a, b)[apart], np.minimum(a, b)[apart])
        while (hooked[hooked] != hooked).any():
            hooked = hooked[hooked]
        label = hooked[label]


def _compare(cosine: float):
    reach = float(np.sqrt(2.0 - 2.0 * cosine))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in key_runs(batches, ["key_a", "key_b", "cell"]):
            cell = run["cell"][0].as_py()
            ids, sizes, second = (run[c].to_numpy() for c in ("id", "size", "second"))
            x = run["x"].combine_chunks().flatten().to_numpy().reshape(len(run), -1)
            scaled = x / np.abs(x).max(axis=1)[:, None]
            unit = scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]
            across = cell >> 31 != cell & ((1 << 31) - 1)
            if len(run) < 2 or (across and (second.all() or not second.any())):
                continue
            rows_a = np.flatnonzero(~second) if across else np.arange(len(run))
            rows_b = np.flatnonzero(second) if across else rows_a
            tree_a = CoverTree(unit[rows_a], reach)
            tree_b = CoverTree(unit[rows_b], reach) if across else tree_a
            links, label = np.zeros(len(run), dtype=np.int64), np.arange(len(run))
            for p, q in close_pairs(tree_a, tree_b, reach):
                p, q = rows_a[p], rows_b[q]
                sure = np.concatenate([confirmed(scaled[p[k : k + 65536]], scaled[q[k : k + 65536]], cosine) for k in range(0, len(p), 65536)] or [np.zeros(0, dtype=bool)])
                p, q = p[sure], q[sure]
                links += np.bincount(p, weights=sizes[q], minlength=len(run)).astype(np.int64)
                links += np.bincount(q, weights=sizes[p], minlength=len(run)).astype(np.int64)
                label = join_labels(label, p, q)
            found = np.flatnonzero(links)
            if len(found):
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in (run["class"].to_numpy()[found], links[found], ids[found], ids[label[found]])], ["class", "links", "a", "b"])

    return compare


def near_vectors(vectors: DataFrame, cosine: float = 0.93, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of ``vectors`` (vec_id, embedding, label, any further columns).

    Vectors with equal, non-null labels (and as many components) are linked if their cosine is at least ``cosine``.
    ``n_links`` counts other vectors linked directly, ``component_id`` is the smallest vec_id reachable, ``kept`` marks it.
    Null or zero vectors, vectors with null or non-finite components, rows without a label link with nothing; a row without a
    vec_id too, and its component_id is null. Rows that repeat vec_id, label and vector count once and are
    returned as often as they come. An empty table has no rows.
    """
    x = F.transform(F.col("embedding"), lambda v: v.cast("double"))
    sound = F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("x", lambda v: v != 0.0)
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), x.alias("x"))
    rows = written(rows.withColumn("x", F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & sound, F.col("x"))), "vectors")
    members = rows.where("x IS NOT NULL").distinct()
    classes = members.groupBy("label", "x").agg(F.min("vec_id").alias("id"), F.count("*").alias("size"))
    classes = classes.withColumn("class", F.xxhash64("label", "x"))
    classes = written(classes, "vector-classes")
    groups = classes.groupBy("label", F.size("x").alias("dims")).agg(F.ceil(F.count("*") / F.lit(block)).cast("long").alias("blocks"))
    dealt = classes.withColumn("dims", F.size("x")).join(groups, ["label", "dims"]).withColumn("own", F.pmod(F.xxhash64("x"), F.col("blocks")))
    cells = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        F.xxhash64("label", "dims").alias("key_a"),
        F.xxhash64(F.lit("second"), "dims", "label").alias("key_b"),
        (F.least("own", "other") * (1 << 31) + F.greatest("own", "other")).alias("cell"),
        (F.col("own") > F.col("other")).alias("second"),
        "id",
        "class",
        "size",
        "x",
    )
    cells = cells.repartition("key_a", "key_b", "cell").sortWithinPartitions("key_a", "key_b", "cell", "id")
    found = written(on_arrow(cells, _compare(cosine), "class long, links long, a long, b long"), "vector-links")
    linked = found.groupBy("class", F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    roots = components(found.select("a", "b")).withColumnRenamed("node", "id")
    named = classes.select("label", "x", "class", "id", "size").join(linked, ["class", "id"], "left").join(roots, "id", "left")
    named = named.select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"), F.coalesce("root", "id").alias("component_id"))
    return (
        rows.join(named, ["label", "x"], "left")
        .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)))
    )
