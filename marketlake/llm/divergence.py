"""Divergence between the sources of a language by three-dimensional cube partitioning.

A language's groups (its sources) are dealt into blocks, and so are its kept terms. A cell is a block of groups against a
block of groups over a block of terms: it gets the slices of its groups, computes what these terms add to the
divergence of all its pairs, and the parts are summed along the term axis. A slice is one row with packed arrays and
is copied once per opposite block of groups; neither a language nor a common term lies in one task.

Map tasks count the terms of their own documents before anything is shuffled. All arithmetic is on whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.graph import written
from marketlake.llm.text import key_runs, on_arrow

LEAST_DOCUMENTS = 30
TERM_RANKS = 50
SCALE = 1_000_000_000
PRIOR = 5
# Sizes of the blocks of a cell, in expectation for groups, which are dealt by hash.
GROUP_BLOCK = 32
TERM_BLOCK = 4096
# Terms that a map task counts before it hands them on.
HELD = 400_000

# Terms are letters A to Z and all bytes of characters beyond ASCII; the rest parts them, and A to Z is lower-cased.
_TERMS = bytes(b | 0x20 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, source, term, n, docs) of a task's documents; a row with a null term counts a group's documents."""
    n: dict[tuple, Counter] = {}
    docs: dict[tuple, Counter] = {}
    size: Counter = Counter()

    def handed_on() -> Iterator[pa.RecordBatch]:
        for group, found in n.items():
            terms, held = list(found), docs[group]
            columns = [pa.array([None, *(t.decode() for t in terms)], pa.string())]
            columns.append(pa.array([0, *found.values()], pa.int64()))
            columns.append(pa.array([size[group], *(held[t] for t in terms)], pa.int64()))
            keys = [pa.array([k] * (len(terms) + 1), pa.string()) for k in group]
            yield pa.RecordBatch.from_arrays([*keys, *columns], ["lang", "source", "term", "n", "docs"])
        for held in (n, docs, size):
            held.clear()

    for batch in batches:
        since = 0
        langs, sources = batch.column(1).to_pylist(), batch.column(2).to_pylist()
        for text, lang, source in zip(batch.column(0), langs, sources, strict=True):
            words = text.as_buffer().to_pybytes().translate(_TERMS).split() if text.is_valid else []
            group = (lang, source)
            if group not in n:
                n[group], docs[group] = Counter(), Counter()
            size[group] += 1
            n[group].update(words)
            docs[group].update(set(words))
            since += len(words)
            if since > HELD // 8:
                since = 0
                if sum(map(len, n.values())) > HELD:
                    yield from handed_on()
        if sum(map(len, n.values())) > HELD:
            yield from handed_on()
    yield from handed_on()


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)) in decimals; 1 where there are no terms at all."""

    def wide(c: Column) -> Column:
        return c.cast("decimal(19,0)")

    over = F.nullif(wide(total + PRIOR * terms), F.lit(0).cast("decimal(19,0)"))
    return F.coalesce(F.call_function("div", F.lit(SCALE).cast("decimal(10,0)") * wide(count + PRIOR), over), F.lit(0)) + 1


def _partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What the terms of a cell add to the divergence of its pairs (a, b): once for blocks that meet themselves, in order of name."""
    for run in key_runs(batches, ["lang", "one", "other", "term_block"]):
        names, second = run["source"].to_pylist(), run["second"].to_numpy()
        terms, across = run["terms"][0].as_py(), run["one"][0].as_py() != run["other"][0].as_py()
        base = run["base"].to_numpy()
        places = run["places"].combine_chunks()
        where, shares = places.flatten().to_numpy(), run["shares"].combine_chunks().flatten().to_numpy()
        owner = np.repeat(np.arange(len(names)), places.value_lengths().to_numpy())
        p = np.repeat(base[:, None], terms, axis=1)
        p[owner, where] = shares
        out: list[list] = [[], [], []]
        for i in range(len(names)):
            facing = np.flatnonzero(second & ~second[i]) if across and not second[i] else np.arange(i + 1, 0 if across else len(names))
            if len(facing):
                out[0] += [names[i]] * len(facing)
                out[1] += [names[j] for j in facing]
                out[2] += np.abs(p[facing] - p[i]).sum(axis=1).tolist()
        lang = pa.array([run["lang"][0].as_py()] * len(out[0]), pa.string())
        yield pa.RecordBatch.from_arrays([lang, pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], ["lang", "a", "b", "value"])


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, ranks: int = TERM_RANKS) -> DataFrame:
    """(lang, source, part, item, value, rank) for every group (lang, source) of ``docs`` (text, lang, source, any further columns).

    Each lang keeps the terms in at least ``least_documents`` of its documents. Part ``pair`` ranks all other sources of the
    lang by the sum of absolute differences between the shares of all its kept terms, part ``term`` the terms that are more frequent in the
    group than in the lang, up to ``ranks``; the greater value first, equal ones by the UTF-8 bytes of the item.

    Null texts, langs and sources are empty. Every row is a document, repeated ones too. A group without kept terms has the same share
    of each; a lang without any has value 0 for all pairs. The only source of a lang has no pairs, an empty table no rows.
    """
    rows = docs.select("text", *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")])
    key = ["lang", "source"]
    found = on_arrow(rows, _counts, "lang string, source string, term string, n long, docs long").groupBy(*key, "term")
    found = written(found.agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")), "terms")
    known = found.where("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    known = written(known.where(F.col("docs") >= least_documents).drop("docs"), "kept-terms")
    counts = written(found.where("term IS NOT NULL").join(known, ["lang", "term"]).drop("docs"), "kept-counts")

    langs = known.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = counts.groupBy(*key).agg(F.sum("n").alias("total"))
    groups = found.where("term IS NULL").select(*key).join(totals, key, "left").join(langs, "lang", "left").fillna(0, ["total", "v", "lang_total"])
    blocks = F.greatest(F.ceil(F.count("*").over(Window.partitionBy("lang")) / GROUP_BLOCK), F.lit(1)).cast("long")
    groups = groups.withColumns({"blocks": blocks, "term_blocks": F.greatest(F.ceil(F.col("v") / TERM_BLOCK), F.lit(1)).cast("long")})
    groups = groups.withColumn("own", F.pmod(F.xxhash64("source"), F.col("blocks")))
    groups = written(groups.withColumn("base", share(F.lit(0), F.col("total"), F.col("v"))), "groups")

    # Terms by block, each with its place there.
    sizes = groups.select("lang", "term_blocks").distinct()
    dealt = known.join(sizes, "lang").withColumn("term_block", F.pmod(F.xxhash64("term"), F.col("term_blocks")))
    in_block = Window.partitionBy("lang", "term_block")
    dealt = dealt.select("lang", "term", "term_block", (F.row_number().over(in_block.orderBy("term")) - 1).alias("place"), F.count("*").over(in_block).alias("terms"))
    dealt = written(dealt, "term-blocks")
    packed = counts.join(dealt, ["lang", "term"]).join(groups.select(*key, "total", "v"), key)
    packed = packed.withColumn("share", share(F.col("n"), F.col("total"), F.col("v"))).groupBy(*key, "term_block")
    packed = packed.agg(F.collect_list(F.struct("place", "share")).alias("slice"))
    held = dealt.groupBy("lang", "term_block").agg(F.first("terms").alias("terms"))
    slices = groups.withColumn("term_block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("term_blocks") - 1)))
    slices = slices.join(held, ["lang", "term_block"], "left").join(packed, [*key, "term_block"], "left")
    slices = slices.withColumn("slice", F.coalesce("slice", F.expr("CAST(array() AS array<struct<place: int, share: bigint>>)")))
    cells = slices.withColumn("facing", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        "lang",
        F.least("own", "facing").alias("one"),
        F.greatest("own", "facing").alias("other"),
        "term_block",
        "source",
        (F.col("own") > F.col("facing")).alias("second"),
        F.coalesce("terms", F.lit(0)).alias("terms"),
        "base",
        F.col("slice.place").alias("places"),
        F.col("slice.share").alias("shares"),
    )
    cell = ["lang", "one", "other", "term_block"]
    partial = on_arrow(cells.repartition(*cell).sortWithinPartitions(*cell, "source"), _partial, "lang string, a string, b string, value long")
    pairs = written(partial.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    pairs = pairs.select("lang", F.col("a").alias("source"), F.col("b").alias("item"), "value").unionByName(
        pairs.select("lang", F.col("b").alias("source"), F.col("a").alias("item"), "value")
    )

    terms = counts.join(groups.select(*key, "total", "v", "lang_total"), key)
    p, q = share(F.col("n"), F.col("total"), F.col("v")), share(F.col("lang_n"), F.col("lang_total"), F.col("v"))
    terms = terms.select(*key, F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
    by_value = Window.partitionBy(*key).orderBy(F.desc("value"), "item")

    def ranked(df: DataFrame, part: str) -> DataFrame:
        return df.withColumn("rank", F.row_number().over(by_value)).select(*key, F.lit(part).alias("part"), "item", "value", "rank")

    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= ranks))
