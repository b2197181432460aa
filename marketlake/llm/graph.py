"""Written steps in the shared folder, and connected components by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import workspace

# Keys of at most this many rows (8 bytes each) may be broadcast; beyond it the same join shuffles.
BROADCAST_KEYS = 1_000_000


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder, read again: lost executors do not repeat what led to it."""
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def tables(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def only_keys(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows of ``df`` whose ``on`` is among the distinct ``keys``, a written table."""
    return df.join(if_small(keys), on, "left_semi")


def if_small(keys: DataFrame) -> DataFrame:
    """A frame of one or two narrow columns, to be broadcast if it has few rows and shuffled else; the result is the same."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def components(links: DataFrame, rounds: int = 50) -> DataFrame:
    """(node, root) for every node of the undirected links (a, b): root is the smallest node reachable.

    Each round hangs every node's larger neighbours, then its smaller ones, on its smallest neighbour, with a
    written table in between, until nothing moves: the logarithm of the longest path in rounds, for any node's
    number of links. Links with a null end or to the node itself are left out.
    """
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges, before = written(edges, "links"), None
    for _ in range(rounds):
        sides = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = sides.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = sides.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        own = least.where("m < u").select("u", F.col("m").alias("v"))
        large = large.unionByName(own).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = written(
            small.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .where("u <> v")
            .distinct(),
            "links",
        )
        state = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
