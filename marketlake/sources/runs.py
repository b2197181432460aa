"""Keyed tables as a base and small runs of changes, which are merged by key when read.

A change writes its own rows and nothing else; folding the runs into the base rewrites the partitions they touch, under a
new version next to the old one. Both become visible by one commit, a small file that is renamed into place, so a
reader sees one state of the table and keeps its files while others write. ``files`` lists what each commit wrote and
how many rows, against which ``unread`` holds what can be read.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.operators.clean import keep_latest
from marketlake.sources.files import exists, names_in, read_text, remove, write_text

FILES = T.StructType([T.StructField("file", T.StringType()), T.StructField("rows", T.LongType())])


@dataclass(frozen=True)
class State:
    """A committed state: the version of each base partition, and the runs since by number, each with who wrote it and its folder."""

    number: int = -1
    versions: dict[str, int] = field(default_factory=dict)
    runs: dict[int, list[str]] = field(default_factory=dict)


@dataclass(frozen=True)
class RunTable:
    """``partitions`` are computed from the rows; their values are collected, so their number must be bounded (months by the
    calendar, buckets of symbols by a constant). Rows without a key are none of this table's."""

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    partitions: Callable[[], dict[str, Column]]
    listed: bool = True  # whether commits list their files, for ``unread``

    def state(self) -> State:
        """The newest committed state; a commit holds all of it."""
        commits = sorted(n for n in names_in(self.spark, f"{self.path}/commits") if n.endswith(".json"))
        if not commits:
            return State()
        found = json.loads(read_text(self.spark, f"{self.path}/commits/{commits[-1]}"))
        return State(found["number"], found["versions"], {int(k): v for k, v in found["runs"].items()})

    def append(self, rows: DataFrame, token: str) -> None:
        """Store rows that replace those with the same keys. ``token`` names the writer's step: a step that is repeated replaces what it wrote before."""
        state = self.state()
        number = state.number + 1
        run = self._number(state, token)
        name = f"{number:012d}"  # of its own, so a repeated step does not touch files that are being read
        self._written(rows, f"{self.path}/runs/{name}")
        if self.listed:
            self._list_files(f"{self.path}/runs/{name}", number)
        self._commit(State(number, state.versions, {**state.runs, number if run is None else run: [token, name]}))

    def read(self, places: Sequence[str] | None = None, before: str | None = None) -> DataFrame:
        """All rows, or those of the partitions ``places`` (values joined by a slash); with ``before``, as they were before that step."""
        state = self.state()
        names = list(self.partitions())
        chosen = {p: v for p, v in state.versions.items() if places is None or p in set(places)}
        limit = self._number(state, before)
        changes = self._changes(state, [r for r in state.runs if limit is None or r < limit])
        if changes is not None and places is not None:
            changes = changes.where(F.concat_ws("/", *names).isin(list(places)))
        base = self._base(chosen)
        if base is None or changes is None:
            found = base if changes is None else changes
            return self.spark.createDataFrame([], self.schema) if found is None else found.select(*self.schema.names)
        unchanged = base.join(changes.select(*self.keys), list(self.keys), "left_anti")
        return unchanged.select(*self.schema.names).unionByName(changes.select(*self.schema.names))

    def compact(self, before: str | None = None, least: int = 1) -> None:
        """Fold the runs before the step ``before`` (all, unless given) into the base, if they are ``least`` or more."""
        state = self.state()
        limit = self._number(state, before)
        folded = [r for r in state.runs if limit is None or r < limit]
        changes = self._changes(state, folded) if len(folded) >= least else None
        if changes is None:
            return
        touched = changes.select(F.concat_ws("/", *self.partitions()).alias("place")).distinct().toArrow()["place"].to_pylist()
        base = self._base({p: v for p, v in state.versions.items() if p in set(touched)})
        merged = changes if base is None else base.join(changes.select(*self.keys), list(self.keys), "left_anti").unionByName(changes)
        version = state.number + 1
        folder = f"{self.path}/base/{version:012d}"
        self._written(merged, folder)
        if self.listed:
            self._list_files(folder, version)
        self._commit(State(version, {**state.versions, **dict.fromkeys(touched, version)}, {k: v for k, v in state.runs.items() if k not in folded}))

    def expire(self) -> None:
        """Remove what no committed state but the newest uses. Readers of older ones must be done: call it by age, not after each write."""
        state = self.state()
        used = {f"{v:012d}" for v in state.versions.values()}
        for name in names_in(self.spark, f"{self.path}/base"):
            if name not in used:
                remove(self.spark, f"{self.path}/base/{name}")
        live = {name for _, name in state.runs.values()}
        for name in names_in(self.spark, f"{self.path}/runs"):
            if name not in live:
                remove(self.spark, f"{self.path}/runs/{name}")
        for name in names_in(self.spark, f"{self.path}/commits"):
            if name != f"{state.number:012d}.json":
                remove(self.spark, f"{self.path}/commits/{name}")
        kept = used | live
        for name in names_in(self.spark, f"{self.path}/files"):
            if name not in kept:
                remove(self.spark, f"{self.path}/files/{name}")

    def unread(self) -> DataFrame:
        """(file, rows, read) of the files of the newest state from which fewer rows can be read than were written: lost, cut or corrupt ones.

        Reads every column of every live file once, pages held against their checksums.
        """
        state = self.state()
        runs = [f"{self.path}/runs/{name}" for _, name in state.runs.values()]
        bases = [f"{self.path}/base/{v:012d}" for v in sorted(set(state.versions.values()))]
        if not runs and not bases:
            return self.spark.createDataFrame([], T.StructType([*FILES.fields, T.StructField("read", T.LongType())]))
        commits = [f.rsplit("/", 1)[1] for f in [*runs, *bases]]
        listed = self.spark.read.schema(FILES).parquet(*[f"{self.path}/files/{c}" for c in commits])
        seen = rows_by_file(self.spark, [f for f in [*runs, *bases] if exists(self.spark, f)], self._typed())
        found = listed.join(seen.withColumnRenamed("rows", "read"), "file", "left").fillna(0, ["read"])
        return found.where("read < rows")

    def _typed(self) -> T.StructType:
        return T.StructType([*self.schema.fields, *[T.StructField(p, T.StringType()) for p in self.partitions()]])

    def _written(self, rows: DataFrame, folder: str) -> None:
        parts = self.partitions()
        rows.select(*self.schema.names).withColumns(parts).hint("rebalance", *parts).sortWithinPartitions(*parts, *self.keys).write.mode(
            "overwrite"
        ).partitionBy(*parts).parquet(folder)

    def _list_files(self, folder: str, commit: int) -> None:
        """Row counts come from the footers of the files just written."""
        files = self.spark.read.schema(self._typed()).parquet(folder).groupBy(F.col("_metadata.file_path").alias("file"))
        files.agg(F.count("*").alias("rows")).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/files/{commit:012d}")

    @staticmethod
    def _number(state: State, token: str | None) -> int | None:
        return next((k for k, (v, _) in state.runs.items() if v == token), None)

    def _changes(self, state: State, runs: Sequence[int]) -> DataFrame | None:
        """The newest row of each key in the runs."""
        if not runs:
            return None
        read = [self.spark.read.schema(self._typed()).parquet(f"{self.path}/runs/{state.runs[r][1]}").withColumn("run", F.lit(r)) for r in runs]
        rows = read[0]
        for more in read[1:]:
            rows = rows.unionByName(more)
        return rows.drop("run") if len(runs) == 1 else keep_latest(rows, list(self.keys), ["run"]).drop("run")

    def _base(self, versions: dict[str, int]) -> DataFrame | None:
        if not versions:
            return None
        place = F.concat_ws("/", *self.partitions())
        found = None
        for version in sorted(set(versions.values())):
            rows = self.spark.read.schema(self._typed()).parquet(f"{self.path}/base/{version:012d}")
            rows = rows.where(place.isin([p for p, v in versions.items() if v == version]))
            found = rows if found is None else found.unionByName(rows)
        return found

    def _commit(self, state: State) -> None:
        write_text(self.spark, f"{self.path}/commits/{state.number:012d}.json", json.dumps({"number": state.number, "versions": state.versions, "runs": state.runs}))


def rows_by_file(spark: SparkSession, paths: Sequence[str], schema: T.StructType) -> DataFrame:
    """(file, rows) that can be read of Parquet files, all columns of them."""
    if not paths:
        return spark.createDataFrame([], FILES)
    reader = spark.read.options(ignoreCorruptFiles="true", ignoreMissingFiles="true").option("parquet.page.verify-checksum.enabled", "true")
    rows = reader.schema(schema).parquet(*paths)
    # A figure of all columns, so that all of them are read.
    whole = F.bit_xor(F.xxhash64(*[F.col(c) for c in schema.names]))
    counted = rows.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"), whole.alias("whole"))
    return counted.where("whole IS NOT NULL").drop("whole")
