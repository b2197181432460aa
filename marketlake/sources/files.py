"""Files and folders of any store that Spark reaches, through its own file systems."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names_in(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, none if there is no such folder."""
    system, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, written aside and renamed into place; an existing one stays and is an error."""
    system, where = _at(spark, path)
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    stream = system.create(aside, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if system.exists(where) or not system.rename(aside, where):
        system.delete(aside, False)
        raise FileExistsError(path)


def run_name(run: str | None = None) -> str:
    """The name of a run, as it is part of folder names; a new one if none is given."""
    if run is None:
        return uuid.uuid4().hex
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", run):
        raise ValueError(f"a run is named by letters, digits and _ . - only, not {run!r}")
    return run
