"""Session defaults and the shared scratch location."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# UTC everywhere, ANSI on, AQE on; the rest is the cluster's business.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "marketlake", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def workspace(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    ``spark.checkpoint.dir`` names that directory on a cluster. A local run that leaves it unset gets a
    temporary folder, which is remembered in the session so that later calls share it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a shared folder before writing intermediate tables")
        root = tempfile.mkdtemp(prefix="marketlake-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/marketlake/{name}-{uuid.uuid4().hex}"
