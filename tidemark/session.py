"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Clock and key semantics rely on UTC; the rest lets Spark re-plan from measured sizes, and read bucketed tables always
# by bucket and, where a bucket is one sorted file, in the order of that file.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings this library relies on; all of them are runtime settings."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    A temporary folder is used only where everything runs in one local process.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        path = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def new_dir(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
