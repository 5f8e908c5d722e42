"""What changed in a folder of source files since the last look."""

from __future__ import annotations

import re
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# A binaryFile row holds one file in memory; Spark refuses content above 2 GiB.
HASH_LIMIT = 1 << 30

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("size", T.LongType()),
        T.StructField("mtime", T.TimestampType()),
        T.StructField("sha256", T.StringType()),
    ]
)


def source_snapshot(
    spark: SparkSession, path: str, glob: str | None = None, hash_limit: int = HASH_LIMIT
) -> DataFrame:
    """Path, size, modification time and SHA-256 of each file below ``path``.

    Files above ``hash_limit`` bytes have no hash: size and time tell their changes.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path)
    facts = [F.col("path"), F.col("length").alias("size"), F.col("modificationTime").alias("mtime")]
    small = files.where(F.col("length") <= hash_limit)
    large = files.where(F.col("length") > hash_limit)
    found = small.select(*facts, F.sha2("content", 256).alias("sha256")).unionByName(
        large.select(*facts, F.lit(None).cast("string").alias("sha256"))
    )
    # A scan passes over empty files; the listing that Spark holds for it has them.
    listed = [(re.sub("^file:/+", "file:/", unquote(f)),) for f in files.inputFiles()]
    empty = spark.createDataFrame(listed, "path string").join(files.select("path"), "path", "left_anti")
    return found.unionByName(
        empty.select(
            "path",
            F.lit(0).cast("long").alias("size"),
            F.lit(None).cast("timestamp").alias("mtime"),
            F.sha2(F.lit(""), 256).alias("sha256"),
        )
    )


def source_changes(before: DataFrame, now: DataFrame) -> DataFrame:
    """Files added, removed, empty or changed, with what changed about them."""
    b, n = before.alias("b"), now.alias("n")
    joined = b.join(n, F.col("b.path") == F.col("n.path"), "full")

    def differs(c: str) -> F.Column:
        return F.col(f"b.{c}").isNotNull() & F.col(f"n.{c}").isNotNull() & (F.col(f"b.{c}") != F.col(f"n.{c}"))

    added, removed = F.col("b.path").isNull(), F.col("n.path").isNull()
    status = (
        F.when(added, "added")
        .when(removed, "removed")
        .when(differs("sha256") | differs("size") | differs("mtime"), "changed")
        .otherwise("same")
    )
    return joined.select(
        F.coalesce("n.path", "b.path").alias("path"),
        status.alias("status"),
        differs("sha256").alias("hash_changed"),
        differs("size").alias("size_changed"),
        differs("mtime").alias("mtime_changed"),
        F.coalesce(F.col("n.size") == 0, F.lit(False)).alias("is_empty"),
    )


def source_is_usable(now: DataFrame) -> bool:
    """False for a source without files or with an empty file."""
    row = now.agg(F.count("*").alias("files"), F.count_if(F.col("size") == 0).alias("empty")).first()
    return row.files > 0 and row.empty == 0
