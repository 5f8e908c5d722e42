"""Helpers of the training-data operators: input columns, written stages, Arrow batches, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.session import configure, new_dir

# Rows an Arrow batch holds at most: the longest texts have over 100 kB, and a batch of them must fit a worker.
BATCH_ROWS = "400"


def prepare(spark: SparkSession) -> SparkSession:
    configure(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark


def column(df: DataFrame, name: str) -> Column:
    """The column of that very name, also when it holds dots."""
    return df["`" + name.replace("`", "``") + "`"]


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **more: str) -> DataFrame:
    """Only the columns an operator reads, under fixed names, so that further columns can't clash; null text is empty."""
    return docs.select(
        column(docs, id_col).alias("doc_id"),
        F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"),
        *[column(docs, c).alias(n) for n, c in more.items()],
    )


def id_type(df: DataFrame, name: str = "doc_id") -> T.DataType:
    return df.schema[name].dataType


def stage(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read again: cuts the lineage and survives lost executors."""
    path = new_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_parity(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 4; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(4))


def connected(edges: DataFrame) -> DataFrame:
    """Components of the undirected edges (a, b) as rows (node, component), component the smallest node reachable.

    Each round joins every node to the smallest of its neighbours: first from the larger ones (large star), then from
    the smaller ones (small star), until the edges stand still. Rounds are written to the shared folder. Each round
    groups by node with partial sums and joins on nodes, so a node with very many edges is split by adaptive execution.
    Null or equal ends carry no edge. No edges give no rows.
    """
    ends = edges.where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    now = stage(ends.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen = None
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = stage(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "star")
        large = (
            both.where("b > a").join(low, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        )
        large = stage(large, "edges")
        down = stage(large.groupBy("a").agg(F.min("b").alias("m")), "star")
        small = large.join(down, "a")
        now = stage(
            small.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(down.select("a", F.col("m").alias("b"))).distinct(),
            "edges",
        )
        state = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            break
        seen = state
    # Still edges are stars: every node points at the smallest of its component.
    return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
