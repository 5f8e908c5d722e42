"""Exact dedup against a persistent index of digests, bucketed and sorted by digest."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.llm.common import documents, id_type, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


class DigestIndex:
    """Digests of all texts seen, one row each: digest, keep_id. Lives as Parquet files under ``path``.

    The files are bucketed and sorted by digest, so the joins of a new batch move and sort only the batch. An index is
    opened again, also in another session, with its path and its number of buckets.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int, id_type: str = "bigint") -> None:
        self.spark, self.buckets = spark, buckets
        self.table = f"digest_index_{uuid.uuid4().hex}"
        where = path.replace("'", "\\'")
        spark.sql(
            f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{where}'"
        )

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def add(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Append the texts of ``docs`` that are new; one row per input row: doc_id, keep_id, group_size, kept, text_sha256.

        Of equal texts within the batch the row with the largest id stays; a text that an earlier batch brought keeps
        that batch's row. group_size counts the rows of this batch. Null and empty texts are one text. Rows without an
        id count, and stay only if no row of their text has an id; rows that repeat one id and text share one verdict.
        Adding a batch again changes nothing. Further columns are not read; an empty batch gives no rows.

        Copies meet as one row per task and digest; the join that hands out verdicts has plain shuffles on both sides,
        so that adaptive execution splits a digest that holds much of the batch.
        """
        texts = documents(docs, id_col, text_col)
        rows = stage(texts.select("doc_id", F.unhex(F.sha2(normalised(F.col("text")), 256)).alias("digest")), "digests")
        groups = stage(rows.groupBy("digest").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), "groups")
        new = groups.join(self.rows().hint("merge"), "digest", "left_anti").select("digest", "keep_id")
        new.repartition(self.buckets, "digest").write.insertInto(self.table)
        known = self.rows().hint("merge")
        verdicts = stage(groups.select("digest", "group_size").join(known, "digest"), "verdicts")
        return rows.join(verdicts, "digest").select(
            "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )


def exact_dedup(docs: DataFrame, path: str, buckets: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Verdicts of one batch against the index under ``path``, which is made if it is not there; see DigestIndex.add."""
    kind = id_type(documents(docs, id_col, text_col)).simpleString()
    return DigestIndex(docs.sparkSession, path, buckets, kind).add(docs, id_col, text_col)
