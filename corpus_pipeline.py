"""The corpus pipeline: language ID, line dedup, near-duplicate join, secret scan and packing over ``documents``.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; all but the last return the columns of ``documents``.
``run`` writes each result as Parquet to the shared folder and reads it again for the next stage.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import column, crc32_parity, prepare
from tidemark.llm.language_id import identify, learn
from tidemark.llm.line_dedup import PASSAGES, line_dedup
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.packing import pack
from tidemark.llm.secret_scan import scan
from tidemark.session import new_dir

MASK = "[SECRET]"


def keyed(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id has a row in ``verdicts`` (one column, doc_id)."""
    wanted = verdicts.select(F.col("doc_id").alias("wanted id"))
    return docs.join(wanted, column(docs, "doc_id").eqNullSafe(F.col("wanted id")), "left_semi")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language or with a narrow margin; lang becomes the predicted language.

    Dictionaries are learned from the labelled rows of ``docs`` outside the held-out quarter of ids.
    """
    prepare(spark)
    learned = learn(docs.where(crc32_parity() != 2))
    found = identify(docs, learned).where("NOT rejected").select("doc_id", "lang_pred")
    # One verdict per id: rows that repeat an id stay together.
    found = found.groupBy("doc_id").agg(F.min("lang_pred").alias("predicted lang")).withColumnRenamed("doc_id", "wanted id")
    kept = docs.join(found, column(docs, "doc_id").eqNullSafe(F.col("wanted id")))
    return kept.select(*[F.col("predicted lang").alias("lang") if c == "lang" else column(docs, c) for c in docs.columns])


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Removes repeated chunks of lines and passages of whole lines; documents that consist of nothing else go, all others stay."""
    prepare(spark)
    before = docs.withColumn("had text", F.coalesce(F.char_length("text") > 0, F.lit(False)))
    after = with_size(line_dedup(before, PASSAGES))
    return after.where(~F.col("had text") | (F.col("text") != "")).select(*[column(after, c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays."""
    prepare(spark)
    return keyed(docs, ngram_join(docs).where("kept").select("doc_id").distinct())


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret becomes MASK; all documents stay."""
    prepare(spark)
    found = scan(docs).where(F.size("found") > 0).select(
        F.col("doc_id").alias("found id"), F.col("text_hash").alias("found text"), "found"
    ).dropDuplicates(["found id", "found text"])
    same = column(docs, "doc_id").eqNullSafe(F.col("found id")) & (F.xxhash64("text") == F.col("found text"))
    rows = docs.join(found, same, "left")

    def step(done, s):
        # Spans come in order; what an earlier span has covered already is not written again.
        begin = F.greatest(s["start"], done["at"])
        gap = F.substr("text", done["at"] + 1, begin - done["at"])
        fresh = s["start"] >= done["at"]
        return F.struct(
            F.greatest(done["at"], s["end"]).alias("at"),
            F.concat(done["out"], F.when(fresh, F.concat(gap, F.lit(MASK))).otherwise(F.lit(""))).alias("out"),
        )

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    masked = F.aggregate("found", start, step, lambda d: F.concat(d["out"], F.substr("text", d["at"] + 1, F.char_length("text"))))
    text = F.when(F.col("found").isNull(), F.col("text")).otherwise(masked)
    done = with_size(rows.withColumn("text", text))
    return done.select(*[column(done, c) for c in docs.columns])


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two lengths with their ids."""
    return pack(prepare(spark) and docs, public_tokenizers.path("word_bpe_49k.json"))


def with_size(docs: DataFrame) -> DataFrame:
    """n_chars follows a changed text, where the table has that column."""
    if "n_chars" not in docs.columns:
        return docs
    size = F.char_length("text").cast(docs.schema["n_chars"].dataType)
    return docs.withColumn("n_chars", size)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language), ("line dedup", lines), ("near duplicates", near_duplicates), ("secret scan", secrets),
    ("packing", packing),
]
ORACLE_SQL = None  # compression and tokenizers are beyond SQL; tests compare with a plain version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, f) in enumerate(STAGES):
        path = new_dir(spark, f"stage-{k}")
        f(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
