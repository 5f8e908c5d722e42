"""One query per training-data operator over the generated tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm.common import crc32_parity, prepare
from tidemark.llm.embedding_dedup import embedding_dedup
from tidemark.llm.exact_dedup import exact_dedup
from tidemark.llm.hard_negatives import hard_negatives
from tidemark.llm.language_id import identify, learn
from tidemark.llm.lattice_sampling import encode
from tidemark.llm.line_dedup import PASSAGES, line_dedup
from tidemark.llm.ngram_join import ngram_join
from tidemark.llm.packing import pack
from tidemark.llm.quality import quality_scores
from tidemark.llm.secret_scan import secret_digests
from tidemark.llm.token_alignment import token_alignment
from tidemark.llm.token_count import token_counts
from tidemark.llm.url_filter import Rule, labelled_by_rules, train, url_filter
from tidemark.session import new_dir

RULES = [Rule("block", "net"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(prepare(spark), sf_dir)

    QUERIES[f.__name__] = run
    return f


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@query
def op1_packing(spark, sf_dir):
    return pack(load(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), with_ids=False)


@query
def op10_token_counts(spark, sf_dir):
    return token_counts(load(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op3_language_id(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    learned = learn(docs.where(crc32_parity() != 2))
    return identify(docs, learned).withColumn("held_out", F.coalesce(crc32_parity() == 2, F.lit(False)))


@query
def op8_exact_dedup(spark, sf_dir):
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return exact_dedup(load(spark, sf_dir, "documents"), new_dir(spark, "digest-index"), buckets)


@query
def op9_ngram_join(spark, sf_dir):
    return ngram_join(load(spark, sf_dir, "documents"))


@query
def op5_secret_scan(spark, sf_dir):
    return secret_digests(load(spark, sf_dir, "documents"))


@query
def op4_line_dedup(spark, sf_dir):
    """doc_id, the text left, its length and how many characters went."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "text", F.char_length(F.coalesce("text", F.lit(""))).alias("before"))
    left = F.char_length(F.coalesce("text", F.lit("")))
    return line_dedup(docs, PASSAGES).select("doc_id", "text", (F.col("before") - left).cast("long").alias("removed_chars"))


@query
def op7_embedding_dedup(spark, sf_dir):
    return embedding_dedup(load(spark, sf_dir, "embeddings"))


@query
def op2_quality(spark, sf_dir):
    """The source of a document stands for its host, source and language for its path."""
    docs = load(spark, sf_dir, "documents")
    path = F.concat_ws("/", docs["source"], docs["lang"])
    return quality_scores(docs, load(spark, sf_dir, "labels"), docs["source"], path)


@query
def op6_lattice_sampling(spark, sf_dir):
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encode(load(spark, sf_dir, "documents"), model, k=2, sharpness=0.5)


@query
def op11_hard_negatives(spark, sf_dir):
    """Rows whose id 7 divides count with the next label; ids that 50 divides are the anchors."""
    rows = load(spark, sf_dir, "embeddings")
    label = F.when(rows["vec_id"] % 7 == 0, (rows["label"] + 1) % 10).otherwise(rows["label"])
    return hard_negatives(rows, F.col("vec_id") % 50 == 0, label=label)


@query
def op12_token_alignment(spark, sf_dir):
    files = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment(load(spark, sf_dir, "documents"), *files)


@query
def op13_url_filter(spark, sf_dir):
    """Rules first; the URLs that they decide are the labelled ones from which the trees are trained."""
    pages = load(spark, sf_dir, "pages")
    return url_filter(pages, RULES, train(labelled_by_rules(pages, RULES))).drop("blocked")
