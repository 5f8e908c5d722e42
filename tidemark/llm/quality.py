"""Quality scores: evidence of a document classifier joined with posteriors of its host and path.

A hashed naive Bayes classifier is counted over all labelled documents. Hosts and paths get beta-binomial posteriors
from the labels found on them: the global rate is the prior of a host, the host's posterior mean the prior of its
paths, each with a strength estimated by moments from the spread between sites. A site with few labels so stays close
to what is above it.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import column, stage

MARKS = re.compile(r"[^\w\s]")


@dataclass(frozen=True)
class Settings:
    features: int = 1 << 16  # hashed features, the bound of what the driver and every task hold of the classifier
    smoothing: float = 0.5  # added to each count of a feature
    clear: float = 4.0  # standard errors from which a feature counts as evidence
    temper: float = 0.3  # power of the number of such features by which their sum is damped
    least_strength: float = 1.0  # bounds of the strength of a prior, in labels
    most_strength: float = 1_000.0
    keep_from: float = 0.5  # posterior probability of good quality from which a document stays


def features(text: str, size: int) -> np.ndarray:
    """Distinct hashed features: words, and coarse steps of shape (length, capitals, marks, repetition, line form)."""
    words = text.split()
    n = max(1, len(words))
    letters = max(1, sum(map(str.isalpha, text)))
    marks = len(MARKS.findall(text))
    shape = [
        f"\x00length {min(12, int(math.log2(n + 1)))}", f"\x00capitals {int(10 * sum(map(str.isupper, text)) / letters)}",
        f"\x00marks {min(10, int(10 * marks / n))}", f"\x00distinct {int(10 * len(set(words)) / n)}",
        f"\x00word {min(15, int(letters / n))}", f"\x00bars {min(10, int(20 * text.count('|') / n))}",
        f"\x00stops {min(10, int(20 * sum(text.count(c) for c in '.!?') / n))}", f"\x00digits {min(10, int(20 * sum(map(str.isdigit, text)) / max(1, len(text))))}",
    ]
    return np.unique(np.array([xxhash.xxh3_64_intdigest(w) % size for w in {*map(str.lower, words), *shape}], np.int64))


def count_features(labelled: DataFrame, settings: Settings) -> np.ndarray:
    """Documents per class (row 0) and per feature and class, over all rows (text, good).

    Each task sums its own rows; what reaches the driver has as many rows as there are features, whatever the input.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((settings.features + 1, 2), np.int64)
        for batch in batches:
            for text, good in zip(batch.column("text").to_pylist(), batch.column("good").to_pylist(), strict=True):
                sums[features(text, settings.features) + 1, good] += 1
                sums[0, good] += 1
        used = np.flatnonzero(sums.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(sums[used, 0]), pa.array(sums[used, 1])], ["feature", "bad", "good"])

    parts = labelled.select("text", "good").mapInArrow(count, "feature long, bad long, good long")
    out = np.zeros((settings.features + 1, 2), np.int64)
    for r in parts.groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good")).collect():
        out[r.feature] = r.bad, r.good
    return out


def log_odds(counts: np.ndarray, settings: Settings) -> np.ndarray:
    """Evidence of each feature for good quality, 0 where chance could explain it or a class has no labels."""
    totals = counts[0].astype(float)
    if not totals.all():
        return np.zeros(len(counts) - 1)
    rates = (counts[1:] + settings.smoothing) / (totals + 2 * settings.smoothing)
    found = np.log(rates[:, 1] / rates[:, 0])
    error = np.sqrt((1 / (counts[1:] + settings.smoothing)).sum(axis=1))
    return np.where(np.abs(found) >= settings.clear * error, found, 0.0)


def evidence(rows: DataFrame, weights: np.ndarray, settings: Settings) -> DataFrame:
    """The rows with the damped sum of evidence of their text, without the text."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [features(t, settings.features) for t in batch.column("text").to_pylist()]
            values = [float(weights[f].sum()) / max(1, np.count_nonzero(weights[f])) ** settings.temper for f in found]
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(values, pa.float64())], [*kept, "evidence"])

    return rows.mapInArrow(score, T.StructType([f for f in rows.schema if f.name != "text"]).add("evidence", "double"))


def strength(sites: DataFrame, settings: Settings) -> float:
    """Labels that a prior of sites (n, good, prior) weighs, by moments of the rates' spread beyond chance."""
    p = F.col("prior")
    found = sites.where("n > 0").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * (F.col("good") / F.col("n") - p) * (F.col("good") / F.col("n") - p)).alias("spread"),
        F.count("*").alias("sites"), F.sum(F.col("n") * p * (1 - p)).alias("chance"), F.sum(F.col("n") * F.col("n")).alias("squares"),
    ).first()
    if not found.sites or not found.n or not found.chance:
        return settings.most_strength
    unit = found.chance / found.n  # variance of one label
    between = (found.spread - found.sites * unit) / found.n  # variance of the rates beyond chance
    if between <= 0:
        return settings.most_strength
    return min(settings.most_strength, max(settings.least_strength, unit / between - 1))


def logit(p: Column) -> Column:
    held = F.least(F.lit(1 - 1e-6), F.greatest(F.lit(1e-6), p))
    return F.log(held / (1 - held))


def quality_scores(
    docs: DataFrame, labels: DataFrame, host: Column, path: Column, settings: Settings = Settings(),
    id_col: str = "doc_id", text_col: str = "text", label_id: str = "doc_id", label_col: str = "quality",
) -> DataFrame:
    """One row per input row: doc_id, host, path, evidence, host_rate, path_rate, score, kept.

    score is the posterior probability of good quality, kept its comparison with ``keep_from``. ``host`` and ``path``
    are columns of ``docs``; a null host or path is a site of its own. A label of 1 is good, 0 bad, others and null are
    none; of several labels of one id the lowest counts. Documents without a label are scored all the same. Without any
    label the global rate is 1/2 and evidence 0. Null and empty texts are scored by their shape; null ids get no label;
    repeated rows are each scored; an empty table gives no rows; further columns are not read.

    Sites are grouped with partial sums, so a host with a third of all rows sends one row per task and path. Scores meet
    sites by a join whose sides are both shuffled, which adaptive execution splits at a large site.
    """
    base = docs.select(
        column(docs, id_col).alias("doc_id"), F.coalesce(column(docs, text_col).cast("string"), F.lit("")).alias("text"),
        F.coalesce(host.cast("string"), F.lit("\x00")).alias("host"), F.coalesce(path.cast("string"), F.lit("\x00")).alias("path"),
    )
    known = labels.select(column(labels, label_id).alias("doc_id"), column(labels, label_col).cast("int").alias("good"))
    known = known.where("doc_id IS NOT NULL AND good IN (0, 1)").groupBy("doc_id").agg(F.min("good").alias("good"))
    # Both sides move at every size: the labels grow with the documents.
    training = base.join(known.hint("merge"), "doc_id")
    weights = log_odds(count_features(training, settings), settings)
    scored = stage(evidence(base, weights, settings), "evidence")
    told = scored.join(known.hint("merge"), "doc_id", "left")
    paths = stage(told.groupBy("host", "path").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")
    ), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    rate = (total.good + 0.5) / (total.n + 1) if total.n else 0.5
    hosts = hosts.withColumn("prior", F.lit(rate))
    weight = strength(hosts, settings)
    hosts = stage(hosts.select("host", ((F.col("good") + weight * F.col("prior")) / (F.col("n") + weight)).alias("host_rate")), "hosts")
    sites = paths.join(hosts, "host").withColumn("prior", F.col("host_rate"))
    weight = strength(sites, settings)
    sites = stage(sites.select(
        "host", "path", "host_rate", ((F.col("good") + weight * F.col("prior")) / (F.col("n") + weight)).alias("path_rate")
    ), "sites")
    joined = scored.join(sites, ["host", "path"])
    score = 1 / (1 + F.exp(-(logit(F.col("path_rate")) + F.col("evidence"))))
    none = F.lit("\x00")
    return joined.select(
        "doc_id", F.nullif("host", none).alias("host"), F.nullif("path", none).alias("path"), "evidence", "host_rate", "path_rate",
        score.alias("score"), (score >= settings.keep_from).alias("kept"),
    )
