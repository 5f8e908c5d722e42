"""URL filter: rules first, gradient-boosted trees on lexical features for the rest.

A rule names a host and the beginning of a path and fits that host and its subdomains; the longest rule that fits decides.
URLs that no rule fits are judged by gradient-boosted trees. Their features are counts over the bytes of the URL and the
smoothed share of blocked URLs of its host suffixes, taken from labelled URLs; a label of a training row never enters the
suffix statistics that this row is trained with.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import Transformer
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.llm.common import column, stage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SUFFIXES = (1, 2)  # labels at the end of a host that make a suffix with statistics of its own
FEATURES = (
    "n_url", "n_host", "n_path", "n_query", "depth", "labels", "parameters", "digits", "digit_share", "hyphens", "host_hyphens",
    "host_digits", "escapes", "marks", "entropy", "host_entropy", "longest_label", "longest_part",
)


@dataclass(frozen=True)
class Rule:
    """``verdict`` for URLs whose host is ``host`` or lies below it and whose path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class Settings:
    rows: int = 20_000  # labelled URLs the trees are fitted on, at most; suffix statistics take all of them
    folds: int = 5  # a training row's suffix statistics come from the other folds
    weight: float = 10.0  # rows that the global share counts for in a suffix
    trees: int = 16
    depth: int = 4
    step: float = 0.2
    seed: int = 20240613


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or where :// is missing."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    found = F.instr(url, "://")
    rest = F.when(found > 0, F.substr(url, found + 3, F.char_length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + 1, F.char_length(rest)), r"^[^?#]*", 0)
    return F.translate(host, UPPER, LOWER), path


def ruled(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, null without one; of equally long ones that with the longer host.

    The rules become one expression, so a list should have at most some hundred of them.
    """
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(rules, key=lambda r: (len(r.name), len(r.host), r.name)):
        if r.verdict not in ("allow", "block"):
            raise ValueError(f"a rule must allow or block, not {r.verdict!r}")
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        name, verdict = F.when(fits, r.name).otherwise(name), F.when(fits, r.verdict).otherwise(verdict)
    return name, verdict


def entropy(values: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Bits a byte of each row, 0 for an empty one."""
    size = np.bincount(row, minlength=n).astype(float)
    cell, count = np.unique(row.astype(np.int64) << 8 | values, return_counts=True)
    spent = np.bincount(cell >> 8, weights=count * np.log2(count), minlength=n)
    whole = np.maximum(size, 1)
    return np.where(size > 0, np.log2(whole) - spent / whole, 0.0)


def longest_run(inside: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Length of the longest run of marked bytes within a row."""
    edge = np.ones(len(inside), bool)
    edge[1:] = (row[1:] != row[:-1]) | (inside[1:] != inside[:-1])
    at = np.flatnonzero(edge)
    out = np.zeros(n)
    if len(at):
        length, kept = np.diff(np.append(at, len(inside))), inside[at]
        np.maximum.at(out, row[at][kept], length[kept])
    return out


def lexical(urls: pa.Array, hosts: pa.Array, paths: pa.Array) -> dict[str, np.ndarray]:
    """FEATURES of whole URLs, from their bytes."""
    n = len(urls)

    def spread(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        raw = texts.cast(pa.binary()).to_pylist()
        return np.frombuffer(b"".join(raw), np.uint8), np.repeat(np.arange(n), [len(x) for x in raw])

    (u, ur), (h, hr), (p, pr) = spread(urls), spread(hosts), spread(paths)
    count = lambda marks, row: np.bincount(row[marks], minlength=n).astype(float)
    digit = lambda b: (b >= 48) & (b <= 57)
    every = lambda row: np.bincount(row, minlength=n).astype(float)
    n_url, n_host, n_path = every(ur), every(hr), every(pr)
    # What follows the path is query and fragment; parameters are its = signs.
    asked = np.zeros(len(u), bool)
    if len(u):
        first = np.flatnonzero(u == ord("?"))
        start = np.full(n, len(u))
        np.minimum.at(start, ur[first], first)
        asked = np.arange(len(u)) >= start[ur]
    letters = ((u | 32) >= 97) & ((u | 32) <= 122)
    return {
        "n_url": n_url, "n_host": n_host, "n_path": n_path, "n_query": count(asked, ur),
        "depth": count(p == ord("/"), pr), "labels": count(h == ord("."), hr) + (n_host > 0),
        "parameters": count(asked & (u == ord("=")), ur), "digits": count(digit(u), ur),
        "digit_share": count(digit(u), ur) / np.maximum(n_url, 1), "hyphens": count(u == ord("-"), ur),
        "host_hyphens": count(h == ord("-"), hr), "host_digits": count(digit(h), hr), "escapes": count(u == ord("%"), ur),
        "marks": count(~letters & ~digit(u), ur), "entropy": entropy(u, ur, n), "host_entropy": entropy(h, hr, n),
        "longest_label": longest_run(h != ord("."), hr, n), "longest_part": longest_run(p != ord("/"), pr, n),
    }


def with_features(rows: DataFrame) -> DataFrame:
    """FEATURES of (url, host, path), and suffix_1, suffix_2: the host's last labels, empty where it has none."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = lexical(*[batch.column(c) for c in ("url", "host", "path")])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(found[f], pa.float64()) for f in FEATURES]], [*batch.schema.names, *FEATURES]
            )

    schema = T.StructType([*rows.schema, *[T.StructField(f, T.DoubleType()) for f in FEATURES]])
    out = rows.mapInArrow(measure, schema)
    return out.select("*", *[F.substring_index("host", ".", -k).alias(f"suffix_{k}") for k in SUFFIXES])


def suffix_counts(labelled: DataFrame, settings: Settings) -> DataFrame:
    """k, suffix, fold, rows, blocked: labelled URLs of each suffix. A hot suffix is summed before it is shuffled."""
    fold = F.pmod(F.xxhash64("url"), F.lit(settings.folds)).cast("int")
    each = labelled.select(
        fold.alias("fold"), (F.col("label") == "block").cast("long").alias("b"),
        F.posexplode(F.array(F.lit(""), *[F.substring_index("host", ".", -k) for k in SUFFIXES])).alias("k", "suffix"),
    )
    return each.groupBy("k", "suffix", "fold").agg(F.count("*").alias("rows"), F.sum("b").alias("blocked"))


@dataclass(frozen=True)
class UrlModel:
    """Trees, and the shares that their suffix features need: one per suffix, and the global one."""

    trees: Transformer
    shares: DataFrame  # k, suffix, share, weight: of all labelled URLs
    overall: float

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path and more) with ``blocked``, the probability of block."""
        out = with_features(rows)
        for k in SUFFIXES:
            some = self.shares.where(F.col("k") == k).select(F.col("suffix").alias(f"suffix_{k}"), F.col("share").alias(f"share_{k}"), F.col("weight").alias(f"weight_{k}"))
            out = out.join(some, f"suffix_{k}", "left").fillna({f"share_{k}": self.overall, f"weight_{k}": 0.0})
        judged = self.trees.transform(assembled(out))
        return judged.select(*[column(judged, c) for c in rows.columns], vector_to_array("probability")[1].alias("blocked"))


def assembled(rows: DataFrame) -> DataFrame:
    names = [*FEATURES, *[f"{x}_{k}" for k in SUFFIXES for x in ("share", "weight")]]
    return VectorAssembler(inputCols=names, outputCol="features").transform(rows)


def train(labelled: DataFrame, settings: Settings = Settings()) -> UrlModel | None:
    """A model of labelled URLs (url, label: allow or block); None where one of the two labels is missing.

    Suffix statistics count all labelled URLs. The trees are fitted on at most ``settings.rows`` distinct ones, drawn by
    hash and weighted by how often they occur, in one task: a bounded sample, so one small partition spares a job per
    level its scheduling. Rows with a null url or another label are left out; a URL with both labels counts as each.
    """
    host, path = split_url(F.col("url"))
    rows = labelled.where("url IS NOT NULL AND label IN ('allow', 'block')").select("url", "label", host.alias("host"), path.alias("path"))
    counts = stage(suffix_counts(rows, settings), "suffixes")
    total, blocked = counts.where("k = 0").agg(F.sum("rows"), F.sum("blocked")).first()
    if not total or blocked in (0, total):
        return None
    overall = blocked / total
    sums = counts.groupBy("k", "suffix").agg(F.sum("rows").alias("all_rows"), F.sum("blocked").alias("all_blocked"))
    share = lambda b, n: (F.col(b) + settings.weight * overall) / (F.col(n) + settings.weight)
    of_all = sums.select("k", "suffix", share("all_blocked", "all_rows").alias("share"), F.log1p("all_rows").alias("weight"))
    fold = F.pmod(F.xxhash64("url"), F.lit(settings.folds)).cast("int").alias("fold")
    # A hash of the URL draws it, so repeats come together and meet as one row with their number as weight.
    order = F.xxhash64("url", F.lit(settings.seed))
    drawn = rows.where(F.pmod(order, F.lit(1 << 40)) < min(1.0, settings.rows / total) * (1 << 40))
    drawn = drawn.groupBy(*rows.columns).agg(F.count("*").cast("double").alias("n"))
    sample = with_features(drawn.orderBy(order, "url", "label").limit(settings.rows)).select("*", fold)
    for k in SUFFIXES:
        others = counts.join(sums, ["k", "suffix"]).where(F.col("k") == k).select(
            F.col("suffix").alias(f"suffix_{k}"), "fold",
            ((F.col("all_blocked") - F.col("blocked") + settings.weight * overall) / (F.col("all_rows") - F.col("rows") + settings.weight)).alias(f"share_{k}"),
            F.log1p(F.col("all_rows") - F.col("rows")).alias(f"weight_{k}"),
        )
        sample = sample.join(others, [f"suffix_{k}", "fold"], "left").fillna({f"share_{k}": overall, f"weight_{k}": 0.0})
    sample = stage(sample.withColumn("y", (F.col("label") == "block").cast("double")), "url-sample")
    # One task with a fixed order of rows, so that sums and with them the trees come out alike in every run.
    fitted = GBTClassifier(
        labelCol="y", weightCol="n", maxIter=settings.trees, maxDepth=settings.depth, stepSize=settings.step, minInstancesPerNode=5, seed=settings.seed
    ).fit(assembled(sample.coalesce(1).sortWithinPartitions("url", "label")))
    return UrlModel(fitted, stage(of_all, "suffix-shares"), overall)


def url_filter(
    pages: DataFrame, rules: list[Rule], model: UrlModel | None, id_col: str = "page_id", url_col: str = "url",
) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict, blocked.

    ``verdict`` is the rule's, else block where the model gives a probability above one half, else allow; ``blocked`` is
    that probability, null where a rule decides or there is no model (then the rest is allowed). Null, empty and relative
    URLs have empty host and path, so no rule fits them, and the model judges what text there is. Null ids stay null,
    rows that repeat an id are judged each; an empty table gives no rows; further columns are not read. One narrow
    stage and one join per suffix length, whose sides move as measured sizes demand; only the URL is read.
    """
    host, path = split_url(column(pages, url_col))
    rows = pages.select(
        column(pages, id_col).alias("page_id"), F.coalesce(column(pages, url_col).cast("string"), F.lit("")).alias("url"),
        host.alias("host"), path.alias("path"),
    )
    name, verdict = ruled(F.col("host"), F.col("path"), rules)
    rows = rows.select("*", name.alias("rule"), verdict.alias("fixed"))
    judged = model.judge(rows) if model else rows.withColumn("blocked", F.lit(None).cast("double"))
    by_model = F.when(F.col("blocked") > 0.5, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("fixed", by_model).alias("verdict"),
        F.when(F.col("rule").isNull(), F.col("blocked")).alias("blocked"),
    )


def labelled_by_rules(pages: DataFrame, rules: list[Rule], url_col: str = "url") -> DataFrame:
    """url, label of the pages that a rule decides."""
    host, path = split_url(column(pages, url_col))
    _, verdict = ruled(host, path, rules)
    return pages.select(column(pages, url_col).cast("string").alias("url"), verdict.alias("label")).where("label IS NOT NULL")
