"""Reconcile by range digests: what differs between a source and its target, without moving what is equal.

Both sides are cut into ranges of their keys. A range has a digest on either side: its rows and the sum of the hashes of
their keys and checksums, which no order of rows changes. Ranges with unlike digests are cut again, finer, and only rows
of fine ranges that still differ are compared one by one. Sums are made before anything moves, so equal ranges cost
their scan and one row; where the key of the source is a number, later scans are bounded by the open ranges.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators import keyset, quality
from tidemark.operators.curate import clean_table, with_checksum
from tidemark.operators.merge import INSERT, UPDATE, dedupe_last
from tidemark.session import new_dir
from tidemark.specs import TableSpec

REMOVED = "removed"  # in the target only
RANGES = 4096  # ranges of the first cut, at most: their digests come to the driver
FINER = 8  # bits by which an open range is cut again: into 256
BOUNDS = 64  # intervals a later scan is bounded by; nearest ones are taken together


def place(spec: TableSpec) -> Column:
    """Where a row lies: its key as a number, or the hash of a text key. Null for text that is no number."""
    key = F.col(spec.key.target)
    return F.xxhash64(key) if spec.key_order == "text" else key.try_cast("long")


def good_rows(source: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleaned rows of the source without those to be rejected.

    Rows are counted between cleaning and filter: Spark would push the filter below the cleaning, and clean every value
    again for each place where the filter reads it.
    """
    cleaned = clean_table(source, spec).withColumn("_reason", quality.reject_reason(spec))
    return cleaned.observe(f"cleaned-{uuid.uuid4().hex}", F.count(F.lit(1)).alias("rows")).where("_reason IS NULL")


def hashed(source: DataFrame, spec: TableSpec, odd: bool) -> DataFrame:
    """Key, checksum and arrival of the source's good rows.

    Without ``odd`` the checksum is null where Spark alone can't make it; with it only those rows go through Python.
    """
    quick = with_checksum(good_rows(source, spec), spec, exact=False)
    columns = [spec.key.target, "checksum", "_seq"]
    if not odd:
        return quick.select(columns)
    exact = with_checksum(quick.where("checksum IS NULL").drop("checksum"), spec)
    return quick.where("checksum IS NOT NULL").select(columns).unionByName(exact.select(columns))


def digests(rows: DataFrame, spec: TableSpec, bits: int) -> DataFrame:
    """p, n, s, odd: of each range of 2^bits places its rows, the sum of their hashes, and how many have no checksum."""
    h = F.xxhash64(spec.key.target, "checksum").cast("decimal(20,0)")
    return rows.groupBy(F.shiftright(place(spec), bits).alias("p")).agg(
        F.count("*").alias("n"), F.sum(h).alias("s"), F.count_if(F.col("checksum").isNull()).alias("odd")
    )


def unlike(a: DataFrame, b: DataFrame) -> DataFrame:
    """p of the ranges whose digests differ, and n, their rows on the first side."""
    a, b = a.alias("a"), b.alias("b")
    differs = ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.s").eqNullSafe(F.col("b.s")))
    joined = a.join(b, F.col("a.p").eqNullSafe(F.col("b.p")), "full").where(differs)
    return joined.select(F.coalesce("a.p", "b.p").alias("p"), F.coalesce("a.n", F.lit(0)).alias("n"))


def intervals(ranges: list[int], bits: int, most: int = BOUNDS) -> list[tuple[int, int]]:
    """Ranges as intervals of places, both ends included; the smallest gaps are closed until ``most`` are left."""
    found = [[p, p] for p in sorted(ranges)]
    gaps = sorted(range(1, len(found)), key=lambda k: found[k][0] - found[k - 1][1])
    joined = {k for n, k in enumerate(gaps) if n < len(found) - most or found[k][0] - found[k - 1][1] == 1}
    out: list[list[int]] = []
    for k, (low, high) in enumerate(found):
        if k in joined:
            out[-1][1] = high
        else:
            out.append([low, high])
    return [(low << bits, (high + 1 << bits) - 1) for low, high in out]


@dataclass(frozen=True)
class Open:
    """Ranges that differ: a written table of p, cut by ``bits``, and the intervals they lie in. As it is written Spark
    knows its size, and takes it to the rows where it is small."""

    ranges: DataFrame
    bits: int
    bounds: list[tuple[int, int]]
    odd: bool

    def rows(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """Rows (by their cleaned key) of open ranges."""
        p = F.shiftright(place(spec), self.bits)
        return df.join(self.ranges.withColumnRenamed("p", "_p"), p.eqNullSafe(F.col("_p")), "left_semi")

    def source(self, df: DataFrame, spec: TableSpec) -> DataFrame:
        """Source rows within the bounds: a superset of the open ranges, which the scan is told where keys are numbers."""
        if spec.key_order == "text":
            return df
        rows, key, unordered = keyset._ordered(df, spec)
        inside = unordered
        for low, high in self.bounds:
            inside = inside | key.between(low, high)
        return rows.where(inside).toDF(*df.columns)


def open_ranges(source: DataFrame, target: DataFrame, spec: TableSpec, most: int = RANGES) -> Open | None:
    """Where source and target differ; None where they are equal.

    The first cut has at most ``most`` ranges between the least and the highest key of both sides; a text key is cut by
    its hash. Where those that differ hold more than half of the source's rows they are not cut again: that would clean
    and hash nearly all of it once more, to spare a merge few of its rows. Keys that occur several times in the source make their ranges differ, and are told apart row by row.
    """
    key, spark = spec.key.target, source.sparkSession
    stored = target.select(key, "checksum")
    ours = hashed(source, spec, False)
    if spec.key_order == "text":
        low, high = -(1 << 63), (1 << 63) - 1
    else:
        raw, number, _ = keyset._ordered(source, spec)
        ends = raw.select(number.cast("long").alias("k")).unionByName(stored.select(place(spec).alias("k"))).agg(F.min("k"), F.max("k")).first()
        low, high = (0, 0) if ends[0] is None else ends
    bits = next(b for b in range(64) if (high >> b) - (low >> b) < most)

    def written(df: DataFrame, label: str) -> DataFrame:
        path = new_dir(spark, label)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    theirs = written(digests(stored, spec, bits), "target-digests")
    own = written(digests(ours, spec, bits), "source-digests")
    odd, rows = own.agg(F.coalesce(F.sum("odd"), F.lit(0)) > 0, F.coalesce(F.sum("n"), F.lit(0))).first()
    if odd:
        own = digests(hashed(source, spec, True), spec, bits)
    found = unlike(own, theirs).collect()
    if not found:
        return None
    first = [r.p for r in found]
    listed = spark.createDataFrame([(p,) for p in first], "p long").coalesce(1)
    coarse = Open(written(listed, "coarse-ranges"), bits, intervals([p for p in first if p is not None], bits), odd)
    if not bits or 2 * sum(r.n for r in found) > rows:
        return coarse
    finer = max(0, bits - FINER)
    narrow = coarse.rows(hashed(coarse.source(source, spec), spec, odd), spec)
    ranges = unlike(digests(narrow, spec, finer), digests(coarse.rows(stored, spec), spec, finer)).select("p")
    return Open(written(ranges, "open-ranges"), finer, coarse.bounds, odd)


def differences(source: DataFrame, target: DataFrame, spec: TableSpec, most: int = RANGES) -> DataFrame:
    """Key and ``difference`` of every key that differs: insert (source only), update, or removed (target only)."""
    key = spec.key.target
    found = open_ranges(source, target, spec, most)
    if found is None:
        return source.sparkSession.createDataFrame([], f"{key} string, difference string")
    ours = dedupe_last(found.rows(hashed(found.source(source, spec), spec, found.odd), spec), key, ["_seq", "checksum"])
    theirs = found.rows(target.select(key, F.col("checksum").alias("_old")), spec)
    kind = (
        F.when(F.col("_old").isNull(), INSERT).when(F.col("checksum").isNull(), REMOVED)
        .when(F.col("_old") != F.col("checksum"), UPDATE)
    )
    joined = ours.select(key, "checksum").join(theirs, key, "full")
    return joined.select(key, kind.alias("difference")).where("difference IS NOT NULL")
