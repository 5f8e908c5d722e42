"""Scans by key checkpoint and bounded chunks in key order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions.text import INTEGRAL
from tidemark.operators.curate import keyed
from tidemark.specs import TableSpec

# Ranges that a key interval is divided into while the end of a chunk is searched.
RANGES = 4096


def _ordered(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Column, Column]:
    """The source by position, the key in its comparison type, and a predicate for keys
    that have no value in that type.

    A numeric key column is compared as it is, so the predicate reaches the source.
    """
    rows, key, dtype = keyed(df, spec)
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        raise ValueError(f"{spec.source_table}: a floating-point key has no exact order; cast it to a whole number or text")
    numeric = isinstance(dtype, INTEGRAL) or isinstance(dtype, T.DecimalType) and dtype.scale == 0
    if spec.key_order == "text":
        return rows, (key.cast("string") if numeric else key), F.lit(False)
    if numeric:
        return rows, key, F.lit(False)
    number = F.trim(key.cast("string")).try_cast("long")
    return rows, number, number.isNull() & key.isNotNull()


def _above(key: Column, spec: TableSpec, last: str | None) -> Column:
    if last is None:
        return F.lit(True)
    return key > F.lit(int(last) if spec.key_order == "long" else last)


def after(df: DataFrame, spec: TableSpec, last: str | None) -> DataFrame:
    """Rows with a key above the checkpoint; all rows where there is no checkpoint.

    Text keys that are no numbers have no place in numeric order: they are read every
    time, as a merge by checksum makes a second read harmless.
    """
    if last is None:
        return df
    rows, key, unordered = _ordered(df, spec)
    return rows.where(_above(key, spec, last) | unordered).toDF(*df.columns)


def chunk(
    df: DataFrame, spec: TableSpec, last: str | None, limit: int
) -> tuple[DataFrame, str | None]:
    """The first ``limit`` rows above the checkpoint in key order, and the key they end at:
    None where fewer rows are left.

    The end is found by counting on the key column alone, then the full rows are read between
    two pushed-down bounds. Rows that share the last key stay together.
    """
    rows, key, unordered = _ordered(df, spec)
    above = _above(key, spec, last)
    keys = rows.where(above).select(key.alias("k")).where("k IS NOT NULL")
    end = _nth(keys, limit)
    if end is None:
        return after(df, spec, last), None
    picked = rows.where((above & (key <= F.lit(end))) | unordered)
    return picked.toDF(*df.columns), str(end)


def _nth(keys: DataFrame, n: int):
    """The n-th smallest of the column k, None where there are fewer.

    Rows are counted per range of keys and the range that holds the n-th is counted again in
    finer ranges, until it holds one key only: each pass is one scan of the key column and one
    small aggregation, whatever ``n`` is. Text keys are cut at sampled quantiles instead, as
    ranges can't be computed from their ends.
    """
    whole = isinstance(keys.schema["k"].dataType, (*INTEGRAL, T.DecimalType))
    while True:
        found = keys.agg(F.count("k").alias("n"), F.min("k").alias("low"), F.max("k").alias("high")).first()
        if found.n < n:
            return None
        if found.low == found.high or found.n == n:
            return found.high
        if whole:
            low, high = int(found.low), int(found.high)
            width = -(-(high - low + 1) // RANGES)
            place = F.floor((F.col("k").cast("decimal(38,0)") - F.lit(low).cast("decimal(38,0)")) / width)
        else:
            cuts = sorted({r.k for r in keys.sample(min(1.0, 4 * RANGES / found.n), seed=1).limit(4 * RANGES).collect()})
            cuts = sorted({found.low, *cuts[:: max(1, len(cuts) // 256)]})
            place = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("k")))
        counts = keys.groupBy(place.alias("p")).agg(F.count("*").alias("n"), F.min("k").alias("low"), F.max("k").alias("high"))
        for r in sorted(counts.collect(), key=lambda r: r.p):
            if n <= r.n:
                keys = keys.where(F.col("k").between(F.lit(r.low), F.lit(r.high)))
                break
            n -= r.n


def key_value(spec: TableSpec) -> Column:
    """The cleaned key of a mapped row in the type its checkpoint compares in."""
    key = F.col(spec.key.target)
    return key.try_cast("long") if spec.key_order == "long" else key
