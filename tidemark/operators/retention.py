"""Removal of rows that a downstream consumer has marked processed."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import clock
from tidemark.specs import TableSpec


def is_prunable(spec: TableSpec, as_of: datetime, days: int = 0) -> Column:
    """Processed and older than the retention; false where either side is unknown."""
    limit = clock(as_of - timedelta(days=days))
    old = F.col("is_processed") & (F.col(spec.prune_clock) < limit)
    return F.coalesce(old, F.lit(False))


def prune(target: DataFrame, spec: TableSpec, as_of: datetime, days: int = 0) -> DataFrame:
    """The rows that stay."""
    return target.where(~is_prunable(spec, as_of, days))


def prune_counts(target: DataFrame, spec: TableSpec, as_of: datetime, days: int = 0) -> DataFrame:
    """One row: table, rows pruned, rows kept."""
    gone = is_prunable(spec, as_of, days)
    return target.agg(
        F.count_if(gone).alias("pruned"), F.count_if(~gone).alias("kept")
    ).select(F.lit(spec.target_table).alias("table_name"), "pruned", "kept")
