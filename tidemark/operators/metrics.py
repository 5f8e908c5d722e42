"""Lag, counters and duration histograms over results of sync tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.functions import parse_timestamp
from tidemark.operators.curate import curate
from tidemark.operators.state import FAILED, SUCCESS
from tidemark.specs import TableSpec

# Alert threshold and upper bounds of the duration buckets, in seconds.
LAG_THRESHOLD_MINUTES = 120
DURATION_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0, float("inf"))


def sync_lag(source: DataFrame, target: DataFrame, spec: TableSpec) -> DataFrame:
    """Minutes by which the target is behind the source; no row where either is empty.

    Source dates are parsed before the maximum is taken, so mixed text forms compare.
    """
    dates = curate(source, spec).select(spec.date.target)
    parsed = parse_timestamp(F.col(spec.date.target), dates.schema[0].dataType)
    newest = dates.agg(F.max(parsed).alias("source_max"))
    stored = target.agg(F.max("created_at").alias("target_max"))
    minutes = (F.unix_micros("source_max") - F.unix_micros("target_max")) / 60e6
    return (
        newest.crossJoin(stored)  # one row each
        .where("source_max IS NOT NULL AND target_max IS NOT NULL")
        .select(
            F.lit(spec.source_table).alias("table_name"),
            "source_max",
            "target_max",
            F.greatest(F.lit(0.0), minutes).alias("lag_minutes"),
        )
    )


def lag_alerts(lags: DataFrame, threshold: float = LAG_THRESHOLD_MINUTES) -> DataFrame:
    return lags.where(F.col("lag_minutes") > threshold).select(
        F.lit("lag threshold exceeded").alias("alert_type"),
        "table_name",
        "lag_minutes",
        F.lit(float(threshold)).alias("threshold"),
    )


def task_counts(classified: DataFrame, rejected: DataFrame, table: str, mode: str) -> DataFrame:
    """Counters of one task: rows scanned, upserted by kind, and in error."""
    kinds = classified.agg(
        F.count("*").alias("upserted"),
        *[F.count_if(F.col("change_type") == k).alias(n)
          for k, n in (("insert", "inserted"), ("update", "updated"), ("unchanged", "unchanged"))],
    )
    errors = rejected.agg(F.count("*").alias("errors"))
    return kinds.crossJoin(errors).select(  # one row each
        F.lit(table).alias("table_name"),
        F.lit(mode).alias("mode"),
        (F.col("upserted") + F.col("errors")).alias("scanned"),
        "upserted", "inserted", "updated", "unchanged", "errors",
    )


def upserted() -> "F.Column":
    """Rows a task offered to the target, changed or not."""
    return F.col("inserted") + F.col("updated") + F.col("unchanged") + F.col("superseded")


def cycle_rollup(tasks: DataFrame, durations: DataFrame) -> DataFrame:
    """Totals per cycle. A cycle succeeds only without row errors and failed tasks."""
    failed = F.when(F.col("error").isNotNull(), F.format_string("%s (%s)", "table_name", "mode"))
    totals = tasks.groupBy("cycle_id").agg(
        F.sum("scanned").alias("rows_scanned"),
        F.sum(upserted()).alias("rows_updated"),
        F.sum("errors").alias("rows_failed"),
        # Tasks of a cycle are a handful by construction: one per table and mode.
        F.concat_ws(", ", F.array_sort(F.collect_list(failed))).alias("failed_tasks"),
    )
    clean = (F.col("rows_failed") == 0) & (F.col("failed_tasks") == "")
    speed = F.when(F.col("duration") > 0, F.col("rows_scanned") / F.col("duration")).otherwise(0.0)
    return totals.join(durations.select("cycle_id", "duration"), "cycle_id", "left").select(
        "cycle_id",
        "rows_scanned",
        "rows_updated",
        "rows_failed",
        "failed_tasks",
        F.round("duration", 2).alias("duration_sec"),
        F.round(speed, 2).alias("rows_per_sec"),
        F.when(clean, SUCCESS).otherwise(FAILED).alias("status"),
    )


def row_counters(tasks: DataFrame) -> DataFrame:
    """Rows per table, mode and status; failures also as errors of type row_failure.

    A failed counter exists only where something failed.
    """
    sums = tasks.groupBy("table_name", "mode").agg(
        F.sum(upserted()).alias("success"), F.sum("errors").alias("failed")
    )
    flat = sums.select(
        "table_name",
        "mode",
        F.expr(
            "stack(3, 'rows', 'success', success, 'rows', 'failed', failed,"
            " 'errors', 'row_failure', failed) AS (counter, label, value)"
        ),
    )
    return flat.where("label = 'success' OR value > 0")


def duration_histogram(
    observed: DataFrame, by: Sequence[str], buckets: Sequence[float] = DURATION_BUCKETS
) -> DataFrame:
    """Cumulative counts per bucket with sum and count, for a ``duration`` column.

    All buckets are counted in one aggregation; only its small result is unpivoted.
    """
    names = [f"b{i}" for i in range(len(buckets))]
    counted = observed.groupBy(*by).agg(
        *[F.count_if(F.col("duration") <= F.lit(b)).alias(n) for n, b in zip(names, buckets)],
        F.sum("duration").alias("duration_sum"),
        F.count("duration").alias("duration_count"),
    )
    pairs = ", ".join(f"CAST('{b}' AS DOUBLE), {n}" for n, b in zip(names, buckets))
    return counted.select(
        *by, F.expr(f"stack({len(names)}, {pairs}) AS (le, bucket_count)"), "duration_sum", "duration_count"
    )
