"""Checkpoints and the run log as small tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from tidemark.functions.dates import clock
from tidemark.specs import CHECKPOINT_SCHEMA, RUN_SCHEMA

RUNNING, SUCCESS, FAILED, INTERRUPTED = "RUNNING", "SUCCESS", "FAILED", "INTERRUPTED"


def advance_checkpoints(old: DataFrame, new: DataFrame, at: datetime) -> DataFrame:
    """Checkpoints after an update; a NULL in the update keeps the stored value.

    ``new`` is (table_name, last_sync_key, last_reconcile_key, cycle_id, status,
    reset_reconcile); ``reset_reconcile`` starts the rolling re-read from the beginning.
    """
    now = clock(at)
    touched = F.col("n.table_name").isNotNull()
    reconcile = F.when(~F.coalesce("n.reset_reconcile", F.lit(False)),
                       F.coalesce("n.last_reconcile_key", "o.last_reconcile_key"))
    joined = old.alias("o").join(new.alias("n"), F.col("o.table_name") == F.col("n.table_name"), "full")
    return joined.select(
        F.coalesce("o.table_name", "n.table_name").alias("table_name"),
        F.coalesce("n.last_sync_key", "o.last_sync_key").alias("last_sync_key"),
        reconcile.alias("last_reconcile_key"),
        F.when(touched, now).otherwise(F.col("o.last_sync_timestamp")).alias("last_sync_timestamp"),
        F.coalesce("n.cycle_id", "o.cycle_id").alias("cycle_id"),
        F.coalesce("n.status", "o.status").alias("status"),
        F.when(touched, now).otherwise(F.col("o.updated_at")).alias("updated_at"),
    ).to(CHECKPOINT_SCHEMA)


def checkpoint_inventory(checkpoints: DataFrame) -> DataFrame:
    return checkpoints.agg(
        F.count("*").alias("checkpoints"),
        F.min("last_sync_timestamp").alias("oldest"),
        F.max("last_sync_timestamp").alias("newest"),
    )


def open_runs(log: DataFrame, starts: DataFrame) -> DataFrame:
    """Append runs (cycle_id, start_time) with status RUNNING."""
    rows = starts.select("cycle_id", "start_time", F.lit(RUNNING).alias("status"))
    return log.unionByName(rows, allowMissingColumns=True).select(RUN_SCHEMA.fieldNames()).to(RUN_SCHEMA)


def close_runs(log: DataFrame, results: DataFrame) -> DataFrame:
    """Set end, duration, counts and status of the runs in ``results``."""
    changed = ["end_time", "duration", "rows_scanned", "rows_updated", "rows_failed", "status"]
    joined = log.alias("l").join(results.alias("r"), "cycle_id", "left")
    return joined.select(
        "cycle_id",
        "l.start_time",
        *[F.coalesce(f"r.{c}", f"l.{c}").alias(c) for c in changed],
    ).to(RUN_SCHEMA)


def interrupt_stale_runs(log: DataFrame, at: datetime) -> DataFrame:
    """Runs left RUNNING by an earlier process become INTERRUPTED."""
    stale = F.col("status") == RUNNING
    return log.withColumns(
        {
            "end_time": F.when(stale, clock(at)).otherwise(F.col("end_time")),
            "status": F.when(stale, F.lit(INTERRUPTED)).otherwise(F.col("status")),
        }
    )
