"""Keyed merge that touches only rows whose checksum differs."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.dates import clock
from tidemark.specs import FINGERPRINT_SCHEMA, TableSpec

INSERT, UPDATE, UNCHANGED, DELETE = "insert", "update", "unchanged", "delete"


def dedupe_last(df: DataFrame, key: str, order: Sequence[str | Column]) -> DataFrame:
    """The last row of each key by ``order``.

    Spark keeps one row per key and map task before the shuffle, so a key that holds much
    of the data does not end up whole in one task.
    """
    newest = [(F.col(o) if isinstance(o, str) else o).desc_nulls_last() for o in order]
    window = Window.partitionBy(key).orderBy(*newest)
    return df.withColumn("_n", F.row_number().over(window)).where("_n = 1").drop("_n")


def classify(source: DataFrame, target: DataFrame, key: str, newer: DataFrame | None = None) -> DataFrame:
    """Source rows (one per key) with ``change_type`` and ``old_created_at`` of the target.

    ``newer`` are rows that stand in place of those of the target; with it come ``old_raw_id`` and no union of both.
    The joins carry no hint: adaptive execution broadcasts a side whose measured size allows it.
    """
    olds = {"_old_checksum": "checksum", "old_created_at": "created_at"}
    if newer is not None:
        olds["old_raw_id"] = "raw_id"
    joined = source.join(target.select(key, *[F.col(c).alias(n) for n, c in olds.items()]), key, "left")
    if newer is not None:
        joined = joined.join(newer.select(key, *[F.col(c).alias(f"_new_{n}") for n, c in olds.items()]), key, "left")
        for n in ("old_created_at", "old_raw_id", "_old_checksum"):
            held = F.col("_new__old_checksum").isNotNull()
            joined = joined.withColumn(n, F.when(held, F.col(f"_new_{n}")).otherwise(F.col(n)))
        joined = joined.drop(*[f"_new_{n}" for n in olds])
    kind = (
        F.when(F.col("_old_checksum").isNull(), INSERT)
        .when(F.col("_old_checksum") != F.col("checksum"), UPDATE)
        .otherwise(UNCHANGED)
    )
    return joined.withColumn("change_type", kind).drop("_old_checksum")


def stamp(changed: DataFrame, spec: TableSpec, run_ts: datetime) -> DataFrame:
    """Run times of changed rows: a transaction date first, then the stored one, then now."""
    now = clock(run_ts)
    out = changed.withColumn("created_at", F.coalesce("created_at", "old_created_at", now))
    return out.withColumn("updated_at", now) if spec.has_updated_at else out


def upsert_changed(
    target: DataFrame, source: DataFrame, spec: TableSpec, run_ts: datetime
) -> DataFrame:
    """The whole target after the merge, each row with its ``change_type``.

    Rows not in the source and rows with an equal checksum come out as they were. A target that is bucketed and sorted
    by its key, as ``TableStore`` keeps it, is neither moved nor sorted; only the source is.
    """
    key = spec.key.target
    columns = spec.raw_schema.fieldNames()
    old = F.struct(*[F.col(f"t.{c}").alias(c) for c in columns])
    now = clock(run_ts)
    fresh = {c: F.col(f"s.{c}") for c in columns if c != "updated_at"}
    fresh["created_at"] = F.coalesce("s.created_at", "t.created_at", now)
    fresh["raw_id"] = F.coalesce("t.raw_id", "s.raw_id")
    if spec.has_updated_at:
        fresh["updated_at"] = now
    new = F.struct(*[fresh[c].alias(c) for c in columns])
    kind = (
        F.when(F.col(f"t.{key}").isNull(), INSERT)
        .when(F.col("t.checksum") != F.col("s.checksum"), UPDATE)
        .otherwise(UNCHANGED)
    )
    joined = target.alias("t").join(source.alias("s"), F.col(f"t.{key}") == F.col(f"s.{key}"), "full")
    merged = joined.select(kind.alias("change_type"), old.alias("old"), new.alias("new"))
    row = F.when(F.col("change_type") == UNCHANGED, F.col("old")).otherwise(F.col("new"))
    return merged.select("change_type", row.alias("r")).select("r.*", "change_type")


def upsert_fingerprints(
    old: DataFrame, seen: DataFrame, table: str, run_ts: datetime, apart: bool = False, newer: DataFrame | None = None
) -> DataFrame:
    """The whole fingerprint table after a batch: one join, each side moved once.

    First times are kept, change times move only when the checksum differs. ``seen`` is (entity_id, checksum), one row
    per key. ``apart`` tells that ``old`` holds this table only; if it is bucketed by entity_id it is not moved at all.
    With ``newer``, rows that stand in place of those of ``old``, only the rows of seen keys come out.
    """
    now = clock(run_ts)
    new = seen.select(F.lit(table).alias("table_name"), "entity_id", F.col("checksum").alias("_new"))
    kept = ["checksum", "first_seen_at", "last_seen_at", "last_changed_at"]
    if newer is not None:
        late = newer.select("entity_id", *[F.col(c).alias(f"_{c}") for c in kept])
        joined = new.join(old.drop("table_name"), "entity_id", "left").join(late, "entity_id", "left")
        held = F.col("_checksum").isNotNull()
        joined = joined.withColumns({c: F.when(held, F.col(f"_{c}")).otherwise(F.col(c)) for c in kept})
    elif apart:
        joined = old.drop("table_name").join(new.drop("table_name"), "entity_id", "full").withColumn("table_name", F.lit(table))
    else:
        joined = old.join(new, ["table_name", "entity_id"], "full")
    found, same = F.col("_new").isNotNull(), F.col("_new").eqNullSafe(F.col("checksum"))
    return joined.select(
        "table_name",
        "entity_id",
        F.coalesce("_new", "checksum").alias("checksum"),
        F.coalesce("first_seen_at", now).alias("first_seen_at"),
        F.when(found, now).otherwise(F.col("last_seen_at")).alias("last_seen_at"),
        F.when(~found | same, F.col("last_changed_at")).otherwise(now).alias("last_changed_at"),
    ).to(FINGERPRINT_SCHEMA)


def first_fingerprints(seen: DataFrame, table: str, run_ts: datetime) -> DataFrame:
    """Fingerprints of (entity_id, checksum), one row per key, where there are none yet."""
    times = [clock(run_ts).alias(c) for c in ("first_seen_at", "last_seen_at", "last_changed_at")]
    return seen.select(F.lit(table).alias("table_name"), "entity_id", "checksum", *times).to(FINGERPRINT_SCHEMA)


def fingerprint_delta(rows: DataFrame, fingerprints: DataFrame, table: str, key: str) -> DataFrame:
    """Rows that were not already seen with this checksum."""
    seen = fingerprints.where(F.col("table_name") == table).select(
        F.col("entity_id").alias(key), "checksum"
    )
    return rows.join(seen, [key, "checksum"], "left_anti")
