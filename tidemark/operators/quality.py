"""Row validation: good rows go on, bad rows go to the dead-letter table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.dates import clock
from tidemark.operators.curate import clean_table
from tidemark.specs import AMOUNT, FAILURE_SCHEMA, FLAG, TableSpec

NULL_KEY = "key is null after cleaning"


def reject_reason(spec: TableSpec) -> Column:
    """Why a cleaned row cannot be stored: NULL for a good row, one reason otherwise."""
    reasons = [F.when(F.col(spec.key.target).isNull(), F.lit(NULL_KEY))]
    for f in spec.fields:
        if f.kind not in (AMOUNT, FLAG):
            has_nul = F.col(f.target).contains("\x00")
            reasons.append(F.when(has_nul, F.lit(f"NUL character in {f.target}")))
    for reason, predicate in spec.checks:
        reasons.append(F.when(~F.coalesce(F.expr(predicate), F.lit(True)), F.lit(reason)))
    return F.coalesce(*reasons)


def dead_letters(df: DataFrame, spec: TableSpec, at: datetime) -> DataFrame:
    """The rejected rows of a source with reason and whole source row as JSON."""
    bad = clean_table(df, spec, payload=True).withColumn("error", reject_reason(spec))
    return (
        bad.where("error IS NOT NULL")
        .select(
            F.lit(spec.source_table).alias("source_table"),
            F.coalesce("_raw_key", F.lit("None")).alias("primary_key"),
            "error",
            F.col("_payload").alias("payload"),
            F.lit(0).alias("retry_count"),
            clock(at).alias("timestamp"),
        )
        .to(FAILURE_SCHEMA)
    )
