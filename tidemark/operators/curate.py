"""Curated projection and row mapping: one narrow job per table, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.functions import (
    as_text,
    clean_text,
    decode_binary_timestamp,
    parse_amount,
    parse_flag,
    parse_timestamp,
)
from tidemark.functions.dates import TEMPORAL, date_of_typed
from tidemark.functions.identity import row_id, with_canonical
from tidemark.specs import AMOUNT, DATE_TEXT, FLAG, TableSpec


def _by_position(df: DataFrame) -> DataFrame:
    """Columns renamed by position, so that names that differ only in case can coexist."""
    return df.toDF(*[f"_s{i}" for i in range(len(df.columns))])


def _resolve(df: DataFrame, name: str) -> tuple[Column, T.DataType]:
    """A source column by tolerant name: exact spelling first, any case otherwise, NULL
    where there is none. Where both exist a NULL in the exact one falls back."""
    headers = [c.strip() for c in df.columns]
    types = [f.dataType for f in df.schema]
    exact = [i for i, h in enumerate(headers) if h == name]
    folded = [i for i, h in enumerate(headers) if h.lower() == name.lower()]
    if not folded:
        return F.lit(None).cast("string"), T.StringType()
    picks = list(dict.fromkeys(exact[-1:] + folded[-1:]))
    if len({types[i] for i in picks}) == 1:
        return F.coalesce(*[F.col(f"_s{i}") for i in picks]), types[picks[0]]
    return F.coalesce(*[as_text(F.col(f"_s{i}"), types[i]) for i in picks]), T.StringType()


def curate(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Pick and rename the columns of the spec; values stay as they are."""
    picked = [_resolve(df, f.source)[0].alias(f.target) for f in spec.fields]
    return _by_position(df).select(*picked)


def keyed(df: DataFrame, spec: TableSpec) -> tuple[DataFrame, Column, T.DataType]:
    """The source with columns named by position, its key column and the key's type.

    ``toDF(*df.columns)`` gives the names back; filters in between still reach the scan.
    """
    if spec.key.source.lower() not in {c.strip().lower() for c in df.columns}:
        raise ValueError(f"{spec.source_table} has no key column {spec.key.source}")
    return _by_position(df), *_resolve(df, spec.key.source)


def clean_table(df: DataFrame, spec: TableSpec, payload: bool = False) -> DataFrame:
    """Entity columns of the spec, cleaned by kind, and ``created_at`` from the row's date.

    ``_raw_key`` is the key text before cleaning and ``_seq`` the arrival order. With
    ``payload`` the whole source row is added as JSON; without it unused source columns
    are not even read.
    """
    resolved = {f.target: _resolve(df, f.source) for f in spec.fields}
    picked = [c.alias(t) for t, (c, _) in resolved.items()]
    key, key_type = resolved[spec.key.target]
    picked.append(as_text(key, key_type).alias("_raw_key"))
    order = [_resolve(df, s)[0] for s in spec.seq]
    picked.append(F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)] or [F.lit(0)]).alias("_seq"))
    if payload:
        row = F.struct(*[F.col(f"_s{i}").alias(c.strip()) for i, c in enumerate(df.columns)])
        picked.append(F.to_json(row, {"ignoreNullFields": "false"}).alias("_payload"))
    out = _by_position(df).select(*picked)

    cleaned, created_at = {}, F.lit(None).cast("timestamp")
    for f in spec.fields:
        c, dtype = F.col(f.target), resolved[f.target][1]
        if f.kind == FLAG:
            cleaned[f.target] = parse_flag(c, dtype)
        elif f.kind == AMOUNT:
            cleaned[f.target] = parse_amount(c, dtype)
        else:
            cleaned[f.target] = clean_text(c, dtype)
        if f.kind == DATE_TEXT and isinstance(dtype, TEMPORAL):
            out = out.withColumn("_date", date_of_typed(c))
            created_at = F.col("_date")
        elif f.kind == DATE_TEXT:
            decoded = decode_binary_timestamp(c, dtype)
            cleaned[f.target] = F.coalesce(decoded, cleaned[f.target])
            created_at = parse_timestamp(c)
    # The date is parsed from its cleaned text, one projection later.
    return out.withColumns(cleaned).withColumn("created_at", created_at).drop("_date")


def with_checksum(df: DataFrame, spec: TableSpec, exact: bool = True) -> DataFrame:
    """Add the SHA-256 of the canonical row, over the entity columns only.

    Without ``exact`` it is NULL for the few rows that Spark alone cannot do.
    """
    columns = [(f.target, f.kind) for f in spec.fields]
    out = with_canonical(df, columns, into="_canonical", exact=exact, stripped=True)
    return out.withColumn("checksum", F.sha2("_canonical", 256)).drop("_canonical")


def with_ingestion(
    df: DataFrame, spec: TableSpec, source_system: str, exact: bool = True
) -> DataFrame:
    """Add checksum, row id and constants to cleaned rows."""
    return with_ids(with_checksum(df, spec, exact), spec, source_system)


def with_ids(df: DataFrame, spec: TableSpec, source_system: str) -> DataFrame:
    """Add what follows from the key: row id and constants."""
    if not source_system:
        raise ValueError("source_system is required")
    return df.withColumns(
        {
            "raw_id": row_id(spec.source_table, F.col(spec.key.target)),
            "source_system": F.lit(source_system),
            "is_processed": F.lit(False),
        }
    )


def map_to_raw(df: DataFrame, spec: TableSpec, source_system: str) -> DataFrame:
    """Source rows as target rows, before the merge adds the run times."""
    names = [f.name for f in spec.raw_schema if f.name != "updated_at"]
    return with_ingestion(clean_table(df, spec), spec, source_system).select(*names)
