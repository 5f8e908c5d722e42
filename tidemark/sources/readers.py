"""Source tables from files or JDBC, queries with parameters, and table probes."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.functions.text import as_text


def read_files(
    spark: SparkSession, path: str, format: str = "parquet", schema: T.StructType | None = None, **options: str
) -> DataFrame:
    """A source table from parquet, orc, csv or json files. Text formats need a schema."""
    if format in ("csv", "json") and schema is None:
        raise ValueError("text formats need a schema: inferring one reads the data twice")
    reader = spark.read.format(format).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 32,
    **options: str,
) -> DataFrame:
    """A source table over JDBC; key predicates are pushed into the database.

    ``key`` and ``bounds`` split the read into ranges, so that it is not one task.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, fetchsize="10000", **options)
    if key and bounds:
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()


def sql_source(
    spark: SparkSession, query: str, args: Mapping[str, Any] | None = None, **views: DataFrame
) -> DataFrame:
    """Result of a query with ``:name`` parameters over frames written as ``{name}``."""
    return spark.sql(query, args=dict(args or {}), **views)


def table_probe(df: DataFrame, table: str, key: str) -> DataFrame:
    """One row per column: position, name, type, and its value in the row with the smallest key.

    That key is found on the key column alone; the row is then read by a pushed-down predicate.
    """
    fields = df.schema.fields
    least = df.agg(F.min(key)).first()[0]
    first = df.where(F.col(key).eqNullSafe(F.lit(least))).limit(1)
    described = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("type"),
                as_text(F.col(f"`{f.name}`"), f.dataType).alias("sample"),
            )
            for i, f in enumerate(fields, 1)
        ]
    )
    return first.select(F.lit(table).alias("table_name"), F.inline(described))
