"""One query per operator over the generated test tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark import functions as fn
from tidemark.functions import clean_text, parse_amount, parse_flag
from tidemark.functions.identity import row_id, with_canonical
from tidemark.operators import digests, keyset, merge, metrics, quality, retention, state
from tidemark.operators.curate import clean_table, curate, map_to_raw, with_checksum
from tidemark.plans.flows import TableSync, prune_all, sync_cycle
from tidemark.plans.standins import (
    FIRST_RUN,
    RETURN_ROWS,
    SECOND_RUN,
    SOURCE_SYSTEM,
    STANDINS,
    customers,
    earlier_orders,
    earlier_sources,
    load,
    receipts,
    returns,
    sales,
    sources,
)
from tidemark.session import configure, new_dir
from tidemark.sources.legacy import read_export
from tidemark.sources.readers import read_files, sql_source, table_probe
from tidemark.sources.snapshot import source_changes, source_snapshot
from tidemark.sources.store import TableStore
from tidemark.specs import (
    CHECKPOINT_SCHEMA,
    CITIES,
    CUSTOMERS,
    FINGERPRINT_SCHEMA,
    RECEIPTS,
    RUN_SCHEMA,
    SALES,
    TEXT,
    TableSpec,
)
from tidemark.streaming import keyed, observed
from tidemark.streaming.stream import read_stream, stream_sync

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Texts as they come from a legacy source, derived from the key of each row. Written in
# SQL that Spark and the checking engine share.
DIRTY_TEXT = """CASE o_orderkey % 8
  WHEN 0 THEN concat('  ', o_orderpriority, ' ') WHEN 1 THEN 'NULL' WHEN 2 THEN concat('b''', o_orderpriority, '''')
  WHEN 3 THEN '   ' WHEN 4 THEN concat(chr(9), ' Undefined ') WHEN 5 THEN concat('b"', o_orderstatus, chr(233), '"')
  WHEN 6 THEN concat(chr(92), 'x', o_orderkey, chr(7)) ELSE concat(o_orderpriority, chr(233), ' ') END"""
DIRTY_AMOUNT = """CASE o_orderkey % 8
  WHEN 0 THEN concat('Rs. ', o_custkey) WHEN 1 THEN concat('$-', o_custkey, '.75') WHEN 2 THEN concat(' ', o_custkey, '.5 ')
  WHEN 3 THEN 'none' WHEN 4 THEN concat('1,', o_custkey) WHEN 5 THEN concat('+.', o_custkey) WHEN 6 THEN 'free'
  ELSE concat(o_custkey, '.') END"""
DIRTY_FLAG = """CASE o_orderkey % 12
  WHEN 0 THEN ' Yes ' WHEN 1 THEN '-1' WHEN 2 THEN 'no' WHEN 3 THEN '0' WHEN 4 THEN 'TRUE' WHEN 5 THEN 'False'
  WHEN 6 THEN '0.5' WHEN 7 THEN 'on' WHEN 8 THEN concat('ok=', o_custkey) WHEN 9 THEN '' WHEN 10 THEN 'y' ELSE NULL END"""
# Ten shapes of a date; {0} formats a timestamp by the given pattern letters.
DATE_SHAPES = ("dd/MM/yy HH:mm:ss", "dd/MM/yyyy HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "dd-MM-yy HH:mm:ss",
               "dd-MM-yyyy HH:mm:ss", "MM/dd/yy HH:mm:ss", "MM/dd/yyyy HH:mm:ss", "dd/MM/yy", "dd/MM/yyyy", "yyyy-MM-dd")
DAY_SHAPES = ("yyyy-MM-dd", "dd/MM/yyyy", "dd/MM/yy", "MM/dd/yyyy", "MM/dd/yy", "dd-MM-yyyy", "dd-MM-yy",
              "MM-dd-yyyy", "MM-dd-yy", "dd.MM.yyyy", "dd.MM.yy")
DIRTY_KEY = "CASE WHEN event_id % 97 = 0 THEN ' null ' ELSE CAST(event_id AS STRING) END"


RETAIN_FROM = datetime(2000, 1, 1)


def query(f: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return f(configure(spark), sf_dir)

    QUERIES[f.__name__.removesuffix("_query")] = run
    return f


def seconds(c: str) -> "F.Column":
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c)


def shown(df: DataFrame) -> DataFrame:
    """Timestamps as text to the second."""
    return df.select(
        *[seconds(f.name) if isinstance(f.dataType, T.TimestampType) else F.col(f.name) for f in df.schema]
    )


def raw(df: DataFrame, spec: TableSpec) -> DataFrame:
    return map_to_raw(df, spec, SOURCE_SYSTEM)


def stored(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Mapped rows as a first run stored them."""
    rows = raw(df, spec).withColumn("old_created_at", F.lit(None).cast("timestamp"))
    return merge.stamp(rows, spec, FIRST_RUN).select(spec.raw_schema.fieldNames())


def earlier_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(sales(earlier_orders(spark, sf_dir)), SALES)


def new_store(spark: SparkSession) -> TableStore:
    return TableStore(spark, new_dir(spark, "store"))


# -- sources ---------------------------------------------------------------------------


@query
def keyset_scan(spark, sf_dir):
    """First scan, scan after a checkpoint, and the latter on a source of text lines."""
    orders = load(spark, sf_dir, "orders")
    spec = replace(SALES, fields=(replace(SALES.key, source="o_orderkey"), *SALES.fields[1:]))
    last = orders.agg(F.expr("CAST(max(o_orderkey) DIV 2 AS STRING)")).first()[0]
    lines = new_dir(spark, "orders-json")
    kept = ["o_orderkey", "o_custkey", "o_totalprice"]
    orders.select(kept).write.json(lines)
    text = read_files(spark, lines, "json", orders.select(kept).schema)
    scans = {"first": (orders, None), "after": (orders, last), "text lines": (text, last)}
    parts = [keyset.after(df, spec, ck).select(F.lit(n).alias("scan"), *kept) for n, (df, ck) in scans.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def exported(spark: SparkSession, orders: DataFrame) -> tuple[str, DataFrame]:
    """Orders as a legacy system exports them: JSON lines in key order; and the columns it has."""
    kept = orders.select("o_orderkey", "o_custkey", "o_totalprice")
    path = new_dir(spark, "export")
    kept.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.json(path)
    return path, kept


@query
def legacy_scan(spark, sf_dir):
    """A scan after a checkpoint on an export that can bound its keys and nothing else."""
    orders = load(spark, sf_dir, "orders")
    path, kept = exported(spark, orders)
    last = orders.agg(F.expr("CAST(max(o_orderkey) DIV 2 AS STRING)")).first()[0]
    spec = replace(SALES, fields=(replace(SALES.key, source="o_orderkey"), *SALES.fields[1:]))
    rows = read_export(spark, path, kept.schema, "o_orderkey", block=1 << 20)
    return keyset.after(rows, spec, last).where("o_totalprice > 1000")


@query
def legacy_poll(spark, sf_dir):
    """The same export polled by key as a stream, in two runs: how often each key came."""
    orders = load(spark, sf_dir, "orders")
    half = orders.agg(F.expr("CAST(max(o_orderkey) DIV 2 AS BIGINT)")).first()[0]
    path, kept = exported(spark, orders.where(F.col("o_orderkey") <= half))
    out, checkpoint = new_dir(spark, "polled"), new_dir(spark, "stream")

    def run() -> None:
        rows = read_export(spark, path, kept.schema, "o_orderkey", stream=True, block=1 << 20)
        keyed.run_batches(rows, checkpoint, lambda b, _: b.write.mode("append").parquet(out))

    run()
    rest = orders.where(F.col("o_orderkey") > half).select(kept.columns)
    rest.repartitionByRange("o_orderkey").sortWithinPartitions("o_orderkey").write.mode("append").json(path)
    run()
    return spark.read.parquet(out).groupBy("o_orderkey").agg(F.count("*").alias("times"), F.max("o_totalprice").alias("price"))


@query
def full_scan(spark, sf_dir):
    return curate(customers(load(spark, sf_dir, "customer")), CUSTOMERS).select(
        *[F.col(c).cast("string").alias(c) for c in CUSTOMERS.entity_columns[:4]], "opening_balance"
    )


@query
def sql_source_query(spark, sf_dir):
    text = """SELECT c.c_custkey, c.c_name, count(*) AS n_orders FROM {customer} c
      JOIN {orders} o ON o.o_custkey = c.c_custkey
      WHERE o.o_totalprice >= :least AND o.o_orderstatus = :status GROUP BY c.c_custkey, c.c_name"""
    return sql_source(
        spark, text, {"least": 100000.0, "status": "F"},
        customer=load(spark, sf_dir, "customer"), orders=load(spark, sf_dir, "orders"),
    )


@query
def table_probe_query(spark, sf_dir):
    keys = {"nation": "n_nationkey", "customer": "c_custkey", "orders": "o_orderkey", "events": "event_id"}
    probes = [table_probe(load(spark, sf_dir, t), t, k) for t, k in keys.items()]
    return probes[0].unionByName(probes[1]).unionByName(probes[2]).unionByName(probes[3])


def customer_files(spark: SparkSession, sf_dir: str, changed: bool = False) -> str:
    """A folder of text files, one per nation, with a line for each of its customers in key order.

    With ``changed`` nation 3 has gone, nation 4 has customers of nation 3 as well, and rich customers
    of nation 5 have another segment.
    """
    rows = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "c_nationkey")
    if changed:
        moved = (F.col("c_nationkey") == 5) & (F.col("c_acctbal") > 5000)
        rows = rows.withColumn("c_mktsegment", F.when(moved, "VISITED").otherwise(F.col("c_mktsegment")))
        rows = rows.withColumn("c_nationkey", F.when(F.col("c_nationkey") == 3, 4).otherwise(F.col("c_nationkey")))
    path = new_dir(spark, "customer-files")
    lines = rows.repartition("c_nationkey").sortWithinPartitions("c_nationkey", "c_custkey")
    lines = lines.select("c_nationkey", F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value"))
    lines.write.partitionBy("c_nationkey").text(path)
    return path


NATION_OF_FILE = "c_nationkey=([0-9]+)/[^/]+$"


@query
def source_snapshot_query(spark, sf_dir):
    snap = source_snapshot(spark, customer_files(spark, sf_dir), "*.txt")
    return snap.select(F.regexp_extract("path", NATION_OF_FILE, 1).cast("int").alias("nation"), "size", "sha256")


@query
def source_changes_query(spark, sf_dir):
    """Customer files against an earlier state in which some were absent, others different."""
    def snap(changed: bool) -> DataFrame:
        found = source_snapshot(spark, customer_files(spark, sf_dir, changed), "*.txt")
        # Both folders were written by this run: times of writing tell nothing.
        return found.withColumns({"path": F.regexp_extract("path", NATION_OF_FILE, 1), "mtime": F.lit(None).cast("timestamp")})

    changes = source_changes(snap(False), snap(True))
    return changes.select(F.col("path").cast("int").alias("nation"), "status", "hash_changed", "size_changed", "is_empty")


# -- cleansing -------------------------------------------------------------------------


@query
def curate_tolerant(spark, sf_dir):
    """Upper-case headers with blanks, an absent column, and two spellings of one name."""
    customer = load(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS ` CUSTOMER_ID`", "c_nationkey AS CITY_ID",
        "CASE WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE c_name END AS CUSTOMER_NAME",
        "c_mktsegment AS customer_name", "c_acctbal AS OPENING_BALANCE", "c_mktsegment AS extra",
    )
    out = clean_table(customer, CUSTOMERS)
    return out.select(CUSTOMERS.entity_columns)


@query
def clean_text_query(spark, sf_dir):
    """Dirty texts of orders, and every document as text and as bytes."""
    dirty = load(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.expr(DIRTY_TEXT).alias("t"))
    docs = load(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.col("text").alias("t"))
    as_bytes = docs.withColumn("b", F.concat(F.encode("t", "UTF-8"), F.unhex(F.lit("ff20"))))
    return (
        dirty.select(F.lit("orders").alias("source"), "id", clean_text(F.col("t")).alias("cleaned"))
        .unionByName(docs.select(F.lit("documents").alias("source"), "id", clean_text(F.col("t")).alias("cleaned")))
        .unionByName(as_bytes.select(F.lit("bytes").alias("source"), "id", clean_text(F.col("b"), T.BinaryType()).alias("cleaned")))
    )


@query
def parse_amount_query(spark, sf_dir):
    text = F.expr(DIRTY_AMOUNT)
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", parse_amount(text).alias("amount"), parse_amount(text, thousands=",").alias("amount_grouped"),
        parse_amount(F.col("o_totalprice"), T.DoubleType()).alias("amount_typed"),
    )


@query
def parse_flag_query(spark, sf_dir):
    return load(spark, sf_dir, "orders").select(
        "o_orderkey", parse_flag(F.expr(DIRTY_FLAG)).alias("flag"),
        parse_flag(F.col("o_custkey"), T.LongType()).alias("flag_typed"),
    )


def printed(column: str, key: str, shapes) -> "F.Column":
    """The timestamp printed in one of the shapes, picked by the key."""
    out = F.lit(None).cast("string")
    for i, shape in enumerate(shapes):
        out = F.when(F.col(key) % len(shapes) == i, F.date_format(column, shape)).otherwise(out)
    return out


@query
def parse_timestamp(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"), printed("o_orderdate", "o_orderkey", DATE_SHAPES).alias("t")
    )
    events = load(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"), printed("ts", "event_id", DATE_SHAPES).alias("t")
    )
    return shown(orders.unionByName(events).withColumn("parsed", fn.parse_timestamp(F.col("t"))))


@query
def parse_date(spark, sf_dir):
    orders = load(spark, sf_dir, "orders").select(
        F.lit("orders").alias("source"), F.col("o_orderkey").alias("id"),
        F.concat(printed("o_orderdate", "o_orderkey", DAY_SHAPES), F.lit(" noon")).alias("t"),
    )
    events = load(spark, sf_dir, "events").select(
        F.lit("events").alias("source"), F.col("event_id").alias("id"),
        F.concat(F.lit("on:"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).alias("t"),
    )
    return orders.unionByName(events).withColumn("parsed", fn.parse_date(F.col("t")).cast("string"))


@query
def decode_binary_ts(spark, sf_dir):
    """Order dates with a clock from the keys, as bytes and as hex text."""
    def int16(c):
        h = F.lpad(F.hex(c), 4, "0")
        return F.concat(F.substring(h, 3, 2), F.substring(h, 1, 2))

    parts = [F.year("o_orderdate"), F.month("o_orderdate"), F.dayofmonth("o_orderdate"),
             F.expr("o_orderkey % 24"), F.expr("o_orderkey % 60"), F.expr("o_custkey % 60")]
    digits = F.concat(*[int16(p) for p in parts], F.lit("00000000"))
    df = load(spark, sf_dir, "orders").select("o_orderkey", digits.alias("d"))
    return df.select(
        "o_orderkey",
        fn.decode_binary_timestamp(F.unhex("d")).alias("from_bytes"),
        fn.decode_binary_timestamp(F.concat(F.lit("\\x"), F.lower("d")), T.StringType()).alias("from_hex"),
    )


@query
def canonical_row(spark, sf_dir):
    """Canonical JSON and checksum of whole documents in four languages."""
    docs = load(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    out = with_canonical(docs, [("lang", TEXT), ("text", TEXT)])
    return out.select("doc_id", F.length("canonical").cast("long").alias("n_chars"), F.sha2("canonical", 256).alias("checksum"))


@query
def row_checksum(spark, sf_dir):
    parts = [
        with_checksum(clean_table(df, spec), spec).select(
            F.lit(spec.target_table).alias("table_name"), F.col(spec.key.target).alias("entity_id"), "checksum"
        )
        for spec, df in ((SALES, sales(load(spark, sf_dir, "orders"))), (CUSTOMERS, customers(load(spark, sf_dir, "customer"))),
                         (RECEIPTS, receipts(load(spark, sf_dir, "events"))))
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def row_id_query(spark, sf_dir):
    tables = ((SALES, "orders", "o_orderkey"), (CUSTOMERS, "customer", "c_custkey"), (RECEIPTS, "events", "event_id"))
    parts = [
        load(spark, sf_dir, t).select(F.lit(s.source_table).alias("table_name"), F.col(k).cast("string").alias("entity_id"))
        .withColumn("raw_id", row_id(s.source_table, F.col("entity_id")))
        for s, t, k in tables
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query
def map_to_raw_query(spark, sf_dir):
    return shown(raw(receipts(load(spark, sf_dir, "events")), RECEIPTS))


@query
def dlq_rows(spark, sf_dir):
    """Rejected events: keys that are null tokens, and a table constraint."""
    events = load(spark, sf_dir, "events").withColumn("event_id", F.expr(DIRTY_KEY))
    spec = replace(RECEIPTS, checks=(("amount above limit", "amount <= 40"),))
    return quality.dead_letters(receipts(events), spec, SECOND_RUN).select(
        "source_table", "primary_key", "error", F.get_json_object("payload", "$.Amount").cast("double").alias("amount"), "retry_count"
    )


# -- merge -----------------------------------------------------------------------------


@query
def dedupe_last(spark, sf_dir):
    df = returns(load(spark, sf_dir, "lineitem"))
    return merge.dedupe_last(df, "RG_ID", list(RETURN_ROWS.seq)).select(
        F.col("RG_ID").alias("rg_id"), "part", "supplier", "quantity", F.col("NET_AMOUNT").alias("net_amount")
    )


@query
def upsert_changed(spark, sf_dir):
    source = raw(sales(load(spark, sf_dir, "orders")), SALES)
    merged = merge.upsert_changed(earlier_target(spark, sf_dir), source, SALES, SECOND_RUN)
    return shown(merged.select("bill_id", "net_amount", "checksum", "created_at", "updated_at", "change_type"))


@query
def upsert_classify(spark, sf_dir):
    source = raw(sales(load(spark, sf_dir, "orders")), SALES)
    kinds = merge.classify(source, earlier_target(spark, sf_dir), "bill_id")
    return kinds.groupBy("change_type").agg(F.count("*").alias("n"))


def seen(df: DataFrame, spec: TableSpec) -> DataFrame:
    return with_checksum(clean_table(df, spec), spec).select(F.col(spec.key.target).alias("entity_id"), "checksum")


def first_fingerprints(spark, sf_dir) -> DataFrame:
    empty = spark.createDataFrame([], FINGERPRINT_SCHEMA)
    return merge.upsert_fingerprints(empty, seen(sales(earlier_orders(spark, sf_dir)), SALES), SALES.source_table, FIRST_RUN)


@query
def fingerprints(spark, sf_dir):
    now = seen(sales(load(spark, sf_dir, "orders")), SALES)
    return shown(merge.upsert_fingerprints(first_fingerprints(spark, sf_dir), now, SALES.source_table, SECOND_RUN))


@query
def fingerprint_delta(spark, sf_dir):
    rows = with_checksum(clean_table(sales(load(spark, sf_dir, "orders")), SALES), SALES)
    fresh = merge.fingerprint_delta(rows, first_fingerprints(spark, sf_dir), SALES.source_table, "bill_id")
    return fresh.select("bill_id", "checksum")


def flagged(spark, sf_dir) -> list[tuple[TableSpec, DataFrame]]:
    """Target rows of all tables, some marked processed at different times."""
    out = []
    for name, df in sources(spark, sf_dir).items():
        spec = STANDINS[name]
        rows = stored(merge.dedupe_last(df, spec.key.source, list(spec.seq)) if spec.seq else df, spec)
        rows = rows.withColumn("is_processed", F.expr(f"pmod(length({spec.key.target}) + ascii(reverse({spec.key.target})), 3) = 0"))
        if spec.has_updated_at and spec.date:
            rows = rows.withColumn("updated_at", F.col("created_at") + F.expr("INTERVAL 10 DAYS"))
        out.append((spec, rows))
    return out


@query
def prune(spark, sf_dir):
    spec, rows = flagged(spark, sf_dir)[2]
    return shown(retention.prune(rows, spec, RETAIN_FROM, 30).select("bill_id", "is_processed", "updated_at"))


@query
def prune_counts(spark, sf_dir):
    parts = [retention.prune_counts(rows, spec, RETAIN_FROM, 30) for spec, rows in flagged(spark, sf_dir)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query
def prune_all_query(spark, sf_dir):
    """Stored tables after marking, pruning and counting what is left."""
    sync = TableSync(new_store(spark), SOURCE_SYSTEM, SECOND_RUN)
    tables = flagged(spark, sf_dir)
    for spec, rows in tables:
        sync.store.replace(spec.target_table, rows, spec.key.target)
    specs = [s for s, _ in tables]
    pruned = prune_all(sync, specs, 9000)
    left = [sync.target(s).agg(F.count("*").alias("kept")).select(F.lit(s.target_table).alias("table_name"), "kept") for s in specs]
    kept = left[0]
    for p in left[1:]:
        kept = kept.unionByName(p)
    return pruned.join(kept, "table_name").select("table_name", "pruned", "kept", F.col("error").isNull().alias("ok"))


# -- state -----------------------------------------------------------------------------


def old_checkpoints(spark, sf_dir) -> DataFrame:
    events = load(spark, sf_dir, "events").where("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00' AND event_type <> 'signup'")
    return events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.max("event_id").cast("string").alias("last_sync_key"),
        F.min("event_id").cast("string").alias("last_reconcile_key"),
        F.max("ts").cast("timestamp").alias("last_sync_timestamp"),
        F.lit("c1").alias("cycle_id"), F.lit(state.SUCCESS).alias("status"),
        F.max("ts").cast("timestamp").alias("updated_at"),
    ).to(CHECKPOINT_SCHEMA)


@query
def checkpoint_advance(spark, sf_dir):
    events = load(spark, sf_dir, "events").where("event_type <> 'view'")
    new = events.groupBy(F.col("event_type").alias("table_name")).agg(
        F.expr("CASE WHEN event_type <> 'click' THEN CAST(max(event_id) AS STRING) END").alias("last_sync_key"),
        F.lit(None).cast("string").alias("last_reconcile_key"), F.lit("c2").alias("cycle_id"),
        F.lit(state.SUCCESS).alias("status"), F.expr("event_type = 'error'").alias("reset_reconcile"),
    )
    return shown(state.advance_checkpoints(old_checkpoints(spark, sf_dir), new, SECOND_RUN))


@query
def checkpoint_inventory(spark, sf_dir):
    return shown(state.checkpoint_inventory(old_checkpoints(spark, sf_dir)))


def tasks(spark, sf_dir) -> DataFrame:
    """Task results derived from events: one cycle per day, one task per event type."""
    return load(spark, sf_dir, "events").groupBy(
        F.date_format("ts", "yyyy-MM-dd").alias("cycle_id"), F.col("event_type").alias("table_name")
    ).agg(
        F.lit("incremental").alias("mode"), F.count("*").alias("scanned"),
        F.count_if(F.expr("value < 5")).alias("inserted"), F.count_if(F.expr("value >= 5 AND value < 10")).alias("updated"),
        F.count_if(F.expr("value >= 10 AND (event_type <> 'error' OR value <= 30)")).alias("unchanged"),
        F.lit(0).cast("long").alias("superseded"), F.count_if(F.expr("event_type = 'error' AND value > 30")).alias("errors"),
        (F.sum(F.expr("CAST(round(value * 100) AS BIGINT)")) / 100000.0).alias("duration"),
        F.expr("CASE WHEN max(value) > 60 THEN 'timeout' END").alias("error"),
    )


def run_times(spark, sf_dir) -> DataFrame:
    return load(spark, sf_dir, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("cycle_id")).agg(
        F.date_trunc("second", F.min("ts")).cast("timestamp").alias("start_time"),
        F.date_trunc("second", F.max("ts")).cast("timestamp").alias("end_time"),
        (F.sum(F.expr("CAST(round(value * 100) AS BIGINT)")) / 10000.0).alias("duration"),
    )


def runs(spark, sf_dir) -> DataFrame:
    """Runs opened for every day and closed for all but those that end before noon hours."""
    times = run_times(spark, sf_dir)
    log = state.open_runs(spark.createDataFrame([], RUN_SCHEMA), times)
    totals = metrics.cycle_rollup(tasks(spark, sf_dir), times).drop("duration_sec")
    done = times.join(totals, "cycle_id").where("date_format(end_time, 'mm') < '55'")
    return state.close_runs(log, done)


@query
def run_log(spark, sf_dir):
    return shown(runs(spark, sf_dir))


@query
def stale_runs(spark, sf_dir):
    return shown(state.interrupt_stale_runs(runs(spark, sf_dir), SECOND_RUN).select("cycle_id", "start_time", "end_time", "status"))


# -- metrics ---------------------------------------------------------------------------


def lags(spark, sf_dir) -> DataFrame:
    now, before = sources(spark, sf_dir), earlier_sources(spark, sf_dir)
    out = None
    for spec in (SALES, RECEIPTS, RETURN_ROWS):
        one = metrics.sync_lag(now[spec.source_table], stored(before[spec.source_table], spec), spec)
        out = one if out is None else out.unionByName(one)
    return out


@query
def sync_lag(spark, sf_dir):
    return shown(lags(spark, sf_dir).withColumn("lag_minutes", F.round("lag_minutes", 4)))


@query
def lag_alerts(spark, sf_dir):
    return metrics.lag_alerts(lags(spark, sf_dir).withColumn("lag_minutes", F.round("lag_minutes", 4)))


@query
def task_counts(spark, sf_dir):
    dirty = receipts(load(spark, sf_dir, "events").withColumn("event_id", F.expr(DIRTY_KEY)))
    target = stored(earlier_sources(spark, sf_dir)[RECEIPTS.source_table], RECEIPTS)
    checked = clean_table(dirty, RECEIPTS).withColumn("reason", quality.reject_reason(RECEIPTS))
    good = with_checksum(checked.where("reason IS NULL"), RECEIPTS)
    kinds = merge.classify(good, target, "receipt_id")
    return metrics.task_counts(kinds, checked.where("reason IS NOT NULL"), RECEIPTS.source_table, "incremental")


@query
def cycle_rollup(spark, sf_dir):
    return metrics.cycle_rollup(tasks(spark, sf_dir), run_times(spark, sf_dir))


@query
def row_counters(spark, sf_dir):
    return metrics.row_counters(tasks(spark, sf_dir))


@query
def duration_histogram(spark, sf_dir):
    out = metrics.duration_histogram(tasks(spark, sf_dir), ["table_name", "mode"])
    return out.select("table_name", "mode", F.col("le").cast("string").alias("le"), "bucket_count",
                      F.round("duration_sum", 3).alias("duration_sum"), "duration_count")


# -- flows -----------------------------------------------------------------------------


@query
def incremental_sync(spark, sf_dir):
    """Two runs over receipts: what had arrived by then, and the rest."""
    store = new_store(spark)
    name = RECEIPTS.source_table
    TableSync(store, SOURCE_SYSTEM, FIRST_RUN).incremental(RECEIPTS, earlier_sources(spark, sf_dir)[name])
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    second.incremental(RECEIPTS, sources(spark, sf_dir)[name])
    return shown(second.target(RECEIPTS))


@query
def reconcile_chunk(spark, sf_dir):
    """A rolling re-read of all sales in chunks, over the target of an earlier run."""
    store = new_store(spark)
    TableSync(store, SOURCE_SYSTEM, FIRST_RUN).incremental(SALES, sales(earlier_orders(spark, sf_dir)))
    orders = sales(load(spark, sf_dir, "orders"))
    third = orders.count() // 3 + 1
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    while True:
        second.reconcile(SALES, orders, third)
        if second.checkpoint(SALES)[1] is None:
            break
    return shown(second.target(SALES).select("bill_id", "net_amount", "checksum", "created_at", "updated_at"))


@query
def range_digests(spark, sf_dir):
    """Every sale that differs from the target of an earlier run, found by digests of key ranges."""
    target, key = earlier_target(spark, sf_dir), SALES.key.target
    store = new_store(spark)
    store.replace(SALES.target_table, target, key)
    stored_sales = store.read(SALES.target_table, SALES.raw_schema, key)
    # Sales of one priority have gone from the source, so that all kinds of differences occur.
    orders = sales(load(spark, sf_dir, "orders").where("o_orderpriority <> '5-LOW' OR o_orderkey % 2 = 0"))
    return digests.differences(orders, stored_sales, SALES)


@query
def repair_sync(spark, sf_dir):
    """The target of an earlier run, repaired where digests of key ranges differ from the source."""
    store = new_store(spark)
    TableSync(store, SOURCE_SYSTEM, FIRST_RUN).incremental(SALES, sales(earlier_orders(spark, sf_dir)))
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    second.repair(SALES, sales(load(spark, sf_dir, "orders")))
    return shown(second.target(SALES).select("bill_id", "net_amount", "checksum", "created_at", "updated_at"))


@query
def full_sync(spark, sf_dir):
    """Both master tables, before and after changes."""
    store = new_store(spark)
    before, now = earlier_sources(spark, sf_dir), sources(spark, sf_dir)
    for spec in (CITIES, CUSTOMERS):
        TableSync(store, SOURCE_SYSTEM, FIRST_RUN).full(spec, before[spec.source_table])
        TableSync(store, SOURCE_SYSTEM, SECOND_RUN).full(spec, now[spec.source_table])
    sync = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    parts = [
        sync.target(s).select(F.lit(s.target_table).alias("table_name"), F.col(s.key.target).alias("entity_id"),
                              "raw_id", "checksum", "is_processed", "updated_at")
        for s in (CITIES, CUSTOMERS)
    ]
    return shown(parts[0].unionByName(parts[1]))


@query
def late_rows(spark, sf_dir):
    """Sales that arrived with keys below the checkpoint: passed over by the incremental
    run, found by the reconcile after it."""
    store = new_store(spark)
    before, orders = sales(earlier_orders(spark, sf_dir)), sales(load(spark, sf_dir, "orders"))
    TableSync(store, SOURCE_SYSTEM, FIRST_RUN).incremental(SALES, before)
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    second.incremental(SALES, orders)
    after_sync = second.target(SALES).select("bill_id", F.lit("incremental").alias("found_by"))
    second.reconcile(SALES, orders, orders.count() + 1)
    rows = second.target(SALES).select("bill_id").join(after_sync, "bill_id", "left")
    return rows.withColumn("found_by", F.coalesce("found_by", F.lit("reconcile")))


@query
def sync_cycle_query(spark, sf_dir):
    """The second of two cycles over all five tables: its task counters."""
    return cycle_counts(spark, sf_dir)


def cycle_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, specs = new_store(spark), list(STANDINS.values())
    first = TableSync(store, SOURCE_SYSTEM, FIRST_RUN, "cycle-1")
    sync_cycle(first, earlier_sources(spark, sf_dir), specs, workers=5)
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN, "cycle-2")
    done = sync_cycle(second, sources(spark, sf_dir), specs, workers=5)
    counts = ["scanned", "inserted", "updated", "unchanged", "superseded", "errors", "pruned"]
    return done.select("cycle_id", "table_name", "mode", *counts, F.round("lag_minutes", 4).alias("lag_minutes"))


@query
def stream_sync_query(spark, sf_dir):
    """Receipts merged from a stream, then delivered again: the final target."""
    store = new_store(spark)
    schema = load(spark, sf_dir, "events").schema
    events = read_stream(spark, f"{sf_dir}/events.parquet", schema)
    sync = TableSync(store, SOURCE_SYSTEM, FIRST_RUN)
    stream_sync(sync, RECEIPTS, receipts(events), new_dir(spark, "stream"))
    again = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    stream_sync(again, RECEIPTS, receipts(events), new_dir(spark, "stream"))
    return shown(again.target(RECEIPTS).select("receipt_id", "checksum", "raw_id", "created_at", "updated_at"))


def deliveries(spark: SparkSession, sf_dir: str, times: int) -> tuple[str, Callable[[], None]]:
    """A folder that holds the receipts of an earlier day ``times`` over, in files of their own, and what adds today's."""
    folder, name = new_dir(spark, "deliveries"), RECEIPTS.source_table
    before, now = earlier_sources(spark, sf_dir)[name], sources(spark, sf_dir)[name]
    for _ in range(times):
        before.repartition(3, "Receipt_ID").write.mode("append").parquet(folder)
    return folder, lambda: now.repartition(3, "Receipt_ID").write.mode("append").parquet(folder)


@query
def stream_classify(spark, sf_dir):
    """Classes of today's receipts by state that an earlier run of the stream has left."""
    folder, add = deliveries(spark, sf_dir, 1)
    schema, checkpoint = receipts(load(spark, sf_dir, "events")).schema, new_dir(spark, "stream")
    out = new_dir(spark, "classes")

    def run(now: datetime) -> None:
        rows = keyed.classified(read_stream(spark, folder, schema, max_files=2), RECEIPTS, now)
        keyed.run_batches(rows, checkpoint, lambda b, _: b.write.mode("append").parquet(f"{out}/{now:%Y-%m-%d}"), "update")

    with keyed.keyed_state(spark):
        run(FIRST_RUN)
        add()
        run(SECOND_RUN)
    last = spark.read.parquet(f"{out}/{SECOND_RUN:%Y-%m-%d}")
    return shown(last.select("receipt_id", "change_type", "checksum", "first_seen_at", "last_changed_at"))


@query
def stream_once(spark, sf_dir):
    """Receipts delivered three times, with today's changes: how often each of them reached the merge."""
    folder, add = deliveries(spark, sf_dir, 2)
    schema, checkpoint = receipts(load(spark, sf_dir, "events")).schema, new_dir(spark, "stream")
    out = new_dir(spark, "reached")

    def run() -> None:
        rows = read_stream(spark, folder, schema, max_files=2, arrival=True)
        once = keyed.without_redelivery(rows, RECEIPTS, "_arrived", "1 day")
        keyed.run_batches(once, checkpoint, lambda b, _: b.select("Receipt_ID").write.mode("append").parquet(out))

    run()
    add()
    run()
    return spark.read.parquet(out).groupBy(F.col("Receipt_ID").alias("receipt_id")).agg(F.count("*").alias("times"))


@query
def stream_late(spark, sf_dir):
    """Receipts with keys below the checkpoint of the stream: passed over by it, found by range digests beside it."""
    store, checkpoint = new_store(spark), new_dir(spark, "stream")
    folder, add = deliveries(spark, sf_dir, 1)
    schema = receipts(load(spark, sf_dir, "events")).schema
    stream_sync(TableSync(store, SOURCE_SYSTEM, FIRST_RUN), RECEIPTS, read_stream(spark, folder, schema), checkpoint)
    add()
    second = TableSync(store, SOURCE_SYSTEM, SECOND_RUN)
    stream_sync(second, RECEIPTS, read_stream(spark, folder, schema), checkpoint, skip_old=True)
    after_stream = second.target(RECEIPTS).select("receipt_id", F.lit("stream").alias("found_by"))
    second.repair(RECEIPTS, sources(spark, sf_dir)[RECEIPTS.source_table])
    rows = second.target(RECEIPTS).select("receipt_id", "checksum").join(after_stream, "receipt_id", "left")
    return rows.withColumn("found_by", F.coalesce("found_by", F.lit("digests")))


@query
def stream_counters(spark, sf_dir):
    """Counters of a stream of receipts, some with bad keys, in several micro-batches: their sums per table."""
    store, folder, out = new_store(spark), new_dir(spark, "deliveries"), new_dir(spark, "good")
    rows = receipts(load(spark, sf_dir, "events").withColumn("event_id", F.expr(DIRTY_KEY)))
    rows.repartition(4, "Receipt_ID").write.parquet(folder)
    log = observed.BatchLog()
    spark.streams.addListener(log)
    try:
        counted = observed.observed(read_stream(spark, folder, rows.schema, max_files=1), RECEIPTS)
        keyed.run_batches(counted, new_dir(spark, "stream"), lambda b, _: b.where("_reason IS NULL").select("receipt_id").write.mode("append").parquet(out))
        log.flush(store)
    finally:
        spark.streams.removeListener(log)
    sums = observed.batches(store).groupBy("table_name", "mode").agg(
        F.sum("scanned").alias("scanned"), F.sum("errors").alias("errors"), seconds_of(F.max("newest")).alias("newest")
    )
    return sums.crossJoin(spark.read.parquet(out).agg(F.count("*").alias("good")))  # one row


def seconds_of(ts):
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")
