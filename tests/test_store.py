"""The table store: bucketed bases, unfinished writes, layout of the merge."""

import glob
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge
from tidemark.session import configure, new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import SALES

SCHEMA = "k string, n int"


@pytest.fixture()
def store(spark):
    return TableStore(configure(spark), new_dir(spark, "store"), buckets=4)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def content(spark, store):
    return sorted((r.k, r.n) for r in store.read("t", frame(spark, []).schema, "k").collect())


def files_per_bucket(path):
    """Names of part files end in _<bucket>."""
    found = [re.search(r"_(\d{5})\.c000", f).group(1) for f in glob.glob(f"{path}/part-*.parquet")]
    return max(map(found.count, found), default=0)


def test_joins_in_place_equal_a_dictionary(spark, store):
    rnd, model = random.Random(8), {}
    schema = frame(spark, []).schema
    assert content(spark, store) == [] and not store.exists("t")
    for step in range(5):
        batch = {str(rnd.randint(0, 40)): step for _ in range(25)}
        old = store.read("t", schema, "k").withColumnRenamed("n", "m")
        rows = old.join(frame(spark, list(batch.items())), "k", "full").select("k", F.coalesce("n", "m").alias("n"))
        store.replace("t", rows, "k", in_place=True)
        model |= batch
        assert content(spark, store) == sorted(model.items())
        assert files_per_bucket(f"{store.root}/t/{store.bases('t')[-1]}") == 1
    assert len(store.bases("t")) == 2


def test_unfinished_base_is_not_read(spark, store):
    store.replace("t", frame(spark, [("a", 1)]), "k")
    store.replace("t", frame(spark, [("b", 2)]), "k")
    os.remove(f"{store.root}/t/{store.bases('t')[-1]}/_SUCCESS")
    assert content(spark, store) == [("a", 1)]
    store.replace("t", frame(spark, [("c", 3)]), "k")
    assert content(spark, store) == [("c", 3)]


def test_reader_is_not_disturbed_by_the_next_write(spark, store):
    store.replace("t", frame(spark, [("a", 1)]), "k")
    reading = store.read("t", frame(spark, []).schema, "k")
    store.replace("t", frame(spark, [("a", 2), ("b", 2)]), "k")
    assert reading.count() == 1


def test_another_session_reads_the_same_buckets(spark, store):
    store.replace("t", frame(spark, [(str(k), k) for k in range(50)]), "k")
    other = TableStore(spark.newSession(), store.root, buckets=7)
    spark.sql(f"DROP TABLE {store._name(store._path('t', store.bases('t')[-1]))}")
    rows = other.read("t", frame(spark, []).schema, "k")
    assert rows.where("k = '7'").first().n == 7 and rows.rdd.getNumPartitions() == 4
    other.replace("t", rows.where("n < 10"), "k", in_place=True)
    assert store.bases("t")[-1].endswith("-4") and len(content(spark, store)) == 10


def test_logs_are_appended_to(spark, store):
    for k in "ab":
        store.append("t", frame(spark, [(k, 1)]))
    assert content(spark, store) == [("a", 1), ("b", 1)]


def stored_sales(spark, store, n):
    raw = SALES.raw_schema.fieldNames()
    rows = spark.range(n).select(
        *[(F.col("id") if c == "bill_id" else F.lit("x") if c == "checksum" else F.lit(None)).cast(SALES.raw_schema[c].dataType).alias(c) for c in raw]
    )
    store.replace("raw_sales", rows, "bill_id")
    return store.read("raw_sales", SALES.raw_schema, "bill_id")


def side_of(plan, text):
    """Operators from the one above a scan of ``text`` up to the join."""
    lines = plan.splitlines()
    at = next(i for i, line in enumerate(lines) if text in line and "Scan" in line)
    depth = lambda i: len(re.match(r"[^A-Za-z*]*", lines[i]).group())
    found, level = [], depth(at)
    for i in range(at - 1, -1, -1):
        if depth(i) < level:
            level = depth(i)
            found.append(lines[i])
            if "Join" in lines[i]:
                return found
    return []


@pytest.mark.parametrize("partitions", ["4", "2", "32"])
def test_merge_neither_moves_nor_sorts_the_target(spark, store, partitions):
    """Four buckets, whatever the partitions of a shuffle are; nothing is broadcast."""
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        target = stored_sales(spark, store, 200)
        path = new_dir(spark, "batch")
        target.where("bill_id < 150").withColumn("checksum", F.lit("y")).write.parquet(path)
        # A third of the batch carries one key.
        batch = spark.read.parquet(path).withColumn("_seq", F.monotonically_increasing_id())
        hot = batch.withColumn("bill_id", F.when(F.rand(1) < 0.33, "7").otherwise(F.col("bill_id")))
        last = merge.dedupe_last(hot, "bill_id", ["_seq"])
        from tidemark.plans.catalogue import FIRST_RUN

        merged = merge.upsert_changed(target, store.beside("raw_sales", last, "bill_id"), SALES, FIRST_RUN)
        name = store._name(store._path("raw_sales", store.bases("raw_sales")[-1]))
        plan = merged._jdf.queryExecution().executedPlan().toString()
        joined = side_of(plan, name)
        assert "SortMergeJoin" in joined[-1] and not any("Exchange" in line or "Sort " in line for line in joined[:-1]), plan
        # The hot key is cut to one row per task before anything moves.
        assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
        store.replace("raw_sales", merged.drop("change_type"), "bill_id", in_place=True)
        assert files_per_bucket(f"{store.root}/raw_sales/{store.bases('raw_sales')[-1]}") == 1
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
