"""Range digests: every difference found, equal ranges left alone."""

import random
from dataclasses import replace
from datetime import datetime

import pytest
from hypothesis import given, settings as how, strategies as st
from pyspark.sql import functions as F

from tidemark.operators import digests
from tidemark.plans.flows import TableSync
from tidemark.session import configure, new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import CUSTOMERS, SALES

DAY1, DAY2 = datetime(2024, 5, 1), datetime(2024, 5, 2)


@how(max_examples=200, deadline=None)
@given(st.sets(st.integers(-50, 50), min_size=1), st.integers(1, 6), st.integers(0, 5))
def test_intervals_hold_every_range(ranges, most, bits):
    found = digests.intervals(list(ranges), bits, most)
    assert len(found) <= most and found == sorted(found)
    for p in ranges:
        assert any(low <= p << bits and (p + 1 << bits) - 1 <= high for low, high in found)
    # Nothing lies outside the ranges' own ends, and with enough intervals nothing but the ranges.
    exact = digests.intervals(list(ranges), bits, 1000)
    assert sum(high - low + 1 for low, high in exact) == len(ranges) << bits


def sync(spark, ts=DAY1):
    return TableSync(TableStore(configure(spark), new_dir(spark, "store")), "TEST", ts)


def bills(spark, pairs):
    return spark.createDataFrame(pairs, "Bill_ID string, NET_AMOUNT string")


def plain(source, target):
    out = set()
    for k in source.keys() | target.keys():
        kind = "insert" if k not in target else "removed" if k not in source else "update"
        if source.get(k) != target.get(k):
            out.add((k, kind))
    return out


@pytest.mark.parametrize("order", ["long", "text"])
def test_every_difference_is_found(spark, order):
    rnd, spec = random.Random(4), replace(SALES, key_order=order)
    keys = [str(k) for k in rnd.sample(range(-10**15, 10**15), 3000)] + ["A7", "B8", "C9"]
    old = {k: rnd.randrange(100) for k in keys[:-200] + keys[-2:]}
    new = {k: old.get(k, 5) + (rnd.random() < 0.01) for k in keys[50:]}
    s = sync(spark)
    s.full(spec, bills(spark, [(k, str(v)) for k, v in old.items()]))
    found = digests.differences(bills(spark, [(k, str(v)) for k, v in new.items()]), s.target(spec), spec)
    assert {tuple(r) for r in found.collect()} == plain(new, old)


def test_equal_sides_have_no_open_range(spark):
    s, source = sync(spark), bills(spark, [(str(k), f"{k}.5") for k in range(300)])
    assert digests.open_ranges(bills(spark, []), s.target(SALES), SALES) is None
    s.full(SALES, source)
    assert digests.open_ranges(source.orderBy(F.rand(2)), s.target(SALES), SALES) is None
    assert digests.differences(source, s.target(SALES), SALES).collect() == []
    done = s.repair(SALES, source)
    assert (done.scanned, done.inserted, done.updated) == (0, 0, 0)


def test_rows_read_again_fall_with_the_share_of_changes(spark):
    path = new_dir(spark, "bills")
    source = spark.range(20_000).selectExpr("id AS Bill_ID", "CAST(id AS string) AS NET_AMOUNT")
    source.repartitionByRange(8, "Bill_ID").sortWithinPartitions("Bill_ID").write.parquet(path)
    stored = spark.read.parquet(path)
    s = sync(spark)
    s.full(SALES, stored)
    read = []
    for changes in (1, 40):
        now = stored.withColumn("NET_AMOUNT", F.when(F.col("Bill_ID").between(5000, 4999 + changes), "7").otherwise(F.col("NET_AMOUNT")))
        again = TableSync(s.store, "TEST", DAY2)
        found = digests.open_ranges(now, again.target(SALES), SALES)
        plan = found.source(now, SALES)._jdf.queryExecution().executedPlan().toString()
        assert "PushedFilters: [Or(" in plan or "GreaterThanOrEqual(Bill_ID," in plan
        result = again.repair(SALES, now)
        assert result.updated == changes
        read.append(result.scanned)
        s.full(SALES, stored)
    assert read[0] < 50 and read[1] < 150


def test_rows_beyond_ascii_and_repeated_keys(spark):
    schema = "CUSTOMER_ID string, CUSTOMER_NAME string, Opening_Balance double"
    data = [(str(k), "Zoë" if k % 3 else "Ann", k + 0.00005) for k in range(60)]
    s = sync(spark)
    s.full(CUSTOMERS, spark.createDataFrame(data, schema))
    assert digests.differences(spark.createDataFrame(data, schema), s.target(CUSTOMERS), CUSTOMERS).collect() == []
    data[7] = ("7", "Zoé", 7.00005)
    twice = [*data, data[9], ("null", "x", 1.0)]
    found = digests.differences(spark.createDataFrame(twice, schema), s.target(CUSTOMERS), CUSTOMERS)
    assert [tuple(r) for r in found.collect()] == [("7", "update")]
    done = TableSync(s.store, "TEST", DAY2).repair(CUSTOMERS, spark.createDataFrame(twice, schema))
    assert (done.updated, done.inserted) == (1, 0)


def test_repair_equals_a_full_sync(spark):
    one, other = sync(spark), sync(spark)
    old, new = bills(spark, [(str(k), "1") for k in range(0, 400, 2)]), bills(spark, [(str(k), str(k % 5)) for k in range(500)])
    for s in (one, other):
        s.full(SALES, old)
    TableSync(one.store, "TEST", DAY2).repair(SALES, new)
    TableSync(other.store, "TEST", DAY2).full(SALES, new)
    assert sorted(map(tuple, one.target(SALES).collect())) == sorted(map(tuple, other.target(SALES).collect()))
    assert one.checkpoint(SALES) == other.checkpoint(SALES)
