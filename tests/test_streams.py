"""Keyed state and deduplication in streams, over folders of many files."""

import json
import time
from dataclasses import replace
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import merge, metrics
from tidemark.operators.curate import map_to_raw
from tidemark.plans import catalogue, standins
from tidemark.plans.flows import TableSync
from tidemark.session import configure, new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import SALES
from tidemark.streaming import keyed, observed
from tidemark.streaming.stream import read_stream, stream_sync

DAY1, DAY2, DAY3 = datetime(2024, 5, 1), datetime(2024, 5, 2), datetime(2024, 5, 3)
SCHEMA = "Bill_ID string, NET_AMOUNT string, at int"
SPEC = replace(SALES, seq=("at",))


class Folder:
    def __init__(self, spark):
        self.spark, self.path, self.checkpoint = spark, new_dir(configure(spark), "in"), new_dir(spark, "stream")

    def add(self, pairs, files=1):
        rows = [(k, v, n) for n, (k, v) in enumerate(pairs)]
        self.spark.createDataFrame(rows, SCHEMA).repartition(files).write.mode("append").parquet(self.path)

    def stream(self, **how):
        schema = self.spark.createDataFrame([], SCHEMA).schema
        return read_stream(self.spark, self.path, schema, **how)

    def classes(self, now, ttl_ms=None, max_files=None):
        found = []
        rows = keyed.classified(self.stream(max_files=max_files), SPEC, now, ttl_ms)
        with keyed.keyed_state(self.spark):
            keyed.run_batches(rows, self.checkpoint, lambda b, _: found.extend(b.collect()), "update")
        return found


def kinds(rows):
    return sorted((r.bill_id, r.change_type) for r in rows)


def test_classes_go_on_after_a_restart(spark):
    folder = Folder(spark)
    folder.add([(str(k), "1") for k in range(6)], files=3)
    assert kinds(folder.classes(DAY1)) == [(str(k), "insert") for k in range(6)]
    folder.add([("0", "1"), ("1", "2"), ("9", "1"), ("null", "5"), (None, "5")], files=2)
    found = {r.bill_id: r for r in folder.classes(DAY2)}
    assert kinds(found.values()) == [("0", "unchanged"), ("1", "update"), ("9", "insert")]
    times = {k: (r.first_seen_at, r.last_seen_at, r.last_changed_at) for k, r in found.items()}
    assert times == {"0": (DAY1, DAY2, DAY1), "1": (DAY1, DAY2, DAY2), "9": (DAY2, DAY2, DAY2)}
    assert folder.classes(DAY3) == []


def test_last_row_of_a_hot_key_decides(spark):
    folder = Folder(spark)
    folder.add([("7" if k % 2 else str(k + 100), str(k)) for k in range(500)], files=4)
    first = {r.bill_id: r for r in folder.classes(DAY1)}
    assert len(first) == 251
    folder.add([("7", "499")])  # as the last of its rows
    assert kinds(folder.classes(DAY2)) == [("7", "unchanged")]


def test_keys_are_forgotten_after_their_time(spark):
    folder = Folder(spark)
    folder.add([("1", "1")])
    assert kinds(folder.classes(DAY1, ttl_ms=1500)) == [("1", "insert")]
    time.sleep(2)
    folder.add([("1", "1")])
    assert kinds(folder.classes(DAY2, ttl_ms=1500)) == [("1", "insert")]


def test_classes_are_those_of_the_batch_operator(spark, sf_dir):
    got = {(r.receipt_id, r.change_type) for r in catalogue.QUERIES["stream_classify"](spark, sf_dir).collect()}
    spec, name = standins.STANDINS["Receipt_Master"], "Receipt_Master"
    source = map_to_raw(standins.sources(spark, sf_dir)[name], spec, "BILLING")
    target = map_to_raw(standins.earlier_sources(spark, sf_dir)[name], spec, "BILLING")
    want = {(r.receipt_id, r.change_type) for r in merge.classify(source, target, "receipt_id").collect()}
    assert got == want and len({k for _, k in want}) == 3


def test_order_of_rows_is_kept_as_text(spark):
    rows = [(-5, "b", DAY1), (3, "a", DAY2), (3, "b", DAY1), (None, "a", DAY1), (10**12, "", DAY1), (3, None, DAY1), (3, "a", DAY1), (-(2**63), "a", DAY1)]
    df = spark.createDataFrame(rows, "x long, y string, z timestamp").select(F.struct("x", "y", "z").alias("s"))
    by_struct = [tuple(r.s) for r in df.orderBy("s").collect()]
    by_text = [tuple(r.s) for r in df.orderBy(keyed.sortable("s", df)).collect()]
    assert by_text == by_struct
    with pytest.raises(ValueError):
        keyed.sortable("s", spark.sql("select struct(1.5D as x) s"))


def test_rows_delivered_again_never_reach_the_merge(spark):
    folder, store = Folder(spark), TableStore(configure(spark), new_dir(spark, "store"))

    def run(now):
        return stream_sync(TableSync(store, "TEST", now), SPEC, folder.stream(arrival=True, max_files=1), folder.checkpoint, once_within="1 hour")

    pairs = [(str(k), "1") for k in range(20)]
    folder.add(pairs)
    folder.add(pairs)
    assert sum(b.scanned for b in run(DAY1)) == 20
    folder.add(pairs, files=2)
    folder.add([(str(k), "1") for k in range(20, 25)])
    again = run(DAY2)
    assert sum(b.scanned for b in again) == 5 and sum(b.inserted for b in again) == 5
    assert TableSync(store, "TEST", DAY2).target(SPEC).count() == 25
    # Counters and durations of all batches are kept, and add up.
    kept = TableSync(store, "TEST", DAY2).results().where("mode = 'stream'").collect()
    assert sum(r.inserted for r in kept) == 25 == sum(r.scanned for r in kept) and all(r.duration > 0 for r in kept)


def test_state_holds_rows_of_the_delay_only(spark):
    folder = Folder(spark)
    seen = []

    def run():
        rows = folder.stream(arrival=True, max_files=1)
        once = keyed.without_redelivery(rows, SPEC, "_arrived", "1 second")
        query = keyed.run_batches(once, folder.checkpoint, lambda b, _: seen.append(b.count()))
        return [json.loads(p.json)["stateOperators"][0] for p in query.recentProgress if json.loads(p.json)["stateOperators"]]

    folder.add([(str(k), "1") for k in range(30)])
    folder.add([(str(k), "1") for k in range(30)])
    assert run()[-1]["numRowsTotal"] == 30 and sum(seen) == 30
    time.sleep(3)
    folder.add([("x", "1")])
    run()
    time.sleep(3)
    folder.add([("y", "1")])
    folder.add([("z", "1")])
    assert run()[-1]["numRowsTotal"] < 10
    folder.add([("1", "1")])  # after its time a row passes again
    run()
    assert sum(seen) == 34


@pytest.mark.parametrize("parts", [1, 5])
def test_stream_over_a_folder_equals_one_over_a_file(spark, sf_dir, parts):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    folder = new_dir(spark, "tables")
    events.repartition(parts).write.parquet(f"{folder}/events.parquet")
    found = catalogue.QUERIES["stream_sync"](spark, folder)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, catalogue.QUERIES["stream_sync"](spark, sf_dir).collect()))
    assert found.count() == events.count() > 0


def test_batches_of_a_stream_are_observed(spark):
    """Sums over batches are the counters of one batch; durations and lags come with them."""
    folder, store, log = Folder(spark), TableStore(configure(spark), new_dir(spark, "store")), observed.BatchLog()
    spark.streams.addListener(log)
    try:
        folder.add([(str(k), "1") for k in range(7)] + [("null", "1")])
        assert len(folder.classes(DAY1, max_files=1)) == 7
        folder.add([("1", "1"), (None, "2")])
        folder.add([("2", "5")])
        assert len(folder.classes(DAY2, max_files=1)) == 2
        assert log.flush(store) == 3 and log.flush(store) == 0
    finally:
        spark.streams.removeListener(log)
    found = observed.batches(store)
    assert [(r.table_name, r.mode, r.scanned, r.errors) for r in found.orderBy("run_id", "batch_id").collect()].count(("BILL_MASTER", "stream", 8, 1)) == 1
    total = found.agg(F.sum("scanned"), F.sum("errors"), F.min("duration")).first()
    assert tuple(total)[:2] == (11, 2) and total[2] > 0
    histogram = metrics.duration_histogram(found, ["table_name", "mode"]).where("le = double('inf')").first()
    assert histogram.bucket_count == 3


def test_lag_of_a_batch_is_behind_the_newest_so_far(spark):
    store, log = TableStore(configure(spark), new_dir(spark, "store")), observed.BatchLog()
    at = lambda h: datetime(2024, 5, 1, h)
    log.entries = [("r", n, "T", "stream", 1, 0, t, 0.5) for n, t in enumerate([at(3), at(9), at(4), None])]
    assert log.flush(store) == 4
    log.entries = [("r", 4, "T", "stream", 1, 0, at(8), 0.5)]
    log.flush(store)
    found = {r.batch_id: r.lag_minutes for r in observed.batches(store).collect()}
    assert found == {0: 0.0, 1: 0.0, 2: 300.0, 3: None, 4: 60.0}
    assert metrics.lag_alerts(observed.batches(store)).count() == 1
