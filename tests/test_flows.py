"""Flows over small fixtures: checkpoints, merge, rejects, reconcile, prune, stream."""

import random
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators import keyset, merge, metrics
from tidemark.plans.flows import TableSync, prune_all, sync_cycle
from tidemark.session import configure, new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import CITIES, CUSTOMERS, RECEIPTS, RETURNS, SALES, SPECS
from tidemark.streaming.stream import read_stream, stream_sync

DAY1, DAY2, DAY3 = datetime(2024, 5, 1), datetime(2024, 5, 2), datetime(2024, 5, 3)
SCHEMA = "Bill_ID long, CUSTOMER_ID string, BILL_DATE string, NET_AMOUNT string, is_Ok string"


@pytest.fixture()
def store(spark):
    return TableStore(configure(spark), new_dir(spark, "store"))


def bills(spark, keys, amount=lambda k: f"{k}.50", date="03/04/24 10:11:12"):
    return spark.createDataFrame([(k, f"C{k % 3}", date, amount(k), "Yes") for k in keys], SCHEMA)


def at(store, ts=DAY1, **options):
    return TableSync(store, "TEST", ts, **options)


def rows(sync, spec=SALES, *columns):
    picked = sync.target(spec).select(spec.key.target, *columns).collect()
    return {r[0]: tuple(r[1:]) if len(columns) > 1 else (r[1] if columns else None) for r in picked}


def counts(result):
    return (result.scanned, result.inserted, result.updated, result.unchanged, result.superseded, result.errors)


def test_incremental_goes_on_from_the_checkpoint(spark, store):
    assert counts(at(store).incremental(SALES, bills(spark, range(1, 10)))) == (9, 9, 0, 0, 0, 0)
    assert at(store).checkpoint(SALES) == ("9", None)
    # 10..12 follow 9 in numeric order although not in text order.
    second = at(store, DAY2).incremental(SALES, bills(spark, range(1, 13)))
    assert counts(second) == (3, 3, 0, 0, 0, 0)
    found = rows(at(store), SALES, "net_amount", "is_ok", "created_at", "updated_at")
    assert len(found) == 12
    assert found["1"] == (1.5, 1, datetime(2024, 4, 3, 10, 11, 12), DAY1)
    assert found["12"][3] == DAY2
    assert counts(at(store, DAY3).incremental(SALES, bills(spark, range(1, 13)))) == (0, 0, 0, 0, 0, 0)
    assert at(store).checkpoint(SALES) == ("12", None)


def test_text_order_is_available(spark, store):
    spec = replace(SALES, key_order="text")
    source = bills(spark, range(1, 13))
    assert keyset.after(source, spec, "9").count() == 0
    assert {r.Bill_ID for r in keyset.after(source, spec, "11").collect()} == {12, *range(2, 10)}


def test_numeric_order_on_text_keys(spark):
    source = spark.createDataFrame([(k,) for k in ("9", " 10 ", "8", "A7", None)], "Bill_ID string")
    kept = {r.Bill_ID for r in keyset.after(source, SALES, "8").collect()}
    assert kept == {"9", " 10 ", "A7"}


def test_key_predicates_reach_the_scan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").withColumnsRenamed({"o_orderkey": "BILL_ID", "o_totalprice": "NET_AMOUNT"})
    plan = keyset.after(orders, SALES, "700").select("NET_AMOUNT")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderkey,700)" in plan and "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan
    both = orders.select(F.lit(None).cast("long").alias("x"), "*").toDF("Bill_ID", *orders.columns)
    assert keyset.after(both, SALES, "700").count() == keyset.after(orders, SALES, "700").count() > 0
    rows, end = keyset.chunk(orders, SALES, "700", 50)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert end == "750" and "LessThanOrEqual(o_orderkey,750)" in plan


def test_only_changed_rows_get_new_times(spark, store):
    at(store).full(SALES, bills(spark, range(100)))
    changed = bills(spark, range(110), amount=lambda k: "7" if k % 10 == 3 else f"{k}.50")
    assert counts(at(store, DAY2).full(SALES, changed)) == (110, 10, 10, 90, 0, 0)
    found = rows(at(store), SALES, "net_amount", "updated_at")
    assert found["3"] == (7.0, DAY2) and found["4"] == (4.5, DAY1) and found["109"] == (109.5, DAY2)


def test_second_run_changes_nothing(spark, store):
    source = bills(spark, range(50))
    at(store).full(SALES, source)
    before = sorted(map(tuple, at(store).target(SALES).collect()))
    assert counts(at(store, DAY2).full(SALES, source.orderBy(F.rand(3)))) == (50, 0, 0, 50, 0, 0)
    assert sorted(map(tuple, at(store).target(SALES).collect())) == before


def test_changed_row_is_queued_again_and_keeps_its_id(spark, store):
    at(store).full(SALES, bills(spark, range(3)))
    at(store).mark_processed(SALES, spark.createDataFrame([("1",), ("2",)], "bill_id string"))
    ids = rows(at(store), SALES, "raw_id")
    at(store, DAY2).full(SALES, bills(spark, range(3), amount=lambda k: "9" if k == 1 else f"{k}.50"))
    assert rows(at(store), SALES, "is_processed") == {"0": False, "1": False, "2": True}
    assert rows(at(store), SALES, "raw_id") == ids


def test_created_at_falls_back_to_the_run_and_is_kept(spark, store):
    at(store).full(SALES, bills(spark, [1], date="soon"))
    assert rows(at(store), SALES, "created_at", "bill_date")["1"] == (DAY1, "soon")
    at(store, DAY2).full(SALES, bills(spark, [1], date="later"))
    assert rows(at(store), SALES, "created_at", "updated_at")["1"] == (DAY1, DAY2)
    at(store, DAY3).full(SALES, bills(spark, [1], date="2020-02-29"))
    assert rows(at(store), SALES, "created_at")["1"] == datetime(2020, 2, 29)


def test_last_of_several_rows_wins(spark, store):
    spec = replace(SALES, seq=("arrived",))
    data = [(k % 7, "C", "2024-01-01", str(n), "1", n) for n, k in enumerate(range(700))]
    random.Random(2).shuffle(data)
    source = spark.createDataFrame(data, SCHEMA + ", arrived int").repartition(5)
    assert counts(at(store).full(spec, source)) == (700, 7, 0, 0, 693, 0)
    assert rows(at(store), spec, "net_amount") == {str(k): float(693 + k) for k in range(7)}


def test_hot_key_is_reduced_before_the_shuffle(spark):
    df = spark.range(0, 100, 1, 4).selectExpr("id % 2 AS key", "id AS seq")
    plan = merge.dedupe_last(df, "key", ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_bad_rows_are_set_aside_and_good_ones_stay(spark, store):
    spec = replace(SALES, checks=(("amount above limit", "net_amount <= 100"),))
    data = [("1", "5"), ("null", "6"), (None, "7"), ("4", "101"), ("5", None), ("6\x00", "1")]
    source = spark.createDataFrame(data, "Bill_ID string, NET_AMOUNT string").withColumn("extra", F.lit("x"))
    assert counts(at(store).incremental(spec, source)) == (6, 2, 0, 0, 0, 4)
    found = {(r.primary_key, r.error): r for r in at(store).failures().collect()}
    assert set(found) == {("null", "key is null after cleaning"), ("None", "key is null after cleaning"),
                          ("4", "amount above limit"), ("6\x00", "NUL character in bill_id")}
    bad = found["4", "amount above limit"]
    assert bad.payload == '{"Bill_ID":"4","NET_AMOUNT":"101","extra":"x"}'
    assert (bad.source_table, bad.retry_count, bad.timestamp) == ("BILL_MASTER", 0, DAY1)
    assert sorted(rows(at(store), spec)) == ["1", "5"]


def test_rows_that_need_the_exact_checksum(spark, store):
    """Non-ASCII names and rounding ties go through the same merge as plain rows."""
    schema = "CUSTOMER_ID string, CUSTOMER_NAME string, Opening_Balance double"
    first = [("1", "José", 2.00005), ("2", "Ann", 1.0), ("3", "ﬁx", 0.03125), ("4", "Bob", 5.0)]
    source = spark.createDataFrame(first, schema)
    assert counts(at(store).full(CUSTOMERS, source)) == (4, 4, 0, 0, 0, 0)
    again = [("1", "JOSÉ ", 2.00005), ("2", "Ann", 1.0), ("3", "fix", 0.03125), ("4", "Böb", 5.0)]
    assert counts(at(store, DAY2).full(CUSTOMERS, spark.createDataFrame(again, schema))) == (4, 0, 1, 3, 0, 0)
    assert rows(at(store), CUSTOMERS, "customer_name")["4"] == "Böb"
    assert all(c and len(c) == 64 for c in rows(at(store), CUSTOMERS, "checksum").values())


def test_reconcile_covers_every_key_once_and_wraps(spark, store):
    at(store).incremental(SALES, bills(spark, range(0, 20, 2)))
    source = bills(spark, range(20), amount=lambda k: "1")
    seen, ends = 0, []
    for _ in range(3):
        result = at(store, DAY2).reconcile(SALES, source, 8)
        seen += result.scanned
        ends.append(at(store).checkpoint(SALES)[1])
    assert (seen, ends) == (20, ["7", "15", None])
    assert rows(at(store), SALES, "net_amount") == {str(k): 1.0 for k in range(20)}
    assert at(store).checkpoint(SALES)[0] == "18"
    assert at(store, DAY3).reconcile(SALES, source, 8).unchanged == 8


def test_reconcile_passes_a_chunk_of_rejects(spark, store):
    source = spark.createDataFrame([("null", "1"), ("a", "1"), ("b", "1"), ("z", "1")], "Bill_ID string, NET_AMOUNT string")
    spec = replace(SALES, key_order="text")
    ends = []
    for _ in range(4):
        at(store).reconcile(spec, source, 2)
        ends.append(at(store).checkpoint(spec)[1])
    assert ends == ["b", "z", None, "b"]


def test_chunk_keeps_rows_of_one_key_together(spark):
    source = bills(spark, [1, 2, 2, 2, 3])
    found, end = keyset.chunk(source, SALES, None, 2)
    assert (found.count(), end) == (4, "2")


def test_late_rows_wait_for_the_reconcile(spark, store):
    at(store).incremental(SALES, bills(spark, [5, 6]))
    source = bills(spark, [3, 5, 6, 7])
    assert counts(at(store, DAY2).incremental(SALES, source)) == (1, 1, 0, 0, 0, 0)
    assert counts(at(store, DAY2).reconcile(SALES, source, 100)) == (4, 1, 0, 3, 0, 0)
    whole = at(store, DAY2)
    assert sorted(rows(whole)) == ["3", "5", "6", "7"]
    newer = bills(spark, [8], date="03/04/24 12:11:12")
    assert whole.lag(SALES, newer).first().lag_minutes == 120.0


def test_incremental_and_reconcile_equal_a_full_sync(spark, store):
    other = TableStore(spark, new_dir(spark, "store"))
    old, new = bills(spark, range(0, 30, 2)), bills(spark, range(40), amount=lambda k: str(k * k))
    for s in (store, other):
        at(s).full(SALES, old)
    at(store, DAY2).incremental(SALES, new)
    at(store, DAY2).reconcile(SALES, new, 1000)
    at(other, DAY2).full(SALES, new)
    assert sorted(map(tuple, at(store).target(SALES).collect())) == sorted(map(tuple, at(other).target(SALES).collect()))


def test_fingerprints_keep_first_and_change_times(spark, store):
    at(store).full(SALES, bills(spark, [1, 2]))
    at(store, DAY2).full(SALES, bills(spark, [1, 2, 3], amount=lambda k: "8" if k == 2 else f"{k}.50"))
    found = {r.entity_id: (r.first_seen_at, r.last_seen_at, r.last_changed_at) for r in at(store).fingerprints(SALES).collect()}
    assert found == {"1": (DAY1, DAY2, DAY1), "2": (DAY1, DAY2, DAY2), "3": (DAY2, DAY2, DAY2)}


def test_pruned_rows_come_back_unless_known_ones_are_skipped(spark, store):
    source = bills(spark, [1, 2, 3])
    at(store).full(SALES, source)
    at(store).mark_processed(SALES, spark.createDataFrame([("1",)], "bill_id string"))
    assert at(store, DAY2).prune(SALES) == 1
    assert counts(at(store, DAY2, skip_known=True).full(SALES, source))[:4] == (3, 0, 0, 0)
    assert sorted(rows(at(store))) == ["2", "3"]
    at(store, DAY3).full(SALES, source)
    assert rows(at(store), SALES, "is_processed") == {"1": False, "2": False, "3": False}


def test_prune_needs_both_processed_and_old(spark, store):
    at(store).full(SALES, bills(spark, range(6)))
    at(store).mark_processed(SALES, spark.createDataFrame([("0",), ("1",)], "bill_id string"))
    assert at(store, DAY1 + timedelta(days=3)).prune(SALES, 5) == 0
    assert at(store, DAY1 + timedelta(days=6)).prune(SALES, 5) == 2
    assert sorted(rows(at(store))) == ["2", "3", "4", "5"]


def test_returns_are_pruned_by_their_transaction_date(spark, store):
    source = spark.createDataFrame([("1", "2024-04-01"), ("2", "2024-04-20")], "RG_ID string, BILL_DATE string")
    at(store).full(RETURNS, source)
    at(store).mark_processed(RETURNS, spark.createDataFrame([("1",), ("2",)], "rg_id string"))
    assert at(store, DAY1).prune(RETURNS, 15) == 1
    assert sorted(rows(at(store), RETURNS)) == ["2"]


def test_prune_all_reports_each_table(spark, store):
    at(store).full(SALES, bills(spark, [1]))
    found = {r.table_name: (r.pruned, r.error) for r in prune_all(at(store), [SALES, CITIES]).collect()}
    assert found == {"raw_sales": (0, None), "raw_cities": (0, None)}


def test_cycle_runs_all_tables_and_one_failure_stops_no_other(spark, store):
    city = spark.createDataFrame([(1, "Rome", 7)], "City_ID int, City_Name string, Group_ID int")
    sources = {
        "City_Master": city, "CUSTOMER_MASTER": spark.createDataFrame([("x",)], "other string"),
        "BILL_MASTER": bills(spark, range(5)),
        "Receipt_Master": spark.createDataFrame([(1, "10")], "Receipt_ID int, Amount string"),
        "ReturnGoods": spark.createDataFrame([(1,)], "RG_ID int"),
    }
    sync = at(store, cycle_id="cycle-1")
    done = {(r.table_name, r.mode): r for r in sync_cycle(sync, sources, list(SPECS.values())).collect()}
    assert len(done) == 8 + 5  # every table is pruned first
    assert {r.pruned for (_, mode), r in done.items() if mode == "prune"} == {0}
    assert done["City_Master", "full"].inserted == 1
    assert done["BILL_MASTER", "reconcile"].unchanged == 5
    run = sync.runs().first()
    # A customer source without its key column gives rows without keys: one reject.
    assert done["CUSTOMER_MASTER", "full"].errors == 1
    assert (run.cycle_id, run.status, run.rows_scanned, run.rows_failed) == ("cycle-1", "FAILED", 16, 1)
    sources["BILL_MASTER"] = spark.createDataFrame([(1,)], "other int")
    del sources["ReturnGoods"]
    sources["CUSTOMER_MASTER"] = spark.createDataFrame([("1",)], "CUSTOMER_ID string")
    again = {(r.table_name, r.mode): r for r in sync_cycle(at(store, DAY2, cycle_id="cycle-2"), sources, list(SPECS.values())).collect()}
    assert "no key column" in again["BILL_MASTER", "incremental"].error
    assert again["Receipt_Master", "incremental"].error is None
    assert "ReturnGoods" in again["ReturnGoods", "reconcile"].error
    assert [(r.cycle_id, r.status) for r in sync.runs().orderBy("cycle_id").collect()] == [("cycle-1", "FAILED"), ("cycle-2", "FAILED")]
    stored = sync.results().groupBy("cycle_id").count().collect()
    assert {r.cycle_id: r["count"] for r in stored} == {"cycle-1": 13, "cycle-2": 13}


def test_crash_before_the_checkpoint_is_repaired_by_a_rerun(spark, store, monkeypatch):
    source = bills(spark, range(8))
    broken = at(store)
    monkeypatch.setattr(broken, "_advance", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        broken.incremental(SALES, source)
    assert at(store).checkpoint(SALES) == (None, None)
    assert counts(at(store, DAY2).incremental(SALES, source)) == (8, 0, 0, 8, 0, 0)
    assert at(store).checkpoint(SALES) == ("7", None)
    assert len(rows(at(store))) == 8


def test_stream_equals_batch_and_restart_adds_nothing(spark, store):
    folder = new_dir(spark, "incoming")
    schema = "Receipt_ID long, Receipt_Date timestamp, Amount double, Receipt_Type string"
    data = [(k, datetime(2024, 1, 1) + timedelta(hours=k), k / 4, "cash") for k in range(40)]
    for part in (data[:25], data[25:]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(folder)
    state, other = new_dir(spark, "stream"), TableStore(spark, new_dir(spark, "store"))
    events = lambda: read_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)
    batches = stream_sync(at(store), RECEIPTS, events(), state)
    assert sum(b.inserted for b in batches) == 40 and len(batches) > 1
    at(other).incremental(RECEIPTS, spark.read.parquet(folder))
    assert sorted(map(tuple, at(store).target(RECEIPTS).collect())) == sorted(map(tuple, at(other).target(RECEIPTS).collect()))
    assert at(store).checkpoint(RECEIPTS)[0] == "39"
    assert stream_sync(at(store, DAY2), RECEIPTS, events(), state) == []
    replay = stream_sync(at(store, DAY2), RECEIPTS, events(), new_dir(spark, "stream"))
    assert sum(b.unchanged for b in replay) == 40 and not any(b.inserted or b.updated for b in replay)
    old = stream_sync(at(store, DAY2), RECEIPTS, events(), new_dir(spark, "stream"), skip_old=True)
    assert sum(b.scanned for b in old) == 0


def test_large_and_small_batches_merge_alike(spark, store):
    """Whether a side is broadcast is for measured sizes to say; the results are the same."""
    other = TableStore(spark, new_dir(spark, "store"))
    old, new = bills(spark, range(30)), bills(spark, range(10, 50), amount=lambda k: str(k // 2))
    results = []
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    for s, limit in ((store, before), (other, "-1")):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        at(s).full(SALES, old)
        results.append(counts(at(s, DAY2).full(SALES, new)))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert results[0] == results[1]
    assert sorted(map(tuple, at(store).target(SALES).collect())) == sorted(map(tuple, at(other).target(SALES).collect()))
    assert sorted(map(tuple, at(store).fingerprints(SALES).collect())) == sorted(map(tuple, at(other).fingerprints(SALES).collect()))


def test_failed_merge_leaves_no_fingerprints_behind(spark, store, monkeypatch):
    """With skip_known a rerun after a failed write finds all rows still to be done."""
    def fails(*args):
        raise OSError("target is away")

    sync = TableSync(store, "BILLING", DAY1, skip_known=True)
    monkeypatch.setattr(sync, "_merge", fails)
    with pytest.raises(OSError):
        sync.full(SALES, bills(spark, range(8)))
    again = TableSync(store, "BILLING", DAY2, skip_known=True).full(SALES, bills(spark, range(8)))
    assert (again.inserted, again.superseded, again.known) == (8, 0, 0)
    third = TableSync(store, "BILLING", DAY3, skip_known=True).full(SALES, bills(spark, range(9)))
    assert (third.inserted, third.superseded, third.known) == (1, 0, 8)
    assert len(rows(at(store), SALES)) == 9


def test_tables_with_rejects_side_by_side(spark, store):
    specs = [replace(SALES, source_table=f"T{k}", target_table=f"raw_t{k}") for k in range(5)]
    source = spark.createDataFrame([("null", "5"), ("1", "6")], "Bill_ID string, NET_AMOUNT string")
    sync = TableSync(store, "BILLING", DAY1, "c")
    done = sync_cycle(sync, {s.source_table: source for s in specs}, specs, workers=5).collect()
    assert all(r.error is None for r in done)
    assert sorted(r.source_table for r in sync.failures().collect()) == sorted(s.source_table for s in specs)


def test_rejects_delivered_twice_are_kept_once(spark, store):
    source = spark.createDataFrame([("null", "5"), (None, "6"), ("1", "6")], "Bill_ID string, NET_AMOUNT string")
    for day in (DAY1, DAY2):
        at(store, day).full(SALES, source)
    assert at(store).failures().count() == 2


def test_a_run_that_throws_is_closed(spark, store, monkeypatch):
    import tidemark.plans.flows as flows

    def fails(*args):
        raise OSError("no workers")

    monkeypatch.setattr(flows, "_run_tasks", fails)
    with pytest.raises(OSError):
        sync_cycle(TableSync(store, "BILLING", DAY1, "c1"), {}, [])
    assert [(r.cycle_id, r.status) for r in at(store).runs().collect()] == [("c1", "FAILED")]


def test_runs_that_never_ended_are_closed_by_the_next(spark, store, monkeypatch):
    import tidemark.plans.flows as flows

    monkeypatch.setattr(flows, "_close_run", lambda *a: None)
    sync_cycle(at(store, cycle_id="lost"), {}, [])
    monkeypatch.undo()
    assert at(store).runs().first().status == "RUNNING"
    sync_cycle(at(store, DAY2, cycle_id="next"), {}, [])
    found = {r.cycle_id: (r.status, r.start_time, r.end_time) for r in at(store).runs().collect()}
    assert found["lost"] == ("INTERRUPTED", DAY1, DAY2) and found["next"][1] == DAY2


def test_lag_after_an_incremental_run_and_its_alert(spark, store):
    late = bills(spark, [5], date="03/04/24 10:11:12").unionByName(bills(spark, [1], date="03/04/24 14:11:12"))
    at(store).incremental(SALES, bills(spark, [4]))
    # The newest row has a key below the checkpoint, so the target stays four hours behind.
    tasks = sync_cycle(at(store, DAY2, cycle_id="c"), {"BILL_MASTER": late}, [SALES])
    found = {r.mode: r.lag_minutes for r in tasks.collect()}
    assert found == {"prune": None, "incremental": 240.0, "reconcile": None}
    assert [(r.table_name, r.lag_minutes) for r in metrics.lag_alerts(tasks).collect()] == [("BILL_MASTER", 240.0)]
    assert at(store, DAY2).results().where("mode = 'incremental'").first().lag_minutes == 240.0


def test_prune_is_a_task_of_the_cycle(spark, store):
    at(store).full(SALES, bills(spark, range(6)))
    at(store).mark_processed(SALES, spark.createDataFrame([("0",), ("1",)], "bill_id string"))
    tasks = sync_cycle(at(store, DAY2, cycle_id="c"), {"BILL_MASTER": bills(spark, [])}, [SALES]).collect()
    assert [(r.mode, r.pruned, r.error) for r in tasks if r.mode == "prune"] == [("prune", 2, None)]
    assert sorted(rows(at(store))) == ["2", "3", "4", "5"]


def test_idle_runs_write_no_base(spark, store):
    at(store).full(SALES, bills(spark, range(5)))
    before = store.bases(SALES.target_table)
    at(store, DAY2).full(SALES, bills(spark, range(5)))
    at(store, DAY2).prune(SALES)
    assert store.bases(SALES.target_table) == before


def test_chunk_ends_for_all_kinds_of_keys(spark):
    ids = random.Random(6).sample(range(-10**12, 10**12), 700)
    frames = {
        "long": spark.createDataFrame([(k,) for k in ids], "Bill_ID long"),
        "decimal(20,0)": spark.createDataFrame([(k,) for k in ids], "Bill_ID long").selectExpr("CAST(Bill_ID AS decimal(20,0)) AS Bill_ID"),
        "string": spark.createDataFrame([(str(k),) for k in ids], "Bill_ID string"),
    }
    for df in frames.values():
        picked, end = keyset.chunk(df, SALES, None, 123)
        assert end == str(sorted(ids)[122]) and picked.count() == 123
        assert keyset.chunk(df, SALES, None, 701)[1] is None
    text = replace(SALES, key_order="text")
    picked, end = keyset.chunk(frames["string"], text, None, 250)
    assert end == sorted(map(str, ids))[249] and picked.count() == 250


def test_decimal_keys_reach_the_source_and_doubles_are_refused(spark):
    path = new_dir(spark, "decimals")
    spark.range(100).selectExpr("CAST(id AS decimal(20,0)) AS Bill_ID").write.parquet(path)
    plan = keyset.after(spark.read.parquet(path), SALES, "50")._jdf.queryExecution().toString()
    assert "GreaterThan(Bill_ID,50)" in plan
    with pytest.raises(ValueError, match="floating-point"):
        keyset.after(spark.range(3).selectExpr("CAST(id AS double) AS Bill_ID"), SALES, "1")
