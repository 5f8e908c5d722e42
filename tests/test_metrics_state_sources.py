"""State tables, metrics and sources on small fixtures."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import metrics, state
from tidemark.operators.curate import clean_table, curate, map_to_raw
from tidemark.session import configure, shared_dir
from tidemark.sources.readers import read_files, sql_source, table_probe
from tidemark.sources.snapshot import source_changes, source_is_usable, source_snapshot
from tidemark.specs import CHECKPOINT_SCHEMA, CUSTOMERS, RETURNS, RUN_SCHEMA, SALES, TASK_SCHEMA

T1, T2 = datetime(2024, 1, 1), datetime(2024, 1, 2)


def test_checkpoints_keep_values_that_are_not_given(spark):
    old = spark.createDataFrame([("a", "10", "5", T1, "c1", "SUCCESS", T1), ("b", "1", "1", T1, "c1", "SUCCESS", T1)], CHECKPOINT_SCHEMA)
    new = spark.createDataFrame(
        [("a", None, None, "c2", "SUCCESS", True), ("c", "7", None, "c2", "SUCCESS", False)],
        "table_name string, last_sync_key string, last_reconcile_key string, cycle_id string, status string, reset_reconcile boolean")
    found = {r.table_name: tuple(r)[1:] for r in state.advance_checkpoints(old, new, T2).collect()}
    assert found["a"] == ("10", None, T2, "c2", "SUCCESS", T2)
    assert found["b"] == ("1", "1", T1, "c1", "SUCCESS", T1)
    assert found["c"] == ("7", None, T2, "c2", "SUCCESS", T2)
    assert tuple(state.checkpoint_inventory(old).first()) == (2, T1, T1)


def test_runs_open_close_and_go_stale(spark):
    log = state.open_runs(spark.createDataFrame([], RUN_SCHEMA), spark.createDataFrame([("c1", T1), ("c2", T1)], "cycle_id string, start_time timestamp"))
    done = spark.createDataFrame([("c1", T2, 5.0, 10, 8, 2, "FAILED")], "cycle_id string, end_time timestamp, duration double, rows_scanned long, rows_updated long, rows_failed long, status string")
    log = state.interrupt_stale_runs(state.close_runs(log, done), T2)
    found = {r.cycle_id: tuple(r)[1:] for r in log.collect()}
    assert found == {"c1": (T1, T2, 5.0, 10, 8, 2, "FAILED"), "c2": (T1, T2, None, None, None, None, "INTERRUPTED")}


def test_rollup_counters_and_histogram(spark):
    rows = [("c1", "a", "full", 10, 1, 2, 7, 0, 0, 0.3, None), ("c1", "b", "incremental", 5, 1, 0, 0, 2, 2, 4.0, "lost"),
            ("c2", "a", "full", 3, 3, 0, 0, 0, 0, 20.0, None)]
    tasks = spark.createDataFrame(rows, TASK_SCHEMA)
    times = spark.createDataFrame([("c1", 4.0), ("c2", 0.0)], "cycle_id string, duration double")
    found = {r.cycle_id: tuple(r)[1:] for r in metrics.cycle_rollup(tasks, times).collect()}
    assert found == {"c1": (15, 13, 2, "b (incremental)", 4.0, 3.75, "FAILED"), "c2": (3, 3, 0, "", 0.0, 0.0, "SUCCESS")}
    assert {tuple(r) for r in metrics.row_counters(tasks).collect()} == {
        ("a", "full", "rows", "success", 13), ("b", "incremental", "rows", "success", 3),
        ("b", "incremental", "rows", "failed", 2), ("b", "incremental", "errors", "row_failure", 2)}
    h = {r.le: r.bucket_count for r in metrics.duration_histogram(tasks, ["mode"], (0.1, 0.5, float("inf"))).where("mode = 'full'").collect()}
    assert h == {0.1: 0, 0.5: 1, float("inf"): 2}


def test_lag_parses_before_the_maximum(spark):
    source = spark.createDataFrame([(1, "31/12/23 00:00:00"), (2, "01/02/24 06:00:00"), (3, "never")], "Bill_ID int, BILL_DATE string")
    target = spark.createDataFrame([(datetime(2024, 2, 1),), (None,)], "created_at timestamp")
    lag = metrics.sync_lag(source, target, SALES)
    assert lag.first().lag_minutes == 360.0
    assert tuple(metrics.lag_alerts(lag, 120).first()) == ("lag threshold exceeded", "BILL_MASTER", 360.0, 120.0)
    assert metrics.lag_alerts(lag, 360).count() == 0
    ahead = spark.createDataFrame([(datetime(2025, 1, 1),)], "created_at timestamp")
    assert metrics.sync_lag(source, ahead, SALES).first().lag_minutes == 0.0
    assert metrics.sync_lag(source, ahead.limit(0), SALES).count() == 0


def test_columns_resolve_in_any_case(spark):
    df = spark.createDataFrame([("1", None, "b", "x", 9)], "customer_id string, CUSTOMER_NAME string, Customer_Name string, ` CITY_ID ` string, extra int")
    row = curate(df, CUSTOMERS).first()
    assert tuple(row) == ("1", "b", "x", None, None)
    mixed = spark.createDataFrame([(None, 5)], "Opening_Balance double, OPENING_BALANCE int")
    assert clean_table(mixed, CUSTOMERS).first().opening_balance == 5.0


def test_mapped_return_row(spark):
    df = spark.createDataFrame([("R1", " c1 ", "2023-12-31", "50")], "RG_ID string, customer_id string, BILL_DATE string, NET_AMOUNT string")
    row = map_to_raw(df, RETURNS, "TEST").first()
    assert (row.rg_id, row.customer_id, row.rgtype, row.net_amount, row.is_ok) == ("R1", "c1", None, 50.0, 0)
    assert (row.is_processed, row.source_system, row.created_at) == (False, "TEST", datetime(2023, 12, 31))
    with pytest.raises(ValueError):
        map_to_raw(df, RETURNS, "")


def test_typed_and_printed_dates_agree(spark):
    df = spark.sql("select 1 Bill_ID, explode(array(timestamp_ntz'2024-01-02 03:04:05', timestamp_ntz'2024-01-02 03:04:05.25', null)) BILL_DATE")
    typed = map_to_raw(df, SALES, "T").select("bill_date", "created_at", "checksum").collect()
    printed = map_to_raw(curate(df, SALES).select(F.col("bill_id").alias("Bill_ID"), F.lit(None).alias("x"), F.expr(
        "case when date_trunc('second', bill_date) = bill_date then date_format(bill_date, 'yyyy-MM-dd HH:mm:ss') else date_format(bill_date, 'yyyy-MM-dd HH:mm:ss.SSSSSS') end").alias("BILL_DATE")), SALES, "T")
    assert sorted(map(str, typed)) == sorted(map(str, printed.select("bill_date", "created_at", "checksum").collect()))


def test_filter_on_mapped_dates_stays_compiled(spark):
    df = spark.createDataFrame([(str(k), f"0{k % 9 + 1}/02/24 10:00:00") for k in range(50)], "Bill_ID string, BILL_DATE string")
    mapped = map_to_raw(df, SALES, "T")
    assert mapped.where("created_at >= '2024-02-05'").count() == sum(k % 9 >= 4 for k in range(50))
    plan = mapped.where("created_at >= '2024-02-05'")._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 60000


def test_sources(spark, tmp_path):
    configure(spark)
    path = str(tmp_path / "in")
    spark.range(5).selectExpr("id", "id * 2 AS v").write.json(path)
    with pytest.raises(ValueError):
        read_files(spark, path, "json")
    df = read_files(spark, path, "json", spark.createDataFrame([], "id long, v long").schema)
    assert sql_source(spark, "SELECT sum(v) AS s FROM {t} WHERE id > :k", {"k": 2}, t=df).first().s == 14
    probe = [tuple(r) for r in table_probe(df, "t", "id").collect()]
    assert probe == [("t", 1, "id", "bigint", "0"), ("t", 2, "v", "bigint", "0")]


def test_source_files_changes(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for n in ("same", "edited", "removed"):
        (folder / n).write_text(n)
    before = source_snapshot(spark, str(folder)).collect()
    before = spark.createDataFrame(before)
    (folder / "edited").write_text("edited!")
    os.remove(folder / "removed")
    (folder / "empty").write_text("")
    now = source_snapshot(spark, str(folder))
    found = {r.path.split("/")[-1]: (r.status, r.hash_changed, r.size_changed, r.is_empty) for r in source_changes(before, now).collect()}
    assert found == {"same": ("same", False, False, False), "edited": ("changed", True, True, False),
                     "removed": ("removed", False, False, False), "empty": ("added", False, False, True)}
    assert not source_is_usable(now) and source_is_usable(before)
    large = source_snapshot(spark, str(folder), hash_limit=6)
    assert {r.path.split("/")[-1]: r.sha256 is None for r in large.collect()} == {"same": False, "edited": True, "empty": False}


def test_scratch_folder_comes_from_the_session(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
