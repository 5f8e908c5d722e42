"""What a first load and a repair of most rows leave undone: moving, staging and cleaning rows twice."""

from datetime import datetime

from pyspark.sql import functions as F

from tidemark.functions import clean_text, parse_amount
from tidemark.functions.identity import fixed4, needs_exact
from tidemark.operators import digests
from tidemark.plans.flows import TableSync
from tidemark.session import configure, new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import SALES

DAY1, DAY2 = datetime(2024, 5, 1), datetime(2024, 5, 2)


def sync(spark, ts=DAY1):
    return TableSync(TableStore(configure(spark), new_dir(spark, "store")), "TEST", ts)


def test_first_load_deals_its_rows_once(spark, monkeypatch):
    s, written = sync(spark), {}
    write = TableStore._write

    def noted(store, rows, path, key, buckets):
        written[path.removeprefix(store.root)] = rows._jdf.queryExecution().executedPlan().toString()
        write(store, rows, path, key, buckets)

    monkeypatch.setattr(TableStore, "_write", noted)
    source = spark.range(300).selectExpr("CAST(id % 200 AS string) AS Bill_ID", "CAST(id AS string) AS NET_AMOUNT")
    result = s.full(SALES, source)
    assert (result.scanned, result.inserted, result.superseded) == (300, 200, 100)
    assert sorted(written) == ["/raw_sales/base-1-2", "/sync_fingerprints/raw_sales/base-1-2"]
    assert written["/raw_sales/base-1-2"].count("Exchange") == 1
    assert "Exchange" not in written["/sync_fingerprints/raw_sales/base-1-2"]
    seen, stored = s.fingerprints(SALES), s.target(SALES)
    assert stored.join(seen, F.col("bill_id") == F.col("entity_id")).where(stored["checksum"] == seen["checksum"]).count() == 200
    assert seen.where("first_seen_at = last_seen_at AND first_seen_at = last_changed_at").count() == 200


def test_ranges_that_hold_most_rows_are_not_cut_again(spark):
    source = spark.range(20_000).selectExpr("id AS Bill_ID", "CAST(id AS string) AS NET_AMOUNT")
    s = sync(spark)
    s.full(SALES, source)
    bits = {}
    for every in (3, 300):
        path = new_dir(spark, "bills")
        source.withColumn("NET_AMOUNT", F.expr(f"IF(Bill_ID % {every} = 0, '-1', NET_AMOUNT)")).write.parquet(path)
        now = spark.read.parquet(path)
        found = digests.open_ranges(now, s.target(SALES), SALES)
        bits[every] = found.bits
        plan = found.rows(digests.good_rows(now, SALES), SALES)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
        assert digests.differences(now, s.target(SALES), SALES).count() == -(-20_000 // every)
    assert bits == {3: 3, 300: 0}
    again = TableSync(s.store, "TEST", DAY2).repair(SALES, now)
    assert (again.updated, again.inserted) == (67, 0) and again.scanned < 200


def test_cleaning_spares_plain_values_patterns_and_decimals(spark):
    """What cleaning and hashing did to every value, whatever it held."""
    path = new_dir(spark, "plain")
    texts = ["12.50", "-.5", "+7", "12.", "1-2", "1.2.3", "--5", ".", "-", "5e3", "b'8.25'", "NULL", " none ", "\\x41", "blue", "٣.5"]
    amounts = [2.5, -0.0, -3e-5, 0.00004, 0.12344, -1234.56784, 99999999999.4321, 1e11, 0.00005, 7.00005, None, 12.0, -0.7, 3.99996, 1e-4, -5.5]
    spark.createDataFrame(list(zip(texts, amounts)), "t string, a double").write.parquet(path)
    rows = spark.read.parquet(path)
    got = rows.select("t", "a", parse_amount(F.col("t")).alias("n"), clean_text(F.col("t")).alias("c"), fixed4(F.col("a")).alias("f"), needs_exact(F.col("a")).alias("odd"))
    numbers = [12.5, -0.5, 7.0, 12.0, 1.0, 1.2, -5.0, None, None, 5.0, 8.25, None, None, 41.0, None, 3.5]
    want = dict(zip(texts, numbers))
    cleaned = {"b'8.25'": "8.25", "NULL": None, " none ": None}
    for r in got.collect():
        assert r.n == want[r.t] and r.c == cleaned.get(r.t, r.t), r
        assert r.a is None and r.f is None or r.odd or r.f == f"{r.a:.4f}", r
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "decimal(20,4)" not in plan and "(?i)" not in plan and "0123456789.-+" in plan
