"""A batch that changes little writes little: deltas beside the base of a table, folded where they grow."""

import random

import pytest
from pyspark.sql import functions as F

from test_flows import DAY1, DAY2, SCHEMA, at, bills, rows, store  # noqa: F401
from tidemark.specs import SALES
from tidemark.operators import digests


@pytest.mark.parametrize("skip_known", [False, True])
def test_batches_of_all_sizes_equal_a_dictionary(spark, store, skip_known):  # noqa: F811
    rnd, model, layers = random.Random(3), {}, []
    for n, size in enumerate([300, 5, 3, 0, 20, 9, 150, 2]):
        batch = {k: rnd.randint(0, 3) for k in rnd.sample(range(300 + 10 * n), size)}
        old = dict(model)
        model |= batch
        data = [(k, "C", "2024-01-01", str(v), "1") for k, v in batch.items()]
        result = at(store, DAY2, skip_known=skip_known).full(SALES, spark.createDataFrame(data, SCHEMA))
        new, same = len(batch.keys() - old.keys()), sum(old.get(k) == v for k, v in batch.items())
        assert (result.inserted, result.updated) == (new, size - new - same)
        assert (result.known if skip_known else result.unchanged) == same and result.superseded == 0
        assert rows(at(store), SALES, "net_amount") == {str(k): float(v) for k, v in model.items()}
        prints = at(store).fingerprints(SALES).select("entity_id", "checksum").collect()
        kept = rows(at(store), SALES, "checksum")
        assert len(prints) == len(kept) and dict(map(tuple, prints)) == kept
        layers.append((store.bases("raw_sales")[-1], store.delta("raw_sales")))
    # Small batches left the base of 300 rows as it was, the large one folded all into the next.
    assert layers[1][0] == layers[0][0] and layers[1][1] is not None and layers[6] == (layers[6][0], None)
    assert digests.open_ranges(at(store).target(SALES).select(F.col("bill_id").alias("Bill_ID"), F.col("customer_id").alias("CUSTOMER_ID"),
        F.col("bill_date").alias("BILL_DATE"), F.col("net_amount").alias("NET_AMOUNT"), F.col("is_ok").alias("is_Ok")), at(store).target(SALES), SALES) is None


def test_delta_is_pruned_and_marked_with_its_base(spark, store):  # noqa: F811
    at(store).full(SALES, bills(spark, range(100)))
    at(store, DAY2).full(SALES, bills(spark, [3, 200], amount=lambda k: "9"))
    assert store.delta("raw_sales") and at(store).target(SALES).count() == 101
    found = rows(at(store), SALES, "net_amount", "created_at", "updated_at")
    assert found["3"][0] == 9.0 and found["3"][2] == DAY2 and found["4"][2] == DAY1
    at(store).mark_processed(SALES, spark.createDataFrame([("3",), ("4",)], "bill_id string"))
    assert at(store, DAY2).prune(SALES, -1) == 2
    assert at(store).target(SALES).count() == 99 and "3" not in rows(at(store))


def test_unfinished_delta_is_not_read(spark, store):  # noqa: F811
    import os

    at(store).full(SALES, bills(spark, range(100)))
    at(store, DAY2).full(SALES, bills(spark, [3], amount=lambda k: "9"))
    os.remove(f"{store.root}/raw_sales/{store.delta('raw_sales')}/_SUCCESS")
    assert rows(at(store), SALES, "net_amount")["3"] == 3.5
    at(store, DAY2).full(SALES, bills(spark, [3], amount=lambda k: "9"))
    assert rows(at(store), SALES, "net_amount")["3"] == 9.0


def test_digests_clean_every_value_once(spark):
    """The filter of rejects stays above the cleaning."""
    source = spark.range(5).selectExpr("id AS Bill_ID", "concat('C', id) AS CUSTOMER_ID", "'x' AS BILL_DATE")
    plan = digests.hashed(source, SALES, False)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("CollectMetrics"):]
    assert "Filter" in plan[:plan.index("CollectMetrics")] and "Filter" not in below, plan
