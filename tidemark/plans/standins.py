"""The generated test tables in the roles of the five billing tables."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.specs import CITIES, CUSTOMERS, RECEIPTS, RETURNS, SALES, TableSpec

SOURCE_SYSTEM = "BILLING"
FIRST_RUN = datetime(2024, 6, 1, 0, 0, 0)
SECOND_RUN = datetime(2024, 6, 2, 0, 0, 0)

# Line items have no key of their own; order and line make one, with duplicates whose
# arrival order is part, supplier, ship date, quantity.
RETURN_ROWS = replace(
    RETURNS, key_order="text", seq=("part", "supplier", "shipped", "quantity")
)
STANDINS: dict[str, TableSpec] = {
    s.source_table: s for s in (CITIES, CUSTOMERS, SALES, RECEIPTS, RETURN_ROWS)
}


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def cities(nation: DataFrame) -> DataFrame:
    return nation.selectExpr("n_nationkey AS City_ID", "n_name AS City_Name", "n_regionkey AS Group_ID")


def customers(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "c_custkey AS CUSTOMER_ID", "c_name AS CUSTOMER_NAME", "c_nationkey AS City_ID",
        "c_acctbal AS Opening_Balance", "c_mktsegment AS segment",
    )


def sales(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS Bill_ID", "o_custkey AS CUSTOMER_ID", "o_orderdate AS BILL_DATE",
        "o_totalprice AS NET_AMOUNT", "o_orderstatus AS is_Ok", "o_orderpriority AS priority",
    )


def receipts(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS Receipt_ID", "user_id AS Customer_ID", "ts AS Receipt_Date", "value AS Amount",
        "get_json_object(props, '$.k') AS Discount", "event_type AS Receipt_Type",
    )


def returns(lineitem: DataFrame) -> DataFrame:
    return lineitem.where("l_returnflag = 'R'").selectExpr(
        "concat(l_orderkey, '-', l_linenumber) AS RG_ID", "l_suppkey AS CUSTOMER_ID",
        "l_linestatus AS RGTYPE", "l_shipdate AS BILL_DATE", "l_extendedprice AS NET_AMOUNT",
        "l_partkey AS part", "l_suppkey AS supplier", "l_shipdate AS shipped", "l_quantity AS quantity",
    )


def sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All five sources as they are now."""
    return {
        CITIES.source_table: cities(load(spark, sf_dir, "nation")),
        CUSTOMERS.source_table: customers(load(spark, sf_dir, "customer")),
        SALES.source_table: sales(load(spark, sf_dir, "orders")),
        RECEIPTS.source_table: receipts(load(spark, sf_dir, "events")),
        RETURNS.source_table: returns(load(spark, sf_dir, "lineitem")),
    }


def earlier_sources(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The sources as an earlier run saw them: later rows missing, some values different.

    Keys do not follow dates, so a good part of what is missing lies below the highest key.
    """
    nation = load(spark, sf_dir, "nation").withColumn("n_name", F.concat("n_name", F.lit(" (old)")))
    customer = load(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.expr("CASE WHEN c_mktsegment = 'MACHINERY' THEN c_acctbal + 1 ELSE c_acctbal END")
    )
    events = load(spark, sf_dir, "events").where("ts < TIMESTAMP_NTZ'2024-01-20 00:00:00'").withColumn(
        "value", F.expr("CASE WHEN event_type = 'click' THEN value + 1 ELSE value END")
    )
    lineitem = load(spark, sf_dir, "lineitem").where("l_shipdate < TIMESTAMP_NTZ'2000-01-01 00:00:00'")
    return {
        CITIES.source_table: cities(nation),
        CUSTOMERS.source_table: customers(customer),
        SALES.source_table: sales(earlier_orders(spark, sf_dir)),
        RECEIPTS.source_table: receipts(events),
        RETURNS.source_table: returns(lineitem),
    }


def earlier_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = load(spark, sf_dir, "orders").where("o_orderdate < TIMESTAMP_NTZ'2000-04-01 00:00:00'")
    price = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END"
    return orders.withColumn("o_totalprice", F.expr(price))
