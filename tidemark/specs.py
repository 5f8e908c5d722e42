"""Table specifications: which source columns become which target columns, and the
schemas of the target and state tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

KEY, TEXT, DATE_TEXT, AMOUNT, FLAG = "key", "text", "date_text", "amount", "flag"

KIND_TYPES = {
    KEY: T.StringType(),
    TEXT: T.StringType(),
    DATE_TEXT: T.StringType(),
    AMOUNT: T.DoubleType(),
    FLAG: T.IntegerType(),
}


@dataclass(frozen=True)
class Field:
    source: str
    target: str
    kind: str = TEXT


@dataclass(frozen=True)
class TableSpec:
    """One synchronised table.

    ``key_order`` says how checkpoint keys compare: ``long`` for numeric keys, ``text``
    for text order. ``seq`` names source columns that give arrival order, so that the
    last of several rows with one key wins. ``checks`` are extra row constraints, each a
    pair of a reason and a SQL predicate over the mapped columns that a good row meets.
    """

    source_table: str
    target_table: str
    fields: tuple[Field, ...]
    mode: str = "incremental"
    key_order: str = "long"
    has_updated_at: bool = True
    seq: tuple[str, ...] = ()
    checks: tuple[tuple[str, str], ...] = ()

    @property
    def key(self) -> Field:
        return next(f for f in self.fields if f.kind == KEY)

    @property
    def date(self) -> Field | None:
        return next((f for f in self.fields if f.kind == DATE_TEXT), None)

    @property
    def entity_columns(self) -> list[str]:
        return [f.target for f in self.fields]

    @property
    def prune_clock(self) -> str:
        return "updated_at" if self.has_updated_at else "created_at"

    @property
    def entity_schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.target, KIND_TYPES[f.kind]) for f in self.fields])

    @property
    def raw_schema(self) -> T.StructType:
        extra = [
            T.StructField("raw_id", T.StringType()),
            T.StructField("checksum", T.StringType()),
            T.StructField("source_system", T.StringType()),
            T.StructField("is_processed", T.BooleanType()),
            T.StructField("created_at", T.TimestampType()),
        ]
        if self.has_updated_at:
            extra.append(T.StructField("updated_at", T.TimestampType()))
        return T.StructType(list(self.entity_schema) + extra)


# Source tables, keys and column names of the billing data model. The source
# table name is part of the row id, the target names are part of the checksum.
CITIES = TableSpec(
    source_table="City_Master",
    target_table="raw_cities",
    mode="full",
    fields=(
        Field("City_ID", "city_id", KEY),
        Field("City_Name", "city_name"),
        Field("Group_ID", "group_id"),
    ),
)
CUSTOMERS = TableSpec(
    source_table="CUSTOMER_MASTER",
    target_table="raw_customers",
    mode="full",
    fields=(
        Field("CUSTOMER_ID", "customer_id", KEY),
        Field("CUSTOMER_NAME", "customer_name"),
        Field("City_ID", "city_id"),
        Field("MOBILE1", "mobile1"),
        Field("Opening_Balance", "opening_balance", AMOUNT),
    ),
)
SALES = TableSpec(
    source_table="BILL_MASTER",
    target_table="raw_sales",
    fields=(
        Field("Bill_ID", "bill_id", KEY),
        Field("CUSTOMER_ID", "customer_id"),
        Field("BILL_DATE", "bill_date", DATE_TEXT),
        Field("NET_AMOUNT", "net_amount", AMOUNT),
        Field("Dis_Amt", "dis_amt", AMOUNT),
        Field("is_Ok", "is_ok", FLAG),
    ),
)
RECEIPTS = TableSpec(
    source_table="Receipt_Master",
    target_table="raw_receipts",
    fields=(
        Field("Receipt_ID", "receipt_id", KEY),
        Field("Customer_ID", "customer_id"),
        Field("Receipt_Date", "receipt_date", DATE_TEXT),
        Field("Amount", "amount", AMOUNT),
        Field("Discount", "discount", AMOUNT),
        Field("Bank_Name", "bank_name"),
        Field("Receipt_Type", "receipt_type"),
        Field("is_Ok", "is_ok", FLAG),
    ),
)
RETURNS = TableSpec(
    source_table="ReturnGoods",
    target_table="raw_rg",
    has_updated_at=False,
    fields=(
        Field("RG_ID", "rg_id", KEY),
        Field("CUSTOMER_ID", "customer_id"),
        Field("RGTYPE", "rgtype"),
        Field("BILL_DATE", "bill_date", DATE_TEXT),
        Field("NET_AMOUNT", "net_amount", AMOUNT),
        Field("is_Ok", "is_ok", FLAG),
    ),
)

# Masters first, then the transaction tables: the order in which a cycle runs them.
SPECS: dict[str, TableSpec] = {
    s.source_table: s for s in (CITIES, CUSTOMERS, SALES, RECEIPTS, RETURNS)
}

FINGERPRINT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("entity_id", T.StringType()),
        T.StructField("checksum", T.StringType()),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
        T.StructField("last_changed_at", T.TimestampType()),
    ]
)

CHECKPOINT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("last_sync_key", T.StringType()),
        T.StructField("last_reconcile_key", T.StringType()),
        T.StructField("last_sync_timestamp", T.TimestampType()),
        T.StructField("cycle_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("updated_at", T.TimestampType()),
    ]
)

FAILURE_SCHEMA = T.StructType(
    [
        T.StructField("source_table", T.StringType()),
        T.StructField("primary_key", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("payload", T.StringType()),
        T.StructField("retry_count", T.IntegerType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

RUN_SCHEMA = T.StructType(
    [
        T.StructField("cycle_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("end_time", T.TimestampType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("rows_scanned", T.LongType()),
        T.StructField("rows_updated", T.LongType()),
        T.StructField("rows_failed", T.LongType()),
        T.StructField("status", T.StringType()),
    ]
)

TASK_SCHEMA = T.StructType(
    [
        T.StructField("cycle_id", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("mode", T.StringType()),
        T.StructField("scanned", T.LongType()),
        T.StructField("inserted", T.LongType()),
        T.StructField("updated", T.LongType()),
        T.StructField("unchanged", T.LongType()),
        T.StructField("superseded", T.LongType()),
        T.StructField("errors", T.LongType()),
        T.StructField("duration", T.DoubleType()),
        T.StructField("error", T.StringType()),
    ]
)

# What a cycle stores of each task.
RESULT_SCHEMA = T.StructType(
    [*TASK_SCHEMA, T.StructField("pruned", T.LongType()), T.StructField("lag_minutes", T.DoubleType())]
)
