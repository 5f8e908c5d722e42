"""Counters, durations and lag of a stream, observed on the way and kept per micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StreamingQueryListener

from tidemark.operators import quality
from tidemark.operators.curate import clean_table
from tidemark.sources.store import TableStore
from tidemark.specs import TableSpec

BATCHES = "sync_batches"
BATCH_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("batch_id", T.LongType()), T.StructField("table_name", T.StringType()),
    T.StructField("mode", T.StringType()), T.StructField("scanned", T.LongType()), T.StructField("errors", T.LongType()),
    T.StructField("newest", T.TimestampType()), T.StructField("duration", T.DoubleType()), T.StructField("lag_minutes", T.DoubleType()),
])
MODE = "stream"


def observed(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Cleaned rows of a stream with ``_reason``, counted on the way under the name of their table: no second pass."""
    cleaned = clean_table(rows, spec).withColumn("_reason", quality.reject_reason(spec))
    return cleaned.observe(
        spec.source_table, F.count(F.lit(1)).alias("scanned"), F.count("_reason").alias("errors"), F.max("created_at").alias("newest"),
    )


class BatchLog(StreamingQueryListener):
    """Keeps what ``observed`` streams report: one entry per micro-batch that had rows.

    Entries wait on the driver, a few numbers each, until ``flush`` appends them to the table ``sync_batches``. The lag of
    a batch is how far its newest row is behind the newest one that any batch of the table has brought so far.
    """

    def __init__(self) -> None:
        self.entries: list[tuple] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        for table, row in p.observedMetrics.items():
            if row["scanned"]:
                seconds = p.durationMs.get("triggerExecution", 0) / 1000
                self.entries.append((str(p.runId), p.batchId, table, MODE, row["scanned"], row["errors"], row["newest"], seconds))

    def onQueryTerminated(self, event) -> None:
        pass

    def flush(self, store: TableStore) -> int:
        """Entries appended. Waits for the events of finished batches first."""
        spark = store.spark
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        entries, self.entries = self.entries, []
        if entries:
            top = {r.table_name: r.top for r in batches(store).groupBy("table_name").agg(F.max("newest").alias("top")).collect()}
            rows = []
            for e in entries:
                table, newest = e[2], e[6]
                behind = None if newest is None else max(0.0, ((top.get(table) or newest) - newest).total_seconds() / 60)
                if newest is not None:
                    top[table] = max(newest, top.get(table) or newest)
                rows.append((*e, behind))
            store.append(BATCHES, spark.createDataFrame(rows, BATCH_SCHEMA).coalesce(1))
        return len(entries)


def batches(store: TableStore) -> DataFrame:
    """Entries of all micro-batches; ``metrics.duration_histogram`` and ``metrics.lag_alerts`` read them as they are."""
    return store.read(BATCHES, BATCH_SCHEMA)
