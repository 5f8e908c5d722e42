"""Changes told apart inside a stream: state per key, and rows delivered again taken out."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.operators.curate import with_checksum
from tidemark.operators.merge import INSERT, UNCHANGED, UPDATE
from tidemark.specs import TableSpec
from tidemark.streaming.observed import observed

CLASSES = "change_type string, checksum string, first_seen_at timestamp, last_seen_at timestamp, last_changed_at timestamp"
STATE = "slot"
SLOTS = 1024  # groups of keys that share one entry of state
# Keyed state lives in RocksDB. State that ends by the clock would ask for batches without data for ever.
KEYED = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started within can keep state per key and stop when nothing is left to read."""
    before = {name: spark.conf.get(name) for name in KEYED}
    try:
        for name, value in KEYED.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class Fingerprints(StatefulProcessor):
    """Of the keys of a slot their checksums and when they were first seen and last changed.

    One call of Python classes all rows of a slot in a batch and reads and writes what is known of it as one value: a key
    alone would cost a call and two messages. A key is forgotten ``ttl_ms`` after its last row, a slot after the last row
    of all its keys.
    """

    def __init__(self, key: str, now: datetime, ttl_ms: int | None):
        self.key, self.now, self.ttl_ms = key, now, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        # A pickled dictionary: key to checksum, first seen, last changed (microseconds) and the time it is forgotten.
        self.known = handle.getValueState(STATE, "keys binary", self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        last: dict[str, tuple[str, str]] = {}
        for some in rows:
            for k, *row in zip(some[self.key], some["row_order"], some["checksum"], strict=True):
                if k not in last or last[k] < tuple(row):
                    last[k] = tuple(row)
        held = self.known.get()
        known = pickle.loads(held[0]) if held is not None else {}
        until = None
        if self.ttl_ms:
            clock = timerValues.getCurrentProcessingTimeInMs()
            until = clock + self.ttl_ms
            known = {k: v for k, v in known.items() if v[3] > clock}
        now = int(np.datetime64(self.now, "us").astype("int64"))
        kinds = []
        for k, (_, checksum) in last.items():
            digest, old = bytes.fromhex(checksum), known.get(k)
            if old is None:
                kind, first, changed = INSERT, now, now
            else:
                kind = UNCHANGED if old[0] == digest else UPDATE
                first, changed = old[1], old[2] if kind == UNCHANGED else now
            known[k] = digest, first, changed, until
            kinds.append(kind)
        self.known.update((pickle.dumps(known, pickle.HIGHEST_PROTOCOL),))
        times = np.array([known[k][1:3] for k in last], "datetime64[us]")
        yield pd.DataFrame({
            self.key: list(last), "change_type": kinds, "checksum": [checksum for _, checksum in last.values()],
            "first_seen_at": times[:, 0], "last_seen_at": np.datetime64(self.now, "us"), "last_changed_at": times[:, 1],
        })

    def close(self) -> None:
        pass


def identified(rows: DataFrame, spec: TableSpec) -> DataFrame:
    """Key, checksum and row_order (text that sorts as rows of a key arrive) of the good rows of a stream, all counted."""
    found = with_checksum(observed(rows, spec).where("_reason IS NULL"), spec)
    # Rows of a key are ordered as in a batch: by ``seq``, of equal ones by checksum.
    order = F.to_json(F.struct("_seq")) if not spec.seq else sortable("_seq", found)
    return found.select(spec.key.target, "checksum", order.alias("row_order"))


def sortable(name: str, rows: DataFrame):
    """A struct of whole numbers, texts and times as one text of the same order; nulls first."""
    parts = []
    for f in rows.schema[name].dataType:
        c, kind = F.col(f"{name}.{f.name}"), f.dataType.typeName()
        if kind in ("byte", "short", "integer", "long"):
            text = F.lpad(F.conv(F.hex(c.cast("long").bitwiseXOR(F.lit(-(1 << 63)))), 16, 16), 16, "0")
        elif kind == "string":
            text = c
        elif kind in ("timestamp", "timestamp_ntz", "date"):
            micros = F.unix_micros(c.cast("timestamp")).bitwiseXOR(F.lit(-(1 << 63)))
            text = F.lpad(F.hex(micros), 16, "0")
        else:
            raise ValueError(f"rows of a stream can't be ordered by {kind} columns")
        parts.append(F.when(c.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), text)))
    return F.concat_ws("\x00", *parts)


def combined(rows: DataFrame, key: str) -> DataFrame:
    """Of each Arrow batch the last row per key, so that a key with much of the stream is small before it moves."""

    def last(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for some in batches:
            yield some.sort_values(["row_order", "checksum"], kind="stable").drop_duplicates(key, keep="last")

    return rows.mapInPandas(last, rows.schema)


def classified(rows: DataFrame, spec: TableSpec, now: datetime, ttl_ms: int | None = None, slots: int = SLOTS) -> DataFrame:
    """A stream of source rows as a stream of classes: one row per key and micro-batch with ``change_type`` insert, update
    or unchanged and the times of its fingerprint.

    The state of a key outlives restarts from the checkpoint. With ``ttl_ms`` a key that brings no row for so long is
    forgotten, and comes back as an insert: state is bounded by the keys of that time. Start the query within
    ``keyed_state``. ``now`` is the clock of the run (UTC, without zone).

    Keys are dealt over ``slots`` by their hash. A batch calls Python once per slot that it touches, and writes what is
    known of that slot again, so take more slots where there are very many keys and batches are small. A checkpoint
    keeps its number of slots.
    """
    key = spec.key.target
    few = combined(identified(rows, spec), key).withColumn("_slot", F.pmod(F.xxhash64(key), F.lit(slots)))
    return few.groupBy("_slot").transformWithStateInPandas(
        Fingerprints(key, now, ttl_ms), f"{key} string, {CLASSES}", "Update", "ProcessingTime" if ttl_ms else "None"
    )


def without_redelivery(rows: DataFrame, spec: TableSpec, arrived: str, delay: str) -> DataFrame:
    """A stream without the rows that it has brought before, in every column of the spec alike, within ``delay``.

    ``arrived`` is a timestamp column that says when a row came, such as the time of its file, not when it happened: rows
    that happened long ago are then never late. State holds the rows of the last ``delay``; what comes again later
    passes, and meets its equal checksum in the merge. Rows without a key differ by their other columns.
    """
    names = {c.strip().lower(): c for c in rows.columns}
    columns = [names[f.source.lower()] for f in spec.fields if f.source.lower() in names]
    columns += [names[s.lower()] for s in spec.seq if s.lower() in names]
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns]), {"ignoreNullFields": "false"})
    once = rows.withColumn("_row", F.sha2(row, 256)).withWatermark(arrived, delay).dropDuplicatesWithinWatermark(["_row"])
    return once.drop("_row", arrived)


def run_batches(rows: DataFrame, checkpoint: str, each: Callable[[DataFrame, int], None], mode: str = "append") -> StreamingQuery:
    """Everything that has arrived, batch by batch; returns the finished query with its progress."""
    query = (
        rows.writeStream.foreachBatch(each).outputMode(mode).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query
