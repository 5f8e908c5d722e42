"""The incremental sync as a stream of micro-batches over a folder of source files."""

from __future__ import annotations

from time import monotonic

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.operators import keyset
from tidemark.plans.flows import RESULTS, TableSync, TaskResult, results_frame
from tidemark.specs import TableSpec
from tidemark.streaming.keyed import run_batches, without_redelivery

ARRIVED = "_arrived"


def read_stream(
    spark: SparkSession, path: str, schema: T.StructType, format: str = "parquet", glob: str | None = None,
    max_files: int | None = None, arrival: bool = False,
) -> DataFrame:
    """A stream over a file, a folder or a pattern; ``arrival`` adds the time of each row's file as ``_arrived``.

    ``glob`` filters file names, so it has to fit the part files of a table that is a folder.
    """
    reader = spark.readStream.format(format).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    # A stream takes folders and patterns but no single file; a pattern of this one name fits both files and folders.
    path = path.rstrip("/")
    rows = reader.load(path if any(c in path for c in "*?[{") else f"{path[:-1]}[{path[-1]}]")
    return rows.withColumn(ARRIVED, F.col("_metadata.file_modification_time")) if arrival else rows


def stream_sync(
    sync: TableSync, spec: TableSpec, rows: DataFrame, checkpoint: str, skip_old: bool = False, once_within: str | None = None
) -> list[TaskResult]:
    """Merge everything that has arrived and stop; the next call goes on from there.

    A batch delivered twice meets equal checksums and changes nothing. ``skip_old`` drops
    keys at or below the key checkpoint, as the batch flow does: late rows then wait for a
    reconcile. The key checkpoint moves after the data of its batch is stored. With
    ``once_within``, an interval, rows delivered again that soon do not reach the merge at all;
    ``rows`` then need the column ``_arrived`` of ``read_stream``. Counters and duration of every
    batch are stored with the results of the other tasks.
    """
    if once_within:
        rows = without_redelivery(rows, spec, ARRIVED, once_within)
    done: list[TaskResult] = []

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        started = monotonic()
        last, _ = sync.checkpoint(spec)
        picked = keyset.after(batch, spec, last) if skip_old else batch
        result = sync.apply(spec, picked)
        if result.max_key is not None:
            newest = result.max_key
            if last is not None:
                newest = max(newest, last, key=int if spec.key_order == "long" else str)
            sync._advance(spec, sync_key=newest)
        done.append(sync._result(spec, "stream", result, started))
        sync.store.append(RESULTS, results_frame(sync.spark, done[-1:]))

    run_batches(rows, checkpoint, merge_batch)
    return done
