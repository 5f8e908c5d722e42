"""Sync flows: incremental, reconcile, full, prune, and a whole cycle over all tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass
from datetime import datetime
from time import monotonic

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from tidemark.functions.dates import clock
from tidemark.operators import digests, keyset, merge, metrics, quality, retention, state
from tidemark.operators.curate import clean_table, with_checksum, with_ids
from tidemark.session import new_dir
from tidemark.sources.store import TableStore
from tidemark.specs import (
    CHECKPOINT_SCHEMA,
    FAILURE_SCHEMA,
    FINGERPRINT_SCHEMA,
    RUN_SCHEMA,
    RESULT_SCHEMA,
    TableSpec,
)

CHECKPOINTS, FAILURES, RUNS, RESULTS = "sync_checkpoints", "sync_failures", "sync_runs", "sync_results"

# Fixed value: rows re-read per reconcile run.
CHUNK_LIMIT = 5000


@dataclass
class TaskResult:
    cycle_id: str
    table_name: str
    mode: str
    scanned: int = 0
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    superseded: int = 0
    errors: int = 0
    duration: float = 0.0
    error: str | None = None
    known: int = 0
    pruned: int = 0
    lag_minutes: float | None = None  # of an incremental run: how far the target is behind after it

    @property
    def upserted(self) -> int:
        return self.inserted + self.updated + self.unchanged + self.superseded


@dataclass
class Batch:
    scanned: int
    rejected: int
    good: int
    max_key: str | None
    inserted: int = 0
    updated: int = 0
    unchanged: int = 0
    known: int = 0  # passed over by ``skip_known``

    @property
    def superseded(self) -> int:
        return self.good - self.inserted - self.updated - self.unchanged - self.known


def results_frame(spark: SparkSession, results: list[TaskResult]) -> DataFrame:
    """Task results as rows of the results table."""
    rows = [tuple(asdict(r)[c] for c in RESULT_SCHEMA.fieldNames()) for r in results]
    return spark.createDataFrame(rows, RESULT_SCHEMA).coalesce(1)


class TableSync:
    """Sync of tables into a store. ``run_ts`` is the clock of the run, never the wall."""

    def __init__(
        self,
        store: TableStore,
        source_system: str,
        run_ts: datetime,
        cycle_id: str | None = None,
        skip_known: bool = False,
    ):
        self.store = store
        self.spark = store.spark
        self.source_system = source_system
        self.run_ts = run_ts
        self.cycle_id = cycle_id or str(uuid.uuid4())
        self.skip_known = skip_known

    # -- tables ------------------------------------------------------------------------

    def target(self, spec: TableSpec) -> DataFrame:
        return self.store.read(spec.target_table, spec.raw_schema, spec.key.target)

    def fingerprint_table(self, spec: TableSpec) -> str:
        return f"sync_fingerprints/{spec.target_table}"

    def fingerprints(self, spec: TableSpec) -> DataFrame:
        return self.store.read(self.fingerprint_table(spec), FINGERPRINT_SCHEMA, "entity_id")

    def failure_table(self, spec: TableSpec) -> str:
        """Rejects of each table lie apart, so that tables synchronised side by side don't meet."""
        return f"{FAILURES}/{spec.target_table}"

    def failures(self) -> DataFrame:
        out = self.spark.createDataFrame([], FAILURE_SCHEMA)
        for table in self.store.tables(FAILURES):
            out = out.unionByName(self.store.read(f"{FAILURES}/{table}", FAILURE_SCHEMA))
        return out

    def _set_aside(self, spec: TableSpec, rows: DataFrame) -> None:
        """Append the rejects of a batch that are not in the dead-letter table yet."""
        same = ["source_table", "primary_key", "error", "payload"]
        known = self.store.read(self.failure_table(spec), FAILURE_SCHEMA).select(*[F.col(c).alias(f"_{c}") for c in same])
        found = quality.dead_letters(rows, spec, self.run_ts)
        match = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in same]
        condition = match[0] & match[1] & match[2] & match[3]
        self.store.append(self.failure_table(spec), found.join(known, condition, "left_anti"))

    def checkpoints(self, spec: TableSpec) -> DataFrame:
        return self.store.read(f"{CHECKPOINTS}/{spec.target_table}", CHECKPOINT_SCHEMA)

    def checkpoint(self, spec: TableSpec) -> tuple[str | None, str | None]:
        """(last_sync_key, last_reconcile_key) of a table."""
        row = self.checkpoints(spec).first()
        return (row.last_sync_key, row.last_reconcile_key) if row else (None, None)

    def _advance(
        self,
        spec: TableSpec,
        sync_key: str | None = None,
        reconcile_key: str | None = None,
        reset: bool = False,
    ) -> None:
        values = {
            "table_name": spec.source_table,
            "last_sync_key": sync_key,
            "last_reconcile_key": reconcile_key,
            "cycle_id": self.cycle_id,
            "status": state.SUCCESS,
        }
        new = self.spark.range(1, numPartitions=1).select(
            *[F.lit(v).cast("string").alias(n) for n, v in values.items()],
            F.lit(reset).alias("reset_reconcile"),
        )
        # One row on each side, each in one partition: nothing to shuffle.
        old = self.checkpoints(spec).coalesce(1)
        self.store.replace(
            f"{CHECKPOINTS}/{spec.target_table}", state.advance_checkpoints(old, new, self.run_ts)
        )

    # -- one batch ---------------------------------------------------------------------

    def apply(self, spec: TableSpec, rows: DataFrame, within: digests.Open | None = None) -> Batch:
        """Clean, validate, identify and merge a batch of source rows, or those in open ranges of digests.

        1. one narrow pass writes the cleaned rows with checksums to shared storage and counts them;
        2. rejects, if that pass saw any, go to the dead-letter table;
        3. the last row of each key is dealt once, as the buckets of the target are; nothing moves after that. Where there is
           no target yet, they are its first base, and the fingerprints are read from it;
        4. these rows are compared with key and checksum of the target, and what is new or changed becomes the target's
           next delta, or is joined with it into its next base;
        5. then the fingerprints of all seen keys are written, so that a fingerprint never
           stands for a row that the target has not got.

        Row ids and constants follow from the key and are added where the target is written.
        """
        key = spec.key.target
        scan, identified, one = Observation(), Observation(), Observation()
        good_key = F.when(F.col("_reason").isNull(), F.col(key))
        if within:
            cleaned = within.rows(digests.good_rows(rows, spec), spec)
        else:
            cleaned = clean_table(rows, spec).withColumn("_reason", quality.reject_reason(spec))
        cleaned = cleaned.observe(
            scan,
            F.count(F.lit(1)).alias("scanned"),
            F.count("_reason").alias("rejected"),
            F.max(keyset.key_value(spec)).alias("max_key"),
            F.min(good_key).alias("low"),
            F.max(good_key).alias("high"),
        )
        good = cleaned.where("_reason IS NULL").drop("_reason", "_raw_key")
        mapped = with_checksum(good, spec, exact=False).withColumn("checksum", F.unhex("checksum"))
        mapped = mapped.observe(identified, F.count_if(F.col("checksum").isNull()).alias("odd"))
        path = new_dir(self.spark, f"stage-{spec.target_table}")
        try:
            staged = self.store.stage(mapped, f"{path}/plain")
            seen = scan.get
            max_key = None if seen["max_key"] is None else str(seen["max_key"])
            batch = Batch(seen["scanned"], seen["rejected"], seen["scanned"] - seen["rejected"], max_key)
            if batch.rejected:
                self._set_aside(spec, rows)
            if batch.good:
                if identified.get["odd"]:
                    odd = with_checksum(staged.where("checksum IS NULL").drop("checksum"), spec)
                    exact = self.store.stage(odd.withColumn("checksum", F.unhex("checksum")), f"{path}/exact")
                    staged = staged.where("checksum IS NOT NULL").unionByName(exact)
                keys = F.col(key).between(seen["low"], seen["high"])
                last = merge.dedupe_last(staged, key, ["_seq", "checksum"]).drop("_seq")
                last = last.observe(one, F.count(F.lit(1)).alias("rows"))
                # Fingerprints as they were before this batch.
                known = self.store.parts(self.fingerprint_table(spec), FINGERPRINT_SCHEMA, "entity_id")
                if self.skip_known or self.store.exists(spec.target_table):
                    last = self.store.stage_beside(spec.target_table, last, f"{path}/last", key)
                    last = last.withColumn("checksum", F.lower(F.hex("checksum")))
                    self._merge(spec, last, one.get["rows"], keys, batch, f"{path}/changed")
                else:
                    last = with_ids(last.withColumn("checksum", F.lower(F.hex("checksum"))), spec, self.source_system)
                    self._create(spec, last)
                    batch.inserted = one.get["rows"]
                    last = self.target(spec)
                self._remember(spec, last, one.get["rows"], known)
        finally:
            for name in ("last", "changed"):
                self.store.unstage(f"{path}/{name}")
            self.store.drop(path)
        return batch

    def _merge(self, spec: TableSpec, last: DataFrame, n: int, within: Column, batch: Batch, path: str) -> None:
        """``last`` are the ``n`` rows of the batch that count, one per key, dealt as the buckets are."""
        key, table, merged = spec.key.target, spec.target_table, Observation()
        last = with_ids(last, spec, self.source_system)
        if self.skip_known:
            last = merge.fingerprint_delta(last, self.fingerprints(spec), spec.source_table, key)
        if not self.store.exists(table):
            self._create(spec, last.observe(merged, F.count(F.lit(1)).alias("rows")))
            batch.inserted = merged.get["rows"]
            batch.known = n - batch.inserted
            return
        base, newer = self.store.parts(table, spec.raw_schema, key)
        newer = base.limit(0) if newer is None else newer.where(within)
        kinds = merge.classify(last, base.where(within), key, newer).observe(
            merged,
            *[
                F.count_if(F.col("change_type") == k).alias(k)
                for k in (merge.INSERT, merge.UPDATE, merge.UNCHANGED)
            ],
        )
        changed = kinds.where(F.col("change_type") != merge.UNCHANGED).drop("change_type")
        changed = changed.withColumn("raw_id", F.coalesce("old_raw_id", "raw_id")).drop("old_raw_id")
        changed = merge.stamp(changed, spec, self.run_ts).select(spec.raw_schema.fieldNames())
        changed = self.store.stage_beside(table, changed, path, key)
        counts = merged.get
        batch.inserted = counts[merge.INSERT]
        batch.updated = counts[merge.UPDATE]
        batch.unchanged = counts[merge.UNCHANGED]
        batch.known = n - batch.inserted - batch.updated - batch.unchanged
        moved = batch.inserted + batch.updated
        if moved and self.store.takes(table, moved):
            self.store.patch(table, changed, key)
        elif moved:
            rows = merge.upsert_changed(self.target(spec), changed, spec, self.run_ts)
            self.store.replace(table, rows.select(spec.raw_schema.fieldNames()), key, in_place=True)

    def _create(self, spec: TableSpec, last: DataFrame) -> None:
        """The first base of a target."""
        first = last.withColumn("old_created_at", F.lit(None).cast("timestamp"))
        first = merge.stamp(first, spec, self.run_ts).select(spec.raw_schema.fieldNames())
        self.store.replace(spec.target_table, first, spec.key.target)

    def _remember(self, spec: TableSpec, last: DataFrame, n: int, known: tuple[DataFrame, DataFrame | None]) -> None:
        table = self.fingerprint_table(spec)
        latest = last.select(F.col(spec.key.target).alias("entity_id"), "checksum")
        if not self.store.exists(table):
            # Nothing to join with, so the rows stay dealt as they are.
            self.store.replace(table, merge.first_fingerprints(latest, spec.source_table, self.run_ts), "entity_id")
        elif self.store.takes(table, n):
            base, newer = known
            newer = base.limit(0) if newer is None else newer
            rows = merge.upsert_fingerprints(base, latest, spec.source_table, self.run_ts, newer=newer)
            self.store.patch(table, rows, "entity_id")
        else:
            rows = merge.upsert_fingerprints(self.fingerprints(spec), latest, spec.source_table, self.run_ts, apart=True)
            self.store.replace(table, rows, "entity_id", in_place=True)

    # -- flows -------------------------------------------------------------------------

    def _result(self, spec: TableSpec, mode: str, batch: Batch, started: float) -> TaskResult:
        return TaskResult(
            self.cycle_id,
            spec.source_table,
            mode,
            scanned=batch.scanned,
            inserted=batch.inserted,
            updated=batch.updated,
            unchanged=batch.unchanged,
            superseded=batch.superseded,
            known=batch.known,
            errors=batch.rejected,
            duration=round(monotonic() - started, 3),
        )

    def incremental(self, spec: TableSpec, source: DataFrame) -> TaskResult:
        """Rows above the key checkpoint. The checkpoint moves after the data is stored."""
        started = monotonic()
        last, _ = self.checkpoint(spec)
        batch = self.apply(spec, keyset.after(source, spec, last))
        if batch.max_key is not None:
            self._advance(spec, sync_key=batch.max_key)
        result = self._result(spec, "incremental", batch, started)
        if spec.date is not None:
            behind = self.lag(spec, source).first()
            result.lag_minutes = behind.lag_minutes if behind else None
        return result

    def reconcile(
        self, spec: TableSpec, source: DataFrame, chunk_limit: int = CHUNK_LIMIT
    ) -> TaskResult:
        """The next chunk of a rolling re-read; a short chunk starts again at the top."""
        started = monotonic()
        _, last = self.checkpoint(spec)
        rows, end = keyset.chunk(source, spec, last, chunk_limit)
        batch = self.apply(spec, rows)
        self._advance(spec, reconcile_key=end, reset=end is None)
        return self._result(spec, "reconcile", batch, started)

    def repair(self, spec: TableSpec, source: DataFrame) -> TaskResult:
        """A reconcile of the whole table at once: range digests tell where source and target differ, and only rows
        from there are merged. Neither checkpoint moves. Rows gone from the source stay in the target."""
        started = monotonic()
        found = digests.open_ranges(source, self.target(spec), spec)
        batch = Batch(0, 0, 0, None) if found is None else self.apply(spec, found.source(source, spec), found)
        return self._result(spec, "repair", batch, started)

    def full(self, spec: TableSpec, source: DataFrame) -> TaskResult:
        """All rows of a master table. Rows gone from the source stay in the target."""
        started = monotonic()
        batch = self.apply(spec, source)
        self._advance(spec)
        return self._result(spec, "full", batch, started)

    def lag(self, spec: TableSpec, source: DataFrame) -> DataFrame:
        """How far the stored table is behind its source; see ``metrics.lag_alerts``."""
        return metrics.sync_lag(source, self.target(spec), spec)

    def runs(self) -> DataFrame:
        """The run log: of each run its last entry. A run that has an end is no longer open, whatever came first."""
        log = self.store.read(RUNS, RUN_SCHEMA)
        return merge.dedupe_last(log, "cycle_id", ["end_time"])

    def results(self) -> DataFrame:
        """Task results of all cycles."""
        return self.store.read(RESULTS, RESULT_SCHEMA)

    def prune(self, spec: TableSpec, days: int = 0) -> int:
        """Take processed rows past their retention out of the target; returns how many.

        Nothing is written where no row has to go.
        """
        if not self.store.exists(spec.target_table):
            return 0
        target = self.target(spec)
        gone = target.where(retention.is_prunable(spec, self.run_ts, days)).count()
        if gone:
            self.store.replace(
                spec.target_table, retention.prune(target, spec, self.run_ts, days), spec.key.target, in_place=True
            )
        return gone

    def mark_processed(self, spec: TableSpec, keys: DataFrame) -> None:
        """What a downstream consumer does with the rows it has taken."""
        key = spec.key.target
        taken = keys.select(key, F.lit(True).alias("_taken")).distinct()
        rows = self.target(spec).join(taken, key, "left")
        rows = rows.withColumn("is_processed", F.coalesce("_taken", "is_processed"))
        self.store.replace(spec.target_table, rows.select(spec.raw_schema.fieldNames()), key, in_place=True)


def _isolated(
    sync: TableSync, spec: TableSpec, mode: str, run: Callable[[], TaskResult]
) -> TaskResult:
    """A task that fails is reported and does not stop the others."""
    started = monotonic()
    try:
        return run()
    except Exception as e:
        reason = str(e).split("\n")[0]
        return TaskResult(
            sync.cycle_id, spec.source_table, mode,
            errors=1, duration=round(monotonic() - started, 3), error=reason,
        )


def _pruned(sync: TableSync, specs: list[TableSpec], days: int, workers: int) -> list[TaskResult]:
    def one(spec: TableSpec) -> TaskResult:
        started = monotonic()
        gone = sync.prune(spec, days)
        return TaskResult(sync.cycle_id, spec.source_table, "prune", duration=round(monotonic() - started, 3), pruned=gone)

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(lambda spec: _isolated(sync, spec, "prune", lambda: one(spec)), specs))


def prune_all(
    sync: TableSync, specs: list[TableSpec], days: int = 0, workers: int = 2
) -> DataFrame:
    """Prune every table: (table_name, pruned, error), one row per table."""
    done = _pruned(sync, specs, days, workers)
    rows = [(s.target_table, None if r.error else r.pruned, r.error) for s, r in zip(specs, done, strict=True)]
    return sync.spark.createDataFrame(rows, "table_name string, pruned long, error string")


def sync_cycle(
    sync: TableSync,
    sources: Mapping[str, DataFrame],
    specs: list[TableSpec],
    retention_days: int = 0,
    chunk_limit: int = CHUNK_LIMIT,
    workers: int = 2,
) -> DataFrame:
    """One cycle: prune, masters in full, transactions incrementally and by one chunk.

    Tables run side by side, the tasks of one table one after the other. Returns the task
    results, prunes among them; they are stored as well, and the run log holds their totals.
    ``metrics.lag_alerts`` tells which tables are too far behind. Entries are appended to the
    logs: a run that starts, one that ends, and older ones that never did.
    """
    store, spark = sync.store, sync.spark
    open_runs = sync.runs().where(F.col("status") == state.RUNNING)
    stale = state.interrupt_stale_runs(open_runs, sync.run_ts)
    start = spark.range(1, numPartitions=1).select(
        F.lit(sync.cycle_id).alias("cycle_id"), clock(sync.run_ts).alias("start_time")
    )
    store.append(RUNS, state.open_runs(stale, start).coalesce(1))
    started = monotonic()
    try:
        tasks = _run_tasks(sync, sources, specs, retention_days, chunk_limit, workers)
        store.append(RESULTS, tasks)
    except BaseException:
        _close_run(sync, monotonic() - started, None)
        raise
    _close_run(sync, monotonic() - started, tasks)
    return tasks


def _run_tasks(
    sync: TableSync,
    sources: Mapping[str, DataFrame],
    specs: list[TableSpec],
    retention_days: int,
    chunk_limit: int,
    workers: int,
) -> DataFrame:
    """Results of all tasks of a cycle."""
    pruned = _pruned(sync, specs, retention_days, workers)

    def table(spec: TableSpec) -> list[TaskResult]:
        name = spec.source_table
        if spec.mode == "full":
            steps = {"full": lambda: sync.full(spec, sources[name])}
        else:
            steps = {
                "incremental": lambda: sync.incremental(spec, sources[name]),
                "reconcile": lambda: sync.reconcile(spec, sources[name], chunk_limit),
            }
        return [_isolated(sync, spec, mode, run) for mode, run in steps.items()]

    with ThreadPoolExecutor(workers) as pool:
        results = [*pruned, *[r for rs in pool.map(table, specs) for r in rs]]
    return results_frame(sync.spark, results)


def _close_run(sync: TableSync, seconds: float, tasks: DataFrame | None) -> None:
    """End of the run in the log, with the totals of its tasks where it got that far."""
    store, spark = sync.store, sync.spark
    total = spark.createDataFrame([(sync.cycle_id, seconds)], "cycle_id string, duration double")
    if tasks is None:
        none = F.lit(0).cast("long")
        totals = total.select(
            "cycle_id", F.col("duration").alias("duration_sec"), none.alias("rows_scanned"),
            none.alias("rows_updated"), none.alias("rows_failed"), F.lit(state.FAILED).alias("status"),
        )
    else:
        totals = metrics.cycle_rollup(tasks, total)
    end = clock(sync.run_ts) + F.make_dt_interval(secs=F.lit(round(seconds, 3)))
    closing = totals.select(
        "cycle_id",
        end.alias("end_time"),
        F.col("duration_sec").alias("duration"),
        "rows_scanned",
        "rows_updated",
        "rows_failed",
        "status",
    )
    mine = sync.runs().where(F.col("cycle_id") == sync.cycle_id)
    store.append(RUNS, state.close_runs(mine, closing).coalesce(1))
