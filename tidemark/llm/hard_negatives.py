"""Hard negatives by Hilbert-ordered Parquet blocks with zone maps.

Vectors of one label are ordered along a Hilbert curve and cut into blocks; a block is one Parquet row with its vectors
and, in columns of their own, the least and the largest value of every dimension. From those, interval arithmetic bounds
the inner product of an anchor with all vectors of a block, so that a window of scores needs only the blocks whose
bounds meet it. Anchors go in groups along the same curve: a group and a block meet as one row, never as pairs of
vectors. Each search first reads one promising block per anchor; what that gives narrows the window before the rest is
chosen. Scores are integers, so results are exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.llm.common import column, stage

LEAST, MOST = -(1 << 62), 1 << 62  # below and above any score


@dataclass(frozen=True)
class Settings:
    scale: int = 256
    positives: int = 5
    negatives: int = 3
    low: int = 50  # percent of the positive's score that a negative has at least
    high: int = 95  # and at most
    block: int = 512  # vectors of a block
    group: int = 64  # anchors of a group
    page: int = 256  # zone maps looked through at once
    part: int = 8192  # vectors that one task puts into blocks
    dims: int = 15  # dimensions of the curve: those of the widest spread
    bits: int = 4  # cells of a dimension are 2 to this power; dims * bits must fit 63 bits

    def __post_init__(self) -> None:
        if self.dims * self.bits > 63 or not 0 <= self.low <= self.high < 100:
            raise ValueError("dims * bits must be at most 63 and 0 <= low <= high < 100")


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of cells (n x dims, below 2 ** bits) along the Hilbert curve.

    From the highest bit down, the cube that holds a point is turned and mirrored so that the curve through it starts at
    the origin; the bits of the turned coordinates, undone from Gray code, are the digits of the place.
    """
    x = cells.astype(np.int64).copy()
    dims = x.shape[1]
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for d in range(dims):
            inside = (x[:, d] & bit) != 0
            swapped = np.where(inside, 0, (x[:, 0] ^ x[:, d]) & below)
            x[:, 0] ^= np.where(inside, below, swapped)
            x[:, d] ^= swapped
    for d in range(1, dims):
        x[:, d] ^= x[:, d - 1]
    turn = np.zeros(len(x), np.int64)
    for level in range(bits - 1, 0, -1):
        turn ^= np.where((x[:, -1] >> level) & 1, (1 << level) - 1, 0)
    x ^= turn[:, None]
    place = np.zeros(len(x), np.int64)
    for level in range(bits - 1, -1, -1):
        for d in range(dims):
            place = place << 1 | (x[:, d] >> level) & 1
    return place


def matrix(values: pa.ListArray) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def row_matrix(scalar: pa.ListScalar, n: int) -> np.ndarray:
    return scalar.values.to_numpy(zero_copy_only=False).reshape(n, -1)


def bounds(q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest inner product each row of q can have with a vector in each box lo..hi."""
    up, down = np.maximum(q, 0).astype(float), np.minimum(q, 0).astype(float)
    lo, hi = lo.T.astype(float), hi.T.astype(float)
    return (up @ lo + down @ hi).astype(np.int64), (up @ hi + down @ lo).astype(np.int64)


def quantised(table: DataFrame, settings: Settings, id_col: str, vector_col: str, label_col: str, label: Column | None) -> DataFrame:
    """vec_id, label, width, q: integer components of the rows that take part."""
    x = column(table, vector_col).cast("array<double>")
    rows = table.select(
        column(table, id_col).alias("vec_id"), (column(table, label_col) if label is None else label).cast("long").alias("label"), x.alias("x")
    ).where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
    broken = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # Products of larger components might not be whole numbers in double precision any more.
    large = F.exists("x", lambda v: F.abs(v) * settings.scale >= float(1 << 20))
    whole = F.when(F.assert_true(~large, "components must be below 2^20 / scale").isNull(), F.transform("x", lambda v: F.floor(v * settings.scale).cast("int")))
    return rows.where(~broken).select("vec_id", "label", F.size("x").alias("width"), whole.alias("q"))


def spreads(rows: DataFrame, settings: Settings) -> DataFrame:
    """width, chosen (dimensions of the curve, widest spread first), mean and sd of each: one row per width."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            width = batch.column("width").to_numpy()
            for w in np.unique(width[width > 0]).tolist():
                x = matrix(batch.column("q").filter(pa.array(width == w))).astype(float)
                sums[w] = sums.get(w, 0) + np.stack([np.full(w, len(x)), x.sum(axis=0), (x * x).sum(axis=0)], axis=1)
        for w, s in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(w, w), pa.int32()), pa.array(np.arange(w), pa.int32()), *[pa.array(s[:, k]) for k in range(3)]],
                ["width", "d", "n", "s", "ss"],
            )

    each = rows.select("width", "q").mapInArrow(add, "width int, d int, n double, s double, ss double")
    total = each.groupBy("width", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"))
    mean = F.col("s") / F.col("n")
    sd = F.sqrt(F.greatest(F.lit(0.0), F.col("ss") / F.col("n") - mean * mean))
    # At most one row per dimension and width.
    ranked = total.select("width", "d", mean.alias("mean"), sd.alias("sd")).withColumn(
        "at", F.row_number().over(Window.partitionBy("width").orderBy(F.desc("sd"), "d"))
    ).where(F.col("at") <= settings.dims)
    chosen = F.array_sort(F.collect_list(F.struct("at", "d", "mean", "sd")))
    return stage(ranked.groupBy("width").agg(chosen.alias("c")).select("width", "c.d", "c.mean", "c.sd"), "spreads")


def with_place(rows: DataFrame, settings: Settings) -> DataFrame:
    """``rows`` with ``place``, the place along the curve (0 for vectors without components)."""
    cells = 1 << settings.bits

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width, place = batch.column("width").to_numpy(), np.zeros(len(batch), np.int64)
            for w in np.unique(width[width > 0]).tolist():
                of = np.flatnonzero(width == w)
                some = batch.take(pa.array(of))
                dims = some.column("d")[0].as_py()
                if dims:
                    mean, sd = (np.array(some.column(c)[0].as_py()) for c in ("mean", "sd"))
                    x = matrix(some.column("q"))[:, dims]
                    cell = np.floor(((x - mean) / np.where(sd > 0, sd, 1) / 4 + 0.5) * cells)  # two deviations to each side
                    place[of] = hilbert(np.clip(cell, 0, cells - 1), settings.bits)
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(place)], [*names, "place"])

    names = rows.columns
    out = rows.join(spreads(rows, settings), "width", "left").select(*names, "d", "mean", "sd")
    return stage(out.mapInArrow(put, T.StructType([*rows.schema, T.StructField("place", T.LongType())])), "placed")


def blocks(placed: DataFrame, size: int, part: int, label: str) -> DataFrame:
    """Rows of (block, label, width, n, ids, q, lo, hi), each of one label and width, along the curve; repeats count once.

    Ranges of the whole key are dealt to tasks, ``part`` rows to each, so neither a hot label nor equal vectors gather.
    """
    order = ["width", "label", "place", "vec_id"]
    ranges = max(1, -(-placed.count() // part))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, at = TaskContext.get().partitionId(), 0
        whole = pa.Table.from_batches(list(batches), schema=arrow).combine_chunks()  # about ``part`` rows
        if not len(whole):
            return
        key = np.stack([whole.column(c).to_numpy() for c in ("width", "label")], axis=1)
        starts = np.flatnonzero(np.append(True, (key[1:] != key[:-1]).any(axis=1)))
        for start, end in zip(starts, np.append(starts[1:], len(whole)), strict=True):
            run = whole.slice(start, end - start).combine_chunks()
            ids, q = run.column("vec_id").to_numpy(), matrix(run.column("q").combine_chunks())
            new = np.append(True, (ids[1:] != ids[:-1]) | (q[1:] != q[:-1]).any(axis=1))
            ids, q = ids[new], q[new]
            for k in range(0, len(ids), size):
                some, x = ids[k:k + size], q[k:k + size]
                by_id = np.argsort(some, kind="stable")  # ties go to the smaller id, so ids ascend in a block
                some, x = some[by_id], x[by_id]
                yield pa.RecordBatch.from_pylist([{
                    "block": (task << 32) + at, "label": int(key[start, 1]), "width": int(key[start, 0]), "n": len(some),
                    "ids": some, "q": x.ravel(), "lo": x.min(axis=0), "hi": x.max(axis=0),
                }], out)
                at += 1

    arrow = pa.schema([("vec_id", pa.int64()), ("label", pa.int64()), ("width", pa.int32()), ("q", pa.list_(pa.int32()))])
    out = pa.schema([
        ("block", pa.int64()), ("label", pa.int64()), ("width", pa.int32()), ("n", pa.int32()), ("ids", pa.list_(pa.int64())),
        ("q", pa.list_(pa.int32())), ("lo", pa.list_(pa.int32())), ("hi", pa.list_(pa.int32())),
    ])
    rows = placed.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
    rows = rows.select(F.col("vec_id").cast("long"), "label", "width", "q")
    schema = "block long, label long, width int, n int, ids array<long>, q array<int>, lo array<int>, hi array<int>"
    return stage(rows.mapInArrow(cut, schema), label)


PAIR = "grp long, block long, used array<int>"


def choose(groups: DataFrame, zones: DataFrame, settings: Settings, same_label: bool, first: bool) -> DataFrame:
    """(grp, block, used): blocks that the windows of a group must read, and by which of its anchors.

    ``groups`` have ``least`` and ``most``: per anchor and window the scores still wanted (LEAST > MOST: none). With
    ``first`` each anchor takes one block only, of those that its windows must read the one with the largest bound.
    Zone maps lie in pages; a group meets every page of its width as one row.
    """
    # Every group visits every page: a page is one row with up to ``page`` zone maps on average.
    pages = max(1, -(-zones.count() // settings.page))
    page = zones.groupBy("width", F.pmod(F.xxhash64("block"), F.lit(pages)).alias("page")).agg(
        F.collect_list(F.struct("block", "label", "lo", "hi")).alias("zones")
    )
    visits = groups.select(
        "width", F.col("block").alias("grp"), "label", "n", "q", "least", "most",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))).alias("page"),
    ).join(page, ["width", "page"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for k in range(len(batch)):
                n, width = batch.column("n")[k].as_py(), batch.column("width")[k].as_py()
                q = row_matrix(batch.column("q")[k], n) if width else np.zeros((n, 0), np.int32)
                least, most = (row_matrix(batch.column(c)[k], n) for c in ("least", "most"))
                z = batch.column("zones")[k].values
                label = z.field("label").to_numpy()
                of = np.flatnonzero((label == batch.column("label")[k].as_py()) == same_label)
                if not len(of):
                    continue
                lo, hi = (matrix(z.field(c).take(pa.array(of))) if width else np.zeros((len(of), 0)) for c in ("lo", "hi"))
                down, up = bounds(q, lo, hi)
                need = np.zeros(up.shape, bool)
                for w in range(least.shape[1]):
                    a, b = least[:, w:w + 1], most[:, w:w + 1]
                    need |= (a <= b) & (up >= a) & (down <= b)
                block = z.field("block").to_numpy()[of]
                grp = batch.column("grp")[k].as_py()
                if first:
                    up = np.where(need, up, LEAST)
                    best = up.argmax(axis=1)
                    some = np.flatnonzero(up[np.arange(n), best] > LEAST)
                    out += [{"grp": grp, "block": int(block[best[i]]), "used": [int(i)], "up": int(up[i, best[i]])} for i in some]
                else:
                    out += [{"grp": grp, "block": int(block[j]), "used": np.flatnonzero(need[:, j])} for j in np.flatnonzero(need.any(axis=0))]
            yield pa.RecordBatch.from_pylist(out, found)

    found = pa.schema([("grp", pa.int64()), ("block", pa.int64()), ("used", pa.list_(pa.int32())), *[("up", pa.int64())] * first])
    pairs = visits.mapInArrow(look, PAIR + ", up long" * first)
    if first:
        best = pairs.groupBy("grp", F.col("used")[0].alias("i")).agg(F.max_by("block", F.struct("up", "block")).alias("block"))
        pairs = best.groupBy("grp", "block").agg(F.collect_list("i").alias("used"))
    return pairs


def read(groups: DataFrame, stored: DataFrame, pairs: DataFrame, top: int, same_label: bool) -> DataFrame:
    """(grp, i, w, score, id): per anchor i of a group and window w the best ``top`` rows of the chosen blocks.

    Higher scores first, then smaller ids; an anchor isn't its own candidate. A block is read once and met by the groups
    that chose it, each pair being one row, so a block wanted by all groups is as many rows as there are groups.
    """
    ours = groups.select(F.col("block").alias("grp"), F.col("n").alias("m"), F.col("ids").alias("anchors"), F.col("q").alias("p"), "least", "most")
    meet = pairs.join(ours, "grp").join(stored.select("block", "width", "n", "ids", "q"), "block").drop("block")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = []
            for k in range(len(batch)):
                get = lambda c: batch.column(c)[k]  # noqa: E731, B023
                n, m, width, used = get("n").as_py(), get("m").as_py(), get("width").as_py(), get("used").values.to_numpy()
                ids, anchors = get("ids").values.to_numpy(), get("anchors").values.to_numpy()[used]
                least, most = (row_matrix(get(c), m)[used] for c in ("least", "most"))
                if width:
                    score = (row_matrix(get("p"), m)[used].astype(float) @ row_matrix(get("q"), n).T.astype(float)).astype(np.int64)
                else:
                    score = np.zeros((len(used), n), np.int64)
                # One number per candidate that orders by score and then by id, as ids ascend.
                order = score * n + (n - 1 - np.arange(n))
                order[anchors[:, None] == ids[None, :]] = LEAST
                few = min(top, n)
                for w in range(least.shape[1]):
                    inside = np.where((score >= least[:, w:w + 1]) & (score <= most[:, w:w + 1]), order, LEAST)
                    at = np.argpartition(inside, n - few, axis=1)[:, n - few:]
                    row, col = np.nonzero(np.take_along_axis(inside, at, axis=1) > LEAST)
                    at = at[row, col]
                    out.append([np.full(len(at), get("grp").as_py()), used[row], np.full(len(at), w), score[row, at], ids[at]])
            if out:
                grp, i, w, s, c = (np.concatenate(x) for x in zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(grp, pa.int64()), pa.array(i, pa.int32()), pa.array(w, pa.int32()), pa.array(s, pa.int64()), pa.array(c, pa.int64())],
                    ["grp", "i", "w", "score", "id"],
                )

    found = meet.mapInArrow(compare, "grp long, i int, w int, score long, id long")
    # Tasks keep the best rows of a window before anything moves.
    place = F.row_number().over(Window.partitionBy("grp", "i", "w").orderBy(F.desc("score"), "id"))
    return found.withColumn("rank", place).where(F.col("rank") <= top)


def narrowed(groups: DataFrame, found: DataFrame, top: int) -> DataFrame:
    """``groups`` whose windows start at the score of the last of ``top`` rows found, where there are so many."""
    last = found.where(F.col("rank") == top).groupBy("grp").agg(F.collect_list(F.struct("i", "w", "score")).alias("last"))

    def raise_least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            new = []
            for k in range(len(batch)):
                least = row_matrix(batch.column("least")[k], batch.column("n")[k].as_py()).copy()
                if batch.column("last")[k].is_valid:
                    rows = batch.column("last")[k].values
                    i, w, score = (rows.field(c).to_numpy() for c in ("i", "w", "score"))
                    least[i, w] = np.maximum(least[i, w], score)
                new.append(least.ravel())
            yield batch.drop_columns(["last", "least"]).append_column("least", pa.array(new, pa.list_(pa.int64())))

    names = [c for c in groups.columns if c != "least"]
    both = groups.join(last.withColumnRenamed("grp", "block"), "block", "left").select(*names, "least", "last")
    return both.mapInArrow(raise_least, T.StructType([*[groups.schema[c] for c in names], groups.schema["least"]]))


def search(groups: DataFrame, stored: DataFrame, settings: Settings, top: int, same_label: bool) -> DataFrame:
    """The best ``top`` rows of every window, exactly: one promising block per anchor first, then all blocks still in question."""
    zones = stored.select("block", "label", "width", "lo", "hi")
    seed = stage(read(groups, stored, choose(groups, zones, settings, same_label, True), top, same_label), "seed")
    rest = stage(narrowed(groups, seed, top), "narrowed")
    # The last row found may tie with a smaller id elsewhere, so windows start at its score and all is read again from there.
    return stage(read(rest, stored, choose(rest, zones, settings, same_label, False), top, same_label), "found")


def hard_negatives(
    table: DataFrame, anchor: Column, settings: Settings = Settings(), label: Column | None = None,
    id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` tells by ``vec_id`` which rows are anchors, ``label`` is an expression over ``table`` instead of its label
    column. A component x counts as floor(scale * x); scores are inner products of these integers, higher ones first,
    ties by smaller id. Each anchor has its best ``positives`` other rows of its label, and for each of them the best
    ``negatives`` rows of another label with low * positive <= 100 * score <= high * positive; a pair without any gives
    no row. Rows with a null id, label or vector or a null or non-finite component take no part; vectors of different
    widths don't meet; vectors without components score 0. A row that repeats id, label and vector counts once; rows that
    share an id and differ stand for themselves, and none is its own namesake's positive. An empty table gives no rows;
    further columns are not read. Ids must be whole numbers; scaled components must stay below 2^20 or the job fails.

    All vectors move once, to be ordered. After that a group of anchors moves to the zone maps (one row per page of them)
    and to the blocks it must read; vectors in blocks are read where they are needed and never paired one by one. Where
    vectors have no clusters, bounds tell little and most blocks are read by most groups.
    """
    rows = quantised(table, settings, id_col, vector_col, label_col, label)
    placed = with_place(rows, settings)
    stored = blocks(placed, settings.block, settings.part, "candidates")
    groups = blocks(placed.where(anchor), settings.group, settings.part, "anchors").drop("lo", "hi")
    once = lambda v, k=1: F.array_repeat(F.lit(v).cast("long"), F.col("n") * k)
    groups = groups.select("*", once(LEAST).alias("least"), once(MOST).alias("most"))
    positives = search(groups, stored, settings, settings.positives, True)
    # Windows of an anchor: one per positive in the order of ranks; LEAST > MOST where there are fewer.
    places = positives.groupBy("grp").agg(F.collect_list(F.struct("i", "rank", "score", "id")).alias("p"))
    k = settings.positives

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            least, most = [], []
            for row in range(len(batch)):
                n = batch.column("n")[row].as_py()
                a, b = np.full((n, k), MOST), np.full((n, k), LEAST)
                p = batch.column("p")[row].values
                i, rank, score = (p.field(c).to_numpy() for c in ("i", "rank", "score"))
                # Whole scores s with low * score <= 100 * s <= high * score.
                a[i, rank - 1] = -(-settings.low * score // 100)
                b[i, rank - 1] = settings.high * score // 100
                least.append(a.ravel())
                most.append(b.ravel())
            kind = pa.list_(pa.int64())
            yield batch.drop_columns(["p"]).append_column("least", pa.array(least, kind)).append_column("most", pa.array(most, kind))

    asked = groups.drop("least", "most").join(places.withColumnRenamed("grp", "block"), "block")
    schema = T.StructType([*groups.drop("least", "most").schema, groups.schema["least"], groups.schema["most"]])
    asked = stage(asked.mapInArrow(windows, schema), "windows")
    negatives = search(asked, stored, settings, settings.negatives, False)
    owner = groups.select(F.col("block").alias("grp"), F.posexplode("ids").alias("i", "anchor_id"))
    pairs = positives.select("grp", "i", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = negatives.join(pairs, ["grp", "i", "w"]).join(owner, ["grp", "i"])
    kind = table.schema[id_col].dataType
    return out.select(
        F.col("anchor_id").cast(kind), F.col("positive_id").cast(kind), F.col("rank").cast("int"),
        F.col("id").cast(kind).alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
    )
