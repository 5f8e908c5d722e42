"""Near-duplicate vectors by sorted projection passes.

In each pass the vectors of a label are ordered by the signs of their projections on random lines, one after the other
as the bits of one number, and every vector is compared with those of a window that follow it. Vectors are centred by
the mean of their label first, so that a label that crowds about a topic is cut like any other. How many passes a label
takes follows from its rows, its spread and the recall wanted; a label that fits a window needs one. Pairs whose cosine
reaches the threshold are joined; components over all passes are the groups. Links within a group are then counted
exactly: members within reach of the group's centre are linked by the triangle inequality, and only the others are
compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import column, connected, stage
from tidemark.session import new_dir

LEVELS = 32  # rings of equal width about a centre, up to twice the angle of the threshold; the last holds all beyond
SLACK = 1e-6  # radians left for rounding where a bound decides
BITS = 62  # lines of a pass; the order of a label of any size is settled by fewer
CHUNK = 512  # rows compared at once with the window behind them


@dataclass(frozen=True)
class Settings:
    cosine: float = 0.93
    recall: float = 0.9999  # share of links at the very threshold to be found; closer ones are missed less
    window: int = 1024  # rows behind a row, in the order of a pass, that it is compared with
    part: int = 16  # windows that one task compares
    block: int = 256  # vectors compared at once when links are counted
    seed: int = 20240602

    def passes(self, rows: int, spread: float) -> int:
        """Passes that reach the recall in a label of so many rows, whose vectors have this mean squared distance to
        their mean.

        Two rows stand in one window if they agree on as many first bits as it takes to cut the label into windows.
        Bits agree by the angle that two vectors of a link have as seen from the mean: a right one at the most.
        """
        bits = max(0, math.ceil(math.log2(max(1, rows) / self.window)))
        if not bits:
            return 1
        cosine = 1 - (1 - self.cosine) / spread if spread > 0 else 0.0
        agree = 1 - math.acos(min(1.0, max(0.0, cosine))) / math.pi
        return max(1, math.ceil(math.log(1 - self.recall) / math.log1p(-(agree**bits))))


def vectors(table: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, x, raw: unit vectors in double precision, and as they were, of the rows that can link; no others."""
    raw = column(table, vector_col).cast("array<double>")
    rows = table.select(
        column(table, id_col).alias("vec_id"), column(table, label_col).alias("label"), raw.alias("x"), column(table, vector_col).alias("raw")
    )
    largest = F.aggregate("x", F.lit(0.0), lambda s, v: F.greatest(s, F.abs(v)))
    broken = F.exists("x", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    # Scaling by the largest component first keeps squares of huge and of tiny values within range.
    scaled = rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL").where(F.size("x") > 0).where(~broken)
    scaled = scaled.withColumn("largest", largest).where("largest > 0").withColumn("x", F.transform("x", lambda v: v / F.col("largest")))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v))
    return scaled.withColumn("norm", norm).select("vec_id", "label", F.transform("x", lambda v: v / F.col("norm")).alias("x"), "raw")


def matrix(values: pa.ListArray) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def units(values: pa.ListArray) -> np.ndarray:
    """Rows as unit vectors in double precision."""
    x = matrix(values).astype(float)
    x /= np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def labels(rows: DataFrame, settings: Settings) -> DataFrame:
    """label, width, mean, passes: one row per label and width."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column("width").to_numpy()
            for w in np.unique(width).tolist():
                some = batch.filter(pa.array(width == w))
                codes = some.column("label").dictionary_encode()
                of, x = codes.indices.to_numpy(), units(some.column("raw"))
                n, sums = np.bincount(of), np.zeros((len(codes.dictionary), w))
                np.add.at(sums, of, x)
                at = np.repeat(np.arange(len(n)), w)
                yield pa.RecordBatch.from_arrays(
                    [codes.dictionary.take(pa.array(at)), pa.array(np.full(len(at), w), pa.int32()), pa.array(np.tile(np.arange(w), len(n)), pa.int32()),
                     pa.array(n[at].astype(np.int64)), pa.array(sums.ravel())],
                    ["label", "width", "d", "n", "s"],
                )

    names = [rows.schema["label"], T.StructField("width", T.IntegerType()), T.StructField("d", T.IntegerType()),
             T.StructField("n", T.LongType()), T.StructField("s", T.DoubleType())]
    sums = rows.select("label", "width", "raw").mapInArrow(add, T.StructType(names))
    means = sums.groupBy("label", "width", "d").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    each = means.groupBy("label", "width").agg(
        F.max("n").alias("n"), F.array_sort(F.collect_list(F.struct("d", (F.col("s") / F.col("n")).alias("m")))).alias("c")
    )
    each = each.select("label", "width", "n", F.transform("c", lambda c: c["m"]).alias("mean"))

    def plan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spread = [1 - float(np.square(m.values.to_numpy()).sum()) for m in batch.column("mean")]
            n = batch.column("n").to_pylist()
            yield batch.drop_columns(["n"]).append_column("passes", pa.array(map(settings.passes, n, spread), pa.int32()))

    schema = T.StructType([*[each.schema[c] for c in ("label", "width", "mean")], T.StructField("passes", T.IntegerType())])
    return stage(each.mapInArrow(plan, schema), "labels")


def with_keys(rows: DataFrame, settings: Settings) -> DataFrame:
    """vec_id, label, width, raw, keys: the place of the vector in each pass that its label takes."""
    names = ["vec_id", "label", "width", "raw"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            how = np.stack([batch.column(c).to_numpy() for c in ("width", "passes")], axis=1)
            for width, passes in np.unique(how, axis=0).tolist():
                some = batch.filter(pa.array((how == [width, passes]).all(axis=1)))
                x = units(some.column("raw")) - matrix(some.column("mean"))
                keys = np.empty((len(x), passes), np.int64)
                for t in range(passes):
                    lines = np.random.default_rng([settings.seed, width, t]).standard_normal((width, BITS))
                    keys[:, t] = (x @ lines > 0) @ (1 << np.arange(BITS - 1, -1, -1, dtype=np.int64))
                ends = (np.arange(len(x) + 1) * passes).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[some.column(c) for c in names], pa.ListArray.from_arrays(ends, pa.array(keys.ravel()))], [*names, "keys"]
                )

    schema = T.StructType([*[rows.schema[c] for c in names], T.StructField("keys", T.ArrayType(T.LongType()))])
    known = rows.join(labels(rows, settings), ["label", "width"]).select(*names, "mean", "passes")
    return stage(known.mapInArrow(sign, schema), "keyed")


def forest(ids: pa.Array, pairs: np.ndarray) -> tuple[pa.Array, pa.Array]:
    """Links of places as links of ids, each to the smallest place that it leads to: no more than there are ids."""
    top = smallest(len(ids), pairs)
    moved = np.flatnonzero(top != np.arange(len(ids)))
    return ids.take(pa.array(moved)), ids.take(pa.array(top[moved]))


def window_pairs(rows: DataFrame, settings: Settings) -> DataFrame:
    """(a, b) of linked vectors that share a window in any pass; of the rows compared at once a forest.

    A pass deals ranges of its order to tasks. The last window of a task meets the first one of the next in a second,
    small step, so no neighbours are lost between tasks.
    """
    keyed = with_keys(rows, settings)
    total, turns = keyed.agg(F.count("*"), F.max(F.size("keys"))).first()
    ranges = max(1, -(-total // (settings.window * settings.part)))
    kind, path = rows.schema["vec_id"], new_dir(rows.sparkSession, "pairs")
    order = ["label", "width", "key", "vec_id"]
    edge = [rows.schema["label"], T.StructField("width", T.IntegerType()), kind, rows.schema["raw"]]
    schema = T.StructType([
        T.StructField("a", kind.dataType), T.StructField("b", kind.dataType), T.StructField("border", T.LongType()),
        T.StructField("later", T.BooleanType()), T.StructField("row", T.StructType(edge)),
    ])
    arrow, fields = to_arrow_schema(schema), [f.name for f in edge]
    given = to_arrow_schema(T.StructType([rows.schema["label"], rows.schema["width"], T.StructField("key", T.LongType()), kind, rows.schema["raw"]]))

    def found(a: pa.Array, b: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([a, b, *[pa.nulls(len(a), arrow.field(k).type) for k in range(2, 5)]], schema=arrow)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here = TaskContext.get().partitionId()
        whole = pa.Table.from_batches(list(batches), schema=given).combine_chunks()  # ``part`` windows
        if not len(whole):
            return
        codes = whole.column("label").combine_chunks().dictionary_encode().indices.to_numpy()
        width, ids = whole.column("width").to_numpy(), whole.column("vec_id").combine_chunks()
        starts = np.flatnonzero(np.append(True, (codes[1:] != codes[:-1]) | (width[1:] != width[:-1])))
        for start, end in zip(starts.tolist(), [*starts[1:].tolist(), len(whole)]):
            x = units(whole.column("raw").slice(start, end - start).combine_chunks())
            for k in range(0, len(x), CHUNK):
                near = x[k:k + CHUNK] @ x[k:k + CHUNK + settings.window].T >= settings.cosine
                pairs = np.argwhere(np.triu(near, 1))
                if len(pairs):
                    yield found(*forest(ids.slice(start + k, CHUNK + settings.window), pairs))
        for later, part in ((True, whole.slice(0, settings.window)), (False, whole.slice(max(0, len(whole) - settings.window)))):
            part = part.combine_chunks()
            row = pa.StructArray.from_arrays([part.column(f).combine_chunks() for f in fields], fields=list(arrow.field("row").type))
            n = len(part)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(n, arrow.field(0).type), pa.nulls(n, arrow.field(1).type), pa.array(np.full(n, here + (not later))),
                 pa.array(np.full(n, later)), row], schema=arrow,
            )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in batch.column("rows"):
                later, row = some.values.field("later").to_numpy(zero_copy_only=False), some.values.field("row")
                codes, width = row.field("label").dictionary_encode().indices.to_numpy(), row.field("width").to_numpy()
                for label, w in {*zip(codes[later].tolist(), width[later].tolist())} & {*zip(codes[~later].tolist(), width[~later].tolist())}:
                    of = np.flatnonzero((codes == label) & (width == w))
                    x, side = units(row.field("raw").take(pa.array(of))), later[of]
                    pairs = np.argwhere((x @ x.T >= settings.cosine) & (~side[:, None] & side[None, :]))
                    if len(pairs):
                        yield pa.RecordBatch.from_arrays([*forest(row.field("vec_id").take(pa.array(of)), pairs)], ["a", "b"])

    for t in range(turns or 0):
        turn = keyed.where(F.size("keys") > t).select("label", "width", F.col("keys")[t].alias("key"), "vec_id", "raw")
        sorted_rows = turn.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        sorted_rows.mapInArrow(compare, schema).write.parquet(f"{path}/pass={t}")
    if not turns:
        return rows.sparkSession.createDataFrame([], T.StructType([schema["a"], schema["b"]]))
    out = rows.sparkSession.read.schema(schema).option("basePath", path).parquet(*[f"{path}/pass={t}" for t in range(turns)])
    # At most a window of rows from either side of a border.
    borders = out.where("border IS NOT NULL").groupBy("pass", "border").agg(
        F.collect_list(F.struct("later", "row")).alias("rows")
    )
    over = borders.where(F.exists("rows", lambda r: r["later"])).where(F.exists("rows", lambda r: ~r["later"])).select("rows")
    return out.where("a IS NOT NULL").select("a", "b").unionByName(over.mapInArrow(meet, T.StructType([schema["a"], schema["b"]])))


def smallest(n: int, pairs: np.ndarray) -> np.ndarray:
    """For each of n places the smallest that the pairs lead to."""
    top = np.arange(n)
    while True:
        least = np.minimum(top[pairs[:, 0]], top[pairs[:, 1]])
        new = top.copy()
        np.minimum.at(new, pairs[:, 0], least)
        np.minimum.at(new, pairs[:, 1], least)
        new = new[new]
        if (new == top).all():
            return top
        top = new


def dot(a: str, b: str) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)


def counted_links(members: DataFrame, settings: Settings) -> DataFrame:
    """vec_id, n_links of the rows (vec_id, component, x): other members of the component within the threshold.

    Members lie in rings about the mean of their component. Two rings so close to it that the threshold holds for any
    two of their members need no comparison; rings so far apart that it can't hold need none either. What is left is
    compared in blocks of rings, block against block, and gives counts, not pairs.
    """
    theta = math.acos(settings.cosine)
    ring = theta / (LEVELS // 2)
    sums = members.select("component", F.posexplode("x")).groupBy("component", "pos").agg(F.sum("col").alias("v"))
    centres = stage(sums.groupBy("component").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "v"))), lambda s: s["v"]).alias("c")
    ), "centres")
    placed = members.join(centres, "component")
    size = F.sqrt(F.aggregate("c", F.lit(0.0), lambda s, v: s + v * v))
    away = F.acos(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("x", "c") / size)))
    level = F.when(size > 0, F.least(F.lit(LEVELS - 1), F.floor(away / ring).cast("int"))).otherwise(F.lit(LEVELS - 1))
    placed = stage(placed.select("vec_id", "component", "x", F.coalesce(level, F.lit(LEVELS - 1)).alias("level")), "placed")
    rings = stage(placed.groupBy("component", "level").agg(F.count("*").alias("n")), "rings")
    far = lambda level: F.when(F.col(level) == LEVELS - 1, F.lit(math.pi)).otherwise((F.col(level) + 1) * ring)
    near = lambda level: F.col(level) * ring
    sure = far("level") + far("other") <= theta - SLACK
    never = (near("level") - far("other") > theta + SLACK) | (near("other") - far("level") > theta + SLACK)
    # At most LEVELS rows per component on either side.
    pairs = rings.select("component", "level").join(rings.select("component", F.col("level").alias("other"), "n"), "component")
    by_ring = pairs.where(sure).groupBy("component", "level").agg(F.sum("n").alias("surely"))
    open_rings = stage(pairs.where(~sure & ~never).select("component", "level", "other"), "open-rings")
    # A ring is cut into blocks of about the same size by hash; only rings that are compared are packed.
    used = open_rings.select("component", "level").distinct()
    parts = rings.join(used, ["component", "level"]).select(
        "component", "level", F.ceil(F.col("n") / settings.block).cast("int").alias("parts")
    )
    blocks = placed.join(parts, ["component", "level"]).groupBy(
        "component", "level", F.pmod(F.xxhash64("vec_id"), F.col("parts")).alias("part")
    ).agg(F.collect_list(F.struct("vec_id", "x")).alias("rows"))
    blocks = stage(blocks, "blocks")
    right = blocks.select("component", F.col("level").alias("other"), F.col("rows").alias("others"))
    meeting = blocks.select("component", "level", "rows").join(open_rings, ["component", "level"]).join(right, ["component", "other"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                a, b = (batch.column(c)[k].values for c in ("rows", "others"))
                hits = matrix(a.field("x")) @ matrix(b.field("x")).T >= settings.cosine
                yield pa.RecordBatch.from_arrays(
                    [a.field("vec_id"), pa.array(hits.sum(axis=1), pa.int64())], ["vec_id", "n"]
                )

    kind = members.schema["vec_id"]
    few = meeting.select("rows", "others")
    compared = few.mapInArrow(compare, T.StructType([kind, T.StructField("n", T.LongType())]))
    compared = compared.groupBy("vec_id").agg(F.sum("n").alias("near"))
    out = placed.select("vec_id", "component", "level").join(by_ring, ["component", "level"], "left").join(compared, "vec_id", "left")
    # Each member has met itself once, in its own ring.
    return out.select("vec_id", (F.coalesce("surely", F.lit(0)) + F.coalesce("near", F.lit(0)) - 1).cast("long").alias("n_links"))


def embedding_dedup(
    table: DataFrame, settings: Settings = Settings(), id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link if labels and widths are equal and the cosine reaches the threshold. Rows with a null id, label or
    vector, and vectors that are empty, zero or hold null or non-finite values, link with nothing: n_links 0, their own
    component, kept. Equal vectors link like any others. Ids are taken as unique; rows that repeat an id are one vector
    in components. An empty table gives no rows; further columns are not read.

    Equal vectors of a label are compared as one. A pass moves every vector once and compares it with a window of others,
    whatever its label holds. A group costs its size, but for members too far from its centre.
    """
    rows = stage(vectors(table, id_col, vector_col, label_col).withColumn("width", F.size("x")), "vectors")
    single = rows.groupBy("label", "width", "x").agg(F.min("vec_id").alias("vec_id"), F.max("vec_id").alias("last"), F.max("raw").alias("raw"))
    single = stage(single, "single")
    several = single.where("vec_id <> last").select("label", "width", "x", F.col("vec_id").alias("b"))
    copies = rows.join(several, ["label", "width", "x"]).where("vec_id <> b").select(F.col("vec_id").alias("a"), "b")
    pairs = window_pairs(single.select("vec_id", "label", "width", "raw"), settings)
    edges = stage(pairs.unionByName(copies).distinct(), "edges")
    found = stage(connected(edges), "components")
    members = stage(rows.join(found, F.col("vec_id") == F.col("node")).select("vec_id", "component", "x"), "members")
    links = counted_links(members, settings)
    ids = table.select(column(table, id_col).alias("vec_id"))
    out = ids.join(found.withColumnRenamed("node", "vec_id"), "vec_id", "left").join(links, "vec_id", "left")
    own = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"),
        F.col("vec_id").eqNullSafe(own).alias("kept"),
    )
