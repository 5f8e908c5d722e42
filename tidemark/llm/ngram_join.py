"""Jaccard self-join on word n-grams by MinHash banding, each candidate pair verified on its full n-gram sets.

Texts with equal sets form one copy class. Classes that agree in a band are candidates. So that a large group of near
copies costs no pair of rows each, every class goes to the largest bucket it lies in, its home; what meets are the
homes, and the classes of two homes are compared in blocks of full sets. Blocks give counts of links and a spanning
forest, not pairs.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import connected, documents, stage

CACHE_WORDS = 500_000
CHUNK = 1 << 13  # n-grams hashed at once


@dataclass(frozen=True)
class Settings:
    words: int = 5  # words of an n-gram
    similarity: float = 0.8
    rows: int = 6  # hashes that must agree within a band
    recall: float = 0.9999  # share of pairs at exactly ``similarity`` that become candidates
    block: int = 64  # classes compared at once with as many others
    seed: int = 20240601

    @property
    def bands(self) -> int:
        """So many bands that a pair at the threshold agrees in one of them with the target recall."""
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.similarity**self.rows))


class Shingler:
    """n-gram sets of texts as sorted arrays of 64-bit hashes.

    Words are what ASCII white space separates, A-Z in lower case. A text of fewer words than n is one n-gram; a text
    without words has none.
    """

    def __init__(self, settings: Settings) -> None:
        import xxhash

        self.n = settings.words
        self.hash = xxhash.xxh3_64_intdigest
        self.known: dict[bytes, int] = {}
        odd = np.random.default_rng(settings.seed).integers(1 << 62, size=self.n + 1, dtype=np.uint64)
        self.weights = odd * np.uint64(2) + np.uint64(1)

    def sets(self, texts: list[str]) -> list[np.ndarray]:
        known = self.known
        if len(known) > CACHE_WORDS:
            known.clear()
        out = []
        for text in texts:
            words = text.encode().lower().split()
            for w in set(words).difference(known):
                known[w] = self.hash(w)
            codes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
            n = min(self.n, len(codes))
            if not n:
                out.append(codes)
                continue
            grams = np.full(len(codes) - n + 1, np.uint64(n))
            for k in range(n):
                grams = grams * self.weights[-1] + codes[k:len(codes) - n + 1 + k] * self.weights[k]
            grams ^= grams >> np.uint64(29)
            grams *= self.weights[0]
            grams ^= grams >> np.uint64(32)
            out.append(np.unique(grams))
        return out


class Bander:
    """Band hashes of an n-gram set."""

    def __init__(self, settings: Settings) -> None:
        draw = np.random.default_rng(settings.seed + 1)
        size = settings.bands * settings.rows
        self.shape = (settings.bands, settings.rows)
        self.scale = (draw.integers(1 << 62, size=(size, 1), dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.shift = draw.integers(1 << 63, size=(size, 1), dtype=np.uint64)
        self.mix = (draw.integers(1 << 62, size=settings.rows, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)
        self.salt = draw.integers(1 << 63, size=settings.bands, dtype=np.uint64)

    def bands(self, grams: np.ndarray) -> np.ndarray:
        least = np.full(len(self.scale), np.iinfo(np.uint64).max)
        for k in range(0, len(grams), CHUNK):
            least = np.minimum(least, (grams[k:k + CHUNK] * self.scale + self.shift).min(axis=1))
        rows = least.reshape(self.shape)
        found = self.salt.copy()
        for k in range(self.shape[1]):
            found = (found ^ (rows[:, k] >> np.uint64(7))) * self.mix[k]
            found ^= found >> np.uint64(31)
        return found.astype(np.int64)


def signatures(rows: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, digest of the n-gram set (null without words), number of n-grams and band hashes."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, bander = Shingler(settings), Bander(settings)
        none = np.empty(0, np.int64)
        for batch in batches:
            sets = shingler.sets(batch.column("text").to_pylist())
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
            bands = [bander.bands(s) if len(s) else none for s in sets]
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            listed = pa.ListArray.from_arrays(ends, np.concatenate([none, *bands]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(digests, pa.binary()), pa.array(map(len, sets), pa.int64()), listed],
                ["doc_id", "digest", "grams", "bands"],
            )

    schema = rows.select("doc_id").schema.add("digest", "binary").add("grams", "long").add("bands", T.ArrayType(T.LongType()))
    return rows.mapInArrow(sign, schema)


def common(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of each set of ``left`` with each of ``right``."""
    out = np.zeros((len(left), len(right)), np.int64)
    sides = [(np.concatenate(s), np.repeat(np.arange(len(s)), [len(x) for x in s])) for s in (left, right)]
    shared = np.intersect1d(sides[0][0], sides[1][0])
    places = []
    for grams, owner in sides:
        at = np.minimum(np.searchsorted(shared, grams), max(0, len(shared) - 1))
        hit = shared[at] == grams if len(shared) else np.zeros(len(grams), bool)
        order = np.argsort(at[hit], kind="stable")
        places.append((at[hit][order], owner[hit][order]))
    for k in range(0, len(shared), CHUNK):
        marks = []
        for (at, owner), n in zip(places, out.shape, strict=True):
            low, high = np.searchsorted(at, [k, k + CHUNK])
            mark = np.zeros((n, min(CHUNK, len(shared) - k)), np.float32)
            mark[owner[low:high], at[low:high] - k] = 1
            marks.append(mark)
        out += (marks[0] @ marks[1].T).astype(np.int64)
    return out


def block_links(meeting: DataFrame, settings: Settings) -> DataFrame:
    """Per block pair (rows, others, same): id, other, n: links found of an id (other null), or an edge of a spanning forest (n null)."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(settings)
        for batch in batches:
            for k in range(len(batch)):
                same = batch.column("same")[k].as_py()
                sides = [batch.column(c)[k].values for c in (("rows",) if same else ("rows", "others"))]
                sets = [shingler.sets(x.field("text").to_pylist()) for x in sides]
                copies = [x.field("copies").to_numpy() for x in sides]
                left, right = sets[0], sets[-1]
                both = common(left, right)
                sizes = [np.array([len(x) for x in side]) for side in (left, right)]
                linked = both >= settings.similarity * (sizes[0][:, None] + sizes[1][None, :] - both)
                ids = pa.concat_arrays([x.field("a") for x in sides])
                codes = ids.dictionary_encode().indices.to_numpy()
                linked &= codes[:len(left), None] != codes[-len(right):][None, :]
                near = linked @ copies[-1] if same else np.concatenate([linked @ copies[1], linked.T @ copies[0]])
                counted = np.flatnonzero(near)
                a, b = np.nonzero(linked)
                edges = forest(len(ids), a, b if same else b + len(left))
                who = np.concatenate([counted, edges[:, 0]])
                other = pa.array(np.concatenate([np.zeros(len(counted), np.int64), edges[:, 1]]), mask=np.arange(len(who)) < len(counted))
                n = pa.array(np.concatenate([near[counted], np.zeros(len(edges), np.int64)]), mask=np.arange(len(who)) >= len(counted))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(who)), ids.take(other), n], ["a", "b", "n"])

    kind = meeting.schema["rows"].dataType.elementType["a"].dataType
    return meeting.mapInArrow(compare, T.StructType([T.StructField("a", kind), T.StructField("b", kind), T.StructField("n", T.LongType())]))


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """(place, smallest place it is linked to) for all places that links lead to a smaller one."""
    top = np.arange(n)
    while True:
        least = np.minimum(top[a], top[b])
        new = top.copy()
        np.minimum.at(new, a, least)
        np.minimum.at(new, b, least)
        new = new[new]
        if (new == top).all():
            moved = np.flatnonzero(top != np.arange(n))
            return np.stack([moved, top[moved]], axis=1)
        top = new


def similar_classes(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Membership (doc_id, copy_id), links of each class to rows of other classes (a, near), and a forest of links (a, b).

    Copy classes are named by their smallest id; only one row of each is compared, so copies in any number cost one row
    per task. A bucket of any size counts: the classes of a home are compared with each other, and with those of every
    home that shares a bucket with it, so all pairs that agree in a band are among the pairs compared.
    """
    rows = documents(docs, id_col, text_col).where("doc_id IS NOT NULL")
    signed = stage(signatures(rows, settings), "signatures")
    found = signed.where("digest IS NOT NULL").groupBy("digest").agg(F.min("doc_id").alias("copy_id"), F.count("*").alias("copies"))
    classes = stage(found, "classes")
    members = stage(signed.select("doc_id", "digest").join(classes.hint("merge"), "digest", "left").select(
        "doc_id", F.coalesce("copy_id", "doc_id").alias("copy_id"),
    ), "members")
    chosen = classes.select("digest", "copies", F.col("copy_id").alias("doc_id"))
    banded = stage(signed.join(chosen.hint("merge"), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("a"), "copies", F.floor(F.log("grams") / math.log(1 / settings.similarity)).cast("int").alias("level"),
        F.explode("bands").alias("band"),
    ), "bands")
    full = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    shared = stage(banded.join(full.hint("merge"), "band"), "shared")
    homes = stage(shared.groupBy("a").agg(
        F.max("copies").alias("copies"), F.max("level").alias("level"), F.max(F.struct("n", "band"))["band"].alias("home"),
    ), "homes")
    touched = stage(shared.select("a", "band").join(homes.select("a", "home").hint("merge"), "a").select("band", "home").distinct(), "touched")
    other = touched.select("band", F.col("home").alias("other"))
    beside = touched.join(other, "band").where("home < other").select("home", "other").distinct()
    # Blocks of about the same number of classes; sets whose sizes differ too much cannot be similar.
    sizes = homes.groupBy("home", "level").agg(F.ceil(F.count("*") / settings.block).cast("int").alias("parts"))
    placed = homes.join(sizes.hint("merge"), ["home", "level"]).select(
        F.col("a").alias("doc_id"), "copies", "home", "level", F.pmod(F.xxhash64("a"), F.col("parts")).alias("part")
    )
    packed = rows.join(placed.hint("merge"), "doc_id").groupBy("home", "level", "part").agg(
        F.collect_set(F.struct(F.col("doc_id").alias("a"), "copies", "text")).alias("rows")
    )
    blocks = stage(packed, "blocks")
    left = blocks.select("home", "level", "part", "rows")
    right = blocks.select(F.col("home").alias("other"), F.col("level").alias("level_b"), F.col("part").alias("part_b"), F.col("rows").alias("others"))
    near = F.abs(F.col("level") - F.col("level_b")) <= 1
    within = left.join(right, F.col("home") == F.col("other")).where(near & (F.struct("level", "part") <= F.struct("level_b", "part_b")))
    across = left.join(beside, "home").join(right, "other").where(near)
    same = (F.col("level") == F.col("level_b")) & (F.col("part") == F.col("part_b"))
    meeting = within.select("rows", "others", same.alias("same")).unionByName(across.select("rows", "others", F.lit(False).alias("same")))
    results = stage(block_links(meeting, settings), "links")
    counts = results.where("n IS NOT NULL").groupBy("a").agg(F.sum("n").alias("near"))
    return members, counts, results.where("n IS NULL").select("a", "b")


def ngram_join(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, class_id, copy_id, n_links, kept.

    copy_id is the smallest id with the same n-gram set, class_id the smallest id reachable by links, n_links the number
    of other rows linked directly, copies included; kept holds for doc_id = class_id. Null and empty texts and texts of
    white space have no n-grams and stand alone. Rows without an id stand alone too: class_id and copy_id null, kept.
    Ids are taken as unique: rows that repeat an id count as copies of each other. An empty table gives no rows; further
    columns are not read.
    """
    members, near, edges = similar_classes(docs, settings, id_col, text_col)
    sizes = stage(members.groupBy("copy_id").agg(F.count("*").alias("size")), "sizes")
    found = connected(edges)
    per_class = stage(
        sizes.join(near.withColumnRenamed("a", "copy_id"), "copy_id", "left")
        .join(found.withColumnRenamed("node", "copy_id"), "copy_id", "left")
        .select(
            "copy_id", F.coalesce("component", "copy_id").alias("class_id"),
            (F.col("size") - 1 + F.coalesce("near", F.lit(0))).alias("n_links"),
        ),
        "per-class",
    )
    known = members.join(per_class.hint("merge"), "copy_id").select(
        "doc_id", "class_id", "copy_id", "n_links", (F.col("doc_id") == F.col("class_id")).alias("kept")
    )
    nameless = documents(docs, id_col, text_col).where("doc_id IS NULL").select("doc_id")
    for c in ("class_id", "copy_id"):
        nameless = nameless.withColumn(c, F.col("doc_id"))
    return known.unionByName(nameless.withColumn("n_links", F.lit(0).cast("long")).withColumn("kept", F.lit(True)))
