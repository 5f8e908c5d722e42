"""Target and state tables as Parquet in shared storage.

A table with a key is a table of Spark's bucketed by that key and sorted by it, one file per bucket. A merge therefore
moves and sorts only its batch: the stored side is read bucket by bucket in key order, and the joined rows lie already
where they are written. A write puts a whole new base beside the current one, or, where it changes little, a delta: a
table of the same buckets whose rows stand in place of those of the base. There is one delta at most, and once it would
hold more than an eighth of the base's rows the next write is a base again, so a batch costs writes in proportion to
itself. Either counts from the moment Spark has put its ``_SUCCESS`` file there; what counted before it stays for those
who still read it. Logs have no key and are appended to. One writer per table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

DONE = "_SUCCESS"  # Spark's mark of a finished write
SHARE = 8  # a delta holds at most this part of the base's rows
# Checksums and row ids are hex text, which only a codec with entropy coding makes small.
CODEC = "zstd"


def _number(folder: str) -> int:
    return int(folder.split("-")[1])


def _buckets(folder: str) -> int:
    return int(folder.split("-")[2])


class TableStore:
    """Tables under ``root``. A new keyed table gets ``buckets`` buckets, by default as many as a shuffle has partitions;
    it keeps that number. Buckets should be so many that one of them fits a task."""

    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    # -- layout ------------------------------------------------------------------------

    def _path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def _hadoop(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _children(self, path: str) -> list[str]:
        fs, p = self._hadoop(path)
        return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []

    def _layers(self, table: str, kind: str) -> list[str]:
        found = [c for c in self._children(self._path(table)) if c.startswith(f"{kind}-")]
        return sorted(found, key=_number)

    def bases(self, table: str, complete: bool = True) -> list[str]:
        """Folders of the bases of a table, oldest first: base-<number>-<buckets>."""
        found = self._layers(table, "base")
        return [c for c in found if not complete or DONE in self._children(self._path(table, c))]

    def delta(self, table: str) -> str | None:
        """Folder of the delta of the current base: delta-<number>-<buckets>."""
        base = self.bases(table)
        found = [c for c in self._layers(table, "delta") if base and _number(c) > _number(base[-1])]
        return next((c for c in reversed(found) if DONE in self._children(self._path(table, c))), None)

    def exists(self, table: str) -> bool:
        return bool(self.bases(table)) or DONE in self._children(self._path(table, "log"))

    def tables(self, folder: str) -> list[str]:
        return sorted(self._children(self._path(folder)))

    def _name(self, path: str) -> str:
        """What the session calls the table in a folder."""
        return f"tidemark_{hashlib.md5(path.encode()).hexdigest()}"

    # -- reading -----------------------------------------------------------------------

    def read(self, table: str, schema: T.StructType, key: str | None = None) -> DataFrame:
        """The current rows of a table; an empty frame of its schema where there is none."""
        base, delta = self.parts(table, schema, key)
        if delta is None:
            return base
        newer = delta.select(F.col(key).alias("_key"))
        return base.join(newer, F.col(key) == F.col("_key"), "left_anti").unionByName(delta)

    def parts(self, table: str, schema: T.StructType, key: str | None = None) -> tuple[DataFrame, DataFrame | None]:
        """The base, and the delta whose rows stand in place of its own, if there is one."""
        found = self.bases(table)
        if found:
            path, buckets = self._path(table, found[-1]), _buckets(found[-1])
            if not (key and buckets):
                return self.spark.read.schema(schema).parquet(path), None
            delta = self.delta(table)
            newer = None if delta is None else self._bucketed(self._path(table, delta), schema, key, buckets)
            return self._bucketed(path, schema, key, buckets), newer
        if self.exists(table):
            return self.spark.read.schema(schema).parquet(self._path(table, "log")), None
        return self.spark.createDataFrame([], schema), None

    def _bucketed(self, path: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
        """The folder as a bucketed table; the session that did not write it is told its layout."""
        name = self._name(path)
        if not self.spark.catalog.tableExists(name):
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            where = path.replace("\\", "\\\\").replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) "
                f"INTO {buckets} BUCKETS LOCATION '{where}'"
            )
        return self.spark.table(name)

    def beside(self, table: str, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` dealt as the buckets of the table are, for a join with it.

        Spark does so by itself where a shuffle has as many partitions as the table has buckets; where it has more, it
        would rather move the table.
        """
        found = self.bases(table)
        buckets = _buckets(found[-1]) if found else 0
        if buckets in (0, int(self.spark.conf.get("spark.sql.shuffle.partitions"))):
            return rows
        return rows.repartition(buckets, key)

    # -- writing -----------------------------------------------------------------------

    def replace(self, table: str, rows: DataFrame, key: str | None = None, in_place: bool = False) -> None:
        """A new base; ``rows`` may read the one before it.

        ``in_place`` tells that ``rows`` come from the table's own buckets (a filter of it, or a join with it on the left
        or in full), so that each task holds one bucket and nothing is moved.
        """
        whole = self.bases(table)
        buckets = (_buckets(whole[-1]) if whole else 0) or self.buckets
        path = self._path(table, f"base-{self._next(table)}-{buckets if key else 0}")
        kept = [*whole[-1:], self.delta(table)]
        if key is None:
            rows.write.option("compression", CODEC).parquet(path)
        else:
            if not (in_place and whole):
                rows = rows.repartition(buckets, key)
            self._write(rows, path, key, buckets)
        self._tidy(table, [*kept, path.split("/")[-1]])

    def takes(self, table: str, n: int) -> bool:
        """Whether ``n`` more rows may lie in the delta of a table; else its base is to be written anew."""
        whole = self.bases(table)
        if not whole or not _buckets(whole[-1]):
            return False
        delta = self.delta(table)
        held = 0 if delta is None else self._rows(self._path(table, delta))
        return SHARE * (held + n) <= self._rows(self._path(table, whole[-1]))

    def patch(self, table: str, rows: DataFrame, key: str) -> None:
        """A new delta with ``rows``, one per key and dealt as the buckets are, in place of older rows of their keys."""
        whole, old = self.bases(table), self.delta(table)
        buckets = _buckets(whole[-1])
        if old is not None:
            before = self._bucketed(self._path(table, old), rows.schema, key, buckets)
            both = before.alias("o").join(rows.alias("n"), F.col(f"o.{key}") == F.col(f"n.{key}"), "full")
            o, n = (F.struct(*[F.col(f"{side}.{c}").alias(c) for c in rows.columns]) for side in "on")
            rows = both.select(F.when(F.col(f"n.{key}").isNull(), o).otherwise(n).alias("r")).select("r.*")
        path = self._path(table, f"delta-{self._next(table)}-{buckets}")
        self._write(rows, path, key, buckets)
        self._tidy(table, [whole[-1], old, path.split("/")[-1]])

    def _next(self, table: str) -> int:
        """The number of the next base or delta."""
        return max([0, *[_number(c) for kind in ("base", "delta") for c in self._layers(table, kind)]]) + 1

    def _rows(self, path: str) -> int:
        """Rows of a folder, told by the footers of its files."""
        return self.spark.read.parquet(path).count()

    def _write(self, rows: DataFrame, path: str, key: str, buckets: int) -> None:
        to = rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).option("compression", CODEC)
        to.saveAsTable(self._name(path))

    def _tidy(self, table: str, kept: list[str | None]) -> None:
        for name in self._layers(table, "base") + self._layers(table, "delta"):
            if name not in kept:
                self.unstage(self._path(table, name))

    def append(self, table: str, rows: DataFrame) -> None:
        """Add rows to a table without a key."""
        rows.write.mode("append").parquet(self._path(table, "log"))

    # -- staging -----------------------------------------------------------------------

    def stage(self, df: DataFrame, path: str) -> DataFrame:
        """Write ``df`` to shared storage and return it read back.

        The written table cuts the lineage: losing an executor later repeats no cleaning.
        """
        df.write.mode("overwrite").option("compression", CODEC).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def stage_beside(self, table: str, df: DataFrame, path: str, key: str) -> DataFrame:
        """The same with the buckets that the table has or will have: joins with it and writes to it move nothing.
        ``df`` is dealt by its key, in as many parts as a shuffle has, or as the buckets are."""
        found = self.bases(table)
        buckets = (_buckets(found[-1]) if found else 0) or self.buckets
        self._write(self.beside(table, df, key), path, key, buckets)
        return self._bucketed(path, df.schema, key, buckets)

    def unstage(self, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(path)}")
        self.drop(path)

    def drop(self, path: str) -> None:
        fs, p = self._hadoop(path)
        fs.delete(p, True)
