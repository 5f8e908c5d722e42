"""Line dedup by content-defined chunks of lines.

A rolling hash over the hashes of the last lines decides where a chunk ends, so an inserted or removed line moves only
the boundaries beside it. A line long enough to count as a passage is a chunk of its own. Where passages are looked for as well, the
shortest runs of lines with enough words are keyed from every line on and up to every line, so that any passage of that
many words is covered by runs that see nothing around it. Chunks and runs that occur in several documents are compared
byte by byte; the document with the smallest id keeps its copy, the others lose theirs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import column, documents, stage

MASK = (1 << 64) - 1
FACTOR = 0x9E3779B97F4A7C15  # odd multiplier of the rolling hash


@dataclass(frozen=True)
class Settings:
    window: int = 2  # lines the rolling hash sees
    one_in: int = 2  # the share of places between lines that may end a chunk, as one in so many
    least_lines: int = 2  # a chunk ends early only at the end of the text or beside a long line
    long_words: int = 40  # words from which a line is a chunk of its own
    min_words: int = 12  # words from which a chunk of several lines may go
    passage_words: int = 0  # words from which any run of whole lines may go, wherever it begins; 0 for chunks only


PASSAGES = Settings(passage_words=50)


def chunks(text: str, settings: Settings) -> list[tuple[int, int, bool]]:
    """(first line, end line, removable) of the chunks of a text, in order, without gaps."""
    lines = text.split("\n")
    words = [len(x.split()) for x in lines]
    out, begin, recent = [], 0, []

    def close(end: int) -> None:
        nonlocal begin
        if end > begin:
            total = sum(words[begin:end])
            out.append((begin, end, total >= (settings.min_words if end - begin > 1 else settings.long_words)))
            begin = end

    for k, line in enumerate(lines):
        if words[k] >= settings.long_words:
            close(k)
            close(k + 1)
            recent = []
            continue
        recent = [*recent[-settings.window + 1:], xxhash.xxh3_64_intdigest(line)]
        rolled = 0
        for h in recent:
            rolled = (rolled * FACTOR + h) & MASK
        if k + 1 - begin >= settings.least_lines and (rolled >> 20) % settings.one_in == 0:
            close(k + 1)
    close(len(lines))
    return out


def removable(text: str, settings: Settings) -> Iterator[tuple[int, str]]:
    """Position and text of each chunk that may go if it occurs elsewhere; of equal ones within the text the first."""
    lines = text.split("\n")
    seen = set()
    for place, (begin, end, may_go) in enumerate(chunks(text, settings)):
        content = "\n".join(lines[begin:end])
        if may_go and content not in seen:
            seen.add(content)
            yield place, content


def runs(lines: list[str], least: int) -> set[tuple[int, int]]:
    """(first line, end line) of the shortest runs with ``least`` words from each line with words on, and up to each."""
    if least <= 0:
        return set()
    places = [(k, n) for k, n in enumerate(len(x.split()) for x in lines) if n]
    out = set()
    for order in (1, -1):
        walk, end, total = places[::order], 0, 0
        for k, n in walk:
            while end < len(walk) and total < least:
                total += walk[end][1]
                end += 1
            if total < least:
                break
            last = walk[end - 1][0]
            out.add((min(k, last), max(k, last) + 1))
            total -= n
    return out


def pieces(text: str, settings: Settings) -> Iterator[tuple[int, int, str]]:
    """First line, end line and text of all that may go if it occurs elsewhere, in order: chunks, and runs of lines."""
    lines = text.split("\n")
    found = {(begin, end) for begin, end, may_go in chunks(text, settings) if may_go}
    for begin, end in sorted(found | runs(lines, settings.passage_words)):
        yield begin, end, "\n".join(lines[begin:end])


def without(text: str, gone: list[bytes], settings: Settings) -> str:
    """The text without the lines of pieces whose digests are in ``gone`` and of repetitions of its own pieces.

    What overlaps its own first place is no repetition.
    """
    drop, gone, seen = set(), set(gone), {}
    for begin, end, content in pieces(text, settings):
        if begin >= seen.setdefault(content, end) or (gone and digest(content) in gone):
            drop.update(range(begin, end))
    return "\n".join(line for k, line in enumerate(text.split("\n")) if k not in drop) if drop else text


def digest(content: str) -> bytes:
    return hashlib.blake2b(content.encode(), digest_size=16).digest()


def repeated_pieces(rows: DataFrame, settings: Settings) -> DataFrame:
    """digest, doc_id of every piece that the document has to give up.

    Digests meet first. The texts of those that several documents hold are then compared in one aggregation on digest
    and text, so equal digests of different texts stay apart; a piece in a third of all documents leaves one row per
    task before the shuffle.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, digests = [], []
            for k, text in enumerate(batch.column("text").to_pylist()):
                found = {digest(content) for _, _, content in pieces(text, settings)}
                row += [k] * len(found)
                digests += found
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(digests, pa.binary())], ["doc_id", "digest"]
            )

    def contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column("shared").to_pylist()
            for k, text in enumerate(batch.column("text").to_pylist()):
                wanted, found = set(shared[k]), {}
                for _, _, content in pieces(text, settings):
                    d = digest(content)
                    if d in wanted:
                        found[content] = d
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(pa.array([k] * len(found), pa.int64())), pa.array(found.values(), pa.binary()),
                     pa.array(found, pa.string())],
                    ["doc_id", "digest", "content"],
                )

    schema = rows.select("doc_id").schema.add("digest", "binary")
    places = stage(rows.mapInArrow(cut, schema), "places")
    several = places.groupBy("digest").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least <> last")
    shared = places.join(stage(several.select("digest"), "several"), "digest")
    shared = stage(shared.groupBy("doc_id").agg(F.collect_set("digest").alias("shared")), "shared")
    found = rows.join(shared, "doc_id").select("doc_id", "text", "shared").mapInArrow(contents, T.StructType([*schema, T.StructField("content", T.StringType())]))
    same = found.groupBy("digest", "content").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
    # Where two texts share a digest neither is told apart by it, so neither goes.
    keepers = same.groupBy("digest").agg(F.count("*").alias("texts"), F.min("keeper").alias("keeper"), F.max("last").alias("last"))
    keepers = stage(keepers.where("texts = 1 AND keeper <> last").select("digest", "keeper"), "keepers")
    return places.join(keepers, "digest").where("doc_id <> keeper").select("doc_id", "digest")


def line_dedup(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with all their columns, the text column without repeated chunks and, by settings, passages.

    Null stays null and empty stays empty; white space and line ends are compared as they are. Of a piece that several
    documents hold the smallest id keeps it; within a document its first place stays. Rows without an id lose only what
    they repeat themselves; rows that repeat an id are one document. An empty table gives no rows. The column
    order is kept and further columns pass through, whatever their names.
    """
    rows = documents(docs, id_col, text_col)
    gone = repeated_pieces(rows.where("doc_id IS NOT NULL"), settings)
    gone = stage(gone.groupBy("doc_id").agg(F.collect_set("digest").alias("gone")), "gone")
    packed = docs.select(column(docs, id_col).alias("key"), F.struct(*[column(docs, c) for c in docs.columns]).alias("row"))
    matched = packed.join(gone, F.col("key") == F.col("doc_id"), "left").select("row", "gone")
    matched = matched.withColumn("text", F.col("row").getField(text_col).cast("string"))

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("text").to_pylist(), batch.column("gone").to_pylist(), strict=True)
            texts = [None if t is None else without(t, g or [], settings) for t, g in pairs]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], ["row", "text"])

    schema = T.StructType([matched.schema["row"], T.StructField("text", T.StringType())])
    done = matched.mapInArrow(strip, schema)
    return done.select(*[
        F.col("text").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns
    ])
