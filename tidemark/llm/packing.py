"""Packing by power-of-two decomposition: documents are cut into pieces of binary lengths, pieces of one length form a bucket.

A document of n ids gives n div ``longest`` pieces of the longest length and one piece for each set bit of the rest, the
longer first. Every piece is a sequence of its own, so no sequence crosses documents and none has padding.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from tidemark.llm.common import documents

END_ID = 1
CACHE_WORDS = 1_000_000  # distinct words, and distinct parts of words, a worker remembers
CACHE_CHARS = 40
# The tokenizer's own pattern, narrowed to printable ASCII and Latin-1 letters.
PART = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^\\sa-z0-9ß-öø-ÿ]+")
PLAIN = re.compile("[!-~À-ÖØ-öø-ÿ]+")


def cut_words(texts: list[str] | pa.Array) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Texts cut at blanks, line breaks and tabs: the place of each word among the distinct ones, those, and at which
    words the texts begin and end. Words never become Python objects but once per batch."""
    held = pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string())
    offset = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1]
    data = np.frombuffer(held.buffers()[2] or b"", np.uint8)[offset[0]:offset[-1]]
    blank = (data == 32) | (data == 10) | (data == 9)
    gone = np.flatnonzero(blank)
    # A word ends at each blank and at the end of each text; what is left lies side by side.
    stops = offset[1:] - offset[0]
    after = np.searchsorted(gone, stops)
    ends = np.append(0, after + np.arange(1, len(held) + 1))
    bounds = np.insert(gone - np.arange(len(gone)), after, stops - after)
    words = pa.LargeStringArray.from_buffers(
        len(bounds), pa.py_buffer(np.append(0, bounds)), pa.py_buffer(data[~blank])
    ).dictionary_encode()
    # One long text, cut by Python, is made faster than one object per value of the column.
    joined = pc.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary.cast(pa.string())), " ")
    return words.indices.to_numpy(), joined[0].as_py().split(" ") if len(words) else [], ends


class WordEncoder:
    """Ids of whole texts, looked up by space-separated words.

    Words that are new are cut into the parts that the tokenizer merges one by one, if they hold plain characters only;
    new parts and all other words go through the tokenizer. Valid for vocabularies that cut as PART does and drop white
    space, as the constructor tries out; any other tokenizer encodes whole texts.
    """

    def __init__(self, tokenizer_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(tokenizer_file, encoding="utf-8") as f:
            form = json.load(f)
        self.tokenizer = Tokenizer.from_str(json.dumps(form))
        self.parts = Tokenizer.from_str(json.dumps(form | {
            "normalizer": None, "added_tokens": [],
            "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        }))
        special = [t["content"] for t in form["added_tokens"]]
        self.held = re.compile("|".join(map(re.escape, special))).search if special else lambda w: None
        self.words: dict[str, bytes] = {}
        self.known: dict[str, bytes] = {}
        probe = "I'll SAY 'tis 12.50% -- don't\nwe've É(ü)à?!\tx's 'RE a_b @#1a"
        self.by_word = self.plain([probe])[0].tolist() == self.tokenizer.encode(probe, add_special_tokens=False).ids

    def plain(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self.words.clear()
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        place, distinct, ends = cut_words(texts)
        found = list(map(self.words.get, distinct))
        fresh = [w for w, got in zip(distinct, found, strict=True) if got is None]
        if fresh:
            self.learn(fresh)
            found = list(map(self.words.__getitem__, distinct))
            for w in fresh:
                if len(w) > CACHE_CHARS:
                    del self.words[w]
        # The ids of all distinct words one after the other, and from them those of all texts.
        flat = np.frombuffer(b"".join(found), "<u4")
        size = np.fromiter(map(len, found), np.int32, len(found)) >> 2
        first = np.cumsum(size, dtype=np.int32) - size
        out = []
        for a, b in zip(ends.tolist(), ends[1:].tolist()):
            some = place[a:b]
            sizes = size[some]
            done = np.cumsum(sizes, dtype=np.int32)
            at = np.repeat(first[some] - done + sizes, sizes)
            at += np.arange(len(at), dtype=np.int32)
            out.append(flat[at])
        return out

    def learn(self, fresh: list[str]) -> None:
        """Ids of new words, for a while those of long ones as well."""
        known, words = self.known, self.words
        whole = [w for w in fresh if not PLAIN.fullmatch(w) or self.held(w)]
        other = fresh if not whole else list(set(fresh).difference(whole))
        split = list(map(PART.findall, map(str.lower, other)))
        missing = list(set(chain.from_iterable(split)).difference(known))
        known.update(self.ids(self.parts, missing))
        words.update(zip(other, [b"".join(map(known.__getitem__, some)) for some in split], strict=True))
        words.update(self.ids(self.tokenizer, whole))
        for p in missing:
            if len(p) > CACHE_CHARS:
                del known[p]

    @staticmethod
    def ids(tokenizer, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Each text with its ids as little-endian unsigned 32-bit integers."""
        for k in range(0, len(texts), 10_000):
            some = texts[k:k + 10_000]
            found = tokenizer.encode_batch_fast(some, add_special_tokens=False)
            yield from zip(some, (struct.pack(f"<{len(e.ids)}I", *e.ids) for e in found), strict=True)

    def encode(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        if self.by_word:
            return self.plain(texts)
        texts = texts.to_pylist() if isinstance(texts, pa.Array) else texts
        return [np.array(e.ids, "<u4") for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(tokenizer_file: str) -> WordEncoder:
    if tokenizer_file not in _ENCODERS:
        _ENCODERS[tokenizer_file] = WordEncoder(tokenizer_file)
    return _ENCODERS[tokenizer_file]


def binary_lengths(n: int, longest: int) -> list[int]:
    """n as pieces of ``longest`` (a power of two) and then falling powers of two."""
    whole, rest = divmod(n, longest)
    return [longest] * whole + [1 << k for k in range(longest.bit_length() - 1, -1, -1) if rest >> k & 1]


def pack(
    docs: DataFrame, tokenizer_file: str, longest: int = 2048, end_id: int = END_ID,
    id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, [ids], bucket, sequence_id, offset.

    ``bucket`` is the power of two of the length and offset is 0, as a piece fills its sequence. Null and empty texts
    give one piece with the end id; null ids stay null; repeated rows are packed each; an empty table gives no rows;
    further columns are not read. One narrow stage without a shuffle. sequence_id is unique, not gapless.
    """
    rows = documents(docs, id_col, text_col)
    if longest < 1 or longest & (longest - 1):
        raise ValueError("longest must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_file).encode
        for batch in batches:
            row, start, length, crc, total, ids = [], [], [], [], [], []
            for k, found in enumerate(encode(batch.column("text"))):
                full = np.append(found, np.uint32(end_id))
                at = 0
                for n in binary_lengths(len(full), longest):
                    piece = full[at:at + n]
                    row.append(k)
                    start.append(at)
                    length.append(n)
                    crc.append(zlib.crc32(piece.tobytes()))
                    total.append(len(full))
                    if with_ids:
                        ids.append(piece.astype(np.int32))
                    at += n
            columns = [batch.column("doc_id").take(pa.array(row, pa.int64()))]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc, total)]
            if with_ids:
                ends = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(ends, np.concatenate(ids) if ids else pa.array([], pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", *["ids"] * with_ids]
    schema = rows.select("doc_id").schema
    for n in names[1:5]:
        schema = schema.add(n, "long")
    if with_ids:
        schema = schema.add("ids", T.ArrayType(T.IntegerType()))
    return (
        rows.mapInArrow(cut, schema)
        .withColumn("bucket", F.log2("length").cast("int"))
        .withColumn("sequence_id", F.monotonically_increasing_id())
        .withColumn("offset", F.lit(0).cast("long"))
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Pieces with their ids as Parquet, one folder per length: batches of one bucket have one shape."""
    pieces.write.partitionBy("bucket").parquet(path)
