"""Cross-tokenizer alignment: which tokens of two tokenizers lie over the same bytes, and how often id pairs meet.

The spans that the tokenizers report (characters from tokenizers, bytes from SentencePiece) are coarse cuts; where tokens
share a character, or a byte-fallback token stands for a part of one, the decoded bytes of the tokens place the cuts.
Neither tokenizer merges across a single space between words, so a text is aligned word by word and words are remembered.

Corpus-wide counts: a block of documents keeps its id pairs once, with the number of its documents that hold each; the
sums over all blocks come back as one row per block and pair, never as a row per document and pair. What only Python
reads of a block, its pairs by document, moves as compressed bytes: as arrays it would fill the executor's heap.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tidemark.llm.common import documents, stage

MARK = "▁"  # stands for a space inside pieces of SentencePiece
CUT = re.compile(r"(?<=\S) (?=\S)")
CACHE_WORDS = 400_000  # distinct words a worker remembers, before those of the next part
CACHE_CHARS = 30_000_000  # and characters of them and their groups
LEARN_WORDS = 10_000  # words aligned at once
PART_CHARS = 500_000  # characters of the documents whose words are looked up at once, unless one document alone has more
BLOCK_CHARS = 4_000_000  # characters of the documents of a block, unless one document alone has more
SHIFT = 20  # bits of a second id inside a pair
COUNT_BITS = 32  # bits of a count behind the place of its pair
SEPARATORS = (",", "|", ";", "")  # after an id: within a side, after the last of A, after a group, after the last group


def byte_level_table() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones themselves, others from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def byte_ends(start: np.ndarray, end: np.ndarray, size: np.ndarray, place: np.ndarray, base: np.ndarray) -> np.ndarray:
    """Byte at which each token ends, of the tokens of many texts laid end to end.

    ``start`` and ``end`` are coarse: units (characters or bytes) of all texts together, ``place`` gives the byte where
    each unit starts, and the end of all. A token that ends where the next one starts is cut there. Tokens that share a
    unit with the next one, or whose span is empty, end where their own decoded bytes do: ``size`` after the cut before,
    or after ``base``, the byte where their text starts, at the first of them.
    """
    follows = np.append(start[1:], end[-1:])
    clean = (end > start) & (follows == end)
    ends = place[end]
    odd = np.flatnonzero(~clean)
    if len(odd):
        # Bytes decoded since the last clean cut or the start of the text, whichever comes later.
        total = np.cumsum(size)
        known = np.where(clean, ends, 0)
        last = np.maximum.accumulate(np.where(clean, np.arange(len(end)), -1))[odd]
        at, spent = np.where(last >= 0, known[last], 0), np.where(last >= 0, total[last], 0)
        fresh = base[odd] > at
        first = np.searchsorted(base, base[odd], side="left")
        before = np.where(first > 0, total[first - 1], 0)
        ends[odd] = np.where(fresh, base[odd] + total[odd] - before, at + total[odd] - spent)
    return ends


class Aligner:
    """Aligns words of texts by two tokenizer files, and remembers them."""

    def __init__(self, byte_file: str, piece_file: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        with open(byte_file, encoding="utf-8") as f:
            form = json.load(f)
        self.a = Tokenizer.from_str(json.dumps(form | {"post_processor": None, "truncation": None, "padding": None}))
        self.a.encode_special_tokens = True
        table = byte_level_table()
        self.a_bytes = {i: bytes(table[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)
        ]
        # Words are independent where no piece has a space after another character, and none is cut at spaces otherwise.
        self.by_word = not any(MARK in p.lstrip(MARK) for i, p in enumerate(pieces) if not self.b.is_byte(i))
        # Texts of ids with what may follow them in groups; the ids of B come after those of A.
        count = max(self.a_bytes) + 1
        self.second = count
        self.shown = [f"{i}{sep}" for sep in SEPARATORS for ids in (range(count), range(len(pieces))) for i in ids]
        self.a_size, self.b_size = np.zeros(count, np.int64), np.array([len(x) for x in self.b_bytes])
        for i, x in self.a_bytes.items():
            self.a_size[i] = len(x)
        self.known: dict[str, int] = {}
        self.texts: list[str | None] = []  # groups as text; None where the bytes differ
        self.held = 0
        self.sizes = np.zeros((0, 4), np.int32)  # tokens of either side, groups, links
        self.pairs = np.zeros(0, np.int64)
        self.starts = np.zeros(1, np.int64)
        self.used = np.zeros(0, np.int32)  # parts that had the word; 1 for those kept from before

    def forget(self) -> None:
        """Of the words that more than one part had, keep the most used ones, to half of what may be remembered."""
        size = np.fromiter((len(w) + len(t or "") for w, t in zip(self.known, self.texts, strict=True)), np.int64, len(self.texts))
        keep = np.flatnonzero((self.used > 1) & (size <= CACHE_CHARS // 1000))
        keep = keep[np.argsort(-self.used[keep], kind="stable")][:CACHE_WORDS // 2]
        keep = np.sort(keep[np.cumsum(size[keep]) <= CACHE_CHARS // 2])
        words = list(self.known)
        self.known = {words[k]: i for i, k in enumerate(keep.tolist())}
        self.texts = [self.texts[k] for k in keep.tolist()]
        self.held = int(size[keep].sum())
        self.sizes = self.sizes[keep]
        self.pairs = self.pairs[self.places(keep)[0]]
        self.starts = np.append(0, np.cumsum(self.sizes[:, 3], dtype=np.int64))
        self.used = np.ones(len(keep), np.int32)

    def places(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the pairs of words are, word after word, and how many each has."""
        n = self.starts[words + 1] - self.starts[words]
        first = np.repeat(self.starts[words] - np.append(0, np.cumsum(n))[:-1], n)
        return first + np.arange(len(first)), n

    def learn(self, words: list[str]) -> None:
        """Align new words, many at once."""
        sizes, pairs = [self.sizes], [self.pairs]
        for k in range(0, len(words), LEARN_WORDS):
            some = words[k:k + LEARN_WORDS]
            texts, size, pair = self.align(some)
            self.known.update(zip(some, range(len(self.texts), len(self.texts) + len(texts)), strict=True))
            self.texts += texts
            self.held += sum(map(len, some)) + sum(len(t) for t in texts if t)
            sizes.append(size.astype(np.int32))
            pairs.append(pair)
        if words:
            self.sizes, self.pairs = np.concatenate(sizes), np.concatenate(pairs)
            self.starts = np.append(0, np.cumsum(self.sizes[:, 3], dtype=np.int64))
            self.used = np.append(self.used, np.zeros(len(words), np.int32))

    def align(self, words: list[str]) -> tuple[list[str | None], np.ndarray, np.ndarray]:
        """Per word its groups as text (None where bytes differ) and its sizes, and the pairs of all words one after another."""
        spaced = [" " + w for w in words]
        ours = self.a.encode_batch(spaced, add_special_tokens=False)
        theirs = [[(p.id, p.begin, p.end) for p in y.pieces] for y in self.b.encode(words, return_type="proto", num_threads=1)]
        a_ids = [x.ids for x in ours]
        raw = [w.encode() for w in spaced]
        a_bytes, b_bytes = self.a_bytes.__getitem__, self.b_bytes.__getitem__
        good = np.array([
            b"".join(map(a_bytes, x)) == w == b"".join([b_bytes(p[0]) for p in y]) for x, y, w in zip(a_ids, theirs, raw, strict=True)
        ])
        texts: list[str | None] = [None] * len(words)
        sizes = np.zeros((len(words), 4), np.int64)
        fit = np.flatnonzero(good).tolist()
        if not fit:
            return texts, sizes, np.zeros(0, np.int64)
        flat = lambda parts, kind=np.int64: np.fromiter(chain.from_iterable(parts), kind)
        chars, n_bytes = np.array([len(spaced[k]) for k in fit]), np.array([len(raw[k]) for k in fit])
        first_char, first_byte = np.append(0, np.cumsum(chars)), np.append(0, np.cumsum(n_bytes))
        n_a, n_b = np.array([len(a_ids[k]) for k in fit]), np.array([len(theirs[k]) for k in fit])
        a_word, b_word = np.repeat(np.arange(len(fit)), n_a), np.repeat(np.arange(len(fit)), n_b)
        code = np.frombuffer("".join([spaced[k] for k in fit]).encode("utf-32-le"), np.uint32)
        wide = np.ones(len(code), np.int64) + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF)
        place = np.append(0, np.cumsum(wide))
        a = flat(a_ids[k] for k in fit)
        spans = flat(chain.from_iterable(ours[k].offsets) for k in fit).reshape(-1, 2) + first_char[a_word, None]
        a_ends = byte_ends(spans[:, 0], spans[:, 1], self.a_size[a], place, first_byte[a_word])
        # Spans of pieces are bytes of the text without the space before it; that byte belongs to the first piece.
        found = flat(chain.from_iterable(theirs[k]) for k in fit).reshape(-1, 3)
        b, b_first = found[:, 0], np.append(True, b_word[1:] != b_word[:-1])
        start, end = found[:, 1] + 1 + first_byte[b_word], found[:, 2] + 1 + first_byte[b_word]
        start = np.where(b_first, first_byte[b_word], start)
        b_ends = byte_ends(start, end, self.b_size[b], np.arange(first_byte[-1] + 1), first_byte[b_word])
        # A link per stretch between ends of either side: the token of each side that covers it.
        stops = np.union1d(a_ends, b_ends)
        i, j = np.searchsorted(a_ends, stops), np.searchsorted(b_ends, stops)
        pairs = a[i] << SHIFT | b[j]
        # A group ends where both sides do.
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        a_last, b_last = cuts[a_group] == a_ends, cuts[b_group] == b_ends
        closes = b_last & np.append(b_word[1:] != b_word[:-1], True)
        kind = np.concatenate([np.where(a_last, 1, 0), np.where(closes, 3, np.where(b_last, 2, 0))])
        token = np.concatenate([a, self.second + b]) + kind * (self.second + len(self.b_size))
        order = np.lexsort((np.repeat([0, 1], [len(a), len(b)]), np.concatenate([a_group, b_group])))
        shown = list(map(self.shown.__getitem__, token[order].tolist()))
        stop = np.cumsum(n_a + n_b).tolist()
        for k, begin, end in zip(fit, [0, *stop], stop):
            texts[k] = "".join(shown[begin:end])
        word_of = lambda ends: np.bincount(np.searchsorted(first_byte, ends) - 1, minlength=len(fit))
        sizes[fit] = np.stack([n_a, n_b, word_of(cuts), word_of(stops)], axis=1)
        return texts, sizes, pairs

    def block(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of all texts: their sizes, digests and distinct pairs, then per document and pair the document, the place of the
        pair among those, and how often the document has it."""
        found, begin = [], 0
        while begin < len(texts):
            end, size = begin + 1, len(texts[begin])
            while end < len(texts) and size + len(texts[end]) <= PART_CHARS:
                size += len(texts[end])
                end += 1
            sizes, digests, pair, doc, code, times = self.part(texts[begin:end])
            found.append((sizes, digests, pair, (doc + begin).astype(np.int32), code.astype(np.int32), times.astype(np.int32)))
            begin = end
        sizes, digests, pairs, docs, codes, times = zip(*found, strict=True)
        pair, place = np.unique(np.concatenate(pairs), return_inverse=True)
        place = np.split(place.astype(np.int32), np.cumsum([len(p) for p in pairs])[:-1])
        code = np.concatenate([at[c] for at, c in zip(place, codes, strict=True)])
        return np.concatenate(sizes), [*chain.from_iterable(digests)], pair, np.concatenate(docs), code, np.concatenate(times)

    def part(self, texts: list[str]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """As ``block``, of texts whose words are looked up at once."""
        if len(self.texts) > CACHE_WORDS or self.held > CACHE_CHARS:
            self.forget()
        cut = [(CUT.split(t) if self.by_word else [t]) if t else [] for t in texts]
        new = list({w for some in cut for w in some}.difference(self.known))
        self.learn(new)
        known, kept = self.known, self.texts
        ids, doc, digests = [], [], []
        for k, some in enumerate(cut):
            of = list(map(known.__getitem__, some))
            parts = [kept[i] for i in of]
            if not parts or None in parts:
                digests.append("")
                continue
            digests.append(hashlib.sha256(";".join(parts).encode()).hexdigest())
            ids.append(np.array(of, np.int64))
            doc.append(np.full(len(of), k))
        sizes = np.zeros((len(texts), 4), np.int64)
        if not ids:
            empty = np.zeros(0, np.int64)
            return sizes, digests, empty, empty, empty, empty
        words, doc = np.concatenate(ids), np.concatenate(doc)
        self.used[np.unique(words)] += 1
        # Each word of a document once, with its number; then the same with the pairs of its words.
        key, times = np.unique(doc * len(kept) + words, return_counts=True)
        doc, words = np.divmod(key, len(kept))
        spread = np.append(0, np.cumsum(np.bincount(doc, minlength=len(texts))))
        for c in range(4):
            sizes[:, c] = np.diff(np.append(0, np.cumsum(self.sizes[words, c] * times))[spread])
        at, n = self.places(words)
        pair, code = np.unique(self.pairs[at], return_inverse=True)
        key = np.repeat(doc, n) * len(pair) + code
        order = np.argsort(key)
        key, times = key[order], np.repeat(times, n)[order]
        edge = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        doc, code = np.divmod(key[edge], len(pair))
        times = np.add.reduceat(times, edge)
        return sizes, digests, pair, doc, code, times


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def aligner(byte_file: str, piece_file: str) -> Aligner:
    key = byte_file, piece_file
    if key not in _ALIGNERS:
        _ALIGNERS[key] = Aligner(*key)
    return _ALIGNERS[key]


def pack(values: np.ndarray) -> bytes:
    """Numbers of 32 bits as compressed bytes; the bytes of equal weight lie together."""
    return pa.compress(np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).data, codec="zstd", asbytes=True)


def unpack(data: pa.Buffer, n: int) -> np.ndarray:
    """The ``n`` numbers that ``pack`` was given."""
    plain = pa.decompress(data, decompressed_size=4 * n, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(plain, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def by_block(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[tuple[pa.Array, list[str]]]:
    """Ids and texts, as many documents at once as have ``chars`` characters."""
    ids, texts, size = [], [], 0
    for batch in batches:
        kind = batch.column("doc_id").type
        for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            if texts and size + len(t) > chars:
                yield pa.array(ids, kind), texts
                ids, texts, size = [], [], 0
            ids.append(i)
            texts.append(t)
            size += len(t)
    if texts:
        yield pa.array(ids, kind), texts


def token_alignment(
    docs: DataFrame, byte_file: str, piece_file: str, id_col: str = "doc_id", text_col: str = "text", block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """One row per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A is a byte-level BPE file of tokenizers and takes space + text, B a SentencePiece model and takes the text, before
    which it puts a space itself; neither knows special tokens in texts. Groups are cut where tokens of both sides end.
    A link is an occurrence of an A and a B token whose bytes overlap; the count of its id pair is the number of rows
    that hold it. ``n_best`` counts the links whose count is the highest of their A id, ``count_sum`` adds up counts.
    Null and empty texts, and texts whose tokens don't decode to space + text, give zeros and an empty digest and count
    nowhere. Null ids stay null; rows that repeat an id count each; an empty table gives no rows; further columns are
    not read. A very long text is one block and, without spaces, one word. Pairs move once per block of documents.
    """
    rows = documents(docs, id_col, text_col)
    numbers = ["n_a", "n_b", "n_groups", "n_links"]
    names = ["block", "docs", *numbers, "groups_sha256", "pairs", "holders", "distinct", "codes", "times"]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, task = aligner(byte_file, piece_file), TaskContext.get().partitionId()
        for at, (ids, texts) in enumerate(by_block(batches, block_chars)):
            sizes, digests, pairs, doc, code, times = tool.block(texts)
            one = lambda values, kind=None: pa.ListArray.from_arrays(
                pa.array([0, len(values)], pa.int32()), pa.array(values) if kind is None else pa.array(values, kind)
            )
            yield pa.RecordBatch.from_arrays([
                pa.array([(task << 32) + at], pa.int64()), one(ids), *[one(sizes[:, k], pa.int64()) for k in range(4)],
                one(digests, pa.string()), one(pairs, pa.int64()), one(np.bincount(code, minlength=len(pairs)), pa.int64()),
                one(np.bincount(doc, minlength=len(texts)), pa.int64()), pa.array([pack(np.diff(code, prepend=0))], pa.binary()), pa.array([pack(times)], pa.binary()),
            ], names)

    kind = rows.schema["doc_id"].dataType
    many, data = T.ArrayType(T.LongType()), T.BinaryType()
    kinds = [T.LongType(), T.ArrayType(kind), *[many] * 4, T.ArrayType(T.StringType()), many, many, many, data, data]
    blocks = stage(rows.mapInArrow(encode, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])), "aligned")

    held = blocks.select("block", "holders", F.posexplode("pairs").alias("at", "pair"))
    counts = held.select("pair", F.get("holders", F.col("at")).alias("n")).groupBy("pair").agg(F.sum("n").alias("count"))
    # An A id has at most as many pairs as B has ids.
    best = F.max("count").over(Window.partitionBy(F.shiftright("pair", SHIFT)))
    counts = stage(counts.withColumn("best", F.col("count") == best), "counts")
    # Place and count as one number, its bits turned over where the count is the highest: numbers are gathered in less memory than rows.
    fits = F.when(F.col("count") < 1 << COUNT_BITS, F.col("count")).otherwise(F.raise_error(F.lit("an id pair is in too many rows")).cast("long"))
    number = F.shiftleft(F.col("at").cast("long"), COUNT_BITS).bitwiseOR(fits)
    number = F.when(F.col("best"), F.bitwise_not(number)).otherwise(number)
    back = held.select("block", "at", "pair").join(counts, "pair").groupBy("block").agg(F.collect_list(number).alias("counted"))
    both = blocks.drop("pairs", "holders").join(back, "block", "left")

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(len(batch)):
                get = lambda c: batch.column(c)[k].values  # noqa: E731, B023
                add = np.zeros((len(get("docs")), 2), np.int64)
                if batch.column("counted")[k].is_valid:
                    counted = get("counted").to_numpy()
                    top = counted < 0
                    counted = np.where(top, ~counted, counted)
                    at = counted >> COUNT_BITS
                    value = np.zeros((len(at), 2), np.int64)
                    value[at, 0], value[at, 1] = top, counted & (1 << COUNT_BITS) - 1
                    ends = np.append(0, np.cumsum(get("distinct").to_numpy()))
                    steps, often = (unpack(batch.column(c)[k].as_buffer(), int(ends[-1])) for c in ("codes", "times"))
                    code = np.cumsum(steps)
                    for c in range(2):
                        add[:, c] = np.diff(np.append(0, np.cumsum(value[code, c] * often))[ends])
                yield pa.RecordBatch.from_arrays(
                    [get("docs"), *[get(c) for c in numbers], pa.array(add[:, 0]), pa.array(add[:, 1]), get("groups_sha256")], out
                )

    out = ["doc_id", *numbers, "n_best", "count_sum", "groups_sha256"]
    kinds = [kind, *[T.LongType()] * 6, T.StringType()]
    return both.mapInArrow(total, T.StructType([T.StructField(n, k) for n, k in zip(out, kinds, strict=True)]))
