"""Token counts of a SentencePiece BPE model by rank-synchronous merging of ragged numpy arrays.

A text is cut where no piece of the model can span: before each run of word marks, around characters without a piece,
and between characters that never stand side by side inside a piece. Those pre-tokens lie one after the other in one
array of symbols. Each round finds the lowest-ranked pair of every sequence and merges its occurrences at once; what is
left when no pair has a rank is the number of tokens.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidemark.llm.common import documents

MARK = "▁"  # stands for a space inside pieces
CACHE_WORDS = 800_000  # distinct pre-tokens a worker remembers
CACHE_CHARS = 40  # longer ones are counted anew each time
NO_RANK = np.int64(1 << 40)
SMALL = 512  # code points looked up in a table


class PieceCounter:
    """Counts tokens with the merges of one model file."""

    def __init__(self, model_file: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        usual = [
            i for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
        ]
        pieces = {model.id_to_piece(i): i for i in usual}
        # Pieces of one score merge from the left; the shorter first gives the same cuts, as the longer is made of it.
        order = sorted(usual, key=lambda i: (-model.get_score(i), len(model.id_to_piece(i))))
        rank = {i: k for k, i in enumerate(order)}
        self.size = model.get_piece_size()
        self.char_ids = np.full(0x110000, -1, np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.char_ids[ord(p)] = i
        merges = sorted(
            (pieces[p[:k]] * self.size + pieces[p[k:]], rank[i], i)
            for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces
        )
        self.pairs, self.ranks, self.made = (np.array(x, np.int64) for x in zip(*merges, strict=True))
        # Pieces that some pair of their own or a better rank takes in at once.
        own = np.full(self.size, NO_RANK)
        own[list(rank)] = list(rank.values())
        self.hasty = np.zeros(self.size, bool)
        for part in (self.pairs // self.size, self.pairs % self.size):
            self.hasty[part[self.ranks <= own[part]]] = True
        self.beside = np.unique(np.array([ord(p[k]) << 21 | ord(p[k + 1]) for p in pieces for k in range(len(p) - 1)], np.int64))
        left, right = self.beside >> 21, self.beside & 0x1FFFFF
        self.beside_rank, self.beside_made = self.lookup(self.char_ids[left].astype(np.int64), self.char_ids[right].astype(np.int64))
        self.near = np.full((SMALL, SMALL), -1, np.int32)  # place in ``beside`` of pairs of common characters
        few = (left < SMALL) & (right < SMALL)
        self.near[left[few], right[few]] = np.flatnonzero(few)
        lines = not any("\n" in p for p in pieces)  # then a line break stands alone as one byte
        self.cut = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+" if lines else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.lines = lines
        self.known: dict[str, int] = {}

    def lookup(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and resulting piece of each pair; NO_RANK where the model has no such merge."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
        hit = self.pairs[at] == key
        return np.where(hit, self.ranks[at], NO_RANK), self.made[at]

    def merged(self, words: list[str]) -> np.ndarray:
        """Tokens of each pre-token."""
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        ids = self.char_ids[code].astype(np.int64)
        has = ids >= 0
        n_bytes = 1 + (code >= 0x80) + (code >= 0x800) + (code >= 0x10000)
        total = np.bincount(word, np.where(has, 0, n_bytes), len(words)).astype(np.int64)
        if not has.any():
            return total
        left, right = code[:-1], code[1:]
        near = self.near[np.minimum(left, SMALL - 1), np.minimum(right, SMALL - 1)]
        rare = np.flatnonzero((left >= SMALL - 1) | (right >= SMALL - 1))
        pair = left[rare] << 21 | right[rare]
        place = np.minimum(np.searchsorted(self.beside, pair), len(self.beside) - 1)
        near[rare] = np.where(self.beside[place] == pair, place, -1)
        joined = (word[1:] == word[:-1]) & has[1:] & has[:-1] & (near >= 0)
        rank = np.append(np.where(joined, self.beside_rank[near], NO_RANK), NO_RANK)[has]
        made = np.append(self.beside_made[near], 0)[has]
        seq = np.concatenate([[0], np.cumsum(~joined)])[has]
        sym, word = ids[has], word[has]
        while len(sym):
            new = np.concatenate([[True], seq[1:] != seq[:-1]])
            starts = np.flatnonzero(new)
            group = np.cumsum(new) - 1
            least = np.minimum.reduceat(rank, starts)
            done = (least == NO_RANK)[group]
            if done.any():
                total += np.bincount(word[done], minlength=len(words))
                keep = ~done
                sym, seq, word, rank, made, new = sym[keep], seq[keep], word[keep], rank[keep], made[keep], new[keep]
                if not len(sym):
                    break
                starts, group, least = np.flatnonzero(new), np.cumsum(new) - 1, least[least < NO_RANK]
            low = least[group]
            here = rank == low
            # Of overlapping occurrences the leftmost of each run counts, then every second one.
            index = np.arange(len(sym))
            first = here & ~np.concatenate([[False], here[:-1]])
            here &= (index - np.maximum.accumulate(np.where(first, index, 0))) % 2 == 0
            spots = np.flatnonzero(here)
            result, bar = made[spots], low[spots]
            # An occurrence whose merge makes a pair of this rank or a better one comes before the occurrences after it.
            early = np.zeros(len(spots), bool)
            doubt = np.flatnonzero(self.hasty[result])
            if len(doubt):
                left = sym[np.maximum(spots - 1, 0)]
                follows = np.concatenate([[False], spots[1:] == spots[:-1] + 2])
                left = np.where(follows, np.concatenate([[0], result[:-1]]), left)[doubt]
                at, one, most = spots[doubt], result[doubt], bar[doubt]
                right_at = np.minimum(at + 2, len(sym) - 1)
                early[doubt] = ((self.lookup(left, one)[0] <= most) & ~new[at]) | (
                    (self.lookup(one, sym[right_at])[0] <= most) & (at + 2 < len(sym)) & (seq[right_at] == seq[at])
                )
            before = np.cumsum(early) - early
            owner = group[spots]
            lead = np.concatenate([[True], owner[1:] != owner[:-1]])
            base = before[np.flatnonzero(lead)][np.cumsum(lead) - 1]
            spots, result = spots[before == base], result[before == base]
            sym[spots] = result
            alive = np.ones(len(sym), bool)
            alive[spots + 1] = False
            sym, seq, word, rank, made = sym[alive], seq[alive], word[alive], rank[alive], made[alive]
            at = spots - np.arange(len(spots))  # where the results stand now
            changed = np.zeros(len(sym), bool)
            changed[at] = changed[np.maximum(at - 1, 0)] = True
            at = np.flatnonzero(changed)
            after = np.minimum(at + 1, len(sym) - 1)
            rank[at], made[at] = self.lookup(sym[at], sym[after])
            rank[at[(seq[at] != seq[after]) | (at == after)]] = NO_RANK
        return total

    def count(self, texts: list[str]) -> list[int]:
        """Tokens of each text, without begin and end."""
        cut = [self.cut.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        known = self.known
        found = [list(map(known.get, words)) for words in cut]
        new = [[w for w, n in zip(words, got, strict=True) if n is None] if None in got else [] for words, got in zip(cut, found, strict=True)]
        missing = list({w for words in new for w in words})
        fresh: dict[str, int] = {}
        for k in range(0, len(missing), 50_000):
            part = missing[k:k + 50_000]
            fresh.update(zip(part, self.merged(part).tolist(), strict=True))
        known.update((w, n) for w, n in fresh.items() if len(w) <= CACHE_CHARS)
        found = [
            (sum(filter(None, got)) + sum(map(fresh.__getitem__, words)) if words else sum(got))
            for got, words in zip(found, new, strict=True)
        ]
        return [n + t.count("\n") for n, t in zip(found, texts, strict=True)] if self.lines else found


_COUNTERS: dict[str, PieceCounter] = {}


def counter(model_file: str) -> PieceCounter:
    """One counter per worker process and model."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PieceCounter(model_file)
    return _COUNTERS[model_file]


def token_counts(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit.

    Null and empty texts have 0 bytes and 0 tokens; null ids stay null; repeated rows are counted each; an empty table
    gives no rows; further columns are not read. One narrow stage, no shuffle. ``model_file`` lies on every executor.
    """
    rows = documents(docs, id_col, text_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = counter(model_file)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts.count(texts), pa.int64())],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    sized = rows.select("doc_id", "text", F.octet_length("text").cast("long").alias("n_bytes"))
    schema = sized.drop("text").schema.add("n_tokens", "long")
    return sized.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)
