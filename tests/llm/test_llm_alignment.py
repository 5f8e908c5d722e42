"""Alignment of two tokenizers against a plain version over single bytes."""

import hashlib
import subprocess
import sys
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings as how, strategies as st
from tokenizers import Tokenizer

import awkward
from tidemark.llm import token_alignment as t

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
A = Tokenizer.from_file(FILES[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def a_bytes(i):
    # A byte-level entry: its characters are bytes, shown as themselves or, where not printable, from 256 on.
    hidden = [b for b in range(256) if not (33 <= b <= 126 or 161 <= b <= 172 or 174 <= b)]
    return bytes(hidden[ord(c) - 256] if ord(c) >= 256 else ord(c) for c in A.id_to_token(i))


def b_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def aligned(text):
    """Ids of both sides, groups and links of one whole text, byte by byte; None without tokens."""
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    parts = [a_bytes(i) for i in a], [b_bytes(i) for i in b]
    if not text or any(b"".join(p) != (" " + text).encode() for p in parts):
        return None
    own = [[k for k, p in enumerate(side) for _ in p] for side in parts]
    ends = [set(np.cumsum([len(p) for p in side]).tolist()) for side in parts]
    groups, start = [], 0
    for end in sorted(ends[0] & ends[1]):
        groups.append("|".join(",".join(str(ids[k]) for k in sorted(set(o[start:end]))) for ids, o in zip((a, b), own)))
        start = end
    return len(a), len(b), groups, [(a[i], b[j]) for i, j in sorted(set(zip(*own)))]


def plain(docs):
    found = [aligned(text or "") for _, text in docs]
    count = Counter(p for f in found if f for p in set(f[3]))
    best = defaultdict(int)
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    for (i, _), f in zip(docs, found, strict=True):
        if f is None:
            yield (i, 0, 0, 0, 0, 0, 0, "")
        else:
            yield (i, f[0], f[1], len(f[2]), len(f[3]), sum(count[p] == best[p[0]] for p in f[3]), sum(count[p] for p in f[3]),
                   hashlib.sha256(";".join(f[2]).encode()).hexdigest())


def order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("chars", [200, t.BLOCK_CHARS])
def test_awkward_rows(spark, chars):
    more = [(20, "a ▁ b", ""), (21, "naïve 𝛼𝛽 😀😃 \u0301e\u0301  x \t\n\n y", ""), (22, "<|endoftext|> </s> <s><unk> <0x41>", ""), (23, "\x00 \u2581", ""),
            (24, "don't we'll  I'M 12,345.67 \u00a0\u3000z ", ""), (25, "  two", ""), (26, " ", ""), (27, "\u0378 \U000e0001ab ﷽", "")]
    rows = awkward.TEXTS + more
    got = t.token_alignment(awkward.table(spark, rows), *FILES, block_chars=chars).collect()
    assert order(got) == order(plain([(i, x) for i, x, _ in rows]))


def test_empty_table(spark):
    assert t.token_alignment(awkward.table(spark, []), *FILES).collect() == []


tool = t.Aligner(*FILES)
CHARS = st.one_of(st.characters(exclude_categories=["Cs"]), st.sampled_from(list(" \n\t'.,-▁ßéñ漢字😀\u200d\u00a0abcDEF019")))


@how(max_examples=400, deadline=None)
@given(st.text(CHARS, max_size=60))
def test_word_by_word_is_as_the_whole_text(text):
    sizes, (digest,), pairs, _, code, times = tool.block([text])
    pair = pairs[code]
    want = aligned(text)
    if want is None:
        assert digest == "" and not sizes.any() and not len(pair)
        return
    assert sizes[0].tolist() == [want[0], want[1], len(want[2]), len(want[3])]
    assert digest == hashlib.sha256(";".join(want[2]).encode()).hexdigest()
    assert {(int(p) >> t.SHIFT, int(p) & (1 << t.SHIFT) - 1): int(n) for p, n in zip(pair, times)} == Counter(want[3])


def ends(spans, sizes, place, base=None):
    start, end = np.array(spans).T
    return t.byte_ends(start, end, np.array(sizes), np.array(place), np.zeros(len(spans), int) if base is None else np.array(base)).tolist()


def test_spans_are_refined_by_bytes():
    # Three tokens share the one character 2..3 of four bytes; a fourth has a clean end.
    assert ends([(0, 2), (2, 3), (2, 3), (2, 3), (3, 5)], [2, 1, 2, 1, 2], [0, 1, 2, 6, 7, 8]) == [2, 3, 5, 6, 8]
    # Byte-fallback pieces: empty spans, the last one holds the whole character.
    assert ends([(0, 1), (1, 1), (1, 1), (1, 4)], [1, 1, 1, 1], range(5)) == [1, 2, 3, 4]
    # The same at the start of a second text, whose first character is shared.
    assert ends([(0, 1), (1, 2), (1, 2), (1, 2)], [1, 1, 1, 2], [0, 1, 5], [0, 1, 1, 1]) == [1, 2, 3, 5]


def test_caches_stay_bounded(monkeypatch):
    small = t.Aligner(*FILES)
    monkeypatch.setattr(t, "CACHE_WORDS", 50)
    texts = [" ".join(f"w{k}x{j}" for j in range(20)) for k in range(40)]
    assert [small.block([x])[1] for x in texts] == [tool.block([x])[1] for x in texts]
    assert len(small.texts) <= 50 + 20


def test_caches_stay_bounded_within_a_block(monkeypatch):
    small = t.Aligner(*FILES)
    texts = ["", *[" ".join([f"w{k}x{j}" for j in range(20)] + ["common words"]) for k in range(40)]]
    want = tool.block(texts)
    monkeypatch.setattr(t, "CACHE_WORDS", 50)
    monkeypatch.setattr(t, "PART_CHARS", 200, raising=False)
    got = small.block(texts)
    assert len(small.texts) <= 50 + 22
    assert small.held == sum(len(w) + len(x) for w, x in zip(small.known, small.texts, strict=True))
    assert {"common", "words"} <= set(small.known)
    for x, y in zip(got, want, strict=True):
        assert list(map(str, x)) == list(map(str, y))
    # Long words are not kept, nor is what goes beyond the characters.
    monkeypatch.setattr(t, "CACHE_CHARS", 5_000)
    long = "many 123456789 " * 2 + "x" * 5_000
    assert [small.block([x])[1] for x in [long, long, "many"]] == [tool.block([x])[1] for x in [long, long, "many"]]
    assert "many" in small.known and "x" * 5_000 not in small.known and small.held <= 2_500


GROWTH = """
import sys
from tidemark.llm.token_alignment import Aligner
peak = lambda: int(next(x for x in open("/proc/self/status") if x.startswith("VmHWM")).split()[1]) / 1024
tool = Aligner(*sys.argv[1:])
tool.block(["ready"])
before = peak()
for k in range(2):
    tool.block([" ".join(f"{(i * 7919 + k) % 1000003:07x}"[::-1] for i in range(j, j + 500)) for j in range(k * 400_000, k * 400_000 + 400_000, 500)])
print(peak() - before)
"""


def test_memory_of_a_worker():
    # Two of them and a full heap of 1.8 GB fit into an executor of 3 GB.
    done = subprocess.run([sys.executable, "-c", GROWTH, *FILES], capture_output=True, text=True, check=True, cwd=Path(t.__file__).parents[2])
    assert float(done.stdout) < 260


@how(max_examples=50, deadline=None)
@given(st.lists(st.integers(-(2**31), 2**31 - 1)))
def test_numbers_are_packed(values):
    kept = np.array(values, np.int32)
    assert t.unpack(pa.py_buffer(t.pack(kept)), len(kept)).tolist() == values
