"""Packing, token counts and lattice sampling against the tokenizer libraries and plain enumeration."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

import awkward
from tidemark.llm import lattice_sampling, packing, token_count

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PIECES)
TOKENIZER = Tokenizer.from_file(WORDS)
COUNTER = token_count.PieceCounter(PIECES)
ENCODER = packing.WordEncoder(WORDS)
SAMPLER = lattice_sampling.Sampler(PIECES, 0.5, 27.0)

ALPHABETS = [
    "abcdefghij THE  ", "ab", "the then ▁", "0123456789.,-\n\t '", "日本語 Σςİ́　", "a\x1c\x85\xa0 \r\x0b", "éèßΩ🎉\x00<s>", " ",
    "<|endoftext|> a",
]
TEXT = st.one_of(st.text(max_size=60), *[st.text(st.sampled_from(a), max_size=60) for a in ALPHABETS])


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_counts_equal_the_library(texts):
    assert COUNTER.count(texts) == [len(x) for x in MODEL.encode(texts)]


@pytest.mark.parametrize("text", ["a" * 5000, " " * 9000 + "x", "the" * 3000, "=-" * 4000, "abc" * 9000, "\n" * 50, awkward.LONG])
def test_counts_of_long_runs_equal_the_library(text):
    assert COUNTER.count([text]) == [len(MODEL.encode(text))]


@settings(max_examples=300, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8))
def test_ids_equal_the_library(texts):
    want = [e.ids for e in TOKENIZER.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in ENCODER.encode(texts)] == want


def test_token_counts_of_awkward_rows(spark):
    out = token_count.token_counts(awkward.table(spark), PIECES, limit=100).collect()
    want = Counter()
    for i, t, _ in awkward.TEXTS:
        n = len(MODEL.encode(t or ""))
        want[(i, len((t or "").encode()), n, n > 100)] += 1
    assert Counter(map(tuple, out)) == want
    assert token_count.token_counts(awkward.table(spark, []), PIECES).count() == 0


def test_pieces_are_binary_and_whole(spark):
    out = packing.pack(awkward.table(spark), WORDS, longest=64).collect()
    assert len({r.sequence_id for r in out}) == len(out)
    assert all(r.offset == 0 and r.length == len(r.ids) == 1 << r.bucket <= 64 for r in out)
    assert all(r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in out)
    starts = Counter(r.doc_id for r in out if r.start == 0)
    assert starts == Counter(i for i, _, _ in awkward.TEXTS)
    by_doc = defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
    for i, t, _ in awkward.TEXTS:
        if starts[i] > 1:
            continue
        ids, rows = [], sorted(by_doc[i], key=lambda r: r.start)
        for r in rows:
            assert r.start == len(ids)
            ids += r.ids
        assert ids == [*TOKENIZER.encode(t or "", add_special_tokens=False).ids, 1]
        assert len(rows) == len(ids) // 64 + (len(ids) % 64).bit_count()
    assert packing.pack(awkward.table(spark, []), WORDS).count() == 0


def test_buckets_are_folders_of_one_length(spark, tmp_path):
    packing.write_buckets(packing.pack(awkward.table(spark), WORDS), str(tmp_path / "b"))
    back = spark.read.parquet(str(tmp_path / "b")).selectExpr("bucket", "size(ids) AS n").distinct().collect()
    assert all(r.n == 1 << r.bucket for r in back)


def segmentations(part):
    pieces = SAMPLER.pieces
    weight = {pieces.text[i]: (int(i), float(w)) for i, w in zip(pieces.ends, pieces.weights, strict=True) if i >= 0}

    def all_of(rest):
        if not rest:
            yield (), 0.0
        for k in range(1, len(rest) + 1):
            if rest[:k] in weight:
                i, w = weight[rest[:k]]
                for tail, more in all_of(rest[k:]):
                    yield (i, *tail), w + more

    found = dict(all_of(part))
    total = math.log(sum(map(math.exp, found.values())))
    return {ids: v - total for ids, v in found.items()}


def test_samples_follow_draws_without_replacement():
    parts = SAMPLER.prepare(["hello"])[0]
    logp, n = segmentations("▁hello"), 4000
    first, both = Counter(), Counter()
    for seed in range(n):
        a, b = SAMPLER.sample(parts, 2, seed)
        for ids, lp, _, _ in (a, b):
            assert abs(logp[tuple(ids.tolist())] - lp) < 1e-9
        assert a[2] > b[2]
        first[tuple(a[0].tolist())] += 1
        both[tuple(a[0].tolist()), tuple(b[0].tolist())] += 1
    want = {x: n * math.exp(p) for x, p in logp.items()}
    chi = [(first[x] - e) ** 2 / e for x, e in want.items() if e > 5]
    assert sum(chi) < len(chi) + 5 * math.sqrt(2 * len(chi))
    pairs = {(x, y): n * math.exp(logp[x] + logp[y]) / -math.expm1(logp[x]) for x in logp for y in logp if x != y}
    chi = [(both[x] - e) ** 2 / e for x, e in pairs.items() if e > 5]
    assert sum(chi) < len(chi) + 5 * math.sqrt(2 * len(chi))


def test_few_segmentations_are_all_emitted_with_certainty():
    want = segmentations("▁the")
    got = SAMPLER.sample(SAMPLER.prepare(["the"])[0], 100, 3)
    assert {tuple(x[0].tolist()) for x in got} == set(want)
    assert all(x[3] == 0.0 for x in got)


@settings(max_examples=150, deadline=None)
@given(TEXT, st.integers(0, 1 << 40))
def test_samples_are_distinct_and_decode(text, seed):
    got = SAMPLER.sample(SAMPLER.prepare([text])[0], 3, seed)
    assert len({tuple(x[0].tolist()) for x in got}) == len(got)
    for ids, *_ in got:
        assert SAMPLER.pieces.decode(ids.tolist()) == text.replace("▁", " ")
        assert MODEL.decode(ids.tolist()) == MODEL.decode(MODEL.encode(text))


def test_sampling_awkward_rows_is_repeatable(spark):
    docs = awkward.table(spark)
    out = lattice_sampling.encode(docs, PIECES, 2, seed=5)
    a, b = sorted(map(str, out.collect())), sorted(map(str, lattice_sampling.encode(docs.repartition(3), PIECES, 2, seed=5).collect()))
    assert a == b
    assert out.where("NOT round_trip").count() == 0
    assert {r.doc_id for r in out.collect()} == {i for i, _, _ in awkward.TEXTS}
    back = lattice_sampling.decode(out, PIECES).collect()
    texts = {i: t for i, t, _ in awkward.TEXTS if i is not None}
    assert all(r.text == (texts[r.doc_id] or "") for r in back if r.doc_id is not None)
    assert lattice_sampling.encode(awkward.table(spark, []), PIECES, 2).count() == 0
