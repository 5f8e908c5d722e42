"""Parts of a batch are cut once each, their edges are found without a search, and decoding is checked in bytes."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidemark.llm.lattice_sampling import MARK, Sampler, hash_table, marked, slots

SAMPLER = Sampler(public_tokenizers.path("piece_bpe_32k.model"), 0.5, 27.0)


def some_texts() -> list[str]:
    rng = random.Random(6)
    odd = "".join(["ab Z\n\t 1'é€😀\x00�", MARK, "  "])
    return ["", " ", "\n\n", "a ", " a", MARK, *["".join(rng.choice(odd) for _ in range(rng.randrange(40))) for _ in range(300)]]


def test_parts_of_a_batch_are_distinct_and_in_order():
    texts, pieces = some_texts(), SAMPLER.pieces
    place, distinct, ends = pieces.split_all(marked(pa.array(["left out", *texts])[1:]))
    assert len(set(distinct)) == len(distinct)
    assert [[distinct[p] for p in place[a:b]] for a, b in zip(ends, ends[1:])] == [pieces.split(t) for t in texts]
    assert [len(x) for x in pieces.split_all(marked(pa.array([], pa.string())))] == [0, 0, 1]


def test_samples_do_not_depend_on_how_texts_were_cut():
    texts = some_texts()
    plain = SAMPLER.sample_all(SAMPLER.prepare(texts), 2, list(range(len(texts))))
    found = SAMPLER.sample_from(SAMPLER.starts(marked(pa.array(texts))), 2, list(range(len(texts))))
    for a, b in zip(plain, found, strict=True):
        assert [x[0].tolist() for x in a] == [x[0].tolist() for x in b]


def test_ids_that_decode_to_another_text_are_told():
    texts = ["the cat", "", "été 😀"]
    ids = [s[0][0] for s in SAMPLER.sample_all(SAMPLER.prepare(texts), 1, [1, 2, 3])]
    given = SAMPLER.pieces.given_back([*ids, ids[0], ids[1]], marked(pa.array(texts)), [0, 1, 2, 2, 0])
    assert given == [True, True, True, False, False]


def test_every_key_is_found_in_the_table():
    keys = np.unique(np.random.default_rng(1).integers(0, 1 << 40, 5000))
    held, out = hash_table(keys, keys * 2)
    at = slots(keys, len(held))
    while (other := held[at] != keys).any():
        assert (held[at] >= 0).all()
        at[other] = (at[other] + 1) % len(held)
    assert (out[at] == keys * 2).all() and (held >= 0).sum() == len(keys)
