"""Words of a batch are looked up once each, and texts get the ids of the tokenizer all the same."""

import random
import re

import numpy as np
import public_tokenizers
import pyarrow as pa

from tidemark.llm.packing import WordEncoder, cut_words

TEXTS = ["", " ", "a b a", "a\tb\n\na ", "é 😀 é x", "<s> the</s> the", "x" * 100 + " y"]


def some_texts() -> list[str]:
    rng = random.Random(4)
    return TEXTS + ["".join(rng.choice("ab Z\n\t 1'é▁€😀<s>|x  ") for _ in range(rng.randrange(60))) for _ in range(500)]


def test_words_of_a_batch_are_distinct_and_in_order():
    texts = some_texts()
    place, distinct, ends = cut_words(pa.array(["left out", *texts])[1:])
    assert len(set(distinct)) == len(distinct)
    got = [[distinct[p] for p in place[a:b]] for a, b in zip(ends, ends[1:])]
    assert got == [re.split("[ \n\t]", t) for t in texts]
    assert [len(x) for x in cut_words([])] == [0, 0, 1]


def test_each_word_of_a_batch_is_looked_up_once():
    encoder, asked = WordEncoder(public_tokenizers.path("word_bpe_49k.json")), []

    class Words(dict):
        def get(self, word):
            asked.append(word)
            return super().get(word)

    encoder.words = Words()
    texts = some_texts()
    for _ in range(2):
        asked.clear()
        got = encoder.encode(pa.array(texts))
        assert len(set(asked)) == len(asked)
        plain = encoder.tokenizer.encode_batch(texts, add_special_tokens=False)
        assert all(np.array_equal(g, e.ids) for g, e in zip(got, plain, strict=True))
