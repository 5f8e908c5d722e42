"""Passages of short lines against a version that shares no code with line dedup."""

import random

import awkward
from tidemark.llm import line_dedup


def plain_passages(docs, least=50):
    """Per id the lines left: those in no run of equal lines with ``least`` words that a smaller id holds as well."""
    left = {}
    for i in sorted(docs):
        mine, gone = docs[i], set()
        for j in docs:
            if j >= i:
                continue
            other = docs[j]
            for a in range(len(mine)):
                for b in range(len(other)):
                    if mine[a] != other[b] or (a and b and mine[a - 1] == other[b - 1]):
                        continue
                    n = 0
                    while a + n < len(mine) and b + n < len(other) and mine[a + n] == other[b + n]:
                        n += 1
                    if sum(len(x.split()) for x in mine[a:a + n]) >= least:
                        gone.update(range(a, a + n))
        left[i] = [x for k, x in enumerate(mine) if k not in gone]
    return left


def test_passages_of_short_lines_go_whatever_stands_around_them(spark):
    draw = random.Random(11)
    line = lambda n: " ".join(f"w{draw.randrange(10**6)}" for _ in range(n))
    around = lambda: [line(draw.randrange(3, 12)) for _ in range(draw.randrange(1, 5))]
    docs = {}
    for count, size in [(2, 30), (3, 20), (4, 15), (6, 10), (10, 10), (5, 11), (7, 8), (2, 25), (8, 7), (3, 17)] * 6:
        passage = [line(size) for _ in range(count)]
        if count > 4:
            passage.insert(2, "")
        for part in (passage, passage, passage + passage[:1]):
            docs[len(docs)] = [*around(), *part, *around()]
    docs[9000] = [*around(), *docs[0], *around(), *docs[9]]
    table = awkward.table(spark, [(i, "\n".join(lines), "en") for i, lines in docs.items()])
    got = {r.doc_id: r.text.split("\n") for r in line_dedup.line_dedup(table, line_dedup.PASSAGES).collect()}
    assert got == plain_passages(docs)


def test_repetitions_within_a_text_leave_the_first_whole():
    block = [f"a{k} b c d e f g h i j" for k in range(6)]
    text = "\n".join(["x", *block, "y", *block, "z"])
    assert line_dedup.without(text, [], line_dedup.PASSAGES).split("\n") == ["x", *block, "y", "z"]
    same = "\n".join(["one two three four five six seven eight nine ten"] * 7)
    assert 5 <= len(line_dedup.without(same, [], line_dedup.Settings(passage_words=50, window=1, one_in=10**9)).split("\n"))
    blank = "\n" * 50_000
    assert line_dedup.without(blank + "word", [], line_dedup.PASSAGES) == blank + "word"
