"""Hard negatives against brute force, the curve and the bounds of blocks."""

import itertools
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings as how, strategies as st
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as h

SCHEMA = "vec_id long, embedding array<float>, label int, rank int, block long, q string, place int, used int"
SMALL = dict(block=16, group=4, page=4, part=100)


def plain(rows, anchor=lambda i: i % 10 == 0, low=50, high=95):
    kept = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(c is not None and np.isfinite(np.float32(c)) for c in v):
            q = tuple(int(np.floor(256 * float(np.float32(c)))) for c in v)
            kept[i, label, q] = None
    out = []
    for i, label, q in kept:
        if not anchor(i):
            continue
        scored = [(-sum(map(int.__mul__, q, p)), j, other) for j, other, p in kept if j != i and len(p) == len(q)]
        for s, j, _ in sorted(x for x in scored if x[2] == label)[:5]:
            fits = sorted(x for x in scored if x[2] != label and low * -s <= 100 * -x[0] <= high * -s)
            out += [(i, j, k, n, -s, -t) for k, (t, n, _) in enumerate(fits[:3], 1)]
    return sorted(out)


def run(spark, rows, **more):
    table = spark.createDataFrame([(i, v, label, 1, 2, "a", 3, 4) for i, v, label in rows], SCHEMA)
    return sorted(map(tuple, h.hard_negatives(table, F.col("vec_id") % 10 == 0, h.Settings(**(SMALL | more))).collect()))


def clustered(n, width=12, seed=1, noise=0.05):
    draw = np.random.default_rng(seed)
    centres = draw.standard_normal((6, width)) / 2
    return [(k, (centres[k % 6] + noise * draw.standard_normal(width)).tolist(), int(draw.integers(3))) for k in range(n)]


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2), (4, 2), (6, 1)])
def test_curve_visits_every_cell_by_single_steps(dims, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
    place = h.hilbert(cells, bits)
    assert sorted(place.tolist()) == list(range(len(cells)))
    assert (np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(axis=1) == 1).all()


@how(max_examples=50, deadline=None)
@given(st.integers(0, 10_000))
def test_bounds_hold_every_score(seed):
    draw = np.random.default_rng(seed)
    q, block = draw.integers(-50, 50, (3, 5)), draw.integers(-50, 50, (7, 5))
    low, up = h.bounds(q, block.min(axis=0, keepdims=True), block.max(axis=0, keepdims=True))
    score = q @ block.T
    assert (low <= score).all() and (score <= up).all()


def test_equal_to_brute_force(spark):
    rows = clustered(700)
    assert run(spark, rows) == plain(rows)
    flat = [(k, np.random.default_rng(k).standard_normal(5).tolist(), k % 4) for k in range(300)]
    assert run(spark, flat) == plain(flat)


def test_hot_label_ties_and_copies(spark):
    # Two thirds of the rows carry one label, half of all vectors are equal, so scores tie across many blocks.
    same = [0.5, 0.25, -0.5, 0.125]
    rows = [(k, same if k % 2 else [0.5, 0.25, -0.5, (k % 9) / 16], 1 if k % 3 else 2) for k in range(600)]
    rows += [(k, same, 1) for k in range(1, 200, 2) if k % 3]  # rows that are in the table already
    assert run(spark, rows) == plain(rows)


def test_rows_that_take_no_part(spark):
    v = [0.5, 0.25, 0.125]
    rows = [(None, v, 1), (1, None, 1), (2, v, None), (3, [0.5, None, 0.1], 1), (4, [0.5, float("nan"), 0.1], 2), (5, [float("inf"), 0.0, 0.0], 2),
            (10, v, 1), (11, v, 1), (12, [0.3, 0.2, 0.1], 2), (13, [0.5, 0.2, 0.1], 2), (20, [1.0, 2.0], 1), (21, [1.0, 2.0], 1), (22, [1.0, 1.0], 2),
            (30, [], 1), (31, [], 1), (32, [], 2), (40, [-0.5, -0.25, -0.125], 3), (41, [-0.25, 0.0, 0.0], 3), (10, [0.3, 0.3, 0.3], 1)]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []
    assert run(spark, [(10, v, 1)]) == []


def test_blocks_far_from_a_window_are_not_read(spark):
    """Along tight clusters most blocks are ruled out by their bounds."""
    rows = clustered(1200, noise=0.01)
    table = spark.createDataFrame([(i, v, label, 1, 2, "a", 3, 4) for i, v, label in rows], SCHEMA)
    settings = h.Settings(**SMALL)
    placed = h.with_place(h.quantised(table, settings, "vec_id", "embedding", "label", None), settings)
    stored = h.blocks(placed, settings.block, settings.part, "candidates")
    groups = h.blocks(placed.where("vec_id % 10 = 0"), settings.group, settings.part, "anchors").drop("lo", "hi")
    groups = groups.select("*", F.expr(f"array_repeat({h.LEAST}L, n)").alias("least"), F.expr(f"array_repeat({h.MOST}L, n)").alias("most"))
    zones = stored.select("block", "label", "width", "lo", "hi")
    seed = h.read(groups, stored, h.choose(groups, zones, settings, True, True), 5, True)
    chosen = defaultdict(set)
    for r in h.choose(h.narrowed(groups, seed, 5), zones, settings, True, False).collect():
        chosen[r.grp].add(r.block)
    of_label = stored.groupBy("label").count().agg(F.min("count")).first()[0]
    assert sum(map(len, chosen.values())) < len(chosen) * of_label / 2


def test_components_that_lose_digits_are_refused(spark):
    with pytest.raises(Exception, match="below 2\\^20"):
        run(spark, [(10, [1e6, 1.0], 1), (11, [1.0, 1.0], 1)])
