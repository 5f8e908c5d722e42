"""Embedding near-dedup and quality scores against plain versions."""

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import awkward
from tidemark.llm import embedding_dedup, quality

SCHEMA = "vec_id long, embedding array<float>, label int, component long, x int, n_links string, level int, keys int"


def plain(rows, least=0.93):
    units = {}
    for i, v, label in rows:
        ok = i is not None and label is not None and v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        if ok:
            x = np.array(v, np.float32).astype(np.float64)
            units[i] = (x / np.linalg.norm(x), label)
    near = {i: {j for j in units if j != i and units[i][1] == units[j][1] and len(units[i][0]) == len(units[j][0])
                and units[i][0] @ units[j][0] >= least} for i in units}
    low = {}
    for i in sorted(near):
        if i not in low:
            stack, found = [i], {i}
            while stack:
                for j in near[stack.pop()] - found:
                    found.add(j)
                    stack.append(j)
            low |= dict.fromkeys(found, i)
    return {(i, len(near.get(i, ())), low.get(i, i), low.get(i, i) == i) for i, _, _ in rows}


def run(spark, rows, **how):
    table = spark.createDataFrame([(i, v, label, 1, 2, "a", 3, 4) for i, v, label in rows], SCHEMA)
    return embedding_dedup.embedding_dedup(table, embedding_dedup.Settings(**how))


def test_groups_of_all_shapes(spark):
    draw = np.random.default_rng(3)
    rows = []
    for g, (size, noise) in enumerate([(1, 0), (2, 0.02), (90, 0.03), (60, 0.05), (120, 0.0), (40, 0.07)]):
        centre = draw.standard_normal(24)
        centre /= np.linalg.norm(centre)
        for _ in range(size):
            rows.append((len(rows) * 7, (centre + noise * draw.standard_normal(24)).tolist(), g % 3))
    arc = [(5000 + k, [math.cos(k / 12), math.sin(k / 12), *[0.0] * 22], 1) for k in range(30)]  # a chain, not a clique
    rows += arc + [(9000 + k, draw.standard_normal(24).tolist(), k % 4) for k in range(200)]
    assert set(map(tuple, run(spark, rows, block=16).collect())) == plain(rows)


def test_vectors_that_cannot_link(spark):
    v = [1.0, 2.0, 3.0]
    rows = [(1, v, 1), (2, v, 1), (3, v, 2), (4, v, None), (5, None, 1), (6, [], 1), (7, [0.0] * 3, 1), (8, [1.0, None, 3.0], 1),
            (9, [1.0, float("nan"), 3.0], 1), (10, [1.0, float("inf"), 3.0], 1), (11, [1e30, 2e30, 3e30], 1), (12, [1e-30, 2e-30, 3e-30], 1),
            (13, [-1.0, -2.0, -3.0], 1), (14, [1.0, 2.0], 1)]
    assert set(map(tuple, run(spark, rows).collect())) == plain(rows)
    assert [tuple(r) for r in run(spark, [(None, v, 1)]).collect()] == [(None, 0, None, True)]
    assert run(spark, []).count() == 0


@pytest.fixture(scope="module")
def labelled(spark, sf_dir):
    base = sf_dir.replace("sf0.001", "sf0.01")
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_quality_separates_held_out_labels(labelled):
    docs, labels = labelled
    shown = labels.where("doc_id % 3 <> 0")
    found = quality.quality_scores(docs, shown, docs["source"], F.concat_ws("/", docs["source"], docs["lang"]))
    held = found.join(labels.where("doc_id % 3 = 0").select("doc_id", "quality"), "doc_id").collect()
    good, bad = ([r.kept for r in held if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.97 * len(good)
    assert sum(bad) <= 0.7 * len(bad)


def test_sparse_sites_stay_near_their_prior(spark):
    rows = [(k, "same text here", "big", "big/a") for k in range(300)] + [(1000 + k, "same text here", "fine", "fine/a") for k in range(300)]
    rows += [(5000, "same text here", "tiny", "tiny/a"), (5001, "same text here", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, p string")
    labels = spark.createDataFrame(
        [(k, int(k % 10 > 0)) for k in range(300)] + [(1000 + k, int(k % 10 > 7)) for k in range(300)] + [(5000, 0)], "doc_id long, quality int"
    )
    got = {r.host: r for r in quality.quality_scores(docs, labels, docs["h"], docs["p"]).collect()}
    assert abs(got["big"].host_rate - 0.9) < 0.02 and abs(got["fine"].host_rate - 0.2) < 0.02
    rate = (270 + 60 + 0.5) / 602
    assert 0.1 < got["tiny"].host_rate < rate and abs(got[None].host_rate - rate) < 1e-9
    assert got["big"].score > got["tiny"].score > 0


def test_rates_equal_the_plain_formula(spark):
    sites = [("h1", "p1", 8, 2), ("h1", "p2", 1, 4), ("h2", "p1", 0, 3), ("h3", "p9", 2, 0)]
    rows, labels = [], []
    for h, p, good, bad in sites:
        for k in range(good + bad):
            rows.append((len(rows), "t", h, p))
            labels.append((len(rows) - 1, int(k < good)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, h string, p string")
    table = spark.createDataFrame(labels, "doc_id long, quality int")
    got = {(r.host, r.path): (r.host_rate, r.path_rate) for r in quality.quality_scores(docs, table, docs["h"], docs["p"]).collect()}

    def weight(items):
        n = sum(a for a, _, _ in items)
        unit = sum(a * p * (1 - p) for a, _, p in items) / n
        between = (sum(a * (g / a - p) ** 2 for a, g, p in items) - len(items) * unit) / n
        return 1000.0 if between <= 0 else min(1000.0, max(1.0, unit / between - 1))

    total, good = sum(g + b for *_, g, b in sites), sum(g for _, _, g, _ in sites)
    rate = (good + 0.5) / (total + 1)
    hosts = defaultdict(lambda: [0, 0])
    for h, _, g, b in sites:
        hosts[h][0] += g + b
        hosts[h][1] += g
    w = weight([(n, g, rate) for n, g in hosts.values()])
    host_rate = {h: (g + w * rate) / (n + w) for h, (n, g) in hosts.items()}
    w = weight([(g + b, g, host_rate[h]) for h, _, g, b in sites])
    for h, p, g, b in sites:
        assert got[h, p] == pytest.approx((host_rate[h], (g + w * host_rate[h]) / (g + b + w)))


def test_quality_of_awkward_rows(spark):
    docs = awkward.table(spark)
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (6, 1), (12, 0), (77, 5)], "doc_id long, quality int")
    got = quality.quality_scores(docs, labels, docs["source"], docs["lang"]).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _, _ in awkward.TEXTS)
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.quality_scores(docs, labels.where("false"), docs["source"], docs["lang"]).where("score <> 0.5").count() == 0
    empty = awkward.table(spark, [])
    assert quality.quality_scores(empty, labels, empty["source"], empty["lang"]).count() == 0
