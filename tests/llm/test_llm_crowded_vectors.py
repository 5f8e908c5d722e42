"""Links in a label whose vectors crowd about a topic, against brute force."""

import numpy as np

from tidemark.llm import embedding_dedup
from test_llm_vectors import run


def crowd(n, width, seed, near):
    """Vectors of cosine ``near`` to a common centre, every other one with a partner of cosine 0.94."""
    draw = np.random.default_rng(seed)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    centre = unit(draw.standard_normal(width))
    aside = lambda x: unit((v := draw.standard_normal((n // 2, width))) - (v * x).sum(axis=-1, keepdims=True) * x)
    x = near * centre + np.sqrt(1 - near * near) * aside(centre)
    return draw.permutation(np.concatenate([x, 0.94 * x + np.sqrt(1 - 0.94**2) * aside(x)])).tolist()


def plain(rows, least=0.93):
    x = np.array([v for _, v, _ in rows], np.float32).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    low = np.arange(len(x))
    while True:
        new = np.minimum(low, np.where(near, low[None, :], len(x)).min(axis=1))
        if (new == low).all():
            return {(i, int(near[i].sum()), int(low[i]), bool(low[i] == i)) for i in range(len(x))}
        low = new


def test_no_link_is_lost_in_a_crowded_label(spark):
    rows = [(k, v, 1) for k, v in enumerate(crowd(4000, 64, 5, 0.8))]
    assert set(map(tuple, run(spark, rows).collect())) == plain(rows)


def test_many_passes_over_small_windows(spark):
    """Windows far below the label, so that several passes and borders between tasks decide."""
    settings = dict(window=64, part=4)
    assert embedding_dedup.Settings(**settings).passes(3000, 0.36) > 20
    rows = [(k, v, 1 + (k % 10 == 0)) for k, v in enumerate(crowd(3000, 64, 6, 0.8))]
    got = {r.vec_id: r for r in run(spark, rows, **settings).collect()}
    want = {}
    for label in (1, 2):
        some = [r for r in rows if r[2] == label]
        want |= {some[i][0]: (n, some[low][0]) for i, n, low, _ in plain(some)}
    linked = [i for i, (n, _) in want.items() if n]
    assert sum(got[i].n_links == want[i][0] for i in linked) >= 0.995 * len(linked) > 1000
    assert all(got[i].n_links <= n for i, (n, _) in want.items())


def test_pairs_meet_in_a_window_as_often_as_the_passes_promise():
    """Pairs at the very threshold against the model that sets the passes."""
    settings, width, n = embedding_dedup.Settings(recall=0.99, window=64), 64, 4000
    x = np.array(crowd(2 * n, width, 6, 0.8))[:n]
    draw = np.random.default_rng(8)
    aside = draw.standard_normal((200, width))
    aside -= (aside * x[:200]).sum(axis=1, keepdims=True) * x[:200]
    y = settings.cosine * x[:200] + np.sqrt(1 - settings.cosine**2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    whole = np.concatenate([x, y])
    mean = whole.mean(axis=0)
    met = np.zeros(200, bool)
    for turn in range(settings.passes(len(whole), 1 - float(mean @ mean))):
        bits = (whole - mean) @ np.random.default_rng([1, turn]).standard_normal((width, embedding_dedup.BITS)) > 0
        place = np.empty(len(whole), int)
        place[np.lexsort(bits.T[::-1])] = np.arange(len(whole))
        met |= np.abs(place[:200] - place[n:]) <= settings.window
    assert met.mean() >= settings.recall - 0.01
