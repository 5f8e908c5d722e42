"""Keyed state of a stream lies in slots of many keys: the classes are those of keys on their own."""

import json
import random
import time

from test_streams import DAY1, DAY2, DAY3, SPEC, Folder, kinds
from tidemark.streaming import keyed


def run(folder, now, slots, ttl_ms=None):
    found = []
    rows = keyed.classified(folder.stream(), SPEC, now, ttl_ms, slots)
    with keyed.keyed_state(folder.spark):
        query = keyed.run_batches(rows, folder.checkpoint, lambda b, _: found.extend(b.collect()), "update")
    return found, json.loads(query.lastProgress.json)["stateOperators"][0]["numRowsTotal"]


def test_slots_equal_a_dictionary(spark):
    rnd, model, folder = random.Random(5), {}, Folder(spark)
    for now in (DAY1, DAY2, DAY3):
        pairs = [(str(rnd.randint(0, 150)), str(rnd.randint(0, 2))) for _ in range(200)]
        folder.add(pairs, files=2)
        found, entries = run(folder, now, slots=8)
        want = []
        for k, v in dict(pairs).items():
            kind = "insert" if k not in model else "unchanged" if model[k][0] == v else "update"
            first = now if kind == "insert" else model[k][1]
            model[k] = v, first, model[k][2] if kind == "unchanged" else now
            want.append((k, kind, *model[k][1:], now))
        got = [(r.bill_id, r.change_type, r.first_seen_at, r.last_changed_at, r.last_seen_at) for r in found]
        assert sorted(got) == sorted(want)
        # Entries of state, and with them calls of Python, are bounded by slots, not by keys.
        assert entries <= 8


def test_keys_of_a_slot_are_forgotten_one_by_one(spark):
    folder = Folder(spark)
    folder.add([("1", "1"), ("2", "1")])
    run(folder, DAY1, 1, 60_000)
    folder.add([("2", "1")])
    assert kinds(run(folder, DAY2, 1, 60_000)[0]) == [("2", "unchanged")]
    folder = Folder(spark)
    folder.add([("1", "1"), ("2", "1")])
    run(folder, DAY1, 1, 8000)
    time.sleep(5)
    folder.add([("2", "1")])
    run(folder, DAY2, 1, 8000)
    time.sleep(5)
    folder.add([("1", "1")])
    assert kinds(run(folder, DAY3, 1, 8000)[0]) == [("1", "insert")]
