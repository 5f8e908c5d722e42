"""The legacy export: pushed key bounds, stretches read side by side, polling by key."""

import json
import random

import pytest
from hypothesis import given, settings as how, strategies as st
from pyspark.sql import functions as F

from tidemark.session import configure, new_dir
from tidemark.sources import legacy
from tidemark.streaming import keyed

SCHEMA = "k long, name string, v double, t timestamp_ntz"


def written(folder, parts):
    """Files of JSON lines, each in key order; lines vary in length."""
    folder.mkdir()
    for n, keys in enumerate(parts):
        lines = [json.dumps({"k": k, "name": "x" * (k % 37), "v": k / 4, "t": "2024-01-02T03:04:05"}) for k in sorted(keys)]
        (folder / f"part-{n}.json").write_text("\n".join(lines) + "\n" * (n % 2))
    (folder / "_SUCCESS").write_text("")
    return str(folder)


@pytest.fixture()
def folder(tmp_path):
    keys = random.Random(3).sample(range(-5000, 5000), 2000)
    return written(tmp_path / "export", [keys[:900], keys[900:901], keys[901:]]), sorted(keys)


def rows(spark, path, block=4000):
    return legacy.read_export(configure(spark), path, spark.createDataFrame([], SCHEMA).schema, "k", block=block)


@pytest.mark.parametrize("block", [1, 40, 4000, 1 << 20])
def test_every_line_is_read_once_at_any_block(spark, tmp_path, block):
    path = written(tmp_path / "e", [range(0, 120, 2), range(1, 100, 2)])
    found = rows(spark, path, block)
    assert sorted(r.k for r in found.select("k").collect()) == sorted([*range(0, 120, 2), *range(1, 100, 2)])


def test_key_bounds_are_pushed_and_the_rest_stays(spark, folder):
    path, keys = folder
    found = rows(spark, path).where("k > 1000 AND k <= 1500 AND name <> '' AND v < 350")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Filter" in plan and "name" in plan[plan.index("Filter"):].splitlines()[0] and "(k#" not in plan[plan.index("Filter"):].splitlines()[0]
    assert sorted(r.k for r in found.collect()) == [k for k in keys if 1000 < k <= 1500 and k % 37 and k / 4 < 350]
    for where, fits in (("k = 17", lambda k: k == 17), ("k >= 4990", lambda k: k >= 4990), ("k < -4990", lambda k: k < -4990), ("k > 9999", lambda k: False)):
        assert sorted(r.k for r in rows(spark, path).where(where).collect()) == [k for k in keys if fits(k)]


def test_stretches_outside_the_bounds_are_not_read(spark, folder):
    path, _ = folder
    reader = legacy.LegacyReader(spark.createDataFrame([], SCHEMA).schema, {"path": path, "key": "k", "block": "4000"})
    whole = len(reader.partitions())
    rest = list(reader.pushFilters([legacy.GreaterThan(("k",), 4000), legacy.EqualTo(("name",), "x"), legacy.IsNotNull(("k",))]))
    assert whole > 20 and [f.attribute for f in rest] == [("name",)]
    assert 0 < len(reader.partitions()) < whole / 4
    assert rows(spark, path).rdd.getNumPartitions() == whole


@how(max_examples=200, deadline=None)
@given(st.lists(st.integers(-9, 9), min_size=1), *[st.none() | st.integers(-9, 9)] * 4)
def test_bounds_never_pass_over_a_wanted_key(keys, low, above, high, below):
    bounds = legacy.Bounds(low, above, high, below)
    if any(map(bounds.holds, keys)):
        assert bounds.meets(min(keys), max(keys)) and bounds.meets(min(keys), None)


def test_types_nulls_and_empty_folders(spark, tmp_path):
    folder = tmp_path / "e"
    folder.mkdir()
    assert rows(spark, str(folder)).count() == 0
    (folder / "a.json").write_text('{"k": 1, "extra": 2}\n\n{"k": 2, "name": "é", "v": 1, "t": "2024-02-03T04:05:06.5"}\n{"k": 2}')
    found = sorted(map(tuple, rows(spark, str(folder)).select("k", "name", "v", F.col("t").cast("string")).collect()), key=str)
    assert found == sorted([(1, None, None, None), (2, None, None, None), (2, "é", 1.0, "2024-02-03 04:05:06.5")], key=str)
    with pytest.raises(Exception, match="no key column"):
        legacy.read_export(spark, str(folder), spark.createDataFrame([], SCHEMA).schema, "z").count()


def test_polls_read_disjoint_ranges_and_a_failed_batch_again(spark, tmp_path):
    path = written(tmp_path / "e", [range(0, 50)])
    checkpoint, seen = new_dir(configure(spark), "stream"), []
    schema = spark.createDataFrame([], SCHEMA).schema

    def run(each):
        keyed.run_batches(legacy.read_export(spark, path, schema, "k", stream=True, block=500), checkpoint, each)

    run(lambda b, _: seen.append(sorted(r.k for r in b.collect())))
    lines = [json.dumps({"k": k}) for k in range(50, 80)]
    (tmp_path / "e" / "later.json").write_text("\n".join(lines))

    def fails(batch, _):
        seen.append(sorted(r.k for r in batch.collect()))
        raise OSError("target is away")

    with pytest.raises(Exception, match="target is away"):
        run(fails)
    run(lambda b, _: seen.append(sorted(r.k for r in b.collect())))
    run(lambda b, _: seen.append(sorted(r.k for r in b.collect())))
    assert [x for x in seen if x] == [list(range(50)), list(range(50, 80)), list(range(50, 80))]
