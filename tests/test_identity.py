"""Checksums and row ids against hashlib, json, unicodedata and uuid."""

import hashlib
import json
import random
import unicodedata
import uuid

from pyspark.sql import functions as F

from tidemark.functions.identity import row_id, with_canonical
from tidemark.specs import AMOUNT, FLAG, KEY, TEXT

COLUMNS = [("k", KEY), ("name", TEXT), ("amount", AMOUNT), ("ok", FLAG)]


def canonical(row):
    out = {"k": row[0], "name": row[1], "amount": row[2], "ok": row[3]}
    for n, v in out.items():
        if isinstance(v, float):
            out[n] = f"{v:.4f}"
        elif isinstance(v, str):
            out[n] = unicodedata.normalize("NFKC", v).strip().upper() or None
        elif v is not None:
            out[n] = str(v)
    return json.dumps(out, sort_keys=True, separators=(",", ":"))


def rows(n=3000, seed=4):
    rnd = random.Random(seed)
    plain = "abcXYZ 09'\"\\/<>&\n\t\r"
    wide = plain + "\u00e9\u00df\u0131\u017f\ufb01\u212b\u00b5\uff21\u00a0\u2003\x1b\x7f\x00\u00a8\u1e9b\U0001f600\u0301\u3000\u2026"
    out = []
    for i in range(n):
        pool = plain if i % 2 else wide
        text = "".join(rnd.choice(pool) for _ in range(rnd.randint(0, 8)))
        amount = rnd.choice([
            round(rnd.uniform(-1e6, 1e6), rnd.randint(0, 7)), rnd.randint(-10**6, 10**6) / 32,
            rnd.randint(-10**6, 10**6) / 10**5, rnd.uniform(-1, 1) * 10 ** rnd.randint(-9, 18),
            rnd.choice([0.0, -0.0, 2.00005, 0.03125, -0.00004, 0.00005, 1e15, 5e-324]), None])
        out.append((str(i), rnd.choice([text, text, text, None]), amount, rnd.choice([0, 1, None])))
    return out


def test_canonical_and_checksum_equal_python(spark):
    data = rows()
    df = spark.createDataFrame(data, "k string, name string, amount double, ok int")
    got = with_canonical(df, COLUMNS).select("k", "canonical", F.sha2("canonical", 256).alias("h")).collect()
    want = {r[0]: canonical(r) for r in data}
    for r in got:
        assert r.canonical == want[r.k]
        assert r.h == hashlib.sha256(want[r.k].encode()).hexdigest()


def test_most_plain_rows_stay_native(spark):
    df = spark.createDataFrame([("1", "Ann", 12.34, 1)], "k string, name string, amount double, ok int")
    plan = with_canonical(df, COLUMNS)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_checksum_sees_every_business_column(spark):
    base = ("1", "Ann", 1.0, 1)
    variants = [base, base, ("1", "ann ", 1.0, 1), ("1", "Bob", 1.0, 1), ("1", "Ann", 1.0001, 1), ("1", "Ann", 1.0, 0)]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(variants)],
                               "i int, k string, name string, amount double, ok int")
    h = [r.canonical for r in with_canonical(df, COLUMNS).orderBy("i").collect()]
    assert h[0] == h[1] == h[2] and len(set(h)) == 4


def test_row_id_equals_uuid5(spark):
    keys = [str(i) for i in range(300)] + ["caf\u00e9", "\u6771\u4eac", "a b", ""]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for r in df.select("k", row_id("BILL_MASTER", F.col("k")).alias("id")).collect():
        assert r.id == str(uuid.uuid5(uuid.NAMESPACE_DNS, f"BILL_MASTER:{r.k}"))


def test_rows_without_escapes_skip_the_json_writer_and_equal_it(spark):
    texts = ["plain", 'quo"te', "back\\slash", "tab\there", "line\nend", "bell\x07", "sla/sh", "{a:1}", "", None, "\x1f", "\x7f", "é"]
    rows = spark.createDataFrame([(i, t, 1.5 * i) for i, t in enumerate(texts)], "i int, t string, n double")
    columns = [("t", "text"), ("n", "amount"), ("i", "flag")]
    for exact in (True, False):
        out = with_canonical(rows, columns, exact=exact)
        for r in out.collect():
            text = r.t.strip().upper() or None if r.t else None
            want = json.dumps({"i": str(r.i), "n": f"{r.n:.4f}", "t": text}, sort_keys=True, separators=(",", ":"))
            assert r.canonical == want or (not exact and r.canonical is None), r
    plan = with_canonical(rows.where("t = 'plain'"), columns, exact=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "concat({" in plan.lower()
