"""Date parsing: known moments printed in known forms come back, and hand-worked cases of other texts."""

import random
import struct
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tidemark.functions import decode_binary_timestamp, parse_date, parse_timestamp

# The forms a date may have.
DAY_FIRST = ["%d/%m/%Y", "%d/%m/%y", "%d-%m-%Y", "%d-%m-%y", "%d.%m.%Y", "%d.%m.%y"]
MONTH_FIRST = ["%m/%d/%Y", "%m/%d/%y", "%m-%d-%Y", "%m-%d-%y"]
ISO = ["%Y-%m-%d"]
# The forms that a clock may follow.
CLOCKED = ["%d/%m/%y", "%d/%m/%Y", "%Y-%m-%d", "%d-%m-%y", "%d-%m-%Y", "%m/%d/%y", "%m/%d/%Y"]


def moments(n, seed=11):
    """Moments that every form can print: two-digit years stand for 1969 to 2068."""
    rnd = random.Random(seed)
    start = datetime(1969, 1, 1)
    return [start + timedelta(days=rnd.randrange(36_500), seconds=rnd.randrange(86_400)) for _ in range(n)]


def parsed(spark, texts):
    df = spark.createDataFrame([(n, t) for n, t in enumerate(texts)], "n int, t string")
    shown = F.date_format(parse_timestamp(F.col("t")), "yyyy-MM-dd HH:mm:ss")
    return [(r.d, r.ts) for r in df.select("n", parse_date(F.col("t")).alias("d"), shown.alias("ts")).orderBy("n").collect()]


def midnight(day):
    return day.strftime("%Y-%m-%d 00:00:00")


@pytest.mark.parametrize("noise", ["{}", "  {} ", "on{}x"])
def test_dates_come_back_from_every_form(spark, noise):
    cases = [(m, f) for m in moments(60) for f in DAY_FIRST + ISO]
    # Month first only where the day cannot be a month.
    cases += [(m, f) for m in moments(120) for f in MONTH_FIRST if m.day > 12]
    got = parsed(spark, [noise.format(m.strftime(f)) for m, f in cases])
    assert got == [(m.date(), midnight(m)) for m, _ in cases]


def test_clocks_come_back(spark):
    cases = [(m, f) for m in moments(80, seed=5) for f in CLOCKED if not f.startswith("%m") or m.day > 12]
    got = parsed(spark, [m.strftime(f + " %H:%M:%S") for m, f in cases])
    assert got == [(m.date(), m.strftime("%Y-%m-%d %H:%M:%S")) for m, _ in cases]


def test_day_first_wins_where_both_fit(spark):
    texts = ["03/04/2024", "03-04-24", "3/4/2024", "13/04/2024", "04/13/2024", "04-13-24"]
    days = [date(2024, 4, 3), date(2024, 4, 3), date(2024, 4, 3), date(2024, 4, 13), date(2024, 4, 13), date(2024, 4, 13)]
    assert parsed(spark, texts) == [(d, midnight(d)) for d in days]


def test_a_slashed_year_in_front_is_read_from_its_last_digits(spark):
    assert parsed(spark, ["2024/05/06"]) == [(date(2006, 5, 24), "2006-05-24 00:00:00")]


def test_short_years_turn_at_sixty_nine(spark):
    texts = ["01/01/68", "01/01/69", "31.12.00", "15-06-99"]
    days = [date(2068, 1, 1), date(1969, 1, 1), date(2000, 12, 31), date(1999, 6, 15)]
    assert parsed(spark, texts) == [(d, midnight(d)) for d in days]


def test_leap_days(spark):
    assert parsed(spark, ["29/02/2000", "29/02/1900", "29/02/2023", "2024-02-29"]) == [
        (date(2000, 2, 29), "2000-02-29 00:00:00"), (None, None), (None, None), (date(2024, 2, 29), "2024-02-29 00:00:00")
    ]


@pytest.mark.parametrize("text", [
    "", "   ", "none", "31/02/2024", "00/01/2024", "13.13.2024", "2024-13-01", "12", "1/2", "04.13.2024", "0000-01-01",
])
def test_other_texts_are_no_dates(spark, text):
    assert parsed(spark, [text]) == [(None, None)]


def test_a_clock_counts_only_if_it_fills_the_text(spark):
    texts = ["08/05/22 00:00:00", "08/05/22 07:08:09 x", "08/05/22 25:08:09", "08/05/22T07:08:09", "08/05/22\t07:08:09"]
    got = [ts for _, ts in parsed(spark, texts)]
    assert got == ["2022-05-08 00:00:00"] * 4 + ["2022-05-08 07:08:09"]


def test_typed_dates_pass_through(spark):
    df = spark.sql("select timestamp'2024-05-06 07:08:09' t, date'2024-05-06' d")
    row = df.select(parse_timestamp(F.col("t"), T.TimestampType()).alias("a"),
                    parse_date(F.col("t"), T.TimestampType()).alias("b"),
                    parse_timestamp(F.col("d"), T.DateType()).alias("c")).first()
    assert row.a.replace(tzinfo=timezone.utc).isoformat().startswith("2024-05-06T07:08:09")
    assert str(row.b) == "2024-05-06" and str(row.c) == "2024-05-06 00:00:00"


def test_binary_timestamps(spark):
    rnd = random.Random(5)
    cases = []
    for i in range(600):
        fields = [rnd.choice([rnd.randint(1890, 2110), rnd.randint(-9, 9), 2024]),
                  rnd.choice([rnd.randint(0, 13), 9, 10]), rnd.choice([rnd.randint(0, 32), 9, 10, 13]),
                  rnd.randint(-3, 30), rnd.randint(0, 70), rnd.randint(0, 70)]
        raw = struct.pack("<hhhhhhI", *fields, rnd.choice([0, 0, 5, 2**31]))
        if i % 10 == 0:
            raw = raw[:rnd.randint(0, 15)]
        y, m, d, h, mi, s = fields
        ok = len(raw) == 16 and 1900 <= y <= 2100 and 1 <= m <= 12 and 1 <= d <= 31
        cases.append((i, raw, repr(raw), "  " + repr(raw) + " ", "\\x" + raw.hex(), "\\x" + raw.hex(" "),
                      f"{y:04d}-{m:02d}-{d:02d} {h:02d}:{mi:02d}:{s:02d}" if ok else None))
    df = spark.createDataFrame(cases, "i int, b binary, lit string, lit2 string, hx string, hx2 string, want string")
    text = T.StringType()
    got = df.select("i", "want", decode_binary_timestamp(F.col("b")).alias("b"),
                    *[decode_binary_timestamp(F.col(c), text).alias(c) for c in ("lit", "lit2", "hx", "hx2")]).collect()
    for r in got:
        assert [r.b, r.lit, r.lit2, r.hx, r.hx2] == [r.want] * 5, (r.i, r)
    assert sum(r.want is not None for r in got) > 100


def test_other_texts_are_not_binary(spark):
    texts = ["2024-01-01", "b'x", "\\xzz", "\\x" + "00" * 15, "b'\\x'", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(decode_binary_timestamp(F.col("t"), T.StringType())).collect()] == [None] * 7
