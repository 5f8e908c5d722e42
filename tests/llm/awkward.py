"""Rows that operators must take: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, kept string, length int, digest string, row int, "
    "`a.b` int, n int, key string, band long, level int"
)
WORDS = "the quick brown fox jumps over a lazy dog while seven wizards quietly box nine jugs of good old wine"
LONG = " ".join(f"word{k % 997} and{k % 13}" for k in range(12_000))
TEXTS = [
    (1, WORDS, "en"), (2, WORDS.upper(), "en"), (3, None, "en"), (4, "", None), (5, " \n\t ", "fr"), (6, LONG, "en"),
    (7, LONG, "en"), (8, "été à la plage où les enfants jouent avec le sable", "fr"), (8, "été à la plage où les enfants jouent avec le sable", "fr"),
    (None, WORDS, "en"), (None, None, None), (9, "1234 5678 !!", None), (10, "x", "en"), (11, "密码 password = 'abcdEFGH12'\n日本語🎉", "en"),
    (12, "aaaaaaaa" * 300, "en"), (13, "one two", "en"), (14, "one two", "en"), (15, WORDS[:60] + " AKIA" + "Z9" * 9 + " " + "0f" * 20, "en"),
]


def table(spark, rows=None):
    rows = TEXTS if rows is None else rows
    return spark.createDataFrame(
        [(i, t, lang, "src", None if t is None else len(t), "yes", 7, "d", 3, 4, 5, "k", 6, 7) for i, t, lang in rows], SCHEMA
    )
