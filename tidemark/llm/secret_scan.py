"""Secret scan in DataFrame functions: known shapes, and tokens that pass a battery of randomness tests.

The battery takes every longer token of digits and letters, infers its alphabet, and tests the symbols for uniformity
(chi-squared, over equal bins and over classes of characters), for runs about the middle of the alphabet and for serial correlation. A token counts as written by
people when randomness is rejected; within each stratum of alphabet and length the rejections are chosen by
Benjamini-Hochberg, so that at most a share ``q`` of them are secrets. All other tokens are flagged.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.llm.common import documents, stage

# The shapes that are always reported.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
ACCESS = "AKIA[A-Z0-9]{12,}"  # the first AKIA of a run is the longest, so a failing match can't hide another
HEX = "[0-9a-f]{32,}"
KINDS = ("assign", "access", "hex", "random")
TOKEN = "[A-Za-z0-9+/_-]{20,}"
# Alphabets from narrow to wide, each in the order of its code.
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("upper hex", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("lower 36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("upper 36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
STEPS = 8  # steps of a power of two in which p-values are counted
DEEPEST = 400


@dataclass(frozen=True)
class Settings:
    min_bits: float = 90.0  # length times bits a symbol below which the tests tell too little
    q: float = 0.01  # share of secrets among the tokens cleared, at most
    per_bin: int = 5  # expected symbols in a bin of the chi-squared test


def spans(text: Column, pattern: str) -> Column:
    """Array of (start, end, value) of the matches, in code points; value is the last group or the whole match."""
    between = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if pattern == ASSIGN else found
    joined = F.arrays_zip(between.alias("gap"), found.alias("match"), value.alias("value"))
    joined = F.slice(joined, F.lit(1), F.size(found))
    empty = F.array().cast("array<struct<start:int,end:int,value:string>>")

    def step(so_far: Column, x: Column) -> Column:
        start = so_far["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["match"])
        one = F.struct(start.alias("start"), end.alias("end"), x["value"].alias("value"))
        return F.struct(end.alias("at"), F.array_append(so_far["out"], one).alias("out"))

    walked = F.aggregate(joined, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda s: s["out"])
    return F.when(F.size(found) == 0, empty).otherwise(walked)


def upper_tail(z: Column) -> Column:
    """P(N > z) of the standard normal for z >= 0, by the usual five-term polynomial (error below 1e-7)."""
    t = 1 / (1 + 0.2316419 * z)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi) * series


def two_sided(z: Column) -> Column:
    return 2 * upper_tail(F.abs(z))


def chi_tail(chi: Column, df: Column) -> Column:
    """Upper tail of chi-squared through its cube root (Wilson, Hilferty)."""
    z = (F.pow(chi / df, F.lit(1 / 3)) - 1 + 2 / (9 * df)) / F.sqrt(2 / (9 * df))
    return F.when(z >= 0, upper_tail(z)).otherwise(1 - upper_tail(-z))


def p_uniform(codes: Column, n: Column, size: Column, per_bin: int) -> Column:
    """Chi-squared test of the symbols over equal bins of the alphabet."""
    bins = F.greatest(F.lit(2), F.least(size, F.floor(n / per_bin).cast("int")))
    expected = n / bins
    counts = F.transform(
        F.sequence(F.lit(0), bins - 1), lambda b: F.size(F.filter(codes, lambda x: F.floor(x * bins / size) == b))
    )
    chi = F.aggregate(counts, F.lit(0.0), lambda s, c: s + (c - expected) * (c - expected) / expected)
    return chi_tail(chi, bins - 1)


def p_classes(token: Column, alphabet: Column, n: Column, size: Column) -> Column:
    """Chi-squared test of digits, small letters, capitals and marks, each as often as the alphabet has them."""
    chi, classes = F.lit(0.0), F.lit(0)
    for others in ("[^0-9]", "[^a-z]", "[^A-Z]", "[0-9A-Za-z]"):
        share = F.char_length(F.regexp_replace(alphabet, others, "")) / size
        seen, expected = F.char_length(F.regexp_replace(token, others, "")), n * share
        chi += F.when(share > 0, (seen - expected) * (seen - expected) / expected).otherwise(0.0)
        classes += (share > 0).cast("int")
    return F.when(classes < 2, F.lit(1.0)).otherwise(chi_tail(chi, classes - 1))


def p_runs(codes: Column, n: Column, size: Column) -> Column:
    """Runs test about the middle of the alphabet; 0 if all symbols lie on one side."""
    high = F.transform(codes, lambda x: (x >= size / 2).cast("int"))
    ones = F.aggregate(high, F.lit(0), lambda s, x: s + x)
    changes = F.aggregate(
        F.zip_with(F.slice(high, F.lit(2), n - 1), F.slice(high, F.lit(1), n - 1), lambda a, b: F.abs(a - b)),
        F.lit(0), lambda s, x: s + x,
    )
    mean = 2.0 * ones * (n - ones) / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    return F.when((ones == 0) | (ones == n) | (variance <= 0), F.lit(0.0)).otherwise(two_sided((changes + 1 - mean) / F.sqrt(variance)))


def p_serial(codes: Column, n: Column, mean: Column) -> Column:
    """Correlation of neighbours; 0 if all symbols are the same."""
    spread = F.aggregate(codes, F.lit(0.0), lambda s, x: s + (x - mean) * (x - mean))
    beside = F.zip_with(F.slice(codes, F.lit(2), n - 1), F.slice(codes, F.lit(1), n - 1), lambda a, b: (a - mean) * (b - mean))
    r = F.aggregate(beside, F.lit(0.0), lambda s, x: s + x) / spread
    return F.when(spread == 0, F.lit(0.0)).otherwise(two_sided((r * n + 1) / F.sqrt(n)))


def by_alphabet(token: Column, of) -> Column:
    """of(position, letters) for the first alphabet that has all symbols of the token; null if none has."""
    out = F
    for k, (_, letters) in enumerate(ALPHABETS):
        out = out.when(token.rlike("^[" + letters.replace("-", "\\-") + "]+$"), of(k, letters))
    return out


def battery(tokens: DataFrame, settings: Settings) -> DataFrame:
    """Adds stratum and depth (steps of the p-value's power of two) to rows with a token; drops what is no candidate.

    Each step is a projection of its own, so that nothing is computed again inside a lambda.
    """
    n, size, codes = F.col("n"), F.col("size"), F.col("codes")
    token = F.col("token")
    out = tokens.where(token.rlike("[0-9]") & token.rlike("[A-Za-z]"))
    out = out.withColumns({"n": F.char_length(token), "alphabet": by_alphabet(token, lambda k, a: F.lit(a)),
                           "kind": by_alphabet(token, lambda k, a: F.lit(k))})
    out = out.withColumn("size", F.char_length("alphabet")).where(n * F.log2(size) >= settings.min_bits)
    out = out.withColumn("codes", F.transform(F.split(token, "", -1), lambda c: F.instr(F.col("alphabet"), c) - 1))
    out = out.withColumn("codes", F.slice(codes, F.lit(1), n))
    out = out.withColumn("mean", F.aggregate(codes, F.lit(0.0), lambda s, x: s + x) / n)
    p = F.least(
        p_uniform(codes, n, size, settings.per_bin), p_classes(token, F.col("alphabet"), n, size),
        p_runs(codes, n, size), p_serial(codes, n, F.col("mean")),
    )
    out = out.withColumn("p", F.least(F.lit(1.0), 4 * p))
    depth = F.when(F.col("p") <= 0, F.lit(DEEPEST)).otherwise(F.least(F.lit(DEEPEST), F.floor(-F.log2("p") * STEPS).cast("int")))
    return out.withColumns({"stratum": F.col("kind") * 64 + F.floor(F.log2(n)).cast("int"), "depth": depth}).drop(
        "token", "n", "alphabet", "kind", "size", "codes", "mean", "p"
    )


def cleared_from(tested: DataFrame, q: float) -> dict[int, int]:
    """Per stratum the depth from which on randomness is rejected (Benjamini-Hochberg at ``q``).

    Counts per stratum and depth are all that reaches the driver: at most 512 strata of 401 depths, whatever the input.
    """
    counts: dict[int, dict[int, int]] = {}
    for r in tested.groupBy("stratum", "depth").count().collect():
        counts.setdefault(r.stratum, {})[r.depth] = r["count"]
    out = {}
    for stratum, by_depth in counts.items():
        total, below = sum(by_depth.values()), 0
        for depth in sorted(by_depth, reverse=True):
            below += by_depth[depth]
            if 2.0 ** (-depth / STEPS) * total <= q * below:
                out[stratum] = depth
    return out


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ",")


def scan(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text_hash, base (array of kind, start, end), found (base and random), n_assign, n_access, n_hex.

    text_hash is xxhash64 of the text, to tell rows with one id apart; kind is the position in KINDS; start and end are code points, end exclusive; arrays are ordered by start, then kind.
    Random spans that touch a base span are left out. Null and empty texts have no spans; null ids stay null; repeated
    rows are each scanned; an empty table gives no rows; further columns are not read. Texts are read once, in one
    narrow stage; after that only spans and tokens move. Within a text the spans are walked in order, so one text with
    very many matches costs their number squared.
    """
    text = F.col("text")
    rows = documents(docs, id_col, text_col)
    raw = rows.select(
        "doc_id", F.xxhash64(text).alias("text_hash"), F.filter(spans(text, ASSIGN), lambda s: F.char_length(s["value"]) >= 8).alias("assign"),
        spans(text, ACCESS).alias("access"), spans(text, HEX).alias("hex"), spans(text, TOKEN).alias("tokens"),
    )

    def tagged(name: str) -> Column:
        kind = F.lit(KINDS.index(name))
        return F.transform(name, lambda s: F.struct(s["start"].alias("start"), kind.alias("kind"), s["end"].alias("end")))

    base = F.array_sort(F.concat(tagged("assign"), tagged("access"), tagged("hex")))
    found = stage(raw.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "text_hash", base.alias("base"), "tokens",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]],
    ), "spans")
    free = F.filter("tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])))
    tokens = found.select("row", F.explode(free).alias("t")).select("row", "t.start", "t.end", F.col("t.value").alias("token"))
    tested = stage(battery(tokens, settings), "tested")
    cleared = F.lit(DEEPEST + 1)
    for stratum, depth in sorted(cleared_from(tested, settings.q).items()):
        cleared = F.when(F.col("stratum") == stratum, F.lit(depth)).otherwise(cleared)
    flagged = tested.where(F.col("depth") < cleared).groupBy("row").agg(
        F.collect_list(F.struct("start", F.lit(KINDS.index("random")).alias("kind"), "end")).alias("random")
    )
    every = F.when(F.col("random").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "random")))
    return found.drop("tokens").join(flagged, "row", "left").select(
        "doc_id", "text_hash", "base", every.alias("found"), "n_assign", "n_access", "n_hex"
    )


def secret_digests(docs: DataFrame, settings: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of each row; see scan for the cases."""
    return scan(docs, settings, id_col, text_col).select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )
