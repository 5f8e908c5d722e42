"""Canonical row text, row checksum and deterministic row id."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import strip
from tidemark.specs import AMOUNT, FLAG

# Fixed value: the DNS namespace of RFC 4122.
_NAMESPACE_HEX = "6ba7b8109dad11d180b400c04fd430c8"
# Above this size a double's shortest decimal text may round differently at 4 places.
_PLAIN_LIMIT = 1e11
# Characters that JSON writes with a backslash.
ESCAPED = r'["\\\x00-\x1f]'


def fixed4(c: Column) -> Column:
    """A double with four decimals. Exact for values that ``needs_exact`` lets through."""
    n = F.floor(F.abs(c) * 10000 + 0.5)  # ten-thousandths
    whole, rest = F.call_function("div", n, F.lit(10000)), F.substring((n % 10000 + 10000).cast("string"), 2, 4)
    plain = F.concat(F.when(c < 0, "-").otherwise(""), whole.cast("string"), F.lit("."), rest)
    tiny = F.when(c.cast("string").startswith("-"), "-0.0000").otherwise("0.0000")
    return F.when(F.abs(c) < 0.00005, tiny).otherwise(plain)


def needs_exact(c: Column) -> Column:
    """Doubles that may be a rounding tie at four decimals, are huge, or not finite."""
    scaled = F.abs(c) * 10000
    off_tie = F.abs(scaled - F.floor(scaled) - 0.5)
    near_tie = off_tie <= scaled * 4e-16 + 1e-3
    return ~(F.abs(c) < _PLAIN_LIMIT) | near_tie


def _exact_canonical(amounts: frozenset[str]):
    """Arrow UDF for the rows whose canonical form has no native expression: Unicode
    normalisation, non-ASCII escapes and exact rounding. All other rows arrive as NULL."""

    def one(row: str) -> str:
        out = {}
        for name, value in json.loads(row).items():
            if value is None:
                out[name] = None
            elif name in amounts:
                out[name] = f"{float(value):.4f}"
            else:
                out[name] = unicodedata.normalize("NFKC", str(value)).strip().upper() or None
        return json.dumps(out, sort_keys=True, separators=(",", ":"))

    @F.pandas_udf("string")
    def exact(rows: pd.Series) -> pd.Series:
        return rows.map(one, na_action="ignore")

    return exact


def with_canonical(
    df: DataFrame,
    columns: Sequence[tuple[str, str]],
    into: str = "canonical",
    exact: bool = True,
    stripped: bool = False,
) -> DataFrame:
    """Add the canonical JSON of ``columns`` (name, kind): keys sorted, text normalised and
    upper-cased, amounts with four decimals, NULLs kept.

    Rows that end up plain ASCII are done by Spark alone. The exact path sees one string
    per row that needs it and NULL for the others, so the input is read only once. Without
    ``exact`` those rows stay NULL, for a caller that treats them on their own. Columns
    that come from the cleaning are already ``stripped`` and never blank.
    """
    ordered = sorted(columns)
    amounts = [n for n, k in ordered if k == AMOUNT]

    def native(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == AMOUNT:
            return fixed4(c)
        if kind == FLAG:
            return c.cast("string")
        return F.upper(c) if stripped else F.nullif(F.upper(strip(c)), F.lit(""))

    keep_nulls = {"ignoreNullFields": "false"}
    # Written out where no text needs an escape, which costs a fraction of what the JSON writer does.
    texts = [F.col(n) for n, k in ordered if k not in (AMOUNT, FLAG)]
    escaped = F.concat_ws("", *texts).rlike(ESCAPED) if texts else F.lit(False)
    values = [
        F.concat(F.lit(f"{',' if i else '{'}{json.dumps(n)}:"), F.coalesce(F.concat(F.lit('"'), native(n, k), F.lit('"')), F.lit("null")))
        for i, (n, k) in enumerate(ordered)
    ]
    whole = F.to_json(F.struct(*[native(n, k).alias(n) for n, k in ordered]), keep_nulls)
    quick = F.when(escaped, whole).otherwise(F.concat(*values, F.lit("}")))
    # Backslash-u: control characters, whose hex case differs; \x7f is escaped in the exact form.
    q = F.col("_quick")
    odd = (F.octet_length(q) != F.length(q)) | q.contains("\\u") | q.contains("\x7f")
    for name in amounts:
        odd = odd | F.coalesce(needs_exact(F.col(name)), F.lit(False))
    staged = df.withColumn("_quick", quick).withColumn("_odd", odd)
    if exact:
        source = F.to_json(F.struct(*[F.col(n) for n, _ in ordered]), keep_nulls)
        fallback = _exact_canonical(frozenset(amounts))(F.when(F.col("_odd"), source))
        staged = staged.withColumn("_exact", fallback)
    else:
        staged = staged.withColumn("_exact", F.lit(None).cast("string"))
    value = F.when(F.col("_odd"), F.col("_exact")).otherwise(F.col("_quick"))
    return staged.withColumn(into, value).drop("_quick", "_odd", "_exact")


def row_id(table: str, key: Column) -> Column:
    """UUID version 5 of ``table:key`` in the DNS namespace, as text."""
    name = F.encode(F.concat(F.lit(f"{table}:"), key), "UTF-8")
    h = F.sha1(F.concat(F.unhex(F.lit(_NAMESPACE_HEX)), name))
    variant = F.translate(F.substring(h, 17, 1), "0123456789abcdef", "89ab89ab89ab89ab")
    return F.concat(
        F.substring(h, 1, 8),
        F.lit("-"),
        F.substring(h, 9, 4),
        F.lit("-5"),
        F.substring(h, 14, 3),
        F.lit("-"),
        variant,
        F.substring(h, 18, 3),
        F.lit("-"),
        F.substring(h, 21, 12),
    )
