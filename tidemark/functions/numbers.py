"""Amounts and flags as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.text import FLOATING, INTEGRAL, as_text, ascii_digits, clean_text, strip

# The number patterns and the words read as a flag.
AMOUNT_PATTERN = r"(?U)([-+]?\d*\.?\d+)"
INTEGER_PATTERN = r"(?U)([-+]?\d+)"
TRUE_WORDS = ("true", "yes", "y", "-1")
FALSE_WORDS = ("false", "no", "n")


def parse_amount(
    c: Column, dtype: T.DataType = T.StringType(), thousands: str | None = None
) -> Column:
    """The first number in the text as a double, NULL where there is none.

    ``'1,234.50'`` reads as 1.0 unless ``thousands`` names the grouping character.
    Numeric columns keep their value; NaN and infinities become NULL.
    """
    if isinstance(dtype, FLOATING):
        value = c.cast("double")
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    if isinstance(dtype, INTEGRAL + (T.DecimalType,)):
        return c.cast("double")
    text = clean_text(c, dtype)
    if thousands:
        text = F.replace(text, F.lit(thousands), F.lit(""))
    # A text that is a plain number as a whole needs no pattern.
    whole = F.when(F.translate(text, "0123456789.-+", "") == "", text.try_cast("double"))
    return F.coalesce(whole, ascii_digits(F.regexp_extract(text, AMOUNT_PATTERN, 1)).try_cast("double"))


def _literal_of_bytes(c: Column) -> Column:
    """Bytes written as a literal: printable bytes as they are, others escaped."""
    forms = F.array(*[F.lit(repr(bytes([b]))[2:-1]) for b in range(256)])
    pairs = F.regexp_extract_all(F.hex(c), F.lit("(..)"), F.lit(1))
    codes = F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int"))
    return F.array_join(F.transform(codes, lambda n: F.get(forms, n)), "")


def parse_flag(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """0 or 1: words first, else whether the first integer in the text is non-zero."""
    if isinstance(dtype, T.BooleanType):
        return F.coalesce(c.cast("int"), F.lit(0))
    if isinstance(dtype, INTEGRAL):
        return F.coalesce((c != 0).cast("int"), F.lit(0))
    if isinstance(dtype, FLOATING):
        # Printed with an exponent below 1e-4, so the first digit is then not a zero.
        size = F.abs(c.cast("double"))
        counts = (size >= 1) | ((size > 0) & (size < 1e-4))
        return F.when(counts & ~F.isnan(c) & (size != float("inf")), 1).otherwise(0)
    if isinstance(dtype, T.BinaryType):
        text = F.concat(F.lit("b'"), _literal_of_bytes(c))  # quoted, so never a word
    else:
        text = F.lower(strip(as_text(c, dtype)))
    number = ascii_digits(F.regexp_extract(text, INTEGER_PATTERN, 1))
    return (
        F.when(text.isin(*TRUE_WORDS), 1)
        .when(text.isin(*FALSE_WORDS), 0)
        .when(number.rlike("[1-9]"), 1)
        .otherwise(0)
    )
