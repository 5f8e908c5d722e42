"""Text cleansing as native column expressions."""

from __future__ import annotations

import sys
import unicodedata

from pyspark.sql import Column, functions as F, types as T

# Every character that str.strip() removes, and every decimal digit that \d accepts with
# its value; both come from the Unicode tables rather than a list.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())
_DIGITS = [chr(c) for c in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(c)) == "Nd"]
_FOREIGN_DIGITS = "".join(_DIGITS)
_ASCII_DIGITS = "".join(str(unicodedata.digit(d)) for d in _DIGITS)

# Texts that stand for "no value", in any case.
NULL_TOKENS = ("", "none", "null", "undefined")

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)


def strip(c: Column) -> Column:
    """Remove leading and trailing whitespace, Unicode whitespace included."""
    return F.btrim(c, F.lit(WHITESPACE))


def ascii_digits(c: Column) -> Column:
    """Write digits of other scripts as 0-9."""
    return F.translate(c, _FOREIGN_DIGITS, _ASCII_DIGITS)


def bytes_to_text(c: Column) -> Column:
    """Decode UTF-8 and drop the bytes that are not valid."""
    return F.replace(F.make_valid_utf8(c.cast("string")), F.lit("�"), F.lit(""))


def double_to_text(c: Column) -> Column:
    """Shortest decimal text: plain digits from 1e-4 up to 1e16, exponents beyond."""
    c = c.cast("double")
    size = F.abs(c)
    short = c.cast("string")
    trimmed = F.rtrim(c.try_cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
    mantissa = F.regexp_replace(F.substring_index(short, "E", 1), r"\.0$", "")
    exponent = F.substring_index(short, "E", -1).try_cast("int")
    scientific = F.format_string(
        "%se%s%02d", mantissa, F.when(exponent < 0, "-").otherwise("+"), F.abs(exponent)
    )
    return (
        F.when(c.isNull(), None)
        .when(F.isnan(c), "nan")
        .when(size == float("inf"), F.when(c > 0, "inf").otherwise("-inf"))
        .when((size == 0) | ((size >= 1e-3) & (size < 1e7)), short)
        .when((size >= 1e-4) & (size < 1e16), plain)
        .otherwise(scientific)
    )


def timestamp_to_text(c: Column) -> Column:
    whole = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return F.when(c == F.date_trunc("second", c), whole).otherwise(
        F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


def as_text(c: Column, dtype: T.DataType) -> Column:
    """The text form of a value of any source type."""
    if isinstance(dtype, (T.StringType, T.NullType)):
        return c.cast("string")
    if isinstance(dtype, T.BinaryType):
        return bytes_to_text(c)
    if isinstance(dtype, T.BooleanType):
        return F.when(c, "True").when(~c, "False")
    if isinstance(dtype, FLOATING):
        return double_to_text(c)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return timestamp_to_text(c)
    return c.cast("string")


def clean_text(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """Strip, unwrap byte-literal texts, and turn the null tokens into NULL."""
    if not isinstance(dtype, (T.StringType, T.BinaryType)):
        return as_text(c, dtype)  # printed by Spark, so nothing to clean
    text = strip(as_text(c, dtype))
    printable = F.regexp_replace(text, r"[^\x20-\x7E]", "")
    unwrapped = strip(F.regexp_replace(printable, r"""^b['"](.*)['"]$""", "$1"))
    # The first character spares nearly all texts the pattern; a stripped text has no line end, so tokens compare as wholes.
    literal = (text.startswith("b") | text.startswith("\\")) & text.rlike(r"""^(b['"]|\\x)""")
    value = F.when(literal, unwrapped).otherwise(text)
    return F.when(~F.lower(value).isin(*NULL_TOKENS), value)
