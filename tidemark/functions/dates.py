"""Dates and timestamps in mixed text and binary forms, as native column expressions.

The expressions rewrite the text step by step and refer to each step once or twice, so
they stay small even where the optimizer copies them into a pushed-down filter.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F, types as T

from tidemark.functions.text import WHITESPACE, as_text, strip

# Accepted forms of a date. Day first wins over month first; a dot only
# separates day-first dates; two-digit years below 69 are 20xx, the rest 19xx.
DATE_PATTERN = r"\d{1,2}[/.-]\d{1,2}[/.-]\d{2,4}|(?!0000)\d{4}-\d{1,2}-\d{1,2}"
CENTURIES = {"20": r"[0-5]\d|6[0-8]", "19": r"69|[7-9]\d"}
# Years, months and days of a binary timestamp.
BINARY_RANGES = ((1900, 2100), (1, 12), (1, 31))

TEMPORAL = (T.DateType, T.TimestampType, T.TimestampNTZType)

_BLANK = "[" + WHITESPACE + "]"
_NOT_BLANK = "[^" + WHITESPACE + "]"
_CLOCK = r"(?:[01]?\d|2[0-3]):[0-5]?\d:[0-5]?\d"
_SLASH_OR_ISO = r"\d{1,2}/\d{1,2}/(?:\d{4}|\d{2})|\d{4}-\d{1,2}-\d{1,2}"
_DASH = r"\d{1,2}-\d{1,2}-(?:\d{4}|\d{2})"
# A one-digit day padded with a blank is accepted in ISO and in month-first forms.
_PADDED_ISO = rf"^(\d{{4}}-\d{{1,2}}-) ([1-9](?:{_BLANK}+{_CLOCK})?)$"
_PADDED_MONTH_FIRST = rf"^(1[0-2]|0?[1-9])/ ([1-9])(/(?:\d{{4}}|\d{{2}}){_BLANK}+{_CLOCK})$"


def clock(at: datetime) -> Column:
    """A point in time as a literal; a datetime without a zone is UTC."""
    at = at.astimezone(timezone.utc) if at.tzinfo else at
    return F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f") + "Z").cast("timestamp")


def _plain_iso(text: Column) -> Column:
    """``yyyy-MM-dd`` with or without a clock, the form that needs no rewriting."""
    plain = F.regexp_extract(text, rf"^(?!0000)\d{{4}}-\d\d-\d\d(?: {_CLOCK})?$", 0)
    return F.concat(plain, F.lit("Z")).try_cast("timestamp")


def _found_date(text: Column) -> Column:
    """The first date in the first word, its year written with four digits."""
    found = F.regexp_extract(text, rf"^{_NOT_BLANK}*?({DATE_PATTERN})", 1)
    for century, years in CENTURIES.items():
        short = rf"^(?<head>\d{{1,2}}([/.-])\d{{1,2}}\2)(?<year>{years})$"
        found = F.regexp_replace(found, short, "${head}" + century + "${year}")
    return found


def _day_first(found: Column) -> Column:
    """ISO and day-first dates. A text in any other form, or no real date, gives NULL."""
    turned = F.regexp_replace(found, r"^(\d{1,2})([/.-])(\d{1,2})\2(?!0000)(\d{4})$", "$4-$3-$1")
    return turned.try_cast("date")


def _month_first(found: Column) -> Column:
    turned = F.regexp_replace(found, r"^(\d{1,2})([/-])(\d{1,2})\2(?!0000)(\d{4})$", "$4-$1-$3")
    return turned.try_cast("date")


def parse_date(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """The date in the first word of the text; NULL where there is none."""
    if isinstance(dtype, TEMPORAL):
        return c.cast("date")
    found = _found_date(strip(as_text(c, dtype)))
    return F.coalesce(_day_first(found), _month_first(found))


def parse_timestamp(c: Column, dtype: T.DataType = T.StringType()) -> Column:
    """A UTC timestamp read from day-first, month-first and ISO texts.

    The clock counts where date and clock together fill the text; any other text that
    starts with a date gives that date at midnight.
    """
    if isinstance(dtype, TEMPORAL):
        return c.cast("timestamp")
    stripped = strip(as_text(c, dtype))
    text = F.regexp_replace(stripped, _PADDED_ISO, "$1$2")
    text = F.regexp_replace(text, _PADDED_MONTH_FIRST, "$2/$1$3")
    found = _found_date(text)

    def at_clock(date: Column, shapes: str) -> Column:
        time = F.regexp_extract(text, rf"^(?:{shapes}){_BLANK}+({_CLOCK})$", 1)
        seconds = F.unix_seconds(F.concat(F.lit("1970-01-01 "), time, F.lit("Z")).try_cast("timestamp"))
        midnight = F.unix_date(date).cast("long") * 86400
        return F.timestamp_seconds(midnight + F.coalesce(seconds, F.lit(0)))

    # A dashed date with a clock is only read day first; month first leaves it at midnight.
    return F.coalesce(
        _plain_iso(stripped),
        at_clock(_day_first(found), f"{_SLASH_OR_ISO}|{_DASH}"),
        at_clock(_month_first(found), _SLASH_OR_ISO),
    )


def date_of_typed(c: Column) -> Column:
    """What ``parse_timestamp`` reads from the printed text of a typed timestamp: whole
    seconds are kept, a fraction leaves the date."""
    ts = c.cast("timestamp")
    whole = F.when(ts == F.date_trunc("second", ts), ts).otherwise(F.date_trunc("day", ts))
    return F.when(F.year(ts).between(1, 9999), whole)


def _literal_to_hex(text: Column) -> Column:
    """Hex of a byte-literal text such as ``b'\\xe6\\x07\\n'``; NULL if it is not one."""
    body = F.regexp_extract(text, r"""(?s)^b(['"])(.*)\1$""", 2)
    token = r"\\x[0-9a-fA-F]{2}|\\[0-7]{1,3}|\\[^x0-7]|[^\\]"
    tokens = F.regexp_extract_all(body, F.lit(f"({token})"), F.lit(1))

    def to_hex(t: Column) -> Column:
        octal = F.conv(F.substr(t, F.lit(2)), 8, 16)
        return (
            F.when(F.length(t) == 1, F.when(F.ascii(t) < 128, F.hex(t)))
            .when(t.startswith("\\x"), F.substr(t, F.lit(3)))
            .when(t == "\\n", "0A")
            .when(t == "\\r", "0D")
            .when(t == "\\t", "09")
            .when(t == "\\a", "07")
            .when(t == "\\b", "08")
            .when(t == "\\f", "0C")
            .when(t == "\\v", "0B")
            .when(t.rlike(r"^\\[0-7]"), F.lpad(octal, 2, "0"))
            .otherwise(F.hex(F.substr(t, F.lit(2))))
        )

    whole = F.length(F.array_join(tokens, "")) == F.length(body)
    return F.when(whole, F.array_join(F.transform(tokens, to_hex), ""))


def _decode_hex(digits: Column) -> Column:
    """Six little-endian int16 and a uint32 in hex, as timestamp text."""
    swapped = F.regexp_replace(digits, "(..)(..)", "$2$1")
    fields = [
        F.pmod(F.conv(F.substring(swapped, i, 4), 16, 10).cast("int") + 32768, F.lit(65536)) - 32768
        for i in range(1, 25, 4)
    ]
    shown = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", *fields)
    in_range = F.length(digits) == 32
    for field, (low, high) in zip(fields, BINARY_RANGES):
        in_range &= field.between(low, high)
    return F.when(in_range, shown)


def decode_binary_timestamp(c: Column, dtype: T.DataType = T.BinaryType()) -> Column:
    """Text of a 16-byte timestamp: six little-endian int16 and a uint32 fraction.

    Takes bytes, byte-literal text, or ``\\x`` hex text. NULL for any other value and for
    dates out of range; the clock fields are printed as they are.
    """
    if isinstance(dtype, T.BinaryType):
        return _decode_hex(F.hex(c))
    if not isinstance(dtype, T.StringType):
        return F.lit(None).cast("string")
    text = strip(c)
    hex_text = F.nullif(
        F.regexp_extract(text, r"^\\x\s*((?:[0-9a-fA-F]{2}\s*)*)$", 1), F.lit("")
    )
    digits = F.when(text.startswith("\\x"), F.regexp_replace(hex_text, r"\s", "")).otherwise(
        _literal_to_hex(text)
    )
    # The one-element array names the digits, so that their expression is not repeated.
    decoded = F.get(F.transform(F.array(digits), _decode_hex), 0)
    return F.when(text.rlike(r"""^(?:b['"]|\\x)"""), decoded)
