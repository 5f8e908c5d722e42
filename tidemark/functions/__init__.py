from tidemark.functions.dates import decode_binary_timestamp, parse_date, parse_timestamp
from tidemark.functions.numbers import parse_amount, parse_flag
from tidemark.functions.text import as_text, clean_text, strip

__all__ = [
    "as_text",
    "clean_text",
    "decode_binary_timestamp",
    "parse_amount",
    "parse_date",
    "parse_flag",
    "parse_timestamp",
    "strip",
]
