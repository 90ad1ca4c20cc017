"""Text rules for target files and for printing numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The code points that a Python ``str.strip`` removes.
WHITE_SPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B)]
        + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)


def strip(text: Column) -> Column:
    """Remove white space from both ends (Spark's ``trim`` takes only spaces
    unless told otherwise)."""
    return F.trim(text, F.lit(WHITE_SPACE))


def is_blank(text: Column) -> Column:
    return strip(text) == ""


def has_non_ascii(text: Column) -> Column:
    """Only characters past ASCII take more than one byte."""
    return F.octet_length(text) > F.length(text)


def decode_bytes(content: Column) -> Column:
    """UTF-8 text, or Latin-1 where the bytes are not valid UTF-8."""
    return F.coalesce(
        F.try_validate_utf8(content.cast("string")),
        F.decode(content, "ISO-8859-1"),
    )


def count_text(number: Column) -> Column:
    """A double as PostgreSQL prints it for the whole-number range: 3.0 is '3'."""
    whole = (number == F.floor(number)) & (F.abs(number) < 1e15)
    return F.when(whole, number.cast("bigint").cast("string")).otherwise(number.cast("string"))


def month_prefix(day: Column) -> Column:
    """File-name prefix of the month: data_MM_yyyy."""
    return F.date_format(day, "'data_'MM_yyyy")
