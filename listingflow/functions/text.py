"""Cleaning of price, area, number, date and coordinate texts (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from listingflow.functions.variants import float_text

# Fixed patterns. Java needs (?U) for \s and \d to cover all of Unicode.
PRICE_NOISE = r"(?U)[R$\s.\x1c-\x1f]"
AREA = r"(?U)([\d.,]+)\s*m"
WHOLE_NUMBER = r"(?U)(\d+)"
LATITUDE = r'(?U)latitude["\s:=]+(-?\d+\.?\d*)'
LONGITUDE = r'(?U)longitude["\s:=]+(-?\d+\.?\d*)'

# Fixed formats: ISO date, optionally with a time; then day/month/year. One-digit
# days, months, hours, minutes and seconds are allowed.
ISO_STAMP = (
    r"^\d{4}-\d{1,2}-\d{1,2}"
    r"(?:[Tt]\d{1,2}:\d{1,2}:\d{1,2}(?:\.\d{1,6}[Zz]|[Zz])?)?$"
)
DAY_FIRST = r"^(\d{1,2})/(\d{1,2})/(\d{4})(?:(?U:\s)+(\d{1,2}:\d{1,2}))?$"
# The general ISO form: dashes, colons and any separator character are
# optional as the standard has it; an offset is dropped, wall time is kept.
ISO_EXTENDED = (
    r"^(\d{4}-\d\d-\d\d)(?:.(\d\d)(?::(\d\d)(?::(\d\d(?:[.,]\d{1,6})?)\d*)?)?"
    r"(?:[+-]\d\d(?::?\d\d(?::?\d\d(?:\.\d+)?)?)?)?)?$"
)
ISO_BASIC = (
    r"^(\d{4})(\d\d)(\d\d)(?:[^\d](\d\d)(?:(\d\d)(?:(\d\d(?:[.,]\d{1,6})?)\d*)?)?"
    r"(?:[+-]\d\d(?::?\d\d(?::?\d\d(?:\.\d+)?)?)?)?)?$"
)


def first_match(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of the first match, NULL without a match (not an empty text)."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def clean_price(text: Column) -> Column:
    """`R$ 1.234,50` -> 1234.5; NULL unless a number above zero is left."""
    text = text.cast("string")
    plain = F.replace(F.regexp_replace(text, PRICE_NOISE, ""), F.lit(","), F.lit("."))
    value = float_text(plain)
    # Spark orders NaN above every number; a price must not be NaN.
    return F.when((value > 0) & ~F.isnan(value), value)


def clean_area(text: Column) -> Column:
    """First number in front of an `m`; zero is allowed."""
    found = first_match(text.cast("string"), AREA)
    plain = F.replace(F.replace(found, F.lit(".")), F.lit(","), F.lit("."))
    return float_text(plain)


def clean_int(text: Column) -> Column:
    """First run of digits, without a sign; NULL beyond 64 bits."""
    return first_match(text.cast("string"), WHOLE_NUMBER).try_cast("bigint")


def coordinates(text: Column) -> Column:
    """struct(lat, lng), each the first match of its own."""
    return F.struct(
        first_match(text, LATITUDE).try_cast("double").alias("lat"),
        first_match(text, LONGITUDE).try_cast("double").alias("lng"),
    )


def _iso_clock(text: Column, pattern: str, date: Column, first_group: int) -> Column:
    def part(group: int) -> Column:
        found = F.replace(F.regexp_extract(text, pattern, group), F.lit(","), F.lit("."))
        return F.when(found == "", "00").otherwise(found)

    clock = F.concat_ws(":", *(part(first_group + i) for i in range(3)))
    stamp = F.concat_ws(" ", date, clock)
    return F.when(text.rlike(pattern), stamp.try_cast("timestamp_ntz"))


def parse_date(text: Column) -> Column:
    """A date text in any of the known forms as TIMESTAMP_NTZ, else NULL."""
    trimmed = F.regexp_replace(text, r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$", "")
    iso = F.when(
        trimmed.rlike(ISO_STAMP),
        F.regexp_replace(F.upper(trimmed), "Z$", "").try_cast("timestamp_ntz"),
    )
    day_first = F.when(
        trimmed.rlike(DAY_FIRST),
        F.btrim(F.regexp_replace(trimmed, DAY_FIRST, "$3-$2-$1 $4")).try_cast("timestamp_ntz"),
    )
    # The general form looks at the text as it is, less a UTC mark.
    wall = F.replace(F.replace(text, F.lit("Z"), F.lit("+00:00")), F.lit("+00:00"))
    basic_date = F.concat_ws("-", *(F.regexp_extract(wall, ISO_BASIC, i) for i in (1, 2, 3)))
    return F.coalesce(
        iso,
        day_first,
        _iso_clock(wall, ISO_EXTENDED, F.regexp_extract(wall, ISO_EXTENDED, 1), 2),
        _iso_clock(wall, ISO_BASIC, basic_date, 4),
    )


def iso_text(stamp: Column) -> Column:
    """A timestamp as ISO text; the fraction is shown only when there is one."""
    whole = F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(stamp, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))


def round2(value: Column) -> Column:
    """Two decimals, decided on the exact binary value.

    `round` works on the shortest decimal text of a double and so turns 47.465
    (stored a little lower) into 47.47; `format_number` does not.
    """
    text = F.call_function("format_number", value, F.lit("0.00"))
    return F.coalesce(text.try_cast("double"), value)
