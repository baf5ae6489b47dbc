"""Text to typed values. Every parser yields NULL, never an error, on text it cannot read."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings.
NUMBER_PATTERN = r"^[\s\p{Z}]*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?[\s\p{Z}]*$"
ISO_TIMESTAMP_PATTERN = (
    r"^(?!0000)\d{4}-\d{2}-\d{2}"
    r"([T ]\d{2}(:\d{2}(:\d{2}([.,]\d{1,9})?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
)
ISO_OFFSET_PATTERN = r"\d([+-])(\d{2}):?(\d{2})$"
US_DATE_PATTERN = r"^\d{1,2}/\d{1,2}/\d{4}$"
OUTER_WHITESPACE_PATTERN = r"^[\s\p{Z}]+|[\s\p{Z}]+$"


def strip(text: Column) -> Column:
    """Trim every kind of whitespace; SQL ``trim`` removes spaces only."""
    return F.regexp_replace(text, OUTER_WHITESPACE_PATTERN, "")


def blank_to_null(text: Column) -> Column:
    """NULL for text that is empty once its outer spaces are gone."""
    return F.nullif(F.trim(text), F.lit(""))


def parse_number(text: Column) -> Column:
    """A decimal or scientific number as double. Words, hex, type suffixes, NaN and infinity give NULL."""
    # The cast takes plain outer spaces itself; only the rarer kinds need another pass.
    plain = F.when(text.rlike(r"[^\x21-\x7E]"), strip(text)).otherwise(text)
    return F.when(text.rlike(NUMBER_PATTERN), plain.try_cast("double"))


def parse_iso_timestamp(text: Column) -> Column:
    """An ISO-8601 date or date-time as a naive timestamp; a stated offset is applied, giving UTC."""
    wall = F.when(
        text.rlike(ISO_TIMESTAMP_PATTERN), F.replace(text, F.lit(","), F.lit(".")).try_cast("timestamp_ntz")
    )
    # A date alone also ends in -NN, so an offset only counts after a time part.
    has_offset = (F.length(text) > 10) & text.rlike(ISO_OFFSET_PATTERN)
    sign = F.when(F.regexp_extract(text, ISO_OFFSET_PATTERN, 1) == "-", -1).otherwise(1)
    offset = F.make_dt_interval(
        F.lit(0),
        sign * F.regexp_extract(text, ISO_OFFSET_PATTERN, 2).try_cast("int"),
        sign * F.regexp_extract(text, ISO_OFFSET_PATTERN, 3).try_cast("int"),
    )
    return F.when(has_offset, wall - offset).otherwise(wall)


def parse_us_date(text: Column) -> Column:
    """Month/day/year with one- or two-digit parts; anything else is NULL."""
    trimmed = strip(text)
    return F.when(trimmed.rlike(US_DATE_PATTERN), F.try_to_date(trimmed, "M/d/yyyy"))
