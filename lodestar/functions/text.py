"""Text functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words a reader takes in a minute.
READING_SPEED = 225


def word_list(text: Column) -> Column:
    """White-space words, white space in the Unicode sense with the four separators from 0x1c on."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)[\s\x1c-\x1f]+"), lambda x: x != "")


def word_count(text: Column) -> Column:
    return F.size(word_list(text)).cast("long")


def slugify(text: Column) -> Column:
    """Lower case, other than a-z and 0-9 as single hyphens, none at the ends; null if nothing stays."""
    dashed = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-")
    return F.nullif(F.btrim(dashed, F.lit("-")), F.lit(""))


def content_hash(text: Column) -> Column:
    """SHA-256 in hex of the UTF-8 bytes; null for no text."""
    return F.when(text != "", F.sha2(text, 256))


def reading_minutes(words: Column) -> Column:
    return F.ceil(words / F.lit(READING_SPEED)).cast("int")


def half_even(total: Column, n: Column) -> Column:
    """The rounded mean, halves to the even neighbour; 0 for none."""
    return F.when(n > 0, F.bround(total.cast("double") / n, 0).cast("int")).otherwise(0)


# The patterns of phone numbers and dates, and the months' letters.
PHONE = r"\(\d{3}\)\s*\d{3}[- ]?\d{4}"
LONG_DATE = r"(?i)\b((?:Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Sept|Oct|Nov|Dec)[a-z]*\.?\s+\d{1,2},\s+20\d{2})"
ISO_DATE = r"20\d{2}-\d{2}-\d{2}"
_MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec"


def phone(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, PHONE, 0), F.lit(""))


def published_date(text: Column) -> Column:
    """ISO date of the first "Mon d, 20yy" with the month's three letters and a day that exists, else the first 20yy-mm-dd as it stands."""
    named = F.regexp_extract(text, LONG_DATE, 1)
    month = F.lower(F.regexp_extract(named, r"^([A-Za-z]{3})\s+(\d{1,2}),\s+(\d{4})$", 1))
    day = F.regexp_extract(named, r"^([A-Za-z]{3})\s+(\d{1,2}),\s+(\d{4})$", 2)
    year = F.regexp_extract(named, r"^([A-Za-z]{3})\s+(\d{1,2}),\s+(\d{4})$", 3)
    number = F.lpad(((F.instr(F.lit(_MONTHS), month) + 3) / 4).cast("int").cast("string"), 2, "0")
    valid = F.when(month != "", F.concat_ws("-", year, number, F.lpad(day, 2, "0")).try_cast("date").cast("string"))
    return F.coalesce(valid, F.nullif(F.regexp_extract(text, ISO_DATE, 0), F.lit("")))


def parse_timestamp(text: Column) -> Column:
    """ISO timestamps with or without fraction and offset; date-only and malformed strings give null, naive ones are UTC."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}T"), text.try_cast("timestamp"))


def retry_after(header: Column, now: Column) -> Column:
    """Seconds to wait by a Retry-After header: a number of seconds, or an HTTP date after ``now``; null for anything else."""
    date = F.try_to_timestamp(F.regexp_extract(header, "^[A-Za-z]{3}, (.*) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    until = (F.unix_micros(date) - F.unix_micros(now)) / 1e6
    return F.when(header.rlike(r"^\d+$"), header.try_cast("double")).when(until > 0, until)
