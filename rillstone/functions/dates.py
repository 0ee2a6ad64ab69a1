"""Dates as sources write them (D1-D7). Operators take as_of; nothing here reads the clock."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

FORMATS = ("dd/MM/yyyy", "dd-MM-yyyy", "yyyy-MM-dd")
#: Fixed values.
MONTHS = ("gennaio", "febbraio", "marzo", "aprile", "maggio", "giugno", "luglio", "agosto", "settembre", "ottobre", "novembre", "dicembre")


def parse_date(c: Column, formats: tuple[str, ...] = FORMATS) -> Column:
    """By the first format that fits."""
    return F.coalesce(*(F.try_to_date(F.trim(c), f) for f in formats))


def year_in(c: Column, pivot: int = 80) -> Column:
    """A year of four digits, else the two digits that end a date: below pivot of this century."""
    four = F.regexp_extract(c, r"\b((?:19|20)[0-9]{2})\b", 1).try_cast("int")
    two = F.regexp_extract(c, r"\b[0-9]{1,2}[/.\-][0-9]{1,2}[/.\-]([0-9]{2})\b", 1).try_cast("int")
    return F.coalesce(four, F.when(two < pivot, 2000 + two).otherwise(1900 + two))


def italian_date(c: Column) -> Column:
    """D3: 12 marzo 2025; a year alone is its first day."""
    pattern = rf"(?i)\b([0-9]{{1,2}})\s+({'|'.join(MONTHS)})\s+([0-9]{{4}})\b"
    day, month, year = (F.regexp_extract(c, pattern, g) for g in (1, 2, 3))
    number = F.array_position(F.array(*map(F.lit, MONTHS)), F.lower(month))
    named = F.try_to_date(F.concat_ws("-", year, F.lpad(number.cast("string"), 2, "0"), F.lpad(day, 2, "0")), "yyyy-MM-dd")
    alone = F.regexp_extract(F.trim(c), r"\A((?:19|20)[0-9]{2})\z", 1).try_cast("int")
    return F.coalesce(F.when(day != "", named), parse_date(c), F.make_date(alone, F.lit(1), F.lit(1)))


def latest_date_in(c: Column, as_of: Column) -> Column:
    """The latest valid date of a text that isn't after as_of."""
    found = F.transform(F.regexp_extract_all(c, F.lit(r"\b[0-9]{1,2}[/-][0-9]{1,2}[/-][0-9]{4}\b"), F.lit(0)), lambda x: parse_date(F.regexp_replace(x, r"\b([0-9])\b", "0$1")))
    return F.array_max(F.filter(found, lambda d: d <= as_of))


def cutoff(as_of: Column, months: int = 24) -> Column:
    """So many months before; the last day of a shorter month."""
    return F.add_months(as_of, -months)


def last_months(as_of: Column, n: int = 8) -> Column:
    """The first days of the last n months, the newest first."""
    first = F.trunc(as_of, "month")
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.add_months(first, -i))


def monthly_key(c: Column) -> tuple[Column, Column, Column]:
    """A key without its year and month, and these."""
    pattern = r"(?:\A|_)((?:19|20)[0-9]{2})_([0-9]{2})(?=_|\z)"
    year, month = (F.regexp_extract(c, pattern, g).try_cast("int") for g in (1, 2))
    return F.regexp_replace(c, pattern, ""), year, month


def recent(date: Column, cutoff_date: Column, keep_unknown: bool) -> Column:
    """F8: not before the cutoff; what has no date is kept or not."""
    return F.coalesce(date >= cutoff_date, F.lit(keep_unknown))


