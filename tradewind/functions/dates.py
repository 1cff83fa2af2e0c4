"""Date repair. Two-digit years are 2000-2099, as Spark reads ``yy``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.text import _col

# Parsed year -> year to write.
REBASED_YEARS = {2095: 2021, 2096: 2022, 2097: 2023, 2098: 2024}


def parse_date(c: Column | str, pattern: str) -> Column:
    """Text to date by ``pattern``; NULL when it does not fit. ``MM/dd/yy`` wants two digits for each part."""
    return F.try_to_date(_col(c), pattern)


def rebase_year(c: Column | str, years: Mapping[int, int] = REBASED_YEARS, unmapped: str = "drop") -> Column:
    """A date as text with its year replaced through ``years``.

    A year outside the map is left out (``07-04``) with ``unmapped="drop"``, and written as parsed
    (``2001-07-04``) with ``unmapped="keep"``. The text need not be a valid date: 2096-02-29 becomes 2022-02-29.
    """
    if unmapped not in ("drop", "keep"):
        raise ValueError(f"unmapped must be 'drop' or 'keep', not {unmapped!r}")
    date = _col(c)
    text = format_as_text(date)
    prefix = F.lit("") if unmapped == "drop" else F.substring(text, 1, 5)
    if years:
        entries = [F.lit(part) for old, new in years.items() for part in (old, f"{new}-")]
        prefix = F.coalesce(F.create_map(*entries)[F.year(date)], prefix)
    return F.concat(prefix, F.substring(text, 6, 5))


def plus_days(c: Column | str, days: int) -> Column:
    """A date in text form moved by ``days``, as text; NULL when the text is not a full, valid date."""
    return F.date_add(_col(c).try_cast("date"), days).cast("string")


def format_as_text(c: Column | str) -> Column:
    """A date as ``yyyy-MM-dd`` text. Unlike ``date_format``, the cast does not pass through the time zone."""
    return _col(c).cast("string")
