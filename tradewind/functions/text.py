"""Text repair. NULL stays NULL in every function; text without a match becomes ``''``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that go, and how a package text is written.
NOT_A_DIGIT = "[^0-9]"
NOT_IN_A_NAME = r"[^a-zA-Z\s'-]"
PACKAGE_NUMBER = r"^(\d+)"
PACKAGE_TEXT = r"^\d+\s(.+)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_digits(c: Column | str) -> Column:
    """Phone, fax and stock counts: everything but 0-9 goes. ``'n.a.'`` becomes ``''``, not NULL."""
    return F.regexp_replace(_col(c), NOT_A_DIGIT, "")


def keep_person_name(c: Column | str) -> Column:
    """ASCII letters, white space, apostrophe and hyphen stay. Accented letters are removed, not folded."""
    return F.regexp_replace(_col(c), NOT_IN_A_NAME, "")


def keep_alphanumeric(c: Column | str, also: str = "") -> Column:
    """ASCII letters, digits, white space and the characters of ``also`` stay.

    ``also`` goes into a character class, so escape regex specials in it.
    """
    return F.regexp_replace(_col(c), rf"[^a-zA-Z0-9\s{also}]", "")


def is_blank(c: Column | str) -> Column:
    """NULL or the empty string; white space counts as content."""
    return _col(c).isNull() | (_col(c) == "")


def first_token(c: Column | str) -> Column:
    """Text before the first comma or white space; ``''`` when the text starts with one."""
    return F.split(_col(c), r"[,\s]")[0]


def leading_number(c: Column | str) -> Column:
    """The digits a text starts with, as an int; NULL when it starts with something else."""
    return F.regexp_extract(_col(c), PACKAGE_NUMBER, 1).try_cast("int")


def text_after_number(c: Column | str) -> Column:
    """What follows a leading number and one white space, with every ``'- '`` taken out."""
    rest = F.regexp_extract(_col(c), PACKAGE_TEXT, 1)
    return F.replace(rest, F.lit("- "), F.lit(""))
