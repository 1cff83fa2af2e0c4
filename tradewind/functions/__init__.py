"""Column expressions: text, number and date repair. Every function returns a ``Column``."""

from tradewind.functions.dates import format_as_text, parse_date, plus_days, rebase_year
from tradewind.functions.numbers import (
    digits_to_int,
    exact_amount,
    magnitude_or_zero,
    thousands_to_double,
    to_double,
)
from tradewind.functions.text import (
    first_token,
    is_blank,
    keep_alphanumeric,
    keep_digits,
    keep_person_name,
    leading_number,
    text_after_number,
)

__all__ = [
    "digits_to_int",
    "exact_amount",
    "first_token",
    "format_as_text",
    "is_blank",
    "keep_alphanumeric",
    "keep_digits",
    "keep_person_name",
    "leading_number",
    "magnitude_or_zero",
    "parse_date",
    "plus_days",
    "rebase_year",
    "text_after_number",
    "thousands_to_double",
    "to_double",
]
