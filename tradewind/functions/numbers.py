"""Number repair. Bad input becomes NULL through ``try_cast``, with ANSI mode on or off."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tradewind.functions.text import _col, keep_digits

# Amounts are summed with this many digits, so that a sum does not depend on the order in which partitions arrive.
AMOUNT = "decimal(38,8)"
# Ten billion amounts below it still sum up within AMOUNT.
AMOUNT_LIMIT = 1e20


def _finite(number: Column) -> Column:
    """NaN and infinity are no numbers here: NULL."""
    return F.when(F.abs(number) < float("inf"), number)


def to_double(c: Column | str) -> Column:
    """The number in a text; NULL for what is no finite number."""
    return _finite(_col(c).try_cast("double"))


def digits_to_int(c: Column | str) -> Column:
    """``'39 units'`` is 39 and ``'-5'`` is 5; a text without digits is NULL."""
    return keep_digits(c).try_cast("int")


def thousands_to_double(c: Column | str) -> Column:
    """Price text where each lower-case ``k`` stands for ``000``: ``'1k'`` is 1000, ``'1.5k'`` is 1.5."""
    return to_double(F.replace(_col(c), F.lit("k"), F.lit("000")))


def magnitude_or_zero(c: Column | str) -> Column:
    """Absolute value, with 0 for NULL."""
    return F.coalesce(F.abs(_col(c)), F.lit(0.0))


def exact_amount(c: Column | str) -> Column:
    """An amount as a decimal that sums exactly; one that is too large or no number raises, whatever the ANSI mode."""
    amount = _col(c).cast("double")
    fits = amount.isNull() | (F.abs(amount) < AMOUNT_LIMIT)
    complaint = F.concat(F.lit("amount out of range: "), amount.cast("string"))
    return F.when(fits, amount.try_cast(AMOUNT)).otherwise(F.raise_error(complaint).cast(AMOUNT))
