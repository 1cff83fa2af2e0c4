"""Date text looked up in a calendar instead of parsed in each row.

A two-digit year leaves 36,525 days, so each text a date is usually written as, and what it is rewritten to, fit in
a small table. Looking a text up costs a fraction of parsing and formatting it. Text the calendar lacks, such as one
with a leading zero, is parsed as before, so results do not depend on the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradewind.functions.dates import REBASED_YEARS, parse_date, rebase_year

PATTERN = "M/d/yy"
DAYS = 36_525  # 2000-01-01 to 2099-12-31

_TEXT = "_calendar_text"
_REBASED = "_calendar_rebased"


def calendar(spark: SparkSession, years: Mapping[int, int], unmapped: str) -> DataFrame:
    """Every date with a two-digit year: as written and as re-based. One task makes it; its size is fixed.

    The text is put together from the date's parts, not formatted, so that no time zone can make two days equal.
    """
    day = F.date_add(F.lit("2000-01-01").cast("date"), F.col("id").cast("int"))
    year = F.lpad((F.year(day) % 100).cast("string"), 2, "0")
    written = F.concat_ws("/", F.month(day).cast("string"), F.dayofmonth(day).cast("string"), year)
    return spark.range(0, DAYS, 1, 1).select(
        written.alias(_TEXT), rebase_year(day, years, unmapped).alias(_REBASED)
    )


def rebase_dates(
    df: DataFrame, *columns: str, years: Mapping[int, int] = REBASED_YEARS, unmapped: str = "drop"
) -> DataFrame:
    """Rewrite ``M/d/yy`` text columns with ``rebase_year``. The joins share one broadcast calendar."""
    days = F.broadcast(calendar(df.sparkSession, years, unmapped))
    for column in columns:
        parsed = rebase_year(parse_date(column, PATTERN), years, unmapped)
        df = (
            df.join(days, F.col(column) == F.col(_TEXT), "left")
            .withColumn(column, F.coalesce(_REBASED, parsed))
            .drop(_TEXT, _REBASED)
        )
    return df


def unreadable(column: str) -> Column:
    """Whether a date text does not parse, so that it becomes NULL."""
    return F.col(column).isNotNull() & parse_date(column, PATTERN).isNull()


def unmapped_year(column: str, years: Mapping[int, int] = REBASED_YEARS) -> Column:
    """Whether a date's year has no year to write, so that it is left out."""
    return ~F.year(parse_date(column, PATTERN)).isin(*years)
