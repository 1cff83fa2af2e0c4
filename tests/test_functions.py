"""Column functions on small literal rows, with ANSI mode on, and as properties on random text."""

from __future__ import annotations

import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tradewind import functions as fn


def evaluate(spark, values, expression, kind="string"):
    """The expression on each value, in order."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.out for r in df.select("i", expression("v").alias("out")).orderBy("i").collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_keep_digits(spark):
    assert evaluate(spark, ["(02) 555-1", "n.a.", "", None], fn.keep_digits) == ["025551", "", "", None]


def test_keep_person_name_removes_accents(spark):
    got = evaluate(spark, ["Müller", "O'Neil-Smith 2", "Jo@n", None], fn.keep_person_name)
    assert got == ["Mller", "O'Neil-Smith ", "Jon", None]


def test_keep_alphanumeric(spark):
    values = ["Grains/Cereals", "a, b & c!", None]
    assert evaluate(spark, values, fn.keep_alphanumeric) == ["GrainsCereals", "a b  c", None]
    assert evaluate(spark, values, lambda c: fn.keep_alphanumeric(c, also=",")) == ["GrainsCereals", "a, b  c", None]


def test_first_token_may_be_empty(spark):
    values = ["Cheeses and more", "Produce, dried", ", leading", " leading", "", None]
    assert evaluate(spark, values, fn.first_token) == ["Cheeses", "Produce", "", "", "", None]


def test_is_blank(spark):
    assert evaluate(spark, [None, "", " ", "a"], fn.is_blank) == [True, True, False, False]


def test_package_text(spark):
    values = ["10 boxes x 20 bags", "24 - 12 oz - bottles", "5kg pkg.", "none", "99999999999 x", None]
    assert evaluate(spark, values, fn.leading_number) == [10, 24, 5, None, None, None]
    assert evaluate(spark, values, fn.text_after_number) == [
        "boxes x 20 bags",
        "12 oz bottles",
        "",
        "",
        "x",
        None,
    ]


def test_thousands_suffix(spark):
    values = ["1k", "1.5k", "2K", "n/a", "-3.5", "", None]
    assert evaluate(spark, values, fn.thousands_to_double) == [1000.0, 1.5, None, None, -3.5, None, None]


def test_digits_to_int(spark):
    assert evaluate(spark, ["39 units", "-5", "none", "", None, "39.0", "99999999999"], fn.digits_to_int) == [
        39,
        5,
        None,
        None,
        None,
        390,
        None,
    ]


def test_digits_of_a_double_keep_its_decimal_zero(spark):
    assert evaluate(spark, [39.0], lambda c: fn.digits_to_int(F.col(c).cast("string")), "double") == [390]


def test_magnitude_or_zero(spark):
    assert evaluate(spark, [-2.5, 2.5, None, 0.0], fn.magnitude_or_zero, "double") == [2.5, 2.5, 0.0, 0.0]


def test_to_double_gives_null_for_bad_text(spark):
    assert evaluate(spark, ["1.5", "x", "", None], fn.to_double) == [1.5, None, None, None]


def test_to_double_gives_null_for_nan_and_infinity(spark):
    assert evaluate(spark, ["NaN", "Infinity", "-Infinity", "1e400", "1e8"], fn.to_double) == [None] * 4 + [1e8]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_an_amount_out_of_range_raises_in_both_ansi_modes(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for amount in (1e20, float("nan"), float("inf")):
            with pytest.raises(Exception, match="amount out of range"):
                evaluate(spark, [amount], fn.exact_amount, "double")
        assert [float(x) for x in evaluate(spark, [1e19, 0.00004], fn.exact_amount, "double")] == [1e19, 0.00004]
        assert evaluate(spark, [None], fn.exact_amount, "double") == [None]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def rebased(c, **options):
    return fn.rebase_year(fn.parse_date(c, "M/d/yy"), **options)


def test_two_digit_years_are_rebased(spark):
    values = ["12/31/95", "7/4/96", "07/04/97", "1/1/98", None]
    assert evaluate(spark, values, rebased) == ["2021-12-31", "2022-07-04", "2023-07-04", "2024-01-01", None]


def test_unmapped_years_lose_the_year_or_keep_it(spark):
    values = ["7/4/99", "7/4/01", "7/4/96"]
    assert evaluate(spark, values, rebased) == ["07-04", "07-04", "2022-07-04"]
    kept = evaluate(spark, values, lambda c: rebased(c, unmapped="keep"))
    assert kept == ["2099-07-04", "2001-07-04", "2022-07-04"]
    with pytest.raises(ValueError):
        rebased("v", unmapped="guess")


def test_an_empty_year_map_leaves_only_month_and_day(spark):
    assert evaluate(spark, ["7/4/96"], lambda c: rebased(c, years={})) == ["07-04"]


def test_dates_that_do_not_parse_are_null(spark):
    values = ["2/30/96", "7/4/1996", "1996-07-04", "", "13/1/96"]
    assert evaluate(spark, values, rebased) == [None] * 5


def test_leap_day_survives_as_text_but_not_as_a_date(spark):
    assert evaluate(spark, ["2/29/96"], rebased) == ["2022-02-29"]
    assert evaluate(spark, ["2022-02-29", "07-04", "2021-07-04", None], lambda c: fn.plus_days(c, 7)) == [
        None,
        None,
        "2021-07-11",
        None,
    ]


def test_two_digit_pattern_is_strict_and_has_no_century_repair(spark):
    got = evaluate(spark, ["12/8/48", "12/08/48", None], lambda c: fn.parse_date(c, "MM/dd/yy").cast("string"))
    assert got == [None, "2048-12-08", None]


TEXT = st.text(st.characters(exclude_categories=["Cs"]))
PROPERTY = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@PROPERTY
@given(st.lists(TEXT, min_size=1, max_size=60))
def test_cleaners_match_a_character_filter_and_are_idempotent(spark, values):
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    spaces = " \t\n\r\f\v"
    for cleaner, allowed in (
        (fn.keep_digits, "0123456789"),
        (fn.keep_person_name, letters + spaces + "'-"),
        (fn.keep_alphanumeric, letters + "0123456789" + spaces),
    ):
        once = evaluate(spark, values, cleaner)
        assert once == ["".join(ch for ch in v if ch in allowed) for v in values]
        assert evaluate(spark, once, cleaner) == once


@PROPERTY
@given(st.lists(st.tuples(st.integers(0, 14), st.integers(0, 33), st.integers(0, 99)), min_size=1, max_size=80))
def test_rebasing_matches_the_calendar(spark, parts):
    import datetime

    def expected(month, day, year):
        try:
            datetime.date(2000 + year, month, day)
        except ValueError:
            return None
        years = {95: "2021-", 96: "2022-", 97: "2023-", 98: "2024-"}
        return f"{years.get(year, '')}{month:02d}-{day:02d}"

    texts = [f"{m}/{d}/{y:02d}" for m, d, y in parts]
    assert evaluate(spark, texts, rebased) == [expected(*p) for p in parts]


@PROPERTY
@given(st.lists(st.from_regex(re.compile(r"[0-9]{0,4}( |kg|)[a-z -]{0,12}", re.ASCII), fullmatch=True), min_size=1))
def test_package_text_matches_python(spark, values):
    def rest(text):
        found = re.match(r"^\d+\s(.+)$", text, re.ASCII)
        return found.group(1).replace("- ", "") if found else ""

    def number(text):
        found = re.match(r"\d+", text, re.ASCII)
        return int(found.group()) if found else None

    assert evaluate(spark, values, fn.leading_number) == [number(v) for v in values]
    assert evaluate(spark, values, fn.text_after_number) == [rest(v) for v in values]
