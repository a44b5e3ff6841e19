"""Field parsing: bounds, shapes and texts of values."""

import pytest
from pyspark.sql import functions as F

from tallyroll.functions import fields


def evaluate(spark, values, make):
    """Results of ``make`` over the column ``c``, in order of the values."""
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "i int, c string")
    return [r.out for r in df.select("i", make(F.col("c")).alias("out")).orderBy("i").collect()]


def test_clean_text_trims_controls_and_fills_missing(spark):
    values = ["  a b ", "\ta\r\n", None, "", "\x00x\x1f"]
    assert evaluate(spark, values, fields.clean_text) == ["a b", "a", "", "", "x"]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("8.00", True),
        ("+8.", True),
        (".5", True),
        ("1e1", True),
        ("1E+2", True),
        ("-1.00", True),
        ("1e400", True),
        ("1e99999999999", False),
        ("", False),
        (".", False),
        ("8,5", False),
        ("1e", False),
        ("abc", False),
        ("0x1", False),
        ("NaN", False),
        ("1 0", False),
        ("8d", False),
    ],
)
def test_is_number(spark, text, expected):
    assert evaluate(spark, [text], fields.is_number) == [expected]


def test_hours_in_range_is_exact_at_the_bounds(spark):
    cases = {
        "0.00": False,
        "-1.00": False,
        "24.00": True,
        "24": True,
        "24.01": False,
        "25.00": False,
        "0.004": True,
        "1e1": True,
        "2.4e1": True,
        "240e-1": True,
        "24.0000000000000000001": False,
        "23.9999999999999999999": True,
        "1e400": False,
        "1e-400": True,
        "-1e-400": False,
        "-0": False,
        "0e5": False,
        "000024.0": True,
        "24.004": False,
        "23.996": True,
        "-0.004": False,
        "99.99": False,
        "100": False,
        "-100": False,
        "1e39": False,
        "abc": None,
        "": None,
        "1e99999999999": None,
    }
    got = evaluate(
        spark, list(cases), lambda c: fields.hours_in_range(c, fields.stored_hours(c))
    )
    assert dict(zip(cases, got)) == cases


def test_stored_hours_round_half_up(spark):
    values = ["8.005", "0.004", "0.005", "7.994", "24", "1e1"]
    got = [str(v) for v in evaluate(spark, values, fields.stored_hours)]
    assert got == ["8.01", "0.00", "0.01", "7.99", "24.00", "10.00"]


def test_decimal_text_is_canonical(spark):
    cases = {
        "0.00": "0.00",
        "-1.00": "-1.00",
        "25": "25",
        "+25": "25",
        "0025.50": "25.50",
        "25.": "25",
        "-.5": "-0.5",
        "1e2": "1E+2",
        "2.5e1": "25",
        "25e0": "25",
        "123.45e1": "1234.5",
        "123e3": "1.23E+5",
        "-0": "0",
        "-0.00": "0.00",
        "0e2": "0E+2",
        "0.000000": "0.000000",
        "0.0000000": "0E-7",
        "-0.0000001": "-1E-7",
        "-0.00000012": "-1.2E-7",
        "-0.000001": "-0.000001",
        "1e400": "1E+400",
    }
    assert dict(zip(cases, evaluate(spark, list(cases), fields.decimal_text))) == cases


def test_decimal_text_matches_the_decimal_module(spark):
    from decimal import Decimal

    values = [
        f"{sign}{whole}.{fraction}{exponent}"
        for sign in ("", "-")
        for whole in ("0", "7", "40", "123456789")
        for fraction in ("0", "5", "05", "000000001")
        for exponent in ("", "e0", "e3", "e-4", "e-12")
    ]
    # str(Decimal) follows the same rule, but for the sign of zero.
    expected = [str(abs(d)) if d == 0 else str(d) for d in map(Decimal, values)]
    assert evaluate(spark, values, fields.decimal_text) == expected


def test_work_date_is_strict(spark):
    values = ["2026-08-03", "2026-8-3", "2026-02-30", "20260803", "2026-08", "2026-08-03T01:00", "", "2024-02-29"]
    got = [str(d) if d else None for d in evaluate(spark, values, fields.work_date_value)]
    assert got == ["2026-08-03"] + [None] * 6 + ["2024-02-29"]


def test_truncated(spark):
    values = ["x" * 300, None, "ab"]
    assert evaluate(spark, values, lambda c: fields.truncated(c, 255)) == ["x" * 255, "", "ab"]
