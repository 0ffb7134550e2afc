from datetime import date

import pytest
from pyspark.sql import functions as F

from cohortlink.functions import text


def value(spark, column, **inputs):
    """Result of one column expression over one row of string (or int) inputs."""
    kinds = {k: "int" if isinstance(v, int) else "string" for k, v in inputs.items()}
    schema = ", ".join(f"{k} {t}" for k, t in kinds.items())
    return spark.createDataFrame([tuple(inputs.values())], schema).select(column).first()[0]


def test_match_key_ignores_case_and_trailing_blanks(spark):
    assert value(spark, text.match_key(F.col("x")), x="Mary  ") == "mary"
    assert value(spark, text.match_key(F.col("x")), x=" Mary") == " mary"
    assert value(spark, text.match_key(F.col("x")), x=None) is None


@pytest.mark.parametrize(
    "parts, expected",
    [
        (("1 A St", None, "CA", "92093"), "1 A St  CA 92093"),
        (("1 A St, Apt 2", "La Jolla", "CA,", "92093"), "1 A St Apt 2 La Jolla CA 92093"),
        ((None, None, None, None), "   "),
    ],
)
def test_address_line(spark, parts, expected):
    columns = [F.col(c) for c in "abcd"]
    assert value(spark, text.address_line(*columns), **dict(zip("abcd", parts))) == expected


@pytest.mark.parametrize(
    "identifier, after_first, without_p",
    [
        ("P123", 123, 123),
        ("p123 ", 123, 123),
        ("PP12", None, 12),
        ("A77", 77, None),
        ("P", None, None),
        ("", None, None),
        (None, None, None),
    ],
)
def test_identifier_numbers(spark, identifier, after_first, without_p):
    assert value(spark, text.number_after_first_char(F.col("x")), x=identifier) == after_first
    assert value(spark, text.number_without_p(F.col("x")), x=identifier) == without_p


@pytest.mark.parametrize(
    "year, month, day, expected, impossible",
    [
        (1980, 5, 17, date(1980, 5, 17), False),
        (1980, 5, None, None, False),
        (2001, 2, 30, None, True),
        (2000, 2, 29, date(2000, 2, 29), False),
        (0, 1, 1, None, True),
    ],
)
def test_date_from_parts(spark, year, month, day, expected, impossible):
    df = spark.createDataFrame([(year, month, day)], "y int, m int, d int")
    parts = [F.col(c) for c in "ymd"]
    assert df.select(text.date_of(*parts), text.no_such_date(*parts)).first() == (expected, impossible)
