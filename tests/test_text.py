"""Truth tables of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from worklink.functions import scores as S
from worklink.functions import text as X


def table(spark, rows, function):
    data = [(i, r[0]) for i, r in enumerate(rows)]
    df = spark.createDataFrame(data, "i int, v string")
    got = [r.o for r in df.select("i", function(F.col("v")).alias("o")).orderBy("i").collect()]
    assert got == [r[1] for r in rows]


@pytest.mark.parametrize("function, rows", [
    (X.clean_str, [(None, None), ("", None), ("  ", None), ("  a b\t", "a b")]),
    (X.clean_phone, [
        (None, None), ("", None), ("-", None), ("98765 43210", "+919876543210"),
        ("91-9876543210", "+919876543210"), ("0919876543210", "+919876543210"),
        ("123456789", "+123456789"), ("449876543210", "+449876543210"),
        ("12345678901234", "+12345678901234"), ("९८७६५४३२१०", "+91९८७६५४३२१०"),
    ]),
    (X.clean_bool, [(None, None), ("", False), ("t", True), ("TRUE", True), (" yes ", True),
                    ("0", False), ("no", False), ("1", True)]),
    (X.phone_key, [(None, None), ("+911.0", "+911"), (" 5 ", "5"), ("", None)]),
    (X.to_num_text, [(None, ""), ("", ""), ("5", "5"), ("5.0", "5"), ("5.5", "5.5"), ("x", "x"),
                     ("1d", "1d"), ("-3", "-3")]),
    (lambda c: X.fmt_date(X.timestamp_of(c)), [
        ("2025-12-09 01:02:03.123456", "12/9/2025"), ("2025-1-2 3:4:5", "1/2/2025"),
        ("2025-01-02", "1/2/2025"), ("2025-01-02 03:04:05+00:00", ""), ("soon", ""), (None, ""),
        ("2025-01-02 03:04:05.5", "1/2/2025"),
    ]),
    (lambda c: X.fmt_date_text(X.timestamp_of(c)), [("2025-12-09", "9-Dec-2025"), (None, "")]),
    (lambda c: X.sheet_serial(X.timestamp_of(c)), [("1899-12-31 12:00:00", 1.5), (None, None)]),
    (S.edu_level, [
        (None, None), ("", None), ("unknown", None), ("10th", 2), ("ITI", 4),
        ("Diploma|12th", 4), ("post graduate degree", 5), ("Postgraduate", 6), ("MBA", 6),
    ]),
])
def test_scalar(spark, function, rows):
    table(spark, rows, function)


@pytest.mark.parametrize("low, high, text", [
    (None, None, ""), ("8000", None, "8000"), (None, "9000.7", "9000"),
    ("8000", "9000", "8000 - 9000"), ("x", "9000", ""), ("nan", "9000", "9000"),
])
def test_fmt_salary(value, low, high, text):
    as_col = [F.lit(v).cast("string") for v in (low, high)]
    assert value(X.fmt_salary(*as_col)) == text


@pytest.mark.parametrize("want, low, high, score", [
    (None, 1.0, 2.0, None), (1.0, None, None, None), (10000.0, 10000.0, 20000.0, 1.0),
    (20000.0, 20000.0, 10000.0, 1.0), (8000.0, 10000.0, 20000.0, 0.5),
    (22000.0, 10000.0, 20000.0, 0.5), (22001.0, 10000.0, 20000.0, 0.0),
    (9000.0, None, 10000.0, 1.0), (12000.0, 10000.0, None, 1.0), (7999.0, 10000.0, 10000.0, 0.0),
])
def test_salary_score(value, want, low, high, score):
    assert value(S.salary_score(*[F.lit(v).cast("double") for v in (want, low, high)])) == score


@pytest.mark.parametrize("ss, js, sd, jd, score", [
    ("", "KA", "a", "a", None), ("ka", None, "a", "a", None), ("UP", "KA", "a", "a", 0.0),
    ("Karnataka", "karna", "", "x", 0.6), ("karna", "Karnataka", "Mysuru", " mysuru rural", 1.0),
    ("x", "x", "a", "b", 0.6),
])
def test_location_score(value, ss, js, sd, jd, score):
    assert value(S.location_score(*[F.lit(v).cast("string") for v in (ss, js, sd, jd)])) == score


@pytest.mark.parametrize("diff, score", [(1, 1.0), (0, 1.0), (-1, 0.5), (-2, 0.0)])
def test_education_score(value, diff, score):
    assert value(S.education_score(F.lit(3) + diff, F.lit(3))) == score


@pytest.mark.parametrize("scores, expected, label", [
    ((1.0, 1.0, 1.0, 1.0), 1.0, "High"), ((0.5, None, None, None), 0.5, "Low"),
    ((None, None, None, None), 0.0, "Very Low"), ((0.6, 0.6, 0.6, 0.6), 0.6, "Medium"),
    ((1.0, 0.0, None, 0.0), 0.5, "Low"),
])
def test_confidence(value, scores, expected, label):
    c = S.confidence(*[F.lit(s).cast("double") for s in scores])
    assert value(c) == pytest.approx(expected)
    assert value(S.confidence_label(F.round(c, 6))) == label


@pytest.mark.parametrize("role, place, category", [
    (0.5, 0.6, "Right Fit"), (0.5, None, "Partial Fit"), (0.49, 1.0, None), (0.9, 0.0, "Partial Fit"),
])
def test_fit_category(value, role, place, category):
    assert value(S.fit_category(F.lit(role), F.lit(place).cast("double"))) == category
