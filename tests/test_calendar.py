from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from dealreports.functions import calendar as C


@pytest.fixture(scope="module")
def days(spark):
    texts = ["2024-02-15", "2024-02-16", "2024-02-29", "2023-02-28", "2024-12-31", "2024-01-01 14:30:00", "2024-04-30"]
    return spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", F.col("t").cast("timestamp_ntz").alias("d")
    )


def collect(df, column):
    return {r["t"]: r[0] for r in df.select(column, "t").collect()}


def test_half_months(days):
    assert collect(days, C.half_month_label("d")) == {
        "2024-02-15": "2024/02/01 - 2024/02/15",
        "2024-02-16": "2024/02/16 - 2024/02/29",
        "2024-02-29": "2024/02/16 - 2024/02/29",
        "2023-02-28": "2023/02/16 - 2023/02/28",
        "2024-12-31": "2024/12/16 - 2024/12/31",
        "2024-01-01 14:30:00": "2024/01/01 - 2024/01/15",
        "2024-04-30": "2024/04/16 - 2024/04/30",
    }
    assert collect(days, C.half_month_start("d"))["2024-02-16"] == datetime(2024, 2, 16)
    assert collect(days, C.half_month_end("d"))["2024-02-16"] == datetime(2024, 2, 29, 23, 59, 59)
    assert collect(days, C.half_month_end("d"))["2024-02-15"] == datetime(2024, 2, 15, 23, 59, 59)


def test_months(days):
    assert collect(days, C.month_start("d"))["2024-02-29"] == datetime(2024, 2, 1)
    assert collect(days, C.month_end("d"))["2024-12-31"] == datetime(2024, 12, 31, 23, 59, 59)
    assert collect(days, C.next_month_end("d"))["2024-12-31"] == datetime(2025, 1, 31)
    assert collect(days, C.next_month_end("d"))["2024-01-01 14:30:00"] == datetime(2024, 2, 29)
    assert collect(days, C.long_month_label("d"))["2024-02-15"] == "FEBRUARY 2024"
    assert collect(days, C.short_month_label("d"))["2024-02-15"] == "Feb 2024"


def test_null_dates_have_no_period(spark):
    df = spark.sql("SELECT CAST(NULL AS TIMESTAMP_NTZ) AS d")
    row = df.select(C.half_month_start("d"), C.half_month_end("d"), C.half_month_label("d"), C.month_end("d")).first()
    assert list(row) == [None] * 4


@pytest.mark.parametrize(
    "text,expected",
    [
        ("2024-03-05", datetime(2024, 3, 5)),
        ("2024-03-05 10:11:12", datetime(2024, 3, 5, 10, 11, 12)),
        ("2024-03-05T10:11:12", datetime(2024, 3, 5, 10, 11, 12)),
        ("03/05/2024", datetime(2024, 3, 5)),
        ("3/5/2024 7:08", datetime(2024, 3, 5, 7, 8)),
        ("3/5/2024 7:08:09", datetime(2024, 3, 5, 7, 8, 9)),
        ("2023-02-29", None),
        ("13/45/2024", None),
        ("TBD", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(C.parse_date("t")).first()[0] == expected


def test_rejected_dates(spark):
    df = spark.createDataFrame([("TBD", ""), ("2024-01-01", None), ("x", "1/2/2024")], "`a b` string, b string")
    assert {tuple(r) for r in C.rejected_dates(df, ["a b", "b"]).collect()} == {("a b", 2), ("b", 0)}


def test_parse_month_label(spark):
    df = spark.createDataFrame([("MARCH 2024",), ("nonsense",), (None,)], "t string")
    assert [r[0] for r in df.select(C.parse_month_label("t")).collect()] == [date(2024, 3, 1), None, None]


AS_OF = datetime(2024, 2, 29, 14, 30)


@pytest.mark.parametrize(
    "as_of,offset,calendar,clock",
    [
        (AS_OF, 0, (datetime(2024, 2, 1), datetime(2024, 3, 1)), (datetime(2024, 2, 1, 14, 30), AS_OF)),
        (
            datetime(2024, 1, 31, 9),
            -1,
            (datetime(2023, 12, 1), datetime(2024, 1, 1)),
            (datetime(2023, 12, 1, 9), datetime(2023, 12, 31, 9)),
        ),
        (
            datetime(2024, 12, 5, 9),
            1,
            (datetime(2025, 1, 1), datetime(2025, 2, 1)),
            (datetime(2025, 1, 1, 9), datetime(2025, 1, 31, 9)),
        ),
    ],
)
def test_month_bounds(as_of, offset, calendar, clock):
    assert C.month_bounds(as_of, offset) == calendar
    assert C.month_bounds(as_of, offset, "clock") == clock


def test_unknown_bounds_are_refused():
    with pytest.raises(ValueError):
        C.month_bounds(AS_OF, 0, "other")


def test_clock_bounds_leave_out_the_first_midnight_and_the_last_evening(spark):
    rows = ["2024-02-01 00:00:00", "2024-02-01 14:30:00", "2024-02-29 14:29:00", "2024-02-29 14:30:00", "2024-02-29 14:31:00"]
    df = spark.createDataFrame([(r,) for r in rows], "t string").selectExpr("t", "CAST(t AS TIMESTAMP_NTZ) AS d")
    kept = lambda bounds: [r["t"] for r in df.where(C.in_month("d", AS_OF, 0, bounds)).collect()]
    assert kept("calendar") == rows
    assert kept("clock") == rows[1:4]
    assert df.where(C.from_month("d", datetime(2024, 1, 15, 14, 30), 1, "clock")).count() == 4


@pytest.mark.parametrize("month,extra,last", [(3, 0, "2024-03-31"), (3, 1, "2024-04-30"), (12, 1, "2024-12-31")])
def test_year_to_date_ends_with_the_year(spark, month, extra, last):
    df = spark.sql("SELECT explode(sequence(DATE '2023-12-01', DATE '2025-02-01')) AS d")
    df = df.where(C.year_to_date("CAST(d AS TIMESTAMP_NTZ)", datetime(2024, month, 10), extra))
    assert [str(x) for x in df.selectExpr("min(d)", "max(d)").first()] == ["2024-01-01", last]


def test_period_table(spark):
    rows = C.period_table(spark, C.months_of_year(2024, 2), AS_OF).collect()
    assert [r["period"] for r in rows] == ["JANUARY 2024", "FEBRUARY 2024"]
    assert rows[0]["period_end"] == datetime(2024, 1, 31, 23, 59, 59)
    assert rows[0]["next_end"] == datetime(2024, 2, 29, 23, 59, 59)
    assert rows[0]["current_end"] == AS_OF
    assert rows[1]["current_end"] == datetime(2024, 2, 29, 23, 59, 59)
