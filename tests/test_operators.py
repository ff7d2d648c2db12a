from datetime import datetime
from decimal import Decimal

import pytest

from dealreports import fixed
from dealreports.operators import columns as col
from dealreports.operators import corrections, counting, filters
from dealreports.functions.calendar import months_of_year


def test_system_columns_are_renamed(spark):
    df = spark.createDataFrame([("z", "t", "u", "c", "a", ("x",))], "timezone string, team_name string, team_user_name string, created string, agent_name string, labels struct<`A B`: string>")
    renamed = col.side_by_side(df, "labels", ["A B"])
    assert renamed.columns == ["Time Zone", "Team", "Team User", "Date Created", "Created By", "A B"]


def test_fills(spark):
    df = spark.createDataFrame([(None, "", None), ("x", "0", datetime(2024, 1, 1))], "`a b` string, c string, d timestamp_ntz")
    filled = col.fill_blank(df, ["a b", "c", "d"], "none")
    assert [tuple(r) for r in filled.collect()] == [("none", "none", None), ("x", "0", datetime(2024, 1, 1))]
    assert col.fill_dates(df, ["d"], datetime(1899, 12, 30)).first()["d"] == datetime(1899, 12, 30)
    assert col.in_order(df, ["c", "a b"]).columns == ["c", "a b"]


def test_dates_before_none_fill_stay_dates(spark):
    """Four columns are in the date list and in the none list: the date filler comes first."""
    both = [c for c in fixed.DATE_COLUMNS if c in fixed.NONE_FILL_COLUMNS]
    assert len(both) == 4
    df = spark.createDataFrame([tuple([None] * 4)], ", ".join(f"`{c}` string" for c in both))
    filled = col.fill_blank(col.to_dates(df, both), both, "none")
    assert list(filled.first()) == [None] * 4


def test_changed_reads_the_columns_as_they_were(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert tuple(col.changed(df, {"a": "b", "b": "a", "c": "a + b"}).first()) == (2, 1, 3)


def test_money(spark):
    texts = ["12.345", "400", "", "n/a", None, "1e2"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").selectExpr(f"{col.to_money('t')} AS m")
    assert [r["m"] for r in df.collect()] == [Decimal("12.35"), Decimal("400.00"), None, None, None, Decimal("100.00")]
    amounts = spark.createDataFrame([(Decimal(1), None), (None, None)], "a decimal(18,2), b decimal(18,2)")
    assert [r[0] for r in amounts.selectExpr(col.sum_of(["a", "b"])).collect()] == [Decimal("1.00"), Decimal("0.00")]


def test_not_equal_keeps_null_and_membership_does_not(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "s string")
    assert [r["s"] for r in df.where(filters.is_not_value("s", "x")).collect()] == ["y", None]
    assert [r["s"] for r in filters.member_of(df, "s", ["x", "z"]).collect()] == ["x"]
    names = spark.createDataFrame([("y",), ("y",)], "name string")
    assert [r["s"] for r in filters.member_of(df, "s", names).collect()] == ["y"]


def test_excluded_titles(spark):
    titles = ["Test deal", "Contest Ln", "TRAINING", "please Delete", "Deal", None, ""]
    df = spark.createDataFrame([(t,) for t in titles], "t string")
    assert [r["t"] for r in df.where(~filters.title_is_excluded("t")).collect()] == ["Deal", None, ""]


def test_never_started_needs_a_blank_name_and_no_date(spark):
    schema = "name string, " + ", ".join(f"`{d}` timestamp_ntz" for d in filters.START_DATES)
    day = datetime(2024, 1, 1)
    rows = [(None, None, None, None, None), ("", None, None, None, None), ("x", None, None, None, None), (None, None, None, day, None)]
    df = spark.createDataFrame(rows, schema)
    assert [r[0] for r in df.select(filters.never_started("name")).collect()] == [True, True, False, False]


SCHEMA = (
    "`Billing Amount` string, `Other Amount` string, `Preferred  Ai  CTC` string, Closing timestamp_ntz"
)
DAY = datetime(2024, 5, 1)


@pytest.mark.parametrize(
    "billing,other,preferred,closing,expected",
    [
        (None, "75", "Yes", DAY, "75"),
        ("", None, "Yes", DAY, "99"),
        ("0", "0", "Yes", DAY, "99"),
        ("0.00", "", "No", DAY, "400"),
        ("", None, None, DAY, "400"),
        ("425", "75", "Yes", DAY, "425"),
        ("n/a", "75", "Yes", DAY, "n/a"),
        (None, "75", "Yes", None, None),
        ("0", "75", "Yes", None, "0"),
    ],
)
def test_billing_amount(spark, billing, other, preferred, closing, expected):
    df = spark.createDataFrame([(billing, other, preferred, closing)], SCHEMA)
    assert corrections.correct_billing(df).first()["Billing Amount"] == expected


def test_empty_listing_tests_the_old_date_and_leaves_the_amount(spark):
    schema = "`CTC Started with Empower` timestamp_ntz, `Listing Started with Empower` timestamp_ntz, `Live on MLS Date` timestamp_ntz, `Listing PAID Date` timestamp_ntz, `Listing PAID Amount` string"
    rows = [(datetime(2021, 1, 1), datetime(2021, 1, 1), DAY, DAY, "150"), (datetime(2020, 12, 31), DAY, DAY, DAY, "150"), (None, DAY, DAY, DAY, "150")]
    df = spark.createDataFrame(rows, schema)
    got = [tuple(r)[1:] for r in corrections.empty_listing(df).collect()]
    assert got == [(None, None, None, "150"), (DAY, DAY, DAY, "150"), (DAY, DAY, DAY, "150")]
    assert [r[4] for r in corrections.empty_listing(df, zero_listing_amount=True).collect()] == ["0", "150", "150"]


def test_spine_has_every_month_and_the_later_months_add_up(spark):
    months = months_of_year(2024)
    hits = spark.createDataFrame([("a", m.date()) for m in months for _ in range(m.month)], "k string, month date")
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    counts = counting.counts_on_spine(hits, keys, months)
    got = {(r["k"], r["month"].month): r["n"] for r in counts.collect()}
    assert got == {**{("a", m): m for m in range(1, 13)}, **{("b", m): 0 for m in range(1, 13)}}
    later = counts.withColumn("n", counting.later_months("k"))
    got = {(r["k"], r["month"].month): r["n"] for r in later.collect()}
    assert got == {**{("a", m): sum(range(m + 1, 13)) for m in range(1, 13)}, **{("b", m): 0 for m in range(1, 13)}}
    wide = counting.months_as_columns(counts, ["k"], months[:2])
    assert wide.columns == ["k", "Jan 2024", "Feb 2024"]


def test_totals_are_the_sums_of_the_cells_and_null_keys_drop(spark):
    rows = [("a", "p", 1), ("a", "q", 2), ("b", "p", 4), (None, "p", 8), ("b", None, 16), ("b", "p", None)]
    df = spark.createDataFrame([(r, c, None if v is None else Decimal(v)) for r, c, v in rows], "r string, c string, v decimal(20,4)")
    cells = counting.cells_with_totals(df, "r", "c", "v")
    got = {(r["r"], r["c"]): int(r["amount"]) for r in cells.collect()}
    assert got == {
        ("a", "p"): 1, ("a", "q"): 2, ("b", "p"): 4,
        ("a", "Total Result"): 3, ("b", "Total Result"): 4,
        ("Total Result", "p"): 5, ("Total Result", "q"): 2, ("Total Result", "Total Result"): 7,
    }
    matrix = counting.totals_matrix(cells, "r", "c", ["p", "q"])
    assert matrix.columns == ["r", "p", "q", "Total Result"]
    assert {tuple(map(str, r)) for r in matrix.collect()} == {
        ("a", "1.0000", "2.0000", "3.0000"),
        ("b", "4.0000", "0.0000", "4.0000"),
        ("Total Result", "5.0000", "2.0000", "7.0000"),
    }
    with pytest.raises(Exception, match="no column q"):
        counting.totals_matrix(cells, "r", "c", ["p"]).collect()


def test_distinct_values_are_sorted_and_not_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "s string")
    assert [r["s"] for r in counting.distinct_values(df, "s").collect()] == ["a", "b"]
