from datetime import datetime
from decimal import Decimal

import pytest
from records import record

from dealreports.plans import workbooks
from dealreports.sinks import render, reports

ROW = [(1, None, float("nan"), "a\r\nb", datetime(2024, 1, 1, 9, 30, 0, 5), Decimal("1.50"), True, 350.0)]
SCHEMA = "i int, n string, f double, s string, t timestamp_ntz, d decimal(18,2), b boolean, g double"


def test_cells(spark):
    df = spark.createDataFrame(ROW, SCHEMA)
    assert list(render.render(df).first()) == ["1", "", "", "a\r\nb", "2024-01-01 09:30:00", "1.50", "True", "350.0"]
    assert render.render_on_one_line(df).first()["s"] == "a b"


def test_clock_text_does_not_depend_on_the_time_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        # this clock time does not exist in New York
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        df = spark.sql("SELECT TIMESTAMP_NTZ '2024-03-10 02:30:00' AS t")
        assert render.render(df).first()["t"] == "2024-03-10 02:30:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_sheets_are_replaced_as_a_whole(spark, tmp_path):
    root = str(tmp_path)
    titles = ["A", "1-15 March 2024"]
    first = reports.write_report([spark.range(3), spark.range(2)], root, "book", titles)
    assert list(first) == titles and spark.read.parquet(first["A"]).count() == 3
    again = reports.write_report({"A": spark.range(1)}, root, "book")
    assert again["A"] == first["A"] and spark.read.parquet(first["A"]).count() == 1
    assert spark.read.parquet(first["1-15 March 2024"]).count() == 2


def test_bad_reports_are_refused(spark, tmp_path):
    for frames, titles in (([], []), ([spark.range(1)], []), ([spark.range(1)] * 2, ["a", "a"]), ([spark.range(1)], None)):
        with pytest.raises(ValueError):
            reports.write_report(frames, str(tmp_path), "book", titles)
    with pytest.raises(ValueError):
        reports.write_sheet(spark.range(1), str(tmp_path / "x"), "xls")


def test_empty_tables_have_a_header_only(spark, tmp_path):
    empty = spark.range(0)
    assert not reports.write_extract(empty, str(tmp_path / "e"))
    back = spark.read.option("header", True).csv(str(tmp_path / "e"))
    assert back.columns == ["id"] and back.count() == 0
    assert reports.write_report({"E": empty, "F": spark.range(1)}, str(tmp_path), "b", skip_empty=True).keys() == {"F"}


def test_csv_cells_survive(spark, tmp_path):
    df = spark.createDataFrame([('say "x", y', None), ("line\nbreak", "b")], "`a b` string, c string")
    assert reports.write_extract(df, str(tmp_path / "e"))
    back = spark.read.option("header", True).option("escape", '"').csv(str(tmp_path / "e"))
    assert {tuple(r) for r in back.collect()} == {('say "x", y', None), ("line break", "b")}
    paths = reports.write_report({"S": df}, str(tmp_path), "b", fmt="csv")
    back = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(paths["S"])
    assert back.count() == 2 and back.columns == ["a b", "c"]
    reports.write_csv(df.select("c"), str(tmp_path / "plain"))


def test_split_gives_a_folder_per_value_and_keeps_every_row(spark, tmp_path):
    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 'hot team' ELSE concat('t', id % 7) END AS sheet")
    reports.write_split(df, str(tmp_path / "s"), ["sheet"])
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.select("id", "sheet").exceptAll(df).count() == 0 and back.count() == 1000
    assert (tmp_path / "s" / "sheet=hot team").is_dir()


def test_all_workbooks_from_one_flat_table(spark, tmp_path, properties):
    records = [
        record(1, items=[("Contract Title", "Deal"), ("Empower TC Name", "Molly Kelley"), ("Empower Agent Name", "Ann"),
                         ("Contract Status", "CTC - Closed - PAID"), ("Closing", "2024-02-10"),
                         ("CTC Started with Empower", "2024-01-10"), ("Billing Amount", "400")]),
        record(2, items=[("Contract Title", "Ann"), ("Contract Status", "AGENT ACCOUNT")]),
    ]
    properties(records).write.parquet(str(tmp_path / "raw"))
    flat = workbooks.write_flat(spark, str(tmp_path / "raw"), str(tmp_path / "flat"))
    as_of, root, teams = datetime(2024, 2, 20), str(tmp_path / "out"), {"ctc": ["T"], "preferred": ["P"]}
    counts = workbooks.write_monthly_counts(flat, root, as_of, teams)
    overview = spark.read.option("header", True).csv(counts["Overview"])
    assert overview.where("state = 'CTC - Closing'").first()["Feb 2024"] == "1"
    sheets = workbooks.write_payroll(flat, root)
    assert spark.read.parquet(sheets["projected"]).columns == ["Empower TC Name", "2024/02/01 - 2024/02/15", "Total Result"]
    staged = workbooks.write_staging(flat, root)
    assert spark.read.parquet(staged["Transaction"]).count() == 1
    daily = spark.read.parquet(workbooks.write_daily_update(flat, root, 2024, as_of))
    assert {r["sheet"] for r in daily.select("sheet").distinct().collect()} == {"JANUARY 2024"}
    paths = workbooks.write_extracts(flat, root, as_of, teams)
    assert spark.read.parquet(paths["extracts"]).first()["extract"] == "Closings-Current Month"
