import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from dealreports.functions.attributes import extract
from dealreports.registry import queries
from dealreports.sources import ingest, tables
from dealreports.streaming.landing import land_stream

PAGE = [
    {"id": 1, "created": "2024-01-01", "team_id": "12", "team_user_id": 3.7, "agent_id": None, "extra": "dropped",
     "field_values": [{"key": "a", "label": "A", "value": {"x": [1, 2]}}], "api_data": {"n": 1}},
    {"id": "oops", "created": None, "team_id": "", "field_values": None},
]


def lists_per_line(folder, *pages):
    folder.mkdir(exist_ok=True)
    for page in pages:
        name = f"page-{len(list(folder.iterdir()))}.json"
        (folder / name).write_text(json.dumps(page) + "\n")
    return str(folder)


def test_pages_are_typed(spark, tmp_path):
    pages = lists_per_line(tmp_path / "pages", PAGE)
    out = str(tmp_path / "out")
    ingest.land(spark, pages, out)
    df = tables.read_properties(spark, out)
    assert df.schema == tables.PROPERTIES
    rows = {r["created"]: r for r in df.collect()}
    first, second = rows["2024-01-01"], rows[None]
    assert (first["id"], first["team_id"], first["team_user_id"], first["agent_id"]) == (1, 12, 3, 0)
    assert (second["id"], second["team_id"], second["team_name"], second["field_values"]) == (0, 0, None, None)
    assert json.loads(first["api_data"]) == {"n": 1}
    assert {r["a"] for r in extract(df, ["a"]).collect()} == {'{"x":[1,2]}', None}


def test_one_record_per_line_and_one_list_over_many_lines(spark, tmp_path):
    lines, pretty = tmp_path / "lines.json", tmp_path / "pretty.json"
    lines.write_text("\n".join(json.dumps(r) for r in PAGE))
    pretty.write_text(json.dumps(PAGE, indent=2))
    one = ingest.enforce(ingest.read_pages(spark, str(lines))).drop("field_values", "api_data").collect()
    two = ingest.enforce(ingest.read_pages(spark, str(pretty), multiline=True)).drop("field_values", "api_data").collect()
    assert sorted(one, key=str) == sorted(two, key=str) and len(one) == 2


def test_landing_replaces_what_was_there(spark, tmp_path):
    out = str(tmp_path / "out")
    ingest.land(spark, lists_per_line(tmp_path / "a", PAGE, PAGE), out)
    ingest.land(spark, lists_per_line(tmp_path / "b", PAGE[:1]), out)
    assert tables.read_properties(spark, out).count() == 1


@pytest.mark.parametrize(
    "text,number",
    [("7", 7), ("-3", -3), ("12.9", 12), ("1e3", 1000), (" 5 ", 5), ("x", 0), ("", 0), (None, 0), ("9223372036854775807", 2**63 - 1), ("1e30", 0)],
)
def test_whole_numbers(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(ingest.whole_number(F.col("t"))).first()[0] == number


def test_nested_columns_become_text(spark, tmp_path):
    pages = tmp_path / "agents.json"
    pages.write_text(json.dumps({"id": 5, "name": "n", "details": {"a": [1]}, "tags": ["x"]}))
    out = str(tmp_path / "agents")
    ingest.land_agents(spark, str(pages), out)
    row = spark.read.parquet(out).first()
    assert (row["id"], row["name"], row["details"], row["tags"]) == (5, "n", '{"a":[1]}', '["x"]')
    df = spark.createDataFrame([(1, {"k": 2}, None)], "id long, api_data map<string,int>, field_values array<int>")
    assert ingest.enforce(df).first()["api_data"] == '{"k":2}'


def test_stream_lands_every_page_once(spark, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    pages = lists_per_line(tmp_path / "pages", PAGE)
    land_stream(spark, pages, out, checkpoint).awaitTermination()
    assert tables.read_properties(spark, out).count() == 2
    land_stream(spark, pages, out, checkpoint).awaitTermination()
    assert tables.read_properties(spark, out).count() == 2
    lists_per_line(tmp_path / "pages", PAGE[:1])
    land_stream(spark, pages, out, checkpoint).awaitTermination()
    assert tables.read_properties(spark, out).count() == 3


def test_readers(spark, tmp_path):
    spark.range(3).selectExpr("id").write.parquet(str(tmp_path / "p" / "all_1.parquet"))
    spark.range(2).selectExpr("id").write.parquet(str(tmp_path / "p" / "all_2.parquet"))
    assert tables.read_properties(spark, str(tmp_path / "p" / "all_*.parquet")).count() == 5
    assert tables.read_properties(spark, [str(tmp_path / "p" / "all_1.parquet")]).count() == 3
    names = tmp_path / "names.csv"
    names.write_text("Compliance Only -  100,ignored\nDate Created]\n\nTeam  A \n")
    got = tables.list_values(tables.read_list(spark, str(names)))
    assert got == ["Compliance Only -  100", "Date Created]", "Team  A "]
    with pytest.raises(ValueError):
        tables.list_values(tables.read_list(spark, str(names)), most=2)
    table = tmp_path / "agents.csv"
    table.write_text("Title,Other,Agent Provided by\nAnn,x,TC\n")
    agents = tables.read_csv_columns(spark, str(table), ["Title", "Agent Provided by"])
    assert [tuple(r) for r in agents.collect()] == [("Ann", "TC")]


@pytest.fixture
def tables_dir(spark, tmp_path):
    """Tables of 900 orders (some keys twice or NULL) of 30 customers."""
    folder = tmp_path / "tables"
    orders = [(None if k == 77 else k - k % 50 // 49, k % 30, datetime(1995 + k % 6, 1 + k % 12, 1 + k % 28)) for k in range(900)]
    customers = [(a, f"Customer {a}", a % 3, "AUTOMOBILE") for a in range(30)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{folder}/orders.parquet")
    spark.createDataFrame(customers, "c_custkey long, c_name string, c_nationkey int, c_mktsegment string").write.parquet(f"{folder}/customer.parquet")
    spark.createDataFrame([(n, f"NATION_{n}") for n in range(3)], "n_nationkey int, n_name string").write.parquet(f"{folder}/nation.parquet")
    return str(folder)


def test_pages_take_a_fraction_of_their_text(spark, tables_dir):
    path = queries._write_pages(spark, tables_dir)
    text = spark.read.text(path)
    length, records = text.selectExpr("sum(octet_length(value) + 1)", "count(*)").first()
    stored = sum(r["length"] for r in spark.read.format("binaryFile").load(path).select("length").collect())
    assert records == queries.inputs.raw(spark, tables_dir).count() > 900
    assert stored < length / 4


@pytest.mark.parametrize("name", ["ingest_typed", "ingest_stream"])
def test_every_compressed_page_is_landed_whole(spark, tables_dir, name):
    raw = queries.inputs.raw(spark, tables_dir)
    agent = F.when(F.col("agent_id") % 5 == 0, 0).otherwise(F.col("agent_id")).alias("agent_id")
    expected = raw.select(F.coalesce("id", F.lit(0)).alias("id"), "created", "team_user_id", agent, "inbound_email_address")
    got = queries.QUERIES[name](spark, tables_dir)
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(got.select(expected.columns)) == rows(expected)
    statuses = lambda df: sorted(map(str, extract(df, ["contract_status"]).select("id", "contract_status").collect()))
    assert rows(got.select("id", "contract_status")) == statuses(raw.withColumn("id", F.coalesce("id", F.lit(0))))
