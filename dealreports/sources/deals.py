"""Deal records made out of the orders, customer and nation tables.

Gives the raw ``properties`` shape: fixed columns and one JSON list of attributes. One row per order, one or
two rows per agent (customer). Every attribute follows from the keys by integer rules, so the same answers
can be computed from the base tables without any JSON.
"""

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealreports.functions.text import literal

AS_OF = datetime(2000, 10, 20, 14, 30)
YEAR = 2000
CUTOVER_YEAR = 1998
COORDINATORS = [f"TC {i}" for i in range(5)]
CTC_TEAMS = [f"Team NATION_{i}" for i in range(0, 6)]
PREFERRED_TEAMS = [f"Team NATION_{i}" for i in range(5, 16)]

STATUSES = [
    "CTC - Pending",
    "CTC - Closed - PAID",
    "CTC - PAID",
    "CTC - Terminated - No Charge",
    "CTC - Withdrawn",
    "CTC - Terminated - Compliance - PAID",
    "CTC - Preferred - Pending",
    "CTC - Preferred - Closed - PAID",
    "CTC - Preferred - Closed - Ready to BILL",
    "CTC - Preferred - PAID",
    "CTC - Preferred - Terminated - No Change",
    "CTC - Preferred - Withdrawn",
    "Listing - PAID",
    "Listing - Pre-Listing",
    "Compliance",
    "Compliance - PAID",
    "Compliance - Ready to BILL",
    "CTC - Terminated - No Change",
    None,
    "CTC - Pending",
]

# Attribute keys that are not the label in lower case with underscores.
KEYS = {"Closing": "closing_date"}


def deals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ``properties`` rows: the order side and the agent side."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    nation = spark.read.parquet(f"{sf_dir}/nation.parquet")
    agents = customer.join(nation, customer.c_nationkey == nation.n_nationkey).selectExpr(
        "c_custkey",
        "c_name",
        "c_mktsegment",
        "CAST(n_nationkey AS BIGINT) AS team_id",
        "concat('Team ', n_name) AS team_name",
    )
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", "o_custkey", "o_orderdate")
    return _from_orders(orders, agents).unionByName(_from_agents(agents))


def _item(label: str, json_value: str, present: str | None = None) -> str:
    """One attribute as JSON text; left out where ``present`` does not hold."""
    key = KEYS.get(label, "_".join(label.lower().split()))
    item = f"""concat('{{"key":"{key}","label":"{label}","value":', {json_value}, '}}')"""
    return item if present is None else f"CASE WHEN {present} THEN {item} END"


def _text(value: str) -> str:
    """A JSON string, or null."""
    return f"""coalesce(concat('"', replace({value}, '"', '\\\\"'), '"'), 'null')"""


def _date(value: str) -> str:
    return f"""concat('"', {value}, '"')"""


def _plus(date: str, days: str) -> str:
    return f"date_add({date}, CAST({days} AS INT))"


def _json_list(items: list[str]) -> str:
    return f"concat('[', concat_ws(',', {', '.join(items)}), ']')"


ROWS_OF_TASK = 20_000


def _spread(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The JSON text is a hundred times the row it comes from, so the rows are spread evenly before it is made.

    Neither the size of the files nor the skew of the join says how long a task would take. The number of tasks
    follows the number of rows, and is given because adaptive execution would put small rows together again.
    """
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // ROWS_OF_TASK)), key)


def _properties(df: DataFrame, row_id: str, created: str, field_values: str) -> DataFrame:
    return df.selectExpr(
        f"{row_id} AS id",
        f"substr(CAST(CAST({created} AS TIMESTAMP_NTZ) AS STRING), 1, 19) AS created",
        "'America/Chicago' AS timezone",
        f"{field_values} AS field_values",
        "team_id",
        "team_name",
        "c_custkey % 50 AS team_user_id",
        "concat('User ', c_custkey % 50) AS team_user_name",
        "c_custkey AS agent_id",
        "c_name AS agent_name",
        "c_mktsegment AS brokerage",
        "'{}' AS api_data",
        f"concat('deal-', {row_id}, '@example.com') AS inbound_email_address",
    )


def _from_orders(orders: DataFrame, agents: DataFrame) -> DataFrame:
    joined = orders.join(agents, orders.o_custkey == agents.c_custkey)
    rows = _spread(joined, "o_orderkey", orders.count()).withColumnsRenamed({"o_orderkey": "k"})
    rows = rows.withColumn("d", F.to_date("o_orderdate"))
    closing = _plus("d", "k % 75")
    listing, offer, compliance = "k % 3 = 0", "k % 7 = 0", "k % 9 < 4"

    def amount(value: str) -> str:
        return f"""CASE WHEN k % 41 = 0 THEN '""' WHEN k % 43 = 0 THEN '"n/a"' ELSE concat('"', {value}, '"') END"""

    title = (
        "CASE WHEN k % 229 = 0 THEN NULL WHEN k % 211 = 0 THEN concat('Test deal ', k) "
        "WHEN k % 223 = 0 THEN concat('TRAINING ', k) WHEN k % 227 = 0 THEN concat('please delete ', k) "
        "ELSE concat('Deal ', k) END"
    )
    client = "CASE WHEN k % 17 = 0 THEN NULL WHEN (k div 20) % 2 = 0 THEN 'Buyer' ELSE 'Seller' END"
    status = f"get(array({', '.join(literal(s) for s in STATUSES)}), CAST(k % 20 AS INT))"
    billing = (
        """CASE WHEN k % 6 = 0 THEN '""' WHEN k % 6 = 1 THEN '0' ELSE concat('"', 400 + 25 * (k % 5), '"') END"""
    )
    attributes = _json_list(
        [
            "CASE WHEN k % 29 = 0 THEN '7' END",
            _item("Contract Title", _text(title)),
            _item("Contract Client Type", _text(client)),
            _item("Empower TC Name", _text("concat('TC ', k % 9)"), "k % 31 <> 0"),
            _item("Empower Agent Name", _text("CASE WHEN k % 37 <> 0 THEN c_name END")),
            _item("Contract Status", _text(status)),
            _item("CTC Started with Empower", _date("d"), "k % 13 <> 0"),
            _item("Closing", f"CASE WHEN k % 97 = 0 THEN '\"TBD\"' ELSE {_date(closing)} END", "k % 11 <> 0"),
            _item("CTC PAID Date", _date(_plus(closing, "10")), "k % 4 = 0 AND k % 11 <> 0 AND k % 97 <> 0"),
            _item("Listing Started with Empower", _date(_plus("d", "k % 20")), listing),
            _item("Listing PAID Date", _date(_plus("d", "20 + k % 25")), listing),
            _item("Offer Started with Empower", _date(_plus("d", "k % 10")), offer),
            _item("Offer Prep PAID Date", _date(_plus("d", "12 + k % 10")), offer),
            _item("Compliance Started with Empower", _date(_plus("d", "k % 15")), compliance),
            _item("Compliance PAID Date", _date(_plus("d", "15 + k % 30")), compliance),
            _item("Listing PAID Amount", amount("150 + 50 * (k % 3)")),
            _item("CTC PAID Amount", amount("350")),
            _item("Offer Prep PAID Amount", amount("40")),
            _item("Compliance PAID Amount", amount("50 + 50 * (k % 3)")),
            _item("Billing Amount", billing),
            _item("Other Amount", """'"75"'""", "k % 12 IN (0, 7)"),
            _item("Preferred  Ai  CTC", """'"Yes"'""", "k % 10 = 0"),
            _item("Billing Status", """'"Compliance - PAID"'""", "k % 53 = 0"),
            _item("Live on MLS Date", _date(_plus("d", "k % 22")), listing),
            _item("CTC Monthly", """CASE WHEN k % 3 = 0 THEN '""' ELSE '"25"' END""", "k % 5 = 0"),
            _item("Promo Notes", """CASE WHEN k % 4 = 0 THEN '""' ELSE '"Spring"' END""", "k % 6 = 0"),
            _item("Contract Status", """'"Superseded"'""", "k % 23 = 0"),
            """CASE WHEN k % 47 = 0 THEN '{"key":"contract_status","label":"Contract Status"}' END""",
        ]
    )
    field_values = (
        f"CASE WHEN k % 103 = 0 THEN NULL WHEN k % 101 = 0 THEN 'not json' "
        f"WHEN k % 107 = 0 THEN concat({attributes}, ' [') ELSE {attributes} END"
    )
    return _properties(rows, "k", "o_orderdate", field_values)


def _from_agents(agents: DataFrame) -> DataFrame:
    rows = _spread(agents.where("c_custkey % 13 <> 0"), "c_custkey", agents.count()).selectExpr(
        "*",
        "c_custkey AS a",
        "explode(CASE WHEN c_custkey % 17 = 0 THEN array(1, 2) ELSE array(1) END) AS twice",
    )
    created = "date_sub(date_add(DATE '1995-01-01', CAST(a % 365 AS INT)), twice - 1)"
    onboard = "date_add(DATE '1995-01-01', CAST(a * 7 % 2400 AS INT))"
    attributes = _json_list(
        [
            _item("Contract Title", _text("CASE WHEN a % 500 <> 0 THEN c_name END")),
            _item("Contract Status", """'"AGENT ACCOUNT"'"""),
            _item("Transaction Coordinator", _text("concat('TC ', a % 9)")),
            _item("Onboard Call Complete Date", _date(onboard), "a % 19 <> 0"),
            _item("Onboarding Status", """'"1st Transaction"'""", "a % 4 = 0"),
            _item("1st Transaction Date", _date(_plus(onboard, "a % 40")), "a % 19 <> 0"),
            _item("Brokerage", _text("c_mktsegment")),
            _item("Agent Provided by", """CASE WHEN a % 3 = 0 THEN '"TC"' ELSE '"Empower"' END""", "a % 3 <> 2"),
            _item("Other Status", """'"Lost - Reassigned"'""", "a % 23 = 0"),
            _item("Reassigned Date", _date(_plus(onboard, "100 + a % 50")), "a % 23 = 0 AND a % 19 <> 0"),
        ]
    )
    return _properties(rows, "a + twice * 10000000", created, attributes)
