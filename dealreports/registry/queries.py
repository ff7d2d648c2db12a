"""The registered queries: each takes a session and a folder of tables and gives a DataFrame."""

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.functions import calendar as cal
from dealreports.functions.attributes import (
    FlatSpec,
    equals_flag,
    extract,
    flatten,
    labels_in,
    parse_once,
    unreadable,
    wide_discovered,
)
from dealreports.functions.discovery import add_up, class_counts, types_of
from dealreports.operators import columns as col
from dealreports.operators import corrections, counting, filters, matching, spelling
from dealreports.operators.asof import as_of
from dealreports.plans import daily, extracts, history, increments, kpis, payroll, sketches, staging, workbooks
from dealreports.plans.statuses import status_catalogue
from dealreports.registry import inputs
from dealreports.registry import oracle as sql
from dealreports.session import scratch_path
from dealreports.sinks import manifest, render, reports
from dealreports.sources import deals as d
from dealreports.sources import ingest
from dealreports.sources.tables import read_csv_columns, read_list, read_properties
from dealreports.streaming import activity, refresh
from dealreports.streaming.landing import land_stream

Query = Callable[[SparkSession, str], DataFrame]

TEAMS = {"ctc": d.CTC_TEAMS, "preferred": d.PREFERRED_TEAMS}
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def keep(query: Query) -> Query:
        QUERIES[name] = query
        if oracle is not None:
            ORACLE[name] = oracle
        return query

    return keep


# What the reports of a family read of the flat table: attributes by key, or by label.
_BY_KEY = ("keys", "keys_last")
_BY_LABEL = ("labels",)
_BY_LAST_LABEL = ("labels_last",)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- attributes, straight from the JSON ---------------------------------------------------------

_ALL = f"""
SELECT k AS id, status, status_last, status_key, closing_text, client, tc, billing FROM deal
UNION ALL SELECT id, 'AGENT ACCOUNT', 'AGENT ACCOUNT', 'AGENT ACCOUNT', NULL, NULL, NULL, NULL FROM agent_row
"""


@register("attr_first", sql.with_agents(f"SELECT id, status AS contract_status, closing_text AS closing_date FROM ({_ALL})"))
def attr_first(spark, sf_dir):
    return extract(inputs.raw(spark, sf_dir).select("id", "field_values"), ["contract_status", "closing_date"])


@register(
    "attr_last",
    sql.with_agents(
        "SELECT id, closing_text AS closing_date, status_key AS contract_status, "
        f"coalesce(status_key = 'CTC - Closed - PAID', FALSE) AS is_closed_paid FROM ({_ALL})"
    ),
)
def attr_last(spark, sf_dir):
    raw = inputs.raw(spark, sf_dir).select("id", "field_values")
    found = extract(raw, ["closing_date", "contract_status"], keep="last")
    return found.withColumn("is_closed_paid", equals_flag(F.col("contract_status"), fixed.CTC_CLOSED_PAID))


_DISCOVERED = list(dict.fromkeys([*sql._LABEL_COLUMN, *sql._AGENT_COLUMN]))


def _wide_sql(status: str) -> str:
    def cell(label: str, side: dict[str, str]) -> str:
        return f"CAST({side.get(label, 'NULL')} AS VARCHAR) AS \"{label}\""

    deal_side = {**sql._LABEL_COLUMN, "Closing": "closing_text", "Contract Status": status}
    of_deals = ", ".join(cell(label, deal_side) for label in _DISCOVERED)
    of_agents = ", ".join(cell(label, sql._AGENT_COLUMN) for label in _DISCOVERED)
    return sql.with_agents(
        f"SELECT k AS id, {of_deals} FROM deal UNION ALL SELECT id, {of_agents} FROM agent_row"
    )


@register("attr_wide_first", _wide_sql("status"))
def attr_wide_first(spark, sf_dir):
    return extract(inputs.raw(spark, sf_dir).select("id", "field_values"), _DISCOVERED, by="label")


@register("attr_wide_last", _wide_sql("status_last"))
def attr_wide_last(spark, sf_dir):
    raw = inputs.raw(spark, sf_dir).select("id", "field_values")
    return extract(raw, _DISCOVERED, by="label", keep="last", require_value=True)


@register("attr_discover", _wide_sql("status_last"))
def attr_discover(spark, sf_dir):
    return wide_discovered(inputs.raw(spark, sf_dir).select("id", "field_values"))


@register("attr_unreadable", sql.with_deals("SELECT count(*) AS rejected FROM deal WHERE (k % 101 = 0 OR k % 107 = 0) AND k % 103 <> 0"))
def attr_unreadable(spark, sf_dir):
    return unreadable(inputs.raw(spark, sf_dir))


@register(
    "dates_rejected",
    sql.with_deals(
        "SELECT 'closing_date' AS \"column\", count(CASE WHEN closing_text = 'TBD' THEN 1 END) AS rejected FROM deal "
        "UNION ALL SELECT unnest(['ctc_started_with_empower', 'listing_started_with_empower', 'listing_paid_date', "
        "'compliance_started_with_empower', 'compliance_paid_date']), 0"
    ),
)
def dates_rejected(spark, sf_dir):
    dates = [k for k in fixed.ATTRIBUTE_KEYS if k not in ("contract_status", "contract_client_type")]
    return cal.rejected_dates(extract(inputs.raw(spark, sf_dir), dates), dates)


@register(
    "json_attribute_of_events",
    "SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL",
)
def json_attribute_of_events(spark, sf_dir):
    value = F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint")
    return _table(spark, sf_dir, "events").groupBy("event_type", value.alias("k")).agg(F.count("*").alias("n"))


# --- calendar -----------------------------------------------------------------------------------


@register(
    "calendar_columns",
    """
SELECT o_orderkey,
  CASE WHEN day(o_orderdate) <= 15 THEN date_trunc('month', o_orderdate) ELSE date_trunc('month', o_orderdate) + INTERVAL 15 DAY END AS half_start,
  CASE WHEN day(o_orderdate) <= 15 THEN CAST(date_trunc('month', o_orderdate) + INTERVAL 14 DAY AS TIMESTAMP)
    ELSE CAST(last_day(o_orderdate) AS TIMESTAMP) END + INTERVAL '23:59:59' AS half_end,
  CAST(last_day(o_orderdate) AS TIMESTAMP) + INTERVAL '23:59:59' AS month_end,
  CAST(last_day(date_trunc('month', o_orderdate) + INTERVAL 1 MONTH) AS TIMESTAMP) AS next_month_end,
  upper(strftime(o_orderdate, '%B %Y')) AS long_label, strftime(o_orderdate, '%b %Y') AS short_label,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS parsed_label
FROM (SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS m, CAST(o_orderdate AS TIMESTAMP) AS o_orderdate FROM orders)
""",
)
def calendar_columns(spark, sf_dir):
    date = "o_orderdate"
    return _table(spark, sf_dir, "orders").select(
        "o_orderkey",
        cal.half_month_start(date).alias("half_start"),
        cal.half_month_end(date).alias("half_end"),
        cal.month_end(date).alias("month_end"),
        cal.next_month_end(date).alias("next_month_end"),
        cal.long_month_label(date).alias("long_label"),
        cal.short_month_label(date).alias("short_label"),
        cal.parse_month_label(f"upper(date_format({date}, 'MMMM yyyy'))").alias("parsed_label"),
    )


# --- monthly counts -----------------------------------------------------------------------------


@register("kpi_ctc_closing", sql.kpi_long([4]))
def kpi_ctc_closing(spark, sf_dir):
    """Straight from the JSON in one job, reading only the attributes of this count."""
    spec = FlatSpec(keys=["contract_status", "closing_date"], key_dates=["closing_date"])
    flat = flatten(inputs.raw(spark, sf_dir).select("team_name", "field_values"), spec)
    return kpis.monthly_kpis(flat, d.AS_OF, TEAMS, [k for k in kpis.KPIS if k.kpi == 4])


@register("kpi_long", sql.kpi_long())
def kpi_long(spark, sf_dir):
    return kpis.monthly_kpis(inputs.flat(spark, sf_dir, *_BY_KEY), d.AS_OF, TEAMS)


@register("kpi_wide", sql.kpi_wide())
def kpi_wide(spark, sf_dir):
    return kpis.kpis_wide(kpi_long(spark, sf_dir), d.AS_OF)


@register("kpi_next_month", sql.kpi_long([16, 17]))
def kpi_next_month(spark, sf_dir):
    return kpis.monthly_kpis(
        inputs.flat(spark, sf_dir, *_BY_KEY), d.AS_OF, TEAMS, [k for k in kpis.KPIS if k.rule == "next"]
    )


@register("kpi_rest_of_year", sql.kpi_long([18, 19]))
def kpi_rest_of_year(spark, sf_dir):
    return kpis.monthly_kpis(
        inputs.flat(spark, sf_dir, *_BY_KEY), d.AS_OF, TEAMS, [k for k in kpis.KPIS if k.rule == "rest"]
    )


_JSON_MONTHS = ", ".join(f"'{m} 2000', \"{m} 2000\"" for m in "Jan Feb Mar Apr May Jun Jul Aug Sep Oct".split())


@register("kpi_incremental", sql.kpi_long())
def kpi_incremental(spark, sf_dir):
    """The counts after three batches: records arrive, change, go and come back; the last state is the flat table."""
    root, flat = scratch_path(spark, "kept-counts"), inputs.flat(spark, sf_dir, *_BY_KEY)
    wrong = F.when(F.col("id") % 2 == 0, F.lit("CTC - Pending")).otherwise(F.lit("CTC - Closed - PAID"))
    later = lambda side, c: F.col(side).withField(c, F.expr(f"{side}.{c} + INTERVAL 40 DAY"))
    changed = flat.where("id % 5 = 0")
    before = changed.withColumn("keys", F.col("keys").withField("contract_status", wrong))
    before = before.withColumn("keys", later("keys", "closing_date")).withColumn("keys_last", later("keys_last", "closing_date"))
    batches = [
        flat.where("id % 3 < 2 AND id % 5 <> 0").unionByName(before),
        flat.where("id % 3 = 2 AND id % 5 <> 0").unionByName(changed).withColumn("deleted", F.expr("id % 7 = 0")),
        flat.where("id % 7 = 0"),
    ]
    for number, batch in enumerate(batches):
        increments.apply_changes(spark, root, batch, TEAMS, number, buckets=8)
    return increments.kept_kpis(spark, root, d.AS_OF)


@register(
    "kpi_summary_json",
    f"SELECT kpi, CAST(json_object('state', state, {_JSON_MONTHS}) AS VARCHAR) AS summary FROM ({sql.kpi_wide()})",
)
def kpi_summary_json(spark, sf_dir):
    return kpis.kpi_summary_json(kpi_wide(spark, sf_dir))


@register("status_catalogue", sql.with_agents(
    f"SELECT DISTINCT status AS contract_status FROM ({_ALL}) WHERE status IS NOT NULL"
))
def statuses(spark, sf_dir):
    return status_catalogue(inputs.flat(spark, sf_dir))


# --- extracts -----------------------------------------------------------------------------------


def _extract(name: str, **options) -> Query:
    return lambda spark, sf_dir: extracts.extract_rows(
        inputs.flat(spark, sf_dir, *_BY_KEY), extracts.EXTRACTS[name], d.AS_OF, TEAMS, **options
    )


for _name in extracts.EXTRACTS:
    register(f"extract_{_name}", sql.extract(_name))(_extract(_name))
    register(f"extract_{_name}_by_clock", sql.extract(_name, "clock"))(_extract(_name, bounds="clock"))

register(
    "extract_closed_with_status",
    sql.extract("closed", require_status=fixed.CTC_CLOSED_PAID),
)(_extract("closed", require_status=fixed.CTC_CLOSED_PAID))


@register("extract_all", sql.all_extracts())
def extract_all(spark, sf_dir):
    return extracts.all_extracts(inputs.flat(spark, sf_dir, *_BY_KEY), d.AS_OF, TEAMS)


@register("extract_closed_halves", sql.closed_halves())
def closed_halves(spark, sf_dir):
    return extracts.closed_halves(inputs.flat(spark, sf_dir, *_BY_KEY), d.AS_OF, TEAMS)


# --- staging ------------------------------------------------------------------------------------


@register("stage_curated", sql.stage_curated())
def stage_curated(spark, sf_dir):
    return staging.curated_transactions(inputs.flat(spark, sf_dir, *_BY_LAST_LABEL), cutover_year=d.CUTOVER_YEAR)


@register("stage_errors", sql.stage_errors())
def stage_errors(spark, sf_dir):
    return staging.error_transactions(inputs.flat(spark, sf_dir, *_BY_LAST_LABEL))


@register("stage_agents", sql.stage_agents())
def stage_agents(spark, sf_dir):
    return staging.agent_accounts(inputs.flat(spark, sf_dir, *_BY_LAST_LABEL))


@register("stage_agent_duplicates", sql.stage_agent_duplicates())
def stage_agent_duplicates(spark, sf_dir):
    return staging.duplicate_agent_accounts(inputs.flat(spark, sf_dir, *_BY_LAST_LABEL))


def _typed(spark, sf_dir) -> DataFrame:
    """Transactions with dates typed and the billing status filled, before any rule."""
    rows = staging.transactions(inputs.flat(spark, sf_dir))
    dates = [c for c in fixed.DATE_COLUMNS if c in rows.columns]
    return col.fill_blank(col.to_dates(rows, dates), ["Billing Status"], "none")


_DEAL_ROWS = "SELECT {} FROM deal"


@register(
    "rule_empty_closing",
    sql.with_deals(
        f"SELECT title AS \"Contract Title\", status_last AS \"Contract Status\", "
        f"CAST({sql._CLOSING_KEPT} AS TIMESTAMP) AS \"Closing\" FROM deal"
    ),
)
def rule_empty_closing(spark, sf_dir):
    return col.in_order(
        corrections.empty_closing(_typed(spark, sf_dir)), ["Contract Title", "Contract Status", "Closing"]
    )


@register(
    "rule_empty_listing",
    sql.with_deals(
        f"SELECT title AS \"Contract Title\", "
        f"CAST(CASE WHEN {sql._BOTH_LATE} THEN NULL ELSE listing_started END AS TIMESTAMP) AS \"Listing Started with Empower\", "
        f"CAST(CASE WHEN {sql._BOTH_LATE} THEN NULL ELSE listing_paid END AS TIMESTAMP) AS \"Listing PAID Date\", "
        f"CAST(CASE WHEN {sql._BOTH_LATE} THEN NULL ELSE live_on_mls END AS TIMESTAMP) AS \"Live on MLS Date\", "
        f"CASE WHEN {sql._BOTH_LATE} THEN '0' ELSE listing_amount END AS \"Listing PAID Amount\" FROM deal"
    ),
)
def rule_empty_listing(spark, sf_dir):
    ruled = corrections.empty_listing(_typed(spark, sf_dir), d.CUTOVER_YEAR, zero_listing_amount=True)
    return col.in_order(
        ruled,
        ["Contract Title", "Listing Started with Empower", "Listing PAID Date", "Live on MLS Date", "Listing PAID Amount"],
    )


@register(
    "rule_override_status",
    sql.with_deals(
        "SELECT title AS \"Contract Title\", coalesce(billing_status, status_last) AS \"Contract Status\" FROM deal"
    ),
)
def rule_override_status(spark, sf_dir):
    return col.in_order(
        corrections.override_status(_typed(spark, sf_dir)), ["Contract Title", "Contract Status"]
    )


@register(
    "rule_billing_amount",
    sql.with_deals(
        f"SELECT title AS \"Contract Title\", CAST({sql._CLOSING_KEPT} AS TIMESTAMP) AS \"Closing\", "
        f"{sql._BILLING} AS \"Billing Amount\" FROM deal"
    ),
)
def rule_billing_amount(spark, sf_dir):
    ruled = corrections.correct_billing(corrections.empty_closing(_typed(spark, sf_dir)))
    return col.in_order(ruled, ["Contract Title", "Closing", "Billing Amount"])


def _titles(condition: str) -> str:
    return sql.with_deals(f"SELECT title AS \"Contract Title\", tc AS \"Empower TC Name\", agent AS \"Empower Agent Name\" FROM deal WHERE {condition}")


_TITLES = ["Contract Title", "Empower TC Name", "Empower Agent Name"]


@register("exclude_titles", _titles(f"NOT ({sql._EXCLUDED})"))
def exclude_titles(spark, sf_dir):
    rows = staging.transactions(inputs.flat(spark, sf_dir))
    return col.in_order(rows.where(~filters.title_is_excluded("`Contract Title`")), _TITLES)


@register("exclude_never_started_coordinator", _titles(f"NOT (coalesce(tc, '') = '' AND {sql._NEVER})"))
def exclude_never_started_coordinator(spark, sf_dir):
    return col.in_order(_typed(spark, sf_dir).where(~filters.never_started("`Empower TC Name`")), _TITLES)


@register("exclude_never_started_agent", _titles(f"NOT (coalesce(agent, '') = '' AND {sql._NEVER})"))
def exclude_never_started_agent(spark, sf_dir):
    return col.in_order(_typed(spark, sf_dir).where(~filters.never_started("`Empower Agent Name`")), _TITLES)


# --- payroll ------------------------------------------------------------------------------------


def _enriched(spark, sf_dir) -> DataFrame:
    return payroll.enrich(inputs.flat(spark, sf_dir, *_BY_LABEL))


register("payroll_enriched", sql.payroll_enriched())(_enriched)
for _name, _mode in (("projected", "p"), ("actual", "a")):
    register(f"payroll_cube_{_name}", sql.payroll_cells(_mode))(
        lambda spark, sf_dir, mode=_mode: payroll.payroll_cells(_enriched(spark, sf_dir), mode, d.COORDINATORS)
    )
    register(f"payroll_{_name}", sql.payroll_matrix(_mode))(
        lambda spark, sf_dir, mode=_mode: payroll.matrix_cells(
            payroll.payroll_matrix(_enriched(spark, sf_dir), mode, d.COORDINATORS)
        )
    )

# --- daily update -------------------------------------------------------------------------------

for _scope in ("period", "all"):
    register(f"daily_update_{_scope}_scope", sql.daily_update(_scope))(
        lambda spark, sf_dir, scope=_scope: daily.daily_update(inputs.flat(spark, sf_dir), d.YEAR, d.AS_OF, scope)
    )

# --- lists from files ---------------------------------------------------------------------------


@register(
    "team_list_members",
    sql.with_agents(
        "SELECT id, team_name FROM (SELECT k AS id, team_name FROM deal UNION ALL SELECT id, team_name FROM agent_row) "
        f"WHERE team_name IN {sql._in(d.PREFERRED_TEAMS)}"
    ),
)
def team_list_members(spark, sf_dir):
    """Rows of the teams in a list file; here the file holds the teams of eleven nations."""
    path = scratch_path(spark, "teams")
    nations = _table(spark, sf_dir, "nation").where("n_nationkey BETWEEN 5 AND 15")
    nations.selectExpr("concat('Team ', n_name) AS name").write.csv(path)
    rows = inputs.flat(spark, sf_dir).select("id", "team_name")
    return filters.member_of(rows, "team_name", read_list(spark, path))


@register(
    "agent_list_join",
    sql.with_agents(
        'SELECT deal.title AS "Contract Title", deal.agent AS "Empower Agent Name" '
        "FROM deal LEFT JOIN agent_row ON deal.agent = agent_row.title"
    ),
)
def agent_list_join(spark, sf_dir):
    """The join to an agent list in CSV: repeated titles repeat the deal, rows without a title name nobody."""
    path = scratch_path(spark, "agents")
    flat = inputs.flat(spark, sf_dir, *_BY_LAST_LABEL)
    agents = staging.agent_rows(flat, ["Contract Title", "Brokerage", "Agent Provided by"])
    agents.select(F.col("`Contract Title`").alias("Title"), "Brokerage", "`Agent Provided by`").write.option(
        "header", True
    ).csv(path)
    deals = staging.transactions(flat, ["Contract Title", "Empower Agent Name"])
    listed = read_csv_columns(spark, path, ["Title", "Agent Provided by"])
    return col.in_order(matching.with_agent_list(deals, listed), ["Contract Title", "Empower Agent Name"])


# --- ingest and sinks ---------------------------------------------------------------------------


def _write_pages(spark, sf_dir) -> str:
    """The raw records as a paged API gives them: nested lists, numbers as text, some of them no numbers.

    Compressed, as an API sends them: the text is many times the tables it is made of. A compressed file is read by
    one task, so it must stay small; it has the rows of one task of ``sources.deals``.
    """
    path = scratch_path(spark, "pages")
    rest = inputs.raw(spark, sf_dir).withColumns(
        {
            "team_user_id": F.expr("concat(team_user_id, '.0')"),
            "agent_id": F.expr("CASE WHEN agent_id % 5 = 0 THEN 'none' ELSE CAST(agent_id AS STRING) END"),
        }
    )
    others = ", ".join(c for c in rest.columns if c != "field_values")
    items = "CASE WHEN field_values LIKE '[%]' THEN field_values ELSE 'null' END"
    record = f"concat('{{\"field_values\":', {items}, ',', substr(to_json(struct({others})), 2))"
    rest.selectExpr(f"{record} AS value").write.option("compression", "gzip").text(path)
    return path


_INGESTED = sql.with_agents(
    "SELECT id, created, timezone, team_id, team_name, team_user_id, team_user_name, agent_id, agent_name, "
    "brokerage, api_data, inbound_email_address, contract_status FROM ("
    f"SELECT k AS id, {sql._CREATED} AS created, {sql._SYSTEM.replace('c_custkey AS agent_id', 'CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS agent_id')}, status AS contract_status FROM deal "
    f"UNION ALL SELECT id, {sql._CREATED}, {sql._SYSTEM.replace('c_custkey AS agent_id', 'CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey END AS agent_id').replace('|| k ||', '|| id ||')}, 'AGENT ACCOUNT' FROM agent_row)"
)


@register("ingest_typed", _INGESTED)
def ingest_typed(spark, sf_dir):
    out = scratch_path(spark, "properties")
    ingest.land(spark, _write_pages(spark, sf_dir), out)
    return extract(read_properties(spark, out), ["contract_status"])


@register("ingest_stream", _INGESTED)
def ingest_stream(spark, sf_dir):
    out = scratch_path(spark, "properties-stream")
    query = land_stream(spark, _write_pages(spark, sf_dir), out, scratch_path(spark, "stream-checkpoint"))
    query.awaitTermination()
    return extract(read_properties(spark, out), ["contract_status"])


# Two dumps of the orders. The second has changed records, the same ones again, late older versions, deletions
# and records that are new; a tenth is in the second only, three quarters are in both.
_DUMPS = """
WITH k AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS d FROM orders),
versions AS (
  SELECT id, d AS updated, 'first' AS team_name, FALSE AS deleted FROM k WHERE id % 10 <> 9
  UNION ALL SELECT id, d + 5, 'changed', FALSE FROM k WHERE id % 4 = 1 AND id % 28 <> 5
  UNION ALL SELECT id, d, 'first', FALSE FROM k WHERE id % 4 = 2
  UNION ALL SELECT id, d - 5, 'late', FALSE FROM k WHERE id % 4 = 3
  UNION ALL SELECT id, d + 9, 'gone', TRUE FROM k WHERE id % 28 = 5)
SELECT id, arg_max(team_name, updated) AS team_name, CAST(max(updated) AS VARCHAR) AS created
FROM versions GROUP BY id HAVING NOT arg_max(deleted, updated)
"""


def _write_dump(spark, sf_dir, path: str, cases: dict[str, tuple[str, int, str]]) -> None:
    """A page of the orders for which a condition holds: (team name, days, whether deleted) by condition."""
    orders = _table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "CAST(o_orderdate AS DATE) AS d")
    for condition, (name, days, deleted) in cases.items():
        rows = orders.where(condition).selectExpr(
            "id", f"'{name}' AS team_name", f"CAST(d + {days} AS STRING) AS created", f"CAST(d + {days} AS STRING) AS updated",
            f"'{deleted}' AS deleted",
        )
        rows.write.mode("append").json(path)


@register("ingest_refreshed", _DUMPS)
def ingest_refreshed(spark, sf_dir):
    """Two dumps by two runs of the stream; the second replaces, repeats, deletes and adds records."""
    pages, out, check = (scratch_path(spark, n) for n in ("dumps", "refreshed", "refresh-checkpoint"))
    _write_dump(spark, sf_dir, pages, {"id % 10 <> 9": ("first", 0, "false")})
    refresh.refresh_stream(spark, pages, out, check, buckets=8).awaitTermination()
    second = {
        "id % 4 = 1 AND id % 28 <> 5": ("changed", 5, "false"), "id % 4 = 2": ("first", 0, "false"),
        "id % 4 = 3": ("late", -5, "false"), "id % 28 = 5": ("gone", 9, "true"),
    }
    _write_dump(spark, sf_dir, pages, second)
    refresh.refresh_stream(spark, pages, out, check, buckets=8).awaitTermination()
    return refresh.read_refreshed(spark, out).select("id", "team_name", "created")


@register(
    "ingest_agents",
    """
SELECT c_custkey AS id, c_name AS name,
  CAST(json_object('segment', c_mktsegment, 'nations', [c_nationkey]) AS VARCHAR) AS details FROM customer
""",
)
def ingest_agents(spark, sf_dir):
    pages, out = scratch_path(spark, "agent-pages"), scratch_path(spark, "agents-landed")
    details = F.struct(F.col("c_mktsegment").alias("segment"), F.array("c_nationkey").alias("nations"))
    records = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), details.alias("details")
    )
    records.write.json(pages)
    ingest.land_agents(spark, pages, out, records.schema)
    return spark.read.parquet(out)


@register("sink_roundtrip", sql.kpi_wide())
def sink_roundtrip(spark, sf_dir):
    paths = reports.write_report(
        {"Overview": kpi_wide(spark, sf_dir)}, scratch_path(spark, "reports"), "monthly_counts"
    )
    return spark.read.parquet(paths["Overview"])


def _csv(spark, path: str, columns: list[str]) -> DataFrame:
    return spark.read.option("header", True).option("escape", '"').csv(path).select(*columns)


def _csv_sql(rows: str, numbers: str = "id, team_id, team_user_id, agent_id", flags: str = "") -> str:
    """All columns as the CSV shows them: numbers as text, flags capitalised, no value as NULL again."""
    texts = [f"CAST({n} AS VARCHAR) AS {n}" for n in numbers.split(", ")]
    texts += [f"CASE {f} WHEN TRUE THEN 'True' WHEN FALSE THEN 'False' END AS {f}" for f in flags.split()]
    return f"SELECT * REPLACE ({', '.join(texts)}) FROM ({rows})"


@register("sink_csv_roundtrip", _csv_sql(sql.extract("preferred_seller")))
def sink_csv_roundtrip(spark, sf_dir):
    path = scratch_path(spark, "extract")
    rows = QUERIES["extract_preferred_seller"](spark, sf_dir)
    reports.write_extract(rows, path)
    return _csv(spark, path, rows.columns)


@register("sink_empty_extract", _csv_sql(f"SELECT * FROM ({sql.extract('preferred_seller')}) WHERE id < 0"))
def sink_empty_extract(spark, sf_dir):
    """An extract without rows: the sheet has its header, and the writer says so."""
    path = scratch_path(spark, "extract")
    rows = QUERIES["extract_preferred_seller"](spark, sf_dir).where("id < 0")
    if reports.write_extract(rows, path):
        raise AssertionError("rows in an empty extract")
    return _csv(spark, path, rows.columns)


@register("sink_sheet_replaced", _csv_sql(sql.extract("current_month")))
def sink_sheet_replaced(spark, sf_dir):
    """A sheet that is written over another one, all cells rendered."""
    path = reports.sheet_path(scratch_path(spark, "sheets"), "closings", "Current")
    reports.write_sheet(QUERIES["extract_closed"](spark, sf_dir), path, fmt="csv")
    rows = QUERIES["extract_current_month"](spark, sf_dir)
    reports.write_sheet(rows, path, fmt="csv")
    return _csv(spark, path, rows.columns)


_SHEETS = ("closed", "current_month", "preferred_seller")


@register(
    "sink_workbook",
    "\nUNION ALL\n".join(f"SELECT '{n}' AS sheet, id, team_name FROM ({sql.extract(n)})" for n in _SHEETS),
)
def sink_workbook(spark, sf_dir):
    """A workbook of three sheets, published twice; the sheets as the second version's manifest names them."""
    root = scratch_path(spark, "published")
    frames = {n: QUERIES[f"extract_{n}"](spark, sf_dir).select("id", "team_name") for n in _SHEETS}
    swapped = dict(zip(_SHEETS, [frames[n] for n in reversed(_SHEETS)]))
    for version in (swapped, frames):
        manifest.publish(spark, root, "extracts", lambda top, v=version: reports.write_report(v, top, "extracts"))
    found = manifest.sheets(spark, root, "extracts")
    return reduce(DataFrame.unionByName, [spark.read.parquet(p).select(F.lit(t).alias("sheet"), "*") for t, p in found.items()])


@register(
    "sink_plain_csv",
    "SELECT CAST(n_nationkey AS VARCHAR) AS n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey FROM nation",
)
def sink_plain_csv(spark, sf_dir):
    path = scratch_path(spark, "plain")
    rows = _table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reports.write_csv(rows, path)
    return _csv(spark, path, rows.columns)


@register("sink_all_extracts", _csv_sql(sql.all_extracts(), flags="is_closed_paid"))
def sink_all_extracts(spark, sf_dir):
    """The scheduled extracts, read back from their folders."""
    paths = workbooks.write_extracts(inputs.flat(spark, sf_dir), scratch_path(spark, "workbooks"), d.AS_OF, TEAMS)
    rows = spark.read.parquet(paths["extracts"])
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns])


@register("sink_per_team", _csv_sql(sql.closed_halves(), flags="is_closed_paid"))
def sink_per_team(spark, sf_dir):
    """Last month's closings, a folder for each half and team, read back."""
    path = workbooks.write_closed_halves(inputs.flat(spark, sf_dir), scratch_path(spark, "workbooks"), d.AS_OF, TEAMS)
    rows = spark.read.parquet(path)
    return rows.select(*[F.nullif(F.col(c), F.lit("")).alias(c) for c in rows.columns])


@register("sink_per_month", f'SELECT * EXCLUDE (month) RENAME (period AS sheet) FROM ({sql.daily_update("period")})')
def sink_per_month(spark, sf_dir):
    root = scratch_path(spark, "workbooks")
    return spark.read.parquet(workbooks.write_daily_update(inputs.flat(spark, sf_dir), root, d.YEAR, d.AS_OF))


@register(
    "stage_newest_first",
    sql.with_agents(
        'SELECT created AS "Date Created", count(*) AS n, row_number() OVER (ORDER BY created DESC) AS place '
        "FROM agent_account GROUP BY created"
    ),
)
def stage_newest_first(spark, sf_dir):
    """The agent accounts as the sheet has them: at which place each date comes."""
    rows = staging.newest_first(staging.agent_accounts(inputs.flat(spark, sf_dir), ["Contract Title"]))
    placed = rows.withColumn("at", F.monotonically_increasing_id())
    dates = placed.groupBy("Date Created").agg(F.count("*").alias("n"), F.min("at").alias("at"))
    # a row for each date; a date that came in two places would stand before one it is older than
    return dates.withColumn("place", F.row_number().over(Window.orderBy("at"))).drop("at")


@register(
    "periods_of_year",
    f"""
SELECT upper(strftime(m, '%B %Y')) AS period, CAST(m AS TIMESTAMP) AS period_start,
  CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) - INTERVAL 1 SECOND AS period_end,
  CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) AS next_start,
  CAST(m + INTERVAL 2 MONTH AS TIMESTAMP) - INTERVAL 1 SECOND AS next_end,
  greatest(CAST(m + INTERVAL 1 MONTH AS TIMESTAMP) - INTERVAL 1 SECOND, {sql.AS_OF}) AS current_end
FROM ({sql.with_deals("SELECT DISTINCT date_trunc('month', started) AS m FROM deal WHERE started IS NOT NULL")})
""",
)
def periods_of_year(spark, sf_dir):
    """The months with a contract start, each expanded to its bounds."""
    starts = inputs.flat(spark, sf_dir).select(F.expr(cal.date_sql("labels.`CTC Started with Empower`")).alias("start"))
    months = starts.select(cal.month_start("start").alias("period_start")).na.drop().distinct()
    return cal.expanded(months, d.AS_OF)


@register(
    "render_cells",
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts,
  coalesce(CAST(user_id AS VARCHAR), '') AS user_id, coalesce(replace(props, chr(10), ' '), '') AS props,
  coalesce(event_type, '') AS event_type FROM events
""",
)
def render_cells(spark, sf_dir):
    return render.render_on_one_line(_table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "props", "event_type"))


# --- the operators on other tables --------------------------------------------------------------




def _order_hits(spark, sf_dir) -> DataFrame:
    orders = _table(spark, sf_dir, "orders").where(cal.in_year("o_orderdate", 2000))
    return orders.select(F.col("o_orderstatus").alias("status"), counting.month_of("o_orderdate").alias("month"))


def _order_statuses(spark) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(F.lit("F"), F.lit("O"), F.lit("P"))).alias("status"))


_ORDER_SPINE = """
SELECT s.status, CAST(m.range AS DATE) AS month, (SELECT count(*) FROM orders WHERE o_orderstatus = s.status
  AND year(o_orderdate) = 2000 AND date_trunc('month', o_orderdate) {} m.range) AS n
FROM (SELECT unnest(['F', 'O', 'P']) AS status) s
CROSS JOIN range(DATE '2000-01-01', DATE '2001-01-01', INTERVAL 1 MONTH) m
"""


@register("orders_per_month", _ORDER_SPINE.format("="))
def orders_per_month(spark, sf_dir):
    return counting.counts_on_spine(_order_hits(spark, sf_dir), _order_statuses(spark), cal.months_of_year(2000))


@register("orders_rest_of_year", _ORDER_SPINE.format(">"))
def orders_rest_of_year(spark, sf_dir):
    return orders_per_month(spark, sf_dir).withColumn("n", counting.later_months("status"))


_NATIONS = """
SELECT CASE WHEN grouping(n_name) = 1 THEN 'Total Result' ELSE n_name END AS n_name,
  CASE WHEN grouping(half) = 1 THEN 'Total Result' ELSE half END AS half, CAST(sum(price) AS DECIMAL(18,2)) AS amount
FROM (
  SELECT n_name, CAST(o_totalprice AS DECIMAL(18,2)) AS price, strftime(o_orderdate, '%Y/%m/') ||
    CASE WHEN day(o_orderdate) <= 15 THEN '01 - ' || strftime(o_orderdate, '%Y/%m/15')
    ELSE '16 - ' || strftime(last_day(o_orderdate), '%Y/%m/%d') END AS half
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)
GROUP BY CUBE (n_name, half)
"""


@register("orders_half_month_totals", _NATIONS)
def orders_half_month_totals(spark, sf_dir):
    orders = _table(spark, sf_dir, "orders")
    customer, nation = _table(spark, sf_dir, "customer"), _table(spark, sf_dir, "nation")
    rows = (
        orders.join(customer, orders.o_custkey == customer.c_custkey)
        .join(nation, customer.c_nationkey == nation.n_nationkey)
        .select(
            "n_name",
            cal.half_month_label("o_orderdate").alias("half"),
            F.col("o_totalprice").cast(col.MONEY).alias("price"),
        )
    )
    return counting.cells_with_totals(rows, "n_name", "half", "price")


_EVENTS = "SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS rn FROM events"


@register("newest_event_per_user", f"SELECT * EXCLUDE (rn) FROM ({_EVENTS}) WHERE rn = 1")
def newest_event_per_user(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return matching.newest_per(events, "user_id", "ts", "event_id")


@register("older_events_per_user", f"SELECT * EXCLUDE (rn) FROM ({_EVENTS}) WHERE rn > 1")
def older_events_per_user(spark, sf_dir):
    events = _table(spark, sf_dir, "events")
    return matching.duplicates_of_newest(events, "user_id", "ts", "event_id")


@register(
    "labelled_documents",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id",
)
def labelled_documents(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    return matching.only_matched(documents, _table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@register(
    "unlabelled_documents",
    "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def unlabelled_documents(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id", "lang")
    return matching.only_unmatched(documents, _table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@register(
    "documents_with_match_flag",
    "SELECT d.doc_id, l.quality, l.toxic, l.doc_id IS NOT NULL AS matched FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def documents_with_match_flag(spark, sf_dir):
    documents = _table(spark, sf_dir, "documents").select("doc_id")
    return matching.left_match(documents, _table(spark, sf_dir, "labels"), "doc_id", "doc_id")


@register("label_types", sql.label_types())
def label_types(spark, sf_dir):
    """The type of every label, from the classes of its values; two batches whose counts are added up."""
    raw = inputs.raw(spark, sf_dir).select("id", "field_values")
    batches = [class_counts(parse_once(raw.where(f"id % 2 = {k}"), names=["label"], mark_values=False)) for k in (0, 1)]
    return types_of(add_up(*batches))


# Statuses in use against the list of the daily update, and agents of deals without an account against the accounts.
_SPELLED = """
nearest AS (
  SELECT kind, value, name, levenshtein(value, name) AS distance FROM wanted JOIN listed USING (kind)
  WHERE levenshtein(value, name) <= 2
  QUALIFY row_number() OVER (PARTITION BY kind, value ORDER BY levenshtein(value, name), name) = 1)
SELECT kind, value, n.name AS nearest, CAST(n.distance AS INTEGER) AS distance
FROM wanted LEFT JOIN nearest n USING (kind, value)
"""
_LISTED_STATUSES = [
    "CTC - Pending", "CTC - Closed - PAID", "CTC - PAID", "CTC - Terminated - No Charge", "Listing - PAID", "Compliance - PAD",
    "Compliance  - Ready to BILL", "CTC - Preferred - Withdrawm",
]


@register(
    "nearest_spelling",
    sql.with_agents("").rstrip() + f""",
listed AS (
  SELECT DISTINCT 'agent' AS kind, title AS name FROM agent_row WHERE title IS NOT NULL
  UNION ALL SELECT 'status', unnest({_LISTED_STATUSES})),
wanted AS (
  SELECT DISTINCT 'agent' AS kind, agent AS value FROM deal
  WHERE agent IS NOT NULL AND agent NOT IN (SELECT title FROM agent_row WHERE title IS NOT NULL)
  UNION ALL SELECT DISTINCT 'status', status FROM deal WHERE status IS NOT NULL),
{_SPELLED}""",
)
def nearest_spelling(spark, sf_dir):
    """The nearest listed status of every status, and the nearest account of every agent without one."""
    flat = inputs.flat(spark, sf_dir)
    accounts = flat.where(filters.is_value("labels_last.`Contract Status`", fixed.AGENT_ACCOUNT))
    agents = accounts.selectExpr("labels_last.`Contract Title` AS title")
    deals_of = flat.where(filters.is_not_value("labels_last.`Contract Status`", fixed.AGENT_ACCOUNT))
    names = deals_of.selectExpr("labels.`Empower Agent Name` AS agent").distinct()
    missing = matching.only_unmatched(names, agents, "agent", "title")
    statuses = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in _LISTED_STATUSES])).alias("name"))
    found = {
        "agent": spelling.nearest_in_list(missing, "agent", agents, "title"),
        "status": spelling.nearest_in_list(deals_of.selectExpr("labels.`Contract Status` AS status"), "status", statuses),
    }
    return reduce(DataFrame.unionByName, [rows.withColumn("kind", F.lit(kind)) for kind, rows in found.items()])


_HISTORY = """
SELECT o_orderkey AS id, CAST(o_orderdate AS TIMESTAMP) AS updated, 'TC ' || (o_orderkey % 9) AS name, 'CTC - Pending' AS status
FROM orders
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY * (20 + o_orderkey % 60),
  CASE WHEN o_orderkey % 5 = 0 THEN 'TC ' || (o_orderkey % 4) ELSE 'TC ' || (o_orderkey % 9) END,
  CASE WHEN o_orderkey % 3 = 0 THEN 'CTC - Pending' ELSE 'CTC - Withdrawn' END
FROM orders WHERE o_orderkey % 7 <> 0
UNION ALL SELECT o_orderkey, CAST(o_orderdate AS TIMESTAMP) + INTERVAL 1 DAY * (100 + o_orderkey % 200), 'TC ' || (o_orderkey % 2),
  CASE WHEN o_orderkey % 2 = 0 THEN 'CTC - Withdrawn' ELSE 'CTC - Pending' END
FROM orders WHERE o_orderkey % 4 = 0
"""


def _history(spark, sf_dir) -> DataFrame:
    """Up to three versions of every order."""
    orders = _table(spark, sf_dir, "orders").selectExpr("o_orderkey AS id", "CAST(o_orderdate AS TIMESTAMP_NTZ) AS d")
    name = "concat('TC ', id % {})"
    later = "d + make_dt_interval(CAST({} AS INT))"
    return (
        orders.selectExpr("id", "d AS updated", f"{name.format(9)} AS name", "'CTC - Pending' AS status")
        .unionByName(orders.where("id % 7 <> 0").selectExpr(
            "id", f"{later.format('20 + id % 60')} AS updated",
            f"CASE WHEN id % 5 = 0 THEN {name.format(4)} ELSE {name.format(9)} END AS name",
            "CASE WHEN id % 3 = 0 THEN 'CTC - Pending' ELSE 'CTC - Withdrawn' END AS status",
        ))
        .unionByName(orders.where("id % 4 = 0").selectExpr(
            "id", f"{later.format('100 + id % 200')} AS updated", f"{name.format(2)} AS name",
            "CASE WHEN id % 2 = 0 THEN 'CTC - Withdrawn' ELSE 'CTC - Pending' END AS status",
        ))
    )


@register(
    "active_at_month_ends",
    f"""
WITH history AS ({_HISTORY}),
months AS (SELECT CAST(range AS DATE) AS month FROM range(DATE '1995-01-01', DATE '1997-01-01', INTERVAL 1 MONTH)),
held AS (
  SELECT id, name, status, month FROM history JOIN months ON updated < month + INTERVAL 1 MONTH
  QUALIFY row_number() OVER (PARTITION BY id, month ORDER BY updated DESC) = 1),
names AS (SELECT DISTINCT name FROM history WHERE status = 'CTC - Pending')
SELECT name, month, count(id) AS n FROM names CROSS JOIN months LEFT JOIN
  (SELECT * FROM held WHERE status = 'CTC - Pending') USING (name, month) GROUP BY name, month
""",
)
def active_at_month_ends(spark, sf_dir):
    months = [datetime(y, m, 1) for y in (1995, 1996) for m in range(1, 13)]
    return history.active_at_month_ends(_history(spark, sf_dir), months, ["CTC - Pending"])


@register(
    "state_as_of",
    f"""
WITH history AS ({_HISTORY}),
asked AS (
  SELECT l_orderkey AS id, CAST(l_shipdate AS TIMESTAMP) AS updated, l_linenumber FROM lineitem)
SELECT a.id, a.updated, a.l_linenumber, h.name, h.status
FROM asked a ASOF LEFT JOIN history h ON a.id = h.id AND a.updated >= h.updated
""",
)
def state_as_of(spark, sf_dir):
    """For every line of every order, the order's version when the line was shipped."""
    lines = _table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS id", "CAST(l_shipdate AS TIMESTAMP_NTZ) AS updated", "l_linenumber"
    )
    return as_of(lines, _history(spark, sf_dir), ["id"], "updated").select(
        "id", "updated", "l_linenumber", "version.name", "version.status"
    )


# Events arrive in three parts, up to four hours out of order; a window or session is written once it is closed.
_CLOSED = """
timed AS (SELECT *, CAST(round(value * 100) AS BIGINT) AS cents FROM events),
mark AS (SELECT max(ts) - INTERVAL 6 HOUR AS closed FROM events)
"""


def _closed_in_parts(spark, sf_dir, name: str, result: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What three runs of a stream write, each after a third of the month's events has arrived."""
    events = _table(spark, sf_dir, "events").selectExpr(
        "event_id", "user_id", "event_type", "CAST(ts AS TIMESTAMP) AS ts", "CAST(round(value * 100) AS BIGINT) AS cents"
    )
    arrival = "unix_timestamp(ts) + 3600 * (event_id % 5)"
    source, out, checkpoint = (scratch_path(spark, f"{name}-{kind}") for kind in ("events", "closed", "checkpoint"))
    first, last = events.selectExpr(f"min({arrival})", f"max({arrival})").first()
    part = F.expr(f"least(2, 3 * ({arrival} - {first}) div greatest(1, {last} - {first}))")
    for number in range(3):
        events.where(part == number).write.mode("append").parquet(source)
        stream = spark.readStream.schema(events.schema).parquet(source)
        activity.write_closed(result(stream), out, checkpoint).awaitTermination()
    closed = spark.read.parquet(out)
    return closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("start", "end")})


@register(
    "activity_windows",
    f"""
WITH {_CLOSED},
opened AS (
  SELECT event_type, cents, time_bucket(INTERVAL 3 HOUR, ts, TIMESTAMP '1970-01-01') - i * INTERVAL 3 HOUR AS "start"
  FROM timed, range(4) AS t(i))
SELECT event_type, "start", "start" + INTERVAL 12 HOUR AS "end", count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
FROM opened, mark WHERE "start" + INTERVAL 12 HOUR <= closed GROUP BY ALL
""",
)
def activity_windows(spark, sf_dir):
    """Events of twelve hours, every three hours."""
    sums = {"cents": F.col("cents")}
    return _closed_in_parts(
        spark, sf_dir, "windows",
        lambda events: activity.windows(events, "ts", ["event_type"], "12 hours", "3 hours", "6 hours", sums),
    )


@register(
    "activity_sessions",
    f"""
WITH {_CLOSED},
steps AS (
  SELECT *, coalesce(ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) > INTERVAL 4 HOUR, TRUE) AS opens FROM timed),
numbered AS (SELECT *, count_if(opens) OVER (PARTITION BY user_id ORDER BY ts) AS number FROM steps),
found AS (
  SELECT user_id, min(ts) AS "start", max(ts) + INTERVAL 4 HOUR AS "end", count(*) AS n, CAST(sum(cents) AS BIGINT) AS cents
  FROM numbered GROUP BY user_id, number)
SELECT f.* FROM found f, mark WHERE "end" <= closed
""",
)
def activity_sessions(spark, sf_dir):
    """Events of a user no more than four hours apart."""
    sums = {"cents": F.col("cents")}
    return _closed_in_parts(
        spark, sf_dir, "sessions", lambda events: activity.sessions(events, "ts", ["user_id"], "4 hours", "6 hours", sums)
    )


@register(
    "sketched_quarters",
    sql.with_deals(
        "SELECT year(closing) AS year, quarter(closing) AS quarter, count(*) AS n, count(DISTINCT tc) AS coordinators, "
        "count(TRY_CAST(billing AS DOUBLE)) AS amounts, min(TRY_CAST(billing AS DOUBLE)) AS lowest, "
        "max(TRY_CAST(billing AS DOUBLE)) AS highest, quantile_disc(TRY_CAST(billing AS DOUBLE), 0.5) AS median "
        "FROM deal WHERE closing IS NOT NULL GROUP BY ALL"
    ),
)
def sketched_quarters(spark, sf_dir):
    """Coordinators and billing amounts of a quarter from the sketches of its months and teams.

    Coordinators and amounts have few different values here, so count and median are exact.
    """
    flat = inputs.flat(spark, sf_dir).where(filters.is_not_value("labels_last.`Contract Status`", fixed.AGENT_ACCOUNT))
    rows = flat.where("keys.closing_date IS NOT NULL").selectExpr(
        "trunc(keys.closing_date, 'MM') AS month", "team_name", "labels.`Empower TC Name` AS tc",
        f"{col.to_money('labels.`Billing Amount`')} AS amount",
    )
    months = sketches.sketched(rows, ["month", "team_name"], {"tc": F.col("tc")}, {"amount": F.col("amount")})
    quarters = months.withColumns({"year": F.year("month"), "quarter": F.quarter("month")})
    return sketches.merged(quarters, ["year", "quarter"]).select(
        "year", "quarter", "n", sketches.distinct_count("tc").alias("coordinators"), sketches.n_values("amount").alias("amounts"),
        *[sketches.quantile("amount", rank).alias(name) for name, rank in (("lowest", 0), ("highest", 1), ("median", 0.5))],
    )


@register("labels_found", sql.labels_found())
def labels_found(spark, sf_dir):
    """The labels an exploration finds."""
    return labels_in(parse_once(inputs.raw(spark, sf_dir).select("field_values")))
