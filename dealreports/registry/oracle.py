"""The answers of the registered queries as SQL over the base tables, without any JSON."""

from typing import NamedTuple

from dealreports import fixed
from dealreports.sources import deals as d

AS_OF = "TIMESTAMP '2000-10-20 14:30:00'"


def _q(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def _s(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _in(values) -> str:
    return "(" + ", ".join(_s(v) for v in values) + ")"


_STATUS = "[" + ", ".join(_s(s) for s in d.STATUSES) + "]"
_AMOUNT = "CASE WHEN k % 41 = 0 THEN '' WHEN k % 43 = 0 THEN 'n/a' ELSE ({}) END"

# One row per order with its attributes by the adapter's rules; all empty where the list is unreadable.
DEAL_BASE = f"""
base AS (
  SELECT o_orderkey AS k, o_orderdate AS created, CAST(o_orderdate AS DATE) AS d,
         c_custkey, c_name, c_mktsegment, CAST(n_nationkey AS BIGINT) AS team_id, 'Team ' || n_name AS team_name,
         o_orderkey % 103 <> 0 AND o_orderkey % 101 <> 0 AND o_orderkey % 107 <> 0 AS readable
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
),
ruled AS (
  SELECT k, created, d, c_custkey, c_name, c_mktsegment, team_id, team_name, readable,
    {_STATUS}[CAST(k % 20 AS INTEGER) + 1] AS status,
    CASE WHEN k % 17 = 0 THEN NULL WHEN (k // 20) % 2 = 0 THEN 'Buyer' ELSE 'Seller' END AS client,
    CASE WHEN k % 229 = 0 THEN NULL WHEN k % 211 = 0 THEN 'Test deal ' || k WHEN k % 223 = 0 THEN 'TRAINING ' || k
         WHEN k % 227 = 0 THEN 'please delete ' || k ELSE 'Deal ' || k END AS title,
    CASE WHEN k % 31 = 0 THEN NULL ELSE 'TC ' || (k % 9) END AS tc,
    CASE WHEN k % 37 = 0 THEN NULL ELSE c_name END AS agent,
    CASE WHEN k % 13 = 0 THEN NULL ELSE d END AS started,
    CASE WHEN k % 11 = 0 OR k % 97 = 0 THEN NULL ELSE d + CAST(k % 75 AS INTEGER) END AS closing,
    CASE WHEN k % 4 = 0 AND k % 11 <> 0 AND k % 97 <> 0 THEN d + CAST(k % 75 AS INTEGER) + 10 END AS ctc_paid,
    CASE WHEN k % 3 = 0 THEN d + CAST(k % 20 AS INTEGER) END AS listing_started,
    CASE WHEN k % 3 = 0 THEN d + 20 + CAST(k % 25 AS INTEGER) END AS listing_paid,
    CASE WHEN k % 7 = 0 THEN d + CAST(k % 10 AS INTEGER) END AS offer_started,
    CASE WHEN k % 7 = 0 THEN d + 12 + CAST(k % 10 AS INTEGER) END AS offer_paid,
    CASE WHEN k % 9 < 4 THEN d + CAST(k % 15 AS INTEGER) END AS compliance_started,
    CASE WHEN k % 9 < 4 THEN d + 15 + CAST(k % 30 AS INTEGER) END AS compliance_paid,
    {_AMOUNT.format("CAST(150 + 50 * (k % 3) AS VARCHAR)")} AS listing_amount,
    {_AMOUNT.format("'350'")} AS ctc_amount,
    {_AMOUNT.format("'40'")} AS offer_amount,
    {_AMOUNT.format("CAST(50 + 50 * (k % 3) AS VARCHAR)")} AS compliance_amount,
    CASE WHEN k % 6 = 0 THEN '' WHEN k % 6 = 1 THEN '0' ELSE CAST(400 + 25 * (k % 5) AS VARCHAR) END AS billing,
    CASE WHEN k % 12 IN (0, 7) THEN '75' END AS other,
    CASE WHEN k % 10 = 0 THEN 'Yes' END AS preferred,
    CASE WHEN k % 53 = 0 THEN 'Compliance - PAID' END AS billing_status,
    CASE WHEN k % 3 = 0 THEN d + CAST(k % 22 AS INTEGER) END AS live_on_mls,
    CASE WHEN k % 5 = 0 THEN CASE WHEN k % 3 = 0 THEN '' ELSE '25' END END AS ctc_monthly,
    CASE WHEN k % 6 = 0 THEN CASE WHEN k % 4 = 0 THEN '' ELSE 'Spring' END END AS promo_notes
  FROM base
),
deal AS (
  SELECT k, created, d, c_custkey, c_name, c_mktsegment, team_id, team_name, readable,
    {{columns}}
  FROM ruled
)
"""
_ATTRIBUTES = (
    "status client title tc agent started closing ctc_paid listing_started listing_paid offer_started offer_paid "
    "compliance_started compliance_paid listing_amount ctc_amount offer_amount compliance_amount billing other "
    "preferred billing_status live_on_mls ctc_monthly promo_notes"
).split()
_COLUMNS = ",\n    ".join(
    [f"CASE WHEN readable THEN {a} END AS {a}" for a in _ATTRIBUTES]
    + [
        "CASE WHEN readable THEN CASE WHEN k % 23 = 0 THEN 'Superseded' ELSE status END END AS status_last",
        # the last object with the key, which has no value where k % 47 = 0
        "CASE WHEN readable AND k % 47 <> 0 THEN CASE WHEN k % 23 = 0 THEN 'Superseded' ELSE status END END AS status_key",
        "CASE WHEN readable THEN CASE WHEN k % 11 = 0 THEN NULL WHEN k % 97 = 0 THEN 'TBD' "
        "ELSE CAST(d + CAST(k % 75 AS INTEGER) AS VARCHAR) END END AS closing_text",
    ]
)
DEAL = DEAL_BASE.replace("{columns}", _COLUMNS)

# One or two rows per agent.
AGENT = """
agent_row AS (
  SELECT c_custkey AS a, c_custkey + twice * 10000000 AS id, c_custkey, c_name, c_mktsegment,
    CAST(n_nationkey AS BIGINT) AS team_id, 'Team ' || n_name AS team_name,
    CAST(DATE '1995-01-01' + CAST(c_custkey % 365 AS INTEGER) - CAST(twice - 1 AS INTEGER) AS TIMESTAMP) AS created,
    CASE WHEN c_custkey % 500 <> 0 THEN c_name END AS title,
    'TC ' || (c_custkey % 9) AS coordinator,
    CASE WHEN c_custkey % 19 <> 0 THEN DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) END AS onboard,
    CASE WHEN c_custkey % 4 = 0 THEN '1st Transaction' END AS onboarding,
    CASE WHEN c_custkey % 19 <> 0 THEN
      DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) + CAST(c_custkey % 40 AS INTEGER) END AS first_transaction,
    CASE c_custkey % 3 WHEN 0 THEN 'TC' WHEN 1 THEN 'Empower' END AS provided_by,
    CASE WHEN c_custkey % 23 = 0 THEN 'Lost - Reassigned' END AS other_status,
    CASE WHEN c_custkey % 23 = 0 AND c_custkey % 19 <> 0 THEN
      DATE '1995-01-01' + CAST(c_custkey * 7 % 2400 AS INTEGER) + 100 + CAST(c_custkey % 50 AS INTEGER) END AS reassigned
  FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN (SELECT CAST(range AS BIGINT) AS twice FROM range(1, 3)) ON twice = 1 OR c_custkey % 17 = 0
  WHERE c_custkey % 13 <> 0
),
agent_ranked AS (
  SELECT *, row_number() OVER (PARTITION BY title ORDER BY created DESC, id) AS rn FROM agent_row
),
agent_account AS (SELECT * FROM agent_ranked WHERE rn = 1)
"""

_SYSTEM = (
    "'America/Chicago' AS timezone, team_id, team_name, c_custkey % 50 AS team_user_id, "
    "'User ' || (c_custkey % 50) AS team_user_name, c_custkey AS agent_id, c_name AS agent_name, "
    "c_mktsegment AS brokerage, '{}' AS api_data, 'deal-' || k || '@example.com' AS inbound_email_address"
)
_CREATED = "strftime(created, '%Y-%m-%d %H:%M:%S')"
_KEY_COLUMN = {
    "closing_date": "closing",
    "ctc_started_with_empower": "started",
    "listing_started_with_empower": "listing_started",
    "listing_paid_date": "listing_paid",
    "compliance_started_with_empower": "compliance_started",
    "compliance_paid_date": "compliance_paid",
}


def with_deals(select: str) -> str:
    return f"WITH {DEAL}\n{select}"


def with_agents(select: str) -> str:
    return f"WITH {DEAL}, {AGENT}\n{select}"


# --- monthly counts -----------------------------------------------------------------------------


class Count(NamedTuple):
    """A monthly count as the report states it, written out here and not taken from the plan."""

    kpi: int
    state: str
    date: str
    statuses: tuple[str, ...]
    teams: str | None = None
    client: str | None = None
    rule: str = "month"


# The nineteen counts of the monthly report.
COUNTS = [
    Count(1, "CTC - Preferred Started", "started", ("CTC - Preferred - Pending",), "preferred"),
    Count(2, "CTC - Preferred Closing", "closing", ("CTC - Preferred - Closed - Ready to BILL",), "preferred"),
    Count(3, "CTC - Started", "started", ("CTC - Pending",), "ctc"),
    Count(4, "CTC - Closing", "closing", ("CTC - Closed - PAID",), "ctc"),
    Count(5, "CTC - Terminated", "closing", ("CTC - Terminated - No Charge",), "ctc"),
    Count(6, "CTC - Withdrawn", "closing", ("CTC - Withdrawn",), "ctc"),
    Count(7, "Client Type-Buyer", "closing", ("CTC - Closed - PAID",), "ctc", "Buyer"),
    Count(8, "Preferred (epique) Buyer Closed", "closing", ("CTC - Preferred - Closed - Ready to BILL",), "preferred", "Buyer"),
    Count(9, "Client Type-Seller", "closing", ("CTC - Closed - PAID",), "ctc", "Seller"),
    Count(10, "Preferred (epique) Seller Closed", "closing", ("CTC - Preferred - Closed - Ready to BILL",), "preferred", "Seller"),
    Count(11, "Listing - Started with Empower", "listing_started", ("Listing - Pre-Listing",)),
    Count(12, "Listing - Paid", "listing_paid", ("Listing - PAID",)),
    Count(13, "Compliance - Started with Empower", "compliance_started", ("Compliance",)),
    Count(14, "Compliance - Paid", "compliance_paid", ("Compliance - PAID",)),
    Count(15, "All Closing Current Month", "closing", ("CTC - Closed - PAID", "CTC - Preferred - Closed - Ready to BILL")),
    Count(16, "Future Closing Next Month - Preffered", "closing", ("CTC - Preferred - Pending",), "preferred", rule="next"),
    Count(17, "Future Closing Next Month - CTC", "closing", ("CTC - Pending",), "ctc", rule="next"),
    Count(18, "Future Closing All Other Month - Preferred", "closing", ("CTC - Preferred - Pending",), "preferred", rule="rest"),
    Count(19, "Future Closing All Other Month - CTC", "closing", ("CTC - Pending",), "ctc", rule="rest"),
]


def _kpi_where(k) -> str:
    date = k.date
    parts = [f"status IN {_in(k.statuses)}", f"{date} >= DATE '2000-01-01'"]
    parts.append(f"{date} < DATE '{'2000-11-01' if k.rule == 'month' else '2000-12-01' if k.rule == 'next' else '2001-01-01'}'")
    if k.teams:
        parts.append(f"team_name IN {_in(d.CTC_TEAMS if k.teams == 'ctc' else d.PREFERRED_TEAMS)}")
    if k.client:
        parts.append(f"client = {_s(k.client)}")
    return " AND ".join(parts)


def _kpi_select(k) -> str:
    date = k.date
    match = {
        "month": f"date_trunc('month', {date}) = m.month",
        "next": f"date_trunc('month', {date}) = m.month + INTERVAL 1 MONTH",
        "rest": f"date_trunc('month', {date}) > m.month",
    }[k.rule]
    return (
        f"SELECT CAST({k.kpi} AS INTEGER) AS kpi, {_s(k.state)} AS state, CAST(m.month AS DATE) AS month, "
        f"(SELECT count(*) FROM deal WHERE {_kpi_where(k)} AND {match}) AS n FROM months m"
    )


_MONTHS = (
    "months AS (SELECT CAST(range AS DATE) AS month FROM range(DATE '2000-01-01', DATE '2000-11-01', INTERVAL 1 MONTH))"
)


def kpi_long(numbers=range(1, 20)) -> str:
    return f"WITH {DEAL}, {_MONTHS}\n" + "\nUNION ALL\n".join(_kpi_select(k) for k in COUNTS if k.kpi in numbers)


def kpi_wide() -> str:
    months = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct"]
    cells = ", ".join(
        f"max(CASE WHEN month(month) = {i} THEN n END) AS {_q(f'{m} 2000')}" for i, m in enumerate(months, start=1)
    )
    return f"SELECT kpi, state, {cells} FROM ({kpi_long()}) GROUP BY kpi, state"


# --- extracts -----------------------------------------------------------------------------------

_CALENDAR = {-1: ("2000-09-01", "2000-10-01"), 0: ("2000-10-01", "2000-11-01"), 1: ("2000-11-01", "2000-12-01")}
_CLOCK = {-1: ("2000-09-01", "2000-09-30"), 0: ("2000-10-01", "2000-10-31"), 1: ("2000-11-01", "2000-11-30")}


class Sheet(NamedTuple):
    title: str
    date: str
    months: int
    onwards: bool = False
    teams: str | None = None
    client: str | None = None
    closed_paid: bool = False


# The eleven extracts as the report states them.
SHEETS = {
    "closed": Sheet("Closed Properties", "closing_date", -1, teams="ctc", closed_paid=True),
    "current_month": Sheet("Closings-Current Month", "closing_date", 0),
    "preferred_seller": Sheet("Preferred - Seller Closed", "closing_date", 0, teams="preferred", client="Seller"),
    "compliance_paid": Sheet("Last Month Compliance Paid", "compliance_paid_date", -1),
    "compliance_started": Sheet("Last Month Compliance Empower Started", "compliance_started_with_empower", -1),
    "listing_started": Sheet("Last Month Listing Empower Started", "listing_started_with_empower", -1),
    "listing_paid": Sheet("Last Month Listing Paid", "listing_paid_date", -1),
    "ctc_from_next_month": Sheet("Future Closings-CTC, All Other Months", "closing_date", 1, True, "ctc"),
    "ctc_next_month": Sheet("Future Closings-CTC, Next Month", "closing_date", 1, teams="ctc"),
    "preferred_from_next_month": Sheet("Future Closings-Preferred, All Other Months", "closing_date", 1, True, "preferred"),
    "preferred_next_month": Sheet("Future Closings-Preferred, Next Month", "closing_date", 1, teams="preferred"),
}


def extract(name: str, bounds: str = "calendar", select: str = "*", require_status: str | None = None) -> str:
    e = SHEETS[name]
    date = f"CAST({_KEY_COLUMN[e.date]} AS TIMESTAMP)"
    if bounds == "calendar":
        low, high = _CALENDAR[e.months]
        where = [f"{date} >= TIMESTAMP '{low} 00:00:00'"]
        if not e.onwards:
            where.append(f"{date} < TIMESTAMP '{high} 00:00:00'")
    else:
        low, high = _CLOCK[e.months]
        where = [f"{date} >= TIMESTAMP '{low} 14:30:00'"]
        if not e.onwards:
            where.append(f"{date} <= TIMESTAMP '{high} 14:30:00'")
    if e.teams:
        where.append(f"team_name IN {_in(d.CTC_TEAMS if e.teams == 'ctc' else d.PREFERRED_TEAMS)}")
    if e.client:
        where.append(f"client = {_s(e.client)}")
    if require_status:
        where.append(f"status_key = {_s(require_status)}")
    added = f"strftime({date}, '%Y-%m-%d %H:%M:%S') AS {e.date}"
    if e.client:
        added += ", client AS contract_client_type"
    if e.closed_paid:
        added += ", coalesce(status_key = 'CTC - Closed - PAID', FALSE) AS is_closed_paid"
    rows = f"SELECT k AS id, {_CREATED} AS created, {_SYSTEM}, {added} FROM deal WHERE {' AND '.join(where)}"
    return with_deals(f"SELECT {select} FROM ({rows})")


def closed_halves() -> str:
    return extract(
        "closed",
        select="*, CASE WHEN day(CAST(closing_date AS DATE)) <= 15 THEN 'Closed Properties 1-15 September 2000' "
        "ELSE 'Closed Properties 16-30 September 2000' END AS workbook, team_name || ' - Closed Properties' AS sheet",
    )


_FIXED = (
    "id, created, timezone, team_id, team_name, team_user_id, team_user_name, agent_id, agent_name, brokerage, "
    "api_data, inbound_email_address"
)


def all_extracts() -> str:
    parts = []
    for name, e in SHEETS.items():
        client = "contract_client_type" if e.client else "CAST(NULL AS VARCHAR)"
        closed = "is_closed_paid" if e.closed_paid else "CAST(NULL AS BOOLEAN)"
        columns = (
            f"{_FIXED}, {_s(e.title)} AS extract, {_s(e.date)} AS date_name, {e.date} AS date, "
            f"{client} AS contract_client_type, {closed} AS is_closed_paid"
        )
        parts.append(f"({extract(name, select=columns)})")
    return "\nUNION ALL\n".join(f"SELECT * FROM {p}" for p in parts)


# --- staging ------------------------------------------------------------------------------------

_LABEL_COLUMN = {
    "Contract Title": "title",
    "Contract Client Type": "client",
    "Empower TC Name": "tc",
    "Empower Agent Name": "agent",
    "Contract Status": "status_last",
    "CTC Started with Empower": "started",
    "Closing": "closing",
    "CTC PAID Date": "ctc_paid",
    "Listing Started with Empower": "listing_started",
    "Listing PAID Date": "listing_paid",
    "Offer Started with Empower": "offer_started",
    "Offer Prep PAID Date": "offer_paid",
    "Compliance Started with Empower": "compliance_started",
    "Compliance PAID Date": "compliance_paid",
    "Listing PAID Amount": "listing_amount",
    "CTC PAID Amount": "ctc_amount",
    "Offer Prep PAID Amount": "offer_amount",
    "Compliance PAID Amount": "compliance_amount",
    "Billing Amount": "billing",
    "Other Amount": "other",
    "Preferred  Ai  CTC": "preferred",
    "Billing Status": "billing_status",
    "Live on MLS Date": "live_on_mls",
    "CTC Monthly": "ctc_monthly",
    "Promo Notes": "promo_notes",
}
_SYSTEM_COLUMN = {
    "Time Zone": "'America/Chicago'",
    "Team": "team_name",
    "Team User": "'User ' || (c_custkey % 50)",
    "Created By": "c_name",
    "Date Created": "created",
}
_AGENT_COLUMN = {
    "Contract Title": "title",
    "Contract Status": "'AGENT ACCOUNT'",
    "Transaction Coordinator": "coordinator",
    "Onboard Call Complete Date": "CAST(onboard AS VARCHAR)",
    "Onboarding Status": "onboarding",
    "1st Transaction Date": "CAST(first_transaction AS VARCHAR)",
    "Brokerage": "c_mktsegment",
    "Agent Provided by": "provided_by",
    "Other Status": "other_status",
    "Reassigned Date": "CAST(reassigned AS VARCHAR)",
}
_NEVER = "started IS NULL AND listing_started IS NULL AND offer_started IS NULL AND compliance_started IS NULL"
# Fixed values, as the records spell them; not taken from the library, so that a slip there shows.
_EXCLUDED = " OR ".join(f"lower(coalesce(title, '')) LIKE '%{w}%'" for w in ("test", "training", "delete"))
_NO_CLOSING = (
    "Compliance - PAID", "Compliance - Ready to BILL", "CTC - Preferred - Terminated - No Change",
    "CTC - Terminated - No Change", "CTC - Preferred - Withdrawn", "CTC - Withdrawn", "Listing - PAID",
    "Listing - Pre-Listing",
)
_BOTH_LATE = f"(year(started) >= {d.CUTOVER_YEAR} AND year(listing_started) >= {d.CUTOVER_YEAR})"
_BLANK_AMOUNT = "(coalesce({0}, '') = '' OR coalesce(TRY_CAST({0} AS DOUBLE) = 0, FALSE))"
_CLOSING_KEPT = f"CASE WHEN status_last IN {_in(_NO_CLOSING)} THEN NULL ELSE closing END"
_BILLING = (
    f"CASE WHEN {_BLANK_AMOUNT.format('billing')} AND ({_CLOSING_KEPT}) IS NOT NULL THEN "
    f"CASE WHEN NOT {_BLANK_AMOUNT.format('other')} THEN other "
    f"WHEN preferred = 'Yes' THEN '99' ELSE '400' END "
    f"ELSE billing END"
)


def _agent_label(label: str) -> str:
    return f"{_AGENT_COLUMN.get(label, 'CAST(NULL AS VARCHAR)')} AS {_q(label)}"


def _system_columns() -> str:
    return ", ".join(f"{sql} AS {_q(name)}" for name, sql in _SYSTEM_COLUMN.items())


def _curated_column(label: str) -> str:
    filler = "TIMESTAMP '1899-12-30 00:00:00'"
    if label in fixed.DATE_COLUMNS:
        source = _LABEL_COLUMN.get(label, "NULL")
        if label == "Closing":
            source = _CLOSING_KEPT
        elif label in ("Listing Started with Empower", "Listing PAID Date", "Live on MLS Date"):
            source = f"CASE WHEN {_BOTH_LATE} THEN NULL ELSE {source} END"
        elif label == "1st Transaction Date":
            source = "first_transaction"
        elif label == "Reassigned Date":
            source = "reassigned"
        return f"coalesce(CAST({source} AS TIMESTAMP), {filler}) AS {_q(label)}"
    if label in _SYSTEM_COLUMN:
        return f"{_SYSTEM_COLUMN[label]} AS {_q(label)}"
    if label in ("Brokerage", "Agent Provided by"):
        return f"{'agent_brokerage' if label == 'Brokerage' else 'provided_by'} AS {_q(label)}"
    source = _LABEL_COLUMN.get(label, "CAST(NULL AS VARCHAR)")
    if label == "Billing Amount":
        source = _BILLING
    elif label == "Contract Status":
        source = "coalesce(nullif(billing_status, ''), status_last)"
    if label in fixed.ZERO_FILL_COLUMNS:
        source = f"coalesce(nullif({source}, ''), '0')"
    if label in fixed.NONE_FILL_COLUMNS:
        source = f"coalesce(nullif({source}, ''), 'none')"
    return f"{source} AS {_q(label)}"


def stage_curated() -> str:
    columns = ",\n  ".join(_curated_column(c) for c in fixed.ORDER_COLUMNS)
    return with_agents(f"""
SELECT {columns}
FROM (
  SELECT deal.*, acc.c_mktsegment AS agent_brokerage, acc.provided_by, acc.first_transaction, acc.reassigned
  FROM deal JOIN agent_account acc ON deal.agent IS NOT DISTINCT FROM acc.title
)
WHERE NOT ({_EXCLUDED}) AND NOT (coalesce(tc, '') = '' AND {_NEVER}) AND NOT (coalesce(agent, '') = '' AND {_NEVER})
""")


def stage_errors() -> str:
    def column(label: str) -> str:
        if label == "Closing":
            return f"closing_text AS {_q(label)}"
        return f"CAST({_LABEL_COLUMN.get(label, 'NULL')} AS VARCHAR) AS {_q(label)}"

    columns = ", ".join(column(label) for label in fixed.TRANSACTION_LABELS)
    empty = ", ".join(f"CAST(NULL AS VARCHAR) AS {_q(f)}" for f in fixed.AGENT_FIELDS)
    return with_agents(f"""
SELECT {_system_columns()}, {columns}, {empty} FROM deal
WHERE NOT EXISTS (SELECT 1 FROM agent_account acc WHERE deal.agent IS NOT DISTINCT FROM acc.title)
""")


def _agents(where: str) -> str:
    columns = ", ".join(_agent_label(label) for label in fixed.AGENT_LABELS)
    return with_agents(f"SELECT {_system_columns()}, {columns} FROM agent_ranked WHERE {where}")


def stage_agents() -> str:
    return _agents("rn = 1")


def stage_agent_duplicates() -> str:
    return _agents("rn > 1")


# When a label stands in a deal's list with a value; the others always do. JSON null is a value.
_STANDS = {
    "Empower TC Name": "k % 31 <> 0", "CTC Started with Empower": "k % 13 <> 0", "Closing": "k % 11 <> 0",
    "CTC PAID Date": "ctc_paid IS NOT NULL", "Listing Started with Empower": "k % 3 = 0", "Listing PAID Date": "k % 3 = 0",
    "Live on MLS Date": "k % 3 = 0", "Offer Started with Empower": "k % 7 = 0", "Offer Prep PAID Date": "k % 7 = 0",
    "Compliance Started with Empower": "k % 9 < 4", "Compliance PAID Date": "k % 9 < 4", "Other Amount": "k % 12 IN (0, 7)",
    "Preferred  Ai  CTC": "k % 10 = 0", "Billing Status": "k % 53 = 0", "CTC Monthly": "k % 5 = 0", "Promo Notes": "k % 6 = 0",
}
_STANDS_FOR_AGENT = {
    "Onboard Call Complete Date": "onboard IS NOT NULL", "Onboarding Status": "onboarding IS NOT NULL",
    "1st Transaction Date": "first_transaction IS NOT NULL", "Agent Provided by": "provided_by IS NOT NULL",
    "Other Status": "other_status IS NOT NULL", "Reassigned Date": "reassigned IS NOT NULL",
}


def labels_found() -> str:
    deals = [f"SELECT {_s(c)} AS label FROM deal WHERE readable AND {_STANDS.get(c, 'TRUE')}" for c in _LABEL_COLUMN]
    agents = [f"SELECT {_s(c)} FROM agent_row WHERE {_STANDS_FOR_AGENT.get(c, 'TRUE')}" for c in _AGENT_COLUMN]
    return with_agents(" UNION ".join(deals + agents))


# How values are classed, written out here and not taken from the library.
_CLASS = r"""CASE WHEN trim(v) = '' THEN 'blank' WHEN regexp_full_match(v, '[+-]?[0-9]{1,18}') THEN 'whole'
    WHEN regexp_full_match(v, '[+-]?\$?([0-9]{1,18}|[0-9]{1,3}(,[0-9]{3}){1,5})(\.[0-9]+)?') THEN 'money'
    WHEN TRY_CAST(v AS DATE) IS NOT NULL THEN 'yyyy-MM-dd' ELSE 'text' END"""


def label_types(misfits: float = 0.05) -> str:
    texts = {c: "closing_text" if c == "Closing" else "status" if c == "Contract Status" else e for c, e in _LABEL_COLUMN.items()}
    deals = [f"SELECT {_s(c)} AS label, CAST({e} AS VARCHAR) AS v FROM deal WHERE readable" for c, e in texts.items()]
    deals.append("SELECT 'Contract Status', 'Superseded' FROM deal WHERE readable AND k % 23 = 0")
    agents = [f"SELECT {_s(c)}, CAST({e} AS VARCHAR) FROM agent_row" for c, e in _AGENT_COLUMN.items()]
    return with_agents("").rstrip() + f""",
found AS ({" UNION ALL ".join(deals + agents)}),
counted AS (
  SELECT label, count(CASE WHEN c <> 'blank' THEN 1 END) AS n_values, count(CASE WHEN c = 'blank' THEN 1 END) AS n_blank,
    count(CASE WHEN c = 'whole' THEN 1 END) AS n_whole, count(CASE WHEN c IN ('whole', 'money') THEN 1 END) AS n_money,
    count(CASE WHEN c = 'yyyy-MM-dd' THEN 1 END) AS n_date
  FROM (SELECT label, {_CLASS} AS c FROM found WHERE v IS NOT NULL) GROUP BY label),
typed AS (
  SELECT *, CASE WHEN n_values > 0 AND n_values - n_whole <= n_values * {misfits}::DOUBLE THEN 'whole'
    WHEN n_values > 0 AND n_values - n_money <= n_values * {misfits}::DOUBLE THEN 'money'
    WHEN n_values > 0 AND n_values - n_date <= n_values * {misfits}::DOUBLE THEN 'date' ELSE 'text' END AS type
  FROM counted)
SELECT label, type, CASE WHEN type = 'date' THEN 'yyyy-MM-dd' END AS format, n_values, n_blank,
  CASE WHEN n_values = 0 THEN 0::DOUBLE ELSE (n_values
    - CASE type WHEN 'whole' THEN n_whole WHEN 'money' THEN n_money WHEN 'date' THEN n_date ELSE n_values END)::DOUBLE
    / n_values END AS misfits
FROM typed"""


# --- payroll ------------------------------------------------------------------------------------

_PAID = {"closing": "closing", "listing": "listing_paid", "ctc": "ctc_paid", "compliance": "compliance_paid",
         "offer_prep": "offer_paid"}


# Labels that payroll reads as dates and amounts or computes, and the coordinator, who has another name in between.
_TYPED = [
    "Empower TC Name", "Closing", "Listing PAID Date", "CTC PAID Date", "Offer Prep PAID Date", "Compliance PAID Date",
    "Listing Started with Empower", "Offer Started with Empower", "Compliance Started with Empower", "Billing Amount",
    "Listing PAID Amount", "CTC PAID Amount", "Offer Prep PAID Amount", "Compliance PAID Amount",
    "TC Commission Rate", "TC Commission Amount",
]


def _half(date: str) -> tuple[str, str]:
    filled = f"coalesce({date}, DATE '1990-01-01')"
    start = f"CASE WHEN day({filled}) <= 15 THEN date_trunc('month', {filled}) ELSE date_trunc('month', {filled}) + INTERVAL 15 DAY END"
    end = f"CASE WHEN day({filled}) <= 15 THEN date_trunc('month', {filled}) + INTERVAL 14 DAY ELSE last_day({filled}) END"
    return start, end


def _payroll_rows() -> str:
    columns = []
    for period, date in _PAID.items():
        start, end = _half(date)
        columns.append(f"CAST({start} AS TIMESTAMP) AS {period}_period_start")
        columns.append(f"CAST({end} AS TIMESTAMP) + INTERVAL '23:59:59' AS {period}_period_end")
        columns.append(f"strftime({start}, '%Y/%m/%d') || ' - ' || strftime({end}, '%Y/%m/%d') AS {period}_periode")

    def paid(date, amount):
        return f"CASE WHEN {date} IS NOT NULL THEN TRY_CAST({amount} AS DECIMAL(18,2)) ELSE 0 END"

    def inside(start, date):
        low, high = _half(date)
        return (
            f"CASE WHEN {start} IS NOT NULL AND {start} >= CAST({low} AS DATE) AND {start} <= CAST({high} AS DATE) "
            "THEN 1 ELSE 0 END"
        )

    texts = [label for label in fixed.TRANSACTION_LABELS if label not in _TYPED]
    first = {**_LABEL_COLUMN, "Contract Status": "status"}
    of_deals = ", ".join(f"CAST({first.get(t, 'NULL')} AS VARCHAR) AS {_q(t)}" for t in texts)
    of_agents = ", ".join(f"CAST({_AGENT_COLUMN.get(t, 'NULL')} AS VARCHAR) AS {_q(t)}" for t in texts)
    everyone = f"""
  SELECT k, tc, billing, listing_amount, ctc_amount, offer_amount, compliance_amount, started, closing, ctc_paid,
    listing_started, listing_paid, offer_started, offer_paid, compliance_started, compliance_paid, {of_deals} FROM deal
  UNION ALL
  SELECT a, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, {of_agents}
  FROM agent_row
"""
    return f"""
SELECT tc, {", ".join(map(_q, texts))}, {", ".join(columns)},
  {", ".join(f"CAST(coalesce({c}, DATE '1990-01-01') AS TIMESTAMP) AS {c}_filled" for c in ("closing", "ctc_paid", "listing_paid", "offer_paid", "compliance_paid", "listing_started", "offer_started", "compliance_started"))},
  TRY_CAST(billing AS DECIMAL(18,2)) AS billing,
  CAST(0.5 AS DECIMAL(6,4)) AS rate,
  CAST(TRY_CAST(billing AS DECIMAL(18,2)) * 0.5 AS DECIMAL(20,4)) AS commission,
  {paid("listing_paid", "listing_amount")} AS listing_amount,
  {paid("ctc_paid", "ctc_amount")} AS ctc_amount,
  {paid("offer_paid", "offer_amount")} AS offer_amount,
  {paid("compliance_paid", "compliance_amount")} AS compliance_amount,
  CASE WHEN closing IS NULL THEN 0 ELSE 1 END AS ctc_projection,
  {inside("listing_started", "listing_paid")} AS listing_projection,
  {inside("offer_started", "offer_paid")} AS offer_projection,
  {inside("compliance_started", "compliance_paid")} AS compliance_projection,
  closing IS NOT NULL AS has_closing, ctc_paid IS NOT NULL AS has_ctc_paid
FROM ({everyone})
"""


def _payroll() -> str:
    return f"""
SELECT *, coalesce(listing_amount, 0) + coalesce(ctc_amount, 0) + coalesce(offer_amount, 0)
    + coalesce(compliance_amount, 0) AS revenue
FROM ({_payroll_rows()})
"""


def _payroll_amounts() -> str:
    return f"""
SELECT *, CAST(CASE WHEN has_closing THEN commission ELSE 0 END AS DECIMAL(20,4)) AS projected,
  CAST(CASE WHEN has_ctc_paid THEN revenue * 0.5 ELSE 0 END AS DECIMAL(20,4)) AS actual,
  CAST(CASE WHEN has_ctc_paid THEN revenue ELSE 0 END AS DECIMAL(18,2)) AS revenue_amount
FROM ({_payroll()})
"""


def payroll_enriched() -> str:
    dates = {
        "Closing": "closing", "Listing PAID Date": "listing_paid", "CTC PAID Date": "ctc_paid",
        "Offer Prep PAID Date": "offer_paid", "Compliance PAID Date": "compliance_paid",
        "Listing Started with Empower": "listing_started", "Offer Started with Empower": "offer_started",
        "Compliance Started with Empower": "compliance_started",
    }
    columns = ["tc AS \"Empower TC Name\"", *(_q(t) for t in fixed.TRANSACTION_LABELS if t not in _TYPED)]
    columns += [f"{c}_filled AS {_q(label)}" for label, c in dates.items()]
    for period in _PAID:
        columns += [f"{period}_period_start", f"{period}_period_end", f"{period}_periode"]
    columns += [
        'rate AS "TC Commission Rate"',
        'billing AS "Billing Amount"',
        'CAST(listing_amount AS DECIMAL(18,2)) AS "Listing PAID Amount"',
        'CAST(ctc_amount AS DECIMAL(18,2)) AS "CTC PAID Amount"',
        'CAST(offer_amount AS DECIMAL(18,2)) AS "Offer Prep PAID Amount"',
        'CAST(compliance_amount AS DECIMAL(18,2)) AS "Compliance PAID Amount"',
        'CAST(ctc_projection AS INTEGER) AS "CTC Projection"',
        'CAST(listing_projection AS INTEGER) AS "Listing Projection"',
        'CAST(offer_projection AS INTEGER) AS "Offer Projection"',
        'CAST(compliance_projection AS INTEGER) AS "Compliance Projection"',
        'commission AS "TC Commission Amount"',
        'CAST(greatest(ctc_projection, listing_projection, offer_projection, compliance_projection) AS INTEGER)'
        ' AS "Projection Condition"',
        'CAST(revenue AS DECIMAL(18,2)) AS "TC Revenue"',
        'projected AS "Projected Amount"',
        'actual AS "Actual Amount"',
        'revenue_amount AS "TC Revenue Amount"',
    ]
    return with_agents(f"SELECT {', '.join(columns)} FROM ({_payroll_amounts()})")


def payroll_cells(mode: str) -> str:
    amount, period = {"p": ("projected", "closing_periode"), "a": ("actual", "ctc_periode")}[mode]
    return with_agents(f"""
SELECT CASE WHEN grouping(tc) = 1 THEN 'Total Result' ELSE tc END AS "Empower TC Name",
  CASE WHEN grouping({period}) = 1 THEN 'Total Result' ELSE {period} END AS periode,
  CAST(coalesce(sum({amount}), 0) AS DECIMAL(20,4)) AS amount
FROM ({_payroll_amounts()}) WHERE tc IN {_in(d.COORDINATORS)}
GROUP BY CUBE (tc, {period})
""")


def payroll_matrix(mode: str) -> str:
    """Every coordinator by every period that occurs, as cells."""
    return f"""
WITH cells AS ({payroll_cells(mode)}),
names AS (SELECT DISTINCT "Empower TC Name" FROM cells), periods AS (SELECT DISTINCT periode FROM cells)
SELECT "Empower TC Name", periode, CAST(coalesce(amount, 0) AS DECIMAL(20,4)) AS amount
FROM names CROSS JOIN periods LEFT JOIN cells USING ("Empower TC Name", periode)
"""


# --- daily update -------------------------------------------------------------------------------


# Statuses of the daily update.
_DAILY_CTC = (
    "status IN ('CTC - Closed - PAID', 'CTC - Pending', 'CTC - PAID', 'CTC - Terminated - No Charge', 'CTC - Withdrawn', "
    "'CTC - Terminated - Compliance - PAID')"
)
_DAILY_PREFERRED = (
    "status IN ('CTC - Preferred - Closed - PAID', 'CTC - Preferred - Pending', 'CTC - Preferred - PAID', "
    "'CTC - Preferred - Terminated - No Change', 'CTC - Preferred - Withdrawn')"
)
_DAILY_PENDING, _DAILY_PREFERRED_PENDING = "status = 'CTC - Pending'", "status = 'CTC - Preferred - Pending'"
_LOST = (
    "other_status IN ('Lost  Reassigned', 'Lost  Left Empower', 'Return to Sales', 'Lost - Do Not Contact', "
    "'Lost  Do Not Contact', 'Lost - Left Empower', 'Lost - Reassigned')"
)
# The measures of the daily update in order: title, date, when it counts, and of which rows.
DEAL_MEASURES = [
    ("Total ACTIVE Files - CTC", "closing", "active", _DAILY_CTC),
    ("Total ACTIVE Files - CTC Preferred", "closing", "active", _DAILY_PREFERRED),
    ("CTC Started for this month", "started", "in", _DAILY_CTC),
    ("CTC - Preferred Started", "started", "in", _DAILY_PREFERRED),
    ("Closings for this month", "closing", "in", _DAILY_CTC),
    ("CTC - Preferred Closings", "closing", "in", _DAILY_PREFERRED),
    ("CTC Pending for this month", "closing", "in", _DAILY_PENDING),
    ("CTC - Preferred Pending for this month", "closing", "in", _DAILY_PREFERRED_PENDING),
    ("CTC Pending for next month", "closing", "next", _DAILY_PENDING),
    ("CTC - Preferred Pending for next month", "closing", "next", _DAILY_PREFERRED_PENDING),
    ("CTC Pending for other months", "closing", "later", _DAILY_PENDING),
    ("CTC - Preferred Pending for other months", "closing", "later", _DAILY_PREFERRED_PENDING),
    ("Offers Started this month", "offer_started", "in", "TRUE"),
    ("Compliance Started this month", "compliance_started", "in", "TRUE"),
    ("Listing Started", "listing_started", "in", "TRUE"),
    ("Listing PAID", "listing_paid", "in", "TRUE"),
]
AGENT_MEASURES = [
    ("TC Generated Agents", "onboard", "until", "provided_by = 'TC'"),
    ("SALES Generated Agents", "onboard", "until", "provided_by = 'Empower'"),
    ("TOTAL Agents", "onboard", "until", "provided_by IN ('Empower', 'TC')"),
    ("1st Transaction Agents", "onboard", "until", "onboarding = '1st Transaction'"),
    ("Lost Agents/return to Sales", "onboard", "until", _LOST),
    ("OB for This Month", "onboard", "in", "TRUE"),
    ("1st Transactions for This Month", "first_transaction", "onboarded", "TRUE"),
]


def _daily_measure(title: str, date: str, rule: str, rows: str, scope: str) -> str:
    """The predicate on one row and one period, as the report states it."""
    tests = {
        "in": f"{date} >= period_start AND {date} <= period_end",
        "active": f"{date} >= current_end",
        "next": f"{date} > next_start AND {date} <= next_end",
        "later": f"{date} > next_end",
        "until": f"{date} <= period_start",
        "onboarded": f"{date} >= period_start AND {date} <= period_end AND date_trunc('month', onboard) = period_start",
    }
    where = [tests[rule], rows]
    if scope == "period" and rule in ("active", "next", "later"):
        where.append(f"date_trunc('month', {date}) = period_start")
    return f"count(CASE WHEN {' AND '.join(where)} THEN 1 END) AS {_q(title)}"


def daily_update(scope: str) -> str:
    titles = ", ".join(f"coalesce({_q(m[0])}, 0) AS {_q(m[0])}" for m in [*DEAL_MEASURES, *AGENT_MEASURES])
    return with_agents(f"""
, periods AS (
  SELECT CAST(m AS TIMESTAMP) AS period_start, m + INTERVAL 1 MONTH - INTERVAL 1 SECOND AS period_end,
    m + INTERVAL 1 MONTH AS next_start, m + INTERVAL 2 MONTH - INTERVAL 1 SECOND AS next_end,
    greatest(m + INTERVAL 1 MONTH - INTERVAL 1 SECOND, {AS_OF}) AS current_end
  FROM (SELECT DISTINCT date_trunc('month', started) AS m FROM deal WHERE year(started) = 2000)
),
everyone AS (SELECT tc FROM deal UNION SELECT NULL),
agent_filled AS (SELECT * REPLACE (coalesce(onboard, DATE '1990-01-01') AS onboard) FROM agent_row),
by_deal AS (
  SELECT period_start, tc, {", ".join(_daily_measure(*m, scope) for m in DEAL_MEASURES)}
  FROM deal CROSS JOIN periods GROUP BY period_start, tc
),
by_agent AS (
  SELECT period_start, coordinator, {", ".join(_daily_measure(*m, scope) for m in AGENT_MEASURES)}
  FROM agent_filled CROSS JOIN periods GROUP BY period_start, coordinator
)
SELECT CAST(p.period_start AS DATE) AS month, upper(strftime(p.period_start, '%B %Y')) AS period,
  e.tc AS "Empower TC Name", {titles}
FROM everyone e CROSS JOIN periods p
LEFT JOIN by_deal b ON b.period_start = p.period_start AND b.tc = e.tc
LEFT JOIN by_agent g ON g.period_start = p.period_start AND g.coordinator = e.tc
""".replace("\n, periods AS", ", periods AS", 1))
