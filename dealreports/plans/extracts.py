"""Eleven extracts: the rows whose date falls into a month, or from a month on, for some teams."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.functions.attributes import equals_flag
from dealreports.functions.calendar import (
    day_sql,
    first_of_month,
    from_month_sql,
    in_month_days_sql,
    in_month_sql,
)
from dealreports.functions.text import in_list, literal, quoted
from dealreports.sinks.render import as_seconds

GROUPS = ("keys", "days", "keys_last", "days_last", "labels", "labels_last")


@dataclass(frozen=True)
class Extract:
    """``months``: which month, relative to the reporting month; ``onwards``: that month and all later ones."""

    title: str
    date: str
    months: int
    onwards: bool = False
    teams: str | None = None
    client: str | None = None
    closed_paid: bool = False


# Titles, dates, months, team lists and client types of the extracts.
EXTRACTS = {
    "closed": Extract("Closed Properties", "closing_date", -1, teams="ctc", closed_paid=True),
    "current_month": Extract("Closings-Current Month", "closing_date", 0),
    "preferred_seller": Extract("Preferred - Seller Closed", "closing_date", 0, teams="preferred", client="Seller"),
    "compliance_paid": Extract("Last Month Compliance Paid", "compliance_paid_date", -1),
    "compliance_started": Extract(
        "Last Month Compliance Empower Started", "compliance_started_with_empower", -1
    ),
    "listing_started": Extract("Last Month Listing Empower Started", "listing_started_with_empower", -1),
    "listing_paid": Extract("Last Month Listing Paid", "listing_paid_date", -1),
    "ctc_from_next_month": Extract(
        "Future Closings-CTC, All Other Months", "closing_date", 1, onwards=True, teams="ctc"
    ),
    "ctc_next_month": Extract("Future Closings-CTC, Next Month", "closing_date", 1, teams="ctc"),
    "preferred_from_next_month": Extract(
        "Future Closings-Preferred, All Other Months", "closing_date", 1, onwards=True, teams="preferred"
    ),
    "preferred_next_month": Extract("Future Closings-Preferred, Next Month", "closing_date", 1, teams="preferred"),
}

TEAMS = {"ctc": fixed.CTC_TEAMS, "preferred": fixed.PREFERRED_TEAMS}


def extract_rows(
    flat: DataFrame,
    extract: Extract,
    as_of: datetime,
    teams: Mapping[str, Sequence[str]] = TEAMS,
    bounds: str = "calendar",
    require_status: str | None = None,
) -> DataFrame:
    """The rows of an extract with all fixed columns and its attributes; dates as text to the second.

    ``bounds='clock'`` compares with the clock time of ``as_of`` on the first and last day. ``closed`` carries a
    flag for closed and paid rows; they are only filtered when ``require_status`` names the status.
    """
    source, date = _date(extract)
    rows = flat.where(_condition(extract, as_of, teams, bounds))
    if require_status:
        rows = rows.where(f"{source}.contract_status = {literal(require_status)}")
    added = [as_seconds(F.col(date)).alias(extract.date)]
    if extract.client:
        added.append(F.col("keys.contract_client_type"))
    if extract.closed_paid:
        added.append(equals_flag(F.col(f"{source}.contract_status"), fixed.CTC_CLOSED_PAID).alias("is_closed_paid"))
    return rows.select(*_fixed_columns(flat), *added)


def _date(extract: Extract) -> tuple[str, str]:
    source = "keys_last" if extract.closed_paid else "keys"
    return source, f"{source}.{extract.date}"


def _fixed_columns(flat: DataFrame) -> list[str]:
    return [quoted(c) for c in flat.columns if c not in GROUPS]


def _condition(extract: Extract, as_of: datetime, teams: Mapping[str, Sequence[str]], bounds: str) -> str:
    _, date = _date(extract)
    day = date.replace("keys", "days")
    if extract.onwards:
        parts = [f"{day} >= {day_sql(first_of_month(as_of, extract.months))}"]
        parts.append(from_month_sql(date, as_of, extract.months, bounds))
    else:
        parts = [in_month_days_sql(day, as_of, extract.months)]
        parts.append(in_month_sql(date, as_of, extract.months, bounds))
    if extract.teams:
        parts.append(f"team_name IN {in_list(teams[extract.teams])}")
    if extract.client:
        parts.append(f"keys.contract_client_type = {literal(extract.client)}")
    return " AND ".join(parts)


def all_extracts(
    flat: DataFrame,
    as_of: datetime,
    teams: Mapping[str, Sequence[str]] = TEAMS,
    bounds: str = "calendar",
) -> DataFrame:
    """The rows of all extracts from one scan, once per extract a row is in.

    Fixed columns, ``extract``, ``date_name`` and ``date`` (the attribute the extract goes by), and
    ``contract_client_type`` and ``is_closed_paid``, which are NULL for extracts that do not show them.
    Written with ``write_split(rows, root, ["extract"])`` this gives all sheets in one job.
    """
    conditions = {e: _condition(e, as_of, teams, bounds) for e in EXTRACTS.values()}
    hits = ", ".join(f"CASE WHEN {condition} THEN {_hit(e)} END" for e, condition in conditions.items())
    hit = f"inline(filter(array({hits}), h -> h IS NOT NULL))"
    rows = flat.where(" OR ".join(f"({c})" for c in conditions.values())).selectExpr(*_fixed_columns(flat), hit)
    return rows.withColumn("date", as_seconds(F.col("date")))


def _hit(extract: Extract) -> str:
    source, date = _date(extract)
    client = "keys.contract_client_type" if extract.client else "CAST(NULL AS STRING)"
    paid = f"({source}.contract_status <=> {literal(fixed.CTC_CLOSED_PAID)})" if extract.closed_paid else "CAST(NULL AS BOOLEAN)"
    fields = {
        "extract": literal(extract.title),
        "date_name": literal(extract.date),
        "date": date,
        "contract_client_type": client,
        "is_closed_paid": paid,
    }
    return f"named_struct({', '.join(f'{literal(name)}, {value}' for name, value in fields.items())})"


def half_titles(prefix: str, as_of: datetime) -> tuple[str, str]:
    """Titles of the two halves of the month before ``as_of``."""
    first = first_of_month(as_of, -1)
    last_day = (first_of_month(as_of, 0) - first).days
    month = first.strftime("%B %Y")
    return f"{prefix} 1-15 {month}", f"{prefix} 16-{last_day} {month}"


def half_title(date_text: Column, prefix: str, as_of: datetime) -> Column:
    first, second = half_titles(prefix, as_of)
    return F.when(F.dayofmonth(date_text.cast("date")) <= 15, first).otherwise(second)


def closed_halves(
    flat: DataFrame, as_of: datetime, teams: Mapping[str, Sequence[str]] = TEAMS, **options
) -> DataFrame:
    """Last month's closings with the workbook (half of the month) and the sheet (team) each row belongs to.

    Rows without a team belong to no sheet and are left out, as in a group by team.
    """
    spec = EXTRACTS["closed"]
    rows = extract_rows(flat, spec, as_of, teams, **options).where("team_name IS NOT NULL")
    return rows.withColumn("workbook", half_title(F.col(spec.date), spec.title, as_of)).withColumn(
        "sheet", F.concat("team_name", F.lit(" - Closed Properties"))
    )
