"""Nineteen monthly counts in one pass: one row per count, one column per month up to the reporting month."""

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports.functions.calendar import in_year_sql, months_of_year, year_to_date_sql
from dealreports.functions.text import in_list, literal, quoted
from dealreports.operators.counting import counts_on_spine, later_months, months_as_columns


@dataclass(frozen=True)
class Kpi:
    """``rule``: count by month, by the month before (``next``), or over the later months (``rest``)."""

    kpi: int
    state: str
    date: str
    statuses: tuple[str, ...]
    teams: str | None = None
    client: str | None = None
    rule: str = "month"
    keep: str = "first"


# Report names, dates, statuses, team lists and client types of the counts, in report order.
KPIS = [
    Kpi(1, "CTC - Preferred Started", "ctc_started_with_empower", ("CTC - Preferred - Pending",), "preferred"),
    Kpi(2, "CTC - Preferred Closing", "closing_date", ("CTC - Preferred - Closed - Ready to BILL",), "preferred"),
    Kpi(3, "CTC - Started", "ctc_started_with_empower", ("CTC - Pending",), "ctc"),
    Kpi(4, "CTC - Closing", "closing_date", ("CTC - Closed - PAID",), "ctc"),
    Kpi(5, "CTC - Terminated", "closing_date", ("CTC - Terminated - No Charge",), "ctc"),
    Kpi(6, "CTC - Withdrawn", "closing_date", ("CTC - Withdrawn",), "ctc"),
    Kpi(7, "Client Type-Buyer", "closing_date", ("CTC - Closed - PAID",), "ctc", "Buyer", keep="last"),
    Kpi(
        8,
        "Preferred (epique) Buyer Closed",
        "closing_date",
        ("CTC - Preferred - Closed - Ready to BILL",),
        "preferred",
        "Buyer",
        keep="last",
    ),
    Kpi(9, "Client Type-Seller", "closing_date", ("CTC - Closed - PAID",), "ctc", "Seller", keep="last"),
    Kpi(
        10,
        "Preferred (epique) Seller Closed",
        "closing_date",
        ("CTC - Preferred - Closed - Ready to BILL",),
        "preferred",
        "Seller",
        keep="last",
    ),
    Kpi(11, "Listing - Started with Empower", "listing_started_with_empower", ("Listing - Pre-Listing",)),
    Kpi(12, "Listing - Paid", "listing_paid_date", ("Listing - PAID",)),
    Kpi(13, "Compliance - Started with Empower", "compliance_started_with_empower", ("Compliance",)),
    Kpi(14, "Compliance - Paid", "compliance_paid_date", ("Compliance - PAID",)),
    Kpi(
        15,
        "All Closing Current Month",
        "closing_date",
        ("CTC - Closed - PAID", "CTC - Preferred - Closed - Ready to BILL"),
    ),
    Kpi(
        16,
        "Future Closing Next Month - Preffered",
        "closing_date",
        ("CTC - Preferred - Pending",),
        "preferred",
        rule="next",
    ),
    Kpi(17, "Future Closing Next Month - CTC", "closing_date", ("CTC - Pending",), "ctc", rule="next"),
    Kpi(
        18,
        "Future Closing All Other Month - Preferred",
        "closing_date",
        ("CTC - Preferred - Pending",),
        "preferred",
        rule="rest",
    ),
    Kpi(19, "Future Closing All Other Month - CTC", "closing_date", ("CTC - Pending",), "ctc", rule="rest"),
]


def date_of(kpi: Kpi) -> str:
    return f"{'keys_last' if kpi.keep == 'last' else 'keys'}.{kpi.date}"


def _condition(kpi: Kpi, as_of: datetime, teams: Mapping[str, Sequence[str]]) -> str:
    date = date_of(kpi)
    if kpi.rule == "month":
        parts = [year_to_date_sql(date, as_of)]
    elif kpi.rule == "next":
        # the next month's closings stand in this month's column; January's would stand in the year before
        parts = [year_to_date_sql(date, as_of, extra_months=1), f"month({date}) > 1"]
    else:
        parts = [in_year_sql(date, as_of.year)]
    return " AND ".join([*parts, member_sql(kpi, teams)])


def member_sql(kpi: Kpi, teams: Mapping[str, Sequence[str]]) -> str:
    """What a record must have besides the date to belong to a count."""
    parts = [f"keys.contract_status IN {in_list(kpi.statuses)}"]
    if kpi.teams:
        parts.append(f"team_name IN {in_list(teams[kpi.teams])}")
    if kpi.client:
        parts.append(f"keys_last.contract_client_type = {literal(kpi.client)}")
    return " AND ".join(parts)


def _some_day_in_year(kpis: Sequence[Kpi], year: int) -> str:
    """Lets the scan skip the parts of the table that lie in other years."""
    days = dict.fromkeys(date_of(k).replace("keys", "days") for k in kpis)
    return " OR ".join(f"{day} BETWEEN DATE '{year}-01-01' AND DATE '{year}-12-31'" for day in days)


def _hit(kpi: Kpi, as_of: datetime, teams: Mapping[str, Sequence[str]]) -> str:
    month = f"trunc({date_of(kpi)}, 'MM')"
    if kpi.rule == "next":
        month = f"add_months({month}, -1)"
    return f"CASE WHEN {_condition(kpi, as_of, teams)} THEN named_struct('kpi', {kpi.kpi}, 'month', {month}) END"


def monthly_kpis(
    flat: DataFrame, as_of: datetime, teams: Mapping[str, Sequence[str]], kpis: Sequence[Kpi] = KPIS
) -> DataFrame:
    """(kpi, state, month, n) with every month of the year up to ``as_of``.

    A row of the flat table is read once and yields one hit per count it belongs to.
    """
    spark = flat.sparkSession
    statuses = sorted({s for k in kpis for s in k.statuses})
    hits = ", ".join(_hit(k, as_of, teams) for k in kpis)
    found = (
        flat.where(f"keys.contract_status IN {in_list(statuses)}")
        .where(_some_day_in_year(kpis, as_of.year))
        .selectExpr(f"inline(filter(array({hits}), h -> h IS NOT NULL))")
    )
    ids = spark.range(1).selectExpr(f"explode(array({', '.join(str(k.kpi) for k in kpis)})) AS kpi")
    counts = counts_on_spine(found, ids, months_of_year(as_of.year))
    later = [k.kpi for k in kpis if k.rule == "rest"]
    if later:
        # every month of the year counts towards the later months, so the cut to ``as_of`` comes after
        rest = F.when(F.col("kpi").isin(later), later_months("kpi")).otherwise(F.col("n"))
        counts = counts.withColumn("n", rest)
    return counts.where(F.col("month") <= F.lit(as_of.date())).select("kpi", state_of(kpis), "month", "n")


def state_of(kpis: Sequence[Kpi]) -> Column:
    cases = " ".join(f"WHEN {k.kpi} THEN {literal(k.state)}" for k in kpis)
    return F.expr(f"CASE kpi {cases} END AS state")


def kpis_wide(counts: DataFrame, as_of: datetime) -> DataFrame:
    """One row per count in report order, one column per month (``Mar 2024``)."""
    return months_as_columns(counts, ["kpi", "state"], months_of_year(as_of.year, as_of.month)).orderBy("kpi")


def kpi_summary_json(wide: DataFrame) -> DataFrame:
    """One JSON text per count: its name and its months."""
    months = [quoted(c) for c in wide.columns if c != "kpi"]
    return wide.select("kpi", F.to_json(F.struct(*months)).alias("summary"))
