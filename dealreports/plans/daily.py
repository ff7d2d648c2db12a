"""Daily update: per month of a year, a matrix of coordinators by 23 measures.

Every measure of a row counts in one month, or from one month on, or up to one month. So a row yields only the
few (name, month, measure) hits it has, the hits are counted once for the whole year, and the measures that
hold for several months are running sums over at most twelve counts per name.
"""

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.functions.calendar import (
    date_sql,
    in_year_sql,
    long_month_label,
    moment_sql,
    month_end_sql,
    months_of_year,
)
from dealreports.functions.text import field, in_list, quoted
from dealreports.operators.columns import fill_counts, in_order, named
from dealreports.operators.counting import month_literals

NAME = "Empower TC Name"
AGENT_NAME = "Transaction Coordinator"

DATES = {
    "start": "CTC Started with Empower",
    "closing": "Closing",
    "listing": "Listing Started with Empower",
    "listing_paid": "Listing PAID Date",
    "offer": "Offer Started with Empower",
    "compliance": "Compliance Started with Empower",
    "onboard": "Onboard Call Complete Date",
    "first_transaction": "1st Transaction Date",
}
TEXTS = {
    "name": NAME,
    "agent_name": AGENT_NAME,
    "status": "Contract Status",
    "provided_by": "Agent Provided by",
    "onboarding": "Onboarding Status",
    "other_status": "Other Status",
}


@dataclass(frozen=True)
class Measure:
    """What a measure counts.

    ``rule``: the date is in the month (``in``), after today and the month (``active``), in the next month
    (``next``), after the next month (``later``), up to the start of the month (``until``), or in the month of
    onboarding (``onboarded``).
    """

    title: str
    date: str
    rule: str = "in"
    column: str | None = None
    values: tuple[str, ...] = ()
    key: str = "name"


_CTC = tuple(fixed.DAILY_CTC_STATUSES)
_PREFERRED = tuple(fixed.DAILY_PREFERRED_STATUSES)
_PENDING = (fixed.CTC_PENDING,)
_PREFERRED_PENDING = (fixed.PREFERRED_PENDING,)

# Titles of the measures in report order, with the dates and values they test.
MEASURES = [
    Measure("Total ACTIVE Files - CTC", "closing", "active", "status", _CTC),
    Measure("Total ACTIVE Files - CTC Preferred", "closing", "active", "status", _PREFERRED),
    Measure("CTC Started for this month", "start", "in", "status", _CTC),
    Measure("CTC - Preferred Started", "start", "in", "status", _PREFERRED),
    Measure("Closings for this month", "closing", "in", "status", _CTC),
    Measure("CTC - Preferred Closings", "closing", "in", "status", _PREFERRED),
    Measure("CTC Pending for this month", "closing", "in", "status", _PENDING),
    Measure("CTC - Preferred Pending for this month", "closing", "in", "status", _PREFERRED_PENDING),
    Measure("CTC Pending for next month", "closing", "next", "status", _PENDING),
    Measure("CTC - Preferred Pending for next month", "closing", "next", "status", _PREFERRED_PENDING),
    Measure("CTC Pending for other months", "closing", "later", "status", _PENDING),
    Measure("CTC - Preferred Pending for other months", "closing", "later", "status", _PREFERRED_PENDING),
    Measure("Offers Started this month", "offer"),
    Measure("Compliance Started this month", "compliance"),
    Measure("Listing Started", "listing"),
    Measure("Listing PAID", "listing_paid"),
    Measure("TC Generated Agents", "onboard", "until", "provided_by", ("TC",), "agent_name"),
    Measure("SALES Generated Agents", "onboard", "until", "provided_by", ("Empower",), "agent_name"),
    Measure("TOTAL Agents", "onboard", "until", "provided_by", ("Empower", "TC"), "agent_name"),
    Measure("1st Transaction Agents", "onboard", "until", "onboarding", ("1st Transaction",), "agent_name"),
    Measure(
        "Lost Agents/return to Sales",
        "onboard",
        "until",
        "other_status",
        tuple(fixed.LOST_AGENT_STATUSES),
        "agent_name",
    ),
    Measure("OB for This Month", "onboard", key="agent_name"),
    Measure("1st Transactions for This Month", "first_transaction", "onboarded", key="agent_name"),
]


def source(flat: DataFrame, date_filler: datetime = fixed.REPORT_DATE_FILLER) -> DataFrame:
    """The columns the measures test. A missing onboard date is ``date_filler``, so it lies before any month."""
    dates = {n: date_sql(field("labels", label)) for n, label in DATES.items()}
    dates["onboard"] = f"coalesce({dates['onboard']}, {moment_sql(date_filler)})"
    return flat.selectExpr(
        *[f"{field('labels', label)} AS {n}" for n, label in TEXTS.items()],
        *[f"{text} AS {n}" for n, text in dates.items()],
    )


def _hit_month(measure: Measure, year: int, as_of: datetime, scope: str) -> tuple[str, str]:
    """Condition and month of a row's hit: the month it counts in, or the first or last of several."""
    january, december = f"DATE '{year}-01-01'", f"DATE '{year}-12-01'"
    date = measure.date
    month = f"trunc({date}, 'MM')"
    in_this_year = in_year_sql(date, year)
    by_second = f"{date} <= {month_end_sql(date)}"  # a fraction after the last second belongs to no month
    if measure.rule == "in":
        return f"{in_this_year} AND {by_second}", month
    if measure.rule == "onboarded":
        return f"{in_this_year} AND {by_second} AND {month} = trunc(onboard, 'MM')", month
    if measure.rule == "until":
        first = f"greatest({january}, CASE WHEN {date} <= {month} THEN {month} ELSE add_months({month}, 1) END)"
        return f"{first} <= {december}", first
    if measure.rule == "active":
        open_today, over = f"{date} >= {moment_sql(as_of)}", f"{date} >= {month_end_sql(date)}"
        if scope == "period":
            return f"{in_this_year} AND {open_today} AND {over}", month
        last = f"least({december}, CASE WHEN {over} THEN {month} ELSE add_months({month}, -1) END)"
        return f"{open_today} AND {last} >= {january}", last
    if scope == "period":
        return "FALSE", month  # the closing would have to lie in the month and after it
    if measure.rule == "next":
        before = f"add_months({month}, -1)"
        return f"{date} > {month} AND {by_second} AND {before} BETWEEN {january} AND {december}", before
    last = f"least({december}, add_months({month}, CASE WHEN {by_second} THEN -2 ELSE -1 END))"
    return f"{date} IS NOT NULL AND {last} >= {january}", last


def _hits(rows: DataFrame, year: int, as_of: datetime, scope: str) -> DataFrame:
    """(name, month, measure): number 0 for every coordinator, -1 for every month with a start, then the measures."""
    found = [
        "named_struct('name', name, 'month', CAST(NULL AS DATE), 'measure', 0)",
        f"CASE WHEN {in_year_sql('start', year)} THEN "
        "named_struct('name', CAST(NULL AS STRING), 'month', trunc(start, 'MM'), 'measure', -1) END",
    ]
    for number, m in enumerate(MEASURES, start=1):
        condition, month = _hit_month(m, year, as_of, scope)
        condition = f"{m.key} IS NOT NULL AND {condition}"
        if m.column:
            condition = f"{m.column} IN {in_list(m.values)} AND {condition}"
        found.append(
            f"CASE WHEN {condition} THEN named_struct('name', {m.key}, 'month', {month}, 'measure', {number}) END"
        )
    return rows.selectExpr(f"inline(filter(array({', '.join(found)}), h -> h IS NOT NULL))")


def daily_update(
    flat: DataFrame,
    year: int,
    as_of: datetime,
    scope: str = "period",
    months: Sequence[datetime] | None = None,
) -> DataFrame:
    """(month, period, Empower TC Name, 23 counts) for every coordinator and every month with a contract start.

    ``scope='period'`` looks for active and pending files only among the closings of the month itself;
    ``'all'`` looks at all closings. ``months`` names the months and spares the pass that finds them.
    """
    if scope not in ("period", "all"):
        raise ValueError(f"scope must be 'period' or 'all', not {scope!r}")
    rows = source(flat)
    counted = _hits(rows, year, as_of, scope).groupBy("name", "month", "measure").agg(F.count("*").alias("n"))
    spread = counted.selectExpr(
        "name",
        "measure",
        "n",
        f"explode(CASE WHEN measure = 0 THEN {month_literals(months_of_year(year))} ELSE array(month) END) AS month",
    )
    per_month = spread.groupBy("name", "month").agg(
        F.expr("max(measure = 0) AS is_coordinator"),
        F.expr("max(measure = -1) AS has_start"),
        *[
            F.expr(f"sum(CASE WHEN measure = {number} THEN n ELSE 0 END) AS {quoted(m.title)}")
            for number, m in enumerate(MEASURES, start=1)
        ],
    )
    so_far = Window.partitionBy("name").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    from_here = Window.partitionBy("name").orderBy("month").rowsBetween(0, Window.unboundedFollowing)
    running = {"until": so_far}
    if scope == "all":
        running |= {"active": from_here, "later": from_here}
    summed = per_month.withColumns(
        {m.title: F.sum(named(m.title)).over(running[m.rule]) for m in MEASURES if m.rule in running}
    )
    if months is None:  # those in which some contract started; a month has a row for each coordinator
        shown = F.max("has_start").over(Window.partitionBy("month"))
    else:
        shown = F.col("month").isin([m.date() for m in months])
    summed = summed.withColumn("shown", shown)
    shown = summed.where("is_coordinator AND shown")
    report = fill_counts(shown, [m.title for m in MEASURES])
    report = report.withColumn("period", long_month_label("month")).withColumnRenamed("name", NAME)
    return in_order(report, ["month", "period", NAME, *[m.title for m in MEASURES]])
