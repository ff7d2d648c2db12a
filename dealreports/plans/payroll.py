"""Payroll: transactions with half-month periods and amounts, and matrices of coordinator by half month."""

from collections.abc import Sequence
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.functions.calendar import half_month_end, half_month_label, half_month_start, moment_sql
from dealreports.functions.text import field, quoted
from dealreports.operators.columns import MONEY, RATED_MONEY, changed, fill_dates, indicator, sum_of, to_dates, to_money
from dealreports.operators.counting import TOTAL, cells_with_totals, totals_matrix
from dealreports.operators.filters import member_of
from dealreports.session import written

COORDINATOR = "Empower TC Name"

# The dates with a half-month period, and how the period columns are called.
PERIODS = {
    "closing": "Closing",
    "listing": "Listing PAID Date",
    "ctc": "CTC PAID Date",
    "compliance": "Compliance PAID Date",
    "offer_prep": "Offer Prep PAID Date",
}
START_DATES = ["Listing Started with Empower", "Offer Started with Empower", "Compliance Started with Empower"]
DATES = [*PERIODS.values(), *START_DATES]

# Amounts that count only when their service was paid, by period.
PAID_AMOUNTS = {
    "listing": "Listing PAID Amount",
    "ctc": "CTC PAID Amount",
    "offer_prep": "Offer Prep PAID Amount",
    "compliance": "Compliance PAID Amount",
}

# Projections and the start date and period each of them compares.
PROJECTIONS = {
    "Listing Projection": ("Listing Started with Empower", "listing"),
    "Offer Projection": ("Offer Started with Empower", "offer_prep"),
    "Compliance Projection": ("Compliance Started with Empower", "compliance"),
}

# What each matrix sums, and by which period.
MODES = {"p": ("Projected Amount", "closing_periode"), "a": ("Actual Amount", "ctc_periode")}


def enrich(
    flat: DataFrame,
    rate: Decimal = fixed.COMMISSION_RATE,
    labels: Sequence[str] = fixed.TRANSACTION_LABELS,
    date_filler: datetime = fixed.REPORT_DATE_FILLER,
) -> DataFrame:
    """Every row by label, with periods, paid amounts, projections, revenue and commission.

    An empty date counts as ``date_filler`` and so has a period too, but no amount.
    """
    df = flat.selectExpr(*[f"{field('labels', label)} AS {quoted(label)}" for label in labels])
    df = fill_dates(to_dates(df, DATES), DATES, date_filler)
    df = df.withColumns(_period_columns())
    empty = moment_sql(date_filler)

    def inside(date: str, period: str) -> str:
        return (
            f"(`{date}` <> {empty} AND `{date}` >= {period}_period_start AND `{date}` <= {period}_period_end)"
        )

    def when_paid(period: str, amount: str, kind: str) -> str:
        return f"CAST(CASE WHEN {inside(PERIODS[period], period)} THEN {amount} ELSE 0 END AS {kind})"

    df = changed(
        df,
        {
            "TC Commission Rate": f"CAST({rate} AS DECIMAL(6,4))",
            "Billing Amount": to_money("`Billing Amount`"),
            **{a: when_paid(p, to_money(f"`{a}`"), MONEY) for p, a in PAID_AMOUNTS.items()},
            "CTC Projection": indicator(f"Closing <> {empty}"),
            **{n: indicator(inside(date, period)) for n, (date, period) in PROJECTIONS.items()},
        },
    )
    projections = ", ".join(f"`{n}`" for n in ["CTC Projection", *PROJECTIONS])
    df = changed(
        df,
        {
            "TC Commission Amount": f"CAST(`Billing Amount` * `TC Commission Rate` AS {RATED_MONEY})",
            "Projection Condition": f"greatest({projections})",
            "TC Revenue": sum_of(f"`{a}`" for a in PAID_AMOUNTS.values()),
        },
    )
    return changed(
        df,
        {
            "Projected Amount": when_paid("closing", "`TC Commission Amount`", RATED_MONEY),
            "Actual Amount": when_paid("ctc", "`TC Revenue` * `TC Commission Rate`", RATED_MONEY),
            "TC Revenue Amount": when_paid("ctc", "`TC Revenue`", MONEY),
        },
    )


def _period_columns() -> dict[str, Column]:
    columns = {}
    for period, date in PERIODS.items():
        columns[f"{period}_period_start"] = half_month_start(quoted(date))
        columns[f"{period}_period_end"] = half_month_end(quoted(date))
        columns[f"{period}_periode"] = half_month_label(quoted(date))
    return columns


def payroll_cells(
    enriched: DataFrame, mode: str, coordinators: Sequence[str] | DataFrame = fixed.PAYROLL_COORDINATORS
) -> DataFrame:
    """(coordinator, period, amount) with totals; mode ``p`` projected by closing, ``a`` actual by payment."""
    if mode not in MODES:
        raise ValueError(f"mode must be 'p' or 'a', not {mode!r}")
    amount, period = MODES[mode]
    chosen = member_of(enriched, COORDINATOR, coordinators)
    cells = cells_with_totals(chosen, COORDINATOR, period, amount)
    return cells.withColumnRenamed(period, "periode")


def payroll_matrix(
    enriched: DataFrame,
    mode: str,
    coordinators: Sequence[str] | DataFrame = fixed.PAYROLL_COORDINATORS,
    periods: Sequence[str] | None = None,
) -> DataFrame:
    """The cells as a matrix with a column per period that occurs, in order, and the total last.

    The rows are read once: the periods come from the cells, a few for each coordinator and half month, which are
    written first. Give ``periods`` to write nothing; a cell in a period that is not among them is an error.
    """
    cells = payroll_cells(enriched, mode, coordinators)
    if periods is None:
        cells = written(cells, "payroll-cells")
        periods = sorted(r[0] for r in cells.select("periode").distinct().collect() if r[0] != TOTAL)
    return totals_matrix(cells, COORDINATOR, "periode", list(periods))


def periods_in(enriched: DataFrame, mode: str, coordinators: Sequence[str] | DataFrame) -> DataFrame:
    """The half months that occur, as a table: (periode)."""
    _, period = MODES[mode]
    found = member_of(enriched, COORDINATOR, coordinators).select(F.col(period).alias("periode"))
    return found.na.drop().distinct()


def matrix_cells(matrix: DataFrame) -> DataFrame:
    """A matrix as (coordinator, periode, amount), empty cells with 0."""
    return matrix.unpivot(quoted(COORDINATOR), [quoted(c) for c in matrix.columns[1:]], "periode", "amount")
