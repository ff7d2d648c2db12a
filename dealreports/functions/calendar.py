"""Month and half-month arithmetic.

The reporting moment ``as_of`` is always a parameter. Bounds that depend only on it are computed on the
driver and enter the plan as literals, so that filters on dates reach the scan. Functions that take a
``date`` take it as SQL text: a column name or an expression.
"""

from calendar import monthrange
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dealreports.functions.text import literal, quoted

# How dates are written in the attribute values besides ISO, first match wins.
DATE_FORMATS = ("M/d/yyyy",)
DATETIME_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss")

_ALMOST_A_DAY = "INTERVAL '23:59:59' HOUR TO SECOND"


def moment_sql(value: datetime) -> str:
    return f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'"


def moment(value: datetime) -> Column:
    return F.expr(moment_sql(value))


def date_sql(text: str, date_formats=DATE_FORMATS, datetime_formats=DATETIME_FORMATS) -> str:
    """Date text to a timestamp without zone; ISO first, then the formats; NULL when none fits."""
    tries = [f"try_cast({text} AS TIMESTAMP_NTZ)"]
    tries += [f"CAST(try_to_date({text}, {literal(f)}) AS TIMESTAMP_NTZ)" for f in date_formats]
    tries += [f"CAST(try_to_timestamp({text}, {literal(f)}) AS TIMESTAMP_NTZ)" for f in datetime_formats]
    return f"coalesce({', '.join(tries)})"


def parse_date(text: str) -> Column:
    return F.expr(date_sql(text))


def rejected_dates(df: DataFrame, columns) -> DataFrame:
    """How many non-blank texts per column are no date: (column, rejected)."""
    counts = df.agg(
        *[F.expr(f"count_if({quoted(c)} <> '' AND {date_sql(quoted(c))} IS NULL)").alias(c) for c in columns]
    )
    return counts.unpivot([], [quoted(c) for c in columns], "column", "rejected")


# --- driver-side months -------------------------------------------------------------------------


def first_of_month(as_of: datetime, offset: int = 0) -> datetime:
    months = as_of.year * 12 + as_of.month - 1 + offset
    return datetime(months // 12, months % 12 + 1, 1)


def month_bounds(as_of: datetime, offset: int, bounds: str = "calendar") -> tuple[datetime, datetime]:
    """First and last moment of the month ``offset`` months from ``as_of``.

    ``calendar``: midnight of the 1st up to (not including) midnight of the next 1st.
    ``clock``: the 1st to the last day, both at the clock time of ``as_of``, both included.
    """
    first = first_of_month(as_of, offset)
    if bounds == "calendar":
        return first, first_of_month(as_of, offset + 1)
    if bounds == "clock":
        clock = as_of - datetime(as_of.year, as_of.month, as_of.day)
        last_day = monthrange(first.year, first.month)[1]
        return first + clock, first + timedelta(days=last_day - 1) + clock
    raise ValueError(f"bounds must be 'calendar' or 'clock', not {bounds!r}")


def in_month_sql(date: str, as_of: datetime, offset: int = 0, bounds: str = "calendar") -> str:
    low, high = month_bounds(as_of, offset, bounds)
    upper = "<" if bounds == "calendar" else "<="
    return f"({date} >= {moment_sql(low)} AND {date} {upper} {moment_sql(high)})"


def from_month_sql(date: str, as_of: datetime, offset: int = 1, bounds: str = "calendar") -> str:
    return f"({date} >= {moment_sql(month_bounds(as_of, offset, bounds)[0])})"


def in_month(date: str, as_of: datetime, offset: int = 0, bounds: str = "calendar") -> Column:
    return F.expr(in_month_sql(date, as_of, offset, bounds))


def from_month(date: str, as_of: datetime, offset: int = 1, bounds: str = "calendar") -> Column:
    return F.expr(from_month_sql(date, as_of, offset, bounds))


def in_month_days_sql(day: str, as_of: datetime, offset: int = 0) -> str:
    """The days that either kind of month bounds can touch; for skipping parts of the table."""
    low, high = first_of_month(as_of, offset), first_of_month(as_of, offset + 1)
    return f"({day} >= {day_sql(low)} AND {day} < {day_sql(high)})"


def day_sql(value: datetime) -> str:
    return f"DATE '{value:%Y-%m-%d}'"


def between_sql(date: str, low: datetime, high: datetime) -> str:
    return f"({date} >= {moment_sql(low)} AND {date} < {moment_sql(high)})"


def year_to_date_sql(date: str, as_of: datetime, extra_months: int = 0) -> str:
    """January of the year up to the month of ``as_of`` plus ``extra_months``, never past December."""
    last = datetime(as_of.year, min(as_of.month + extra_months, 12), 1)
    return between_sql(date, datetime(as_of.year, 1, 1), first_of_month(last, 1))


def in_year_sql(date: str, year: int) -> str:
    return between_sql(date, datetime(year, 1, 1), datetime(year + 1, 1, 1))


def year_to_date(date: str, as_of: datetime, extra_months: int = 0) -> Column:
    return F.expr(year_to_date_sql(date, as_of, extra_months))


def in_year(date: str, year: int) -> Column:
    return F.expr(in_year_sql(date, year))


def months_of_year(year: int, through: int = 12) -> list[datetime]:
    return [datetime(year, m, 1) for m in range(1, through + 1)]


# --- column-side periods ------------------------------------------------------------------------


def month_start(date: str) -> Column:
    return F.expr(f"CAST(trunc({date}, 'MM') AS TIMESTAMP_NTZ)")


def month_end_sql(date: str) -> str:
    """Last day of the month at 23:59:59."""
    return f"(CAST(last_day({date}) AS TIMESTAMP_NTZ) + {_ALMOST_A_DAY})"


def month_end(date: str) -> Column:
    return F.expr(month_end_sql(date))


def next_month_end(date: str) -> Column:
    """Last day of the following month at midnight."""
    return F.expr(f"CAST(last_day(add_months(trunc({date}, 'MM'), 1)) AS TIMESTAMP_NTZ)")


def _half_month_days(date: str) -> tuple[str, str]:
    first = f"trunc({date}, 'MM')"
    return (
        f"CASE WHEN day({date}) <= 15 THEN {first} ELSE date_add({first}, 15) END",
        f"CASE WHEN day({date}) <= 15 THEN date_add({first}, 14) ELSE last_day({date}) END",
    )


def half_month_start(date: str) -> Column:
    """The 1st or the 16th."""
    return F.expr(f"CAST({_half_month_days(date)[0]} AS TIMESTAMP_NTZ)")


def half_month_end(date: str) -> Column:
    """The 15th or the last day of the month, at 23:59:59."""
    return F.expr(f"CAST({_half_month_days(date)[1]} AS TIMESTAMP_NTZ) + {_ALMOST_A_DAY}")


def half_month_label(date: str) -> Column:
    """``2024/03/16 - 2024/03/31``"""
    start, end = _half_month_days(date)
    return F.expr(f"concat(date_format({start}, 'yyyy/MM/dd'), ' - ', date_format({end}, 'yyyy/MM/dd'))")


def long_month_label(date: str) -> Column:
    """``MARCH 2024``"""
    return F.expr(f"upper(date_format({date}, 'MMMM yyyy'))")


def short_month_label(date: str) -> Column:
    """``Mar 2024``"""
    return F.expr(f"date_format({date}, 'MMM yyyy')")


def parse_month_label(label: str) -> Column:
    """``MARCH 2024`` to the first of that month; NULL when it is no month label."""
    return F.expr(f"try_to_date(initcap({label}), 'MMMM yyyy')")


def period_table(spark: SparkSession, months: list[datetime], as_of: datetime) -> DataFrame:
    """``expanded`` for given months."""
    starts = ", ".join(moment_sql(m) for m in months)
    return expanded(spark.range(1).selectExpr(f"explode(array({starts})) AS period_start"), as_of)


def expanded(months: DataFrame, as_of: datetime) -> DataFrame:
    """One row per month (``period_start``): label, start, end, next start, next end, the later of end and ``as_of``."""
    return months.selectExpr(
        "upper(date_format(period_start, 'MMMM yyyy')) AS period",
        "period_start",
        "add_months(period_start, 1)::TIMESTAMP_NTZ - INTERVAL '1' SECOND AS period_end",
        "add_months(period_start, 1)::TIMESTAMP_NTZ AS next_start",
        "add_months(period_start, 2)::TIMESTAMP_NTZ - INTERVAL '1' SECOND AS next_end",
    ).withColumn("current_end", F.expr(f"greatest(period_end, {moment_sql(as_of)})"))
