"""Counts per month with every month present, and totals over tables."""

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dealreports.functions.calendar import short_month_label
from dealreports.operators.columns import named

TOTAL = "Total Result"


def month_of(date: str) -> Column:
    return F.expr(f"trunc({date}, 'MM')")


def month_literals(months: list[datetime]) -> str:
    return f"array({', '.join(f"DATE '{m:%Y-%m-%d}'" for m in months)})"


def counts_on_spine(hits: DataFrame, keys: DataFrame, months: list[datetime], weight: str | None = None) -> DataFrame:
    """``hits`` (key, month) counted for every row of ``keys`` and every month: (key, month, n).

    The empty cells ride along with weight 0, so one aggregation does it and no join is needed. ``keys`` is a
    short list of known keys. ``weight`` names a column of numbers to add up instead of counting rows.
    """
    key = keys.columns[0]
    cells = keys.selectExpr(key, f"explode({month_literals(months)}) AS month", "0 AS n")
    weighted = hits.select(key, "month", (F.lit(1) if weight is None else named(weight)).alias("n")).unionByName(cells)
    return weighted.groupBy(key, "month").agg(F.sum("n").alias("n"))


def later_months(key: str) -> Column:
    """Sum of the later months' counts of a key, where counts have one row per key and month."""
    later = Window.partitionBy(key).orderBy("month").rowsBetween(1, Window.unboundedFollowing)
    return F.coalesce(F.sum("n").over(later), F.lit(0))


def months_as_columns(counts: DataFrame, keys: list[str], months: list[datetime]) -> DataFrame:
    """One column per month, named ``Mar 2024``."""
    labels = [m.strftime("%b %Y") for m in months]
    labelled = counts.withColumn("label", short_month_label("month"))
    return labelled.groupBy(*keys).pivot("label", labels).agg(F.first("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct values, no NULL."""
    return df.select(named(column)).na.drop().distinct().orderBy(named(column))


def cells_with_totals(df: DataFrame, row: str, column: str, amount: str) -> DataFrame:
    """Sums per cell, per row, per column and overall; the totals are called ``Total Result``.

    Rows without a row or column key are left out, as a pivot leaves them out. The cube, which multiplies its
    input by four, runs on the cells and not on the rows.
    """
    known = df.where(named(row).isNotNull() & named(column).isNotNull())
    cells = known.groupBy(named(row), named(column)).agg(F.sum(named(amount)).alias("amount"))
    cube = cells.cube(named(row), named(column)).agg(
        F.sum("amount").alias("amount"),
        F.grouping(named(row)).alias("__all_rows"),
        F.grouping(named(column)).alias("__all_columns"),
    )
    return cube.select(
        F.when(F.col("__all_rows") == 1, TOTAL).otherwise(named(row)).alias(row),
        F.when(F.col("__all_columns") == 1, TOTAL).otherwise(named(column)).alias(column),
        F.coalesce("amount", F.lit(0)).cast(df.schema[amount].dataType).alias("amount"),
    )


def totals_matrix(cells: DataFrame, row: str, column: str, columns: list[str]) -> DataFrame:
    """The cells as a matrix, empty ones 0, with the total as last column.

    A cell in a column that is not listed ends the job with an error: the totals would not be the sum of the row.
    """
    known = F.when(named(column).isin([*columns, TOTAL]), named(column))
    unknown = F.raise_error(F.concat(F.lit("the matrix has no column "), named(column)))
    wide = cells.withColumn(column, F.coalesce(known, unknown.cast("string")))
    return wide.groupBy(named(row)).pivot(column, [*columns, TOTAL]).agg(F.first("amount")).na.fill(0)
