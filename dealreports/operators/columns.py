"""Renames, fills, casts and indicators over lists of columns."""

from collections.abc import Iterable, Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports.fixed import SYSTEM_COLUMNS
from dealreports.functions.calendar import date_sql, moment_sql
from dealreports.functions.text import field, literal, quoted

MONEY = "DECIMAL(18,2)"
RATED_MONEY = "DECIMAL(20,4)"


def named(name: str) -> Column:
    """A column whose name may hold spaces or dots."""
    return F.col(quoted(name))


def changed(df: DataFrame, expressions: Mapping[str, str]) -> DataFrame:
    """``df`` with columns replaced or added by SQL expressions, all over the columns as they were."""
    kept = [
        f"{expressions[c]} AS {quoted(c)}" if c in expressions else quoted(c)
        for c in df.columns
    ]
    added = [f"{e} AS {quoted(c)}" for c, e in expressions.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)


def in_order(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.select(*[quoted(n) for n in names])


def side_by_side(df: DataFrame, group: str, labels: Iterable[str], *first: str) -> DataFrame:
    """The renamed system columns and some attributes of the flat table next to each other."""
    return df.selectExpr(
        *first,
        *[f"{raw} AS {quoted(name)}" for raw, name in SYSTEM_COLUMNS.items()],
        *[f"{field(group, label)} AS {quoted(label)}" for label in labels],
    )


def to_dates(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return changed(df, {n: date_sql(quoted(n)) for n in names})


def fill_dates(df: DataFrame, names: Iterable[str], filler: datetime) -> DataFrame:
    return changed(df, {n: f"coalesce({quoted(n)}, {moment_sql(filler)})" for n in names})


def is_blank(text: str) -> str:
    return f"({text} IS NULL OR {text} = '')"


def fill_blank(df: DataFrame, names: Iterable[str], filler: str) -> DataFrame:
    """NULL and empty text become ``filler``; columns that are no text are left alone."""
    texts = {f.name for f in df.schema if f.dataType.simpleString() == "string"}
    return changed(
        df, {n: f"coalesce(nullif({quoted(n)}, ''), {literal(filler)})" for n in names if n in texts}
    )


def fill_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return changed(df, {n: f"CAST(coalesce({quoted(n)}, 0) AS BIGINT)" for n in names})


def to_money(text: str) -> str:
    """Text to an amount, NULL when it is none."""
    return f"try_cast({text} AS {MONEY})"


def sum_of(amounts: Iterable[str]) -> str:
    """Row-wise sum where a missing amount counts as nothing."""
    return f"CAST({' + '.join(f'coalesce({a}, 0)' for a in amounts)} AS {MONEY})"


def indicator(condition: str) -> str:
    return f"CASE WHEN {condition} THEN 1 ELSE 0 END"
