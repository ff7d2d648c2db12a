"""Row conditions where NULL is a value like any other."""

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealreports.fixed import EXCLUDED_TITLE_WORDS
from dealreports.functions.text import in_list, literal, quoted
from dealreports.operators.columns import is_blank, named

# The dates that show that some service was started.
START_DATES = [
    "CTC Started with Empower",
    "Listing Started with Empower",
    "Offer Started with Empower",
    "Compliance Started with Empower",
]


def is_value(column: str, wanted: str) -> Column:
    return F.expr(f"{column} <=> {literal(wanted)}")


def is_not_value(column: str, wanted: str) -> Column:
    """True for NULL too."""
    return F.expr(f"NOT ({column} <=> {literal(wanted)})")


def member_of(df: DataFrame, column: str, names: Sequence[str] | DataFrame) -> DataFrame:
    """Rows whose column is in a list: literals for a short list, a semi join for a table of ``name``."""
    if isinstance(names, DataFrame):
        wanted = names.select(F.col("name").alias("__name"))
        return df.join(wanted, named(column) == F.col("__name"), "left_semi")
    return df.where(f"{quoted(column)} IN {in_list(names)}")


def title_is_excluded(title: str, words: Iterable[str] = EXCLUDED_TITLE_WORDS) -> Column:
    """Any of the words anywhere in the title, in any case; a NULL title is kept."""
    found = " OR ".join(f"contains(lower({title}), {literal(w)})" for w in words)
    return F.expr(f"coalesce({found}, FALSE)")


def never_started(name: str) -> Column:
    """The name is blank and no service has a start date."""
    return F.expr(" AND ".join([is_blank(name), *[f"{quoted(date)} IS NULL" for date in START_DATES]]))


def both_from_year(a: str, b: str, year: int) -> str:
    return f"coalesce(year({a}) >= {year} AND year({b}) >= {year}, FALSE)"
