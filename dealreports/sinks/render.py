"""Cells as text."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.operators.columns import named


def as_seconds(moment: Column) -> Column:
    """A timestamp as ``2024-03-16 00:00:00``, without going through a time zone."""
    return F.substring(moment.cast("timestamp_ntz").cast("string"), 1, 19)


def one_line(text: Column) -> Column:
    """Line feeds become spaces, carriage returns go."""
    return F.translate(text, "\n\r", " ")


def _cell(f: T.StructField) -> Column:
    value = named(f.name)
    if isinstance(f.dataType, (T.TimestampNTZType, T.TimestampType)):
        return as_seconds(value)
    if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
        return F.when(~F.isnan(value), value.cast("string"))
    if isinstance(f.dataType, T.BooleanType):
        return F.initcap(value.cast("string"))
    return value.cast("string")


def render(df: DataFrame) -> DataFrame:
    """All cells as text; NULL and NaN are empty."""
    return df.select(*[F.coalesce(_cell(f), F.lit("")).alias(f.name) for f in df.schema])


def render_on_one_line(df: DataFrame) -> DataFrame:
    """The same without line breaks, as the extracts are written."""
    return df.select(*[F.coalesce(one_line(_cell(f)), F.lit("")).alias(f.name) for f in df.schema])
