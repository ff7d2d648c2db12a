"""Reading entity tables, column lists and CSV columns."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PROPERTIES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("created", T.StringType()),
        T.StructField("timezone", T.StringType()),
        T.StructField("field_values", T.StringType()),
        T.StructField("team_id", T.LongType()),
        T.StructField("team_name", T.StringType()),
        T.StructField("team_user_id", T.LongType()),
        T.StructField("team_user_name", T.StringType()),
        T.StructField("agent_id", T.LongType()),
        T.StructField("agent_name", T.StringType()),
        T.StructField("brokerage", T.StringType()),
        T.StructField("api_data", T.StringType()),
        T.StructField("inbound_email_address", T.StringType()),
    ]
)


def read_properties(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """One file, a directory, a glob or several of them; the schema is fixed, so nothing is inferred."""
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.schema(PROPERTIES).parquet(*paths)


def read_list(spark: SparkSession, path: str) -> DataFrame:
    """First field of every line of a header-less CSV, as ``name``; spaces belong to the names."""
    return spark.read.schema("name string").csv(path, enforceSchema=True).where("name IS NOT NULL")


def list_values(names: DataFrame, most: int | None = None) -> list[str]:
    """A list file as Python strings, for column lists; ``most`` refuses more names than so many."""
    names = names.select("name")
    rows = (names if most is None else names.limit(most + 1)).collect()
    if most is not None and len(rows) > most:
        raise ValueError(f"more than {most} names: join on them instead")
    return [r["name"] for r in rows]


def read_csv_columns(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Some columns of a CSV with a header; the others are not parsed."""
    return spark.read.option("header", True).csv(path).select(*[F.col(f"`{c}`") for c in columns])
