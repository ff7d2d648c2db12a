"""Landing of record pages: typed, nested values as JSON text, full refresh.

Pages are JSON files: one record per line, or one list of records per line as a paged API returns them.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.sources.tables import PROPERTIES


def as_text(schema: T.StructType = PROPERTIES) -> T.StructType:
    """The schema with every field as text: the JSON reader then keeps nested values as JSON text."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema])


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PROPERTIES, multiline: bool = False) -> DataFrame:
    """Raw records, all text. ``multiline`` reads files that hold one list over several lines."""
    return spark.read.schema(as_text(schema)).option("multiLine", multiline).json(path)


def whole_number(value: Column) -> Column:
    """Text to a whole number: a fraction is cut off, anything else and NULL become 0."""
    return F.coalesce(value.try_cast("bigint"), value.try_cast("decimal(38,6)").try_cast("bigint"), F.lit(0))


def enforce(df: DataFrame, schema: T.StructType = PROPERTIES) -> DataFrame:
    """Exactly the columns of ``schema``: numbers coerced, the rest text, missing ones NULL, others dropped."""

    def typed(f: T.StructField) -> Column:
        if f.name not in df.columns:
            return F.lit(None).cast(f.dataType).alias(f.name)
        value = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.LongType):
            return whole_number(value.cast("string")).alias(f.name)
        if isinstance(df.schema[f.name].dataType, (T.ArrayType, T.MapType, T.StructType)):
            return F.to_json(value).alias(f.name)
        return value.cast("string").alias(f.name)

    return df.select(*[typed(f) for f in schema])


def nested_to_json(df: DataFrame) -> DataFrame:
    """Lists, maps and structs become JSON text; the other columns stay as they are."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    return df.select(
        *[
            F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, nested) else F.col(f"`{f.name}`")
            for f in df.schema
        ]
    )


def land(spark: SparkSession, pages: str, out: str, multiline: bool = False) -> None:
    """Full refresh of the landing area from all pages."""
    typed = enforce(read_pages(spark, pages, multiline=multiline))
    typed.write.mode("overwrite").option("compression", "snappy").parquet(out)


def land_agents(spark: SparkSession, pages: str, out: str, schema: T.StructType | None = None) -> None:
    """Snapshot of the agent records. Give the schema of an earlier run to spare the inference pass."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    nested_to_json(reader.json(pages)).write.mode("overwrite").parquet(out)
