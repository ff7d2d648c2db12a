"""Intermediate tables in the shared folder, packed well: they are written once and read a few times."""

from pyspark.sql import DataFrame

from dealreports.session import scratch_path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back; cuts the lineage, and survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or a longer one if ``df`` has such a column in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
