"""Incremental landing: pages that arrived since the last run, each exactly once."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from dealreports.sources.ingest import as_text, enforce
from dealreports.sources.tables import PROPERTIES


def page_stream(spark: SparkSession, pages: str, files_per_batch: int = 1000) -> DataFrame:
    return enforce(
        spark.readStream.schema(as_text(PROPERTIES)).option("maxFilesPerTrigger", files_per_batch).json(pages)
    )


def land_stream(spark: SparkSession, pages: str, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the new pages to the landing area and stops. Stateless; the checkpoint knows what was read.

    A record that is fetched again is in the table twice; ``refresh.refresh_stream`` keeps its newest version only.
    """
    return (
        page_stream(spark, pages)
        .writeStream.format("parquet")
        .option("checkpointLocation", checkpoint)
        .option("compression", "snappy")
        .outputMode("append")
        .trigger(availableNow=True)
        .start(out)
    )
