"""Activity over event time: sliding windows and sessions of the changes that pages bring, with late rows.

A row belongs to windows by its own moment, not by when it arrives. The watermark is the latest moment seen so far less
``late``; a window or session is written once, when the watermark has passed its end, and what it says is then final.
Rows whose windows are all written are too late: they change nothing and are counted (``too_late``). So over everything
that arrived, the written windows are those a batch job computes from all rows but the too late ones.

Rows are counted in every task before the shuffle, also into sessions, so a hot key shuffles partial counts. The state is
one row for each open window or session and key; the watermark bounds it. Without a moment a row belongs to no window.
NULL is a key like others.
"""

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from dealreports.sources.ingest import as_text
from dealreports.streaming.refresh import CHANGES, versions_of

LOCAL_SESSIONS = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def _measures(sums: Mapping[str, Column] | None) -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(name) for name, c in (sums or {}).items()]]


def _flat(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    others = [c for c in windows.columns if c not in (*keys, "window")]
    return windows.select(*keys, F.col("window.start").alias("start"), F.col("window.end").alias("end"), *others)


def windows(
    rows: DataFrame,
    moment: str,
    keys: Sequence[str],
    size: str,
    slide: str | None = None,
    late: str = "0 seconds",
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``keys, start, end, n`` and sums for every window of ``size`` that starts every ``slide`` and has a row.

    A window holds its start and not its end. ``rows`` is a stream or a table; of a table nothing is late.
    """
    timed = rows.withWatermark(moment, late) if rows.isStreaming else rows
    grouped = timed.groupBy(*keys, F.window(moment, size, slide or size).alias("window"))
    return _flat(grouped.agg(*_measures(sums)), keys)


def sessions(
    rows: DataFrame,
    moment: str,
    keys: Sequence[str],
    gap: str,
    late: str = "0 seconds",
    sums: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``keys, start, end, n`` and sums of every session: rows of a key no further apart than ``gap``.

    ``end`` is the last row's moment and ``gap``. A late row may join two sessions that are still open.
    """
    if not keys:
        raise ValueError("sessions need a key")
    rows.sparkSession.conf.set(LOCAL_SESSIONS, "true")
    timed = rows.withWatermark(moment, late) if rows.isStreaming else rows
    grouped = timed.groupBy(*keys, F.session_window(moment, gap).alias("window"))
    return _flat(grouped.agg(*_measures(sums)), keys)


def page_changes(spark: SparkSession, pages: str, files_per_batch: int = 1000) -> DataFrame:
    """A stream of the record versions that pages bring, with ``moment``, when a record was changed by its own clock."""
    stream = spark.readStream.schema(as_text(CHANGES)).option("maxFilesPerTrigger", files_per_batch).json(pages)
    return versions_of(stream).withColumn("moment", F.col("updated").cast("timestamp"))


def write_closed(closed: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Appends the windows or sessions that what arrived since the last run has closed, and stops.

    Open ones stay in the checkpoint's state for the next run. Every one is written exactly once, also after a failure.
    """
    writer = closed.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start(out)


def too_late(query: StreamingQuery) -> int:
    """How many (partly counted) rows of a finished run came after their window was written."""
    return sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in p["stateOperators"])
