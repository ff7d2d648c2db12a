"""Keyed refresh of the landing area: the newest version of every record, whatever order pages arrive in.

The table lies in buckets by record key. A batch of pages is reduced to the newest version of each record, held
against the buckets its records fall into, and only buckets in which a record really changes are written anew; the
others keep their files. The new state appears with one manifest, which also names the last batch of the stream, so
a batch that is run again after a failure changes nothing.

The newer of two versions is the one with the later ``updated``; of one moment, a deletion, then the greater hash of
the content. That order does not depend on arrival: late pages, repeated pages and pages in another order give the
same table. Deleted records stay as marks, so that a late older version does not bring them back; readers skip them.

A record without a whole number as id has the id 0; such records are told apart by their content and never replace
one another. A moment that cannot be read counts as the earliest.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from dealreports.session import written
from dealreports.sinks import manifest
from dealreports.sources.ingest import as_text, enforce, read_pages
from dealreports.sources.tables import PROPERTIES

BUCKETS = 64

# What pages may have besides the record's own fields.
CHANGES = T.StructType([*PROPERTIES.fields, T.StructField("updated", T.StringType()), T.StructField("deleted", T.StringType())])
STATE = (
    T.StructType([*PROPERTIES.fields, T.StructField("updated", T.TimestampNTZType())])
    .add("deleted", T.BooleanType())
    .add("key", T.StringType())
    .add("content", T.LongType())
)


def _order() -> list[Column]:
    """Newest first."""
    return [F.col("updated").desc_nulls_last(), F.col("deleted").desc(), F.col("content").desc()]


def versions_of(pages: DataFrame) -> DataFrame:
    """Typed records with moment, deletion mark, key and content hash; one row a version of a record."""
    typed = enforce(pages, CHANGES)
    content = F.xxhash64(*[F.col(f.name) for f in PROPERTIES])
    typed = typed.withColumns(
        {
            "updated": F.expr("try_cast(updated AS TIMESTAMP_NTZ)"),
            "deleted": F.coalesce(F.lower("deleted") == "true", F.lit(False)),
            "content": content,
        }
    )
    key = F.when(F.col("id") == 0, F.concat(F.lit("#"), F.col("content"))).otherwise(F.col("id").cast("string"))
    return typed.withColumn("key", key).select(*STATE.fieldNames())


def newest_versions(versions: DataFrame) -> DataFrame:
    """One row a key. Each task keeps one candidate a key before the shuffle, so a hot key stays small."""
    order = Window.partitionBy("key").orderBy(*_order())
    return versions.withColumn("rank", F.row_number().over(order)).where("rank = 1").drop("rank")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("key"), F.lit(buckets)).cast("int")


def upsert(
    spark: SparkSession,
    out: str,
    pages: DataFrame,
    batch: int | None = None,
    buckets: int = BUCKETS,
    first: Callable[[DataFrame, int | None], object] | None = None,
) -> manifest.State:
    """Takes a batch of pages into the table at ``out``. ``batch`` numbers the batches of a stream from 0.

    ``first`` is called with the records that change (newest versions, deleted ones marked) and the number of the
    batch before the table changes. After a failure it is called again with the same records, so what it keeps
    must know its batches, as ``plans.increments`` does.
    """
    before = manifest.state(spark, out)
    buckets = before.notes.get("buckets", buckets)
    if batch is not None and batch <= before.notes.get("batch", -1):
        return before
    notes = {"buckets": buckets, "batch": before.notes.get("batch", -1) if batch is None else batch}
    arrived = newest_versions(versions_of(pages)).withColumn("bucket", _bucket(buckets))
    arrived = written(arrived, "arrived")
    touched = [str(r[0]) for r in arrived.select("bucket").distinct().collect()]  # at most one value a bucket
    held = manifest.read(spark, out, STATE, touched)
    rank = F.struct(F.coalesce("updated", F.expr("TIMESTAMP_NTZ '0001-01-01'")).alias("u"), "deleted", "content")
    known = held.select("key", rank.alias("known"))
    changed = arrived.join(known, "key", "left").where(F.col("known").isNull() | (rank > F.col("known"))).drop("known")
    changed = written(changed, "changed")
    names = [str(r[0]) for r in changed.select("bucket").distinct().collect()]
    if not names:
        return before if batch is None else manifest.commit(spark, out, before, before.entries, notes)
    if first is not None:
        first(changed, batch)
    kept = manifest.read(spark, out, STATE, names).join(changed.select("key"), "key", "left_anti")
    rows = kept.withColumn("bucket", _bucket(buckets)).select(*changed.columns).unionByName(changed)
    folder = manifest.staged()
    rows = rows.hint("rebalance", F.col("bucket"))
    rows.write.partitionBy("bucket").parquet(f"{out.rstrip('/')}/{folder}")
    return manifest.commit(spark, out, before, before.entries | {n: f"{folder}/bucket={n}" for n in names}, notes)


def read_refreshed(spark: SparkSession, out: str, version: int | None = None) -> DataFrame:
    """The newest version of every record that is not deleted, as ``sources.tables.read_properties`` gives records."""
    return manifest.read(spark, out, STATE, version=version).where("NOT deleted").select(*PROPERTIES.fieldNames())


def refresh_stream(
    spark: SparkSession,
    pages: str,
    out: str,
    checkpoint: str,
    files_per_batch: int = 1000,
    buckets: int = BUCKETS,
    first: Callable[[DataFrame, int | None], object] | None = None,
) -> StreamingQuery:
    """Takes the pages that arrived since the last run into the table, and stops. ``first`` as in ``upsert``.

    A run that fails between the commit of the table and that of the stream repeats its batch; the manifest knows it.
    One checkpoint belongs to one table.
    """

    def take(batch: DataFrame, number: int) -> None:
        upsert(spark, out, batch, number, buckets, first)

    stream = spark.readStream.schema(as_text(CHANGES)).option("maxFilesPerTrigger", files_per_batch).json(pages)
    writer = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def land_at_once(spark: SparkSession, pages: str, out: str) -> manifest.State:
    """Full refresh from all pages that appears at once; a run that fails leaves the table as it was."""
    before, folder = manifest.state(spark, out), manifest.staged()
    enforce(read_pages(spark, pages)).write.option("compression", "snappy").parquet(f"{out.rstrip('/')}/{folder}")
    return manifest.commit(spark, out, before, {"all": folder})
