"""The monthly counts kept up to date: a batch of changed records changes counts, nothing is counted anew.

A record belongs to some counts in some months (its hits). The hits of every record that has any are kept in buckets
by id, the counts per (kpi, month) in one small table. For a batch, the hits of its records as they are now count
1 each and those kept for the same records -1: counts are sums, so adding these to the table gives what counting all
records would give. Only the buckets of the batch's records are read and written. Hits and counts change with one
manifest, which also names the last batch; a batch that is run again changes nothing.

Hits do not depend on the reporting moment, so one table serves every ``as_of``.
"""

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.functions.calendar import day_sql, months_of_year
from dealreports.functions.text import in_list
from dealreports.operators.counting import counts_on_spine, later_months
from dealreports.plans.kpis import KPIS, Kpi, date_of, member_sql, state_of
from dealreports.session import written
from dealreports.sinks import manifest

BUCKETS = 64
HITS = T.StructType().add("id", "long").add("kpi", "integer").add("month", "date")
COUNTS = T.StructType().add("kpi", "integer").add("month", "date").add("n", "long")
COUNTS_ENTRY = "counts"


def hits_of(flat: DataFrame, teams: Mapping[str, Sequence[str]], kpis: Sequence[Kpi] = KPIS) -> DataFrame:
    """(id, kpi, month): every count a record belongs to, with the month of its date."""
    hits = ", ".join(
        f"CASE WHEN {date_of(k)} IS NOT NULL AND {member_sql(k, teams)} "
        f"THEN named_struct('kpi', {k.kpi}, 'month', trunc({date_of(k)}, 'MM')) END"
        for k in kpis
    )
    statuses = sorted({s for k in kpis for s in k.statuses})
    rows = flat.where(f"keys.contract_status IN {in_list(statuses)}")
    return rows.selectExpr("id", f"inline(filter(array({hits}), h -> h IS NOT NULL))")


def apply_changes(
    spark: SparkSession,
    root: str,
    changed: DataFrame,
    teams: Mapping[str, Sequence[str]],
    batch: int | None = None,
    kpis: Sequence[Kpi] = KPIS,
    buckets: int = BUCKETS,
) -> manifest.State:
    """Takes a batch into the counts: flat rows of records as they are now, one row a record.

    A column ``deleted`` marks records that are gone. Records of a batch that have been there before are replaced.
    """
    before = manifest.state(spark, root)
    buckets = before.notes.get("buckets", buckets)
    if batch is not None and batch <= before.notes.get("batch", -1):
        return before
    notes = {"buckets": buckets, "batch": before.notes.get("batch", -1) if batch is None else batch}
    bucket = F.pmod(F.xxhash64("id"), F.lit(buckets)).cast("int")
    present = changed.where("NOT coalesce(deleted, false)") if "deleted" in changed.columns else changed
    now = written(hits_of(present, teams, kpis), "hits")
    ids = written(changed.select("id").distinct().withColumn("bucket", bucket), "changed-ids")
    names = [str(r[0]) for r in ids.select("bucket").distinct().collect()]  # at most one value a bucket
    kept = manifest.read(spark, root, HITS, names)
    earlier = kept.join(ids.select("id"), "id", "left_semi")
    counts = manifest.read(spark, root, COUNTS, [COUNTS_ENTRY])
    signed = now.select("kpi", "month", F.lit(1).cast("long").alias("n")).unionByName(
        earlier.select("kpi", "month", F.lit(-1).cast("long").alias("n"))
    )
    counts = counts.unionByName(signed).groupBy("kpi", "month").agg(F.sum("n").alias("n")).where("n <> 0")
    folder = manifest.staged()
    top = f"{root.rstrip('/')}/{folder}"
    counts.coalesce(1).write.parquet(f"{top}/counts")  # a row for each kpi and month
    rest = kept.join(ids.select("id"), "id", "left_anti")
    rows = rest.unionByName(now).withColumn("bucket", bucket).hint("rebalance", F.col("bucket"))
    rows.write.partitionBy("bucket").parquet(f"{top}/hits")
    found = {name for name, _, _ in manifest.Files(spark, root).listed(f"{top}/hits")}
    entries = {k: v for k, v in before.entries.items() if k not in names}
    entries |= {n: f"{folder}/hits/bucket={n}" for n in names if f"bucket={n}" in found}
    return manifest.commit(spark, root, before, entries | {COUNTS_ENTRY: f"{folder}/counts"}, notes)


def kept_counts(spark: SparkSession, root: str) -> DataFrame:
    """(kpi, month, n) of all months, by the month of the record's date."""
    return manifest.read(spark, root, COUNTS, [COUNTS_ENTRY])


def kept_kpis(spark: SparkSession, root: str, as_of: datetime, kpis: Sequence[Kpi] = KPIS) -> DataFrame:
    """(kpi, state, month, n) as ``kpis.monthly_kpis`` gives them, from the kept counts alone."""
    year = f"month BETWEEN {day_sql(datetime(as_of.year, 1, 1))} AND {day_sql(datetime(as_of.year, 12, 1))}"
    following = [k.kpi for k in kpis if k.rule == "next"]
    later = [k.kpi for k in kpis if k.rule == "rest"]
    moved = F.when(F.col("kpi").isin(following), F.add_months("month", -1)).otherwise(F.col("month"))
    counts = kept_counts(spark, root).where(year).withColumn("month", moved).where(year)
    ids = spark.range(1).selectExpr(f"explode(array({', '.join(str(k.kpi) for k in kpis)})) AS kpi")
    counts = counts_on_spine(counts, ids, months_of_year(as_of.year), weight="n")
    if later:
        counts = counts.withColumn("n", F.when(F.col("kpi").isin(later), later_months("kpi")).otherwise(F.col("n")))
    return counts.where(F.col("month") <= F.lit(as_of.date())).select("kpi", state_of(kpis), "month", "n")
