"""Files as they were: active files of every coordinator at the end of each month, from all versions of the records."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dealreports import fixed
from dealreports.functions.text import in_list
from dealreports.operators.asof import intervals
from dealreports.operators.counting import month_literals

ACTIVE = (*fixed.DAILY_CTC_STATUSES, *fixed.DAILY_PREFERRED_STATUSES)


def active_at_month_ends(
    history: DataFrame, months: Sequence[datetime], statuses: Sequence[str] = ACTIVE
) -> DataFrame:
    """(name, month, n): records whose version at the end of the month is active, for every name and month.

    ``history`` has ``id, updated, name, status``: a row for each version. A version holds from its moment up to the
    next of its record. It counts 1 from the first month whose end it reaches, and -1 from the first month whose end
    the next one reaches; the numbers of a month are running sums over the months, so no version is paired with the
    months it holds in. Names without an active version have no rows.
    """
    held = intervals(history, ["id"], "updated").where(f"status IN {in_list(statuses)} AND name IS NOT NULL")
    begins = "CAST(trunc(updated, 'MM') AS DATE)"
    ends = "CAST(trunc(until, 'MM') AS DATE)"
    steps = held.where(f"until IS NULL OR {begins} < {ends}").selectExpr(
        "name", f"inline(array(struct({begins} AS month, 1 AS n), struct({ends} AS month, -1 AS n)))"
    )
    first, last = F.lit(min(months).date()), F.lit(max(months).date())
    steps = steps.where("month IS NOT NULL").withColumn("month", F.greatest("month", first)).where(F.col("month") <= last)
    steps = steps.groupBy("name", "month").agg(F.sum("n").alias("n"))
    names = steps.select("name").distinct().selectExpr("name", f"explode({month_literals(list(months))}) AS month", "0L AS n")
    so_far = Window.partitionBy("name").orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    summed = steps.unionByName(names).groupBy("name", "month").agg(F.sum("n").alias("n"))
    summed = summed.withColumn("n", F.sum("n").over(so_far))
    return summed.where(F.col("month").isin([m.date() for m in months]))
