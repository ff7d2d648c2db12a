"""Distinct counts and quantiles kept as mergeable sketches, one row for each month and group.

A distinct count cannot be added up over months, nor can a median. Sketches can be merged: a HyperLogLog sketch for
every distinct count, a KLL sketch for every measure. They are made once from a month's records (partly in every task,
so a hot month or group shuffles a sketch and not its rows), stored, and merged over any range of months or set of
groups without the records. A batch of records that only adds is sketched alone and merged in; sketches cannot forget,
so a changed or deleted record needs its month made anew.

Bounds: with ``LG_K`` 12 the standard error of a distinct count is 1.6 %, and small counts are exact; with
``KLL_K`` 800 a quantile's rank is off by less than 0.5 % with probability 0.99, and up to about 800 values it is exact
but for interpolation. Merging does not widen either bound. Lowest and highest value (quantiles 0 and 1) are exact.

NULL is no value. A group without any value has a distinct count of 0 and NULL quantiles. Months of records without a
date, and groups without a name, are the month or group NULL.
"""

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_K = 12
KLL_K = 800

_DISTINCT, _VALUES = "distinct_", "values_"


def sketched(
    rows: DataFrame,
    keys: Sequence[str],
    distinct: Mapping[str, Column] | None = None,
    values: Mapping[str, Column] | None = None,
) -> DataFrame:
    """``keys``, ``n`` (rows) and a binary column for each name of ``distinct`` and ``values``."""
    columns = [F.count(F.lit(1)).alias("n")]
    columns += [F.hll_sketch_agg(c, F.lit(LG_K)).alias(f"{_DISTINCT}{name}") for name, c in (distinct or {}).items()]
    columns += [
        F.kll_sketch_agg_double(c.cast("double"), F.lit(KLL_K)).alias(f"{_VALUES}{name}") for name, c in (values or {}).items()
    ]
    return rows.groupBy(*keys).agg(*columns)


def merged(sketches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketches of all rows that agree in ``keys`` (fewer or coarser ones than they were made by) as one row."""
    columns = [F.sum("n").alias("n")]
    for name in sketches.columns:
        if name.startswith(_DISTINCT):
            columns.append(F.hll_union_agg(name).alias(name))
        elif name.startswith(_VALUES):
            columns.append(F.kll_merge_agg_double(name).alias(name))
    return sketches.groupBy(*keys).agg(*columns)


def add_up(keys: Sequence[str], *batches: DataFrame) -> DataFrame:
    """Sketches of several batches as those of all their records."""
    return merged(reduce(DataFrame.unionByName, batches), keys)


def distinct_count(name: str) -> Column:
    """The number of different values of a measure given as ``distinct``."""
    return F.coalesce(F.hll_sketch_estimate(f"{_DISTINCT}{name}"), F.lit(0).cast("long"))


def quantile(name: str, rank: float) -> Column:
    """The value below or at which the share ``rank`` of a measure's values lies; NULL where there is none."""
    sketch = F.col(f"{_VALUES}{name}")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0, F.kll_sketch_get_quantile_double(sketch, F.lit(float(rank))))


def n_values(name: str) -> Column:
    """How many values (not NULL) a measure's sketch has seen."""
    return F.coalesce(F.kll_sketch_get_n_double(F.col(f"{_VALUES}{name}")), F.lit(0).cast("long"))
