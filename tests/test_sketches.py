import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from dealreports.plans import sketches as sk

SCHEMA = "month date, team string, tc string, amount double"


def records(n, seed=1):
    rng = random.Random(seed)
    return [
        (date(2024, rng.randrange(1, 13), 1), "hot" if rng.random() < 0.4 else f"t{rng.randrange(5)}", f"tc {rng.randrange(3000)}", float(rng.randrange(10**6)))
        for _ in range(n)
    ]


def make(df, keys):
    return sk.sketched(df, keys, {"tc": F.col("tc")}, {"amount": F.col("amount")})


def rank_of(values, x):
    """Shares of values below, and below or at."""
    return sum(v < x for v in values) / len(values), sum(v <= x for v in values) / len(values)


@pytest.fixture(scope="module")
def rows():
    return records(30_000)


def test_quarters_from_months(spark, rows):
    months = make(spark.createDataFrame(rows, SCHEMA).repartition(7), ["month", "team"])
    merged = sk.merged(months.withColumn("quarter", F.quarter("month")), ["quarter"])
    out = merged.select("quarter", "n", sk.distinct_count("tc").alias("tc"), *[sk.quantile("amount", q).alias(f"q{i}") for i, q in enumerate((0, 0.25, 0.5, 0.9, 1))])
    for r in out.collect():
        held = [x for x in rows if (x[0].month + 2) // 3 == r["quarter"]]
        exact, amounts = len({x[2] for x in held}), [x[3] for x in held]
        assert r["n"] == len(held)
        assert abs(r["tc"] - exact) <= 4 * 0.016 * exact
        assert (r["q0"], r["q4"]) == (min(amounts), max(amounts))
        for name, q in (("q1", 0.25), ("q2", 0.5), ("q3", 0.9)):
            low, high = rank_of(amounts, r[name])
            assert low - 0.01 <= q <= high + 0.01


def test_batches_add_up(spark, rows):
    """Merged batches know what one pass knows: the distinct counts are the same, ranks within the same bound."""
    df = spark.createDataFrame(rows[:9000], SCHEMA)
    parts = [make(spark.createDataFrame(rows[i : i + 3000], SCHEMA), ["team"]) for i in (0, 3000, 6000)]
    whole = {r["team"]: r for r in make(df, ["team"]).select("team", "n", sk.distinct_count("tc").alias("tc"), sk.n_values("amount").alias("v")).collect()}
    added = sk.add_up(["team"], *parts)
    got = added.select("team", "n", sk.distinct_count("tc").alias("tc"), sk.n_values("amount").alias("v"), sk.quantile("amount", 0.5).alias("m")).collect()
    assert {r["team"] for r in got} == set(whole)
    for r in got:
        amounts = [x[3] for x in rows[:9000] if x[1] == r["team"]]
        low, high = rank_of(amounts, r["m"])
        assert (r["n"], r["v"]) == (whole[r["team"]]["n"], len(amounts))
        assert abs(r["tc"] - whole[r["team"]]["tc"]) <= 0.02 * whole[r["team"]]["tc"] + 1
        assert low - 0.01 <= 0.5 <= high + 0.01


def test_groups_without_values(spark):
    rows = [(None, "a", None, None), (None, "a", None, None), (date(2024, 1, 1), None, "x", 5.0), (date(2024, 1, 1), None, "x", 5.0)]
    out = make(spark.createDataFrame(rows, SCHEMA), ["month", "team"])
    out = sk.merged(out, ["month", "team"])
    got = out.select("month", "team", "n", sk.distinct_count("tc").alias("tc"), sk.quantile("amount", 0.5).alias("m"), sk.n_values("amount").alias("v"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(
        [(None, "a", 2, 0, None, 0), (date(2024, 1, 1), None, 2, 1, 5.0, 2)], key=str
    )


def test_no_rows(spark):
    assert sk.merged(make(spark.createDataFrame([], SCHEMA), ["team"]), ["team"]).count() == 0


def test_rows_are_sketched_before_the_shuffle(spark, rows):
    """A hot group shuffles a sketch for each task, not its rows."""
    plan = make(spark.createDataFrame(rows[:100], SCHEMA), ["team"])._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("Exchange") :]
    assert "partial_hll_sketch_agg" in below and "partial_kll_sketch_agg_double" in below
