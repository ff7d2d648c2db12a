import json
import random

import pytest

from dealreports.functions.attributes import parse_once
from dealreports.functions.discovery import add_up, class_counts, class_sql, types_of
from dealreports.operators import spelling
from dealreports.operators.spelling import nearest_in_list


@pytest.mark.parametrize(
    ("text", "kind"),
    [("7", "whole"), ("-12", "whole"), ("1.5", "money"), ("$1,234.50", "money"), ("1234567890123456789012", "text"), ("12,34", "text"),
     ("2024-02-29", "yyyy-MM-dd"), ("2024-02-30", "text"), ("2/29/2024", "M/d/yyyy"), ("13/1/2024", "text"), ("2024-01-01 10:00:00", "yyyy-MM-dd HH:mm:ss"),
     ("1/2/2024 9:05", "M/d/yyyy H:mm"), ("", "blank"), ("  ", "blank"), ("TBD", "text"), ("1e5", "text")],
)
def test_classes(spark, text, kind):
    assert spark.createDataFrame([(text,)], "v string").selectExpr(class_sql("v")).first()[0] == kind


def parsed_of(spark, values):
    rows = [(json.dumps([{"key": "k", "label": label, "value": v}]),) for label, v in values]
    return parse_once(spark.createDataFrame(rows, "field_values string"))


def test_types_and_misfits(spark):
    values = [("day", "2024-01-01")] * 97 + [("day", "1/2/2024")] * 2 + [("day", "soon")]
    values += [("n", "5")] * 19 + [("n", "x")] + [("m", "5")] * 10 + [("m", "5.5")] * 10 + [("t", "5")] * 18 + [("t", "x")] * 2
    values += [("b", "")] * 3 + [("none", None)] + [("raw", 5)] * 2
    counts = class_counts(parsed_of(spark, values))
    got = {r["label"]: (r["type"], r["format"], r["n_values"], r["n_blank"], round(r["misfits"], 3)) for r in types_of(counts).collect()}
    assert got == {
        "day": ("date", "yyyy-MM-dd", 100, 0, 0.01), "n": ("whole", None, 20, 0, 0.05), "m": ("money", None, 20, 0, 0.0),
        "t": ("text", None, 20, 0, 0.0), "b": ("text", None, 0, 3, 0.0), "raw": ("whole", None, 2, 0, 0.0),
    }
    assert types_of(counts, misfits=0.1).where("label = 't'").first()["type"] == "whole"


def test_batches_add_up(spark):
    rng = random.Random(1)
    values = [(rng.choice("abc"), rng.choice(["1", "2.5", "x", "", "2024-01-01"])) for _ in range(200)]
    whole = class_counts(parsed_of(spark, values))
    both = add_up(class_counts(parsed_of(spark, values[:70])), class_counts(parsed_of(spark, values[70:])))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, both.collect()))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, last = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("edits", [1, 2])
def test_nearest_is_that_of_all_pairs(spark, edits):
    rng = random.Random(edits)
    words = lambda n: ["".join(rng.choices("abü ", k=rng.randrange(0, 7))) for _ in range(n)]
    values, listed = words(120) + ["CTC - Pendng", "Compliance Ready to Bill"], words(25) + ["CTC - Pending", "Compliance - Ready to BILL"]
    df = spark.createDataFrame([(v,) for v in [*values, None]], "v string").repartition(3)
    names = spark.createDataFrame([(v,) for v in [*listed, None]], "name string")
    got = {r["value"]: (r["distance"], r["nearest"]) for r in nearest_in_list(df, "v", names, edits=edits).collect()}
    for v in set(values):
        near = min((distance(v, w), w.encode(), w) for w in listed)
        assert got[v] == ((near[0], near[2]) if near[0] <= edits else (None, None))
    assert len(got) == len(set(values))


def test_many_values_share_deletions(spark):
    """Names that differ in their digits only share most deletions; each still gets its own nearest."""
    values = spark.range(300).selectExpr("concat('N', lpad(id * 7 % 1000, 3, '0')) AS v")
    names = spark.range(300).selectExpr("concat('N', lpad(id * 3, 3, '0')) AS name")
    got = {r["value"]: r["nearest"] for r in nearest_in_list(values, "v", names).collect()}
    listed = [f"N{3 * i:03d}" for i in range(300)]
    for v in list(got)[::17]:
        assert got[v] == min((distance(v, w), w) for w in listed)[1]
    assert len(got) == 300


def test_deletions_are_not_broadcast_and_two_edits_only_where_needed(spark, monkeypatch):
    """However small the texts look in a plan, their deletions go to no driver; near values have no deletions of two."""
    made, keyed = [], spelling.keyed
    monkeypatch.setattr(spelling, "keyed", lambda *args: made.append((args[0].count(), args[2])) or keyed(*args))
    values = spark.createDataFrame([("Agent 1",), ("Agent 25",), ("Agent 999",)], "v string")
    names = spark.createDataFrame([("Agent 2",), ("Agent 26",), ("Agent 34",)], "name string")
    got = {r["value"]: (r["nearest"], r["distance"]) for r in nearest_in_list(values, "v", names).collect()}
    assert got == {"Agent 1": ("Agent 2", 1), "Agent 25": ("Agent 2", 1), "Agent 999": (None, None)}
    assert made == [(3, 1), (3, 1), (1, 2), (3, 2)]
    texts = spark.createDataFrame([("Agent 1",)], "value string")
    plan = spelling._within(texts, texts, 2)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
