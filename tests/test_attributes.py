import json

import pytest
from pyspark.sql import functions as F

from dealreports.functions import attributes as A

CASES = {
    "missing": ('[{"key":"b","label":"B","value":1}]', None, None),
    "null value": ('[{"key":"a","label":"A","value":null}]', None, None),
    "twice": ('[{"key":"a","value":"1"},{"key":"a","value":"2"}]', "1", "2"),
    "null first": ('[{"key":"a","value":null},{"key":"a","value":"2"}]', None, "2"),
    "null last": ('[{"key":"a","value":"1"},{"key":"a","value":null}]', "1", None),
    "no object": ('[7,"x",null,[1],{"key":"a","value":"1"}]', "1", "1"),
    "top-level object": ('{"key":"a","value":"1"}', None, None),
    "empty": ("[]", None, None),
    "no json": ("not json", None, None),
    "cut off": ('[{"key":"a","value":"1"}', None, None),
    "blank": ("", None, None),
    "null": (None, None, None),
    "number": ('[{"key":"a","value":350}]', "350", "350"),
    "decimal": ('[{"key":"a","value":12.10}]', "12.1", "12.1"),
    "true": ('[{"key":"a","value":true}]', "true", "true"),
    "list": ('[{"key":"a","value":[1,2]}]', "[1,2]", "[1,2]"),
    "object": ('[{"key":"a","value":{"x":1}}]', '{"x":1}', '{"x":1}'),
    "quotes and breaks": (json.dumps([{"key": "a", "value": 'say "hi"\n\\'}]), 'say "hi"\n\\', 'say "hi"\n\\'),
}


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(name, text) for name, (text, _, _) in CASES.items()]
    return spark.createDataFrame(rows, "name string, field_values string")


@pytest.mark.parametrize("keep,position", [("first", 1), ("last", 2)])
def test_extract_by_key(texts, keep, position):
    got = {r["name"]: r["a"] for r in A.extract(texts, ["a"], keep=keep).collect()}
    assert got == {name: case[position] for name, case in CASES.items()}


def test_single_values_agree_with_extract(texts):
    text = F.col("field_values")
    got = texts.select("name", A.first_value(text, "a").alias("f"), A.last_value(text, "a").alias("l")).collect()
    assert {r["name"]: (r["f"], r["l"]) for r in got} == {n: c[1:] for n, c in CASES.items()}


def test_an_element_without_value_is_passed_over_only_when_required(spark):
    text = '[{"label":"A","value":"1"},{"label":"A"}]'
    df = spark.createDataFrame([(text,)], "field_values string")
    assert A.extract(df, ["A"], by="label", keep="last").first()["A"] is None
    assert A.extract(df, ["A"], by="label", keep="last", require_value=True).first()["A"] == "1"


def test_an_explicit_null_is_a_value(spark):
    df = spark.createDataFrame([('[{"label":"A","value":"1"},{"label":"A","value":null}]',)], "field_values string")
    assert A.extract(df, ["A"], by="label", keep="last", require_value=True).first()["A"] is None


def test_labels_with_spaces_dots_brackets_and_quotes(spark):
    labels = ["Preferred  Ai  CTC", "Date Created]", "a.b", "it's", "back`tick"]
    text = json.dumps([{"label": label, "value": str(i)} for i, label in enumerate(labels)])
    df = spark.createDataFrame([(text,)], "field_values string")
    assert list(A.extract(df, labels, by="label").first()) == ["0", "1", "2", "3", "4"]
    flat = A.flatten(df, A.FlatSpec(labels=labels, labels_last=labels))
    assert list(flat.first()["labels"]) == list(flat.first()["labels_last"]) == ["0", "1", "2", "3", "4"]


def test_flat_table_types_only_the_dates_it_is_told(spark):
    text = '[{"key":"closing_date","label":"Closing","value":"3/5/2024"}]'
    df = spark.createDataFrame([(1, text)], "id int, field_values string")
    flat = A.flatten(df, A.FlatSpec(keys=["closing_date"], labels=["Closing"], key_dates=["closing_date"]))
    row = flat.selectExpr("id", "keys.closing_date AS d", "labels.Closing AS t").first()
    assert (row["id"], str(row["d"]), row["t"]) == (1, "2024-03-05 00:00:00", "3/5/2024")


def test_discovery_gives_the_union_of_labels_and_keeps_every_row(texts, spark):
    rows = [(1, '[{"label":"x","value":1},{"label":"x","value":2}]'), (2, '[{"label":"y","value":"z"}]'), (3, "no")]
    df = spark.createDataFrame(rows, "id int, field_values string")
    wide = A.wide_discovered(df)
    assert wide.columns == ["id", "x", "y"]
    assert {tuple(r) for r in wide.collect()} == {(1, "2", None), (2, None, "z"), (3, None, None)}
    with pytest.raises(ValueError):
        A.label_names(A.parse_once(df), most=1)
    assert {r["label"] for r in A.labels_in(A.parse_once(df)).collect()} == {"x", "y"}


def test_text_that_is_more_than_one_list_is_unreadable(spark):
    whole = '[{"key":"a","label":"A","value":1}]'
    rest = [" xx", "]", "[2]", ",[2]", "] [", " [", ',"z"', "]]", " {}"]
    rows = [(i, whole + r) for i, r in enumerate(rest)] + [(100, f" {whole}\n"), (101, '[{"key":"a","value":NaN}]'), (102, whole[:-1])]
    df = spark.createDataFrame(rows, "id int, field_values string")
    got = {r["id"]: r["a"] for r in A.extract(df, ["a"]).collect()}
    assert got == {i: "1" if i == 100 else None for i, _ in rows}
    assert A.unreadable(df).first()["rejected"] == len(rows) - 1


def test_one_parse_for_each_row(spark):
    df = spark.createDataFrame([(1, "[]")], "id int, field_values string")
    plan = A.extract(df, ["a", "b"]).where("a = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1


def test_unreadable_counts_set_text_only(texts):
    # the object is JSON but no list
    assert A.unreadable(texts).first()["rejected"] == 4


def test_a_filter_on_an_attribute_does_not_repeat_the_parse(texts):
    plan = A.extract(texts, ["a"]).where("a = '1'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_result_does_not_depend_on_the_partitions(texts):
    one, many = (A.extract(texts.repartition(n), ["a"]).collect() for n in (1, 8))
    assert sorted(one, key=str) == sorted(many, key=str)


def test_many_lookups_are_compiled(spark):
    """A group of many names gives what the list says, and none of its lookups is a function that Spark interprets."""
    wanted = [f"Label {i}" for i in range(120)]
    items = [7, {"label": "Label 3", "value": "a"}, {"label": "other", "value": "b"}, {"label": "Label 3", "value": None},
             {"label": "Label 3"}, {"label": None, "value": "c"}, {"label": "Label 119", "value": 5}]
    df = spark.createDataFrame([(1, json.dumps(items)), (2, None), (3, "[]"), (4, "no list")], "id int, field_values string")
    flat = A.flatten(df, A.FlatSpec(labels=wanted, labels_last=wanted))
    rows = {r["id"]: r.asDict(recursive=True) for r in flat.collect()}
    full = lambda found: {w: found.get(w) for w in wanted}
    assert rows[1]["labels"] == full({"Label 3": "a", "Label 119": "5"})
    assert rows[1]["labels_last"] == full({"Label 119": "5"})
    assert all(rows[i]["labels"] == rows[i]["labels_last"] == full({}) for i in (2, 3, 4))
    top = flat._jdf.queryExecution().optimizedPlan().toString().split("+- Generate")[0]
    assert "array_position" in top and "lambda" not in top


def test_names_with_the_same_bit_are_told_apart(spark, properties):
    """More names than bits: many of them share one, and one that is missing stays NULL."""
    names = [f"name {i}" for i in range(300)]
    rows = [(json.dumps([{"key": n, "label": n, "value": n} for n in names[start::3]]),) for start in range(3)]
    found = A.extract(spark.createDataFrame(rows, "field_values string"), names, keep="last", require_value=True)
    for start, row in enumerate(found.collect()):
        assert row.asDict() == {n: n if i % 3 == start else None for i, n in enumerate(names)}


# Elements of a list, and whether a list of them is read as texts at once.
ELEMENTS = {
    '{"key":"a","label":"A","value":"1"}': True,
    '{"key": "a", "label": "A", "value": "say \\"hi\\" \\u0041{}[],:"}': True,
    '{"value":null,"label":null,"key":"a"}': True,
    '{"label":true,"key":"a","value":false}': True,
    '{"key":"a","label":0,"value":-350}': True,
    '{"key":"a","label":"A","value":123456789012345678}': True,
    '{"key":"a","label":"A","value":12.10}': False,
    '{"key":"a","label":"A","value":-0}': False,
    '{"key":"a","label":"A","value":{"x": 1}}': False,
    '{"key":"a","label":"A","value":[1, 2]}': False,
    '{"key":"a","label":"A"}': False,
    '{"key":"a","label":"A","value":"1","x":"y"}': False,
    '7': False,
}


def test_plain_lists_and_others_are_read_alike(spark):
    """A list is plain or, for one element more that is no object, not; its other elements are the same then."""
    rows = [(i, n, f"[{e}, {e}{more}]") for i, e in enumerate(ELEMENTS) for n, more in enumerate(["", ", 7"])]
    df = spark.createDataFrame(rows, "i int, n int, t string").withColumn("is_plain", F.col("t").rlike(A._PLAIN))
    assert {r["i"] for r in df.where("is_plain").collect()} == {i for i, plain in enumerate(ELEMENTS.values()) if plain}
    read = df.select("i", "n", F.slice(A.items(F.col("t")), 1, 2).alias("x"), F.slice(A.items(F.col("t"), ["key"], False), 1, 2).alias("k"))
    found = {(r["i"], r["n"]): r for r in read.collect()}
    for i, element in enumerate(ELEMENTS):
        plain, other = found[i, 0], found[i, 1]
        assert plain["x"] == other["x"] and len(plain["x"]) == 2
        assert [x and (x["key"], x["value"]) for x in plain["k"]] == [x and (x["key"], x["value"]) for x in other["k"]]
        if element != "7":
            assert [(x["key"], x["value"]) for x in plain["x"]] == [(x["key"], x["value"]) for x in plain["k"]]
            assert [x["has_value"] for x in plain["x"]] == ["value" in element] * 2


def test_lists_that_only_look_plain_are_unreadable(spark):
    """A name given twice, an escape or a sign that JSON does not know, a list that goes on."""
    good = '{"key":"a","label":"A","value":"1"}'
    bad = ['{"key":"a","key":"b","value":"1"}', '{"key":"a","label":"A","value":"\\q"}', '{"key":"a","label":"A","value":"\t"}',
           '{"key":"a","label":"A","value":007}', good + "]}, [" + good, good + ","]
    df = spark.createDataFrame([(f"[{good},{b}]",) for b in bad], "field_values string")
    assert [r["a"] for r in A.extract(df, ["a"]).collect()] == [None] * len(bad)
    assert A.unreadable(df).first()["rejected"] == len(bad)


def test_a_long_list_is_plain(spark):
    one = {"key": "k", "label": "l", "value": 'v "' * 50}
    df = spark.createDataFrame([(json.dumps([one] * 20_000),)], "t string")
    assert tuple(df.select(F.col("t").rlike(A._PLAIN), F.size(A.items(F.col("t")))).first()) == (True, 20_000)
