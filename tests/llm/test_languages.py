import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dealreports.llm import languages as lang

SYLLABLES = {"aa": "ka to mi ru se no".split(), "bb": "schl ung ein ver ch er".split(), "cc": "ção ém os ar de ló".split()}


def sentence(rng, language, n):
    return " ".join("".join(rng.choice(SYLLABLES[language]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def labelled(n=300, seed=1):
    rng = random.Random(seed)
    return [(i, sentence(rng, g := rng.choice(list(SYLLABLES)), rng.randrange(20, 60)), g) for i in range(n)]


@pytest.fixture(scope="module")
def model(spark):
    rows = [(t, g) for _, t, g in labelled()] + [("text without language", None), (None, "aa"), ("", "bb")]
    return lang.learn(spark.createDataFrame(rows, "text string, lang string"))


def as_bytes(text):
    return np.frombuffer(text.encode(), dtype=np.uint8)


def test_held_out_documents(docs_of):
    rows = labelled(400, 7)
    out = lang.languages_of(docs_of(rows)).collect()
    truth = {i: g for i, _, g in rows}
    assert {r["doc_id"]: r["held_out"] for r in out} == {i: zlib.crc32(str(i).encode()) % 4 == 2 for i in truth}
    assert all(r["lang_pred"] == truth[r["doc_id"]] for r in out if r["held_out"])
    assert all(0 <= r["score"] <= 1 for r in out)


def test_held_out_labels_teach_nothing(docs_of):
    rows = labelled(200, 3)
    out = {i: zlib.crc32(str(i).encode()) % 4 == 2 for i, _, _ in rows}
    relabelled = [(i, t, "zz" if out[i] else g) for i, t, g in rows]
    key = lambda df: sorted(map(str, df.collect()))
    assert key(lang.languages_of(docs_of(rows))) == key(lang.languages_of(docs_of(relabelled)))


def test_counts_are_those_of_every_text(spark):
    rows = [(t, g) for _, t, g in labelled(50)]
    found = {(r["lang"], r["gram"]): r["n"] for r in lang.counts(spark.createDataFrame(rows, "text string, lang string")).collect()}
    want = {}
    for text, g in rows:
        for x in lang.grams(as_bytes(text)).tolist():
            want[g, x] = want.get((g, x), 0) + 1
    assert found == want


def test_mixture_shares(model):
    rng = random.Random(9)
    text = sentence(rng, "aa", 300) + " " + sentence(rng, "cc", 100)
    name, score, names, shares, _ = model.predict(as_bytes(text))
    n = [len(lang.grams(as_bytes(part))) for part in (text[: len(sentence(random.Random(9), "aa", 300))], text)]
    assert (name, names) == ("aa", ["aa", "cc"])
    assert abs(score - n[0] / n[1]) < 0.05 and abs(sum(shares) - 1) < 1e-6
    assert model.predict(as_bytes(sentence(rng, "bb", 80)))[2] == ["bb"]


def test_steps_raise_the_likelihood_to_its_maximum(model):
    rng = random.Random(4)
    data = as_bytes(sentence(rng, "aa", 60) + " " + sentence(rng, "bb", 40))
    n = np.bincount(lang.grams(data), minlength=lang.GRAMS)
    seen = np.flatnonzero(n)
    pi, best = model.shares(n[seen].astype(float), seen, np.array([0, 1]))
    chances = model.chances[seen][:, [0, 1]]
    grid = [float(n[seen] @ np.log(chances @ np.array([p, 1 - p]))) for p in np.linspace(0.01, 0.99, 99)]
    assert best >= max(grid) - 0.05 and abs(pi.sum() - 1) < 1e-9


def test_odd_rows(spark, model, clashing):
    rows = [(1, None), (2, ""), (3, "12 !? 34"), (4, "ß"), (5, "١٢٣"), (6, "语言"), (7, "a")]
    df = clashing(spark.createDataFrame(rows, "doc_id long, text string"))
    out = lang.predicted(df, model, "language")
    assert out.columns == [*df.columns, "language"]
    found = {r["doc_id"]: r["language"] for r in out.collect()}
    assert {i for i, r in found.items() if r["lang_pred"] == "und" and r["score"] == 0} == {1, 2, 3, 5}
    assert {found[i]["lang_pred"] for i in (4, 6, 7)} <= set(SYLLABLES)


def test_a_very_long_text(spark, model):
    text = sentence(random.Random(2), "cc", 200_000)
    out = lang.predicted(spark.createDataFrame([(text,)], "text string"), model).select("language.*").first()
    assert (out["lang_pred"], out["languages"]) == ("cc", ["cc"])


def test_no_rows_and_nothing_to_learn(docs_of):
    assert lang.languages_of(docs_of([])).count() == 0
    out = lang.languages_of(docs_of([(1, "some text", None), (None, "text", None)])).collect()
    assert [(r["lang_pred"], r["score"], r["held_out"]) for r in out] == [("und", 0.0, False)] * 2


def test_more_languages_than_a_model_holds(spark, monkeypatch):
    """The rarest are left out and told; the job goes on."""
    monkeypatch.setattr(lang, "MOST_LANGUAGES", 2)
    rows = [("some words " * 9, "b"), ("other words " * 5, "c"), ("a few", "a"), ("a fez", "d"), ("no end", None)]
    table = lang.counts(spark.createDataFrame(rows, "text string, lang string"))
    assert lang.fitted(table).languages == ["b", "c"]
    assert {r["lang"]: r["learned"] for r in lang.values_of(table).collect()} == {"a": False, "b": True, "c": True, "d": False}


def test_a_thousand_stray_values(spark):
    rows = [(t, g) for _, t, g in labelled(60)] + [(f"stray {i}", f"junk {i}") for i in range(1100)]
    learned = lang.learn(spark.createDataFrame(rows, "text string, lang string").repartition(3))
    assert len(learned.languages) == lang.MOST_LANGUAGES and set(SYLLABLES) <= set(learned.languages)
    assert learned.predict(as_bytes(sentence(random.Random(5), "bb", 40)))[0] == "bb"


def test_counts_of_more_languages_than_a_task_holds(spark, monkeypatch):
    rows = [(t, f"{g}{i % 7}") for i, t, g in labelled(60)]
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    whole = sorted(map(tuple, lang.counts(df).collect()))
    monkeypatch.setattr(lang, "HELD", 2)
    assert sorted(map(tuple, lang.counts(df).collect())) == whole


def plainly(model, data):
    """The main language by trying every nested set to the end, written without matrices."""
    n = {}
    for gram in lang.grams(data).tolist():
        n[gram] = n.get(gram, 0) + 1
    total = sum(n.values())

    def shares(among):
        pi = {k: 1 / len(among) for k in among}
        for _ in range(lang.STEPS if len(among) > 1 else 0):
            mix = {g: sum(pi[k] * model.chances[g, k] for k in among) for g in n}
            pi = {k: pi[k] * sum(c * model.chances[g, k] / mix[g] for g, c in n.items()) / total for k in among}
        return pi, sum(c * np.log(sum(pi[k] * model.chances[g, k] for k in among)) for g, c in n.items())

    every, _ = shares(range(len(model.languages)))
    order = sorted(every, key=lambda k: (-every[k], k))
    tried = []
    for size in range(1, len(order) + 1):
        pi, likelihood = shares(order[:size])
        tried.append((likelihood / lang.ORDER - 0.5 * size * np.log(max(total / lang.ORDER, 2)), -size, pi))
    pi = max(tried, key=lambda t: t[:2])[2]
    names = sorted(pi, key=lambda k: (-pi[k], k))
    return [model.languages[k] for k in names], [pi[k] for k in names]


def test_predictions_are_those_of_a_plain_version(model):
    """Also with small shares: no language is left out of the choice beforehand."""
    rng = random.Random(11)
    sizes = [(60, 0, 0), (40, 30, 0), (300, 3, 0), (300, 0, 6), (50, 50, 50), (400, 8, 4), (2, 1, 0), (1, 0, 0)]
    small = 0
    for sizes_of in sizes:
        data = as_bytes(" ".join(sentence(rng, g, k) for g, k in zip(SYLLABLES, sizes_of) if k))
        _, _, names, shares, _ = model.predict(data)
        want_names, want_shares = plainly(model, data)
        assert names == want_names
        assert np.allclose(shares, want_shares, atol=1e-9)
        small += min(shares) < 0.02
    assert small


def test_rows_without_id_are_learned_from(spark):
    assert spark.range(1).select(lang.held_out(F.lit(None).cast("long"))).first()[0] is False
