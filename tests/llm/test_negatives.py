import math
import random

import numpy as np
import pytest

from dealreports.llm import negatives as ng


def brute(rows):
    taking = [
        (i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, [math.floor(256 * x) for x in v])
        for i, v, label in rows
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    last = lambda i: (i is None, i or 0)
    out = []
    for n, (i, label, v) in enumerate(taking):
        if i is None or i % 100:
            continue
        others = [t for m, t in enumerate(taking) if m != n]
        product = lambda w: max(min(sum(a * b for a, b in zip(v, w)), ng.BEYOND), -ng.BEYOND)
        scored = [(-product(w), last(j), j, other == label) for j, other, w in others]
        scored.sort(key=lambda s: s[:2])
        for ps, _, positive, _ in [s for s in scored if s[3]][:5]:
            fitting = [(ns, j) for ns, _, j, same in scored if not same and 80 * -ps <= 100 * -ns <= 100 * -ps][:5]
            out += [(i, positive, rank, j, -ps, -ns) for rank, (ns, j) in enumerate(fitting, 1)]
    return sorted(out, key=str)


@pytest.fixture
def vectors_of(spark):
    return lambda rows, kind="float": spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")


def mined(df):
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r[c] for c in names) for r in ng.mined(df).collect()), key=str)


def single(x):
    return [float(v) for v in np.float32(x)]


def corpus(seed, n, size, copies=0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 1) for _ in range(size)] for _ in range(4)]
    rows = []
    for i in range(n):
        v = [c + rng.gauss(0, 0.7) for c in centres[rng.randrange(4)]]
        norm = math.sqrt(sum(x * x for x in v))
        rows.append((i, single([x / norm for x in v]), rng.randrange(10)))
    return rows + [(n + i, rows[5][1], i % 3) for i in range(copies)]


@pytest.mark.parametrize(("size", "copies"), [(64, 0), (64, 300), (5, 0), (1, 0), (130, 0)])
def test_hard_negatives_are_those_of_all_pairs(vectors_of, monkeypatch, size, copies):
    monkeypatch.setattr(ng, "TILE_ROWS", 150)
    monkeypatch.setattr(ng, "TILE_BYTES", size * 8 * 2)
    rows = corpus(size, 500, size, copies)
    assert mined(vectors_of(rows).repartition(4)) == brute(rows)


def test_odd_rows(vectors_of, clashing):
    rows = corpus(1, 210, 6)
    rows += [(None, rows[3][1], 2), (None, rows[100][1], 1), (300, None, 1), (400, [1.0, None, 2.0], 1), (500, rows[0][1], None)]
    rows += [(600, [float("nan")] + [0.0] * 5, 2), (700, [float("inf")] + [0.0] * 5, 2), (800, [], 3), (900, [0.5, 0.5], 3)]
    rows += [(1000, [0.0] * 6, 4), (100, rows[100][1], rows[100][2]), (-100, single([0.3] * 6), -4), (1100, single([0.25] * 9), 5)]
    assert mined(clashing(vectors_of(rows)).withColumnRenamed("score", "SCORE")) == brute(rows)


def test_empty_tables(vectors_of):
    assert mined(vectors_of([])) == []
    assert mined(vectors_of([(0, None, 1)])) == []
    assert mined(vectors_of([(1, [0.5], 1), (2, [0.25], 1)])) == []
    assert mined(vectors_of([(0, [], 1), (1, [], 1), (2, [], 1), (3, [], 2)])) == brute(
        [(0, [], 1), (1, [], 1), (2, [], 1), (3, [], 2)]
    )


def test_huge_components(vectors_of):
    rows = [(i, [float(10**6 + i), float(i % 3), 2.0**40 if i % 5 == 0 else 1.5], i % 3) for i in range(120)]
    assert mined(vectors_of(rows, "double")) == brute(rows)
    assert len(mined(vectors_of([(i, [1e308 * (i % 2 + 0.5), -1e300], i % 3) for i in range(30)], "double"))) >= 0


def test_intervals_hold_and_codes_leave_little():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    whole, signs = np.floor(256 * x), ng.random_signs(64, ng.CODES, 1)
    turned = ng.turned(whole, ng.turns(signs)[0])
    assert np.allclose(turned @ turned.T, whole @ whole.T)
    words, steps = ng.coded(whole, signs)
    assert words.shape == (300, ng.CODES) and steps.shape == (300, 2 * ng.CODES)
    rest = steps[:, 1::2] / np.linalg.norm(turned, axis=1)[:, None]
    assert (np.diff(rest, axis=1) < 0).all() and rest[:, -1].max() < 0.1
    anchor = ng.Anchor(turned[0])
    units = np.where(turned >= 0, 1.0, -1.0) / 8
    product = anchor.product(words[:, :1].copy(), np.bitwise_count(words[:, 0]).astype(np.int64))
    assert (np.abs(product - units @ turned[0]) <= anchor.error + 1e-9).all() and anchor.error < 0.02 * 256


def test_few_rows_survive_the_codes():
    import pyarrow as pa

    rng = np.random.default_rng(5)
    x = np.floor(256 * rng.normal(size=(2000, 64)) / 8)
    signs = ng.random_signs(64, ng.CODES, ng.SEED)
    words, steps = ng.coded(x, signs)
    rows = {"uid": np.arange(2000), "vec_id": np.arange(2000), "label": np.ones(2000, dtype=np.int64)}
    lists = {"vector": ng._lists(x), "codes": ng._lists(words.view(np.int64)), "steps": ng._lists(steps)}
    held = ng.Rows(pa.table({k: pa.array(v) for k, v in rows.items()} | lists), 64, ng.CODES)
    scores = x @ x.T
    for n in range(20):
        left = ng.survivors(held, np.arange(2000), x[n : n + 1], signs, np.array([[-np.inf, np.inf]]), 5)
        assert set(np.argsort(-scores[n])[:5]) <= set(left) and len(left) < 100
