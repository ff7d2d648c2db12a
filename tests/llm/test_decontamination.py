import random

import numpy as np
import pytest

from dealreports.llm import decontamination as dec


def brute_tiles(a, b, least):
    """Longest free common run first, by looking at all pairs of places."""
    free_a, free_b = [True] * len(a), [True] * len(b)
    covered = count = longest = 0
    while True:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                k = 0
                while i + k < len(a) and j + k < len(b) and a[i + k] == b[j + k] and free_a[i + k] and free_b[j + k]:
                    k += 1
                if k > best[0]:
                    best = (k, i, j)
        k, i, j = best
        if k < least:
            return covered, count, longest
        free_a[i : i + k] = free_b[j : j + k] = [False] * k
        covered, count, longest = covered + k, count + 1, max(longest, k)


def test_tiles_are_those_of_all_pairs():
    rng = random.Random(3)
    for _ in range(400):
        kinds = rng.choice([2, 3, 6])
        a = [rng.randrange(kinds) + 100 for _ in range(rng.randrange(20))]
        b = [rng.randrange(kinds) + 100 for _ in range(rng.randrange(30))]
        if len(a) > 6 and rng.random() < 0.5:
            k = rng.randrange(1, len(a))
            b = a[k:] + b + a[:k]
        got = dec.tile(np.array(a, dtype=np.uint64), np.array(b, dtype=np.uint64), 3)
        assert tuple(got) == brute_tiles(a, b, 3)


ITEM = "which of these seven rivers runs through the oldest town of the northern coast and ends in a lake"


def rows():
    w = ITEM.split()
    half = len(w) // 2
    return [
        (1, "before " + ITEM + " after"),
        (2, " ".join(w[half:]) + " in between " + " ".join(w[:half])),  # reordered
        (3, " ".join(f"{x}!!" for x in ITEM.upper().split())),  # marks and case
        (4, " ".join(w[:7])),  # too little
        (5, " ".join(x for a in w for x in (a, "zzz"))),  # the words, but no run of them
        (6, "something else altogether that nobody asked about"),
        (7, None), (8, ""), (1, "again " + ITEM), (None, ITEM),
    ]


ITEMS = [(10, ITEM), (11, "too short"), (12, None), (13, ""), (14, "another item about the moons of a planet far away")]


@pytest.fixture
def items(spark):
    return spark.createDataFrame([(*i, "x") for i in ITEMS], "item_id long, text string, doc_id string")


@pytest.mark.parametrize("sent", [1 << 20, 0])
def test_contaminated_documents(docs_of, items, clashing, monkeypatch, sent):
    monkeypatch.setattr(dec, "SENT_BYTES", sent)
    docs = clashing(docs_of(rows()))
    found = dec.contaminated(docs, items).collect()
    pairs = sorted(((r["doc_id"], r["item_id"]) for r in found), key=str)
    assert sorted(set(pairs), key=str) == [(1, 10), (2, 10), (3, 10), (None, 10)]
    assert all(r["coverage"] == r["covered_tokens"] / r["item_tokens"] >= dec.COVERAGE for r in found)
    two = next(r for r in found if r["doc_id"] == 2)
    assert (two["tiles"], two["covered_tokens"]) == (2, len(ITEM.split()))
    left = dec.decontaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [4, 5, 6, 7, 8]


def test_no_rows(docs_of, items):
    assert dec.contaminated(docs_of([]), items).count() == 0
    assert dec.contaminated(docs_of(rows()), items.where("false")).count() == 0
    assert dec.decontaminated(docs_of(rows()), items.where("false")).count() == len(rows())


def test_a_very_long_text_and_an_item_twice(docs_of, spark):
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    items = spark.createDataFrame([(1, ITEM), (1, ITEM)], "item_id long, text string")
    found = dec.contaminated(docs_of([(1, long), (2, f"{long} {ITEM} {long}")]), items)
    assert [(r["doc_id"], r["item_id"]) for r in found.collect()] == [(2, 1), (2, 1)]


def both_ways(monkeypatch, docs, items):
    out = []
    for sent in (1 << 20, 0):
        monkeypatch.setattr(dec, "SENT_BYTES", sent)
        found = dec.contaminated(docs, items).collect()
        left = dec.decontaminated(docs, items)
        assert left.columns == docs.columns
        out.append((sorted(map(tuple, found), key=str), sorted(map(tuple, left.collect()), key=str)))
    return out


def test_sent_and_joined_give_the_same_rows(docs_of, spark, clashing, monkeypatch):
    short, long = "one two three four five six seven eight nine ten", " ".join(f"w{i}" for i in range(100))
    items = [*ITEMS, (10, ITEM), (20, short), (20, long), (None, "a b c d e f g")]
    extra = [(1, "a clean row"), (2, ITEM), (2, ITEM), (None, "clean"), (None, None), (30, f"x {short} y"), (31, "a b c d e f g")]
    docs = clashing(docs_of(rows() + extra))
    sent, joined = both_ways(monkeypatch, docs, spark.createDataFrame(items, "item_id long, text string"))
    assert sent == joined
    pairs = [r[:2] for r in sent[0]]
    assert (None, 10) in pairs and (30, 20) in pairs and (31, None) in pairs
    assert pairs.count((2, 10)) == 6  # three rows, an item that is given twice
    assert sorted((r[0] for r in sent[1]), key=str) == sorted([1, 4, 5, 6, 7, 8, None, None], key=str)


UNSPACED = [
    "哪一条河流穿过北方海岸最古老的城市并流入湖泊？请选择正确的答案。",
    "北の海岸で最も古い町を通り、湖に注ぐ川はどれですか。",
    "แม่น้ำสายใดไหลผ่านเมืองที่เก่าแก่ที่สุดของชายฝั่งทางเหนือ",
]


def test_scripts_without_spaces_and_short_items(docs_of, spark, monkeypatch):
    items = [*enumerate(UNSPACED), (10, "Avogadro's number"), (11, "Zyzzyva"), (12, "Was ist “das”—hier?"), (13, "?!"), (14, "三角形")]
    docs = [(i, f"before{t}after 和") for i, t in enumerate(UNSPACED)]
    docs += [(5, "so Avogadro's number it is"), (6, "a Zyzzyva, and a zyzzyva"), (7, "Avogadro has a number"), (8, "was ist das hier")]
    docs += [(9, "一个三角形的"), (20, "三和角形"), (21, "?!"), (22, UNSPACED[0][:20]), (23, UNSPACED[0][:8] + "x")]
    docs += [(24, "Avogadro s"), (25, "number zyzzyvas")]
    sent, joined = both_ways(monkeypatch, docs_of(docs), spark.createDataFrame(items, "item_id long, text string"))
    assert sent == joined
    assert sorted(r[:2] for r in sent[0]) == [(0, 0), (1, 1), (2, 2), (5, 10), (6, 11), (8, 12), (9, 14), (22, 0)]
    assert [r[0] for r in sent[1]] == sorted([7, 20, 21, 23, 24, 25], key=str)
