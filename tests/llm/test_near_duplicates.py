import random
import re

import pytest

from dealreports.llm import near_duplicates as nd


def brute(rows):
    """Components by all pairs."""
    sets = {}
    for doc_id, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[doc_id] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {d: (len(sets[d]), root(d), root(d) == d) for d in ids}


def found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def changed(rng, text, n):
    text = list(text)
    for _ in range(n):
        text[rng.randrange(len(text))] = f"c{rng.randrange(10**6)}"
    return text


def corpus(seed):
    """Unlike texts, small groups, one large group around a base, and a passage that many texts share."""
    rng = random.Random(seed)
    base, passage = words(rng, 120), words(rng, 60)
    texts = [words(rng, rng.randrange(1, 200)) for _ in range(60)]
    texts += [changed(rng, base, rng.randrange(0, 9)) for _ in range(90)]
    texts += [passage + words(rng, rng.randrange(0, 40)) for _ in range(70)]
    for _ in range(12):
        one = words(rng, rng.randrange(5, 150))
        texts += [changed(rng, one, rng.randrange(0, 4)) for _ in range(rng.randrange(2, 6))]
    texts += [[], ["one"], ["one"], ["one", "two"], ["One", "TWO"], ["x"] * 40, ["x"] * 5]
    rng.shuffle(texts)
    return [(i * 3, " ".join(t)) for i, t in enumerate(texts)] + [(10_000, None), (10_001, "")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_are_those_of_all_pairs(docs_of, seed):
    rows = corpus(seed)
    assert found(nd.near_duplicates(docs_of(rows))) == brute(rows)


def test_links_are_exact_at_the_limit(docs_of):
    # 7 of 9 shingles shared is over 0.75, 6 of 8 is 0.75, 5 of 7 below.
    same = [f"s{i}" for i in range(10)]
    rows = [
        (1, " ".join(same)), (2, " ".join([*same, "a"])), (3, " ".join([*same, "a", "b"])),
        (4, " ".join([*same, "a", "b", "c"])), (5, " ".join([*same, "a", "b", "c", "d"])),
    ]
    assert found(nd.near_duplicates(docs_of(rows))) == brute(rows)


def test_odd_rows(docs_of, clashing):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f"), (None, "other words"), (3, None)]
    df = nd.near_duplicates(clashing(docs_of(rows)))
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    got = sorted(map(tuple, df.collect()), key=str)
    assert got == sorted(
        [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (None, 2, 1, False), (None, 1, None, True), (3, 0, 3, True)], key=str
    )


def test_no_rows(docs_of):
    assert nd.near_duplicates(docs_of([])).count() == 0


def test_a_very_long_text(docs_of):
    long = " ".join(f"v{i}" for i in range(150_000))
    rows = [(1, long), (2, long + " more words at the end"), (3, "short")]
    assert {k: v[1] for k, v in found(nd.near_duplicates(docs_of(rows))).items()} == {1: 1, 2: 1, 3: 3}


def test_rows_that_share_a_doc_id_or_have_none(docs_of, clashing):
    near, other = " ".join(f"s{i}" for i in range(40)), " ".join(f"t{i}" for i in range(40))
    alone = " ".join(f"u{i}" for i in range(40))
    rows = [
        (3, near), (5, near + " more"), (5, other), (7, other + " more"), (9, alone), (9, alone + " more"),
        (None, near + " yet"), (None, "no id here"), (None, "No ID here"), (None, None), (None, ""), (11, ""), (11, ""),
    ]
    got = {(r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in nd.near_duplicates(docs_of(rows)).collect()}
    assert got == {
        (3, 36, 3, True), (5, 37, 3, False), (5, 36, 5, True), (7, 37, 5, False), (9, 36, 9, True), (9, 37, 9, True),
        (None, 37, 3, False), (None, 1, None, True), (None, 0, None, True), (11, 0, 11, True),
    }
    docs = clashing(docs_of(rows))
    left = nd.one_of_each(docs)
    assert left.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"] and r["text"].lower()[:2]) for r in left.collect()), key=str)
    assert kept == sorted([(3, "s0"), (5, "t0"), (9, "u0"), (None, "no"), (None, None), (None, ""), (11, "")], key=str)


@pytest.mark.parametrize("seed", range(2))
def test_passages_with_a_third_more_of_own_text(docs_of, seed):
    """Texts made of one common passage and about a third of own words, next to texts of the passage alone."""
    rng = random.Random(seed)
    passage = words(rng, rng.choice([15, 19, 40]), 10**6)
    rows = [(i, " ".join(passage + [f"own{seed}-{i}"])) for i in range(20)]
    n = len(passage) - 4
    for i in range(100, 140):
        own = [f"p{seed}-{i // 2}-{k}" for k in range(rng.randrange(n // 4, n // 3 + 2))]
        rows.append((i, " ".join(passage + own)))
        rows.append((i + 1000, " ".join(passage + own + [f"q{i}-{k}" for k in range(rng.randrange(0, n // 3 + 2))])))
    rows += [(5000 + i, " ".join(passage + words(rng, rng.randrange(60, 90), 10**6))) for i in range(25)]
    assert found(nd.near_duplicates(docs_of(rows))) == brute(rows)


def hashes(text):
    import numpy as np

    data = np.frombuffer(text.encode(), dtype=np.uint8)
    return next(nd.shingle_sets(data, np.array([0, len(data)]))).tolist()


def test_a_small_text_that_leaves_common_lists(docs_of):
    """16 hashes of 21 are shared; what both have besides the passage is not among the 16 lowest of the larger text."""
    rng = random.Random(1)
    while True:
        passage = words(rng, 15, 10**6)
        one = passage + words(rng, 5, 10**6)
        two = one + words(rng, 5, 10**6)
        shared = set(hashes(" ".join(one))) - set(hashes(" ".join(passage)))
        if not shared & set(hashes(" ".join(two))[: nd.POSTED]):
            break
    rows = [(100 + i, " ".join(passage + [f"own{i}"])) for i in range(20)] + [(1, " ".join(one)), (2, " ".join(two))]
    want = brute(rows)
    assert want[2][1] == 1 and found(nd.near_duplicates(docs_of(rows))) == want


def test_more_links_join_components(spark):
    member = spark.createDataFrame([(1, 1), (5, 1), (2, 2), (3, 2), (7, 7), (8, 7)], "node long, component long")
    links = spark.createDataFrame([(5, 3), (9, 10), (1, 5)], "a long, b long")
    got = {r["node"]: r["component"] for r in nd._with_links(member, links).collect()}
    assert got == {1: 1, 5: 1, 2: 1, 3: 1, 7: 7, 8: 7, 9: 9, 10: 9}
    assert nd._with_links(member, links.where("false")) is member
