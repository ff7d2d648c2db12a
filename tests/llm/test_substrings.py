import hashlib
import random
import re

import numpy as np
import pytest

from dealreports.llm import substrings
from dealreports.llm.fm_index import Index, WaveletMatrix


def brute(rows):
    """What stays of each row: words, removed words, hash."""
    split = [(d, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for d, t in rows]
    first = {}
    for d, w in split:
        for i in range(len(w) - 49):
            key = tuple(w[i : i + 50])
            if d is not None:
                first[key] = min(d, first.get(key, d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - 49):
            if d is not None and first[tuple(w[i : i + 50])] < d:
                gone.update(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


def corpus(seed):
    rng = random.Random(seed)

    def words(n):
        return [rng.choice("abcdefghijklmnopqrstuvwxyzäöü") * rng.randrange(1, 3) for _ in range(n)]

    passages = [words(rng.randrange(50, 140)) for _ in range(6)]
    rows = []
    for i in range(120):
        text = words(rng.randrange(0, 120))
        for _ in range(rng.randrange(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randrange(0, 20)
            at = rng.randrange(len(text) + 1)
            text[at:at] = passage[cut:] if rng.random() < 0.5 else passage
        rows.append((i * 2, rng.choice([" ", "\n", "  \t"]).join(text)))
    rows += [(1001, rows[10][1]), (1003, rows[10][1]), (1005, "x " * 300), (1007, "x " * 90), (1009, None), (1011, "")]
    rng.shuffle(rows)
    return rows


def spark_rows(df):
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept_sha256"]) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "crowded", "shard"), [(1, 1000, 400_000), (2, 2, 400_000), (3, 0, 300), (4, 1000, 300)])
def test_removed_words_are_those_of_brute_force(docs_of, monkeypatch, seed, crowded, shard):
    monkeypatch.setattr(substrings, "CROWDED", crowded)
    monkeypatch.setattr(substrings, "SHARD_WORDS", shard)
    rows = corpus(seed)
    assert spark_rows(substrings.without_repeats(docs_of(rows))) == sorted((r[:4] for r in brute(rows)), key=str)


def test_odd_rows(docs_of, clashing):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text), (None, text), (3, None), (4, "")]
    df = clashing(docs_of(rows))
    assert spark_rows(substrings.without_repeats(df)) == sorted((r[:4] for r in brute(rows)), key=str)
    cleaned = substrings.cleaned(df)
    assert cleaned.columns == df.columns
    assert sorted(((r["doc_id"], r["text"]) for r in cleaned.collect()), key=str) == sorted(
        [(1, text), (1, text), (None, text), (3, None), (4, "")], key=str
    )


def test_no_rows(docs_of):
    assert substrings.without_repeats(docs_of([])).count() == 0
    assert substrings.cleaned(docs_of([])).count() == 0


def test_cleaned_texts(docs_of):
    rows = corpus(5)
    want = {d: kept for (d, _, gone, _, kept) in brute(rows) if gone}
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in substrings.cleaned(docs_of(rows)).collect()}
    for d, text in rows:
        if d not in want:
            assert got[d] == (text, None if text is None else len(text))
        elif want[d]:
            assert got[d] == (want[d], len(want[d]))
        else:
            assert d not in got


def test_wavelet_ranks():
    rng = np.random.default_rng(1)
    symbols = rng.integers(0, 11, 777)
    matrix = WaveletMatrix(symbols, 10)
    for s in np.unique(symbols):
        places = rng.integers(0, 778, 40)
        assert matrix.rank(np.full(40, s), places).tolist() == [int((symbols[:p] == s).sum()) for p in places]


def test_index_finds_every_run_and_nothing_else():
    rng = random.Random(1)
    for trial in range(120):
        length, kinds = rng.choice([2, 3, 5, 8]), rng.choice([1, 2, 3])
        texts = [[rng.randrange(kinds) * 7 + 3 for _ in range(rng.randrange(1, 25))] for _ in range(rng.randrange(1, 8))]
        owners = [rng.randrange(10) for _ in texts]
        streams = texts if trial % 2 else [[rng.randrange(kinds + 1) * 7 + 3 for _ in range(rng.randrange(25))] for _ in range(5)]
        (flat, first), (stream, ends) = (
            (np.array([x for t in ts for x in t], dtype=np.uint64), np.concatenate([[0], np.cumsum([len(t) for t in ts])]))
            for ts in (texts, streams)
        )
        found = {}
        for lanes, places, owner in Index(flat, first, np.array(owners), length).matches(stream, ends):
            found |= {(int(a), int(b)): int(c) for a, b, c in zip(lanes, places, owner)}
        want = {}
        for i, s in enumerate(streams):
            for p in range(len(s) - length + 1):
                who = [o for t, o in zip(texts, owners) for r in range(len(t) - length + 1) if t[r : r + length] == s[p : p + length]]
                if who:
                    want[i, p] = min(who)
        assert found == want
