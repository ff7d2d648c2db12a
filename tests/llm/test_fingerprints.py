import hashlib
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from dealreports.llm import fingerprints as fp


def as_bytes(text):
    return np.frombuffer(text.encode(), dtype=np.uint8)


def slow_ends(data):
    """Chunk by chunk, byte by byte."""
    gears = fp._GEAR.tolist()
    out, start = [], 0
    while start < len(data):
        end = len(data)
        for i in range(start + 1, len(data)):
            h = sum(gears[b] << k for k, b in enumerate(reversed(data[max(0, i - 16) : i]))) & 0xFFFF
            size = i - start
            zeros = 7 if size <= fp.NORMAL else 3
            if size >= fp.MOST or size >= fp.LEAST and h >> (16 - zeros) == 0:
                end = i
                break
        out.append(end)
        start = end
    return out


def prose(rng, n):
    return " ".join("".join(rng.choice("abcdeäöü") for _ in range(rng.randrange(1, 9))) for _ in range(n))


def test_ends_are_those_of_the_rolling_hash():
    rng = random.Random(1)
    for n in (0, 1, 2, 5, 30, 200):
        text = prose(rng, n).encode()
        assert fp.ends(np.frombuffer(text, dtype=np.uint8)).tolist() == slow_ends(text)
    for text in (b"a" * 1000, bytes(rng.randrange(256) for _ in range(3000)), b"a" * 8, b"a" * 9):
        assert fp.ends(np.frombuffer(text, dtype=np.uint8)).tolist() == slow_ends(text)


def test_fingerprints_resist_shifts():
    rng = random.Random(2)
    text = prose(rng, 800)
    own = fp.fingerprint(as_bytes(text))
    assert fp.contained(own, fp.fingerprint(as_bytes("inserted " + text))) > 0.95
    assert fp.contained(own, fp.fingerprint(as_bytes(text[: len(text) // 2]))) == pytest.approx(0.5, abs=0.05)
    assert fp.contained(own, fp.fingerprint(as_bytes(prose(rng, 800)))) < 0.02
    assert fp.contained(fp.fingerprint(as_bytes(text[300:900])), own) > 0.8


def test_containment_is_weighted_by_length():
    a, b = fp.fingerprint(as_bytes("x" * 8)), fp.fingerprint(as_bytes(""))
    assert (fp.contained(a, a), fp.contained(a, b), fp.contained(b, a), fp.contained(b, b)) == (1, 0, 0, 1)


def brute(rows):
    """Each row after the next: descending doc_id, equal ones by a hash of the text, without doc_id last."""
    hashed = lambda text: np.uint64(xxhash.xxh64_intdigest((text or "").encode(), seed=42)).astype(np.int64)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), hashed(r[1])))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        own, new, after = (fp.fingerprint(as_bytes(t)) for t in (text, edited, following))
        row = (doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fp.spelled(own), fp.spelled(new))
        out.append((*row, fp.contained(own, new), fp.contained(own, after)))
    return sorted(out, key=str)


@pytest.mark.parametrize("part", [1 << 24, 3000, 10])
def test_every_row_meets_the_next(docs_of, clashing, monkeypatch, part):
    monkeypatch.setattr(fp, "PART_BYTES", part)
    rng = random.Random(part)
    rows = [(i * 7 % 101, prose(rng, rng.randrange(0, 60))) for i in range(101)]
    rows += [(500, None), (501, ""), (502, rows[3][1]), (502, rows[4][1]), (None, "no id"), (None, "no id either"), (-3, "x 🙂 y")]
    out = fp.compared(clashing(docs_of(rows)))
    assert out.columns[:3] == ["doc_id", "n_chars", "edited_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == brute(rows)


def test_few_rows(docs_of):
    assert fp.compared(docs_of([])).count() == 0
    for rows in ([(1, "alone")], [(1, None)], [(None, "alone")], [(1, "a b c d"), (2, "e f g h")]):
        assert sorted(map(tuple, fp.compared(docs_of(rows)).collect()), key=str) == brute(rows)


def test_a_very_long_text(docs_of):
    rows = [(1, "short"), (2, prose(random.Random(3), 120_000)), (3, "short")]
    assert sorted(map(tuple, fp.compared(docs_of(rows)).collect()), key=str) == brute(rows)


def test_many_rows_of_one_doc_id_or_none(docs_of, monkeypatch):
    """Ties are cut: with parts of 2 kB no part holds much more, and every row meets its next."""
    monkeypatch.setattr(fp, "PART_BYTES", 2000)
    rng = random.Random(6)
    rows = [(None, prose(rng, 6)) for _ in range(1500)] + [(7, prose(rng, 6)) for _ in range(1500)] + [(i, "one") for i in range(5, 10)]
    assert sorted(map(tuple, fp.compared(docs_of(rows).repartition(5)).collect()), key=str) == brute(rows)


@pytest.mark.parametrize("doc_id", [None, 7])
def test_many_equal_rows(docs_of, monkeypatch, doc_id):
    monkeypatch.setattr(fp, "PART_BYTES", 1000)
    rng = random.Random(8)
    rows = [(doc_id, "the same text again and again")] * 1500 + [(i, prose(rng, 9)) for i in range(40)]
    assert sorted(map(tuple, fp.compared(docs_of(rows).repartition(6)).collect()), key=str) == brute(rows)
    alone = rows[:1500]
    assert sorted(map(tuple, fp.compared(docs_of(alone).repartition(6)).collect()), key=str) == brute(alone)


def test_parts_are_near_their_size(docs_of, monkeypatch):
    """10,000 rows without doc_id and 10,000 of one, a third of them equal: no share is far above the limit."""
    monkeypatch.setattr(fp, "PART_BYTES", 4000)
    rng = random.Random(9)
    texts = ["equal rows of the table" if rng.random() < 0.33 else prose(rng, 5) for _ in range(20_000)]
    rows = [(None if i % 2 else 3, t) for i, t in enumerate(texts)]
    docs = docs_of(rows).repartition(8).select("doc_id", F.xxhash64("text").alias("hash"), "text")
    keys = docs.select("doc_id", "hash", F.octet_length("text").alias("bytes")).cache()
    parts = fp._cut(keys)
    dealt = fp._dealt(docs, parts, fp._firsts(keys, parts)).where("NOT extra").groupBy("part", "share").agg(F.sum(F.octet_length("text")).alias("b")).collect()
    assert sum(r["b"] for r in dealt) == sum(len(t.encode()) for t in texts)
    assert max(r["b"] for r in dealt) < 3 * 4000 and len(dealt) > 50


def test_no_cap_on_what_a_part_holds(docs_of, monkeypatch):
    monkeypatch.setattr(fp, "PART_BYTES", 100)
    monkeypatch.setattr(fp, "MOST_PARTS", 3)
    rng = random.Random(10)
    rows = [(i, prose(rng, 9)) for i in range(200)]
    assert sorted(map(tuple, fp.compared(docs_of(rows).repartition(4)).collect()), key=str) == brute(rows)
