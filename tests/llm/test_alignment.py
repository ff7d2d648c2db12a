import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from dealreports.llm import alignment as al
from dealreports.llm.queries import BYTES, PIECES

pytestmark = pytest.mark.skipif(not (Path(BYTES).exists() and Path(PIECES).exists()), reason="no vocabulary files")


def brute(rows):
    """By the bytes: which tokens of both sides overlap."""
    import sentencepiece
    import tokenizers
    from tokenizers.decoders import ByteLevel  # noqa: F401

    a = tokenizers.Tokenizer.from_file(BYTES)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    letters = al.byte_of_letter()
    found = []
    for doc_id, text in rows:
        if not text:
            found.append((doc_id, [], [], [], []))
            continue
        ids = a.encode(" " + text, add_special_tokens=False).ids
        x = [bytes(letters[c] for c in a.id_to_token(i)) if i != 50256 else b"<|endoftext|>" for i in ids]
        other = b.encode(text)
        y = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in other]
        want = (" " + text).encode()
        if b"".join(x) != want or b"".join(y) != want:
            found.append((doc_id, [], [], [], []))
            continue
        owner = [[n for n, part in enumerate(side) for _ in part] for side in (x, y)]
        links = sorted(set(zip(*owner)))
        ends = [set(np.cumsum([len(p) for p in side]).tolist()) for side in (x, y)]
        groups, lo = [], 0
        for hi in sorted(ends[0] & ends[1]):
            groups.append([",".join(str(name[n]) for n in dict.fromkeys(o[lo:hi])) for name, o in zip((ids, other), owner)])
            lo = hi
        found.append((doc_id, ids, other, [(ids[i], other[j]) for i, j in links], groups))
    count = Counter(p for f in found for p in set(f[3]))
    highest = Counter()
    for (i, _), n in count.items():
        highest[i] = max(highest[i], n)
    out = []
    for doc_id, ids, other, links, groups in found:
        text = ";".join("|".join(g) for g in groups)
        best = sum(count[p] == highest[p[0]] for p in links)
        digest = hashlib.sha256(text.encode()).hexdigest() if text else ""
        out.append((doc_id, len(ids), len(other), len(groups), len(links), best, sum(count[p] for p in links), digest))
    return sorted(out, key=str), count, highest


ROWS = [
    (1, "The cat sat on the mat, the cat did."),
    (1, "The cat sat on the mat, the cat did."),
    (None, "a row without id"),
    (2, None),
    (3, ""),
    (4, "▁ taken as a space: no tokens"),
    (5, "Zwölf Boxkämpfer jagen Viktor quer über den großen Sylter Deich"),
    (6, "日本語 🙂\n\n  x\ty  "),
    (7, "<|endoftext|> is text here, and <s> too </s>"),
    (8, "unbelievable antidisestablishmentarianism " * 400),
    (9, " "),
    (10, "x" * 5000),
    (11, "\x00 zero byte"),
    (12, "end ퟿\U0010ffff"),
]
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=str)


def test_documents_against_brute_force(docs_of, clashing):
    rng = random.Random(1)
    vocabulary = "the of and Haus maison unhappily running 12 12345 naïve co-op e.g. über".split()
    rows = ROWS + [(100 + i, " ".join(rng.choices(vocabulary, k=rng.randrange(1, 60)))) for i in range(150)]
    want, count, highest = brute(rows)
    docs = clashing(docs_of(rows).repartition(5))
    out = al.aligned(docs, BYTES, PIECES, with_groups=True).cache()
    assert found(out) == want
    for r in out.collect():
        assert r["groups_sha256"] == (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "")
    pairs = {(r["a"], r["b"]): (r["n_docs"], r["highest"]) for r in al.pair_counts(docs, BYTES, PIECES).collect()}
    assert pairs == {p: (n, n == highest[p[0]]) for p, n in count.items()}


def test_many_small_blocks_merge_in_rounds(docs_of, monkeypatch):
    monkeypatch.setattr(al, "BLOCK_BYTES", 200)
    monkeypatch.setattr(al, "FAN_IN", 2)
    monkeypatch.setattr(al, "GROUP_BYTES", 500)
    monkeypatch.setattr(al, "FRAME", 7)
    rng = random.Random(2)
    rows = ROWS + [(100 + i, " ".join(rng.choices("the cat of unhappily über 12345".split(), k=20))) for i in range(60)]
    assert found(al.aligned(docs_of(rows), BYTES, PIECES, radices=3)) == brute(rows)[0]


def test_no_documents(docs_of):
    assert al.aligned(docs_of([]), BYTES, PIECES).collect() == []
    assert al.pair_counts(docs_of([]), BYTES, PIECES).collect() == []
    assert found(al.aligned(docs_of([(1, None), (2, "")]), BYTES, PIECES)) == [(d, 0, 0, 0, 0, 0, 0, "") for d in (1, 2)]


def test_merge_and_highest_counts(monkeypatch):
    rng = np.random.default_rng(3)
    for frame in (1, 3, 1000):
        monkeypatch.setattr(al, "FRAME", frame)
        runs, want = [], Counter()
        for _ in range(rng.integers(1, 9)):
            pairs = np.unique(rng.integers(0, 60, rng.integers(1, 50)))
            counts = rng.integers(1, 1 << 40, len(pairs))
            want.update(dict(zip(pairs.tolist(), counts.tolist())))
            runs.append(al.packed_pairs(pairs, counts))
        got = [np.concatenate(x) for x in zip(*al.with_highest(al.merged(runs), 10))]
        assert dict(zip(got[0].tolist(), got[1].tolist())) == want and (np.diff(got[0]) > 0).all()
        top = {a: max(n for p, n in want.items() if p // 10 == a) for a in {p // 10 for p in want}}
        assert [bool(x) for x in got[2]] == [want[p] == top[p // 10] for p in got[0].tolist()]
    assert list(al.merged([])) == []


def test_radices_keep_all_ids():
    ids = np.arange(1003)
    for radices in (1, 7, 64):
        rank = al.radix_major(ids, 1003, radices)
        assert len(set(rank.tolist())) == 1003 and (al.of_radix_major(rank, 1003, radices) == ids).all()
        assert (rank // -(-1003 // radices) == ids % radices).all()


def test_ranks_give_the_ids_of_the_library():
    pair = al.tokenizer_pair(BYTES, PIECES)
    assert pair.ranked is not None
    rng = random.Random(6)
    known = [chr(c) for c in range(0x500)] + [chr(c) for c in (*range(0x2010, 0x2028), *range(0x2030, 0x205F))]
    parts = known + ["the ", " of", "'s", "'ll", "  ", "\n\n", "ing", "123", "<|endoftext|>", "\r\n", "\xa0 ", "\x85"] * 40
    texts = [" " + "".join(rng.choices(parts, k=rng.randrange(1, 60))) for _ in range(4000)]
    texts += [f" a{c}b {c}{c} 1{c}2 .{c}. \n{c}\n {c}" for c in known]
    assert all(al.LONG_KNOWN.fullmatch(t) for t in texts) and not al.LONG_KNOWN.fullmatch("a 日")
    assert pair.a_ids(texts) == [x.ids for x in pair.a.encode_batch(texts, add_special_tokens=False)]
    mixed = texts[:50] + ["日本語 text", " ", "\u2028 x", "\u0560"]
    assert pair.a_ids(mixed) == [x.ids for x in pair.a.encode_batch(mixed, add_special_tokens=False)]
