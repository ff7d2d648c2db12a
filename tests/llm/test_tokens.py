import random
from pathlib import Path

import numpy as np
import pytest

from dealreports.llm import tokens
from dealreports.llm.queries import RANKS

pytestmark = pytest.mark.skipif(not Path(RANKS).exists(), reason="no vocabulary file")


@pytest.fixture(scope="module")
def vocabulary():
    return tokens.ranks(RANKS)


def brute(ends, spans, rule):
    out, s = [0.0] * (len(spans) + 1), 0
    for e in ends:
        own = [next((k for k, (b, f) in enumerate(spans) if b <= p < f), len(spans)) for p in range(s, e)]
        inside = [o for o in own if o < len(spans)]
        if rule == "share":
            for o in own:
                out[o] += 1 / (e - s)
        elif not inside:
            out[-1] += 1
        else:
            out[inside[0] if rule == "first" else max(set(inside), key=lambda o: (inside.count(o), -o))] += 1
        s = e
    return out


@pytest.mark.parametrize("rule", tokens.RULES)
def test_attribution_is_that_of_every_byte(rule):
    rng = random.Random(5)
    for _ in range(500):
        ends = np.cumsum([rng.randrange(1, 5) for _ in range(rng.randrange(12))]).astype(np.int64)
        size = int(ends[-1]) if len(ends) else 0
        cuts = sorted(rng.randrange(size + 1) for _ in range(2 * rng.randrange(4)))
        begin, finish = (np.array(cuts[k::2], dtype=np.int64) for k in (0, 1))
        got = tokens.attribute(ends, begin, finish, rule)
        assert np.allclose(got, brute(ends.tolist(), list(zip(begin, finish)), rule))


def test_ends_are_those_of_the_tokens(vocabulary):
    encoder = tokens.Encoder(vocabulary)
    for text in ("", "a", "The cat’s 日本語 🙂\n\n x", "word " * 500):
        ids = encoder.encoding.encode_ordinary(text)
        parts = encoder.encoding.decode_tokens_bytes(ids)
        assert encoder.ends(text).tolist() == np.cumsum([len(p) for p in parts]).tolist()
        assert b"".join(parts).decode() == text


def test_lines_share_all_tokens(docs_of, vocabulary, clashing):
    texts = ["one\ntwo\n\nthree", "", None, "\n", "no end", "end\n", "日本\n語 🙂\n", "a\n" * 3000, "long " * 50_000]
    out = tokens.line_tokens(clashing(docs_of(list(enumerate(texts)))), vocabulary).collect()
    encoder = tokens.Encoder(vocabulary)
    for i, text in enumerate(texts):
        mine = sorted((r["section"], r["begin"], r["finish"], r["n_tokens"]) for r in out if r["doc_id"] == i)
        lines = (text or "").splitlines(keepends=True) or [""]
        ends = np.cumsum([len(line) for line in lines]).tolist()
        assert [m[:3] for m in mine] == list(zip(range(len(lines)), [0, *ends[:-1]], ends))
        assert sum(m[3] for m in mine) == len(encoder.ends(text or ""))


def test_given_spans_and_what_lies_outside(spark, vocabulary):
    text = "title: 語語 body of the text"
    rows = [(1, text, [(0, 5), (7, 9)]), (2, text, []), (3, text, None), (4, None, [(0, 0)]), (None, text, [(0, len(text))])]
    df = spark.createDataFrame(rows, "doc_id long, text string, spans array<struct<begin: int, finish: int>>")
    for rule in tokens.RULES:
        out = tokens.token_counts(df, vocabulary, rule, "spans").collect()
        total = len(tokens.Encoder(vocabulary).ends(text))
        for doc_id in (1, 2, 3, None):
            assert sum(r["n_tokens"] for r in out if r["doc_id"] == doc_id) == pytest.approx(total)
        assert [(r["section"], r["n_tokens"]) for r in out if r["doc_id"] in (2, 3)] == [(None, total)] * 2
        assert {(r["begin"], r["finish"]) for r in out if r["doc_id"] == 1} == {(0, 5), (7, 9), (None, None)}
    with pytest.raises(ValueError, match="rule"):
        tokens.token_counts(df, vocabulary, "last")


def test_no_rows(docs_of, vocabulary):
    assert tokens.line_tokens(docs_of([]), vocabulary).count() == 0
