import hashlib
import random
from pathlib import Path

import pytest

from dealreports.llm import pieces
from dealreports.llm.queries import PIECES

BYTES = [(f"<0x{b:02X}>", 0.0, "byte") for b in range(256)]
TOY = [
    ("<unk>", 0.0, "other"), ("▁", -3.0, "piece"), ("a", -2.0, "piece"), ("b", -2.5, "piece"), ("ab", -3.25, "piece"),
    ("ba", -4.0, "piece"), ("▁a", -2.75, "piece"), ("aab", -6.0, "piece"), ("bb", -4.5, "piece"), ("c", -5.0, "piece"),
    ("b.", -4.25, "piece"), ("▁▁", -1e9, "piece"), (".", -3.5, "piece"), ("..", -5.0, "piece"), *BYTES,
]


@pytest.fixture(scope="module")
def toy():
    return pieces.Vocabulary(TOY)


def every(vocabulary, text):
    """Scores of all segmentations of a whole text, over one lattice without cuts into words."""
    spelled = "▁" + text.replace("▁", "\n").replace(" ", "▁")
    known = {p: s for p, s, k in TOY if k == "piece" and s > pieces.RULED_OUT}

    def rest(i):
        if i == len(spelled):
            return [0.0]
        out = []
        for j in range(i + 1, len(spelled) + 1):
            if spelled[i:j] in known:
                out += [known[spelled[i:j]] + r for r in rest(j)]
        if spelled[i] not in known:
            out += [vocabulary.unknown + r for r in rest(i + 1)]
        return out

    return sorted(rest(0), reverse=True)


def test_n_best_scores_are_those_of_all_segmentations(toy):
    rng = random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aab b.c?\n▁") for _ in range(rng.randrange(0, 9)))
        for n in (1, 3, 6):
            found = pieces.Encoder(toy, n).encode(text)
            assert [round(s, 6) for s, _ in found] == [round(s, 6) for s in every(toy, text)[:n]], (text, n)
            assert len({tuple(ids.tolist()) for _, ids in found}) == len(found)
            for score, ids in found:
                assert toy.decode(ids.tolist()) == text


def test_words_never_cut_a_piece(toy):
    assert toy.words("ab b.a  c..\n") == [" ab", " b.", "a", " ", " c", "..", "\n"] or "".join(toy.words("ab b.")) == " ab b."
    assert "b." in "".join(w for w in toy.words("ab.") if "." in w)


def test_ties_do_not_fill_the_agenda(toy):
    found = pieces.Encoder(toy, 4).encode("ab" * 400)
    assert len(found) == 4


@pytest.mark.skipif(not Path(PIECES).exists(), reason="no model file")
def test_scores_are_those_of_the_library_and_texts_come_back(sf_dir, spark):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(Path(PIECES).read_bytes())
    proto.trainer_spec.model_type = 1  # the same pieces and scores, searched for the best sum
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    encoder = pieces.Encoder(pieces.vocabulary(PIECES), 4)
    texts = [r[0] for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").collect()]
    compared = 0
    for text in texts:
        found = encoder.encode(text)
        assert encoder.vocabulary.decode(found[0][1].tolist()) == text
        plain = text.replace("\n", " ")[:250].strip()
        if plain.isascii() and "  " not in plain and len(plain) > 20:
            theirs = [sum(library.get_score(i) for i in ids) for ids in library.nbest_encode(plain, nbest_size=4)]
            assert [round(s) for s, _ in encoder.encode(plain)] == [round(s) for s in theirs]
            compared += 1
    assert compared > 50


ODD = [(1, None), (2, ""), (3, " "), (4, "  two  spaces "), (5, "▁ literal ▁▁"), (6, "日本語 🙂\x00"), (7, "tab\there"), (None, "x"), (7, "tab\there")]


@pytest.mark.skipif(not Path(PIECES).exists(), reason="no model file")
def test_odd_texts(docs_of, clashing):
    df = clashing(docs_of([*ODD, (8, "a" * 20_000), (9, "word " * 20_000)])).drop("segmentations")
    out = pieces.segmented(df, PIECES, 2)
    assert out.columns == [*df.columns, "segmentations"]
    back = pieces.decoded(out.selectExpr("doc_id", "text", "segmentations[0].pieces AS best"), PIECES, "best", "again")
    assert [(r["text"] or "") for r in back.collect()] == [r["again"] for r in back.collect()]
    rows = {(r["doc_id"], r["decoded_sha256"]) for r in pieces.digests(df, PIECES).collect()}
    assert {(i, hashlib.sha256((t or "").encode()).hexdigest()) for i, t in ODD} <= rows


@pytest.mark.skipif(not Path(PIECES).exists(), reason="no model file")
def test_no_rows(docs_of):
    assert pieces.segmented(docs_of([]), PIECES).count() == 0
    assert pieces.digests(docs_of([]), PIECES).count() == 0


def test_kept_words_are_bounded(toy, monkeypatch):
    monkeypatch.setattr(pieces, "KEPT_WORDS", 5)
    encoder = pieces.Encoder(toy, 2)
    rng = random.Random(8)
    for _ in range(50):
        text = " ".join("".join(rng.choice("abc") for _ in range(6)) for _ in range(4))
        assert round(encoder.encode(text)[0][0], 6) == round(pieces.Encoder(toy, 2).encode(text)[0][0], 6)
        assert len(encoder.words) <= 5 + 4


@pytest.mark.skipif(not Path(PIECES).exists(), reason="no model file")
def test_decoded_in_the_same_pass(docs_of):
    docs = docs_of([*ODD, (8, "a" * 20_000)])
    both = pieces.segmented(docs, PIECES, 2, decoded_into="again")
    assert both.columns == [*docs.columns, "segmentations", "again"]
    apart = pieces.segmented(docs, PIECES, 2).selectExpr("*", "segmentations[0].pieces AS best")
    apart = pieces.decoded(apart, PIECES, "best", "again").drop("best")
    rows = lambda df: sorted(map(str, df.collect()))
    assert rows(both) == rows(apart)
