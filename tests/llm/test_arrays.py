import re

import numpy as np
import pyarrow as pa

from dealreports.llm import arrays

TEXTS = ["", "a", " a b\tc ", "x\x0by\x0cz", "ä ö ü 日本 語", "the the The", "end", "of", "  "]


def read(texts, **options):
    data = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    return arrays.words(np.frombuffer(b"".join(data), dtype=np.uint8), offsets, **options)


def spoken(found, i):
    lo, hi = found.first[i], found.first[i + 1]
    return [found.data[s:e].tobytes().decode() for s, e in zip(found.start[lo:hi], found.end[lo:hi])]


def test_words_are_runs_without_white_space():
    found = read(TEXTS)
    assert [spoken(found, i) for i in range(len(TEXTS))] == [re.findall(r"[^\x20\x09-\x0D]+", t) for t in TEXTS]


def test_marks_separate_and_letters_are_lowered():
    found = read(["Don't, STOP-it é.É"], lower=True, separators=arrays.MARKS)
    assert spoken(found, 0) == ["don", "t", "stop", "it", "é", "É"]


def test_equal_words_have_equal_hashes_wherever_they_are():
    words = [f"w{i}" for i in range(3000)] + ["a", "b", "ab", "ba", "aa", "A" * 70, "A" * 71]
    texts = [" ".join(words), "x " + "  ".join(reversed(words))]
    found = read(texts)
    by_word = {}
    for i in range(2):
        hashes = found.hashes[found.first[i] : found.first[i + 1]]
        for word, h in zip(spoken(found, i), hashes.tolist()):
            assert by_word.setdefault(word, h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_runs_and_sliding_minimum():
    values = np.random.default_rng(0).integers(0, 4, 200, dtype=np.uint64)
    for length in (1, 2, 5, 16, 50, 199, 200, 201):
        hashes, seen = arrays.runs(values, length), {}
        assert len(hashes) == max(0, 201 - length)
        for i, h in enumerate(hashes.tolist()):
            assert seen.setdefault(tuple(values[i : i + length]), h) == h
        assert len(set(seen.values())) == len(seen)
    for width in (1, 2, 3, 35):
        least = arrays.sliding_minimum(values, width)
        assert least.tolist() == [min(values[i : i + width]) for i in range(200 - width + 1)]


def test_chunks_give_every_text_once():
    texts = ["a" * n for n in (0, 5, 40, 3, 0, 100, 1)] + [None, "é"]
    column = pa.array(texts, pa.string())[1:]
    out = []
    for chunk in arrays.chunks(column, 40):
        bounds = chunk.offsets.tolist()
        out += [chunk.data[a:b].tobytes().decode() for a, b in zip(bounds, bounds[1:])]
    assert out == [t or "" for t in texts[1:]]
    assert list(arrays.chunks(column[:0])) == []


def test_tokens_by_unicode_class():
    texts = ["Don’t «STOP» it—é…É", "你好，世界", "ไทย ok", "a­b c　d", "x😀😀y", "", "né"]
    data = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, data)])
    found = arrays.tokens(np.frombuffer(b"".join(data), dtype=np.uint8), offsets)
    got = [
        [found.data[s:e].tobytes().decode() for s, e in zip(found.start[lo:hi], found.end[lo:hi])]
        for lo, hi in zip(found.first[:-1], found.first[1:])
    ]
    assert got == [
        ["don", "t", "stop", "it", "é", "É"], [*"你好世界"], [*"ไทย", "ok"], ["a­b", "c", "d"], ["x", "😀", "😀", "y"], [], ["né"]
    ]
