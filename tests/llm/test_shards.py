import random
import zlib

import pytest

from dealreports.llm import shards as sh


def smallest(sizes, shards):
    low, high = max(sizes), sum(sizes)
    while low < high:
        middle, used, count = (low + high) // 2, 0, 1
        for s in sizes:
            if used + s > middle:
                used, count = 0, count + 1
            used += s
        low, high = (low, middle) if count <= shards else (middle + 1, high)
    return low


def as_blocks(groups, digits, only=None):
    sizes = {}
    for key, size in groups:
        if only is None or any(key.startswith(o) for o in only):
            sizes.setdefault(key[:digits], []).append(size)
    return [sh.Block(b, sum(x), len(x)) for b, x in sizes.items()]


def test_capacity_is_the_smallest_and_cuts_keep_it():
    rng = random.Random(2)
    for _ in range(200):
        shards = rng.randrange(1, 9)
        groups = {"".join(rng.choice("0123") for _ in range(8)): rng.choice([1, 9, rng.randrange(1, 40), 300 if rng.random() < 0.05 else 7]) for _ in range(rng.randrange(1, 120))}
        groups = sorted(groups.items())
        largest, want = max(s for _, s in groups), smallest([s for _, s in groups], shards)
        blocks = sorted(as_blocks(groups, 1))
        while True:
            low = sh.smallest_capacity(blocks, shards, largest, True)
            high = sh.smallest_capacity(blocks, shards, largest, False)
            assert low <= want and (high is None or high >= want)
            if low == high:
                break
            todo = set(sh.unsettled(blocks, shards, low, sum(b.size for b in blocks) if high is None else high, largest))
            assert todo
            more = [x for n in {len(t) for t in todo} for x in as_blocks(groups, n + 1, [t for t in todo if len(t) == n])]
            blocks = sorted([b for b in blocks if b.beginning not in todo] + more)
        begins, loads = sh.cuts(blocks, shards, low), [0] * shards
        for key, size in groups:
            loads[sum(b <= key for b in begins)] += size
        assert max(loads) == want == low


def check(rows, out, shards):
    assert len(out) == len(rows)
    want = sorted(((d, len((t or "").encode()) + 8, None if t is None else zlib.crc32(t.encode())) for d, t in rows), key=str)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"]) for r in out), key=str) == want
    by_shard = {}
    for r in out:
        by_shard.setdefault(r["shard"], []).append(r)
    for s, members in by_shard.items():
        assert 0 <= s < shards
        assert sorted(r["slot"] for r in members) == list(range(len(members)))
    assert {(r["law"], r["grown_shard"]) for r in out} <= {("bytes", None)}
    texts = dict(rows)
    homes = {}
    for r in out:
        homes.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert all(len(h) == 1 for h in homes.values())
    return {s: sum(r["size"] for r in m) for s, m in by_shard.items()}


@pytest.mark.parametrize("cell", [20_000, 3])
def test_shards_of_rows(docs_of, clashing, monkeypatch, cell):
    import hashlib

    monkeypatch.setattr(sh, "CELL_ROWS", cell)
    rng = random.Random(4)
    rows = [(i, "x" * rng.randrange(0, 300) + str(i % 211)) for i in range(400)] + [(1000 + i, "hot text" * 20) for i in range(150)]
    rows += [(2000, None), (2001, None), (2002, "")]
    loads = check(rows, sh.sharded(clashing(docs_of(rows)), 5).collect(), 5)
    sizes = {}
    for _, t in rows:
        key = "" if t is None else hashlib.sha256(t.encode()).hexdigest()
        sizes[key] = sizes.get(key, 0) + len((t or "").encode()) + 8
    assert max(loads.values()) == smallest([s for _, s in sorted(sizes.items())], 5)


def test_shards_are_nearly_equal(docs_of):
    rng = random.Random(5)
    rows = [(i, "y" * rng.randrange(50, 150) + str(i)) for i in range(3000)]
    loads = check(rows, sh.sharded(docs_of(rows)).collect(), 24)
    assert len(loads) == 24 and max(loads.values()) - min(loads.values()) < 600


def test_one_large_group_leaves_the_others_equal(docs_of):
    rows = [(i, "z" * 100 + str(i)) for i in range(600)] + [(1000 + i, "q" * 100) for i in range(300)]
    loads = sorted(check(rows, sh.sharded(docs_of(rows), 6).collect(), 6).values())
    assert len(loads) == 6 and loads[-1] == 300 * 108 and loads[-2] < 600 * 112 / 4


def test_few_rows(docs_of):
    assert sh.sharded(docs_of([])).count() == 0
    check([(1, "a")], sh.sharded(docs_of([(1, "a")])).collect(), 24)
    check([(1, None)], sh.sharded(docs_of([(1, None)]), 1).collect(), 1)
    out = sh.sharded(docs_of([(1, "a"), (1, "a"), (None, "b"), (None, "c")]), 2).collect()
    assert len(out) == 4 and sorted((r["shard"], r["slot"]) for r in out) == [(0, 0), (0, 1), (1, 0), (1, 1)]


def test_only_built_in_functions(docs_of):
    plan = sh.sharded(docs_of([(1, "a"), (2, "b")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
