"""Documents that hold benchmark items, by greedy string tiling.

Tokens are runs of letters and digits, A to Z in lower case; a letter of a script that is written without spaces is
one, as are symbols beyond ASCII. Runs of ``SEED`` tokens that a document shares with an
item are the seeds of tiles. For each pair with seeds the longest common runs of tokens that are not yet marked are
marked again and again (compared by Karp-Rabin hashes, then token by token), down to ``SEED`` tokens. A document is
contaminated by an item if marked tokens are ``COVERAGE`` of the item, in whatever order its passages come. An item of
fewer than ``SEED`` tokens is one seed, and must be there whole.
"""

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.llm import arrays
from dealreports.llm.shared import unused, written

SEED = 4
COVERAGE = 0.5
SENT_BYTES = 32 << 20  # benchmarks up to this size go to every task, larger ones are joined

MATCH = T.StructType().add("item_id", "long")
for _name in ("item_tokens", "covered_tokens", "tiles", "longest_tile"):
    MATCH = MATCH.add(_name, "integer")
MATCHES = T.ArrayType(MATCH)


class Tiles(NamedTuple):
    covered: int
    count: int
    longest: int


def tile(item: np.ndarray, other: np.ndarray, least: int = SEED) -> Tiles:
    """Greedy string tiling of two token sequences: longest matches first, none over another's tokens."""
    free = np.ones(len(item), dtype=bool), np.ones(len(other), dtype=bool)
    covered = count = longest = 0
    size = min(len(item), len(other))
    while size >= least:
        found = sorted(_common(item, other, free, size))
        if not found:
            size = max(least, size // 2) if size > least else 0
            continue
        best = max(length for length, _, _ in found)
        if best > size:  # a longer match than looked for: it comes first
            found = [f for f in found if f[0] == best]
        for length, i, j in sorted(found, key=lambda f: (-f[0], f[1], f[2])):
            if free[0][i : i + length].all() and free[1][j : j + length].all():
                free[0][i : i + length] = False
                free[1][j : j + length] = False
                covered, count, longest = covered + length, count + 1, max(longest, length)
    return Tiles(covered, count, longest)


def _common(item: np.ndarray, other: np.ndarray, free: tuple[np.ndarray, np.ndarray], size: int):
    """Maximal common runs of free tokens, of ``size`` at least: length and both places."""
    sides = []
    for tokens, is_free in zip((item, other), free):
        hashes = arrays.runs(tokens, size)
        taken = np.concatenate([[0], np.cumsum(~is_free)])
        places = np.flatnonzero(taken[size:] == taken[:-size])
        sides.append((hashes[places], places))
    by_hash: dict[int, list[int]] = {}
    for h, i in zip(sides[0][0].tolist(), sides[0][1].tolist()):
        by_hash.setdefault(h, []).append(i)
    seen = set()
    hits = np.isin(sides[1][0], sides[0][0])
    for h, j in zip(sides[1][0][hits].tolist(), sides[1][1][hits].tolist()):
        for i in by_hash[h]:
            if (i - 1, j - 1) in seen:  # inside a run that began earlier
                seen.add((i, j))
                continue
            n = min(len(item) - i, len(other) - j)
            same = (item[i : i + n] == other[j : j + n]) & free[0][i : i + n] & free[1][j : j + n]
            length = n if same.all() else int(np.argmin(same))
            if length >= size:
                seen.add((i, j))
                yield length, i, j


class Seeds:
    """Hashes of runs of ``size`` tokens with the items they are of."""

    def __init__(self, size: int, seeds: list[np.ndarray], owners: list[np.ndarray]):
        self.size = size
        seeds, owners = (np.concatenate([*x, np.zeros(0, dtype=k)]) for x, k in ((seeds, np.uint64), (owners, int)))
        order = np.argsort(seeds, kind="stable")
        self.seeds, self.owners = seeds[order], owners[order].astype(np.int64)
        # One byte for each value of a seed's last bits; tells most other runs at one look.
        self.mask = np.uint64((1 << max(16, int(8 * len(seeds)).bit_length())) - 1)
        self.maybe = np.zeros(int(self.mask) + 1, dtype=bool)
        self.maybe[(self.seeds & self.mask).astype(np.int64)] = True

    def seeded(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of runs that are seeds, and the items they are of; a place comes once for each item."""
        places = np.flatnonzero(self.maybe[(hashes & self.mask).astype(np.int64)])
        lo = np.searchsorted(self.seeds, hashes[places], side="left")
        n = np.searchsorted(self.seeds, hashes[places], side="right") - lo
        at = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(places, n), self.owners[at]


class Benchmark:
    """Items with their tokens and seeds, small enough to be in every task."""

    def __init__(self, ids: list, texts: list):
        self.ids, self.tokens = ids, []
        by_size: dict[int, tuple[list, list]] = {}
        for number, chunk in enumerate(texts):
            data = np.frombuffer((chunk or "").encode(), dtype=np.uint8)
            tokens = arrays.tokens(data, np.array([0, len(data)])).hashes
            self.tokens.append(tokens)
            if len(tokens):
                size = min(SEED, len(tokens))
                own = np.unique(arrays.runs(tokens, size))
                seeds, owners = by_size.setdefault(size, ([], []))
                seeds.append(own)
                owners.append(np.full(len(own), number))
        self.seeds = [Seeds(size, *by_size[size]) for size in sorted(by_size, reverse=True)]


def _near(tokens: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """The tokens of seeds, with a mark where text in between is left out; no common run lies elsewhere."""
    inside = np.zeros(len(tokens) + 1, dtype=np.int64)
    np.add.at(inside, places, 1)
    np.add.at(inside, places + size, -1)
    inside = np.cumsum(inside[:-1]) > 0
    begin = np.flatnonzero(inside & ~np.concatenate([[False], inside[:-1]]))
    kept = np.flatnonzero(inside)
    # The marks are no word's hash (all but surely) and differ from one another.
    return np.insert(tokens[kept], np.searchsorted(kept, begin), np.arange(1, len(begin) + 1, dtype=np.uint64))


def matches(benchmark: Benchmark, data: np.ndarray, offsets: np.ndarray) -> Iterator[list[tuple]]:
    """For each text the items that contaminate it."""
    found = arrays.tokens(data, offsets)
    pairs: dict[int, list[tuple]] = {}
    for seeds in benchmark.seeds:
        places, items = seeds.seeded(arrays.runs(found.hashes, seeds.size))
        text = np.searchsorted(found.first, places, side="right") - 1
        inside = places + seeds.size <= found.first[text + 1]
        places, items, text = places[inside], items[inside], text[inside]
        order = np.lexsort((places, items, text))
        places, items, text = places[order], items[order], text[order]
        begin = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(items, prepend=-1) != 0))
        for lo, hi in zip(begin.tolist(), np.append(begin[1:], len(places)).tolist()):
            item = benchmark.tokens[items[lo]]
            if SEED * (hi - lo) >= COVERAGE * len(item):  # so few seeds cannot cover enough
                first = int(found.first[text[lo]])
                tokens = found.hashes[first : int(found.first[text[lo] + 1])]
                if seeds.size < SEED:  # the whole item: one place tells
                    hi = lo + 1
                t = tile(item, _near(tokens, places[lo:hi] - first, seeds.size), seeds.size)
                if t.covered >= COVERAGE * len(item):
                    row = (benchmark.ids[items[lo]], len(item), t.covered, t.count, t.longest)
                    pairs.setdefault(int(text[lo]), []).append(row)
    for i in range(len(offsets) - 1):
        yield pairs.get(i, [])


def _as_array(rows: list[list[tuple]]) -> pa.Array:
    names = ["item_id", "item_tokens", "covered_tokens", "tiles", "longest_tile"]
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32())
    flat = [x for r in rows for x in r]
    columns = [pa.array([x[k] for x in flat], kind) for k, kind in enumerate(kinds)]
    bounds = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    return pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.StructArray.from_arrays(columns, names))


def with_matches(docs: DataFrame, items: DataFrame, column: str = "matches") -> DataFrame:
    """``docs`` with ``column``: the items of a small benchmark (``item_id``, ``text``) that contaminate each row.

    NULL and empty texts match nothing, nor do items without a token. Items with fewer than four tokens match where they
    are whole. An item that is given twice is matched twice. The items are collected: the caller checks their size (``contaminated`` does).
    """
    rows_of = items.select("item_id", "text").collect()
    sent = docs.sparkSession.sparkContext.broadcast(([r[0] for r in rows_of], [r[1] for r in rows_of]))
    at = docs.columns.index("text")

    def rows(batches):
        benchmark = Benchmark(*sent.value)
        for batch in batches:
            out = [m for c in arrays.chunks(batch.column(at)) for m in matches(benchmark, c.data, c.offsets)]
            yield pa.RecordBatch.from_arrays([*batch.columns, _as_array(out)], names=[*batch.schema.names, column])

    schema = T.StructType([*docs.schema.fields, T.StructField(column, MATCHES)])
    return docs.mapInArrow(rows, schema)


def fits(items: DataFrame) -> bool:
    """Whether the benchmark may be sent to every task."""
    size = items.agg(F.sum(F.octet_length("text") + F.lit(16))).first()[0] or 0
    return size <= SENT_BYTES


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, item_tokens, covered_tokens, coverage, tiles, longest_tile`` of contaminated documents.

    ``docs`` has ``doc_id`` and ``text``, ``items`` has ``item_id`` and ``text``. Documents without a match give no
    row. See ``with_matches`` for NULL and short texts.
    """
    docs = docs.select("doc_id", "text")
    if fits(items):
        found = with_matches(docs, items).select("doc_id", F.inline("matches"))
    else:
        found = _joined(docs, items).select("doc_id", F.inline("matches"))
    return found.withColumn("coverage", F.col("covered_tokens") / F.col("item_tokens"))


def _joined(docs: DataFrame, items: DataFrame) -> DataFrame:
    """As ``with_matches``, for benchmarks of any size: seeds of documents and items meet in a join.

    ``docs`` may have other columns; rows without a match are left out. Texts meet by a hash of them, not by ids: equal
    texts match alike. Texts with equal hashes only add pairs, for the tiles are made for every row's own text.
    """
    key, item_key = unused(docs, "text_key"), unused(docs, "item_key")
    column, item_text, item_id = unused(docs, "matches"), unused(docs, "item_text"), unused(docs, "item_id")

    def seeds(sizes: list[int]):
        """Seeds of each row, of the whole text if it has fewer tokens than ``SEED``; or all runs of these sizes."""

        def rows(batches):
            for batch in batches:
                for chunk in arrays.chunks(batch.column(1)):
                    found = arrays.tokens(chunk.data, chunk.offsets)
                    bounds = [*zip(found.first[:-1].tolist(), found.first[1:].tolist())]
                    for size in sizes or range(1, SEED + 1):
                        grams = arrays.runs(found.hashes, size)
                        lists = [
                            grams[lo : max(lo, hi - size + 1) if sizes or size == min(SEED, hi - lo) else lo]
                            for lo, hi in bounds
                        ]
                        counts = [len(x) for x in lists]
                        at = np.repeat(np.arange(len(lists)), counts)
                        flat = np.concatenate([*lists, np.zeros(0, dtype=np.uint64)]).view(np.int64)
                        lengths = np.repeat(np.array([hi - lo for lo, hi in bounds], dtype=np.int64), counts)
                        keys = batch.column(0)[chunk.rows].take(pa.array(at))
                        yield pa.RecordBatch.from_arrays(
                            [keys, pa.array(flat), pa.array(lengths)], names=["key", "seed", "tokens"]
                        )

        return rows

    schema = "key long, seed long, tokens long"
    docs = docs.withColumn(key, F.xxhash64("text"))
    items = items.select(
        F.col("item_id").alias(item_id), F.col("text").alias(item_text), F.xxhash64("text").alias(item_key)
    )
    of_items = items.select(item_key, item_text).distinct().mapInArrow(seeds([]), schema)
    of_items = written(of_items.withColumnRenamed("key", "item"), "items")
    sizes = of_items.select(F.least("tokens", F.lit(SEED))).distinct().collect()  # four at most
    of_docs = docs.select(key, "text").mapInArrow(seeds([r[0] for r in sizes] or [SEED]), schema)
    of_docs = of_docs.select("key", "seed").distinct()
    # So many places of an item begin a shared seed; tiles cover at most SEED tokens for each.
    places = of_items.groupBy("item", "seed").agg(F.count("*").alias("places"), F.min("tokens").alias("tokens"))
    pairs = of_docs.join(places, "seed").groupBy("key", "item")
    pairs = pairs.agg(F.sum("places").alias("shared"), F.min("tokens").alias("tokens"))
    pairs = pairs.where(SEED * F.col("shared") >= COVERAGE * F.col("tokens"))
    pairs = written(pairs.select(F.col("key").alias(key), F.col("item").alias(item_key)), "pairs")
    both = pairs.join(docs, key).join(items, item_key).drop(key, item_key)
    at = [both.columns.index(c) for c in ("text", item_id, item_text)]
    kept = [i for i, c in enumerate(both.columns) if c not in (item_id, item_text)]

    def rows(batches):
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                item = Benchmark(row.column(at[1]).to_pylist(), row.column(at[2]).to_pylist())
                out = [m for c in arrays.chunks(row.column(at[0])) for m in matches(item, c.data, c.offsets)]
                if out[0]:
                    left = row.select(kept)
                    yield pa.RecordBatch.from_arrays([*left.columns, _as_array(out)], names=[*left.schema.names, column])

    fields = [both.schema.fields[i] for i in kept]
    return both.mapInArrow(rows, T.StructType([*fields, T.StructField(column, MATCHES)]))


def decontaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that no item contaminates, with all their columns."""
    if not fits(items):
        bad = _joined(docs.select("text"), items).select("text").distinct()
        return docs.join(bad, "text", "left_anti").select(docs.columns)
    column = unused(docs, "matches")
    return with_matches(docs, items, column).where(F.size(column) == 0).drop(column)
