"""Fingerprints of texts from content-defined chunks.

A gear hash rolls over the bytes of a text: the last 16 bytes, each worth twice the one before it. A chunk ends where
the hash's leading bits are zero: seven bits up to ``NORMAL`` bytes and three beyond (normalised chunking), never
below ``LEAST`` bytes and always at ``MOST``. Since ends depend on the bytes around them only, chunks are the same
again a little after any change or shift. A fingerprint is the set of the chunks' digests, each weighted by the
chunk's length. How much of one text another one contains is the weight of the digests that both have over the
weight of its own.
"""

import hashlib
from bisect import bisect_left
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealreports.llm import arrays
from dealreports.llm.shared import written

LEAST, NORMAL, MOST = 8, 32, 128
STRICT, LOOSE = np.uint16(9), np.uint16(13)  # bits of the hash that need not be zero
LENGTH_BITS = 12  # of a fingerprint's entries; the others are the digest's
PART_BYTES = 16 << 20  # about so much text in a part, or more where that would make many parts
MOST_PARTS = 20_000
POINTS = 20  # of the sample, for each part

_GEAR = np.random.Generator(np.random.PCG64(42)).integers(0, 1 << 16, 256, dtype=np.uint16)

COMPARED = """doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string,
    near_edited double, near_next double"""


def gear(data: np.ndarray) -> np.ndarray:
    """Rolling hash at every byte, over it and the 15 before it."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8):
        more = h.copy()
        more[width:] += h[:-width] << np.uint16(width)
        h = more
    return h


def ends(data: np.ndarray) -> np.ndarray:
    """Where the chunks of a text end."""
    n = len(data)
    h = gear(data)
    loose = np.flatnonzero((h >> LOOSE) == 0)
    strict = loose[(h[loose] >> STRICT) == 0]
    # The next loose and strict place from anywhere, by one look for many chunks at once, then a walk.
    loose, strict = (np.append(x + 1, n + MOST).tolist() for x in (loose, strict))
    out, start, i, j = [], 0, 0, 0
    while n - start > LEAST:
        least, normal = start + LEAST, start + NORMAL
        while strict[i] < least:
            i += 1
        if strict[i] <= normal:
            end = strict[i]
        else:
            while loose[j] <= normal:
                j += 1
            end = min(loose[j], start + MOST)
        if end >= n:
            break
        out.append(end)
        start = end
    if n:
        out.append(n)
    return np.array(out, dtype=np.int64)


def fingerprint(data: np.ndarray) -> np.ndarray:
    """The distinct chunks of a text, sorted: 52 bits of digest and 12 of length each."""
    end = ends(data)
    start = np.concatenate([[0], end[:-1]]) if len(end) else end
    up, down = arrays.powers(len(data) + 1)
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(arrays.BYTE[data] * up[: len(data)], dtype=np.uint64, out=total[1:])
    digest = arrays.mixed((total[end] - total[start]) * down[start])
    length = (end - start).astype(np.uint64)
    bits = np.uint64(LENGTH_BITS)
    return np.unique((digest >> bits << bits) | length)


def contained(a: np.ndarray, b: np.ndarray) -> float:
    """The share of fingerprint ``a`` that ``b`` has too; 1 for two empty ones, 0 for an empty one and another."""
    if not len(a):
        return float(not len(b))
    length = np.uint64((1 << LENGTH_BITS) - 1)
    return float((np.intersect1d(a, b, True) & length).sum()) / float((a & length).sum())


def spelled(fingerprint: np.ndarray) -> str:
    """16 hexadecimal digits for each chunk; a prefix for the empty text, which has none."""
    return "gear:" + fingerprint.astype(">u8").tobytes().hex()


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first ones of another text, as many or all it has."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), dtype=np.uint8)


Key = tuple[bool, int, int]  # without doc_id, its complement, hash of the text: the order of rows


class Parts:
    """Ranges of keys. A key that is several bounds, for many rows have it, is a part by itself with several shares.

    Part ``2 i`` holds the keys after bound i - 1 up to bound i, part ``2 i + 1`` the rows of bound i if that is a bound
    more than once.
    """

    def __init__(self, bounds: list[Key]):
        times = Counter(bounds)
        self.bounds = sorted(times)
        self.shares = [times[b] for b in self.bounds]

    def of(self, key: Key) -> tuple[int, int]:
        """A key's part, and among how many shares its rows are dealt."""
        i = bisect_left(self.bounds, key)
        if i < len(self.bounds) and self.bounds[i] == key and self.shares[i] > 1:
            return 2 * i + 1, self.shares[i]
        return 2 * i, 1


def keys_of(batch: pa.RecordBatch) -> list[Key]:
    """Of a batch with ``doc_id`` and ``hash`` as its first columns."""
    return [(d is None, ~(d or 0), h) for d, h in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]


def _cut(keys: DataFrame) -> Parts:
    """Parts of about as many bytes, from a sample of rows by their bytes; at most ``POINTS * MOST_PARTS`` points."""
    total = keys.agg(F.sum("bytes")).first()[0] or 0
    parts = min(MOST_PARTS, -(-total // PART_BYTES))
    if parts < 2:
        return Parts([])
    points = F.floor(F.col("bytes") * F.lit(POINTS * parts / total) + F.rand(1)).cast("int")
    sample = keys.select("doc_id", "hash", points.alias("points")).where("points > 0")
    found = sorted(((r[0] is None, ~(r[0] or 0), r[1]), r[2]) for r in sample.collect())
    bounds, seen = [], 0
    for key, n in found:
        bounds += [key] * ((seen + n) // POINTS - seen // POINTS)
        seen += n
    return Parts(bounds)


def _firsts(keys: DataFrame, parts: Parts) -> dict[int, Key]:
    """The first key of every part that has rows."""

    def least(batches):
        found: dict[int, Key] = {}
        for batch in batches:
            for key in keys_of(batch):
                part, _ = parts.of(key)
                if part not in found or key < found[part]:
                    found[part] = key
        columns = [pa.array(list(found), pa.int64()), *(pa.array([k[i] for k in found.values()], t) for i, t in enumerate((pa.bool_(), pa.int64(), pa.int64())))]
        yield pa.RecordBatch.from_arrays(columns, names=["part", "missing", "place", "hash"])

    found = keys.select("doc_id", "hash").mapInArrow(least, "part long, missing boolean, place long, hash long")
    found = found.groupBy("part").agg(F.min(F.struct("missing", "place", "hash")).alias("first"))
    return {r["part"]: tuple(r["first"]) for r in found.collect()}


def _dealt(docs: DataFrame, parts: Parts, firsts: dict[int, Key]) -> DataFrame:
    """Rows with part and share; a part's first row also goes to the part before, once from each task (``extra``)."""
    present = sorted(firsts)
    before = {firsts[part]: present[i - 1] for i, part in enumerate(present)} if len(present) > 1 else {}

    def rows(batches):
        dealt: Counter[Key] = Counter()
        for batch in batches:
            where, part, share, extra = [], [], [], []
            for i, key in enumerate(keys_of(batch)):
                at, shares = parts.of(key)
                where.append(i)
                part.append(at)
                share.append(dealt[key] % shares if shares > 1 else 0)
                extra.append(False)
                if key in before and not dealt[key]:
                    where.append(i)
                    part.append(before[key])
                    share.append(0)
                    extra.append(True)
                if shares > 1 or key in before:
                    dealt[key] += 1
            columns = [c.take(pa.array(where, pa.int64())) for c in batch.columns]
            columns += [pa.array(part, pa.int64()), pa.array(share, pa.int64()), pa.array(extra, pa.bool_())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "hash", "text", "part", "share", "extra"])

    return docs.mapInArrow(rows, "doc_id long, hash long, text string, part long, share long, extra boolean")


def _compared(batches):
    """Rows in order, each with the next one of its part; a part's last row with its extra row, or else its first."""
    kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    place, waiting, first, out = None, None, None, []

    def follow(text: str, own: np.ndarray) -> None:
        doc_id, before, current = waiting
        new = edited(before, text).encode()
        after = fingerprint(np.frombuffer(new, dtype=np.uint8))
        out.append(
            (doc_id, len(before), hashlib.sha256(new).hexdigest(), spelled(current), spelled(after), contained(current, after), contained(current, own))
        )

    def packed():
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    for batch in batches:
        for doc_id, text, part, share, extra in zip(*(batch.column(i).to_pylist() for i in range(5))):
            if (part, share) != place:
                if waiting:
                    follow(*first)
                place, waiting, first = (part, share), None, None
            if extra and not waiting:
                continue  # the part's last row has met another copy of it
            own = fingerprint(_bytes(text))
            if waiting:
                follow(text, own)
            waiting = None if extra else (doc_id, text, own)
            first = first or (text, own)
        yield packed()
        out = []
    if waiting:
        follow(*first)
    yield packed()


def compared(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (``doc_id``, ``text``) by fingerprint with its edited text and with the next row.

    The next row is the one with the next smaller doc_id, after the last the first. Rows that share a doc_id follow
    each other by a hash of their texts; rows without doc_id come last. NULL counts as the empty text, whose
    fingerprint is ``gear:``. A single row is its own next.

    Rows are cut into parts anywhere in that order, also among rows of one doc_id or without one, by a sample that
    only decides where. Equal rows may be dealt to several shares, where each is followed by its like; those of
    the first share have the part's end. A task holds one batch of rows, whatever a part's size.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    hashed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("hash"), "text")
    keys = written(hashed.select("doc_id", "hash", F.octet_length("text").alias("bytes")), "keys")
    parts = _cut(keys)
    dealt = _dealt(hashed, parts, _firsts(keys, parts))
    order = ["part", "share", "extra", F.col("doc_id").desc_nulls_last(), "hash"]
    ordered = dealt.repartition("part", "share").sortWithinPartitions(*order)
    return ordered.select("doc_id", "text", "part", "share", "extra").mapInArrow(_compared, COMPARED)
