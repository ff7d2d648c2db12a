"""Hard negatives by rotated one-bit codes: intervals of inner products decide what is scored in integers.

Vectors become integers (``floor(SCALE * x)``) and are turned by random signs and Walsh-Hadamard transforms, which
keep inner products. The signs of a turned vector are its one-bit code; stored with it are its alignment (the inner
product of vector and code as a unit vector) and the length of the rest that the code leaves. The rest is turned again
and gets a code of its own, and so on. The anchor, turned alike, is rounded to ``PLANES`` bits, so that its inner
product with a code is a few popcounts. Estimate and interval of an inner product <q, v> after k codes:

    sum of alignment * <rounded q, code>  +-  sum of |alignment| * |q - rounded q|  +  |rest| * |part of q across code k|

The rest is at right angles to code k, so the last term is Cauchy-Schwarz; both hold for certain. Codes are looked
at one after another, only for rows whose interval still meets what is asked; the rows that survive the last code
are scored in integers. Nothing is missed: the result is that of scoring every row.

Anchors meet all rows in blocks. A tile holds some thousand rows and as many anchors as fit ``TILE_BYTES``; each
tile keeps the best few rows of an anchor, and those of all tiles are ranked. Rows are dealt to tiles by their row
id in the written table of codes, so copies of a vector or a hot label are spread evenly.

Defined results: rows with a NULL label or vector, or a NULL, infinite or NaN component take no part; without
vec_id a row is no anchor, and comes last among equal scores; an empty vector scores 0; a shorter vector counts as
ending in zeros; repeated rows each stand for themselves, so an anchor given twice is mined twice; scores beyond
2^62 count as 2^62. Components are scaled as doubles, above 1e300 as 1e300.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dealreports.llm.shared import written

SCALE = 256
CODES = 6
PLANES = 8
SEED = 12
POSITIVES = 5
NEGATIVES = 5
LOW, HIGH = 80, 100  # a negative's score in hundredths of the positive's
TILE_ROWS = 8192
TILE_BYTES = 16 << 20
BEYOND = 1 << 62

CODED = "vec_id long, label long, vector array<double>, codes array<long>, steps array<double>"


def random_signs(size: int, codes: int, seed: int) -> np.ndarray:
    """Signs of the turns before each code: three before the first, one before each other."""
    return np.random.Generator(np.random.PCG64(seed)).choice([-1.0, 1.0], (codes + 2, size))


def turned(x: np.ndarray, signs: np.ndarray) -> np.ndarray:
    """Rows of a power of two of components, turned; inner products stay."""
    n, size = x.shape
    for flip in signs:
        x = (x * flip).reshape(n, size)
        width = 1
        while width < size:
            pairs = x.reshape(n, -1, 2, width)
            x = np.stack([pairs[:, :, 0] + pairs[:, :, 1], pairs[:, :, 0] - pairs[:, :, 1]], axis=2).reshape(n, size)
            width *= 2
        x = x / np.sqrt(size)
    return x


def turns(signs: np.ndarray) -> list[np.ndarray]:
    return [signs[:3], *(signs[k : k + 1] for k in range(3, len(signs)))]


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as 64-bit words."""
    n, size = bits.shape
    out = np.zeros((n, max(8, size // 8)), dtype=np.uint8)
    out[:, : -(-size // 8)] = np.packbits(bits, axis=1)
    return out.view(np.uint64)


def coded(x: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of all codes of each vector; alignment and length of the rest, code by code."""
    words, steps, rest = [], [], x
    for turn in turns(signs):
        rest = turned(rest, turn)
        bits = rest >= 0
        unit = np.where(bits, 1.0, -1.0) / np.sqrt(x.shape[1])
        align = np.einsum("ij,ij->i", rest, unit)
        rest = rest - align[:, None] * unit
        words.append(packed(bits))
        steps += [align, np.linalg.norm(rest, axis=1)]
    return np.concatenate(words, axis=1), np.stack(steps, axis=1)


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """A column of lists as a matrix, shorter lists filled up with zeros."""
    lengths = np.asarray(column.value_lengths())
    values = np.asarray(column.flatten(), dtype=np.float64)
    if len(lengths) and (lengths == size).all():
        return values.reshape(len(lengths), size)
    out = np.zeros((len(lengths), size))
    first = np.cumsum(lengths) - lengths
    out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(values)) - np.repeat(first, lengths)] = values
    return out


def _lists(x: np.ndarray) -> pa.Array:
    bounds = np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]
    return pa.ListArray.from_arrays(pa.array(bounds), pa.array(np.ascontiguousarray(x).ravel()))


class Rows:
    """Rows of a tile, by label, with their codes."""

    def __init__(self, rows: pa.Table, size: int, codes: int):
        rows = rows.sort_by("label").combine_chunks()
        column = lambda name: rows.column(name).combine_chunks()
        self.uid, self.label = (np.asarray(rows.column(n)) for n in ("uid", "label"))
        self.vec_id = column("vec_id")
        self.id_order = np.asarray(self.vec_id.fill_null(np.iinfo(np.int64).max))
        self.vector = matrix(column("vector"), size)
        words = np.asarray(column("codes").flatten()).view(np.uint64).reshape(len(rows), codes, -1)
        steps = np.asarray(column("steps").flatten()).reshape(len(rows), codes, 2)
        self.words = [np.ascontiguousarray(words[:, k]) for k in range(codes)]
        self.ones = [np.bitwise_count(w).sum(axis=1, dtype=np.int64) for w in self.words]
        self.align, self.rest = (np.ascontiguousarray(steps[:, :, k].T) for k in (0, 1))
        self.length = np.linalg.norm(self.vector, axis=1)
        self.largest = float(np.abs(self.vector).max(initial=0.0))

    def of_label(self, label: int) -> tuple[int, int]:
        return tuple(np.searchsorted(self.label, [label, label + 1]))

    def scores(self, chosen: np.ndarray, vector: np.ndarray) -> np.ndarray:
        """Integer inner products; beyond 2^53 in Python's whole numbers."""
        if self.largest * float(np.abs(vector).max(initial=0.0)) * max(len(vector), 1) < 2.0**53:
            return (self.vector[chosen] @ vector).astype(np.int64)
        whole = [int(x) for x in vector]
        exact = (sum(int(a) * b for a, b in zip(row, whole)) for row in self.vector[chosen])
        return np.array([min(max(s, -BEYOND), BEYOND) for s in exact], dtype=np.int64)


class Anchor:
    """An anchor as it is turned for one of the codes, rounded to planes of bits."""

    def __init__(self, x: np.ndarray, planes: int = PLANES):
        low, high = x.min(), x.max()
        step = (high - low) / ((1 << planes) - 1) or 1.0
        with np.errstate(invalid="ignore"):
            whole = np.clip(np.rint((x - low) / step), 0, (1 << planes) - 1).astype(np.int64)
        self.low, self.step, self.total = low, step, low * len(x) + step * float(whole.sum())
        self.planes = packed((whole >> np.arange(planes)[:, None] & 1).astype(bool))
        self.error = np.linalg.norm(x - (low + step * whole))
        self.length, self.size = np.linalg.norm(x), len(x)

    def product(self, words: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """Inner products of the rounded anchor with codes, from popcounts."""
        summed = np.zeros(len(words), dtype=np.int64)
        for k, plane in enumerate(self.planes):
            count = np.bitwise_count(words & plane)
            summed += (count[:, 0] if count.shape[1] == 1 else count.sum(axis=1, dtype=np.int64)).astype(np.int64) << k
        return (2 * (self.low * ones + self.step * summed) - self.total) / np.sqrt(self.size)


def survivors(
    rows: Rows, chosen: np.ndarray, vector: np.ndarray, signs: np.ndarray, ranges: np.ndarray, best: int
) -> np.ndarray:
    """Rows of ``chosen`` whose interval may hold one of the ``best`` highest scores in a range (low, high)."""
    estimate, rounding = np.zeros(len(chosen)), np.zeros(len(chosen))
    least = ranges[:, 0].astype(float)
    for k, turn in enumerate(turns(signs)):
        if not len(chosen):
            break
        vector = turned(vector, turn)
        anchor = Anchor(vector[0])
        product = anchor.product(rows.words[k][chosen], rows.ones[k][chosen])
        align = rows.align[k][chosen]
        estimate, rounding = estimate + align * product, rounding + np.abs(align) * anchor.error
        across = np.sqrt(np.maximum(anchor.length**2 - np.maximum(np.abs(product) - anchor.error, 0.0) ** 2, 0.0))
        slack = 1e-9 * anchor.length * (rows.length[chosen] + 1.0)  # for sums in doubles
        reach = rows.rest[k][chosen] * across + rounding + slack
        lower, upper = np.clip(estimate - reach, -BEYOND, BEYOND), np.clip(estimate + reach, -BEYOND, BEYOND)
        keep = np.zeros(len(chosen), dtype=bool)
        for r, (_, high) in enumerate(ranges):
            sure = lower[(upper <= high) & (lower > least[r])]
            if len(sure) >= best:
                least[r] = np.partition(sure, len(sure) - best)[len(sure) - best]
            keep |= ~(upper < least[r]) & ~(lower > high)
        chosen, estimate, rounding = chosen[keep], estimate[keep], rounding[keep]
    return chosen


FOUND = "anchor long, high long, vec_id long, uid long, score long"


def _search(size: int, codes: int, best: int, same: bool, seed: int):
    """The best rows of a tile for each of its anchors: of the same label, or of others and in the anchor's ranges."""
    wide = 1 << max(size - 1, 0).bit_length()

    def tile(rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(rows) and len(anchors):
            held, signs = Rows(rows, size, codes), random_signs(wide, codes, seed)
            vectors = matrix(anchors.column("vector").combine_chunks(), size)
            highs = anchors.column("highs").to_pylist()
            for n, (uid, label) in enumerate(zip(anchors.column("uid").to_pylist(), anchors.column("label").to_pylist())):
                filled = np.zeros((1, wide))
                filled[0, :size] = vectors[n]
                begin, end = held.of_label(label)
                if same:
                    chosen = np.arange(begin, end)
                    chosen = chosen[held.uid[chosen] != uid]
                    ranges = np.array([[-np.inf, np.inf]])
                else:
                    chosen = np.concatenate([np.arange(begin), np.arange(end, len(held.uid))])
                    ranges = np.array([[LOW * h / HIGH - 1e-6 * abs(h), h] for h in highs[n]], dtype=float)
                with np.errstate(all="ignore"):
                    chosen = survivors(held, chosen, filled, signs, ranges, best)
                scores = held.scores(chosen, vectors[n])
                order = np.lexsort((held.uid[chosen], held.id_order[chosen], -scores))
                chosen, scores = chosen[order], scores[order]
                for high in highs[n]:
                    if same:
                        meets = np.arange(min(best, len(chosen)))
                    else:
                        least = -(-LOW * high // HIGH)
                        meets = np.flatnonzero((scores <= high) & (scores >= least))[:best]
                    ids = held.vec_id.take(pa.array(chosen[meets])).to_pylist()
                    out += [
                        (uid, high, i, u, s)
                        for i, u, s in zip(ids, held.uid[chosen[meets]].tolist(), scores[meets].tolist())
                    ]
        names = ["anchor", "high", "vec_id", "uid", "score"]
        return pa.table({name: pa.array([x[k] for x in out], pa.int64()) for k, name in enumerate(names)})

    return tile


def encoded(vectors: DataFrame, scale: int = SCALE, codes: int = CODES, seed: int = SEED) -> tuple[DataFrame, int]:
    """The rows that take part, with integer vectors and codes, written; and the number of components."""
    whole = "label IS NOT NULL AND embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(double(x)) < double('Infinity'))"
    taking = vectors.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding").where(whole)
    size = max(taking.agg(F.max(F.size("embedding"))).first()[0] or 0, 1)
    wide = 1 << (size - 1).bit_length()

    def rows(batches):
        signs = random_signs(wide, codes, seed)
        for batch in batches:
            for lo in range(0, len(batch), 1024):
                part = batch.slice(lo, 1024)
                with np.errstate(over="ignore"):
                    x = np.floor(np.clip(scale * matrix(part.column(2), size), -1e300, 1e300))
                filled = np.zeros((len(x), wide))
                filled[:, :size] = x
                with np.errstate(all="ignore"):
                    words, steps = coded(filled, signs)
                columns = [part.column(0), part.column(1), _lists(x), _lists(words.view(np.int64)), _lists(steps)]
                yield pa.RecordBatch.from_arrays(columns, names=["vec_id", "label", "vector", "codes", "steps"])

    coded_rows = taking.mapInArrow(rows, CODED)
    return written(coded_rows.withColumn("uid", F.monotonically_increasing_id()), "codes"), size


def _tiles(rows: DataFrame, anchors: DataFrame, size: int, codes: int, best: int, same: bool, seed: int) -> DataFrame:
    """The ``best`` rows of every anchor and range over all tiles."""
    n_rows, n_anchors = rows.count(), anchors.count()
    row_groups = max(1, -(-n_rows // TILE_ROWS))
    anchor_groups = max(1, -(-n_anchors * size * 8 // TILE_BYTES))
    group = lambda n: F.pmod(F.xxhash64("uid"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.withColumn("r", group(row_groups)).withColumn("a", every(anchor_groups))
    right = anchors.withColumn("a", group(anchor_groups)).withColumn("r", every(row_groups))
    found = left.groupBy("r", "a").cogroup(right.groupBy("r", "a")).applyInArrow(_search(size, codes, best, same, seed), FOUND)
    order = Window.partitionBy("anchor", "high").orderBy(F.desc("score"), F.col("vec_id").asc_nulls_last(), "uid")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best)


def relabelled(vectors: DataFrame) -> DataFrame:
    """Where vec_id is divisible by 7, the label is the next of ten."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return vectors.select("vec_id", "embedding", moved.alias("label"))


def negatives(
    vectors: DataFrame,
    is_anchor,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    scale: int = SCALE,
    codes: int = CODES,
    seed: int = SEED,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; ``is_anchor`` is a condition on ``vec_id``. An anchor's
    positives are the ``positives`` highest other rows of its label; for each, the ``negatives`` highest rows of other
    labels with a score of ``LOW`` to ``HIGH`` hundredths of the positive's come back, equal scores by smaller vec_id.
    """
    rows, size = encoded(vectors, scale, codes, seed)
    anchors = written(rows.where(is_anchor).select("uid", F.col("vec_id").alias("anchor_id"), "label", "vector"), "anchors")
    every = anchors.drop("anchor_id").withColumn("highs", F.array(F.lit(0).cast("long")))
    near = written(_tiles(rows, every, size, codes, positives, True, seed), "positives")
    highs = near.where("score >= 0").groupBy(F.col("anchor").alias("uid")).agg(F.collect_set("score").alias("highs"))
    asked = anchors.drop("anchor_id").join(highs, "uid")
    far = _tiles(rows, asked, size, codes, negatives, False, seed)
    far = far.select("anchor", F.col("high").alias("score"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score"))
    pairs = near.select("anchor", F.col("vec_id").alias("positive_id"), "score").join(far, ["anchor", "score"])
    ids = anchors.select(F.col("uid").alias("anchor"), "anchor_id")
    return pairs.join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", F.col("score").alias("positive_score"), "negative_score"
    )


def mined(vectors: DataFrame) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    return negatives(relabelled(vectors), F.col("vec_id") % 100 == 0)
