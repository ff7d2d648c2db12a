"""Languages of a text as a mixture, by expectation-maximisation over n-gram likelihoods.

Features are three-byte grams of the text in lower case (A to Z), all but letters read as one space. Every language
has a distribution over hashed grams, counted over all labelled rows it is learned from. A document is a mixture of
these distributions; expectation-maximisation finds the shares. The set of languages is the one of the nested sets
(largest share first) with the best likelihood less half the logarithm of the number of grams for each language. No
share is too small for the choice: sets are left out only where the greatest likelihood that any mixture can have, less
their penalty, is below what a smaller set has reached. Neighbouring grams overlap in two bytes of three, so a third
of the grams counts as independent.

The model goes to every task, 256 kB a language. Of more than ``MOST_LANGUAGES`` values of ``lang`` those with the
most grams are learned, of equal ones those that sort first; ``values_of`` tells which. The others are never predicted.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.llm import arrays
from dealreports.llm.shared import written

GRAMS = 1 << 15
ORDER = 3
SMOOTH = 0.5
STEPS = 25
MOST_LANGUAGES = 1000
HELD = 200  # languages that a task adds up at a time
UNKNOWN = "und"

COUNTS = "lang string, gram int, n long"
PREDICTED = T.StructType(
    [
        T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
        T.StructField("languages", T.ArrayType(T.StringType())),
        T.StructField("shares", T.ArrayType(T.DoubleType())),
        T.StructField("fit", T.DoubleType()),
    ]
)

# ASCII letters in lower case, bytes of other characters as they are, everything else a space.
_FOLDED = np.array([ord(chr(b).lower()) if chr(b).isalpha() and b < 128 else b if b >= 128 else 32 for b in range(256)])
_FOLDED = _FOLDED.astype(np.uint32)


def grams(data: np.ndarray) -> np.ndarray:
    """Hashed grams of one text, with a space before and after; runs of spaces count as one."""
    folded = np.concatenate([[32], _FOLDED[data], [32]]).astype(np.uint32)
    space = folded == 32
    folded = folded[~(space & np.concatenate([[False], space[:-1]]))]
    if len(folded) < ORDER:
        return np.zeros(0, dtype=np.int64)
    code = folded[:-2] | (folded[1:-1] << np.uint32(8)) | (folded[2:] << np.uint32(16))
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int64)


def has_letter(data: np.ndarray) -> bool:
    kinds = _FOLDED[data]
    if ((kinds >= 97) & (kinds <= 122)).any():
        return True
    return bool((data >= 128).any()) and any(c.isalpha() for c in data.tobytes().decode())


def counts(labelled: DataFrame) -> DataFrame:
    """``lang, gram, n`` over all rows of ``labelled`` (``text``, ``lang``); each task adds up its own rows first."""

    def given(sums: dict[str, np.ndarray]):
        for lang, n in sums.items():
            seen = np.flatnonzero(n)
            columns = [pa.array([lang] * len(seen), pa.string()), pa.array(seen, pa.int32()), pa.array(n[seen])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    def rows(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for chunk in arrays.chunks(batch.column(0)):
                bounds = chunk.offsets.tolist()
                for lang, lo, hi in zip(batch.column(1)[chunk.rows].to_pylist(), bounds, bounds[1:]):
                    if lang not in sums:
                        if len(sums) == HELD:
                            yield from given(sums)
                            sums = {}
                        sums[lang] = np.zeros(GRAMS, dtype=np.int64)
                    sums[lang] += np.bincount(grams(chunk.data[lo:hi]), minlength=GRAMS)
        yield from given(sums)

    found = labelled.where("lang is not null").select("text", "lang").mapInArrow(rows, COUNTS)
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Languages in the order of their names, and their gram probabilities (one row for each gram)."""

    def __init__(self, languages: list[str], chances: np.ndarray):
        self.languages, self.chances = languages, chances

    def shares(self, n: np.ndarray, seen: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, float]:
        """Shares of the languages ``among`` that make the counted grams likeliest, and the log-likelihood."""
        chances = self.chances[np.ix_(seen, among)]
        pi, total = np.full(len(among), 1 / len(among)), n.sum()
        if len(among) > 1:
            for _ in range(STEPS):
                pi = pi * (chances.T @ (n / (chances @ pi))) / total
        return pi, float(n @ np.log(chances @ pi))

    def missing(self, n: np.ndarray, seen: np.ndarray, pi: np.ndarray) -> float:
        """At most so much are the shares ``pi`` of all languages below the greatest log-likelihood.

        By Jensen's inequality the gain of any other shares is no more than the logarithm of the largest factor that
        the next step would give a share, for each gram.
        """
        chances = self.chances[seen]
        factors = chances.T @ (n / (chances @ pi)) / n.sum()
        return float(n.sum() * np.log(max(factors.max(), 1.0)))

    def predict(self, data: np.ndarray) -> tuple[str, float, list[str], list[float], float]:
        """Main language and its share, all languages of the set and their shares, mean log-likelihood of a gram."""
        if not self.languages or not has_letter(data):
            return UNKNOWN, 0.0, [], [], 0.0
        n = np.bincount(grams(data), minlength=GRAMS)
        seen = np.flatnonzero(n)
        n = n[seen].astype(float)
        every, likelihood = self.shares(n, seen, np.arange(len(self.languages)))
        greatest = likelihood + self.missing(n, seen, every)
        order = np.argsort(-every, kind="stable")
        penalty = 0.5 * np.log(max(n.sum() / ORDER, 2))
        best = None
        for size in range(1, len(order) + 1):
            if best is not None and greatest / ORDER - penalty * size <= best[0]:
                break  # neither this set nor a larger one can be better
            pi, likelihood = self.shares(n, seen, order[:size])
            value = likelihood / ORDER - penalty * size
            if best is None or value > best[0]:
                best = value, pi, order[:size], likelihood / n.sum()
        _, pi, chosen, fit = best
        rank = np.lexsort((chosen, -pi))
        names = [self.languages[i] for i in chosen[rank]]
        shares = [min(1.0, float(x)) for x in pi[rank]]
        return names[0], shares[0], names, shares, fit


def values_of(table: DataFrame) -> DataFrame:
    """``lang, n_grams, learned`` of every value in a table of counts: whether it is among those a model learns."""
    totals = table.groupBy("lang").agg(F.sum("n").alias("n_grams"))
    most = totals.orderBy(F.desc("n_grams"), "lang").limit(MOST_LANGUAGES).select("lang", F.lit(True).alias("learned"))
    return totals.join(F.broadcast(most), "lang", "left").select("lang", "n_grams", F.coalesce("learned", F.lit(False)).alias("learned"))


def learn(labelled: DataFrame) -> Model:
    """A model from all rows of ``labelled`` (``text``, ``lang``). Rows without lang, and empty texts, teach nothing."""
    return fitted(written(counts(labelled), "grams"))


def fitted(table: DataFrame) -> Model:
    """A model from a table of counts. The driver gets one row a language, its counts packed."""

    def packed(group: pa.Table) -> pa.Table:
        n = np.zeros(GRAMS, dtype=np.int64)
        n[np.asarray(group.column("gram"))] = np.asarray(group.column("n"))
        return pa.table({"lang": group.column("lang").slice(0, 1), "counts": pa.array([n.tobytes()], pa.binary())})

    # A group has at most GRAMS rows.
    learned = table.join(F.broadcast(values_of(table).where("learned").select("lang")), "lang")
    found = learned.groupBy("lang").applyInArrow(packed, "lang string, counts binary").collect()
    found.sort(key=lambda r: r["lang"])
    n = np.zeros((GRAMS, len(found)))
    for i, row in enumerate(found):
        n[:, i] = np.frombuffer(row["counts"], dtype=np.int64)
    return Model([r["lang"] for r in found], (n + SMOOTH) / (n.sum(axis=0) + SMOOTH * GRAMS))


def predicted(docs: DataFrame, model: Model, column: str = "language") -> DataFrame:
    """``docs`` with ``column``, a struct of ``lang_pred, score, languages, shares, fit`` of its ``text``.

    NULL, empty and letterless texts are ``und`` with score 0 and no languages. ``score`` is the share of the main
    language; equal shares go to the name that sorts first.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")
    kinds = [("lang_pred", pa.string()), ("score", pa.float64()), ("languages", pa.list_(pa.string())),
             ("shares", pa.list_(pa.float64())), ("fit", pa.float64())]

    def rows(batches):
        for batch in batches:
            out = []
            for chunk in arrays.chunks(batch.column(at)):
                bounds = chunk.offsets.tolist()
                out += [sent.value.predict(chunk.data[lo:hi]) for lo, hi in zip(bounds, bounds[1:])]
            columns = [pa.array([r[i] for r in out], kind) for i, (_, kind) in enumerate(kinds)]
            struct = pa.StructArray.from_arrays(columns, [name for name, _ in kinds])
            yield pa.RecordBatch.from_arrays([*batch.columns, struct], names=[*batch.schema.names, column])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, T.StructField(column, PREDICTED)]))


def held_out(doc_id: Column) -> Column:
    """Whether a document is left out of learning: crc32 of its id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def languages_of(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score, languages, shares`` of every row, learned from those not held out.

    A row without doc_id is not held out.
    """
    docs = docs.select("doc_id", "text", "lang")
    model = learn(docs.where(~held_out(F.col("doc_id"))))
    out = predicted(docs.select("doc_id", "text"), model).select("doc_id", "language.*")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "languages", "shares")
