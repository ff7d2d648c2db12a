"""Tokens of sections of documents, from one encoding of each whole document.

A document is encoded once by a byte-level BPE; its tokens' bytes one after another are the document's. Adding up
their lengths gives every token's span, which is joined with the spans of the sections (both are in order, so a
binary search finds the sections of a token's first and last byte). A token that lies in several sections goes to

* ``most``: the one with most of its bytes, of equal ones the first;
* ``first``: the one with its first byte in a section;
* ``share``: all of them, by the share of its bytes.

Bytes outside all sections count as a section of their own with number NULL, so that nothing is lost.
"""

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.llm import arrays

# Fixed value: how the vocabulary's own tokenizer cuts texts before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("most", "first", "share")


def ranks(file: str) -> dict[bytes, int]:
    """A vocabulary file: a token in base 64 and its rank in each line (read on the driver)."""
    with open(file, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Encoder:
    def __init__(self, vocabulary: dict[bytes, int], pattern: str = PATTERN):
        import tiktoken

        self.encoding = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=vocabulary, special_tokens={})
        self.size = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)
        for token, rank in vocabulary.items():
            self.size[rank] = len(token)

    def ends(self, text: str) -> np.ndarray:
        """Where each token of a text ends, in bytes."""
        return np.cumsum(self.size[np.array(self.encoding.encode_ordinary(text), dtype=np.int64)])


def lines(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans (in bytes) of the lines of a text; a line has its line end. The empty text is one empty line."""
    finish = np.flatnonzero(data == 10) + 1
    if not len(finish) or finish[-1] < len(data):
        finish = np.append(finish, len(data))
    return np.concatenate([[0], finish[:-1]]), finish


def attribute(ends: np.ndarray, begin: np.ndarray, finish: np.ndarray, rule: str) -> np.ndarray:
    """Tokens of each section, and last those of no section. Spans are in order and do not overlap."""
    # Sections and the gaps between them, one after another; the owner of a gap is the extra place at the end.
    bounds = np.stack([begin, finish], axis=1).ravel()
    owner = np.full(len(bounds) + 1, len(begin))
    owner[1::2] = np.arange(len(begin))
    counts = np.zeros(len(begin) + 1)
    start = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    low = np.searchsorted(bounds, start, side="right")
    high = np.searchsorted(bounds, ends - 1, side="right")
    whole = low == high
    np.add.at(counts, owner[low[whole]], 1.0)
    for s, e, lo, hi in zip(start[~whole].tolist(), ends[~whole].tolist(), low[~whole].tolist(), high[~whole].tolist()):
        edges = [s, *bounds[lo:hi].tolist(), e]
        parts = [(b - a, int(owner[lo + k])) for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a]
        inside = [p for p in parts if p[1] < len(begin)] or parts
        if rule == "share":
            for size, own in parts:
                counts[own] += size / (e - s)
        elif rule == "first":
            counts[inside[0][1]] += 1
        else:
            sizes: dict[int, int] = {}
            for size, own in inside:
                sizes[own] = sizes.get(own, 0) + size
            counts[max(sizes, key=lambda own: (sizes[own], -own))] += 1
    return counts


def token_counts(
    docs: DataFrame, vocabulary: dict[bytes, int], rule: str = "most", spans: str | None = None, pattern: str = PATTERN
) -> DataFrame:
    """``doc_id, section, begin, finish, n_tokens`` for every section of every row of ``docs``.

    ``docs`` has ``doc_id`` and ``text``; ``spans`` names a column of arrays of (begin, finish) in code points, in
    order and without overlap; without it the sections are the lines, each with its line end. ``begin`` and ``finish``
    are code points. Tokens outside all sections come in a row with section NULL, if there are any. A NULL text is an
    empty one: a single empty line without tokens. NULL spans mean no sections. Texts are whole at any length.
    """
    if rule not in RULES:
        raise ValueError(f"rule {rule}: one of {', '.join(RULES)}")
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def rows(batches):
        encoder = Encoder(sent.value, pattern)
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1)):
                ids, out = batch.column(0)[chunk.rows], []
                given = batch.column(2)[chunk.rows].to_pylist() if spans else [None] * len(ids)
                where = chunk.offsets.tolist()
                for i, (lo, hi) in enumerate(zip(where, where[1:])):
                    data = chunk.data[lo:hi]
                    point = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])  # code points before each byte
                    if spans:
                        pairs = np.array([tuple(s.values()) for s in given[i] or []], dtype=np.int64).reshape(-1, 2)
                        of_point = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
                        begin, finish = of_point[np.minimum(pairs, len(of_point) - 1)].T
                    else:
                        begin, finish = lines(data)
                    counts = attribute(encoder.ends(data.tobytes().decode()), begin, finish, rule)
                    n = len(begin)
                    out += [(i, k, int(point[begin[k]]), int(point[finish[k]]), counts[k]) for k in range(n)]
                    if counts[n]:
                        out.append((i, None, None, None, counts[n]))
                columns = list(zip(*out)) or [()] * 5
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64())
                taken = ids.take(pa.array(columns[0], kinds[0]))
                yield pa.RecordBatch.from_arrays(
                    [taken, *[pa.array(c, k) for c, k in zip(columns[1:], kinds[1:])]],
                    names=["doc_id", "section", "begin", "finish", "n_tokens"],
                )

    taken = docs.select("doc_id", "text", *([spans] if spans else []))
    counts = T.StructType([taken.schema["doc_id"]])
    for name, kind in (("section", "integer"), ("begin", "long"), ("finish", "long"), ("n_tokens", "double")):
        counts = counts.add(name, kind)
    return taken.mapInArrow(rows, counts)


def line_tokens(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Whole tokens of each line, a token across a line's end counted where most of it is."""
    return token_counts(docs, vocabulary, "most").withColumn("n_tokens", F.col("n_tokens").cast("long"))
