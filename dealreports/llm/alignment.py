"""Alignment of two tokenizers: groups of tokens with common ends, and how often linked ids meet in the corpus.

A text is encoded by A (byte-level BPE, with a space in front) and by B (SentencePiece, which adds the space). The
tokens' bytes give their ends; where both end, a group ends. Between two neighbouring ends of either side lies one
link: the A and the B token whose byte ranges overlap there.

Pairs of ids are counted over the corpus by external spill counting:

1. Texts are worked on in blocks of about ``BLOCK_BYTES``. The links of a block, as (A id, B id, text of the block,
   times), are sorted A-major and cut into ``RADICES`` runs by A id; each run is packed by zstd and written, the pairs
   with their numbers of texts apart from the texts.
2. ``FAN_IN`` runs of a radix at a time meet in a k-way heap merge that adds up the numbers of texts, in
   rounds until one run a radix is left. An A id's pairs follow one another there, so its highest count is known when
   they end.
3. The counts stream back to the runs: runs of a radix in groups of about ``GROUP_BYTES``, so that an id that a
   third of all texts have is dealt to many tasks, each with the counts of that radix. A run gives each text of its block the sum over
   its links and the number of links with their A id's highest count; blocks add these up over the radices.

A task holds some runs, blocks of merged runs or the counts of one radix, never all records of an id. Packed
runs are written to the shared folder; what a lost executor held is read or computed again.

Defined results: a NULL or empty text, or one whose joined token bytes of A or of B are not space and text, has no
tokens (zeros, ``groups_sha256`` empty). Strings of special tokens are plain text. Rows stay rows: repeated rows count
as texts of their own. Texts are whole at any length. Columns besides doc_id and text are not looked at.
"""

import functools
import hashlib
import heapq
import json
import os
import re
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.llm import arrays
from dealreports.llm.shared import written
from dealreports.llm.tokens import PATTERN

BLOCK_BYTES = 2 << 20
RADICES = 64
FAN_IN = 32
GROUP_BYTES = 32 << 20
FRAME = 1 << 15  # pairs that a reader of a run holds at a time


def byte_of_letter() -> dict[str, int]:
    """The letters that byte-level vocabularies write bytes with: visible ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


# Letters, marks and spaces up to here have been the same in all versions of Unicode that the two libraries may have.
LONG_KNOWN = re.compile("[\\x00-\u04ff\u2010-\u2027\u2030-\u205e]*")


def ranked(file: dict, a_bytes: list[bytes]):
    """The same byte-level BPE in tiktoken, some three times as fast; None if the file asks for anything else.

    Ranks are ids, so the merges must be in the order of the ids that they make.
    """
    import tiktoken

    model, cut = file["model"], file.get("pre_tokenizer") or {}
    plain = (
        model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback"))
        and (cut.get("type"), cut.get("add_prefix_space"), cut.get("use_regex", True)) == ("ByteLevel", False, True)
        and file.get("normalizer") is None
    )
    if not plain:
        return None
    added = {t["id"] for t in file.get("added_tokens", [])}
    merges = ["".join(m if isinstance(m, list) else m.split(" ")) for m in model["merges"]]
    ids = [model["vocab"].get(m) for m in merges]
    if ids != list(range(256, 256 + len(ids))) or len(set(model["vocab"].values()) - added) != 256 + len(ids):
        return None
    ranks = {token: i for i, token in enumerate(a_bytes) if i not in added}
    return tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


class Pair:
    """The two tokenizers and the bytes of their tokens."""

    def __init__(self, a_file: str, b_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_file)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_file)
        self.b_file = b_file
        letters = byte_of_letter()
        with open(a_file, encoding="utf-8") as lines:
            file = json.load(lines)
        extra = {t["id"]: t["content"].encode() for t in file.get("added_tokens", [])}
        entries = {i: t for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        n = max(entries) + 1
        self.a_bytes = [
            extra[i] if i in extra else bytes(letters[c] for c in entries[i]) if i in entries else b"" for i in range(n)
        ]
        self.b_bytes = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(self.b.id_to_piece(list(range(self.b.get_piece_size()))))
        ]
        self.a_size, self.b_size = (np.array([len(x) for x in side]) for side in (self.a_bytes, self.b_bytes))
        self.ranked = ranked(file, self.a_bytes)
        names = [f"{i}{end}" for i in range(n) for end in ",|"]
        self.names = np.array(names + [f"{i}{end}" for i in range(len(self.b_bytes)) for end in ",;"], dtype=object)

    def a_ids(self, texts: list[str]) -> list[list[int]]:
        """The ids of A: by ranks where both libraries cut the text alike for certain."""
        quick = [self.ranked is not None and LONG_KNOWN.fullmatch(t) is not None for t in texts]
        rest = iter(self.a.encode_batch_fast([t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.ranked.encode_ordinary(t) if q else next(rest).ids for t, q in zip(texts, quick)]

    def encode(self, texts: list[str]) -> list[tuple[list[int], list[int]] | None]:
        """Ids of A and B of each text; None where either does not give back space and text."""
        spaced, found = [" " + t for t in texts], []
        for text, x, y in zip(spaced, self.a_ids(spaced), self.b.encode(texts, num_threads=1)):
            want = text.encode()
            exact = b"".join(map(self.a_bytes.__getitem__, x)) == want == b"".join(map(self.b_bytes.__getitem__, y))
            found.append((x, y) if len(text) > 1 and exact else None)
        return found


@functools.cache
def tokenizer_pair(a_file: str, b_file: str) -> Pair:
    return Pair(a_file, b_file)


def pack(*columns: np.ndarray) -> bytes:
    """Whole numbers in as few bytes as they need, packed by zstd."""
    parts = [struct.pack("<B", len(columns))]
    for column in columns:
        column = column.astype(np.min_scalar_type(int(column.max(initial=0))))
        parts += [struct.pack("<BQ", column.itemsize, len(column)), column.tobytes()]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(parts))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    at, columns = 1, []
    for _ in range(raw[0]):
        width, n = struct.unpack_from("<BQ", raw, at)
        columns.append(np.frombuffer(raw, dtype=f"<u{width}", count=n, offset=at + 9).astype(np.int64))
        at += 9 + width * n
    return columns


def packed_pairs(pairs: np.ndarray, *columns: np.ndarray) -> bytes:
    """A run: frames of ascending pairs and their columns, each with its length in front."""
    out = []
    for lo in range(0, len(pairs), FRAME):
        part = slice(lo, lo + FRAME)
        frame = pack(np.diff(pairs[part], prepend=0), *(c[part] for c in columns))
        out += [struct.pack("<I", len(frame)), frame]
    return b"".join(out)


def frames(run: bytes) -> Iterator[list[np.ndarray]]:
    at = 0
    while at < len(run):
        (n,) = struct.unpack_from("<I", run, at)
        steps, *columns = unpack(run[at + 4 : at + 4 + n])
        yield [np.cumsum(steps), *columns]
        at += 4 + n


def merged(runs: Iterable[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A k-way merge: pairs in ascending order with their counts added up.

    The heap holds the last pair of the frame that each run is at. Up to the smallest of them, nothing is missing.
    """
    readers = [frames(run) for run in runs]
    heads, heap = {}, []

    def advance(i: int) -> None:
        heads[i] = next(readers[i], None)
        if heads[i] is None:
            del heads[i]
        else:
            heapq.heappush(heap, (int(heads[i][0][-1]), i))

    for i in range(len(readers)):
        advance(i)
    while heap:
        limit, done, taken = heap[0][0], [], []
        while heap and heap[0][0] == limit:
            done.append(heapq.heappop(heap)[1])
        for i, (pairs, counts) in heads.items():
            n = int(np.searchsorted(pairs, limit, side="right"))
            taken.append((pairs[:n], counts[:n]))
            heads[i] = [pairs[n:], counts[n:]]
        for i in done:
            advance(i)
        pairs, counts = (np.concatenate(x) for x in zip(*taken))
        order = np.argsort(pairs, kind="stable")
        pairs, counts = pairs[order], counts[order]
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        yield pairs[first], np.add.reduceat(counts, first)


def with_highest(merge: Iterable[tuple[np.ndarray, np.ndarray]], b_size: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Merged pairs and counts, and whether a count is the highest of its A id; an A id's pairs stay together."""
    empty = np.zeros(0, dtype=np.int64)
    pairs, counts = empty, empty

    def judged(pairs, counts):
        side = pairs // b_size
        first = np.flatnonzero(np.append(True, side[1:] != side[:-1]))
        highest = np.maximum.reduceat(counts, first)
        return pairs, counts, counts == np.repeat(highest, np.diff(np.append(first, len(side))))

    for more, number in merge:
        pairs, counts = np.concatenate([pairs, more]), np.concatenate([counts, number])
        whole = int(np.searchsorted(pairs, pairs[-1] // b_size * b_size))
        if whole:
            yield judged(pairs[:whole], counts[:whole])
            pairs, counts = pairs[whole:], counts[whole:]
    if len(pairs):
        yield judged(pairs, counts)


class Block:
    """Texts of a block in both tokenizers: numbers and digests of each text, and the runs of its links."""

    def __init__(self, texts: list[str], pair: Pair, radices: int):
        n = len(texts)
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.zeros(n, dtype=np.int64) for _ in range(4))
        self.groups: list[str] = [""] * n
        self.runs: list[tuple[int, bytes, bytes]] = []
        found = pair.encode(texts)
        where = np.array([i for i, x in enumerate(found) if x], dtype=np.int64)
        if not len(where):
            return
        a, b = (np.concatenate([np.array(found[i][side], dtype=np.int64) for i in where]) for side in (0, 1))
        self.n_a[where], self.n_b[where] = ([len(found[i][side]) for i in where] for side in (0, 1))
        a_end, b_end = np.cumsum(pair.a_size[a]), np.cumsum(pair.b_size[b])
        text_end = a_end[np.cumsum(self.n_a[where]) - 1]
        cuts = np.sort(np.concatenate([a_end, b_end]), kind="stable")
        cuts = cuts[np.append(True, cuts[1:] != cuts[:-1])]
        at_a, at_b = np.searchsorted(a_end, cuts), np.searchsorted(b_end, cuts)
        text = np.searchsorted(text_end, cuts)
        common = (a_end[at_a] == cuts) & (b_end[at_b] == cuts)
        self.n_links[where] = np.bincount(text, minlength=len(where))
        self.n_groups[where] = np.bincount(text[common], minlength=len(where))
        self._name_groups(where, a, b, a_end, b_end, cuts[common], text_end, pair)
        self._cut_runs(a[at_a], b[at_b], where[text], n, pair, radices)

    def _name_groups(self, where, a, b, a_end, b_end, common, text_end, pair) -> None:
        """``a1,a2|b1;a3|b2``: tokens of a group one after another, first those of A."""
        place = np.concatenate([2 * np.searchsorted(common, a_end), 2 * np.searchsorted(common, b_end) + 1])
        order = np.argsort(place, kind="stable")
        last = np.append(place[order][1:] != place[order][:-1], True)
        code = np.concatenate([2 * a, 2 * (b + len(pair.a_bytes))])[order] + last
        names = pair.names[code].tolist()
        lo = 0
        for i in where:
            hi = lo + int(self.n_a[i] + self.n_b[i])
            self.groups[i] = "".join(names[lo:hi])[:-1]
            lo = hi

    def _cut_runs(self, a, b, text, n, pair, radices) -> None:
        n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)
        record = (radix_major(a, n_a, radices) * n_b + b) * n + text
        record = np.sort(record)
        first = np.flatnonzero(np.append(True, record[1:] != record[:-1]))
        times, record = np.diff(np.append(first, len(record))), record[first]
        pairs, text = np.divmod(record, n)
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        counts, pairs = np.diff(np.append(first, len(record))), pairs[first]
        bounds = np.searchsorted(pairs, np.arange(radices + 1) * (-(-n_a // radices) * n_b))
        first = np.append(first, len(record))
        for radix, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
            if lo < hi:
                part = slice(first[lo], first[hi])
                self.runs.append((radix, packed_pairs(pairs[lo:hi], counts[lo:hi]), pack(text[part], times[part])))


def radix_major(a: np.ndarray, n_a: int, radices: int) -> np.ndarray:
    """A ids renumbered so that those of a radix follow one another. Low ids are frequent, so neighbours are dealt out."""
    return a % radices * -(-n_a // radices) + a // radices


def of_radix_major(rank: np.ndarray, n_a: int, radices: int) -> np.ndarray:
    width = -(-n_a // radices)
    return rank % width * radices + rank // width


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")


def _records(docs: DataFrame, a_file: str, b_file: str, radices: int, with_groups: bool) -> DataFrame:
    """One row a text and one a run, written: ``block`` tells what belongs together, ``radix`` is NULL for texts."""
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("place", T.IntegerType())])
    schema.add(docs.schema["doc_id"])
    for name in _NUMBERS:
        schema = schema.add(name, "long")
    schema = schema.add("groups_sha256", "string").add("groups", "string")
    schema = schema.add("radix", "integer").add("pairs", "binary").add("texts", "binary")

    def rows(batches):
        from pyspark import TaskContext

        pair = tokenizer_pair(a_file, b_file)
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1), BLOCK_BYTES):
                texts = [t or "" for t in batch.column(1)[chunk.rows].to_pylist()]
                block, n = Block(texts, pair, radices), len(texts)
                runs = len(block.runs)
                digests = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in block.groups]
                columns = [
                    pa.array(np.full(n + runs, number), pa.int64()),
                    pa.array([*range(n), *[n] * runs], pa.int32()),
                    pa.concat_arrays([batch.column(0)[chunk.rows], pa.nulls(runs, batch.column(0).type)]),
                    *[pa.array([*getattr(block, name).tolist(), *[None] * runs], pa.int64()) for name in _NUMBERS],
                    pa.array(digests + [None] * runs, pa.string()),
                    pa.array([*(block.groups if with_groups else [None] * n), *[None] * runs], pa.string()),
                    pa.array([None] * n + [r[0] for r in block.runs], pa.int32()),
                    *[pa.array([None] * n + [r[k] for r in block.runs], pa.binary()) for k in (1, 2)],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=schema.fieldNames())
                number += 1

    return written(docs.select("doc_id", "text").mapInArrow(rows, schema), "runs")


def _counted(runs: DataFrame, n_runs: int, b_size: int) -> DataFrame:
    """``radix, table``: all pairs of a radix in order, their numbers of texts, and whether these are the highest."""

    def one_run(rows: pa.Table) -> pa.Table:
        parts = [packed_pairs(*x) for x in merged(rows.column("pairs").to_pylist())]
        return pa.table({k: rows.column(k)[:1] for k in ("radix", "block")} | {"pairs": pa.array([b"".join(parts)], pa.binary())})

    def table(rows: pa.Table) -> pa.Table:
        parts = [packed_pairs(*x) for x in with_highest(merged(rows.column("pairs").to_pylist()), b_size)]
        return pa.table({"radix": rows.column("radix")[:1], "table": pa.array([b"".join(parts)], pa.binary())})

    runs = runs.select("radix", F.xxhash64("block").alias("block"), "pairs")
    while n_runs > FAN_IN:
        n_runs = -(-n_runs // FAN_IN)
        runs = runs.withColumn("block", F.pmod("block", F.lit(n_runs)))
        runs = written(runs.groupBy("radix", "block").applyInArrow(one_run, "radix int, block long, pairs binary"), "merged")
    return written(runs.groupBy("radix").applyInArrow(table, "radix int, table binary"), "counts")


def _contributions(runs: DataFrame, counts: DataFrame, groups: int) -> DataFrame:
    """``block, sums``: what each run gives the texts of its block."""

    def summed(key, rows: pa.Table, counts: pa.Table) -> pa.Table:
        blocks, sums = [], []
        if len(rows):
            known = [np.concatenate(x) for x in zip(*(f for t in counts.column("table").to_pylist() for f in frames(t)))]
            for block, n, run, texts in zip(*(rows.column(k).to_pylist() for k in ("block", "place", "pairs", "texts"))):
                text, times = unpack(texts)
                pairs, n_texts = (np.concatenate(x) for x in zip(*frames(run)))
                at = np.repeat(np.searchsorted(known[0], pairs), n_texts)
                best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
                np.add.at(best, text, times * known[2][at])
                np.add.at(total, text, times * known[1][at])
                blocks.append(block)
                sums.append(pack(best, total))
        return pa.table({"block": pa.array(blocks, pa.int64()), "sums": pa.array(sums, pa.binary())})

    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))
    left = runs.select("radix", F.pmod(F.xxhash64("block"), F.lit(groups)).cast("int").alias("part"), "block", "place", "pairs", "texts")
    right = counts.select("radix", every.alias("part"), "table")
    return left.groupBy("radix", "part").cogroup(right.groupBy("radix", "part")).applyInArrow(summed, "block long, sums binary")


def _joined(texts: DataFrame, sums: DataFrame) -> DataFrame:
    """``texts`` with the sums of its blocks over the radices."""
    schema = T.StructType(list(texts.schema.fields)).add("n_best", "long").add("count_sum", "long")

    def added(rows: pa.Table, sums: pa.Table) -> pa.Table:
        n = len(rows)
        best, total = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64)
        for part in sums.column("sums").to_pylist():
            for into, more in zip((best, total), unpack(part)):
                into += more
        place = np.asarray(rows.column("place"))
        return rows.append_column("n_best", pa.array(best[place])).append_column("count_sum", pa.array(total[place]))

    return texts.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(added, schema)


def _measured(docs: DataFrame, a_file: str, b_file: str, radices: int, with_groups: bool):
    records = _records(docs, a_file, b_file, radices, with_groups)
    runs = records.where("radix IS NOT NULL")
    size = F.length("pairs") + F.length("texts")
    each = runs.groupBy("radix").agg(F.count("*").alias("n"), F.sum(size).alias("size"))
    n, size = each.agg(F.max("n"), F.max("size")).first()
    b_size = len(tokenizer_pair(a_file, b_file).b_bytes)
    return records, runs, _counted(runs, n or 0, b_size), max(1, -(-(size or 0) // GROUP_BYTES))


def aligned(docs: DataFrame, a_file: str, b_file: str, radices: int = RADICES, with_groups: bool = False) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for every row of ``docs``.

    ``a_file`` is a byte-level BPE of the tokenizers library, ``b_file`` a SentencePiece model. With ``with_groups``
    the column ``groups`` holds the groups themselves: ``a1,a2|b1;a3|b2,b3``.
    """
    records, runs, counts, groups = _measured(docs, a_file, b_file, radices, with_groups)
    texts = records.where("radix IS NULL").select("block", "place", "doc_id", *_NUMBERS, "groups_sha256", "groups")
    out = _joined(texts, _contributions(runs, counts, groups))
    names = ["doc_id", *_NUMBERS, "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else [])]
    return out.select(names)


def pair_counts(docs: DataFrame, a_file: str, b_file: str, radices: int = RADICES) -> DataFrame:
    """``a, b, n_docs, highest``: every linked pair of ids, how many texts hold it, and whether no B id meets a more."""
    counts = _measured(docs, a_file, b_file, radices, False)[2]
    pair = tokenizer_pair(a_file, b_file)
    n_a, n_b = len(pair.a_bytes), len(pair.b_bytes)

    def rows(batches):
        for batch in batches:
            for table in batch.column(0).to_pylist():
                for pairs, n, highest in frames(table):
                    rank, b = np.divmod(pairs, n_b)
                    a = of_radix_major(rank, n_a, radices)
                    columns = [pa.array(a), pa.array(b), pa.array(n), pa.array(highest.astype(bool))]
                    yield pa.RecordBatch.from_arrays(columns, names=["a", "b", "n_docs", "highest"])

    return counts.select("table").mapInArrow(rows, "a long, b long, n_docs long, highest boolean")
