"""SentencePiece segmentation: the N best segmentations of whole texts, and decoding.

The text gets a space in front, spaces become ``▁``. A segmentation is a path through the lattice of pieces, its
score the sum of its pieces' scores. A character that is no piece costs ``UNKNOWN_PENALTY`` more than the worst piece
and is written as its UTF-8 bytes. Pieces that the model rules out (scores below ``RULED_OUT``) are not used, but for
the single ``▁``, which costs as much as an unknown character. A ``▁`` that the text itself has is written as bytes,
so that decoding gives back every text exactly.

No piece goes across a space or a line end, or joins letters with marks but for the pairs that the vocabulary shows,
so the lattice of a text is the lattices of its words one after another.
Words are solved once and kept (up to ``KEPT_WORDS`` in a worker, then anew). The N best paths differ from the best in the N - 1 words whose
second best path loses least. Through the lattice of these words a backward A-star search, with the forward Viterbi
scores as exact heuristics, gives the N best paths in order. Of words with equal losses those further left change.
"""

import hashlib
import heapq
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dealreports.llm import arrays

SPACE = "▁"
N_BEST = 4
UNKNOWN_PENALTY = 10.0
RULED_OUT = -1e8
KEPT_WORDS = 1 << 20


def _word_pattern(pieces: list[str]) -> re.Pattern:
    """Cuts a text before spaces and line ends, and between letters or digits and marks unless a piece joins the two."""
    joined = {(a, b) for p in pieces for a, b in zip(p, p[1:]) if a != SPACE and a.isalnum() != b.isalnum()}
    if len(joined) > 100:
        return re.compile(r"[ \n][^ \n]*")
    unit = r"(?:[^\W_]+|(?:[^\w \n]|_)+)"
    across = "|".join(f"(?<={re.escape(a)})(?={re.escape(b)})" for a, b in sorted(joined))
    more = f"(?:(?:{across}){unit})*" if joined else ""
    return re.compile(rf"[ \n]?{unit}{more}|[ \n]")


class Vocabulary:
    """Pieces with their scores. ``entries``: piece, score and kind (``piece``, ``byte`` or ``other``) by id."""

    def __init__(self, entries: list[tuple[str, float, str]]):
        usable = [(p, s, i) for i, (p, s, kind) in enumerate(entries) if kind == "piece" and s > RULED_OUT]
        # A longer piece with a space inside would join words.
        usable = [(p, s, i) for p, s, i in usable if SPACE not in p[1:] and not re.search(r"[ \n]", p)]
        self.unknown = min((s for _, s, _ in usable), default=0.0) - UNKNOWN_PENALTY
        usable += [(p, self.unknown, i) for i, (p, s, _) in enumerate(entries) if p == SPACE and s <= RULED_OUT]
        self.byte = {int(p[1:-1], 16): i for i, (p, _, kind) in enumerate(entries) if kind == "byte"}
        if len(self.byte) < 256:
            raise ValueError("the model has no piece for every byte")
        # A tree of characters: score and id of the piece that ends at a node (or None), and the nodes after it.
        self.tree: dict = {}
        for p, score, i in usable:
            after = self.tree
            for c in p:
                node = after.setdefault(c, [None, None, {}])
                after = node[2]
            node[:2] = score, i
        self.written = [
            bytes([int(p[1:-1], 16)]) if kind == "byte" else p.replace(SPACE, " ").encode() if kind == "piece" else b""
            for p, _, kind in entries
        ]
        self.word = _word_pattern([p for p, _, _ in usable])

    def words(self, text: str) -> list[str]:
        """A text, with a space in front, cut where no piece goes across."""
        return self.word.findall(" " + text)

    @staticmethod
    def spelled(word: str) -> str:
        """A word with its space as ``▁``; a ``▁`` of its own as a line end, which is no piece and so goes as bytes."""
        out = word.replace(SPACE, "\n")
        return SPACE + out[1:] if word[:1] == " " else out

    def arcs(self, word: str) -> list[list[tuple[int, float, int | None]]]:
        """For each character of a word the arcs that begin there: end, score, id (None: written as bytes).

        A space can only be a word's first character.
        """
        spelled, out, n = self.spelled(word), [], len(word)
        for i in range(n):
            here, after, j = [], self.tree, i
            while j < n and (node := after.get(spelled[j])):
                j += 1
                score, piece, after = node
                if score is not None:
                    here.append((j, score, piece))
            if not here or here[0][0] != i + 1:
                here.insert(0, (i + 1, self.unknown, None))
            out.append(here)
        return out

    def solve(self, word: str) -> tuple[float, float, list[int]]:
        """Best score of a word, what the second best path loses against it, and the ids of the best.

        A forward pass with the two best scores of every place, over the arcs as ``arcs`` gives them.
        """
        spelled, n, tree = self.spelled(word), len(word), self.tree
        best, second = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1)
        origin, by = [0] * (n + 1), [None] * (n + 1)
        for i in range(n):
            so_far, behind, after, j = best[i], second[i], tree, i
            node = after.get(spelled[i])
            if node is None or node[0] is None:
                self._reach(i + 1, i, so_far + self.unknown, behind + self.unknown, None, best, second, origin, by)
            while node is not None:
                j += 1
                score, piece, after = node
                if score is not None:
                    value = so_far + score
                    if value > best[j]:
                        old, value_behind = best[j], behind + score
                        second[j] = old if old > value_behind else value_behind
                        best[j], origin[j], by[j] = value, i, piece
                    elif value > second[j]:
                        second[j] = value
                node = after.get(spelled[j]) if j < n else None
        steps, at = [], n
        while at:
            steps.append((origin[at], at, by[at]))
            at = origin[at]
        return best[n], best[n] - second[n], self.ids(word, steps[::-1])

    @staticmethod
    def _reach(j, i, value, value_behind, piece, best, second, origin, by) -> None:
        if value > best[j]:
            second[j] = max(best[j], value_behind)
            best[j], origin[j], by[j] = value, i, piece
        elif value > second[j]:
            second[j] = value

    def ids(self, word: str, steps: list[tuple[int, int, int | None]]) -> list[int]:
        """The ids of a path's arcs (begin, end, id)."""
        out = []
        for i, j, piece in steps:
            if piece is None:
                out.extend(self.byte[b] for b in word[i:j].encode())
            else:
                out.append(piece)
        return out

    def decode(self, ids) -> str:
        """The text of a segmentation of a whole text, without the space in front."""
        return b"".join(map(self.written.__getitem__, ids)).decode(errors="replace")[1:]


def viterbi(arcs) -> list[float]:
    """Best score of every place from the left."""
    best = [0.0] + [-np.inf] * len(arcs)
    for i, here in enumerate(arcs):
        for j, score, _ in here:
            if best[i] + score > best[j]:
                best[j] = best[i] + score
    return best


def n_best(arcs, n: int) -> list[tuple[float, list[tuple[int, int, int | None]]]]:
    """The ``n`` best paths, best first, by A-star from the end; the forward scores are exact heuristics."""
    forward = viterbi(arcs)
    into: list[list[tuple[int, float, int | None]]] = [[] for _ in range(len(arcs) + 1)]
    for i, here in enumerate(arcs):
        for j, score, piece in here:
            into[j].append((i, score, piece))
    out, count = [], 0
    # Among equal scores the path that has come furthest goes on, so that ties cannot fill the agenda.
    agenda = [(-forward[-1], len(arcs), 0, 0.0, None)]
    while agenda and len(out) < n:
        _, at, _, done, tail = heapq.heappop(agenda)
        if at == 0:
            steps = []
            while tail:
                steps.append(tail[0])
                tail = tail[1]
            out.append((done, steps))
            continue
        for i, score, piece in into[at]:
            count += 1
            item = (-(forward[i] + score + done), i, count, done + score, ((i, at, piece), tail))
            heapq.heappush(agenda, item)
    return out


class _Words(dict):
    """Solved words: a word's number, by which arrays give score, loss of the second best, and ids."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.score, self.loss = np.zeros(1024), np.zeros(1024)
        self.begin, self.flat = np.zeros(1025, dtype=np.int64), np.zeros(8192, dtype=np.int32)

    def __missing__(self, word: str) -> int:
        number = len(self)
        score, loss, ids = self.vocabulary.solve(word)
        if number == len(self.score):
            self.score, self.loss = (np.concatenate([x, np.zeros_like(x)]) for x in (self.score, self.loss))
            self.begin = np.concatenate([self.begin, np.zeros(number, dtype=np.int64)])
        begin = int(self.begin[number])
        while begin + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.score[number], self.loss[number] = score, loss
        self.flat[begin : begin + len(ids)] = ids
        self.begin[number + 1] = begin + len(ids)
        self[word] = number
        return number


class Encoder:
    def __init__(self, vocabulary: Vocabulary, n: int = N_BEST):
        self.vocabulary, self.n, self.words = vocabulary, n, _Words(vocabulary)

    def encode(self, text: str) -> list[tuple[float, np.ndarray]]:
        """Score and ids of the best segmentations of a whole text, best first; at most ``n``, fewer if there are."""
        if len(self.words) > KEPT_WORDS:
            self.words = _Words(self.vocabulary)
        known, spoken = self.words, self.vocabulary.words(text)
        number = np.array(list(map(known.__getitem__, spoken)), dtype=np.int64)
        begin, size = known.begin[number], known.begin[number + 1] - known.begin[number]
        place = np.concatenate([[0], np.cumsum(size)])
        ids = known.flat[np.repeat(begin - place[:-1], size) + np.arange(place[-1])]
        score = float(known.score[number].sum())
        loss = known.loss[number]
        fewest = self.n - 1
        able = np.flatnonzero(loss < np.inf)
        if not fewest or not len(able):
            return [(score, ids)]
        if len(able) > fewest:
            limit = np.partition(loss[able], fewest - 1)[fewest - 1]
            able = able[loss[able] <= limit]
            able = able[np.argsort(loss[able], kind="stable")[:fewest]]
        able = np.sort(able).tolist()
        out = []
        for value, changes in self._among([spoken[i] for i in able]):
            parts, at = [], 0
            for i, own in zip(able, changes):
                parts += [ids[at : place[i]], own]
                at = place[i + 1]
            total = score - float(known.score[number[able]].sum()) + value
            out.append((total, np.concatenate([*parts, ids[at:]])))
        return out

    def _among(self, words: list[str]) -> list[tuple[float, list[np.ndarray]]]:
        """The best paths through some words one after another: score, and the ids of every word."""
        arcs, ends = [], [0]
        for word in words:
            shift = len(arcs)
            arcs += [[(j + shift, s, p) for j, s, p in here] for here in self.vocabulary.arcs(word)]
            ends.append(len(arcs))
        out = []
        for score, steps in n_best(arcs, self.n):
            own = []
            for word, lo, hi in zip(words, ends, ends[1:]):
                inside = [(i - lo, j - lo, p) for i, j, p in steps if lo <= i < hi]
                own.append(np.array(self.vocabulary.ids(word, inside), dtype=np.int32))
            out.append((score, own))
        return out


_encoders: dict[tuple[int, int], Encoder] = {}


def _encoder(vocabulary: Vocabulary, n: int) -> Encoder:
    """A worker's encoder; it keeps its words from task to task. Only the last vocabulary's is kept."""
    found = _encoders.get((id(vocabulary), n))
    if found is None or found.vocabulary is not vocabulary:
        _encoders.clear()
        found = _encoders[id(vocabulary), n] = Encoder(vocabulary, n)
    return found


def vocabulary(model_file: str) -> Vocabulary:
    """Reads a SentencePiece model file (on the driver; a vocabulary goes to the tasks as a broadcast)."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    kinds = {True: "byte", False: "piece"}
    entries = [
        (
            model.id_to_piece(i),
            model.get_score(i),
            "other" if model.is_control(i) or model.is_unknown(i) or model.is_unused(i) else kinds[model.is_byte(i)],
        )
        for i in range(model.get_piece_size())
    ]
    return Vocabulary(entries)


SEGMENTATION = T.StructType(
    [T.StructField("score", T.DoubleType()), T.StructField("pieces", T.ArrayType(T.IntegerType()))]
)
_ARROW = pa.list_(pa.struct([("score", pa.float64()), ("pieces", pa.list_(pa.int32()))]))


def segmented(
    docs: DataFrame, model_file: str, n: int = N_BEST, column: str = "segmentations", decoded_into: str | None = None
) -> DataFrame:
    """``docs`` with ``column``: the ``n`` best segmentations (score, ids) of each ``text``, best first.

    A NULL text counts as an empty one; the empty text is the single space in front. Fewer than ``n`` come back if
    there are no more. With ``decoded_into``, that column is the text that the ids of the best stand for, as
    ``decoded`` gives it: the ids need not go to a second worker, several times the text in a batch.
    """
    sent, at = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file)), docs.columns.index("text")
    made = [T.StructField(column, T.ArrayType(SEGMENTATION))]
    if decoded_into is not None:
        made.append(T.StructField(decoded_into, T.StringType()))

    def rows(batches):
        encoder = _encoder(sent.value, n)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                best = [encoder.encode(t or "") for t in part.column(at).to_pylist()]
                flat = [x for b in best for x in b]
                ids = pa.ListArray.from_arrays(_bounds(len(x[1]) for x in flat), _joined([x[1] for x in flat]))
                structs = pa.StructArray.from_arrays([pa.array([x[0] for x in flat]), ids], ["score", "pieces"])
                found = [pa.ListArray.from_arrays(_bounds(len(b) for b in best), structs)]
                if decoded_into is not None:
                    found.append(pa.array([sent.value.decode(b[0][1].tolist()) for b in best], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns, *found], names=[*part.schema.names, *(f.name for f in made)])

    return docs.mapInArrow(rows, T.StructType([*docs.schema.fields, *made]))


def _bounds(sizes) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.fromiter(sizes, dtype=np.int64))]), pa.int32())


def _joined(parts: list[np.ndarray]) -> pa.Array:
    return pa.array(np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32), pa.int32())


def decoded(encoded: DataFrame, model_file: str, column: str = "pieces", into: str = "text") -> DataFrame:
    """``encoded`` with ``into``: the text that the ids in ``column`` stand for; NULL ids give NULL."""
    sent, at = encoded.sparkSession.sparkContext.broadcast(vocabulary(model_file)), encoded.columns.index(column)

    def rows(batches):
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                texts = [None if x.as_py() is None else sent.value.decode(x.values.to_pylist()) for x in part.column(at)]
                columns = [*part.columns, pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=[*part.schema.names, into])

    return encoded.mapInArrow(rows, T.StructType([*encoded.schema.fields, T.StructField(into, T.StringType())]))


ENCODED = """doc_id long, n_pieces int, score double, ids_sha256 string, decoded_sha256 string,
    nbest array<struct<score: double, n_pieces: int, ids_sha256: string>>"""


def digests(docs: DataFrame, model_file: str, n: int = N_BEST) -> DataFrame:
    """``segmented`` and ``decoded`` in one pass, told by digests: one row for every row of ``docs``.

    ``ids_sha256`` is taken over the ids as 32-bit little-endian numbers, ``decoded_sha256`` over the UTF-8 text that
    decoding the best segmentation gives.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(model_file))
    kind = pa.list_(pa.struct([("score", pa.float64()), ("n_pieces", pa.int32()), ("ids_sha256", pa.string())]))

    def rows(batches):
        encoder = _encoder(sent.value, n)
        for batch in batches:
            for lo in range(0, len(batch), 256):
                part = batch.slice(lo, 256)
                found, texts = [], []
                for text in part.column(1).to_pylist():
                    best = encoder.encode(text or "")
                    texts.append(hashlib.sha256(sent.value.decode(best[0][1].tolist()).encode()).hexdigest())
                    found.append([
                        {"score": s, "n_pieces": len(i), "ids_sha256": hashlib.sha256(i.astype("<i4").tobytes()).hexdigest()}
                        for s, i in best
                    ])
                first = [f[0] for f in found]
                columns = [
                    part.column(0),
                    pa.array([f["n_pieces"] for f in first], pa.int32()),
                    pa.array([f["score"] for f in first], pa.float64()),
                    pa.array([f["ids_sha256"] for f in first], pa.string()),
                    pa.array(texts, pa.string()),
                    pa.array(found, kind),
                ]
                yield pa.RecordBatch.from_arrays(
                    columns, names=["doc_id", "n_pieces", "score", "ids_sha256", "decoded_sha256", "nbest"]
                )

    return docs.select("doc_id", F.col("text")).mapInArrow(rows, ENCODED)
