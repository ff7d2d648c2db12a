"""Removal of passages that an earlier document has, found with a compressed FM-index per shard.

A window is ``WINDOW`` consecutive words of one document. It is removed if a document with a smaller doc_id has it.

Equal windows have an equal smallest hash among the 16-word runs inside them (their anchor). Neighbouring windows
with one anchor form a stretch. Only stretches whose anchor occurs in two documents can hold a repeated window, and
equal stretches need to be looked at once. The words of each distinct stretch go to the shard of their anchor, where
an FM-index over all of the shard's stretches gives, for every window of every stretch, the smallest doc_id that has
it. Windows of a document are removed where that is smaller than its own.

An anchor with more than ``CROWDED`` distinct stretches (a passage in a large part of all documents, always with
other words around it) is dealt out anew by whole windows: those that occur once are left out, the others become
stretches of one window, spread over all shards.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dealreports.llm import arrays
from dealreports.llm.fm_index import Index
from dealreports.llm.shared import unused, written

WINDOW = 50
ANCHOR = 16  # words of the runs that anchors are chosen from
CROWDED = 1000
SHARD_WORDS = 400_000
LONGEST = 64  # windows in a stretch

SIGNED = """doc_id long, digest string, n_words long, kept_sha256 string,
    stretches array<struct<anchor: long, content: long, at: int, windows: int>>"""
CUT = "anchor long, content long, doc_id long, last long, words binary"
KEPT = "doc_id long, digest string, text_key long, n_removed long, kept_sha256 string, kept_text string"
FOUND = "anchor long, content long, begin int, finish int, owner long"


def _digest(hashes: np.ndarray) -> str:
    return xxhash.xxh3_128_hexdigest(np.ascontiguousarray(hashes).tobytes())


def _text_of(found: arrays.Words, lo: int, hi: int, kept: np.ndarray | None = None) -> bytes:
    """Words ``lo`` up to ``hi`` (those that are kept) joined by one space."""
    data = found.data
    if hi == lo:
        return b""
    begin, end = int(found.start[lo]), int(found.end[hi - 1])
    places = found.start[lo:hi] - begin, found.end[lo:hi] - begin
    edges = np.zeros(end - begin + 1, dtype=np.int8)
    if kept is not None:
        places = places[0][kept], places[1][kept]
        if not len(places[0]):
            return b""
    edges[places[0]] += 1
    edges[places[1]] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).astype(bool)
    # One separator stays before every word but the first.
    text = np.where(inside, data[begin:end], np.uint8(0x20))
    inside[places[0][1:] - 1] = True
    return text[inside].tobytes()


def stretches(hashes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Anchor, content hash, first word and number of windows of every stretch of one document."""
    if len(hashes) < WINDOW:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(4))
    anchors = arrays.sliding_minimum(arrays.runs(hashes, ANCHOR), WINDOW - ANCHOR + 1)
    n = len(anchors)
    begin = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
    size = np.diff(np.append(begin, n))
    pieces = (size + LONGEST - 1) // LONGEST
    at = np.repeat(begin, pieces) + LONGEST * (np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces))
    windows = np.diff(np.append(at, n))
    # A stretch's content: two overlapping ends of windows do not fix the middle, so every word goes in.
    up, down = arrays.powers(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * up[:-1], dtype=np.uint64, out=total[1:])
    content = arrays.mixed((total[at + windows + WINDOW - 1] - total[at]) * down[at] + windows.astype(np.uint64))
    return anchors[at].view(np.int64), content.view(np.int64), at, windows


def signed(docs: DataFrame) -> DataFrame:
    """Words, the hash of the words joined by one space, and the stretches of every document."""

    def rows(batches):
        for batch in batches:
            ids = batch.column(0)
            for chunk in arrays.chunks(batch.column(1)):
                found = arrays.words(chunk.data, chunk.offsets)
                digests, sizes, shas, lists = [], [], [], []
                for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
                    digests.append(_digest(found.hashes[lo:hi]))
                    sizes.append(hi - lo)
                    shas.append(hashlib.sha256(_text_of(found, lo, hi)).hexdigest())
                    lists.append(stretches(found.hashes[lo:hi]))
                flat = [np.concatenate([x[k] for x in lists]) for k in range(4)]
                kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
                names = ("anchor", "content", "at", "windows")
                items = pa.StructArray.from_arrays([pa.array(v, k) for v, k in zip(flat, kinds)], names)
                bounds = np.concatenate([[0], np.cumsum([len(x[0]) for x in lists])])
                yield pa.RecordBatch.from_arrays(
                    [ids[chunk.rows], pa.array(digests), pa.array(sizes, pa.int64()), pa.array(shas),
                     pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), items)],
                    names=["doc_id", "digest", "n_words", "kept_sha256", "stretches"],
                )

    return docs.select("doc_id", "text").mapInArrow(rows, SIGNED)


def _with_texts(docs: DataFrame, per_doc: DataFrame) -> DataFrame:
    return per_doc.join(docs.select("doc_id", "text"), "doc_id")


def _cut(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The words (as hashes) of wanted stretches: ``doc_id, digest, anchor, content, at, windows, last``.

    ``last`` is the largest doc_id that has the stretch; it is passed on.
    """
    per_doc = wanted.groupBy("doc_id").agg(
        F.collect_list(F.struct("digest", "anchor", "content", "at", "windows", "last")).alias("stretches")
    )

    def rows(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2)):
                found = arrays.words(chunk.data, chunk.offsets)
                ids = batch.column(0)[chunk.rows].to_pylist()
                lists = batch.column(1)[chunk.rows]
                out = []
                for i, (doc_id, items) in enumerate(zip(ids, lists)):
                    hashes = found.hashes[found.first[i] : found.first[i + 1]]
                    digest = _digest(hashes)
                    for s in items.as_py():
                        if s["digest"] == digest:
                            words = hashes[s["at"] : s["at"] + s["windows"] + WINDOW - 1]
                            out.append((s["anchor"], s["content"], doc_id, s["last"], words.tobytes()))
                columns = list(zip(*out)) or [()] * 5
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)],
                    names=["anchor", "content", "doc_id", "last", "words"],
                )

    return _with_texts(docs, per_doc).mapInArrow(rows, CUT)


def _runs_of(number: np.ndarray, place: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """Neighbouring windows with one owner put together: number, first and end place, owner."""
    order = np.lexsort((place, number))
    number, place, owner = number[order], place[order], owner[order]
    new = np.ones(len(number), dtype=bool)
    new[1:] = (number[1:] != number[:-1]) | (owner[1:] != owner[:-1]) | (place[1:] != place[:-1] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(number)) - 1
    return number[begin], place[begin], place[last] + 1, owner[begin]


def _search_shard(shard: pa.Table) -> pa.Table:
    """Index of a shard's stretches; each is streamed through it. Gives the runs of windows by smallest owner."""
    shard = shard.combine_chunks()
    words = shard["words"].combine_chunks()
    sizes = np.array([len(w) // 8 for w in words.to_pylist()], dtype=np.int64)
    first = np.concatenate([[0], np.cumsum(sizes)])
    flat = np.frombuffer(b"".join(words.to_pylist()), dtype=np.uint64)
    index = Index(flat, first, shard["doc_id"].to_numpy(), WINDOW)
    found = list(index.matches(flat, first))
    number, begin, finish, owner = _runs_of(*(np.concatenate([f[k] for f in found]) for k in range(3)))
    return pa.table(
        [
            shard["anchor"].take(pa.array(number)),
            shard["content"].take(pa.array(number)),
            pa.array(begin, pa.int32()),
            pa.array(finish, pa.int32()),
            pa.array(owner, pa.int64()),
        ],
        names=["anchor", "content", "begin", "finish", "owner"],
    )


def _searched(cut: DataFrame) -> DataFrame:
    """Smallest owner of every window of every stretch, from one FM-index per shard of whole anchors."""
    total = cut.agg(F.sum(F.length("words"))).first()[0] or 0
    shards = max(1, -(-total // (8 * SHARD_WORDS)))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("anchor"), F.lit(shards)))
    return dealt.groupBy("shard").applyInArrow(_search_shard, FOUND)


def _crowded(cut: DataFrame) -> DataFrame:
    """As ``_searched``, for anchors with very many stretches: by windows that occur in two stretches."""

    def rows(batches):
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                keys = [arrays.runs(np.frombuffer(w, dtype=np.uint64), WINDOW) for w in part.column(4).to_pylist()]
                sizes = np.array([len(k) for k in keys], dtype=np.int64)
                row = np.repeat(np.arange(len(part)), sizes)
                place = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                key = np.concatenate([*keys, np.zeros(0, dtype=np.uint64)]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column(k).take(pa.array(row)) for k in range(4)] + [pa.array(place, pa.int32()), pa.array(key)],
                    names=["anchor", "content", "doc_id", "last", "place", "window"],
                )

    windows = written(cut.mapInArrow(rows, "anchor long, content long, doc_id long, last long, place int, window long"), "windows")
    first = windows.groupBy("window").agg(
        F.min(F.struct("doc_id", "anchor", "content", "place")).alias("least"), F.max("last").alias("most")
    )
    first = first.where("least.doc_id < most").select("window", "least.*")
    words = F.substring(F.col("words"), F.col("place") * 8 + 1, F.lit(8 * WINDOW))
    alone = first.join(cut.select("anchor", "content", "words"), ["anchor", "content"])
    alone = alone.select(
        F.col("window").alias("anchor"), F.col("window").alias("content"), "doc_id", F.col("doc_id").alias("last"), words.alias("words")
    )
    owners = _searched(written(alone, "cut")).select(F.col("content").alias("window"), "owner")
    return windows.join(owners, "window").select(
        "anchor", "content", F.col("place").alias("begin"), (F.col("place") + 1).alias("finish"), "owner"
    )


def _kept(docs: DataFrame, ranges: DataFrame) -> DataFrame:
    """``doc_id, digest, text_key, n_removed, kept_sha256, kept_text`` of documents that lose words."""
    per_doc = ranges.groupBy("doc_id").agg(F.collect_set(F.struct("digest", "begin", "finish")).alias("ranges"))

    def rows(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(2)):
                found = arrays.words(chunk.data, chunk.offsets)
                ids = batch.column(0)[chunk.rows]
                digests, removed, shas, texts = [], [], [], []
                for i, items in enumerate(batch.column(1)[chunk.rows]):
                    lo, hi = int(found.first[i]), int(found.first[i + 1])
                    digest = _digest(found.hashes[lo:hi])
                    edges = np.zeros(hi - lo + 1, dtype=np.int64)
                    for r in items.as_py():
                        if r["digest"] == digest:
                            edges[r["begin"]] += 1
                            edges[r["finish"]] -= 1
                    kept = np.cumsum(edges[:-1]) == 0
                    text = _text_of(found, lo, hi, kept)
                    digests.append(digest)
                    removed.append(int(hi - lo - kept.sum()))
                    shas.append(hashlib.sha256(text).hexdigest())
                    texts.append(text.decode())
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(digests), batch.column(3)[chunk.rows], pa.array(removed, pa.int64()), pa.array(shas),
                     pa.array(texts, pa.string())],
                    names=["doc_id", "digest", "text_key", "n_removed", "kept_sha256", "kept_text"],
                )

    texts = _with_texts(docs, per_doc).withColumn("text_key", F.xxhash64("text"))
    return texts.mapInArrow(rows, KEPT)


def _changed(docs: DataFrame, base: DataFrame) -> DataFrame:
    """Documents that lose words: ``doc_id, digest, text_key, n_removed, kept_sha256, kept_text``."""
    each = base.where("doc_id is not null").select("doc_id", "digest", F.inline("stretches"))
    anchors = each.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).where("lo < hi")
    shared = written(each.join(anchors.select("anchor"), "anchor", "left_semi"), "shared")
    contents = shared.groupBy("anchor", "content").agg(
        F.min(F.struct("doc_id", "digest", "at", "windows")).alias("head"), F.max("doc_id").alias("last")
    )
    suspects = docs.join(shared.select("doc_id").distinct(), "doc_id").dropDuplicates(["doc_id", "text"])
    suspects = written(suspects, "suspects")
    cut = written(_cut(suspects, contents.select("anchor", "content", "head.*", "last")), "cut")
    many = cut.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > CROWDED)
    crowd = cut.join(many, "anchor", "left_semi")
    found = _searched(written(cut.join(many, "anchor", "left_anti"), "cut")).union(_crowded(written(crowd, "cut")))
    # A copy's windows have the smallest owner of its stretch's; its own doc_id is larger than that.
    ranges = shared.join(written(found, "found"), ["anchor", "content"]).where("owner < doc_id")
    finish = F.col("at") + F.col("finish") + (WINDOW - 1)
    return _kept(suspects, ranges.select("doc_id", "digest", (F.col("at") + F.col("begin")).alias("begin"), finish.alias("finish")))


def without_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` for every row of ``docs`` (columns ``doc_id`` and ``text``).

    NULL and empty texts have no words. Rows that share a doc_id never remove words from each other, since neither
    has the smaller one. A row without doc_id neither loses words nor takes any away. Other columns are not read.
    """
    docs = docs.select("doc_id", "text")
    base = written(signed(docs), "signed")
    changed = _changed(docs, base).select(
        "doc_id", "digest", F.col("n_removed").alias("removed"), F.col("kept_sha256").alias("kept")
    )
    out = base.select("doc_id", "digest", "n_words", "kept_sha256").join(changed.dropDuplicates(["doc_id", "digest"]), ["doc_id", "digest"], "left")
    return out.select(
        "doc_id",
        "n_words",
        F.coalesce("removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("kept", "kept_sha256").alias("kept_sha256"),
    )


def cleaned(docs: DataFrame) -> DataFrame:
    """``docs`` without the words that ``without_repeats`` removes, with all its columns.

    A text that loses words becomes its kept words joined by one space, and ``n_chars``, if there is such a column,
    their code points; other texts stay as they are. Rows that lose all their words go.
    """
    two = docs.select("doc_id", "text")
    changed = _changed(two, written(signed(two), "signed"))
    new, key, old = (unused(docs, name) for name in ("kept_text", "text_key", "old_key"))
    changed = changed.select(F.col("doc_id").alias(old), F.col("text_key").alias(key), F.col("kept_text").alias(new))
    same = (F.col("doc_id") == F.col(old)) & (F.xxhash64("text") == F.col(key))
    joined = docs.join(changed, same, "left").where(f"`{new}` is null or `{new}` <> ''")
    replaced = {"text": F.coalesce(new, "text")}
    if "n_chars" in docs.columns:
        replaced["n_chars"] = F.when(F.col(new).isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(docs.schema["n_chars"].dataType)
    return joined.select([replaced.get(c, F.col(f"`{c}`")).alias(c) for c in docs.columns])
