"""Near duplicates by bottom-k sketches from one hash function.

A text's set holds the hashes of its distinct five-word shingles. Texts with equal sets form a class, and only one
text of a class goes on. The ``POSTED`` smallest hashes of each text (all of a set of up to ``SMALL``) go into inverted
lists. Two sets with similarity 0.75 share each of the smallest hashes of their union with probability 0.75 at least,
so both miss each other in all 16 lists with probability 0.25 ** 16.

A hash that more than ``COMMON`` texts post is common. Texts that are made of much repeated passages (crowded texts:
more than a quarter of their posted hashes are common) go by their whole sets. Sizes fix how many hashes two similar
sets share at least. Either one of them is rare, and the two meet in its list, since crowded texts post all their rare
hashes. Or all of them are common; then both sets have so many common hashes, and they meet in the lists of their
``POSTED`` smallest common ones. The other texts leave common lists, for a partner shares one of their rare hashes: for
certain in a set of up to 16, whose partners have up to 21 hashes and are posted whole; in a larger set but for about
3.4e-5 of those whose shared hashes are all common (see README).

A list is worked on in rounds. In a round its first texts (those with fewest rare hashes) are pivots, and every other
text of the list that is not in a pivot's component yet is compared with them. Pivots leave the list, the others
stay. The number of pivots grows from round to round, until no list holds two components that still could have a
link. Copies fall together in the first round, so a list of n copies costs n comparisons and not n * n / 2.

Pairs pass through a filter by size and an estimate from the union of both sketches (the ``K`` smallest hashes), then
through the exact similarity of the whole sets.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from dealreports.llm import arrays
from dealreports.llm.graph import components
from dealreports.llm.shared import unused, written

WORDS = 5
SIMILAR = (75, 100)  # 100 * intersection >= 75 * union
POSTED = 16
SMALL = 21  # sets that a set of 16 hashes can be similar to; such sets are posted whole
COMMON = 16  # a hash that more texts than this post is common
K = 128
# Six standard deviations of an estimate from 128 values below 0.75; the exact similarity decides.
LEAST_ESTIMATE = 0.52
PIVOTS = 64  # times as many pivots in each round

SALTS = 16  # a component's smallest doc_id is given to so many parts of its classes

SKETCHES = "doc_id long, row_key long, n_shingles long, class string, node long, lowest array<long>, sketch binary"


def shingle_sets(data: np.ndarray, offsets: np.ndarray):
    """The sorted distinct shingle hashes of each text; fewer words than five make one shingle, none an empty set."""
    found = arrays.words(data, offsets, lower=True)
    grams = arrays.runs(found.hashes, WORDS)
    for lo, hi in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if hi - lo >= WORDS:
            yield np.unique(grams[lo : hi - WORDS + 1])
        elif hi > lo:
            yield arrays.runs(found.hashes[lo:hi], hi - lo)
        else:
            yield np.zeros(0, dtype=np.uint64)


def sketches(docs: DataFrame) -> DataFrame:
    """Size, class (a digest of the whole set), hashes to post and sketch (upper halves of hashes) of every text.

    ``node`` is half of the class as a number; ``row_key`` tells rows apart by doc_id and text.
    """

    def rows(batches):
        for batch in batches:
            ids, keys = batch.column(0), batch.column(2)
            for chunk in arrays.chunks(batch.column(1)):
                sizes, classes, of_nodes, lowest, sketched = [], [], [], [], []
                for s in shingle_sets(chunk.data, chunk.offsets):
                    sizes.append(len(s))
                    digest = xxhash.xxh3_128(s.tobytes())
                    classes.append(digest.hexdigest() if len(s) else None)
                    of_nodes.append((digest.intdigest() >> 64) - (1 << 63))
                    lowest.append((s if len(s) <= SMALL else s[:POSTED]).view(np.int64))
                    sketched.append((s[:K] >> np.uint64(32)).astype(np.uint32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [ids[chunk.rows], keys[chunk.rows], pa.array(sizes, pa.int64()), pa.array(classes, pa.string()),
                     pa.array(of_nodes, pa.int64()), pa.array(lowest, pa.list_(pa.int64())), pa.array(sketched, pa.binary())],
                    names=["doc_id", "row_key", "n_shingles", "class", "node", "lowest", "sketch"],
                )

    return docs.select("doc_id", "text", row_key()).mapInArrow(rows, SKETCHES)


def row_key() -> Column:
    """Equal for rows with equal doc_id and text."""
    return F.xxhash64("doc_id", "text").alias("row_key")


@F.pandas_udf(T.DoubleType())
def estimate(a, b):
    """Share of the smallest values of the union that both sketches hold."""
    out = np.empty(len(a))
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = np.unique(np.frombuffer(x, dtype=np.uint32)), np.unique(np.frombuffer(y, dtype=np.uint32))
        union = np.union1d(x, y)[:K]
        out[i] = len(np.intersect1d(np.intersect1d(x, y, True), union, True)) / max(1, len(union))
    return pd.Series(out)


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs whose whole sets are similar, exactly."""
    part, whole = SIMILAR
    a = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    b = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def rows(batches):
        for batch in batches:
            keep = np.zeros(len(batch), dtype=bool)
            for at in range(0, len(batch), 64):
                sides = [
                    [s for c in arrays.chunks(batch.column(k).slice(at, 64)) for s in shingle_sets(c.data, c.offsets)]
                    for k in (2, 3)
                ]
                for i, (x, y) in enumerate(zip(*sides)):
                    both = len(np.intersect1d(x, y, True))
                    keep[at + i] = whole * both >= part * (len(x) + len(y) - both)
            yield batch.select([0, 1]).filter(pa.array(keep))

    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(rows, "a long, b long")


def _sized(posted: DataFrame) -> DataFrame:
    """With ``members``, the number of texts in the list of each posted hash."""
    size = posted.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
    joined = posted.join(size, "value", "left")
    return joined.withColumn("members", F.coalesce("members", F.lit(1)))


def _whole_sets(texts: DataFrame) -> DataFrame:
    """``doc, n, value``: every shingle hash of every text."""

    def rows(batches):
        for batch in batches:
            for chunk in arrays.chunks(batch.column(1)):
                found = list(shingle_sets(chunk.data, chunk.offsets))
                sizes = np.array([len(s) for s in found], dtype=np.int64)
                ids = batch.column(0)[chunk.rows].take(pa.array(np.repeat(np.arange(len(found)), sizes)))
                values = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.repeat(sizes, sizes)), pa.array(values)], names=["doc", "n", "value"]
                )

    return texts.mapInArrow(rows, "doc long, n long, value long")


def postings(heads: DataFrame, docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The lists in which texts meet, and the texts that are in them.

    ``value, doc, n, rare, common``: list, text, size of its set, hashes of it that are not common, and for common
    lists how many common ones it has (NULL: a list of a rare hash, in which any two texts may have a link).
    """
    first = heads.select(F.col("node").alias("doc"), F.col("n_shingles").alias("n"), F.explode("lowest").alias("value"))
    first = written(_sized(first), "posted")
    met = first.where("members > 1").select(F.col("doc").alias("node")).distinct()
    of_heads = heads.join(met, "node").select("row_key", "node")
    listed = docs.select("text", row_key()).join(of_heads, "row_key").dropDuplicates(["row_key"])
    listed = written(listed.select("node", "text"), "listed")
    rare = F.count_if(F.col("members") <= COMMON)
    # A partner of a set of up to 16 shares three quarters of it, so one of so many; larger sets are judged by a share.
    enough = F.when(F.col("n") <= POSTED, F.floor(F.col("n") / 4) + 1).otherwise(F.ceil(0.75 * F.col("posted")))
    judged = first.groupBy("doc").agg(F.max("n").alias("n"), F.count("*").alias("posted"), rare.alias("rare"))
    crowded = written(judged.where(F.col("rare") < enough).select("doc"), "crowded")
    whole = _whole_sets(listed.join(crowded.withColumnRenamed("doc", "node"), "node").select("node", "text"))
    # Whole sets and what the other texts post are counted together. A hash that only then is common stays a meeting
    # place of the few texts that post it.
    posted = first.join(crowded, "doc", "left_anti").where(F.col("members") <= COMMON).select("doc", "n", "value", F.lit(False).alias("whole"))
    both = written(_sized(posted.union(whole.select("doc", "n", "value", F.lit(True)))), "whole")
    both = both.where("members > 1")
    whole = both.where("whole")
    counts = whole.groupBy("doc").agg(F.count_if(F.col("members") > COMMON).alias("common"))
    lowest = F.col("value").bitwiseXOR(F.lit(-(1 << 63)))  # in the order of unsigned numbers
    order = F.row_number().over(Window.partitionBy("doc").orderBy(lowest))
    common = whole.where(F.col("members") > COMMON).withColumn("order", order).where(F.col("order") <= POSTED)
    common = common.join(counts, "doc").select("value", "doc", "n", (F.col("n") - F.col("common")).alias("rare"), "common")
    few = both.where(~F.col("whole") & (F.col("members") > COMMON)).select("value", "doc", "n", "n", "n")
    none = F.lit(None).cast("long")
    lists = both.where(F.col("members") <= COMMON).select("value", "doc", "n", "n", none).toDF("value", "doc", "n", "rare", "common")
    return lists.union(common).union(few), listed


def _pairs(placed: DataFrame, pivots: int) -> tuple[DataFrame, DataFrame]:
    """The first texts of every list, and the pairs of them with the list's other texts that could have a link.

    A pair meets in many common lists. It is taken in the smallest in which one of the two is a pivot.
    """
    part, whole = SIMILAR
    rank = F.row_number().over(Window.partitionBy("value").orderBy("rare", "n", "doc"))
    chosen = placed.withColumn("rank", rank).where(F.col("rank") <= pivots).drop("rank", "rare")
    chosen = written(chosen, "pivots")
    is_common = F.col("common").isNotNull()

    def lists_of(texts: DataFrame, name: str) -> DataFrame:
        """Common lists of each text, at most ``POSTED``."""
        return texts.where(is_common).groupBy("doc").agg(F.collect_set("value").alias(name))

    common = placed.where(is_common).join(lists_of(placed, "mine"), "doc").select(*placed.columns, "mine")
    no_lists = F.lit(None).cast("array<long>")
    texts = placed.where(~is_common).withColumn("mine", no_lists).union(common)
    leads = chosen.where(is_common).join(lists_of(chosen, "leads"), "doc").select(*chosen.columns, "leads")
    leads = chosen.where(~is_common).withColumn("leads", no_lists).union(leads)
    leads = leads.toDF("value", "p", "pn", "pc", "home", "leads")
    both, least = F.col("n") + F.col("pn"), F.least("n", "pn")
    # Similar sets share part / (part + whole) of both sizes together, and cannot share more than the smaller has.
    met = texts.join(leads, "value").where(
        (F.col("component") != F.col("home"))
        & ((part + whole) * least >= part * both)
        & (
            F.col("mine").isNull()
            | ((part + whole) * F.least("common", "pc") >= part * both)
            & (F.array_min(F.array_intersect("mine", "leads")) == F.col("value"))
        )
    )
    return chosen, met.select(F.least("doc", "p").alias("a"), F.greatest("doc", "p").alias("b")).distinct()


def _with_links(member: DataFrame, links: DataFrame) -> DataFrame:
    """``node, component`` with more links: only the components that they join are looked at again."""
    if links.isEmpty():
        return member
    ends = links
    for end in ("a", "b"):
        of_end = member.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}"))
        ends = ends.join(of_end, end, "left").withColumn(end, F.coalesce(f"of_{end}", end)).drop(f"of_{end}")
    moved = written(components(ends.where("a <> b").distinct()), "moved")
    new = links.select(F.col("a").alias("node")).union(links.select("b")).distinct().join(member, "node", "left_anti")
    everyone = member.union(new.select("node", F.col("node").alias("component")))
    to = moved.select(F.col("node").alias("component"), F.col("component").alias("low"))
    everyone = everyone.join(to, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
    return written(everyone, "member")


def grouped(docs: DataFrame, heads: DataFrame) -> DataFrame:
    """``node, component`` of class representatives that have a link."""
    part, whole = SIMILAR
    lists, listed = postings(heads, docs)
    placed, pivots = written(lists.withColumn("component", F.col("doc")), "lists"), 1
    sketch = heads.select("node", "sketch")
    member = None
    while True:
        chosen, pairs = _pairs(placed, pivots)
        near = (
            pairs.join(sketch.toDF("a", "sketch_a"), "a").join(sketch.toDF("b", "sketch_b"), "b")
            .where(estimate("sketch_a", "sketch_b") >= LEAST_ESTIMATE).select("a", "b")
        )
        near = written(near, "near")
        if member is None:
            member = written(components(verified(near, listed)), "member")
        elif not near.isEmpty():
            member = _with_links(member, written(verified(near, listed), "links"))
        linked = member.select(F.col("node").alias("doc"), F.col("component").alias("linked"))
        rest = placed.drop("component").join(chosen.select("value", "doc"), ["value", "doc"], "left_anti")
        rest = rest.join(linked, "doc", "left").select(*lists.columns, F.coalesce("linked", "doc").alias("component"))
        # Texts leave a common list that could have a link only with a smaller set than any of the list.
        ends = rest.groupBy("value").agg(
            F.min("component").alias("low"), F.max("component").alias("high"), F.min("n").alias("least_n"),
            F.max("common").alias("most_common"),
        )
        able = F.col("common").isNull() | (
            (part + whole) * F.least("common", "most_common") >= part * (F.col("n") + F.col("least_n"))
        )
        placed = written(rest.join(ends.where("low < high"), "value").where(able).select(placed.columns), "lists")
        if placed.isEmpty():
            return member
        pivots *= PIVOTS


def _judged(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Sketches of all rows, and ``class, row_key, component_id, head`` of all classes.

    ``row_key`` is of a class's row with the smallest doc_id, ``component_id`` the smallest doc_id of the class's
    component (NULL if it has none), ``head`` whether the class is the one of its component that has it.
    """
    sketched = written(sketches(docs), "sketches")
    by_id = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row_key", "node", "n_shingles", "lowest", "sketch")
    heads = sketched.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(by_id).alias("head"))
    heads = written(heads.select("class", "head.*"), "heads")
    member = grouped(docs, heads)
    ids = heads.select("class", "row_key", "node", "no_id", "doc_id")
    linked = written(ids.join(member, "node"), "linked")
    least = linked.groupBy("component").agg(F.min(F.struct("no_id", "doc_id", "node")).alias("least"))
    salts = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long")))
    salted = linked.withColumn("salt", F.pmod(F.xxhash64("class"), F.lit(SALTS)))
    linked = salted.join(least.select("component", "least", salts.alias("salt")), ["component", "salt"])
    linked = linked.select(
        "class", "row_key", F.col("least.doc_id").alias("component_id"), (F.col("least.node") == F.col("node")).alias("head")
    )
    alone = ids.join(member, "node", "left_anti")
    return sketched, linked.union(alone.select("class", "row_key", "doc_id", F.lit(True)))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs`` (columns ``doc_id`` and ``text``).

    NULL and empty texts have an empty set and are linked with nothing. Each row is judged by its own text, so rows
    that repeat a doc_id with the same text give equal rows, and with unlike texts are in components of their own.
    Other columns are not read. A row without doc_id takes the smallest doc_id of its component, and is kept if it has
    none.
    """
    docs = docs.select("doc_id", "text")
    sketched, classes = _judged(docs)
    out = sketched.select("doc_id", "n_shingles", "class").join(classes.withColumn("found", F.lit(True)), "class", "left")
    component = F.when(F.col("found"), F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.select("doc_id", "n_shingles", component.alias("component_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component with all its columns: of the smallest doc_id. Rows without any word are kept.

    Those of them that have a doc_id are one row if that and their texts are equal.
    """
    key = unused(docs, "row_key")
    sketched, classes = _judged(docs.select("doc_id", "text"))
    empty = sketched.where(F.col("class").isNull() & F.col("doc_id").isNotNull()).select("row_key")
    heads = classes.where("head").select("row_key").union(empty).distinct().withColumnRenamed("row_key", key)
    kept = docs.withColumn(key, row_key()).join(heads, key, "left_semi").dropDuplicates(["doc_id", "text"])
    has_word = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    return kept.select(docs.columns).union(docs.where(F.col("doc_id").isNull() & ~has_word))
