"""Mixing sources to target weights: every source gives its exact budget of words, whole epochs first.

Each row gets a key that is random but told by its content (a digest of seed, doc_id and text). Rows are sorted by
ranges of (source, key) into parts; the sizes of the parts and the running sums inside them are distributed prefix
sums. A source whose budget is e times its size and r words more gives e epochs of all its rows and, in the order
of the keys, its first r words: the row at the cut gives part of its words. Rows alike in doc_id and text have equal
keys; their order decides which copy is cut, not what the copies give together, so runs agree.

Built-in functions only. Keys and sizes are written once, some 60 bytes a row; texts are read once and not sorted.
The written row id ends ties, so parts can be cut inside a hot source, a hot key or many copies of one row. Every
part of a source begins with a row that carries what the earlier parts hold: the window needs no join.

Defined results: a NULL text has no words (size 0, taken 0); rows without a source are a source of their own, the
last one; a source without words has target 0; an empty table gives an empty result. Other columns of the input are
not looked at, whatever their names.
"""

from fractions import Fraction

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dealreports.llm.shared import written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)  # by source in code point order, repeating
SHARE = Fraction(3, 2)  # of all words
MOST_EPOCHS = 2
SEED = 13


def sized(docs: DataFrame, seed: int = SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, source, size, key, row`` and the columns to keep, written; ``row`` tells apart rows that are alike."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("doc_id", "text")]
    return written(
        docs.select(
            "doc_id",
            "source",
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.md5(F.concat_ws(":", F.lit(str(seed)), *parts)).alias("key"),
            F.monotonically_increasing_id().alias("row"),
            *([F.struct(*keep).alias("kept")] if keep else []),
        ),
        "sized",
    )


def weighed(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, weight``: weights repeat over the sources in code point order, NULL last.

    One row a source; they are numbered in one task, for sources are a list that people weigh.
    """
    number = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    listed = F.array(*[F.lit(w).cast("long") for w in weights])
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    return sums.withColumn("weight", F.element_at(listed, (number % len(weights) + 1).cast("int")))


def targets(sources: DataFrame, share: Fraction = SHARE, most: int = MOST_EPOCHS) -> DataFrame:
    """``source, source_size, target``: ``share`` of all words by weight, no target above ``most`` times its source.

    What a source cannot give is reshared by weight among the others until none is above its limit. Sources reach
    their limits in the order of size by weight. The words a unit of weight gets, if all sources before one in
    that order give their limits and the rest share what is left, grow up to the first source that stays free
    and fall from there on, so the largest of them holds.
    """
    everything = Window.partitionBy()
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    limit = most * F.col("source_size")
    words = F.sum("source_size").over(everything) * share.numerator / F.lit(float(share.denominator))
    left = words - F.coalesce(F.sum(limit).over(before), F.lit(0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = sources.withColumn("level", left / weight_left)
    target = F.least(limit.cast("double"), F.col("weight") * F.max("level").over(everything))
    return levels.select("source", "source_size", target.alias("target"))


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` of ``sized`` with ``source_size``, ``target`` and ``taken``, the words that the mix takes of each."""
    parted = rows.repartitionByRange("source", "key", "row").withColumn("part", F.spark_partition_id())
    parted = written(parted, "parted")
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    heads = parted.groupBy("source", "part").agg(F.sum("size").alias("size"))
    heads = heads.withColumn("size", F.coalesce(F.sum("size").over(earlier), F.lit(0)))
    heads = heads.alias("h").join(plan.alias("p"), F.expr("h.source <=> p.source")).select("h.*", "source_size", "target")
    lines = heads.withColumn("head", F.lit(0)).unionByName(parted.withColumn("head", F.lit(1)), allowMissingColumns=True)
    running = Window.partitionBy("source", "part").orderBy("head", "key", "row").rowsBetween(Window.unboundedPreceding, 0)
    lines = lines.select(
        *[c for c in lines.columns if c not in ("source_size", "target")],
        (F.sum("size").over(running) - F.col("size")).alias("before"),
        F.first("source_size").over(running).alias("source_size"),
        F.first("target").over(running).alias("target"),
    ).where("head = 1")
    budget = F.floor(F.col("target") + 0.5)
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = F.col("budget") - F.col("epochs") * F.col("source_size")
    again = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    lines = lines.withColumn("budget", budget).withColumn("epochs", epochs)
    return lines.withColumn("taken", (F.col("epochs") * F.col("size") + again).cast("long"))


def mixed(
    docs: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    share: Fraction = SHARE,
    most: int = MOST_EPOCHS,
    seed: int = SEED,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``, and a struct ``kept`` of columns to keep.

    ``docs`` has ``doc_id``, ``text`` and ``source``. ``taken`` counts words, repeats too: a row is taken
    ``taken div size`` times whole, and once more its first ``taken % size`` words.
    """
    rows = sized(docs, seed, keep)
    out = taken(rows, targets(weighed(rows, weights), share, most))
    return out.select("doc_id", "size", "source_size", "target", "taken", *(["kept"] if keep else []))


def texts(mix: DataFrame) -> DataFrame:
    """``doc_id, epoch, text``: what a mix that keeps ``text`` holds; a cut text is its first words, one space between."""
    copies = F.expr("explode(sequence(0L, (taken - 1) div greatest(size, 1L)))")
    chosen = mix.where("taken > 0").select("doc_id", "size", "taken", F.col("kept.text").alias("text"), copies.alias("epoch"))
    words = F.col("taken") - F.col("epoch") * F.col("size")
    first = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.lit(1), words.cast("int")), " ")
    return chosen.select("doc_id", "epoch", F.when(words >= F.col("size"), F.col("text")).otherwise(first).alias("text"))
