"""Shards of nearly equal size, by the smallest largest shard (minimax) over ordered groups that stay whole.

Rows with equal texts are a group; groups are in the order of their digests, and a shard is a run of groups. The
smallest capacity with which the groups fit into the shards is found by binary search; a capacity is checked by
filling one shard after another.

Groups are too many for one place, so they are looked at in blocks (digests with the same beginning). Blocks whose
cuts could lie inside are resolved further, 16 or 256 parts at a time, until the smallest capacity is certain:
taking blocks as whole gives a capacity that suffices, taking them as divisible one that is needed. Only the blocks
that a cut can fall into are resolved, so a few thousand sums reach the driver in each of a few rounds, however many
rows there are.
"""

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dealreports.llm.shared import written

SHARDS = 24
OVERHEAD = 8  # bytes of a row besides its text
FIRST_DIGITS = 3  # of digests, in the first round: 4096 blocks
CELL_ROWS = 20_000
AFTER_ALL = "~"  # sorts after every digest


class Block(NamedTuple):
    """Groups whose digests begin alike."""

    beginning: str
    size: int
    groups: int

    @property
    def divisible(self) -> bool:
        return self.groups > 1


def fill(blocks: list[Block], capacity: int, largest: int, inside: bool) -> list[tuple[int, int]] | None:
    """Ends of shards filled one after another, as number of the block and bytes before the end.

    With ``inside`` a shard may end within a divisible block, else only between blocks. None if something does not
    fit: a group larger than the capacity, or a block where it has to stay whole.
    """
    if largest > capacity:
        return None
    out, used, done = [], 0, 0
    for number, block in enumerate(blocks):
        left = block.size
        if block.divisible and inside:
            while used + left > capacity:
                take = capacity - used
                left, done, used = left - take, done + take, 0
                out.append((number, done))
        elif block.size > capacity:
            return None
        elif used + block.size > capacity:
            out.append((number, done))
            used = 0
        used, done = used + left, done + left
    out.append((len(blocks), done))
    return out


def smallest_capacity(blocks: list[Block], shards: int, largest: int, inside: bool) -> int | None:
    """The smallest capacity with which the blocks fill at most so many shards."""

    def fits(capacity: int) -> bool:
        ends = fill(blocks, capacity, largest, inside)
        return ends is not None and len(ends) <= shards

    total = sum(b.size for b in blocks)
    low, high = max(largest, -(-total // shards)), total
    while low < high:
        middle = (low + high) // 2
        if fits(middle):
            high = middle
        else:
            low = middle + 1
    return low if fits(low) else None


def unsettled(blocks: list[Block], shards: int, low: int, high: int, largest: int) -> list[str]:
    """Divisible blocks that an end can fall into, for capacities from ``low`` to ``high``."""
    starts, at = [], 0
    for block in blocks:
        starts.append(at)
        at += block.size
    latest = [p for _, p in fill(blocks, high, largest, True)][: shards - 1]
    early, used, earliest = 0, 0, []
    for number, block in enumerate(blocks):
        if used + block.size > low:
            earliest.append(starts[number])
            used = 0
        used += block.size
    earliest += [at] * max(0, len(latest) - len(earliest))
    out = []
    for block, start in zip(blocks, starts):
        while early < len(latest) and latest[early] <= start:
            early += 1
        ends = range(early, len(latest))
        if block.divisible and any(earliest[j] < start + block.size and latest[j] > start for j in ends):
            out.append(block.beginning)
    return out


def cuts(blocks: list[Block], shards: int, capacity: int) -> list[str]:
    """Where shards 1, 2, ... begin, so that none is over the capacity and all are as near to equal as that allows.

    A shard ends where what is left can still go into the shards that are left, and nearest to an equal share.
    """
    places, at = [0], 0
    for block in blocks:
        at += block.size
        places.append(at)
    # needed[m]: the first place from which m shards can take all the rest.
    needed, at = [len(blocks)], len(blocks)
    for _ in range(shards):
        while at > 0 and places[needed[-1]] - places[at - 1] <= capacity:
            at -= 1
        needed.append(at)
    out, begin = [], 0
    for shard in range(shards - 1):
        share = places[begin] + (places[-1] - places[begin]) / (shards - shard)
        allowed = [
            i for i in range(max(begin, needed[shards - shard - 1]), len(blocks) + 1)
            if places[i] - places[begin] <= capacity
        ]
        begin = min(allowed, key=lambda i: abs(places[i] - share))
        out.append(blocks[begin].beginning if begin < len(blocks) else AFTER_ALL)
    return out


def _blocks(groups: DataFrame, digits: int) -> list[Block]:
    rows = groups.groupBy(F.substring("digest", 1, digits).alias("beginning"))
    rows = rows.agg(F.sum("size").alias("size"), F.count("*").alias("groups")).collect()
    return sorted(Block(r["beginning"], r["size"], r["groups"]) for r in rows)


def plan(groups: DataFrame, shards: int) -> list[str]:
    """Digests (or their beginnings) at which the shards after the first begin. ``groups`` has ``digest, size``."""
    blocks = _blocks(groups, FIRST_DIGITS)
    if not blocks:
        return [AFTER_ALL] * (shards - 1)
    largest = groups.agg(F.max("size")).first()[0]
    while True:
        needed = smallest_capacity(blocks, shards, largest, inside=True)
        enough = smallest_capacity(blocks, shards, largest, inside=False)
        if needed == enough:
            return cuts(blocks, shards, needed)
        high = sum(b.size for b in blocks) if enough is None else enough
        resolved = set(unsettled(blocks, shards, needed, high, largest))
        more = 2 if len(resolved) <= 32 else 1
        blocks = [b for b in blocks if b.beginning not in resolved]
        for digits in sorted({len(beginning) for beginning in resolved}):
            inside = F.substring("digest", 1, digits).isin([b for b in resolved if len(b) == digits])
            blocks += _blocks(groups.where(inside), digits + more)
        blocks.sort()


def sharded(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs`` (``doc_id``, ``text``).

    ``size`` is the text's UTF-8 bytes and 8 more. Rows with equal texts share a shard; NULL texts are equal to one
    another, have size 8 and no crc32. Sizes of shards are as near to equal as whole groups allow and the largest is
    as small as it can be. ``slot`` numbers the rows of a shard from 0 without gaps; equal rows get numbers in any
    order. The law is ``bytes``, so ``grown_shard`` is NULL. Other columns are not read.
    """
    rows = docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + OVERHEAD).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"),
        F.coalesce(F.sha2("text", 256), F.lit("")).alias("digest"),
    )
    rows = written(rows, "sized")
    begins = plan(written(rows.groupBy("digest").agg(F.sum("size").alias("size")), "groups"), shards)
    shard = F.size(F.filter(F.array(*map(F.lit, begins)), lambda at: at <= F.col("digest"))) if begins else F.lit(0)
    rows = rows.withColumn("shard", shard)
    counts = {r["shard"]: r["count"] for r in rows.groupBy("shard").count().collect()}  # a row for each shard
    cells = {s: max(1, -(-n // CELL_ROWS)) for s, n in counts.items()} or {0: 1}
    of_shard = F.create_map(*[F.lit(x) for pair in cells.items() for x in pair])
    rows = rows.withColumn("cell", F.pmod(F.xxhash64("doc_id", "digest"), of_shard[F.col("shard")]))
    before = Window.partitionBy("shard").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = rows.groupBy("shard", "cell").count()
    offsets = offsets.select("shard", "cell", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "digest"))
    placed = rows.withColumn("place", place).join(offsets, ["shard", "cell"])
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("before") + F.col("place") - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
