"""Which rule judges a URL, by a sort-merge range join of rules and URLs.

A rule has a host and the beginning of a path. It fits its host and all subdomains. The canonical key of a host and a
path is the host's labels in reverse order, ``#`` (which neither can contain) and the path: ``com.example#/en/``. A
rule's key is then the beginning of the keys it fits, and all keys with one beginning form an interval. Since a rule
fits subdomains, a URL is looked up with each of its host's endings that has no more labels than a rule's host.

Rules' intervals lie inside one another or apart. Starts and ends of rules and the keys of URLs are put into one
order; a start puts its rule on the stack, an end brings back the rule around it, and a URL's key finds the innermost
rule on top. The top is carried along by a window (the last start or end before a key), so no rows of different
buckets depend on each other. Buckets are ranges of keys; a range with many URLs has several buckets, each with all
the range's starts and ends, and with the rule that is open where the range begins.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUCKET_ROWS = 20_000  # URL keys in a bucket
RANGE_EVENTS = 1000  # starts and ends of rules in a range of keys, or more where that would make many ranges
MOST_RANGES = 1000
LAST = "\U0010ffff"  # after every character that can follow

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A to Z in lower case) and path of a URL; both empty if it is NULL or has no ``://``."""
    text = F.coalesce(url, F.lit(""))
    after = F.when(F.contains(text, F.lit("://")), F.substring(text, F.locate("://", text) + 3, F.length(text)))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(after, F.length(host) + 1, F.length(after)), r"^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def key_of(labels: Column, path: Column) -> Column:
    """The canonical key; ``labels`` are the host's, in reverse order."""
    return F.concat(F.array_join(labels, "."), F.lit("#"), path)


def reversed_labels(host: Column) -> Column:
    return F.reverse(F.split(host, r"\."))


def _beginnings(key: Column) -> Column:
    """All proper beginnings of a key that are keys themselves: those that go past the ``#``."""
    sizes = F.sequence(F.locate("#", key), F.length(key) - 1)
    return F.when(F.locate("#", key) < F.length(key), F.transform(sizes, lambda n: F.substring(key, F.lit(1), n)))


def _around(keys: DataFrame, rules: DataFrame) -> DataFrame:
    """``key`` and the innermost rule (``around``) whose key is a proper beginning of it; NULL if there is none."""
    parts = keys.select("key", F.explode_outer(_beginnings(F.col("key"))).alias("part"))
    found = parts.join(rules.select(F.col("key").alias("part"), "rule"), "part")
    inner = found.groupBy("key").agg(F.max_by("rule", F.length("part")).alias("around"))
    return keys.join(inner, "key", "left").select(*keys.columns, "around")


def judged(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages`` (``page_id``, ``url``).

    ``rules`` has ``host``, ``path`` and ``verdict``. Of the rules that fit, the longest (host and path) wins, of
    equally long ones that with the longer host. ``rule`` is its host and path in one, or NULL, and ``verdict`` is its
    verdict or ``default``. Rules that are given twice count once, with the verdict that sorts last (``block`` before
    ``allow``); rules with a NULL in host or path are left out. Repeated pages give repeated rows. Other columns are
    not read.
    """
    given = rules.where("host is not null and path is not null").select(
        F.translate("host", _UPPER, _LOWER).alias("host"), "path", "verdict"
    )
    given = given.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    given = given.select(
        key_of(reversed_labels(F.col("host")), F.col("path")).alias("key"),
        F.struct(
            F.length(F.concat("host", "path")).alias("size"),
            F.length("host").alias("host_size"),
            F.concat("host", "path").alias("rule"),
            "verdict",
        ).alias("rule"),
    )
    host, path = host_and_path(F.col("url"))
    urls = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    labels = reversed_labels(F.col("host"))
    most = _most_labels(given)
    probes = urls.withColumn("depth", F.explode(F.sequence(F.lit(1), F.least(F.size(labels), F.lit(most)))))
    probes = probes.withColumn("key", key_of(F.slice(labels, F.lit(1), F.col("depth")), F.col("path")))

    cuts = _cuts(given)
    range_of = _range_of(cuts)
    probes = probes.withColumn("range", range_of(F.col("key")))
    rows = probes.groupBy("range").count().collect()  # at most so many rows as there are ranges
    buckets = {r["range"]: max(1, -(-r["count"] // BUCKET_ROWS)) for r in rows} or {0: 1}
    parts = F.create_map(*[F.lit(x) for pair in buckets.items() for x in pair])
    salt = F.pmod(F.xxhash64("page_id", "url"), parts[F.col("range")])
    probes = probes.select("page_id", "url", "host", "path", "depth", "key", "range", salt.alias("salt"))

    events = _events(given, cuts, range_of).where(F.col("range").isin(list(buckets)))
    events = events.withColumn("salt", F.explode(F.sequence(F.lit(0), parts[F.col("range")] - 1)))
    nothing = {c: F.lit(None).cast(t) for c, t in probes.dtypes if c not in ("key", "range", "salt")}
    both = events.withColumns(nothing).unionByName(
        probes.withColumns({"kind": F.lit(1), "top": F.lit(None).cast(events.schema["top"].dataType)})
    )
    order = Window.partitionBy("range", F.col("salt").cast("long")).orderBy("key", "kind", F.length("top.rule.rule"))
    swept = both.withColumn("top", F.last("top", ignorenulls=True).over(order)).where("kind = 1")
    each = swept.groupBy("page_id", "url", "host", "path").agg(
        F.max("top.rule").alias("rule"), F.count_if(F.col("depth") == 1).alias("copies")
    )
    repeated = each.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select(
        "page_id", "host", "path", F.col("rule.rule").alias("rule"), F.coalesce("rule.verdict", F.lit(default)).alias("verdict")
    )


def _most_labels(rules: DataFrame) -> int:
    """Labels of the rules' longest host, 1 without rules: every URL has one probe at least."""
    hosts = F.substring_index("key", "#", 1)
    return rules.agg(F.max(F.size(F.split(hosts, r"\.")))).first()[0] or 1


def _cuts(rules: DataFrame) -> list[str]:
    """Keys of about every ``RANGE_EVENTS``-th start or end, in order; at most about ``MOST_RANGES`` of them."""
    events = 2 * rules.count()
    step = max(RANGE_EVENTS, -(-events // MOST_RANGES)) // 2
    if events <= RANGE_EVENTS:
        return []
    chosen = rules.where(F.pmod(F.xxhash64("key"), F.lit(step)) == 0).select("key")
    return sorted((r[0] for r in chosen.collect()), key=str.encode)


def _range_of(cuts: list[str]):
    if not cuts:
        return lambda key: F.lit(0)
    known = F.array(*map(F.lit, cuts))
    return lambda key: F.size(F.filter(known, lambda cut: cut <= key))


def _events(rules: DataFrame, cuts: list[str], range_of) -> DataFrame:
    """``key, kind, top, range``: starts (kind 0), ends (2) and the rule that is open where a range begins (-1).

    ``top`` is a structure, so that a stack without a rule differs from a row that is no event.
    """
    inside = _around(rules, rules)
    starts = inside.select("key", F.lit(0).alias("kind"), F.struct("rule").alias("top"))
    ends = inside.select(F.concat("key", F.lit(LAST)).alias("key"), F.lit(2).alias("kind"), F.struct(F.col("around").alias("rule")).alias("top"))
    events = starts.union(ends)
    if cuts:
        begins = rules.sparkSession.range(1).select(F.explode(F.array(*map(F.lit, cuts))).alias("key"))
        begins = _around(begins, rules).select("key", F.lit(-1).alias("kind"), F.struct(F.col("around").alias("rule")).alias("top"))
        events = events.union(begins)
    return events.withColumn("range", range_of(F.col("key")))
