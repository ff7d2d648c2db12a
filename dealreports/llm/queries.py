"""Registered queries of the operators, with their SQL counterparts where SQL can express them."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dealreports.llm import (
    alignment,
    decontamination,
    fingerprints,
    languages,
    mixing,
    negatives,
    pages,
    pieces,
    shards,
    substrings,
    tokens,
    url_rules,
)
from dealreports.llm import near_duplicates as nd
from dealreports.llm.shipping import ship

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
RANKS = "/opt/tokenizers/byte_bpe_50k.tiktoken"
BYTES = "/opt/tokenizers/byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if oracle:
            ORACLE[name] = oracle
        return query

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_languages")
def document_languages(spark, sf_dir):
    """Main language and mixture of every document, learned from three quarters of them."""
    return languages.languages_of(table(spark, sf_dir, "documents"))


@register("op2_main_text")
def main_text_of_pages(spark, sf_dir):
    """The main text of every page."""
    return pages.with_main_text(table(spark, sf_dir, "pages"))


@register("op3_fingerprints")
def document_fingerprints(spark, sf_dir):
    """Every document compared with its edited text and with the next document by fingerprint."""
    return fingerprints.compared(table(spark, sf_dir, "documents"))


@register("op4_segmentations")
def document_segmentations(spark, sf_dir):
    """The four best segmentations of every whole document, and the text that the best one decodes to, as digests."""
    return pieces.digests(table(spark, sf_dir, "documents"), PIECES)


@register("op5_shards")
def document_shards(spark, sf_dir):
    """Every document in one of 24 shards of nearly equal bytes, equal texts together."""
    return shards.sharded(table(spark, sf_dir, "documents"))


@register("op6_line_tokens")
def document_line_tokens(spark, sf_dir):
    """Tokens of every line of every document, from one encoding of the whole document."""
    return tokens.line_tokens(table(spark, sf_dir, "documents"), tokens.ranks(RANKS))


@register(
    "op7_repeated_passages",
    r"""
    WITH w AS (
      SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
    windows AS (
      SELECT doc_id, i, md5(array_to_string(words[i:i + 49], ' ')) AS content
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 48)) AS i FROM w WHERE len(words) >= 50)),
    firsts AS (SELECT content, min(doc_id) AS owner FROM windows GROUP BY content),
    gone AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place
      FROM windows JOIN firsts USING (content) WHERE owner < doc_id),
    gone_lists AS (SELECT doc_id, list(place) AS places FROM gone GROUP BY doc_id),
    kept AS (
      SELECT doc_id, len(words) AS n_words, coalesce(len(places), 0) AS n_removed,
        [x FOR x, i IN words IF places IS NULL OR NOT list_contains(places, i)] AS words
      FROM w LEFT JOIN gone_lists USING (doc_id))
    SELECT doc_id, n_words, n_removed, sha256(coalesce(array_to_string(words, ' '), '')) AS kept_sha256 FROM kept
    """,
)
def repeated_passages(spark, sf_dir):
    """Words of every document that an earlier document has in a run of 50, and what is left."""
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@register(
    "op8_url_rules",
    r"""
    WITH rest AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
      FROM pages),
    raw AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM rest),
    parts AS (
      SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path
      FROM raw),
    rules(rule_host, rule_path, verdict) AS (VALUES
      ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
      ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
    named AS (SELECT row_number() OVER () AS row_id, * FROM parts),
    fit AS (
      SELECT row_id, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
        max_by(verdict, length(rule_host || rule_path)) AS verdict
      FROM named JOIN rules
        ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
      GROUP BY row_id)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM named LEFT JOIN fit USING (row_id)
    """,
)
def url_verdicts(spark, sf_dir):
    """The rule and verdict for every page's URL."""
    names = ("host", "path", "verdict")
    rules = [F.struct(*[F.lit(v).alias(n) for n, v in zip(names, rule)]) for rule in URL_RULES]
    rules = spark.range(1).select(F.inline(F.array(*rules)))
    return url_rules.judged(table(spark, sf_dir, "pages"), rules)


@register(
    "op9_near_duplicates",
    rf"""
    WITH RECURSIVE w AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
    s AS (
      SELECT doc_id, unnest(list_distinct(CASE WHEN len(words) = 0 THEN []
        ELSE [array_to_string(words[i:i + 4], ' ') FOR i IN range(1, greatest(len(words) - 3, 2))] END)) AS shingle
      FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (
      SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y USING (shingle)
      WHERE x.doc_id <> y.doc_id GROUP BY ALL),
    links AS (
      SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * common >= 75 * (p.n + q.n - common)),
    reach(a, b) AS (
      SELECT doc_id, doc_id FROM documents UNION
      SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b),
    low AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
    FROM documents d JOIN low USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def near_duplicate_documents(spark, sf_dir):
    """Components of documents whose five-word shingles are similar by 0.75 or more, over all documents."""
    return nd.near_duplicates(table(spark, sf_dir, "documents"))


@register("op10_contaminated_documents")
def contaminated_documents(spark, sf_dir):
    """Documents that hold half of a benchmark item or more, with the item and the cover."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op11_aligned_tokens")
def aligned_tokens(spark, sf_dir):
    """Every document in two tokenizers: groups with common ends, links, and how common the links are in the corpus."""
    return alignment.aligned(table(spark, sf_dir, "documents"), BYTES, PIECES)


@register(
    "op12_hard_negatives",
    """
    WITH rows AS (
      SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
      SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
        list_dot_product(a.v, b.v)::BIGINT AS score
      FROM rows a JOIN rows b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
    positives AS (
      SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, other_id AS negative_id,
      positive_score, score AS negative_score
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND 100 * score <= 100 * positive_score
    WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id)
    QUALIFY row_number() OVER w <= 5
    """,
)
def hard_negatives(spark, sf_dir):
    """For every hundredth vector and its nearest of the same label, the nearest of other labels not above it."""
    return negatives.mined(table(spark, sf_dir, "embeddings"))


@register(
    "op13_mixed_documents",
    r"""
    WITH rows AS (
      SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5('13:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key
      FROM documents),
    sources AS (
      SELECT source, sum(size)::BIGINT AS source_size,
        [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
      FROM rows GROUP BY source),
    levels AS (
      SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER earlier, 0))
        / (sum(weight) OVER () - coalesce(sum(weight) OVER earlier, 0)) AS level
      FROM sources
      WINDOW earlier AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    targets AS (
      SELECT source, source_size, least(2.0::DOUBLE * source_size, weight * max(level) OVER ()) AS target FROM levels),
    lines AS (
      SELECT doc_id, size, source_size, target, floor(target + 0.5)::BIGINT AS budget,
        sum(size) OVER (PARTITION BY t.source ORDER BY key ROWS UNBOUNDED PRECEDING) - size AS before
      FROM rows r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source)
    SELECT doc_id, size, source_size, target,
      (CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size * size
        + greatest(0, least(size, budget % source_size - before)) END)::BIGINT AS taken
    FROM lines
    """,
)
def mixed_documents(spark, sf_dir):
    """The words that a mix of all sources by weight takes of every document."""
    return mixing.mixed(table(spark, sf_dir, "documents"))
