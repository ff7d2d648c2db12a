"""The corpus pipeline: five stages over ``documents``, each made of one operator of ``dealreports.llm``.

Every stage takes what the one before it kept and returns the rows it keeps with the columns of ``documents``; the
last returns the kept documents as tokens. Rows stay rows: a doc_id that is given twice is judged twice.
"""

from pyspark.sql import functions as F

from dealreports.llm import decontamination, languages, near_duplicates, pieces, substrings
from dealreports.llm.queries import PIECES, table
from dealreports.llm.shared import unused, written
from dealreports.llm.shipping import ship


def known_language(spark, docs, sf_dir):
    """Drops documents without any text in a language: those without a letter (``und``).

    Languages are learned from all rows that have one. A mixture is kept, whatever its languages.
    """
    ship(spark)
    model = languages.learn(docs.select("text", "lang"))
    found = unused(docs, "found")
    judged = languages.predicted(docs, model, found)
    return judged.where(F.col(found)["lang_pred"] != languages.UNKNOWN).select(docs.columns)


def one_of_each(spark, docs, sf_dir):
    """Keeps the document with the smallest doc_id of each group of near duplicates.

    Rows are judged by their texts, whether they share a doc_id or have none.
    """
    ship(spark)
    return near_duplicates.one_of_each(docs)


def without_repeated_passages(spark, docs, sf_dir):
    """Takes out passages that an earlier document has, and documents of which nothing is left.

    A text that loses words becomes its kept words joined by one space, and ``n_chars`` their code points.
    """
    ship(spark)
    return substrings.cleaned(docs)


def without_benchmarks(spark, docs, sf_dir):
    """Drops documents that hold half of a benchmark item or more."""
    ship(spark)
    return decontamination.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def as_tokens(spark, docs, sf_dir):
    """The best segmentations of every document: of the first its score, ids and their number, and whether decoding
    gives the text back; ``others`` are the next best with score and ids, best first."""
    ship(spark)
    encoded = pieces.segmented(docs.select("doc_id", "text", "lang", "source"), PIECES, decoded_into="decoded")
    best, others = F.col("segmentations")[0], F.slice("segmentations", 2, pieces.N_BEST)
    exact = F.coalesce("text", F.lit("")) == F.col("decoded")
    found = encoded.select(
        "doc_id", "lang", "source", best["score"].alias("score"), exact.alias("exact"), best["pieces"].alias("ids"), others.alias("others")
    )
    return found.select("doc_id", "lang", "source", F.size("ids").alias("n_pieces"), "score", "exact", "ids", "others")


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each),
    ("repeated_passages", without_repeated_passages),
    ("benchmarks", without_benchmarks),
    ("tokens", as_tokens),
]

# EM shares, sketches, tiling and segmentation are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after another over ``documents``; each stage's rows are written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
