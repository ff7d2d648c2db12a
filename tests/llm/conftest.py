import pytest

from dealreports.llm.shipping import ship


@pytest.fixture(scope="session", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, or from (doc_id, text, lang)."""

    def make(rows, lang="en"):
        rows = [(*r, lang) if len(r) == 2 else r for r in rows]
        rows = [(i, t, g, "s", None if t is None else len(t)) for i, t, g in rows]
        return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")

    return make


# Columns with the names that operators use inside, and some that differ by case only.
CLASHING = {
    name: "'x'"
    for name in (
        "class component component_id digest kept kept_text text_key matches part extra n_shingles value sketch shard cell "
        "place before key range salt rule verdict host path predicted_language segmentations score ids decoded"
    ).split()
}


@pytest.fixture
def clashing():
    return lambda df: df.selectExpr(*df.columns, *(f"{v} AS `{k}`" for k, v in CLASHING.items() if k not in df.columns))
