import pytest

from barlake.llm.common import ship_package

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def vocabulary():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture
def docs(spark):
    """Build a documents table from (doc_id, text) pairs."""
    ship_package(spark)

    def make(pairs, more=""):
        rows = [(i, t, "en", "src0", len(t or "")) for i, t in pairs]
        return spark.createDataFrame(rows, DOCS)

    return make
