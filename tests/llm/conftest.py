import pytest

from tidemark.llm.storage import importable

SF = "/root/testdata/sf0.001"
DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(autouse=True)
def workers_import_the_package(spark):
    importable(spark)


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) pairs, in several partitions, with columns of clashing names."""
    def make(pairs, schema="doc_id long, text string", **more):
        df = spark.createDataFrame([(i, t, "x", "y", 1) for i, t in pairs],
                                   f"{schema}, fp string, score string, shard int")
        return df.repartition(3)
    return make
