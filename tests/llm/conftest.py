import pytest

from tests.conftest import SF001, spark  # noqa: F401

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def docs(spark):  # noqa: F811
    """A documents table from (id, text) or (id, text, source) rows, with columns
    whose names operators use inside."""
    def make(rows, source="s"):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else source, 0, 1, "x", 5) for r in rows]
        return spark.createDataFrame(full, DOC + ", cls long, n string, size int")
    return make


@pytest.fixture(scope="session")
def sf001(spark):  # noqa: F811
    def read(name):
        return spark.read.parquet(f"{SF001}/{name}.parquet")
    return read
