import os

import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return SF_DIR


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs_of(spark):
    """A documents table from texts (ids from 0) or from (doc_id, text, source) rows, with a column of a clashing name."""
    def make(rows, extra="score"):
        rows = [(i, r, "src") if not isinstance(r, tuple) else r for i, r in enumerate(rows)]
        full = [(i, t, "en", s, None if t is None else len(t), 7.5) for i, t, s in rows]
        return spark.createDataFrame(full, f"{DOCS}, {extra} double").repartition(3)

    return make
