import os

import pytest


@pytest.fixture(scope="session")
def spark(spark):
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    spark.sparkContext.environment["PYTHONPATH"] = root
    return spark


DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def make_docs(spark):
    """Documents from (doc_id, text, lang, source), with columns that the operators use as names of their own."""
    extra = "id string, hash int, fp string, row int, digest string, number int, component int, kept_id int, lines_removed int, score string"

    def make(rows):
        full = [(i, t, lang, site, None if t is None else len(t), *["x", 1, "f", 2, "d", 3, 4, 5, 6, "s"]) for i, t, lang, site in rows]
        return spark.createDataFrame(full, f"{DOCS}, {extra}")

    return make
