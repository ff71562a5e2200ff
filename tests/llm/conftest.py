import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from parcel.session import get_session  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, h1 string, key string, words int, bucket string, bitmap int, n_hit int, node string"


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[*]", **{"spark.sql.shuffle.partitions": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents with extra columns whose names clash with inner ones."""

    def make(rows):
        full = [(i, t, lang, src, None if t is None else len(t), "x", "y", 1, "z", 0, 0, "n") for i, t, lang, src in rows]
        return spark.createDataFrame(full, DOCS)

    return make
