import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from parceltide.session import prepare  # noqa: E402


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


@pytest.fixture
def documents(llm):
    """Build a documents table with an extra, clashing column."""

    def build(rows):
        full = [(i, t, "en", s, None if t is None else len(t), 1) for i, t, s in ((*r, "a")[:3] for r in rows)]
        return llm.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, id int")

    return build
