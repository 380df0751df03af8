from __future__ import annotations

import pytest
from llm_helpers import SCHEMA


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table of the given texts, with ids from 0 on, or of (id, text) pairs."""

    def make(*texts):
        pairs = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", f"src{(i or 0) % 3}", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA)

    return make
