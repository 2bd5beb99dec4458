from __future__ import annotations

import duckdb
import pytest

from tests.llm.data import SF, path_of


@pytest.fixture(scope="session")
def given():
    """(doc_id, text) of the given small documents."""
    return dict(duckdb.sql(f"select doc_id, text from '{path_of(SF, 'documents')}'").fetchall())
