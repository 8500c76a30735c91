from __future__ import annotations

from pathlib import Path

import pytest

SF = Path("/root/testdata")


@pytest.fixture(scope="session")
def docs(spark):
    """A small ``documents`` with extra columns named like results."""

    def make(rows):
        table = [(i, t, "en", "s", 0, "x", -1) for i, t in rows]
        return spark.createDataFrame(table, "doc_id long, text string, lang string, source string, n_chars long, kept string, keep_id long")

    return make
