from __future__ import annotations

import pytest

from tests.conftest import spark  # noqa: F401
from tests.helpers import frame

DDL = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):  # noqa: F811
    """A documents table from (doc_id, text) rows, with columns whose names clash with the operators' own."""

    def make(*rows, lang="en"):
        plain = [(i, t, lang, "s", None if t is None else len(t)) for i, t in rows]
        clash = "n_words long, kept boolean, component_id long, place long, row long, raw string, print string, shard int"
        return frame(spark, f"{DDL}, {clash}", *[(*r, 1, True, 2, 3, 4, "r", "p", 5) for r in plain])

    return make
