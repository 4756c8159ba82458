"""A fixture and values that several test modules import."""

from __future__ import annotations

import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"

#: Texts that every operator must take: null, empty, white space, control
#: characters, four-byte code points, one word, a very long text.
ODD_TEXTS = [None, "", " \t\n ", "one", "a\x00b \x1c c d", "\U0001f600 éè 中文", "long word " * 30_000]


@pytest.fixture
def make_docs(spark):
    """documents rows from (doc_id, text[, lang[, source]]) tuples."""

    def make(rows, schema=DOCUMENT):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", None if r[1] is None else len(r[1])) for r in rows]
        return spark.createDataFrame(full, schema)

    return make
