import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

# columns that no operator may trip over: names that they use inside
CLASH = {"label": 3, "digest": "x", "rep": 1, "key": 2, "seed": 5, "pos": 6, "spans": "s", "t": 7, "i": 8, "rank": 9, "kept": False, "score": 0.5, "words": "w"}
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"`{k}` {'string' if isinstance(v, str) else 'boolean' if isinstance(v, bool) else 'double' if isinstance(v, float) else 'int'}" for k, v in CLASH.items())


@pytest.fixture()
def documents(spark):
    """Rows (doc_id, text[, lang, source]) as documents with clashing extra columns."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s", len(r[1]) if r[1] is not None else None, *CLASH.values()) for r in rows]
        return spark.createDataFrame(full, DOCS)
    return make


@pytest.fixture()
def labels(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
    return make


@pytest.fixture(scope="session")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path
