import pytest

from starloom.llm import words

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Documents of ``(doc_id, text)`` pairs, with all columns of the table."""

    def make(pairs):
        return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in pairs], DOCUMENT)

    return make


@pytest.fixture
def odd_columns():
    """Adds columns whose names clash with those that operators make."""
    from pyspark.sql import functions as F

    names = ["row", "k1", "k2", "node", "n", "score", "kept", "words", "component", "bucket", "batch", "x0", "centre"]
    return lambda df: df.withColumns({c: F.lit("x") for c in names})


def split(text):
    """Words by the definition, for brute force."""
    import re

    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


assert words.split_words("a\x0bb c") == [b"a", b"b", b"c"]
