import pytest

# The names clash with columns that the operators make; all of them must be ignored.
EXTRA = ("size", "n", "key", "hash", "shard", "tokens", "items", "cell", "prefix", "full", "c0", "label", "x")


@pytest.fixture
def documents(spark):
    def make(rows):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        rows = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, *["junk"] * len(EXTRA)) for r in rows]
        return spark.createDataFrame(
            rows, "doc_id long, text string, lang string, source string, n_chars long, "
            + ", ".join(f"`{c}` string" for c in EXTRA))
    return make


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and very long texts, ties, repeated rows."""
    long = " ".join(f"w{i % 5000}" for i in range(200_000))
    return documents([(1, None), (2, ""), (3, " \n\t "), (4, "One two three"), (4, "One two three"), (5, "one two three"),
                      (6, long), (7, long + " end"), (None, "one two three"), (None, None), (8, "Ünï çode ß ЖЖ"),
                      (9, "É é"), (10, "é é")])
