import pytest

LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(40_000))


@pytest.fixture
def texts(spark):
    """A documents table of the given (doc_id, text), with columns that clash."""

    def make(rows):
        rows = [(i, t, "en", "src0", len(t or ""), 1, "x", 2.0) for i, t in rows]
        return spark.createDataFrame(
            rows,
            "doc_id long, text string, lang string, source string, n_chars long, "
            "size long, owner string, rep double",
        )

    return make
