import pytest

IDS = "doc_id long, text string, lang string, source string, n_chars long, score int, rk string, size int, part int, at string, node int"


@pytest.fixture(scope="session")
def make(spark):
    """Documents of (doc_id, text, lang, source), with further columns whose names the operators use inside."""

    def build(rows):
        full = [(*(list(r) + [None] * 4)[:4], None if (len(r) < 2 or r[1] is None) else len(r[1]), 1, "x", 2, 3, "y", 4) for r in rows]
        return spark.createDataFrame(full, IDS)

    return build
