import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    """Rows (doc_id, text, source) as a documents table with further, clashing column names."""

    def make(rows, **extra):
        full = [(i, t, "en", s, None if t is None else len(t)) + tuple(extra.values()) for i, t, s in rows]
        more = "".join(f", {c} string" for c in extra)
        return spark.createDataFrame(full, DOCS + more)

    return make


@pytest.fixture(scope="session")
def by_id():
    """The rows of a result by one column; each id once."""

    def fetch(df, key="doc_id"):
        rows = df.collect()
        found = {r[key]: r for r in rows}
        assert len(found) == len(rows)
        return found

    return fetch
