import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from texts or (doc_id, text[, lang, source]) rows, with an extra column whose name clashes."""
    def make(rows, partitions=3):
        full = []
        for i, r in enumerate(rows):
            r = (i, r) if not isinstance(r, tuple) else r
            full.append((*r, *("en", "src0")[len(r) - 2:]) if len(r) < 4 else r)
        full = [(*r, len(r[1] or ""), 7, "x") for r in full]
        return spark.createDataFrame(
            full, "doc_id long, text string, lang string, source string, n_chars long, row_key int, n string").repartition(partitions)
    return make
