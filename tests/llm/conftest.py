import pytest
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def shipped(spark):
    from shelfcast.llm.common import small_batches
    from shelfcast.session import ship_package

    ship_package(spark)
    small_batches(spark)
    return spark


@pytest.fixture(scope="session")
def frame(shipped):
    """A documents table from (doc_id, text) pairs, with clashing extra columns."""

    def make(rows, clash=True):
        df = shipped.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOCS)
        if clash:
            for name in ("n", "score", "row", "bucket", "blob", "cid", "_doc", "_spans", "length", "piece", "kept", "spans"):
                df = df.withColumn(name, F.lit("x"))
        return df

    return make


ODD_TEXTS = [None, "", " ", "\n\n", "a", "word " * 3000, "x" * 5000, "Ünïcode ß 日本語 🙂 é", "<|endoftext|> a'll 12!", "\x1cctrl\x85 nel ls"]
