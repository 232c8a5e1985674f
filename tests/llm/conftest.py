import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from sitelens.session import get_session  # noqa: E402

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = get_session(app="sitelens-llm-tests", master="local[*]", shuffle_partitions=4)
    s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))
    return s


@pytest.fixture(scope="session")
def make(spark):
    """Rows (doc_id, text[, source]) as a documents table with clashing extra columns."""
    def table(rows):
        rows = [(*r, "src")[:3] for r in rows]
        df = spark.createDataFrame([(k, t, "en", s, len(t or "")) for k, t, s in rows], DOCS)
        from pyspark.sql import functions as F
        return df.withColumns({c: F.lit(7) for c in ("size", "key", "spans", "n_tokens", "score", "cls", "digest", "token", "row", "range")})

    return table


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "same text as another one here"), (6, "same text as another one here"),
       (6, "same text as another one here"), (None, "no key at all in this row"), (7, "日本語 é ß ½ 🙂"), (8, "x" * 200_000),
       (9, "word " * 50_000)]


@pytest.fixture(scope="session")
def odd():
    return ODD
