import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from ledgerline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return build_session(master="local[4]", shuffle_partitions=8, app_name="ledgerline-tests")


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def make_docs(spark):
    """Documents of (id, text[, source]) rows, with columns whose names clash with the operators' own."""
    def make(rows, extra=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, T.StructType.fromDDL(DOCS))
        if extra:
            df = df.selectExpr("*", "1 as score", "2 as kept", "3 as hits", "4 as fp", "5 as key_id", "'x' as lines", "6 as `drop`")
        return df
    return make
