from __future__ import annotations

import pytest

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    """documents from (doc_id, text) or (doc_id, text, lang)."""
    def make(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None) for r in rows]
        return spark.createDataFrame(full, DOC)
    return make


@pytest.fixture()
def clash(spark):
    """The same documents with extra columns whose names operators use inside."""
    from pyspark.sql import functions as F

    def make(df):
        for name in ("n", "h", "key", "node", "score", "digest", "norm", "rank", "keep_id"):
            df = df.withColumn(name, F.lit("x"))
        return df
    return make
