from __future__ import annotations

import pytest

from quotalake.llm.common import ship_code

#: Extra columns whose names clash with columns that the operators compute.
EXTRA = ("lang", "score", "kept", "n_words", "line", "row", "part", "sig", "key", "fingerprint", "size", "shard")
SCHEMA = "doc_id long, text string, " + ", ".join(f"{c} string" for c in EXTRA)


@pytest.fixture(scope="session")
def docs(spark):
    """(id, text, ...) rows -> a documents frame with clashing extra columns, over three partitions."""
    ship_code(spark)

    def make(rows, partitions=3):
        full = [(*r, "en", *["x"] * (len(EXTRA) - 1)) for r in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(partitions) if full else spark.createDataFrame([], SCHEMA)

    return make


@pytest.fixture(scope="session")
def sf_docs(spark):
    ship_code(spark)
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


#: Nulls, blanks, repeated rows, a repeated id, ties and odd characters.
ODD = [(None, "the of and"), (None, None), (1, None), (2, ""), (3, " \n\t "), (4, "Ünï ÉCOLE école A a"), (5, "x"),
       (5, "x"), (5, "y z"), (6, "a\x00b\x0bc d"), (7, "日本語 テキスト 🙂"), (8, "%%% &&& 1.2.3.4 + -"), (9, "a" * 5000)]
