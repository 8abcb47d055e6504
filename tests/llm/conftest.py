import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))


@pytest.fixture(autouse=True)
def shipped(spark):
    from voltrail.llm.store import ship
    ship(spark)


@pytest.fixture()
def docs_of(spark):
    """Documents of (doc_id, text), with columns whose names operators use themselves."""
    def make(rows, extra=False):
        df = spark.createDataFrame(rows, "doc_id bigint, text string")
        if extra:
            from pyspark.sql import functions as F
            df = df.withColumns({c: F.lit("x") for c in ("row", "kept", "found", "stats", "hits", "spans", "token_ids", "block", "id", "tag", "fp", "root", "class", "start", "n", "item", "again")}).withColumn("n_chars", F.char_length("text").cast("bigint"))
        return df
    return make


#: Null, empty, white space only, repeated rows, a very long text and one without white space.
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (5, "a b c d e f " * 4000), (6, "x" * 30000), (7, "é 中 😀 ñ z"), (None, "no id here at all"), (8, "one two three four five")]
