from __future__ import annotations

import pytest
from pyspark.sql import types as T

from actiontally.llm import queries

LONG = "long words of many kinds " * 8000

#: Null id and text, empty and blank texts, a repeated row, an id with two texts, a long text.
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog. It's fine!", "x", 7), (2, None, "x", 1), (3, "", "y", 0), (4, " \n\t ", "y", 2),
    (5, "naïve café — 漢字 “quoted” ＡＢＣ", "z", 3), (1, "The quick brown fox jumps over the lazy dog. It's fine!", "x", 7),
    (6, "same id one " * 20, "a", 5), (6, "same id two " * 20, "b", 5), (None, "no id here at all", "n", 9), (None, None, None, None), (7, LONG, "l", 1),
]


@pytest.fixture()
def odd_docs(spark):
    """Rows with every odd case, and columns named like the operators' own."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("kept", T.StringType()), T.StructField("n_words", T.LongType())])
    wide = spark.createDataFrame(ROWS, schema)
    for name in ("spans", "score", "c0", "class", "set", "token", "key", "found", "blob", "part", "start"):
        wide = wide.selectExpr("*", f"'own' as `{name}`")
    return wide


@pytest.fixture()
def no_docs(odd_docs):
    return odd_docs.filter("false")


@pytest.fixture()
def tables(spark, scratch):
    """Writes small tables as the queries read them."""
    def write(docs, labels=(), benchmark=()):
        kinds = {"documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
                 "labels": "doc_id bigint, quality int, toxic int", "benchmark": "item_id bigint, text string"}
        for name, rows in (("documents", docs), ("labels", labels), ("benchmark", benchmark)):
            spark.createDataFrame(list(rows), kinds[name]).coalesce(2).write.mode("overwrite").parquet(f"{scratch}/{name}.parquet")
        return scratch

    return write


@pytest.fixture(scope="session")
def vocabulary():
    return queries.word_vocabulary()
