"""Helpers of these tests."""

import os

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, `_row` string, `Text_` string"


def documents(spark, texts, start=0):
    """Rows with the columns of documents and two more whose names clash with those the operators use."""
    rows = [(start + i, t, "en", None, None, "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def read(spark, name, sf_dir=SF):
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
