import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def odd_documents(spark):
    """Nulls everywhere, empty and long texts, repeated rows, and columns that operators use inside."""
    long_text = " ".join(f"w{i % 977}" for i in range(30_000)) + " " + "x" * 100_000
    rows = [
        (1, None, None, None, None),
        (2, "", "en", "a", 0),
        (None, "a row without an id but with quite a few words in it as it is", None, "b", 9),
        (3, "same text here twice over and over again for the test of ties", "en", None, 9),
        (4, "same text here twice over and over again for the test of ties", "en", None, 9),
        (4, "same text here twice over and over again for the test of ties", "en", None, 9),
        (5, long_text, "de", "a", 9),
        (6, " \t\n ", "fr", "", 9),
        (7, "!!! 123 ...", "fr", "", 9),
        (8, "one\n\ntwo\r\nthree été 中文", "fr", "a", 9),
        (9, "\u0301\u0308 \u20dd 12", "fr", "a", 9),  # marks without a letter
    ]
    frame = spark.createDataFrame(rows, DOCS)
    for name in ("piece", "bucket", "size", "slot", "shard", "virtual_slot", "weight", "_key", "score", "kind", "rep", "label"):
        from pyspark.sql import functions as F

        frame = frame.withColumn(name, F.lit("extra"))
    return frame
