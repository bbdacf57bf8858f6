import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)
# Python workers find the library from any working folder.
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, os.environ.get("PYTHONPATH", "")]))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


ODD = [
    (1, "short"), (2, None), (3, ""), (4, "short"), (4, "short"), (None, "no id at all, twice"), (None, "no id at all, twice"),
    (5, "word " * 30000), (6, "z" * 50000), (7, "   \n\t \n"), (8, "Ünïcödé — 中文 текст 🙂 it's we'll 'S"),
]


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows and columns whose names an operator may use itself."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(ODD, "doc_id long, text string")
    extra = ("id", "hash", "z", "block", "shard", "simhash", "component_id", "n_words", "ids", "decoded", "secret_spans", "fingerprint", "n_email", "gram", "n")
    return df.select("*", *[F.lit("x").alias(c) for c in extra])


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
