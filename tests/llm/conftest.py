import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

LONG = " ".join(f"w{i * i % 977}" for i in range(4000))
BASE = " ".join(f"term{i * 7 % 101} of{i}" for i in range(60))
NEAR = BASE.replace("term7 of1 ", "changed of1 ")

# nulls in any column, empty and blank texts, a very long one, copies, repeated rows and ids
ODD_ROWS = [
    (1, BASE, "en", "src0", 10),
    (2, BASE, "en", "src0", 10),
    (2, BASE, "en", "src0", 10),
    (3, NEAR, None, None, None),
    (None, BASE, "en", None, 3),
    (None, None, None, None, None),
    (4, None, "en", "src1", 0),
    (5, "", "en", "src1", 0),
    (6, " \n\t ", "de", "src1", 3),
    (7, LONG, "en", "src2", 5),
    (8, "one word", "fr", "src2", 8),
    (9, "é ▁ 日本 \U0001f600 it's  x", "fr", "src2", 8),
]


@pytest.fixture(scope="session")
def documents(spark):
    def build(rows):
        return spark.createDataFrame(rows, DOCUMENTS)

    return build


@pytest.fixture(scope="session")
def odd(documents):
    return documents(ODD_ROWS).repartition(3)
