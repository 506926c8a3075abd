import random

import pytest
from pyspark.sql import types as T


def words(rng, n, vocabulary=("ta", "ri", "mo", "ne", "lu", "ko", "sa", "vi")):
    return " ".join("".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 4))) for _ in range(n))


def document_rows():
    """Nulls, empty and long texts, copies, near copies, repeated rows, short texts."""
    rng = random.Random(5)
    rows, base = [], words(rng, 120)
    rows.append((1, None))
    rows.append((2, ""))
    rows.append((3, " \n\t \n"))
    rows.append((4, "12345 ... !!"))
    rows.append((5, "Ärger über Öl, ½ Œuvre ça été — 東京 mo"))
    for i in range(10, 14):
        rows.append((i, base))                                   # exact copies
    rows.append((14, base.upper()))                              # a copy but for case
    for i in range(15, 20):
        w = base.split()
        w[i] = "changed"
        rows.append((i, " ".join(w)))                            # near copies
    for i in range(20, 40):
        rows.append((i, "\n".join(words(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 6)))))
    rows.append((40, words(rng, 20000)))                         # very long, one line
    rows.append((41, "x" * 50000))                               # one very long word
    rows.append((42, "mo"))
    rows.append((42, "mo"))                                      # a repeated row
    rows.append((43, "ta ri"))
    return rows


@pytest.fixture(scope="session")
def doc_rows():
    return document_rows()


@pytest.fixture(scope="session")
def docs(spark, doc_rows):
    """Documents with extra columns whose names clash with inner ones."""
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("dropped", T.StringType()),
                           T.StructField("n", T.IntegerType()), T.StructField("dkey", T.StringType()), T.StructField("start", T.LongType())])
    return spark.createDataFrame([(i, t, "aa", "d", 1, None, 7) for i, t in doc_rows], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string")


@pytest.fixture(scope="session")
def null_docs(spark):
    """Rows without any value, twice, beside one plain row."""
    return spark.createDataFrame([(None, None, None), (None, None, None), (None, "mo ta ri", None), (9, "mo ta ri ne lu", "aa")],
                                 "doc_id long, text string, lang string")
