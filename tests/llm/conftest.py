import pytest
from pyspark.sql import Row
from pyspark.sql import types as T

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])
#: Columns whose names the operators use inside or return.
CLASHES = ("shard", "slot", "key", "size", "n", "rep", "node", "label", "score", "spans", "items", "n_lines", "piece",
           "component_id", "kept", "pos", "c0", "_scan", "row", "held_out", "found", "sequence_id",
           "src", "part", "target", "taken", "copies", "b", "h", "words", "start", "rest", "first", "good", "toxic", "mask")


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(pairs, lang="en"):
        return spark.createDataFrame([Row(i, t, lang, "s", None if t is None else len(t)) for i, t in pairs], DOCUMENTS)
    return make


@pytest.fixture(scope="session")
def labels_of(spark):
    def make(rows):
        return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    return make


LONG = "line of words that goes on\n" * 3 + " ".join(f"w{i % 9973}" for i in range(150_000))
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "Two words"), (6, LONG), (7, "same text here again and again"),
       (8, "same text here again and again"), (8, "same text here again and again"), (9, "déjà vu — ñandú 日本語 \U0001f600"),
       (None, "a row without an id\nsecond line\nthird line\nfourth"), (10, "$$$ 123 ???"), (11, "a\nb\nc\na\nb\nc\nd"),
       (12, "x\na\nb\nc")]


@pytest.fixture()
def odd(docs_of):
    return docs_of(ODD)


@pytest.fixture()
def clashing(odd):
    from pyspark.sql import functions as F

    return odd.select("*", *(F.lit(f"extra {c}").alias(c) for c in CLASHES))


@pytest.fixture()
def no_docs(docs_of):
    return docs_of([])
