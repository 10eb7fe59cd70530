import pytest
from pyspark.sql import types as T

DOC = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])

ODD = [None, "", " \t\n", "one", "a b c d", "la la la la la la", "x  y   z", "<|endoftext|> in a text", "ß Ünder Ünder ... naïve —   end ", "1 2 3 !!", "same text of five words", "same text of five words"]


@pytest.fixture
def make_docs(spark):
    """Rows as documents, with columns of clashing names."""

    def make(rows):
        full = [(*r, *[None] * (5 - len(r))) for r in rows]
        from pyspark.sql import functions as F

        df = spark.createDataFrame(full, DOC)
        return df.withColumn("score", F.lit("x")).withColumn("weight", F.lit(1)).withColumn("n", F.lit("n")).withColumn("w", F.lit(2))

    return make


@pytest.fixture
def odd_docs(make_docs):
    long = " ".join(f"word{i % 977} of" for i in range(20_000))
    rows = [(i, t, "en" if i % 2 else "fr", f"s{i % 3}") for i, t in enumerate([*ODD, long])]
    return make_docs([*rows, (None, "no id here at all", None, None), (3, "one", "en", "s0")])
