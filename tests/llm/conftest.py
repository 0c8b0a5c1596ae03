import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"

LONG = "the quick brown fox jumps over the lazy dog and runs away from here " * 4000

#: (doc_id, text): nulls, empty and blank texts, ties, repeated rows, a very long text.
ODD = [(0, None), (1, ""), (2, " \t\n\x0b "), (3, "one two three"), (4, "ONE two three"), (5, LONG),
       (6, "é " * 30 + "😀 <|endoftext|> <s> ▁ x\x00y"), (7, "a b c d e f g h i j k l m n o p"),
       (8, "z a b c d e f g h i j k l m n o p"), (8, "z a b c d e f g h i j k l m n o p"), (None, "a b c"), (9, "one two three")]


@pytest.fixture(scope="session")
def rows():
    return [(r["doc_id"], r["text"]) for r in pq.read_table(f"{SF}/documents.parquet").to_pylist()]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd rows with extra columns whose names the operators use inside."""
    df = spark.createDataFrame(ODD, "doc_id long, text string")
    for c in ("k", "t", "n", "n_words", "words", "starts", "shard", "chunk", "held", "comp", "rep", "key", "y"):
        df = df.withColumn(c, F.lit(None).cast("string"))
    return df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id long, text string")
