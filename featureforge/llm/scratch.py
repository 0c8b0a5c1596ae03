"""Intermediate tables of the corpus operators, written under the shared
checkpoint folder (``spark.checkpoint.dir``), so that a lost executor loses
nothing that was already computed."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from featureforge.session import checkpoint_dir


class Scratch:
    """A fresh folder for the tables of one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df`` written as Parquet and read back."""
        path = f"{self.base}/{name}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, text: str) -> int:
    """Total UTF-8 bytes of a column (one scan of that column)."""
    from pyspark.sql import functions as F
    return df.agg(F.coalesce(F.sum(F.octet_length(F.col(text))), F.lit(0)).alias("b")).first()["b"]
