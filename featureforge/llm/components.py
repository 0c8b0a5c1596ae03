"""Connected components of links as Spark joins (smallest label spreads, with
pointer jumping); every round is written to the shared scratch folder."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from featureforge.llm.scratch import Scratch


def components(links: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(k, comp) for every id in ``links`` (a, b): comp is the smallest id
    reachable."""
    both = scratch.table(links.select("a", "b").union(links.select("b", "a")).distinct(), f"{name}-edges")
    labels = both.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("low")).select(
        "k", F.least("k", "low").alias("comp"))
    labels = scratch.table(labels, f"{name}-0")
    rounds = 0
    while True:
        rounds += 1
        near = (both.join(labels.select(F.col("k").alias("b"), "comp"), "b")
                .groupBy(F.col("a").alias("k")).agg(F.min("comp").alias("low")))
        lower = labels.join(near, "k").select("k", F.least("comp", "low").alias("comp"), F.col("comp").alias("old"))
        jump = labels.select(F.col("k").alias("comp"), F.col("comp").alias("next"))
        new = scratch.table(lower.join(jump, "comp", "left").select(
            "k", F.least("comp", F.coalesce("next", "comp")).alias("comp"), "old"), f"{name}-{rounds}")
        if new.where("comp <> old").isEmpty():
            return new.select("k", "comp")
        labels = new.select("k", "comp")
