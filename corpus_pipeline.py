"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir), works on all documents that the stage
before kept, and returns a DataFrame that is written as Parquet and read again
as the next stage's ``docs``.  All but the last return the columns of
``documents``; other columns are passed on unchanged.

* toxicity: documents predicted toxic go; the model learns from the labels
  outside the held-out fifth.
* near-dedup: the smallest id of each component of near-duplicates stays (a
  repeated id is one document).
* substring dedup: words of 13-word windows that a smaller id also has go; an
  untouched text keeps its white space, a document whose words are all removed
  stays with an empty text.
* decontamination: documents contaminated with benchmark items go.
* packing: pieces of the rest in sequences of 1024 tokens.

``ORACLE_SQL`` is None: a fitted classifier and a tokenizer are no SQL; the
tests compare the stages with brute force.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from featureforge.llm import catalog, decontaminate, neardup, packing, substrings, toxicity
from featureforge.llm.scratch import Scratch

#: Ids of rejected documents that are sent to all tasks at most; more are joined by shuffle.
BROADCAST_IDS = 1 << 20
#: Documents of an Arrow batch: an executor that has run earlier stages has little room beside its heap.
BATCH_ROWS = "1000"
#: Parts that a packing task remembers: fewer than alone, since the executors still hold what earlier stages left.
PACKING_MEMORY_PARTS = 100_000


def _small_batches(spark: SparkSession) -> None:
    """The stage's jobs run after its function has returned, so the setting stays."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def _without(spark: SparkSession, docs: DataFrame, rejected: DataFrame) -> DataFrame:
    ids = Scratch(spark, "rejected").table(rejected.select("doc_id").distinct(), "ids")
    return docs.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "doc_id", "left_anti").select(docs.columns)


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    model = toxicity.fit(docs, catalog.table(spark, sf_dir, "labels"), catalog.toxic_held_out())
    return toxicity.without_toxic(docs, model)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return _without(spark, docs, neardup.near_duplicates(docs).where("NOT kept"))


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    others = tuple(c for c in docs.columns if c != "doc_id")
    cut = substrings.deduplicate_substrings(docs.select("doc_id", *[F.col(c).alias(f"own_{c}") for c in others]),
                                            text_col="own_text", carry=tuple(f"own_{c}" for c in others))
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("own_text"))
    made = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": text,
            "n_chars": F.when(F.col("n_removed") > 0, F.length("kept_text")).otherwise(F.col("own_n_chars"))
            .cast(docs.schema["n_chars"].dataType)}
    return cut.select(*[made.get(c, F.col(f"own_{c}")).alias(c) for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    found = decontaminate.contamination(docs, catalog.table(spark, sf_dir, "benchmark"))
    return _without(spark, docs, decontaminate.with_verdict(found).where("contaminated"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    _small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), carry="crc32", memory_parts=PACKING_MEMORY_PARTS).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


STAGES = [
    ("toxicity", toxicity_stage),
    ("near_dedup", near_dedup_stage),
    ("substring_dedup", substring_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for ``documents`` in ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = catalog.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name)
    return docs
