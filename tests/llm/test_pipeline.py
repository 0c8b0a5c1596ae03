"""The pipeline's stages against brute force on what each stage reads."""


import corpus_pipeline as pipeline
from pyspark.sql import functions as F

from tests.llm.conftest import ODD, SF
from tests.llm.test_dedup import brute_components, brute_substrings, split
from tests.llm.test_quality_and_decontamination import brute_contamination
from tests.llm.test_tokens_and_packing import check_packed


def test_stages_on_the_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    columns = docs.dtypes
    for k, (name, stage) in enumerate(pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        texts = [(i, r["text"]) for i, r in before.items()]
        path = str(tmp_path / f"{k}")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        if name == "packing":
            check_packed(texts, docs.collect())
            break
        assert docs.dtypes == columns
        after = {r["doc_id"]: r for r in docs.collect()}
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
            assert set(after) <= set(before) and len(before) - len(after) <= 3 * len(toxic)
        if name == "near_dedup":
            assert set(after) == {i for i, x in brute_components(texts).items() if x[2]}
        if name == "substring_dedup":
            for i, n, gone, sha in brute_substrings(texts):
                if gone == 0:
                    assert after[i] == before[i]
                else:
                    assert len(split(after[i]["text"])) == n - gone and after[i]["n_chars"] == len(after[i]["text"])
        if name == "decontamination":
            assert set(after) == {x[0] for x in brute_contamination(texts, bench, 13) if not x[4]}
        else:
            assert name == "substring_dedup" or all(after[i] == before[i] for i in after)


def test_stages_on_odd_rows(spark, odd, empty):
    """Null values in every column, ties, repeated rows, clashing extra columns, no rows."""
    full = odd.withColumns({"lang": F.lit(None).cast("string"), "source": F.lit(None).cast("string"),
                            "n_chars": F.lit(None).cast("long"), "own_text": F.lit("x"), "kept_text": F.lit("y")})
    none = full.limit(0)
    for name, stage in pipeline.STAGES:
        out = stage(spark, full, SF)
        assert stage(spark, none, SF).collect() == []
        if name == "packing":
            check_packed(ODD, out.collect())
        else:
            assert out.columns == full.columns
            stay = {k for k, x in brute_components(ODD).items() if x[2]} | {None} if name == "near_dedup" else {k for k, _ in ODD}
            assert out.count() == sum(k in stay for k, _ in ODD)


def test_run_is_registered_and_whole(spark):
    import __spark_entry__ as E
    out = E.queries()["pipeline"](spark, SF).collect()
    starts = {(r["doc_id"], r["start"]) for r in out}
    assert len(starts) == len(out) and all(r["length"] <= 1024 for r in out)
    assert all((i, 0) in starts for i, _ in starts)
