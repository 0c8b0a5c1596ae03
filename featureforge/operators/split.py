"""Reproducible splits and resampling.

Every row gets an exact, partition-independent rank inside its stratum:
order = (md5(id || '-' || seed), id).  A single ``row_number()`` per stratum
would put a whole class (half the table for a binary target) in one window
partition, so the rank is assembled in two parts:

* the hash's first ``bucket_chars`` hex digits split each stratum into up to
  16**bucket_chars buckets; the per-(stratum, bucket) counts are a small table
  (bounded by #strata x 16**bucket_chars) whose running sum gives each
  bucket's offset (joined back; AQE broadcasts it when it is small);
* ``row_number()`` runs inside (stratum, bucket) groups, ~n / 65 536 rows each.

rank = offset + row_number gives exactly the single-window result.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def hash_key(id_col: str, seed: int):
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f"-{seed}")))


def stratified_rank(df: DataFrame, id_col: str, strata: Sequence[str] = (), seed: int = 42,
                    bucket_chars: int = 4) -> DataFrame:
    """Adds ``_rank`` (1-based, exact) and ``_n`` (stratum size)."""
    if strata:   # one non-null key per stratum (a null class is a stratum of its own)
        skey = F.concat_ws("\u0001", *[F.coalesce(F.col(k).cast("string"), F.lit("\u0000")) for k in strata])
    else:
        skey = F.lit("")
    staged = (df.withColumn("_s", skey).withColumn("_h", hash_key(id_col, seed))
              .withColumn("_b", F.substring("_h", 1, bucket_chars)))
    counts = staged.groupBy("_s", "_b").agg(F.count(F.lit(1)).alias("_c"))
    w_run = Window.partitionBy("_s").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (counts.withColumn("_off", F.coalesce(F.sum("_c").over(w_run), F.lit(0)))
               .withColumn("_n", F.sum("_c").over(Window.partitionBy("_s"))).drop("_c"))
    # offsets has at most (#strata x 16**bucket_chars) rows; #strata is not
    # bounded in general, so no hint: AQE broadcasts it at runtime when the
    # measured size of that stage is under the broadcast threshold
    joined = staged.join(offsets, ["_s", "_b"])
    w_in = Window.partitionBy("_s", "_b").orderBy("_h", id_col)
    return (joined.withColumn("_rank", F.col("_off") + F.row_number().over(w_in))
            .drop("_s", "_h", "_b", "_off"))


def _round_half_up(x):
    return F.floor(x + F.lit(0.5)).cast("bigint")


def train_test_split(df: DataFrame, id_col: str, target: str | None = None, test_size: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Adds ``split`` in {train, test}; per stratum the first
    round(n * test_size) rows of the hash order are test.  Unstratified when
    ``target`` is None (or absent)."""
    strata = [target] if target and target in df.columns else []
    r = stratified_rank(df, id_col, strata, seed)
    k = _round_half_up(F.col("_n") * test_size)
    return r.withColumn("split", F.when(F.col("_rank") <= k, "test").otherwise("train")).drop("_rank", "_n")


def train_val_test_split(df: DataFrame, id_col: str, target: str | None = None,
                         test_size: float = 0.2, val_size: float = 0.2, seed: int = 42) -> DataFrame:
    """Test first, then val_size / (1 - test_size) of the rest."""
    strata = [target] if target and target in df.columns else []
    r = stratified_rank(df, id_col, strata, seed)
    kt = _round_half_up(F.col("_n") * test_size)
    kv = _round_half_up((F.col("_n") - kt) * (val_size / (1 - test_size)))
    return r.withColumn("split", F.when(F.col("_rank") <= kt, "test")
                        .when(F.col("_rank") <= kt + kv, "val").otherwise("train")).drop("_rank", "_n")


def stratified_kfold(df: DataFrame, id_col: str, target: str | None = None, k: int = 5,
                     seed: int = 42) -> DataFrame:
    """fold = (rank - 1) mod k within the stratum (usable as CrossValidator foldCol)."""
    strata = [target] if target and target in df.columns else []
    r = stratified_rank(df, id_col, strata, seed)
    return r.withColumn("fold", ((F.col("_rank") - 1) % k).cast("int")).drop("_rank", "_n")


def random_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42) -> DataFrame:
    """T4 (random): T1 without strata."""
    return train_test_split(df, id_col, None, test_size, seed)


def time_split(df: DataFrame, ts_col: str, id_col: str, test_size: float = 0.2) -> DataFrame:
    """T4 (time): rows ordered by (ts, id), null times last; the last
    round(n * test_size) rows are test.  The cut is located exactly with
    ``locate_kth`` (bucketed count histograms, then a bounded window), first
    on the time key, then on the id among rows sharing the boundary time, so a
    burst of identical timestamps never sorts in one task."""
    from featureforge.functions.rank import locate_kth
    if dict(df.dtypes)[ts_col] == "timestamp_ntz":     # wall-clock time: no session time zone involved
        key = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts_col}`)")
    else:
        key = F.unix_micros(F.col(ts_col).cast("timestamp"))
    staged = df.withColumn("_tk", key)
    st = staged.agg(F.count(F.lit(1)).alias("n"), F.count("_tk").alias("nn")).first()
    n, nn = st["n"], st["nn"]
    k_train = n - int((n * test_size) + 0.5)
    if k_train <= 0:
        return df.withColumn("split", F.lit("test"))
    tk, idc = F.col("_tk"), F.col(id_col)
    if k_train > nn:                       # the cut falls among null times (ordered by id)
        vid, _ = locate_kth(staged.where(tk.isNull()), id_col, k_train - nn)
        split = F.when(tk.isNotNull() | (idc <= F.lit(vid)), "train").otherwise("test")
    else:
        v, less = locate_kth(staged, "_tk", k_train)
        vid, _ = locate_kth(staged.where(tk == F.lit(v)), id_col, k_train - less)
        split = (F.when(tk < F.lit(v), "train").when(tk > F.lit(v), "test")
                 .when((tk == F.lit(v)) & (idc <= F.lit(vid)), "train").otherwise("test"))
    return staged.withColumn("split", split).drop("_tk")


def row_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """T5: n rows without replacement = the n smallest hash keys
    (TakeOrderedAndProject: each task keeps n, bounded)."""
    return df.orderBy(hash_key(id_col, seed), F.col(id_col)).limit(n)
