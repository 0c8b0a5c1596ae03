"""Exact k-nearest-neighbour joins (M8, I4).

Points are dealt to the cells of a few pivots.  A query first searches the cell
of its nearest pivot, which bounds the distance of its k-th neighbour; then it
visits only cells that the triangle inequality cannot rule out: a cell whose
pivot is farther away than the bound plus the cell's radius holds nothing, nor
does one whose border with the query's own cell is farther than the bound.  Cells
are split into blocks of bounded size, so a hot cell is many tasks, and k rows
per query and block come out.  Distances are Euclidean over the given columns,
ties go to the smaller id: of equal points only the k smallest ids can be
found, so only they are searched, and equal queries are searched once.

Defined cases: points or queries with a missing coordinate take part in nothing
(``KnnImputer`` leaves such columns out per pattern); fewer points than k give
fewer neighbours; repeated points are neighbours of their own.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from featureforge.session import scratch_path

#: Pivots at most, points of a block and queries of a block.
MAX_PIVOTS = 1024
BLOCK = 4096
#: Rows compared with all pivots at a time.
SLICE = 1024
MAX_PATTERNS = 64


def distances(q: np.ndarray, p: np.ndarray) -> np.ndarray:
    """(queries x points); coordinates are added in order, as a SQL sum does."""
    out = np.zeros((len(q), len(p)))
    for j in range(q.shape[1]):
        d = q[:, j][:, None] - p[:, j][None, :]
        out += d * d
    return np.sqrt(out)


def _matrix(col: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    col = col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col
    return np.asarray(col.flatten().to_numpy(zero_copy_only=False), float).reshape(-1, d) if len(col) else np.zeros((0, d))


def _sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for a in range(0, batch.num_rows, SLICE):
            yield batch.slice(a, SLICE)


def nearest_of(far: np.ndarray, take: int) -> np.ndarray:
    """(queries x take) places of the smallest distances of each row, the first place of equals."""
    if take == far.shape[1]:
        return np.argsort(far, axis=1, kind="stable")
    last = np.partition(far, take - 1, axis=1)[:, take - 1:take]
    row, place = np.nonzero(far <= last)  # by row, then by place
    order = np.lexsort((far[row, place], row))
    row, place = row[order], place[order]
    start = np.searchsorted(row, np.arange(len(far)))
    return place[start[:, None] + np.arange(take)]


def pick_pivots(points: DataFrame, n: int, seed: int) -> np.ndarray:
    """At most ``n`` distinct points, by a hash of their coordinates."""
    rows = points.select("v").distinct().orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(n).collect()
    return np.array([r["v"] for r in rows], float)


def _placed(df: DataFrame, pivots: np.ndarray, id_type: str) -> DataFrame:
    """(id, v, cell, r): nearest pivot and the distance to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            d = distances(_matrix(batch.column("v"), pivots.shape[1]), pivots)
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("v"), pa.array(cell.astype(np.int32)),
                                              pa.array(d[np.arange(len(d)), cell])], ["id", "v", "cell", "r"])

    return df.select("id", "v").mapInArrow(run, f"id {id_type}, v array<double>, cell int, r double")


def _visits(queries: DataFrame, pivots: np.ndarray, radius: np.ndarray, blocks: np.ndarray, id_type: str) -> DataFrame:
    """(qid, v, cell, block) for the cells other than its own that a query must
    visit, given ``bound`` on its k-th distance."""
    between = distances(pivots, pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _sliced(batches):
            d = distances(_matrix(batch.column("v"), pivots.shape[1]), pivots)
            own = batch.column("cell").to_numpy()
            bound = batch.column("bound").to_numpy()[:, None] * (1 + 1e-12)
            home = d[np.arange(len(d)), own][:, None]
            # distance to the border between the own cell and another: (d^2 - home^2) / (2 * distance of the pivots)
            border = (d * d - home * home) / np.maximum(2 * between[own], 1e-300)
            go = (d - radius <= bound) & (border <= bound + 1e-9 * d) & (blocks > 0)
            go[np.arange(len(d)), own] = False
            i, c = np.nonzero(go)
            n = blocks[c]
            at = np.repeat(np.arange(len(i)), n)
            first = np.repeat(np.concatenate([[0], np.cumsum(n)[:-1]]), n) if len(n) else np.zeros(0, np.int64)
            for a in range(0, len(at), 1 << 16):
                k = at[a:a + (1 << 16)]
                rows = pa.array(i[k])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id").take(rows), batch.column("v").take(rows), pa.array(c[k].astype(np.int32)),
                     pa.array((np.arange(a, a + len(k)) - first[a:a + len(k)]).astype(np.int32))], ["qid", "v", "cell", "block"])

    return queries.mapInArrow(run, f"qid {id_type}, v array<double>, cell int, block int")


def _nearest(visits: DataFrame, points: DataFrame, k: int, d: int, q_type: str, p_type: str) -> DataFrame:
    """(qid, found): the k nearest points of every visited block, as (distance, id)."""
    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        p, order = _matrix(right.column("v"), d), np.arange(right.num_rows)
        ids = right.column("id").combine_chunks()
        ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
        by_id = np.argsort(np.array(ids.to_pylist()), kind="stable") if len(ids) else order
        p, ids = p[by_id], ids.take(pa.array(by_id))  # a stable sort by distance then breaks ties by id
        out = []
        for a in range(0, left.num_rows, 512):
            q = _matrix(left.column("v").slice(a, 512), d)
            far = distances(q, p)
            take = min(k, len(p))
            near = nearest_of(far, take)
            flat = near.ravel()
            out.append(pa.table([left.column("qid").slice(a, 512).take(pa.array(np.repeat(np.arange(len(q)), take))),
                                 pa.array(far[np.arange(len(q))[:, None], near].ravel()), ids.take(pa.array(flat))], names=["qid", "distance", "id"]))
        return pa.concat_tables(out) if out else pa.table({"qid": left.column("qid").slice(0, 0), "distance": pa.array([], pa.float64()),
                                                           "id": ids.slice(0, 0)})

    return (visits.groupBy("cell", "block").cogroup(points.groupBy("cell", "block"))
            .applyInArrow(search, f"qid {q_type}, distance double, id {p_type}"))


def _best(found: DataFrame, k: int) -> DataFrame:
    """(qid, near): the k nearest (distance, id) of each query."""
    return found.groupBy("qid").agg(F.slice(F.array_sort(F.collect_list(F.struct("distance", "id"))), 1, k).alias("near"))


def knn_join(queries: DataFrame, points: DataFrame, cols: Sequence[str], k: int, query_id: str = "id", point_id: str = "id",
             n_pivots: int | None = None, block: int = BLOCK, seed: int = 42) -> DataFrame:
    """(qid, near): each query's k nearest points as an array of (distance, id), nearest first."""
    spark = points.sparkSession
    q_type, p_type = queries.schema[query_id].dataType.simpleString(), points.schema[point_id].dataType.simpleString()

    def vectors(df, id_col):
        full = F.lit(True)
        for c in cols:
            full = full & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
        return df.where(full).select(F.col(id_col).alias("id"), F.array(*[F.col(c).cast("double") for c in cols]).alias("v"))

    path = scratch_path(spark, f"knn-{uuid.uuid4().hex}")
    # of equal points the k smallest ids
    rank = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    vectors(points, point_id).withColumn("rank", rank).where(F.col("rank") <= k).drop("rank").write.parquet(f"{path}/distinct")
    points = spark.read.parquet(f"{path}/distinct")
    n = points.count()
    pivots = pick_pivots(points, n_pivots or max(1, min(MAX_PIVOTS, int(n ** 0.5))), seed)
    if not len(pivots):
        return vectors(queries, query_id).select(F.col("id").alias("qid")).withColumn(
            "near", F.expr("array()").cast(f"array<struct<distance:double,id:{p_type}>>")).where(F.lit(False))
    placed = _placed(points, pivots, p_type)
    placed.write.parquet(f"{path}/placed")
    placed = spark.read.parquet(f"{path}/placed")
    radius, blocks = np.zeros(len(pivots)), np.zeros(len(pivots), np.int64)
    for r in placed.groupBy("cell").agg(F.max("r").alias("r"), F.count("id").alias("n")).collect():  # a row per pivot
        radius[r["cell"]], blocks[r["cell"]] = r["r"], -(-r["n"] // block)
    # blocks of a cell by a hash of the id and a row number, so that repeated points are spread as well
    split = F.element_at(F.array(*[F.lit(int(max(b, 1))) for b in blocks]), F.col("cell") + 1)
    points = placed.withColumn("block", F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), split).cast("int"))
    points.write.parquet(f"{path}/points")
    points = spark.read.parquet(f"{path}/points")
    every = vectors(queries, query_id)
    asked = _placed(every.groupBy("v").agg(F.min("id").alias("id")), pivots, q_type)  # one for all equal queries
    asked.write.parquet(f"{path}/queries")
    asked = spark.read.parquet(f"{path}/queries")
    home = asked.select(F.col("id").alias("qid"), "v", "cell", F.explode(F.sequence(F.lit(0), split - 1)).alias("block"))
    first = _best(_nearest(home, points, k, len(cols), q_type, p_type), k)
    first.write.parquet(f"{path}/first")
    first = spark.read.parquet(f"{path}/first")
    bound = F.when(F.size("near") >= k, F.element_at("near", -1)["distance"]).otherwise(F.lit(float("inf")))
    bounded = asked.join(first.select(F.col("qid").alias("id"), bound.alias("bound")), "id", "left").fillna(float("inf"), ["bound"])
    visits = _visits(bounded.select("id", "v", "cell", "bound"), pivots, radius, blocks, q_type)
    more = _nearest(visits, points, k, len(cols), q_type, p_type)
    seen = first.select("qid", F.inline("near")).select("qid", "distance", "id")
    best = asked.select(F.col("id").alias("qid"), "v").join(_best(seen.unionByName(more), k), "qid").drop("qid")
    return every.select(F.col("id").alias("qid"), "v").join(best, "v").select("qid", "near")


def knn_classify(train: DataFrame, rows: DataFrame, cols: Sequence[str], k: int = 5, id_col: str = "id", label_col: str = "label",
                 **kw) -> DataFrame:
    """M8: (id, p1, prediction): share of positive labels among the k nearest
    training rows.  Columns should be on one scale."""
    labels = train.select(F.col(id_col).alias("nid"), F.col(label_col).cast("double").alias("y"))
    near = knn_join(rows, train, cols, k, id_col, id_col, **kw).select("qid", F.explode("near.id").alias("nid"))
    out = near.join(labels, "nid").groupBy("qid").agg(F.avg("y").alias("p1"))
    return out.select(F.col("qid").alias(id_col), "p1", (F.col("p1") >= 0.5).cast("int").alias("prediction"))


def knn_impute(df: DataFrame, cols: Sequence[str], k: int = 5, id_col: str = "id", **kw) -> DataFrame:
    """I4: a missing value becomes the mean of that column over the k nearest
    rows.  Rows with the same missing columns (a pattern) are served together:
    distances use the columns they have, donors are the rows that have those and
    the missing one.  Rows without any value, and rows without a donor, get the
    column's mean.  More than ``MAX_PATTERNS`` patterns raise."""
    mask = F.concat(*[F.when(F.col(c).isNull() | F.isnan(F.col(c).cast("double")), "1").otherwise("0") for c in cols])
    df = df.withColumns({c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in cols}).withColumn("_mask", mask)
    found = [r[0] for r in df.select("_mask").distinct().limit(MAX_PATTERNS + 2).collect()]
    patterns = sorted(m for m in found if "1" in m)
    if len(patterns) > MAX_PATTERNS:
        raise ValueError(f"more than {MAX_PATTERNS} patterns of missing columns; impute fewer columns at a time")
    means = df.agg(*[F.avg(c).alias(c) for c in cols]).first()
    holes = [(m, c) for m, (j, c) in itertools.product(patterns, enumerate(cols)) if m[j] == "1" and "0" in m]

    def values(hole: tuple[str, str]) -> DataFrame:
        m, c = hole
        have = [x for x, gone in zip(cols, m) if gone == "0"]
        rows, donors = df.where(F.col("_mask") == m), df.where(F.col(c).isNotNull())
        near = knn_join(rows, donors, have, k, id_col, id_col, **kw).select("qid", F.explode("near.id").alias("nid"))
        return (near.join(donors.select(F.col(id_col).alias("nid"), F.col(c).alias("_x")), "nid").groupBy("qid")
                .agg(F.avg("_x").alias("_value")).withColumn("_col", F.lit(c)))

    with ThreadPoolExecutor(max_workers=4) as pool:
        parts = list(pool.map(values, holes))
    filled = None
    for value in parts:
        filled = value if filled is None else filled.unionByName(value)
    if filled is not None:
        wide = filled.groupBy(F.col("qid").alias(id_col)).agg(*[F.max(F.when(F.col("_col") == c, F.col("_value"))).alias(f"_n_{c}") for c in cols])
        df = df.join(wide, id_col, "left")
    else:
        df = df.withColumns({f"_n_{c}": F.lit(None).cast("double") for c in cols})
    return df.withColumns({c: F.coalesce(F.col(c), F.col(f"_n_{c}"), F.lit(means[c])) for c in cols}).drop(
        "_mask", *[f"_n_{c}" for c in cols])
