"""Exact top-k search by inner product: global score histograms close in on each query's kth value."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pithy.session import written

SCALE = 64
K = 20
BINS = 2048
QUERY_BLOCK = 512
ROW_BLOCK = 4096
BROADCAST_BYTES = 8 << 20
EXACT = 1 << 53


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component as long; null for a vector that takes no part."""
    v = vector.cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 2.0**52 / scale))
    whole = F.transform(F.when(fine & (F.size(v) > 0), v), lambda x: F.floor(x * scale))
    return F.when(squared(whole) < 2.0**60, whole)


def squared(vector: Column) -> Column:
    return F.aggregate(vector, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))


def blocks(rows: DataFrame, size: int) -> DataFrame:
    """(width, row, id, lo, need, x): rows of one width packed into lists of at most `size`, without a shuffle."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(0).to_numpy()
            for width in np.unique(widths):
                of_width = batch.filter(pa.array(widths == width))
                for at in range(0, of_width.num_rows, size):
                    part = of_width.slice(at, size)
                    lists = [
                        pa.ListArray.from_arrays(pa.array([0, len(c)], pa.int32()), c)
                        for c in (*part.columns[1:5], part.column(5).flatten())
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array([width], pa.int32()), *lists], part.schema.names)

    schema = "width int, row array<long>, id array<long>, lo array<long>, need array<long>, x array<long>"
    return rows.select("width", "row", "id", "lo", "need", "x").mapInArrow(step, schema)


def paired(queries: DataFrame, candidates: DataFrame) -> DataFrame:
    """Every block of the query set beside every block of rows of its width; the query set is one broadcast."""
    q = blocks(queries, QUERY_BLOCK).select("width", *[F.col(c).alias(f"q_{c}") for c in ("row", "lo", "need", "x")])
    rows = candidates.withColumns({"lo": F.lit(0).cast("long"), "need": F.lit(0).cast("long")})
    return blocks(rows, ROW_BLOCK).select("width", "row", "id", "x").join(F.broadcast(q), "width")


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """All inner products as int64; by floating point where every partial sum is an exact double."""
    if not len(q) or not len(x):
        return np.zeros((len(q), len(x)), np.int64)
    most = math.sqrt(float((q.astype(float) ** 2).sum(1).max())) * math.sqrt(float((x.astype(float) ** 2).sum(1).max()))
    if most < EXACT / 2:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return q @ x.T


def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, ...]]:
    """(query rows, lo, need, ids by value, scores, own) of every pair of blocks; own marks a query's own row."""
    for batch in batches:
        for i in range(batch.num_rows):
            one = {n: batch.column(n)[i].values for n in batch.schema.names if n != "width"}
            one = {n: v.to_numpy(zero_copy_only=False) for n, v in one.items()}
            width = batch.column("width")[i].as_py()
            order = np.argsort(one["id"], kind="stable")
            s = scores(one["q_x"].reshape(-1, width), one["x"].reshape(-1, width)[order])
            own = one["q_row"][:, None] == one["row"][order][None, :] if np.isin(one["q_row"], one["row"]).any() else None
            yield one["q_row"], one["q_lo"], one["q_need"], one["id"][order], s, own


def histograms(pairs: DataFrame, step: int, width: int) -> DataFrame:
    """(row, bin, n): how many rows score lo + bin * step to below lo + (bin + 1) * step, for the bins that can matter.

    Scores of lo + width and more have been counted by an earlier pass.

    A block sends no bin below the one in which its own scores reach `need`, nor
    below what an earlier block of its task reached: that block alone holds as many
    scores above, so the global one lies no lower.
    """

    bins = -(-width // step)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reached: dict[int, np.ndarray] = {}
        for row, lo, need, _, s, own in scored(batches):
            up = s - lo[:, None]
            inside = (up >= 0) & (up < width)
            if own is not None:
                inside &= ~own
            q, c = np.nonzero(inside)
            counts = np.bincount(q * bins + up[q, c] // step, minlength=len(row) * bins).reshape(len(row), bins)
            from_top = counts[:, ::-1].cumsum(axis=1)[:, ::-1]
            enough = (from_top >= need[:, None]).sum(axis=1) - 1  # the last bin with `need` scores in and above it
            floor = np.maximum(reached.get(int(row[0]), np.int64(0)), enough)
            reached[int(row[0])] = floor
            q, b = np.nonzero(counts)
            sent = b >= floor[q]
            q, b = q[sent], b[sent]
            yield pa.RecordBatch.from_arrays([pa.array(row[q]), pa.array(b), pa.array(counts[q, b])], ["row", "bin", "n"])

    return pairs.mapInArrow(count, "row long, bin long, n long").groupBy("row", "bin").agg(F.sum("n").alias("n"))


def refined(queries: DataFrame, found: DataFrame, step: int) -> DataFrame:
    """The queries with `lo` at the bin of their kth score, and `need` less the scores above that bin.

    A query with fewer candidates than it needs keeps its range, whose foot is below all scores.
    """
    down = Window.partitionBy("row").orderBy(F.desc("bin"))
    at = (
        found.withColumn("upto", F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, 0)))
        .join(queries.select("row", "need"), "row").where("upto >= need and upto - n < need")
        .select("row", (F.col("bin") * step).alias("_up"), (F.col("upto") - F.col("n")).alias("_above"))
    )
    zero = F.lit(0).cast("long")
    return queries.join(at, "row", "left").select(
        "width", "row", "id", "x", (F.col("lo") + F.coalesce("_up", zero)).alias("lo"),
        (F.col("need") - F.coalesce("_above", zero)).alias("need"),
    )


def nearest(pairs: DataFrame) -> DataFrame:
    """(row, vec_id, score): rows above the kth score, and of those at it the `need` smallest ids a block has."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, lo, need, ids, s, own in scored(batches):
            taken = s >= lo[:, None]
            if own is not None:
                taken &= ~own
            q, c = np.nonzero(taken)  # by query, then id
            score = s[q, c]
            tied = np.flatnonzero(score == lo[q])
            nth = np.arange(len(tied)) - np.searchsorted(q[tied], q[tied])
            stays = np.ones(len(q), bool)
            stays[tied[nth >= need[q[tied]]]] = False
            q, c, score = q[stays], c[stays], score[stays]
            yield pa.RecordBatch.from_arrays([pa.array(row[q]), pa.array(ids[c]), pa.array(score)], ["row", "vec_id", "score"])

    return pairs.mapInArrow(keep, "row long, vec_id long, score long")


def top_k(
    vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE,
    bins: int = BINS, broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of `vectors` for every row that meets `is_query`.

    Components count as floor(scale * x); the score is their exact inner product.
    Ranks go by falling score, then smaller id; all rows but the query's own are
    candidates, and a query with fewer than k candidates gets them all. Null ids, and
    vectors that are null or empty or hold a null or a non-finite component, take no
    part, nor do vectors of a squared integer length of 2^60 or more, whose scores
    need not fit a long. Vectors of another width are no candidates. Rows that repeat
    an id are rows of their own: each is a query, and a candidate of the other. Empty
    tables give empty results; other columns are ignored.

    The query set meets all rows in blocks, a bounded part of it at a time, which is
    broadcast. Each pass scores everything anew and refines the range of every kth
    score by `bins`, until it is one number; a last pass returns the rows at or above
    it. Shuffled are histogram bins and results, about k per query and task.
    """
    rows = written(
        vectors.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("x"), F.coalesce(is_query, F.lit(False)).alias("asks"))
        .where("id is not null and x is not null").withColumn("width", F.size("x")).withColumn("row", F.monotonically_increasing_id()),
        "top-rows",
    )
    far, far_asked, width, asking = rows.agg(
        F.max(squared(F.col("x"))), F.max(F.when(F.col("asks"), squared(F.col("x")))), F.max("width"), F.sum(F.col("asks").cast("long"))
    ).first()
    if not asking:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    reach = (math.isqrt(math.ceil(far)) + 1) * (math.isqrt(math.ceil(far_asked)) + 1)  # no score lies at or beyond it
    at_once = max(1, broadcast_bytes // (8 * width))
    parts = -(-asking // at_once)
    asked = written(
        rows.where("asks").withColumns({
            "part": F.pmod(F.xxhash64("row"), F.lit(parts)), "lo": F.lit(-reach).cast("long"), "need": F.lit(k).cast("long"),
        }), "top-queries",
    )
    best = None
    for part in range(parts):
        queries = asked.where(F.col("part") == part).drop("part", "asks")
        left = 2 * reach + 1
        while True:
            step = -(-left // bins)
            queries = written(refined(queries, histograms(paired(queries, rows), step, left), step), "top-ranges")
            if step == 1:
                break
            left = step
        names = queries.select("row", F.col("id").alias("query_id"))
        by_score = Window.partitionBy("row").orderBy(F.desc("score"), "vec_id")
        ranked = nearest(paired(queries, rows)).withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k)
        chosen = ranked.join(names, "row").select("query_id", "rank", "vec_id", "score")
        if parts > 1:
            chosen = written(chosen, "top-chosen")
        best = chosen if best is None else best.unionByName(chosen)
    return best
