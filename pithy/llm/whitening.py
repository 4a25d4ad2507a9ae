"""Whitening of embeddings by shifted CholeskyQR: Gram passes, triangular solves, an SVD of the composed factor."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pithy.session import written

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 32
PASSES = 8
ORTHOGONAL = 1e-11
EPS = 2.0**-53
LOW = 1 << 26


def fit_list(vectors: DataFrame, id_col: str, vector_col: str, scale: int, shift: int) -> DataFrame:
    """(id, x): floor(scale * c) + shift of every usable vector."""
    v = F.col(vector_col).cast("array<double>")
    fine = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < 2.0**52 / scale)) & (F.size(v) > 0)
    x = F.transform(F.when(fine, v), lambda c: F.floor(c * scale) + shift)
    return vectors.select(F.col(id_col).alias("id"), x.alias("x")).where("x is not null")


def integers(batch: pa.RecordBatch, width: int, column: str = "x") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def summed(rows: DataFrame, size: int, of: Callable[[pa.RecordBatch], np.ndarray], type_: str = "double") -> np.ndarray:
    """Sum over all batches of the equally shaped (size, any) matrices that `of` makes of a batch.

    A task adds its own batches and sends one row per matrix row; these are added by
    row number over the cluster, so that only the sum reaches the driver.
    """
    schema = f"i int, v array<{type_}>"

    def lists(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        numbers, values = list(total), np.stack(list(total.values()))
        offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))], ["i", "v"])

    def per_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                total = of(batch) if total is None else total + of(batch)
        if total is not None:
            yield lists(dict(enumerate(total)))

    def per_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1)):
                v = v.values.to_numpy(zero_copy_only=False)
                total[i] = total[i] + v if i in total else v.copy()
        if total:
            yield lists(total)

    found = rows.mapInArrow(per_task, schema).repartition("i").mapInArrow(per_row, schema).collect()
    return np.array([r.v for r in sorted(found, key=lambda r: r.i)]).reshape(size, -1)


def solved(rows: np.ndarray, factor: np.ndarray) -> np.ndarray:
    """Q of Q @ factor = rows, column after column; factor is upper triangular."""
    out = np.empty_like(rows)
    for j in range(rows.shape[1]):
        out[:, j] = (rows[:, j] - out[:, :j] @ factor[:j, j]) / factor[j, j]
    return out


def cholesky(gram: np.ndarray, rows: int, first: bool) -> np.ndarray:
    """Upper factor of the Gram matrix, shifted in the first pass and wherever it is not positive definite to rounding."""
    width = len(gram)
    size = max(float(np.linalg.norm(gram, 2)), np.finfo(float).tiny)
    least = min(11 * (rows * width + width * (width + 1)) * EPS, 1e-2) * size
    shift = least if first else 0.0
    while True:
        try:
            return np.linalg.cholesky(gram + shift * np.eye(width)).T
        except np.linalg.LinAlgError:
            shift = max(least, 10 * shift)


def orthogonal_factor(gram_of: Callable[[list[np.ndarray]], np.ndarray], rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(singular values, right vectors as columns) of the centred rows, directions without variance left out.

    Each pass divides the rows by the factors so far and factors what is left; it ends
    when the directions of the composed factor are orthonormal.
    """
    factors: list[np.ndarray] = []
    whole = np.eye(width)
    for _ in range(PASSES):
        gram = gram_of(factors)
        left, sizes, right = np.linalg.svd(whole)
        stay = np.ones(width, bool)
        if factors:
            stay = sizes > 4 * width * EPS * sizes[0]
            within = left[:, stay].T @ gram @ left[:, stay]
            if np.abs(within - np.eye(int(stay.sum()))).max() <= ORTHOGONAL:
                break
            stay &= np.abs(np.einsum("ij,ik,kj->j", left, gram, left) - 1) < 1e-6
        factors.append(cholesky(gram, rows, not factors))
        whole = factors[-1] @ whole
    return sizes[stay], right[stay].T


def whiten(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS,
    scale: int = SCALE, shift: int = SHIFT,
) -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of every vector and component.

    A component c counts as x = floor(scale * c) + shift. All vectors are fitted, and
    centred exactly before anything is multiplied: x - S / n for n vectors with the sums S.
    Components go by falling variance from 1. deviation is the sum of (n * x - S)^2,
    null where that does not fit a long; explained is the component's share of the whole variance;
    identity_error the largest entry of the whitened rows' covariance less the identity.

    Vectors that are null or empty, or hold a null, a non-finite component or one whose x is
    no exact double, are left out; a null id is kept. Vectors of another width than
    the commonest (the wider of a tie) are left out too. Directions without variance
    are no components, so equal vectors, one vector, and an empty table give no
    rows. Repeated rows count and return each time. Other columns are ignored.

    A pass sends one width x width matrix per task, whatever its rows; the driver
    holds a few such matrices and no row.
    """
    x = written(fit_list(vectors, id_col, vector_col, scale, shift).withColumn("width", F.size("x")), "fit-list")
    result = f"component int, n long, deviation long, whitened double, explained double, identity_error double"
    common = x.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).first()
    empty = x.where("false").select(F.col("id").alias(id_col), *[F.lit(None).cast(t).alias(c) for c, t in (f.split() for f in result.split(", "))])
    if common is None:
        return empty
    width, n = common["width"], common["count"]
    x = x.where(F.col("width") == width).select("id", "x")

    def halves(batch: pa.RecordBatch) -> np.ndarray:
        values = integers(batch, width)
        return np.stack([(values // LOW).sum(axis=0), (values % LOW).sum(axis=0)])

    high, low = summed(x, 2, halves, "long").tolist()
    sums = [h * LOW + l for h, l in zip(high, low)]
    mean = np.array([s // n for s in sums], np.int64)
    rest = np.array([s % n for s in sums], np.int64)

    def centred(batch: pa.RecordBatch) -> np.ndarray:
        return (integers(batch, width) - mean) - rest / n

    def gram_of(factors: list[np.ndarray]) -> np.ndarray:
        def gram(batch: pa.RecordBatch) -> np.ndarray:
            rows = centred(batch)
            for factor in factors:
                rows = solved(rows, factor)
            return rows.T @ rows

        return summed(x, width, gram)

    trace = float(summed(x, 1, lambda batch: (centred(batch) ** 2).sum(axis=0)[None, :]).sum()) / n
    if not trace:
        return empty
    sizes, directions = orthogonal_factor(gram_of, n, width)
    sizes, directions = sizes[:components], directions[:, :components]
    kept = len(sizes)
    root = sizes / np.sqrt(n)
    axes = directions / root
    middle = summed(x, 1, lambda batch: (centred(batch) @ axes).sum(axis=0)[None, :])[0] / n

    def covariance(batch: pa.RecordBatch) -> np.ndarray:
        white = centred(batch) @ axes - middle
        return white.T @ white

    error = float(np.abs(summed(x, kept, covariance) / n - np.eye(kept)).max())
    explained = root**2 / trace

    def deviations(values: np.ndarray) -> pa.Array:
        off = values - mean
        if (n * (int(np.abs(off).max(initial=0)) + 1)) ** 2 * width < 1 << 63:
            return pa.array(((n * off - rest) ** 2).sum(axis=1))
        exact = [sum((n * o - r) ** 2 for o, r in zip(row, rest.tolist())) for row in off.tolist()]
        return pa.array([d if d < 1 << 63 else None for d in exact], pa.int64())

    names = [id_col, *[f.split()[0] for f in result.split(", ")]]

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.num_rows
            which = pa.array(np.repeat(np.arange(rows), kept))
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(which), pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * kept, n, np.int64)), deviations(integers(batch, width)).take(which),
                pa.array((centred(batch) @ axes).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * kept, error)),
            ], names)

    id_type = x.schema["id"].dataType.simpleString()
    return x.mapInArrow(project, f"`{id_col}` {id_type}, {result}")
