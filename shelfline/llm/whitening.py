"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

The centred rows ``X`` are reduced to a small bidiagonal matrix, one pair of products ``u = Xv`` and
``Xᵀu`` a step; its singular values and right vectors give the components and their deviations.
The covariance is never formed.

Left vectors are as long as the table. Each is ``Xp`` for a short ``p`` that the recurrence yields, so
tasks make their part of all earlier ones anew from ``X`` and ``P``: nothing long is kept between
passes, and a lost executor costs its tasks only. One pass of step ``k`` takes the row ``x`` to its
entries of ``u`` and of all earlier left vectors, and sums ``uᵀu``, ``Uᵀu`` and ``Xᵀu``. Full
reorthogonalisation of ``u`` is linear in these sums; right vectors are short and are
reorthogonalised twice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfline.llm.common import map_arrow, materialized

SCALE, SHIFT = 1024, 100_000
#: Components whose deviation is below this share of the largest are rounding, not data.
LEAST = 1e-10
#: Size of a residual, relative to the largest singular value, at which components are settled.
SETTLED = 1e-15


def fixed_point(rows: DataFrame, vector: str, key: str) -> DataFrame:
    """``key, x``: entries as whole numbers ``floor(1024 c) + 100000``, packed as eight-byte integers.

    Dropped are null vectors and those that hold null or non-finite entries, or entries too large for
    such a number (from 2^52 on). Vectors of another length than most have (ties: the longer) are
    dropped too, and empty ones."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            lengths = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            c = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            good = np.isfinite(c) & (np.abs(c) < 2.0**52)
            x = np.floor(np.where(good, c, 0) * SCALE).astype("<i8") + SHIFT
            ends = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.concatenate([[0], np.cumsum(~good)])[ends]
            offsets = pa.py_buffer((ends * 8).astype("<i4"))
            packed = pa.Array.from_buffers(pa.binary(), len(lengths), [None, offsets, pa.py_buffer(x.tobytes())])
            kept = pa.array((np.diff(bad) == 0) & (lengths > 0))
            yield pa.RecordBatch.from_arrays([batch.column("key"), packed, pa.array(lengths)], ["key", "x", "d"]).filter(kept)

    kind = dict(rows.dtypes)[key]
    rows = rows.select(F.col(f"`{key}`").alias("key"), F.col(f"`{vector}`").alias("vector"))
    packed = materialized(map_arrow(rows, pack, f"key {kind}, x binary, d bigint"), "fixed-point")
    widths = packed.groupBy("d").count()
    most = widths.orderBy(F.desc("count"), F.desc("d")).first()
    return packed.where(F.col("d") == (most["d"] if most else 0)).select("key", "x")


def _rows(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("x").to_pylist()), "<i8").reshape(batch.num_rows, dims)


def _summed(packed: DataFrame, dims: int, part: Callable[[np.ndarray], np.ndarray], kind: str) -> list:
    """The sum over all rows of what ``part`` makes of a batch of them, place by place. Tasks add up
    their own batches, places are summed before and after the shuffle; only the sums reach the driver."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(_rows(batch, dims))
                total = found if total is None else total + found
        if total is not None:
            values = pa.array([str(v) for v in total.tolist()]) if kind == "string" else pa.array(total.astype(np.float64))
            yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), values], ["place", "value"])

    value = F.col("value").cast("decimal(38,0)") if kind == "string" else F.col("value")
    sums = map_arrow(packed, add, f"place int, value {kind}").groupBy("place").agg(F.sum(value).alias("value"))
    return [r["value"] for r in sorted(sums.collect(), key=lambda r: r["place"])]


def column_sums(packed: DataFrame, dims: int) -> tuple[int, list[int]]:
    """Number of rows and the exact sum of every dimension."""

    def part(x: np.ndarray) -> np.ndarray:
        exact = x if int(np.abs(x).max()) * len(x) < 1 << 62 else x.astype(object)
        return np.array([len(x), *(int(s) for s in exact.sum(0))], object)

    n, *sums = (int(v) for v in _summed(packed, dims, part, "string"))
    return n, sums


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """Rows less the mean, in double precision: the whole part of the mean goes exactly."""
    whole = [s // n for s in sums]
    return (x - np.array(whole, np.int64)) - np.array([(s - w * n) / n for s, w in zip(sums, whole, strict=True)])


def golub_kahan_lanczos(product: Callable[[np.ndarray, np.ndarray], tuple], dims: int, wanted: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Singular values, falling, and right vectors (columns) of ``X``: at least the first ``wanted``.

    ``product(q, p)`` gives ``uᵀu``, ``(XP)ᵀu`` and ``Xᵀu`` of ``u = Xq`` and the squared size of ``X``.
    Where a step finds nothing new, which repeated deviations and constant directions cause, the next
    starts from a direction orthogonal to all before. At most ``dims`` steps.
    """
    rng = np.random.default_rng(seed)
    v_all, p_all, w_all = (np.zeros((dims, dims)) for _ in range(3))
    b, beta, whole = np.zeros((dims, dims)), 0.0, True

    def orthogonal(r: np.ndarray, k: int) -> np.ndarray:
        for _ in range(2):
            r = r - v_all[:, :k] @ (v_all[:, :k].T @ r)
        return r

    def fresh(k: int) -> np.ndarray:
        r = orthogonal(orthogonal(rng.standard_normal(dims), k), k)
        return r / np.linalg.norm(r)

    v = fresh(0)
    for k in range(dims):
        v_all[:, k] = v
        q = v - beta * p_all[:, k - 1] if k else v
        uu, c, xu, size = product(q, p_all[:, :k])
        q, xu = q - p_all[:, :k] @ c, xu - w_all[:, :k] @ c
        alpha, tiny = np.sqrt(max(0.0, uu - c @ c)), 1e-13 * np.sqrt(size)
        r = np.zeros(dims)
        if alpha > tiny:
            b[k, k] = alpha
            p_all[:, k], w_all[:, k] = q / alpha, xu / alpha
            r = orthogonal(w_all[:, k] - alpha * v, k + 1)
        beta = float(np.linalg.norm(r))
        if k + 1 == dims:
            break
        if beta <= tiny:
            v, beta, whole = fresh(k + 1), 0.0, False
            continue
        if whole and k + 1 >= wanted:
            left, s, _ = np.linalg.svd(b[: k + 1, : k + 1])
            if (beta * np.abs(left[-1, :wanted]) <= SETTLED * s[0]).all():
                break
        b[k, k + 1], v = beta, r / beta
    _, s, right = np.linalg.svd(b[: k + 1, : k + 1])
    return s, v_all[:, : k + 1] @ right.T


def whitened(rows: DataFrame, components: int = 8, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key, component, n, deviation, whitened, explained, identity_error`` for every remaining row and
    each of the first ``components`` principal components of the vectors (see :func:`fixed_point` for
    what remains): the row's exact squared deviation, its whitened coordinate, the component's share of
    the trace, and how far the whitened covariance is from the identity.

    A component whose deviation is rounding is left out, so fewer than ``components`` may come back;
    a single vector, equal vectors and an empty table give no row. Repeated rows count as often as
    they come, a null key is kept. A deviation beyond 64 bits is null.
    """
    spark, kind = rows.sparkSession, dict(rows.dtypes)[key]
    schema = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    packed = fixed_point(rows, vector, key)
    first = packed.first()
    if first is None:
        return spark.createDataFrame([], schema)
    dims = len(first["x"]) // 8
    n, sums = column_sums(packed, dims)

    def product(q: np.ndarray, p: np.ndarray) -> tuple:
        k = p.shape[1]

        def part(x: np.ndarray) -> np.ndarray:
            x = _centred(x, n, sums)
            u = x @ q
            return np.concatenate([[u @ u, np.vdot(x, x)], (x @ p).T @ u, x.T @ u])

        found = np.array(_summed(packed, dims, part, "double"))
        return found[0], found[2 : 2 + k], found[2 + k :], found[1]

    size = _summed(packed, dims, lambda x: np.array([np.square(_centred(x, n, sums)).sum()]), "double")[0]
    if not size:
        return spark.createDataFrame([], schema)
    s, vectors = golub_kahan_lanczos(product, dims, min(components, dims))
    kept = [i for i in range(min(components, len(s))) if s[i] > LEAST * s[0]]
    axes = vectors[:, kept] * (np.sqrt(n) / s[kept])  # projection on a component, over its deviation
    explained = s[kept] ** 2 / size

    def spread(x: np.ndarray) -> np.ndarray:
        z = _centred(x, n, sums) @ axes
        return np.concatenate([z.sum(0), (z.T @ z).ravel()])

    found = np.array(_summed(packed, dims, spread, "double")) / n
    mean, second = found[: len(kept)], found[len(kept) :].reshape(len(kept), -1)
    error = float(np.abs(second - np.outer(mean, mean) - np.eye(len(kept))).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _rows(batch, dims)
            z = _centred(x, n, sums) @ axes
            times = len(kept)
            columns = [
                pa.compute.take(batch.column("key"), pa.array(np.repeat(np.arange(len(x)), times))),
                pa.array(np.tile(np.arange(1, times + 1), len(x)), pa.int32()), pa.array(np.full(len(x) * times, n), pa.int64()),
                pa.compute.take(_deviations(x, n, sums), pa.array(np.repeat(np.arange(len(x)), times))), pa.array(z.ravel()),
                pa.array(np.tile(explained, len(x))), pa.array(np.full(len(x) * times, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return map_arrow(packed, project, schema)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> pa.Array:
    """Sum over the dimensions of ``(n x - S)^2``, exact; null beyond 64 bits."""
    widest = n * int(np.abs(x).max()) + max(abs(s) for s in sums)
    if widest < 1 << 31 and widest * widest * x.shape[1] < 1 << 62 or _fits(x, n, sums):
        return pa.array(np.square(n * x - np.array(sums, np.int64)).sum(1), pa.int64())
    exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(1)
    return pa.array([int(v) if v < 1 << 63 else None for v in exact], pa.int64())


def _fits(x: np.ndarray, n: int, sums: list[int]) -> bool:
    """Whether whole arithmetic in 64 bits is exact, judged with room to spare."""
    if n * int(np.abs(x).max()) >= 1 << 62 or max(abs(s) for s in sums) >= 1 << 62:
        return False
    return float(np.square((n * x - np.array(sums, np.int64)).astype(float)).sum(1).max()) < 2.0**62
