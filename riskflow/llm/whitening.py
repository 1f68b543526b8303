"""Whitening of embeddings by the singular values of their centred rows.

Blockwise QR: every task centres its rows and reduces them to a triangular factor; factors are
stacked and reduced again, a bounded number at a time, until one is left. Its size is the
dimension, not the number of rows. From there on everything is as small as that factor:
Householder reflections make it upper bidiagonal, differential quotient-difference steps with
shifts (dqds) find its singular values to high relative accuracy, and twisted factorisations of
each shifted matrix give the right singular vectors, which the reflections carry back. The
covariance matrix is never formed, so small directions keep their digits.

Entries are taken as the integers x = floor(scale * c) + offset. Sums, centring and deviations are
exact integers. The rows that are fitted are the distinct vectors, each once.

Rows whose vector is null or empty, holds a null or a non-finite entry, or an entry whose integer
does not fit 62 bits, are left out. Vectors of another length than the most common one (the longer
one of equals) have no place in its space and are left out as well. Directions without variance
cannot be whitened: they are no components, so one distinct vector alone, like an empty table,
gives no rows. Equal singular values leave their directions free within their space. Repeated rows
and null ids give repeated results. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskflow.llm.common import stored

SCALE, OFFSET, COMPONENTS = 64, 1_000_000, 16
#: Triangular factors that are stacked at a time, and rows of a block.
FAN, BLOCK = 64, 4096
_EPS = float(np.finfo(float).eps)


class Whitening(NamedTuple):
    n: int  # distinct vectors
    sums: list[int]  # of each dimension
    values: np.ndarray  # falling eigenvalues of the covariance, those of components only
    vectors: np.ndarray  # their unit vectors, a column each
    trace: float


# -- the small matrices --------------------------------------------------------------------------


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Diagonal and superdiagonal of U' R V, and the reflections that make V, first one first."""
    a = r.copy()
    m = len(a)
    right: list[np.ndarray] = []
    for k in range(m):
        v = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(2 * v, v @ a[k:, k:])
        if k < m - 2:
            v = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ v, 2 * v)
            right.append(v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _reflector(x: np.ndarray) -> np.ndarray:
    """Unit v (or zero) with (1 - 2vv') x along the first axis."""
    v = x.astype(float)
    size = np.linalg.norm(v)
    if size == 0:
        return v
    v = v / size
    v[0] += 1.0 if v[0] >= 0 else -1.0
    return v / np.linalg.norm(v)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squared singular values of an upper bidiagonal matrix, falling.

    The shift of a step is Newton's bound: the first, unshifted sweep gives the diagonal of the
    inverse, whose trace bounds the smallest value from below, so no step loses definiteness.
    The matrix is split wherever a superdiagonal has died out.
    """
    top = float(max(np.max(np.abs(diagonal), initial=0.0), np.max(np.abs(above), initial=0.0)))
    if top == 0:
        return np.zeros(len(diagonal))
    tiny = 1e-200  # in place of a zero on the diagonal, which would divide
    q = [max((x / top) ** 2, tiny) for x in diagonal.tolist()]
    e = [(x / top) ** 2 for x in above.tolist()]
    found: list[float] = []
    work = [(q, e, 0.0)]
    while work:
        q, e, shift = work.pop()
        for _ in range(200 * len(q)):
            if len(q) == 1:
                break
            cut = next((k for k in range(len(e) - 1, -1, -1) if _negligible(e[k], min(q[k], q[k + 1]), shift)), None)
            if cut is not None:
                work.append((q[: cut + 1], e[:cut], shift))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if q[0] < q[-1]:  # small values leave at the end
                q, e = q[::-1], e[::-1]
            inverse, d = 0.0, q[0]
            for k in range(len(e)):
                inverse += 1 / max(d, tiny)
                d = d * (q[k + 1] / (d + e[k]))
            inverse += 1 / max(d, tiny)
            step = (1 - 4 * len(q) * _EPS) / inverse
            if step <= _EPS * shift:
                step = 0.0
            moved = _sweep(q, e, step, tiny)
            while moved is None:  # rounding only
                step = step / 2 if step > tiny else 0.0
                moved = _sweep(q, e, step, tiny)
            q, e = moved
            shift += step
        else:
            raise ArithmeticError("dqds did not converge")
        found.append((shift + q[0]) * top * top)
    return np.sort(np.array(found))[::-1]


def _negligible(e: float, q: float, shift: float) -> bool:
    """Whether a superdiagonal moves no value by more than rounding: relative to its neighbours, or
    to what has been shifted off already, where values lie close together."""
    return e <= _EPS * _EPS * (shift + q) or e + 2 * math.sqrt(e * q) <= _EPS * shift


def _sweep(q: list[float], e: list[float], step: float, tiny: float) -> tuple[list[float], list[float]] | None:
    """One shifted transform, or None if a value left the positive range."""
    new_q, new_e, d = [], [], q[0] - step
    for k in range(len(e)):
        if d < 0:
            return None
        new_q.append(max(d + e[k], tiny))
        ratio = q[k + 1] / new_q[-1]
        new_e.append(e[k] * ratio)
        d = d * ratio - step
    if d < 0:
        return None
    return [*new_q, max(d, tiny)], new_e


def twisted(diagonal: np.ndarray, above: np.ndarray, value: float, taken: list[np.ndarray]) -> np.ndarray:
    """Unit vector of B'B, B upper bidiagonal, to an eigenvalue: factorisations of B'B - value from
    above and from below meet at the twist with the smallest pivot, and the vector is read off.
    Where vectors of close values are ``taken``, the twist keeps away from their large entries."""
    m = len(diagonal)
    scale = float(np.max(np.abs(diagonal)))
    a = np.where(np.abs(diagonal) < 1e-150 * scale, 1e-150 * scale, diagonal)
    d = a * a
    link = np.append(above / a[:-1], 0.0)
    safe = lambda x: x if x != 0 else _EPS * _EPS * value
    stationary, lower = np.empty(m), np.empty(m)
    s = -value
    for k in range(m):
        stationary[k] = s
        if k < m - 1:
            lower[k] = d[k] * link[k] / safe(s + d[k])
            s = lower[k] * link[k] * s - value
    progressive, upper = np.empty(m), np.empty(m)
    p = d[-1] - value
    for k in range(m - 1, -1, -1):
        progressive[k] = p
        if k:
            ratio = d[k - 1] / safe(d[k - 1] * link[k - 1] ** 2 + p)
            upper[k - 1] = link[k - 1] * ratio
            p = p * ratio - value
    pivot = stationary + progressive + value
    free = 1.0 - sum((c * c for c in taken), np.zeros(m))
    weighed = np.abs(pivot) / np.maximum(free, _EPS)
    twist = int(np.argmin(np.where(np.isfinite(weighed), weighed, np.inf)))
    z = np.zeros(m)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -lower[k] * z[k + 1]
    for k in range(twist, m - 1):
        z[k + 1] = -upper[k] * z[k]
    return z / np.linalg.norm(z)


def _apart(z: np.ndarray, taken: list[np.ndarray]) -> np.ndarray:
    """The part of z at right angles to unit vectors, taken off twice against rounding."""
    for c in [*taken, *taken]:
        z = z - (c @ z) * c
    return z


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest squared singular values of a triangular factor and their right vectors; values
    that rounding alone could have made are left out."""
    diagonal, above, right = bidiagonal(r)
    squares = dqds(diagonal, above)
    floor = (len(r) * _EPS) ** 2 * (squares[0] if len(squares) else 0.0)
    squares = squares[:count][squares[:count] > floor]
    band = np.diag(diagonal) + np.diag(above, 1)
    columns: list[np.ndarray] = []
    rng = np.random.default_rng(0)
    for k, value in enumerate(squares):
        # Close values share their space: keep to the part that is not taken yet.
        near = [columns[j] for j in range(k) if squares[j] - value <= 1e-3 * squares[j]]
        z = _apart(twisted(diagonal, above, value, near), near)
        if np.linalg.norm(z) < 0.1:  # equal values: inverse iteration within the rest of the space
            shifted = band.T @ band - value * (1 + 16 * _EPS) * np.eye(len(z))
            z = _apart(rng.standard_normal(len(z)), near)
            for _ in range(4):
                z = _apart(np.linalg.solve(shifted, z / np.linalg.norm(z)), near)
        columns.append(z / np.linalg.norm(z))
    vectors = np.array(columns).T.reshape(len(r), len(columns))
    for k in range(len(right) - 1, -1, -1):  # V = H1 H2 ..., each from column k + 1 on
        v = right[k]
        vectors[k + 1 :] -= np.outer(2 * v, v @ vectors[k + 1 :])
    return squares, vectors


# -- the rows ------------------------------------------------------------------------------------


def integers(rows: DataFrame, key: str, column: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """Columns ``key`` and x, the integer vectors, of the rows that have one."""
    entry = lambda c: c.cast("double")
    fits = lambda c: c.isNotNull() & ~F.isnan(entry(c)) & (F.abs(entry(c)) < 2.0**62 / scale)
    good = rows.select(F.col(key).alias("key"), F.col(column).alias("v")).where(
        F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(fits(c), F.lit(False)))
    )
    sizes = good.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if sizes is not None:
        good = good.where(F.size("v") == sizes["d"])
    return good.select("key", F.transform("v", lambda c: F.floor(entry(c) * float(scale)) + F.lit(offset)).alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: as 64-bit integers where they fit, as Python's otherwise."""
    most = max(map(abs, sums), default=0) + n * int(np.abs(x).max(initial=0))
    if most < 2**62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _reduced(factors: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(factors), mode="r")


def _fit_sums(fit: DataFrame) -> tuple[int, list[int]]:
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            x = _matrix(batch.column(0))
            low, high = x & 0xFFFFFF, x >> 24  # 24 bits apart, so that a batch cannot overflow
            part = [int(a) + (int(b) << 24) for a, b in zip(low.sum(axis=0), high.sum(axis=0), strict=True)]
            sums = part if sums is None else [a + b for a, b in zip(sums, part, strict=True)]
            n += len(x)
        if n:
            at = pa.array(range(len(sums)), pa.int32())
            yield pa.RecordBatch.from_pydict({"at": at, "n": [n] * len(sums), "s": [str(s) for s in sums]})

    parts = fit.select("x").mapInArrow(partial, "at int, n long, s string")
    rows = parts.groupBy("at").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).orderBy("at").collect()
    return (rows[0]["n"] if rows else 0), [int(r["s"]) for r in rows]


def _triangular(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of the centred rows."""

    def leaf(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, len(sums)))
        for batch in batches:
            x = _matrix(batch.column(0))
            for at in range(0, len(x), BLOCK):
                r = _reduced([r, (_centred(x[at : at + BLOCK], n, sums) / n).astype(float)])
        if len(r):
            yield pa.RecordBatch.from_pydict({"node": [TaskContext.get().partitionId()], "r": [r.ravel().tolist()]})

    def stack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, r = None, np.zeros((0, len(sums)))
        for batch in batches:
            for k, flat in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if k != node and len(r):
                    yield pa.RecordBatch.from_pydict({"node": [node], "r": [r.ravel().tolist()]})
                    r = np.zeros((0, len(sums)))
                node = k
                r = _reduced([r, flat.values.to_numpy().reshape(-1, len(sums))])
        if len(r):
            yield pa.RecordBatch.from_pydict({"node": [node], "r": [r.ravel().tolist()]})

    schema = "node long, r array<double>"
    factors = stored(fit.select("x").mapInArrow(leaf, schema), "factors")
    while factors.count() > FAN:
        grouped = factors.withColumn("node", F.floor(F.col("node") / FAN)).repartition("node").sortWithinPartitions("node")
        factors = stored(grouped.mapInArrow(stack, schema), "factors")
    rows = [np.array(row["r"]).reshape(-1, len(sums)) for row in factors.orderBy("node").collect()]
    r = _reduced(rows)
    return np.vstack([r, np.zeros((len(sums) - len(r), len(sums)))])


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Fit the distinct vectors of a stored table with column x; None if it is empty."""
    n, sums = _fit_sums(vectors)
    if not n:
        return None
    r = _triangular(vectors, n, sums)
    squares, columns = directions(r, components)
    return Whitening(n, sums, squares / n, columns, float((r * r).sum()) / n)


def _whiten(x: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    centred = _centred(x, model.n, model.sums)
    return centred, (centred / model.n).astype(float) @ (model.vectors / np.sqrt(model.values))


def identity_error(vectors: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the fitted rows, whitened, minus the identity."""
    k = len(model.values)

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            w = _whiten(_matrix(batch.column(0)), model)[1]
            first += w.sum(axis=0)
            second += w.T @ w
        flat = np.append(first, second).tolist()
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(len(flat)), pa.int32()), "m": flat})

    parts = vectors.select("x").mapInArrow(moments, "at int, m double")
    total = np.array([r["m"] for r in parts.groupBy("at").agg(F.sum("m").alias("m")).orderBy("at").collect()]) / model.n
    mean = total[:k]  # zero but for rounding, so that nothing cancels here
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max(initial=0.0))


def whiten(
    rows: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    components: int = COMPONENTS,
    scale: int = SCALE,
    offset: int = OFFSET,
) -> DataFrame:
    """Per remaining row and component: the key, component (from 1), n, deviation (the sum over the
    dimensions of (n * x - S) squared; null where it does not fit a long), whitened, explained and
    identity_error. ``components`` bounds the number of components."""
    x = stored(integers(rows, key, column, scale, offset), "integers")
    # A common vector is counted once per task before the exchange.
    distinct = stored(x.select("x").distinct(), "vectors")
    model = fit(distinct, components)
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, deviation long, w array<double>"
    if model is None or not len(model.values):
        return _shaped(x.limit(0).selectExpr(f"key as `{key}`", "cast(null as long) deviation", "cast(null as array<double>) w"), key, [], 0, 0.0)
    error = identity_error(distinct, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            centred, w = _whiten(_matrix(batch.column(1)), model)
            most = int(np.abs(centred).max(initial=0))
            if centred.dtype == object or most * most * centred.shape[1] >= 2**63:
                exact = (centred.astype(object) ** 2).sum(axis=1)
                deviation = pa.array([int(d) if d < 2**63 else None for d in exact], pa.int64())
            else:
                deviation = pa.array((centred * centred).sum(axis=1), pa.int64())
            flat = pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column(0), deviation, flat], names=[key, "deviation", "w"])

    return _shaped(x.mapInArrow(run, schema), key, (model.values / model.trace).tolist(), model.n, error)


def _shaped(whitened: DataFrame, key: str, explained: list[float], n: int, error: float) -> DataFrame:
    shares = F.lit(explained).cast("array<double>") if explained else F.expr("cast(array() as array<double>)")
    return whitened.select(F.col(key), "deviation", F.posexplode("w").alias("at", "whitened")).select(
        F.col(key),
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
