"""Whitening directions of vectors by a bidiagonal qd solver.

Components become integers, floor(scale * c). The fit list holds every distinct integer
vector once. Tasks reduce its centred rows to triangles by blockwise QR, and triangles are
stacked and reduced again, eight at a time, until one is left (R, as wide as the vectors).
Householder reflections bring R to bidiagonal form; dqds finds its singular values; twisted
factorisations give the vectors of the largest ones. Squared singular values over n are the
eigenvalues of the covariance, and rotating back gives the whitening directions.

Only R, per-dimension sums and the chosen directions come to the driver: the square of the
dimension, whatever the number of rows. Nothing else is collected or broadcast.

Rows whose vector is null or holds null or non-finite entries are dropped. Entries that a
shorter vector lacks count as 0. Repeated vectors count once in the fit and get a result for
each row; a row without an id keeps its null. There are as many components as asked for, or
as dimensions if these are fewer. A component without variance (all vectors equal along it)
has ``explained`` 0 and ``whitened`` null, and stays out of ``identity_error``, which is
0 if no component has variance. ``deviation`` is null where it does not fit a long. An empty
table, or one of empty vectors, gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm import common
from wattloom.llm.maxscore import integers, matrix

SCALE = 256
COMPONENTS = 4
#: Rows stacked on a triangle before the next reduction, triangles joined by one task.
QR_ROWS = 4096
FAN_IN = 8
EPS = float(np.finfo(float).eps)
#: A squared superdiagonal entry this small against its neighbour is taken as 0.
NEGLIGIBLE = (4 * EPS) ** 2
#: Components whose singular value is below this share of the largest have no variance.
NO_VARIANCE = 1e-12


@dataclass(frozen=True)
class Fit:
    """n distinct vectors, their sums, and the directions of the largest eigenvalues."""

    n: int
    sums: list[int]
    eigenvalues: list[float]
    directions: np.ndarray
    trace: float

    @property
    def means(self) -> np.ndarray:
        return np.array([s / self.n for s in self.sums])


# --- Spark: sums and the triangle ---------------------------------------------


def _exact_sums(rows: np.ndarray) -> list[int]:
    if float(np.abs(rows.astype(float)).max(initial=0.0)) * len(rows) < 2.0**62:
        return [int(s) for s in rows.sum(axis=0)]
    return [int(s) for s in rows.astype(object).sum(axis=0)]


def _sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sum of each dimension."""

    def partial(batch: pa.RecordBatch) -> pa.RecordBatch:
        sums = _exact_sums(matrix(batch.column(0), width))
        return pa.record_batch(
            [
                pa.array(range(width), pa.int32()),
                pa.array([str(s) for s in sums], pa.string()),
                pa.array([batch.num_rows] * width, pa.int64()),
            ],
            names=["dimension", "total", "n"],
        )

    rows = (
        fit.mapInArrow(
            lambda batches: (partial(b) for b in batches if b.num_rows), "dimension int, total string, n long"
        )
        .groupBy("dimension")
        .agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
        .orderBy("dimension")
        .collect()
    )
    return rows[0]["n"], [int(r["total"]) for r in rows]


def _reduced(stack: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(stack), mode="r")


def _pack(triangle: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch([pa.array([triangle.astype("<f8").tobytes()], pa.binary())], names=["r"])


def _unpack(column: pa.Array, width: int) -> list[np.ndarray]:
    return [np.frombuffer(cell.as_buffer(), "<f8").reshape(-1, width) for cell in column]


def _triangle(fit: DataFrame, means: np.ndarray) -> np.ndarray:
    """R of a QR factorisation of all centred rows."""
    width = len(means)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = np.zeros((0, width))
        stack, held = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            stack.append(matrix(batch.column(0), width) - means)
            held += batch.num_rows
            if held >= QR_ROWS:
                triangle, stack, held = _reduced([triangle, *stack]), [], 0
        if stack:
            triangle = _reduced([triangle, *stack])
        if len(triangle):
            yield _pack(triangle)

    def join(table: pa.Table) -> pa.Table:
        return pa.Table.from_batches([_pack(_reduced(_unpack(table.column("r"), width)))])

    level = common.staged(
        fit.mapInArrow(reduce_rows, "r binary").select("r", F.spark_partition_id().alias("k")), "triangles"
    )
    while level.count() > 1:
        joined = level.groupBy(F.floor(F.col("k") / FAN_IN).alias("joined")).applyInArrow(
            lambda key, table: join(table).append_column("k", pa.array([key[0].as_py()], pa.int64())),
            "r binary, k long",
        )
        level = common.staged(joined, "triangles")
    found = level.select("r").toArrow()
    triangle = np.zeros((width, width))
    for part in _unpack(found.column("r"), width):
        triangle[: len(part)] = part
    return triangle


# --- the small dense problem ---------------------------------------------------


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """v and beta with (I - beta v v') x = (±|x|, 0, ...)."""
    norm = float(np.linalg.norm(x))
    if norm == 0.0:
        return np.zeros_like(x), 0.0
    v = x.copy()
    v[0] += norm if x[0] >= 0 else -norm
    return v, 2.0 / float(v @ v)


def bidiagonal(square: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, superdiagonal and right rotation P: square = Q B P'."""
    a = square.copy()
    n = len(a)
    right = np.eye(n)
    for i in range(n):
        v, beta = _reflector(a[i:, i])
        a[i:, i:] -= beta * np.outer(v, v @ a[i:, i:])
        if i < n - 2:
            v, beta = _reflector(a[i, i + 1 :])
            a[i:, i + 1 :] -= beta * np.outer(a[i:, i + 1 :] @ v, v)
            right[:, i + 1 :] -= beta * np.outer(right[:, i + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), right


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One dqds transform, or None if the shift exceeds the smallest eigenvalue."""
    d = q[0] - shift
    least = d
    new_q, new_e = [], []
    for i, coupling in enumerate(e):
        if d < 0.0:
            return None
        total = d + coupling
        ratio = q[i + 1] / total
        new_q.append(total)
        new_e.append(coupling * ratio)
        d = d * ratio - shift
        least = min(least, d)
    if d < 0.0:
        return None
    new_q.append(d)
    return new_q, new_e, least


def singular_values(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal matrix, falling: dqds with deflation.

    Shifts come from the last pivot and its coupling, or from the smallest pivot of the
    sweep before. A shift that is too large shows as a negative pivot; the sweep is then
    done again with a smaller one, at last with 0, which cannot fail.
    """
    scale = max(float(np.abs(diagonal).max(initial=0.0)), float(np.abs(above).max(initial=0.0)))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    squares: list[float] = []
    parts = [([float(x) for x in (diagonal / scale) ** 2], [float(x) for x in (above / scale) ** 2], 0.0)]
    while parts:
        q, e, moved = parts.pop()
        least = min(q)
        for _ in range(100 * len(q) + 100):
            if len(q) == 1 or e[-1] <= NEGLIGIBLE * (moved + q[-1]):
                squares.append(moved + q.pop())
                if not q:
                    break
                e.pop()
                least = min(q)
                continue
            cut = next((i for i, x in enumerate(e) if x <= NEGLIGIBLE * (moved + q[i])), None)
            if cut is not None:
                parts.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                least = min(q)
                continue
            if 1.5 * q[0] < q[-1]:
                q.reverse()
                e.reverse()
            shift = q[-1] - sqrt(q[-1] * e[-1]) if e[-1] < q[-1] / 4 else least / 4
            shift = max(0.0, min(shift, least))
            step = _sweep(q, e, shift)
            while step is None:
                shift = shift / 4 if shift > EPS * max(least, EPS) else 0.0
                step = _sweep(q, e, shift)
            q, e, least = step
            moved += shift
        if q:
            raise ArithmeticError("dqds did not settle")
    return scale * np.sqrt(np.sort(np.array(squares))[::-1])


def _twisted(diagonal: np.ndarray, above: np.ndarray, square: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Twist pivots and the two sets of multipliers of B'B - square * I.

    B'B = L D L' with D the squared diagonal. The stationary transform factorises from the
    top, the progressive one from the bottom; at each index the two meet in a twist.
    """
    n = len(diagonal)
    tiny = EPS * max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)))
    a = np.where(np.abs(diagonal) < tiny, tiny, diagonal)
    pivot, low = a * a, above / a[:-1]
    floor = EPS * EPS * square
    down, up = np.zeros(n - 1), np.zeros(n - 1)
    s, p = np.zeros(n), np.zeros(n)
    s[0] = -square
    for i in range(n - 1):
        d = s[i] + pivot[i]
        d = d if abs(d) > floor else floor
        down[i] = pivot[i] * low[i] / d
        s[i + 1] = down[i] * low[i] * s[i] - square
    p[-1] = pivot[-1] - square
    for i in range(n - 2, -1, -1):
        d = pivot[i] * low[i] * low[i] + p[i + 1]
        d = d if abs(d) > floor else floor
        up[i] = low[i] * (pivot[i] / d)
        p[i] = p[i + 1] * (pivot[i] / d) - square
    return s + p + square, down, up


def _settled(diagonal: np.ndarray, above: np.ndarray, square: float, before: np.ndarray) -> np.ndarray:
    """Inverse iteration for a vector beside others of the same value, kept apart from them.

    The start has a share in every part, so that it finds the part that is left.
    """
    z = 1.5 + np.cos(np.arange(len(diagonal)))
    z -= before @ (before.T @ z)
    full = np.diag(diagonal) + np.diag(above, 1)
    shifted = full.T @ full - square * (1.0 + 4 * EPS) * np.eye(len(diagonal))
    for _ in range(3):
        z = np.linalg.solve(shifted, z)
        z -= before @ (before.T @ z)
        z /= np.linalg.norm(z)
    return z


def right_vectors(diagonal: np.ndarray, above: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Right singular vectors, as columns, of the given singular values.

    The twist with the smallest pivot gives the vector. Values that agree to rounding may
    give the same one again; then the next twists are tried until one leaves something new
    beside the vectors before, and inverse iteration makes up for what that loses.
    """
    n = len(diagonal)
    norm = max(float(np.abs(diagonal).max()), float(np.abs(above).max(initial=0.0)))
    # Couplings within rounding would only leak one part's vector into another.
    above = np.where(np.abs(above) <= 4 * EPS * norm, 0.0, above)
    found = np.zeros((n, 0))
    for value in values:
        square = float(value) ** 2
        pivots, down, up = _twisted(diagonal, above, square)
        best, best_left = np.zeros(n), -1.0
        for k in np.argsort(np.abs(pivots), kind="stable"):
            z = np.zeros(n)
            z[k] = 1.0
            for i in range(k - 1, -1, -1):
                z[i] = -down[i] * z[i + 1]
            for i in range(k, n - 1):
                z[i + 1] = -up[i] * z[i]
            z /= np.linalg.norm(z)
            rest = z - found @ (found.T @ z)
            left = float(np.linalg.norm(rest))
            if left > best_left:
                best, best_left = rest, left
            if left > 0.5:
                break
        best = best / np.linalg.norm(best)
        best -= found @ (found.T @ best)
        image = diagonal * best
        image[:-1] += above * best[1:]
        back = diagonal * image
        back[1:] += above * image[:-1]
        if np.abs(back - square * best).max() > 100 * EPS * norm * norm:
            best = _settled(diagonal, above, square, found)
        found = np.column_stack([found, best / np.linalg.norm(best)])
    return found


# --- the operator ---------------------------------------------------------------


def fit_list(rows: DataFrame) -> tuple[DataFrame, int]:
    """Distinct integer vectors, written once, and their dimension."""
    distinct = common.staged(rows.select("_x").distinct(), "fit-list")
    width = distinct.agg(F.max(F.size("_x"))).first()[0] or 0
    return distinct, width


def fit(distinct: DataFrame, width: int, components: int = COMPONENTS) -> Fit:
    """Directions of the largest eigenvalues of the covariance of distinct vectors."""
    n, sums = _sums(distinct, width)
    triangle = _triangle(distinct, np.array([s / n for s in sums]))
    diagonal, above, right = bidiagonal(triangle)
    values = singular_values(diagonal, above)
    squares = values * values
    if abs(squares.sum() - (triangle * triangle).sum()) > 1e-9 * squares.sum():
        raise ArithmeticError("the singular values do not add up to the variance")
    values = values[: min(components, width)]
    values = np.where(values <= NO_VARIANCE * max(values[0], 0.0), 0.0, values)
    directions = right @ right_vectors(diagonal, above, values[values > 0.0])
    return Fit(n, sums, [float(v) ** 2 / n for v in values], directions, float(squares.sum()) / n)


def _projected(rows: np.ndarray, model: Fit) -> np.ndarray:
    """Whitened coordinates of components with variance, a column each."""
    used = model.directions.shape[1]
    return (rows - model.means) @ model.directions / np.sqrt(np.array(model.eigenvalues[:used]))


def identity_error(distinct: DataFrame, model: Fit) -> float:
    """Largest entry of the covariance of whitened coordinates less the identity."""
    used = model.directions.shape[1]
    if not used:
        return 0.0
    width = len(model.sums)
    names = [f"w{i}" for i in range(used)]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        w = _projected(matrix(batch.column(0), width), model)
        return pa.record_batch([pa.array(c) for c in w.T], names=names)

    w = distinct.mapInArrow(
        lambda batches: (run(b) for b in batches if b.num_rows), ", ".join(f"{c} double" for c in names)
    )
    pairs = [(i, j) for i in range(used) for j in range(i, used)]
    found = w.agg(*[F.covar_pop(names[i], names[j]).alias(f"c{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"c{i}_{j}"] - (1.0 if i == j else 0.0)) for i, j in pairs)


def _deviations(rows: np.ndarray, model: Fit) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2, exactly."""
    largest = float(np.abs(rows.astype(float)).max(initial=0.0)) * model.n + max(map(abs, model.sums), default=0)
    if largest * largest * max(1, rows.shape[1]) < 2.0**62:
        apart = rows * model.n - np.array(model.sums, np.int64)
        return [int(x) for x in (apart * apart).sum(axis=1)]
    apart = rows.astype(object) * model.n - np.array(model.sums, object)
    return [x if x < 1 << 63 else None for x in map(int, (apart * apart).sum(axis=1))]


def whitened(
    vectors: DataFrame,
    components: int = COMPONENTS,
    scale: int = SCALE,
    key: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """Whitened coordinates: vec_id, component, n, deviation, whitened, explained, identity_error."""
    rows = integers(vectors, scale, key, vector)
    layout = (
        "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    )
    distinct, width = fit_list(rows)
    if not width:
        return vectors.sparkSession.createDataFrame([], layout)
    model = fit(distinct, width, components)
    error = identity_error(distinct, model)
    count = len(model.eigenvalues)
    used = model.directions.shape[1]
    explained = [e / model.trace if model.trace else 0.0 for e in model.eigenvalues]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = matrix(batch.column(1), width)
        coordinates = np.full((len(x), count), np.nan)
        coordinates[:, :used] = _projected(x, model)
        flat = coordinates.ravel()
        deviations = pa.array(_deviations(x, model), pa.int64())
        each = np.repeat(np.arange(len(x)), count)
        return pa.record_batch(
            [
                batch.column(0).take(pa.array(each)),
                pa.array(np.tile(np.arange(1, count + 1), len(x)), pa.int32()),
                pa.array(np.full(len(flat), model.n), pa.int64()),
                deviations.take(pa.array(each)),
                pa.array(flat, mask=np.isnan(flat)),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(len(flat), error)),
            ],
            names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
        )

    return rows.mapInArrow(lambda batches: (run(b) for b in batches if b.num_rows), layout)
