"""Embedding whitening by a bidiagonal qd solver.

Vectors become whole numbers, x = floor(64 c) + 1,000,000.  The fit list holds each
distinct vector once.  Each task reduces its centred rows (x - S/n) by blockwise QR to
one triangle; triangles are stacked and reduced again, FAN_IN at a time, in Spark, so
the driver gets at most FAN_IN of them, whatever the number of rows.  The last triangle
is made bidiagonal by Householder reflections; dqds finds its singular values to high
relative accuracy; twisted factorisations of the shifted L D L' give the directions.
Only these steps on a dims x dims triangle run on the driver.

Defined cases: a vector that is null, or holds a null or non-finite entry or one whose x
does not fit a long, is left out; so are vectors of a length other than the most frequent
(of equally frequent ones the longest), and empty ones.  Repeated rows and ids keep a row
each; null ids stay null.  An empty table, and one whose vectors are all equal, gives no
rows.  Components without variance (singular values below the rounding error of the
largest) cannot be scaled to one and are not returned.  ``deviation`` is exact, and null
where it does not fit a long.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import pin

SCALE, OFFSET = 64, 1_000_000
FAN_IN = 64  # triangles that one task, or the driver, stacks at once
BLOCK = 1 << 19  # numbers of a block that is reduced at once
EPS = np.finfo(np.float64).eps


def whole_numbers(vector: Column) -> Column:
    """The x of each entry; null if the vector has no usable entries."""
    largest = float(2**62 // SCALE)
    entry = lambda c: F.floor(c.cast("double") * SCALE) + F.lit(OFFSET).cast("long")
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < largest, F.lit(False)))
    return F.when(usable & (F.size(vector) > 0), F.transform(vector, entry))


def vectors_of(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, x)`` of the usable rows, as a stable table."""
    found = rows.select(F.col(id_col).alias("vec_id"), whole_numbers(F.col(vector_col)).alias("x")).where("x IS NOT NULL")
    found = pin(found, "whitening-rows")
    sizes = found.groupBy(F.size("x").alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return found.where(F.size("x") == (sizes[0]["dims"] if sizes else 0))


def _matrix(batch: pa.RecordBatch, column: str = "x") -> np.ndarray:
    """The vectors of a batch, one a row."""
    lists = batch.column(batch.schema.get_field_index(column))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            x = _matrix(batch)
            step = max(1, BLOCK // x.shape[1])
            yield from (x[at : at + step] for at in range(0, len(x), step))


def _centre(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    """S/n as whole part and rest, so that x - S/n keeps the digits of x."""
    whole = [s // n for s in sums]
    rest = [float(Fraction(s - w * n, n)) for s, w in zip(sums, whole)]
    return np.array(whole, np.int64), np.array(rest)


def _centred(x: np.ndarray, centre: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    return (x - centre[0]).astype(np.float64) - centre[1]


def _sums(fit: DataFrame) -> tuple[int, tuple[int, ...]]:
    """Rows, and exact sums by place: a task sends one row a place."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for x in _blocks(batches):
            # Halves of 31 bits: no sum of a block can leave a long.
            own = [(int(h) << 31) + int(l) for h, l in zip((x >> 31).sum(axis=0), (x & 0x7FFFFFFF).sum(axis=0))]
            total = own if total is None else [a + b for a, b in zip(total, own)]
            n += len(x)
        if total is not None:
            places = pa.array(range(len(total)), pa.int32())
            digits = pa.array([str(t) for t in total], pa.string())
            yield pa.RecordBatch.from_arrays([places, pa.array([n] * len(total), pa.int64()), digits], ["place", "n", "total"])

    parts = fit.select("x").mapInArrow(add, "place int, n long, total string")
    total = F.sum(F.col("total").cast("decimal(38,0)"))
    rows = parts.groupBy("place").agg(F.sum("n").alias("n"), total.alias("total")).orderBy("place").collect()
    return (rows[0]["n"] if rows else 0), tuple(int(r["total"]) for r in rows)


def _triangle(rows: np.ndarray) -> np.ndarray:
    """R of a QR factorisation, always square."""
    r = np.linalg.qr(rows, mode="r")
    return np.vstack([r, np.zeros((rows.shape[1] - len(r), rows.shape[1]))])


def reduced_triangle(fit: DataFrame, dims: int, centre: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """R with R'R = sum of outer products of the centred rows."""
    schema = "task int, triangle binary"

    def row(task: int, r: np.ndarray) -> dict:
        return {"task": pa.array([task], pa.int32()), "triangle": pa.array([r.tobytes()], pa.binary())}

    def read(raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, np.float64).reshape(dims, dims)

    def reduce_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        r = None
        for x in _blocks(batches):
            block = _centred(x, centre)
            r = _triangle(block if r is None else np.vstack([r, block]))
        if r is not None:
            yield pa.RecordBatch.from_pydict(row(TaskContext.get().partitionId(), r))

    def stack(table: pa.Table) -> pa.Table:
        parts = sorted(zip(table["task"].to_pylist(), table["triangle"].to_pylist()))
        r = None
        for _, raw in parts:
            r = _triangle(read(raw) if r is None else np.vstack([r, read(raw)]))
        return pa.table(row(parts[0][0] // FAN_IN, r))

    parts = pin(fit.select("x").mapInArrow(reduce_rows, schema), "whitening-triangles")
    most = parts.agg(F.max("task")).first()[0]
    while most is not None and most >= FAN_IN:  # task numbers shrink by FAN_IN a round
        parts = pin(parts.groupBy(F.floor(F.col("task") / FAN_IN)).applyInArrow(stack, schema), "whitening-triangles")
        most //= FAN_IN
    found = sorted((p["task"], bytes(p["triangle"])) for p in parts.collect())
    return _triangle(np.vstack([read(raw) for _, raw in found]))


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(a, b, v)``: R = U B V' with B upper bidiagonal, diagonal a and superdiagonal b."""
    m, n = np.array(r, np.float64), len(r)
    v = np.eye(n)

    def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
        size = np.linalg.norm(x)
        u = x.copy()
        u[0] += np.copysign(size, x[0])
        length = np.linalg.norm(u)
        return (u / length if length else u), -np.copysign(size, x[0])

    for k in range(n):
        u, m[k, k] = reflector(m[k:, k])
        m[k + 1 :, k] = 0
        m[k:, k + 1 :] -= 2 * np.outer(u, u @ m[k:, k + 1 :])
        if k + 1 < n:
            u, m[k, k + 1] = reflector(m[k, k + 1 :])
            m[k, k + 2 :] = 0
            m[k + 1 :, k + 1 :] -= 2 * np.outer(m[k + 1 :, k + 1 :] @ u, u)
            v[:, k + 1 :] -= 2 * np.outer(v[:, k + 1 :] @ u, u)
    return np.diag(m).copy(), np.diag(m, 1).copy(), v


def _dqds(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, float, int]:
    """One shifted qd transform without subtractions but the shift: new q and e, the least d, and where it is."""
    n = len(q)
    new_q, new_e = np.empty(n), np.empty(n - 1)
    d = q[0] - shift
    least, at = d, 0
    for k in range(n - 1):
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k] if new_q[k] else 0.0
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
        if d < least:
            least, at = d, k + 1
    new_q[n - 1] = d
    return new_q, new_e, least, at


def squared_singular_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix by dqds, falling."""
    found: list[float] = []
    scale = max([*np.abs(a), *np.abs(b), 0.0])
    if not scale:
        return np.zeros(len(a))
    work = [((a / scale) ** 2, (b / scale) ** 2, 0.0)]
    while work:
        q, e, moved = work.pop()
        if len(q) > 1 and q[0] < q[-1]:
            q, e = q[::-1].copy(), e[::-1].copy()  # the transposed factor turned round: the same singular values
        for _ in range(60 * len(q) + 60):
            if len(q) == 1:
                found.append(moved + q[0])
                break
            small = np.flatnonzero(e <= EPS**2 * (moved + np.minimum(q[:-1], q[1:])) + 1e-300)
            if len(small):
                cut = int(small[-1]) + 1
                work.append((q[:cut].copy(), e[: cut - 1].copy(), moved))
                q, e = q[cut:], e[cut:]
                continue
            if e[-1] <= EPS**2 * moved and q[-1] <= EPS * moved:
                found.append(moved + q[-1])
                q, e = q[:-1], e[:-1]
                continue
            # Least eigenvalue of the last two rows, an upper bound that is close near convergence.
            half, low = (q[-2] + e[-1] + q[-1]) / 2, q[-2] * q[-1]
            shift = low / (half + np.sqrt(max(half * half - low, 0.0))) if half else 0.0
            for tried in range(4):
                new_q, new_e, least, at = _dqds(q, e, shift)
                if least >= 0:
                    break
                # Failing in the last place alone, shift plus that negative d is below the least eigenvalue.
                late = shift + least if at == len(q) - 1 and shift + least > 0 else 0.0
                shift = late if tried == 0 else shift / 8 if tried == 1 else 0.0
            q, e, moved = np.maximum(new_q, 0.0), new_e, moved + shift
        else:
            raise RuntimeError("dqds did not converge")
    return np.sort(np.maximum(found, 0.0))[::-1] * scale**2


def _twisted(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Twisted factorisations of B'B - value: gammas, and the factors below and above each twist."""
    n = len(a)
    d, low = a * a, b / a[:-1]
    s, p = np.empty(n), np.empty(n)
    lower, upper = np.empty(n - 1), np.empty(n - 1)
    tiny = 1e-290
    s[0] = -value
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot = pivot if abs(pivot) > tiny else -tiny
        lower[k] = d[k] * low[k] / pivot
        s[k + 1] = lower[k] * low[k] * s[k] - value
    p[-1] = d[-1] - value
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else -tiny
        ratio = d[k] / pivot
        upper[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - value
    return s + p + value, lower, upper


def _vector(lower: np.ndarray, upper: np.ndarray, twist: int) -> np.ndarray:
    z = np.zeros(len(lower) + 1)
    z[twist] = 1.0
    for k in range(twist - 1, -1, -1):
        z[k] = -lower[k] * z[k + 1]
    for k in range(twist, len(lower)):
        z[k + 1] = -upper[k] * z[k]
    return z / np.linalg.norm(z)


def directions(a: np.ndarray, b: np.ndarray, values: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvectors of B'B (columns) for its largest values, and those values refined by Rayleigh corrections.

    Values closer than a thousandth share a cluster: a vector that is nearly one already
    found is taken from another twist, and the cluster is made orthogonal.
    """
    n = len(a)
    floor = max(np.abs(a).max(), np.abs(b).max() if n > 1 else 0.0) * 1e-30
    a = np.where(np.abs(a) < floor, floor, a)
    found = np.zeros((n, most))
    out = values[:most].copy()
    for c in range(most):
        if n == 1:
            found[0, 0] = 1.0
            continue
        near = [k for k in range(c) if abs(values[k] - values[c]) <= 1e-3 * values[k]]
        value = values[c]
        for _ in range(3):
            gammas, lower, upper = _twisted(a, b, value)
            twist = int(np.argmin(np.abs(gammas)))
            z = _vector(lower, upper, twist)
            step = gammas[twist] * z[twist] ** 2
            if abs(step) <= 2 * EPS * abs(value) or abs(step) > 1e-8 * abs(value):
                break
            value += step
        for twist in np.argsort(np.abs(gammas), kind="stable"):
            z = _vector(lower, upper, int(twist))
            for _ in range(2):
                z = z - found[:, near] @ (found[:, near].T @ z)
            if not near or np.linalg.norm(z) > 0.1:
                break
        found[:, c], out[c] = z / np.linalg.norm(z), value
    return found, out


@dataclass(frozen=True)
class Whitening:
    """Rows and sums of the fit list, its components (a row each) with their eigenvalues, and the trace."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float


def fit(vectors: DataFrame, components: int = 16) -> tuple[Whitening, DataFrame]:
    """The whitening of the distinct vectors of ``vectors_of``, and the fit list (a pinned table)."""
    distinct = pin(vectors.select("x").distinct(), "whitening-fit")
    n, sums = _sums(distinct)
    dims = len(sums)
    if not n:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0), distinct
    a, b, v = bidiagonal(reduced_triangle(distinct, dims, _centre(n, sums)))
    values = squared_singular_values(a, b)
    kept = min(components, int((values > values[0] * (dims * EPS) ** 2 * 16).sum()) if values[0] > 0 else 0)
    z, refined = directions(a, b, values, kept) if kept else (np.zeros((dims, 0)), np.zeros(0))
    axes = (v @ z).T
    signs = np.sign(axes[np.arange(kept), np.abs(axes).argmax(axis=1)]) if kept else np.zeros(0)
    return Whitening(n, sums, axes * signs[:, None], refined / n, float(values.sum()) / n), distinct


def _scaled(model: Whitening) -> np.ndarray:
    return (model.components / np.sqrt(model.eigenvalues)[:, None]).T


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of the whitened fit list minus the identity."""
    k = len(model.eigenvalues)
    if not k:
        return 0.0
    centre, map_ = _centre(model.n, model.sums), _scaled(model)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for x in _blocks(batches):
            z = _centred(x, centre) @ map_
            total += np.vstack([z.T @ z, z.sum(axis=0)])
        places = pa.array(range(total.size), pa.int32())
        yield pa.RecordBatch.from_arrays([places, pa.array(total.ravel())], ["place", "total"])

    sums = distinct.select("x").mapInArrow(add, "place int, total double").groupBy("place").agg(F.sum("total").alias("total"))
    flat = np.zeros((k + 1) * k)
    for row in sums.collect():  # (k + 1) k numbers
        flat[row["place"]] = row["total"] / model.n
    moments = flat.reshape(k + 1, k)
    covariance = moments[:k] - np.outer(moments[k], moments[k])
    return float(np.abs(covariance - np.eye(k)).max())


def _deviations(x: np.ndarray, n: int, sums: tuple[int, ...]) -> list[int | None]:
    """Sums over places of (n x - S)^2, exactly."""
    most = max(max(abs(int(x[:, k].max()) * n - s), abs(int(x[:, k].min()) * n - s)) for k, s in enumerate(sums))
    if most * most * len(sums) < 2**63 and n < 2**31 and max(abs(int(x.max())), abs(int(x.min()))) * n < 2**62 and max(map(abs, sums)) < 2**62:
        off = x * np.int64(n) - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [d if d < 2**63 else None for d in exact]


def whiten(rows: DataFrame, components: int = 16, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` of each usable row and component."""
    vectors = vectors_of(rows, id_col, vector_col)
    model, distinct = fit(vectors, components)
    error, k = identity_error(distinct, model), len(model.eigenvalues)
    id_type = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    centre = _centre(model.n, model.sums) if model.n else None
    map_, explained = _scaled(model), model.eigenvalues / model.trace if k else np.zeros(0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not k or not batch.num_rows:
                continue
            x = _matrix(batch)
            step = max(1, BLOCK // x.shape[1])
            for at in range(0, len(x), step):
                part = x[at : at + step]
                z = _centred(part, centre) @ map_
                m = len(part)
                ids = batch.column(0).slice(at, m).take(pa.array(np.repeat(np.arange(m), k)))
                off = pa.array(_deviations(part, model.n, model.sums), pa.int64()).take(pa.array(np.repeat(np.arange(m), k)))
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, model.n, np.int64)),
                        off,
                        pa.array(z.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return vectors.select("vec_id", "x").mapInArrow(run, schema)
