"""Embedding whitening: principal components of the distinct vectors, projected and scaled to unit variance.

An entry c becomes the long x = floor(256 * c). The fit list holds each distinct x
vector once, so a vector that a third of all rows share counts like any other. Its sums
and its centred covariance are added up by numpy in the tasks and summed in a tree of
bounded groups, in a fixed order; only statistics (one dimension x dimension matrix)
reach the driver. There Householder reflections make the matrix tridiagonal,
bisection on Sturm counts finds the leading eigenvalues, inverse iteration their
vectors (those of eigenvalues that lie close together are made orthogonal to each
other), and the reflections take them back. Components, means and scales go to
all tasks as a few rows of numbers, which project every row. The covariance of the
whitened fit list is measured by a further pass.

Rows drop whose vector is null, has null, NaN or infinite entries, or an entry with
|x| of ``LIMIT`` or more (whose integers a double can't hold). Vectors must be of one length:
if they are not, the most frequent length counts (ties: the longest), and rows of
another length drop. Directions without variance (eigenvalue at most ``NO_VARIANCE`` of
the trace) have no component; if there is none at all, or no vector, the result is empty.
Repeated rows and null ids are projected like others. ``deviation`` is null where it
doesn't fit a long. Further columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hourcast.llm.common import pick, prepare
from hourcast.sinks.util import materialize

SCALE = 256
COMPONENTS = 4
LIMIT = 1 << 53
NO_VARIANCE = 1e-14
#: Eigenvalues closer than this part of the largest one form a cluster.
CLUSTER = 1e-3
#: Partial results that one group of the summing tree adds up.
FAN = 32
EPS = np.finfo(np.float64).eps


# ---- eigenvectors of a symmetric matrix ---------------------------------------------

def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflectors): Householder reflections of the symmetric matrix ``a``.

    Reflector k is a unit vector over the rows k + 1 to the end (all zero: no reflection).
    """
    a = np.array(a, dtype=np.float64)
    n, reflectors = len(a), []
    for k in range(n - 2):
        x = a[k + 1:, k].copy()
        size = np.linalg.norm(x)
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        norm = np.linalg.norm(v)
        if not np.any(x[1:]) or not norm:
            reflectors.append(np.zeros_like(x))
            continue
        v /= norm
        reflectors.append(v)
        below = a[k + 1:, k + 1:]
        p = below @ v
        w = p - (v @ p) * v
        below -= 2 * (np.outer(v, w) + np.outer(w, v))
        a[k + 1:, k] = a[k, k + 1:] = 0
        a[k + 1, k] = a[k, k + 1] = -np.copysign(size, x[0])
    return np.diag(a).copy(), np.diag(a, -1).copy(), reflectors


def sturm_count(d: np.ndarray, e2: np.ndarray, x: np.ndarray, tiny: float) -> np.ndarray:
    """Eigenvalues below each of ``x``: the negative pivots of T - x (``e2``: squares of the off-diagonal)."""
    below, q = np.zeros(len(x), dtype=np.int64), np.inf
    for i in range(len(d)):
        q = d[i] - x - (e2[i - 1] / q if i else 0)
        q = np.where(np.abs(q) < tiny, -tiny, q)
        below += q < 0
    return below


def leading_eigenvalues(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues of the tridiagonal matrix, falling, by bisection on Sturm counts."""
    n = len(d)
    reach = np.abs(np.append(e, 0)) + np.abs(np.insert(e, 0, 0))
    low, high = np.full(k, (d - reach).min()), np.full(k, (d + reach).max())
    size = max(abs(low[0]), abs(high[0]), np.finfo(np.float64).tiny)
    low, high = low - 2 * EPS * size, high + 2 * EPS * size
    rank = n - 1 - np.arange(k)  # eigenvalues below the one sought
    tiny = max(EPS * EPS * size, np.finfo(np.float64).tiny)
    e2 = e * e
    for _ in range(2000):
        middle = (low + high) / 2
        if np.all((high - low <= EPS * np.maximum(np.abs(low), np.abs(high))) | (middle <= low) | (middle >= high)):
            break
        up = sturm_count(d, e2, middle, tiny) > rank
        high, low = np.where(up, middle, high), np.where(up, low, middle)
    return (low + high) / 2


def solve_shifted(d: np.ndarray, e: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """x with (T - shift) x = b, by elimination with row exchanges; pivots of zero become ``tiny``."""
    n = len(d)
    u0, u1, u2, b = np.zeros(n), np.zeros(n), np.zeros(n), b.astype(np.float64)
    row = (d[0] - shift, e[0] if n > 1 else 0.0, 0.0)
    for i in range(n - 1):
        following = (e[i], d[i + 1] - shift, e[i + 1] if i + 2 < n else 0.0)
        if abs(following[0]) > abs(row[0]):
            row, following = following, row
            b[i], b[i + 1] = b[i + 1], b[i]
        first = row[0] if abs(row[0]) > tiny else tiny
        u0[i], u1[i], u2[i] = first, row[1], row[2]
        f = following[0] / first
        row = (following[1] - f * row[1], following[2] - f * row[2], 0.0)
        b[i + 1] -= f * b[i]
    u0[n - 1] = row[0] if abs(row[0]) > tiny else tiny
    x = np.zeros(n + 2)
    for i in range(n - 1, -1, -1):
        x[i] = (b[i] - u1[i] * x[i + 1] - u2[i] * x[i + 2]) / u0[i]
        if abs(x[i]) > 1e200:  # only the direction matters
            x /= 1e200
            b[:i] /= 1e200
    return x[:n]


def eigenvectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit vectors (rows) of the tridiagonal matrix for ``values`` (falling), by inverse iteration."""
    size = max(np.abs(d).max() + 2 * np.abs(e).max(initial=0), np.finfo(np.float64).tiny)
    tiny, found, first, last = EPS * size, [], 0, None
    r = np.random.default_rng(0)
    for k, value in enumerate(values):
        if k and values[k - 1] - value > CLUSTER * size:
            first, last = k, None
        # equal eigenvalues get shifts a little apart
        shift = value if last is None else min(value, last - 8 * EPS * size)
        last = shift
        x = r.uniform(0.5, 1.0, len(d)) * r.choice([-1.0, 1.0], len(d))
        for _ in range(6):
            for _ in range(2):  # twice is enough
                for y in found[first:]:
                    x = x - (x @ y) * y
            x = solve_shifted(d, e, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
        for _ in range(2):
            for y in found[first:]:
                x = x - (x @ y) * y / (y @ y)
            x /= np.linalg.norm(x)
        found.append(x)
    return np.array(found).reshape(len(values), len(d))


def leading_components(v: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit vectors as rows) of the symmetric matrix ``v``: the ``k`` largest, those without variance left out."""
    d, e, reflectors = tridiagonal(v)
    values = leading_eigenvalues(d, e, min(k, len(d)))
    values = values[values > NO_VARIANCE * max(np.trace(v), 0)]
    vectors = eigenvectors(d, e, values)
    for j in range(len(reflectors) - 1, -1, -1):
        u = reflectors[j]
        vectors[:, j + 1:] -= 2 * np.outer(vectors[:, j + 1:] @ u, u)
    return values, vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


# ---- distributed statistics ---------------------------------------------------------

def _matrix(column: pa.Array, width: int, dtype) -> np.ndarray:
    """The rows of a batch's list column (all of length ``width``) as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False).reshape(len(column), width)


def _add_up(parts: DataFrame) -> DataFrame:
    """Rows (task, row, values): sums of ``values`` by ``row`` over all tasks.

    Up to ``FAN`` neighbouring tasks are added at a time, in order of task, so no group
    grows with the input and the doubles' sum doesn't depend on timing.
    """
    parts = materialize(parts, "partial_sums")
    tasks = (parts.agg(F.max("task")).first()[0] or 0) + 1
    kind = parts.schema["values"].dataType.simpleString()

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        rows = np.array(table.column("values").to_pylist())
        total = rows[0].copy()
        for r in rows[1:]:
            total += r
        task = table.column("task")[0].as_py() // FAN
        return pa.table({"task": pa.array([task], pa.int32()), "row": table.column("row")[:1],
                         "values": pa.array([total], table.schema.field("values").type)})

    while tasks > 1:
        parts = parts.groupBy("row", F.floor(F.col("task") / FAN)).applyInArrow(add, f"task int, row int, values {kind}")
        tasks = -(-tasks // FAN)
    return parts


def _by_task(df: DataFrame, make, kind: str) -> DataFrame:
    """(task, row, values) of ``make``, which turns a task's batches into a matrix of sums (None: no rows)."""
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        total = make(it)
        if total is None:
            return
        task = TaskContext.get().partitionId()
        for a in range(0, len(total), 64):
            part = total[a:a + 64]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(part), task, dtype=np.int32)), pa.array(np.arange(a, a + len(part), dtype=np.int32)),
                 pa.array(list(part), pa.list_(pa.int64() if kind == "bigint" else pa.float64()))], names=["task", "row", "values"])

    return df.mapInArrow(run, f"task int, row int, values array<{kind}>")


def _collect(sums: DataFrame) -> np.ndarray:
    return np.array([r["values"] for r in sorted(sums.collect(), key=lambda r: r["row"])])


def sums(fit: DataFrame, width: int) -> tuple[int, list[int]]:
    """(n, exact sums) of the fit list's vectors ``x``."""
    def make(it):
        total, seen = np.zeros((3, width), dtype=np.int64), False
        for batch in it:
            if not len(batch):
                continue
            seen, x = True, _matrix(batch.column("x"), width, np.int64)
            total += np.array([np.full(width, len(x)), (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)])  # can't overflow
        return total if seen else None

    n, high, low = _collect(_add_up(_by_task(fit, make, "bigint"))).tolist()
    return n[0], [(a << 32) + b for a, b in zip(high, low, strict=True)]


def covariance(fit: DataFrame, mean: np.ndarray, n: int) -> np.ndarray:
    """Covariance of the fit list, centred before multiplying."""
    def make(it):
        total = None
        for batch in it:
            if len(batch):
                c = _matrix(batch.column("x"), len(mean), np.float64) - mean
                total = c.T @ c if total is None else total + c.T @ c
        return total

    v = _collect(_add_up(_by_task(fit, make, "double"))) / n
    return (v + v.T) / 2


def _project(x: np.ndarray, mean: np.ndarray, vectors: np.ndarray, scales: np.ndarray) -> np.ndarray:
    """Whitened rows; a row's result doesn't depend on its batch."""
    return np.einsum("ij,kj->ik", x.astype(np.float64) - mean, vectors) / scales


def deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - S)^2 of every row, exact; None where it exceeds a long."""
    s = np.array(total, dtype=object)
    most = max((abs(int(x.min(initial=0))), abs(int(x.max(initial=0))))) * n + max(map(abs, total))
    if most * most * len(total) < 1 << 63:
        d = n * x - s.astype(np.int64)
        return (d * d).sum(axis=1).tolist()
    d = x.astype(object) * n - s
    return [int(v) if v < 1 << 63 else None for v in (d * d).sum(axis=1)]


def whiten(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error): a row for every row of ``df`` and component."""
    spark = df.sparkSession
    prepare(spark)
    d = pick(df, id=id_col, c=vector_col)
    scaled = F.transform("c", lambda c: c.cast("double") * SCALE)
    sound = F.forall("s", lambda s: s.isNotNull() & ~F.isnan(s) & (F.abs(s) < LIMIT))
    d = d.withColumn("s", scaled).where(F.col("c").isNotNull() & sound)
    d = d.select("id", F.transform("s", lambda s: F.floor(s).cast("long")).alias("x"))
    d = materialize(d.withColumn("width", F.size("x")), "scaled_vectors")
    schema = (f"id {d.schema['id'].dataType.simpleString()}, component int, n long, deviation long, whitened double, "
              "explained double, identity_error double")
    none = spark.createDataFrame([], schema)
    widths = d.groupBy("width").count().agg(F.max(F.struct("count", "width"))["width"]).first()[0]
    if not widths:
        return none
    d = d.where(F.col("width") == widths).select("id", "x")
    fit = materialize(d.select("x").distinct(), "fit_list")
    n, total = sums(fit, widths)
    mean = np.array([s / n for s in total])
    v = covariance(fit, mean, n)
    values, vectors = leading_components(v, components)
    if not len(values):
        return none
    scales, explained, k = np.sqrt(values), values / np.trace(v), len(values)

    def second(it):
        out = None
        for batch in it:
            if len(batch):
                w = _project(_matrix(batch.column("x"), widths, np.int64), mean, vectors, scales)
                part = np.vstack([w.sum(axis=0), w.T @ w])
                out = part if out is None else out + part
        return out

    moments = _collect(_add_up(_by_task(fit, second, "double"))) / n
    error = float(np.abs(moments[1:] - np.outer(moments[0], moments[0]) - np.eye(k)).max())

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = len(batch)
            if not rows:
                continue
            x = _matrix(batch.column("x"), widths, np.int64)
            each = np.repeat(np.arange(rows), k)
            yield pa.RecordBatch.from_arrays([
                batch.column("id").take(pa.array(each)), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, n)), pa.array(deviations(x, n, total), pa.int64()).take(pa.array(each)),
                pa.array(_project(x, mean, vectors, scales).ravel()), pa.array(np.tile(explained, rows)),
                pa.array(np.full(rows * k, error))],
                names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return d.mapInArrow(run, schema)
