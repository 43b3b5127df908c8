"""Whitening of vectors: leading eigenvectors of their covariance by a block Jacobi-Davidson method.

The covariance is never formed.  ``V @ U`` for a block of vectors ``U`` is a job that centres every
vector before multiplying and adds up ``(x - mean) ((x - mean) . U)``; the driver holds only blocks of
``dimensions x components`` numbers.  Each outer step takes Ritz pairs from the subspace, locks the leading ones
whose residuals have reached double precision, solves the projected correction equations
``(I - QQ')(V - theta)(I - QQ') t = -r`` of all others by some steps of MINRES, which share their
products, and adds the corrections to the subspace.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F, types as T

from panelflow.session import materialize

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 32
# Larger entries are no numbers that a long could count with; see ``usable_vectors``.
LARGEST = float(1 << 46)
EPS = float(np.finfo(np.float64).eps)
# Residuals count as double precision below so many units of rounding of the largest eigenvalue.
ROUNDING = 16
# Steps of MINRES at most per correction; the first ones are solved roughly, later ones ever better.
INNER_STEPS = 6
OUTER_STEPS = 300
# Rows multiplied at once.
ROWS = 4096


def usable_vectors(df: DataFrame, vector_col: str = "embedding", carry: list[str] | None = None) -> DataFrame:
    """``carry`` columns with ``_x``: ``floor(64 * entry)`` of every entry as packed integers, and ``_d``, their number.

    Rows whose vector is null, empty, or holds a null, a non-finite or an entry of 2^46 or more in size are left out.
    """
    kept = [f for f in df.schema if f.name in (carry or [])]
    entries = F.col(f"`{vector_col}`").cast("array<double>")
    good = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LARGEST))
    names = [f.name for f in kept]

    def run(batches):
        for batch in batches:
            lists = batch.column(0)
            sizes = np.asarray(pc.list_value_length(lists))
            x = np.floor(SCALE * np.asarray(lists.flatten())).astype(np.int64)
            ends = np.cumsum(np.concatenate([[0], sizes]))
            packed = [part.astype("<i4" if not len(part) or np.abs(part).max() < 1 << 31 else "<i8") for part in np.split(x, ends[1:-1])]
            columns = [*batch.columns[1:], pa.array([p.tobytes() for p in packed], pa.binary()), pa.array(sizes, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "_x", "_d"])

    slim = df.filter(F.col(f"`{vector_col}`").isNotNull() & (F.size(f"`{vector_col}`") > 0) & good)
    slim = slim.select(entries.alias("_0"), *[F.col(f"`{n}`") for n in names])
    return slim.mapInArrow(run, T.StructType([*kept, T.StructField("_x", T.BinaryType()), T.StructField("_d", T.IntegerType())]))


def _matrix(packed: pa.BinaryArray, d: int) -> np.ndarray:
    """Rows of ``usable_vectors`` as int64."""
    values = packed.to_pylist()
    if not values:
        return np.zeros((0, d), dtype=np.int64)
    if all(len(v) == 4 * d for v in values):
        return np.frombuffer(b"".join(values), "<i4").reshape(-1, d).astype(np.int64)
    return np.stack([np.frombuffer(v, "<i4" if len(v) == 4 * d else "<i8").astype(np.int64) for v in values])


def _parts(batch: pa.RecordBatch, d: int):
    for at in range(0, batch.num_rows, ROWS):
        yield _matrix(batch.column(batch.schema.get_field_index("_x")).slice(at, ROWS), d)


def _added(rows: DataFrame, d: int, size: int, term: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``term`` (``size`` doubles) over all vectors: added up per task, then per number across tasks."""

    def run(batches):
        total = np.zeros(size)
        for batch in batches:
            for x in _parts(batch, d):
                total += term(x)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], names=["i", "v"])

    found = rows.select("_x").mapInArrow(run, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(size)
    out[found["i"].to_numpy()] = found["v"].to_numpy()
    return out


def _integer_sums(rows: DataFrame, d: int) -> list[int]:
    """Exact sums of every dimension."""

    def run(batches):
        total = [0] * d
        for batch in batches:
            for x in _parts(batch, d):
                total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        texts = pa.array(list(map(str, total)), pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), texts], names=["i", "v"])

    parts = rows.select("_x").mapInArrow(run, "i int, v string").withColumn("v", F.col("v").cast("decimal(38,0)"))
    found = parts.groupBy("i").agg(F.sum("v").alias("v")).collect()
    return [int(v) for _, v in sorted((r.i, r.v) for r in found)]


def _orthonormal(new: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """An orthonormal base of ``new`` outside ``against``; directions that vanish are left out."""
    new = new[:, np.linalg.norm(new, axis=0) > 0]
    new = new / np.linalg.norm(new, axis=0)
    base = np.concatenate([*against, np.zeros((len(new), 0))], axis=1)
    out = []
    for column in new.T:
        for _ in range(3):
            column = column - base @ (base.T @ column)
            size = np.linalg.norm(column)
            if size < 1e-10:
                break
            column = column / size
        else:
            out.append(column)
            base = np.concatenate([base, column[:, None]], axis=1)
    return np.array(out).T if out else np.zeros((len(new), 0))


def minres(multiply: Callable[[np.ndarray], np.ndarray], right: np.ndarray, tolerance: float, steps: int) -> np.ndarray:
    """Approximate solutions of ``A x = b`` for symmetric ``A``, each column by itself, with shared products."""
    k = right.shape[1]
    x, v, v_old = np.zeros_like(right), right.copy(), np.zeros_like(right)
    beta = np.linalg.norm(v, axis=0)
    first = np.where(beta > 0, beta, 1.0)
    eta, left = beta.copy(), beta.copy()
    c, c_old, s, s_old = np.ones(k), np.ones(k), np.zeros(k), np.zeros(k)
    w, w_old = np.zeros_like(right), np.zeros_like(right)
    for _ in range(steps):
        going = (beta > EPS * first) & (left > tolerance * first)
        if not going.any():
            break
        v = np.where(going, v / np.where(beta > 0, beta, 1.0), 0.0)
        new = multiply(v)
        alpha = (v * new).sum(axis=0)
        new = new - alpha * v - beta * v_old
        beta_new = np.linalg.norm(new, axis=0)
        delta = c * alpha - c_old * s * beta
        r1, r2, r3 = np.hypot(delta, beta_new), s * alpha + c_old * c * beta, s_old * beta
        going &= r1 > 0
        safe = np.where(going, r1, 1.0)
        c_old, s_old = np.where(going, c, c_old), np.where(going, s, s_old)
        c, s = np.where(going, delta / safe, c), np.where(going, beta_new / safe, s)
        w_new = (v - r3 * w_old - r2 * w) / safe
        x = x + np.where(going, c * eta * w_new, 0.0)
        w_old, w = np.where(going, w, w_old), np.where(going, w_new, w)
        eta = np.where(going, -s * eta, eta)
        left = np.where(going, np.abs(eta), left)
        v_old, v, beta = v, new, np.where(going, beta_new, 0.0)
    return x


def leading_eigenpairs(multiply: Callable[[np.ndarray], np.ndarray], d: int, k: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """``(values, vectors, outer steps)``: the ``k`` largest eigenvalues of the symmetric ``multiply``, falling.

    Locked vectors are multiplied once more at the end; if a residual is then above the limit, the
    search goes on from them.
    """
    start = np.random.default_rng(seed).standard_normal((d, min(k, d)))
    locked, values, largest = np.zeros((d, 0)), np.zeros(0), 0.0
    space = _orthonormal(start)
    products = multiply(space)
    room = max(3 * k, k + 8)
    for outer in range(1, OUTER_STEPS + 1):
        inner = space.T @ products
        theta, turn = np.linalg.eigh((inner + inner.T) / 2)
        theta, turn = theta[::-1], turn[:, ::-1]
        space, products = space @ turn, products @ turn
        largest = max(largest, float(np.abs(theta).max(initial=0.0)))
        limit = ROUNDING * EPS * largest * np.sqrt(d)
        wanted = min(k - locked.shape[1], space.shape[1])
        residuals = products[:, :wanted] - space[:, :wanted] * theta[:wanted]
        residuals -= locked @ (locked.T @ residuals)
        sizes = np.linalg.norm(residuals, axis=0)
        ready = int(np.argmax(np.append(sizes > limit, True)))
        locked, values = np.concatenate([locked, space[:, :ready]], axis=1), np.concatenate([values, theta[:ready]])
        space, products, theta, residuals = space[:, ready:], products[:, ready:], theta[ready:], residuals[:, ready:]
        if locked.shape[1] == min(k, d):
            again = multiply(locked)
            inner = locked.T @ again
            values, turn = np.linalg.eigh((inner + inner.T) / 2)
            values, turn = values[::-1], turn[:, ::-1]
            vectors, again = locked @ turn, again @ turn
            if (np.linalg.norm(again - vectors * values, axis=0) <= 2 * limit).all():
                return values, vectors, outer
            # Rounding had built up in the products that were carried along.
            space, products, locked, values = vectors, again, np.zeros((d, 0)), np.zeros(0)
            continue
        wanted -= ready
        current, shift = space[:, :wanted], theta[:wanted]
        if space.shape[1] + wanted > room:
            space, products = space[:, : wanted + 4], products[:, : wanted + 4]
        fixed = np.concatenate([locked, current], axis=1)

        def projected(t: np.ndarray) -> np.ndarray:
            t = t - fixed @ (fixed.T @ t)
            t = multiply(t) - shift * t
            return t - fixed @ (fixed.T @ t)

        small = 2.0**-outer
        corrections = minres(projected, -residuals, small, INNER_STEPS)
        more = _orthonormal(np.concatenate([corrections, residuals], axis=1), locked, space)[:, :wanted]
        missing = d - locked.shape[1] - space.shape[1]
        if more.shape[1] < min(wanted, missing):
            noise = np.random.default_rng(seed + outer).standard_normal((d, min(wanted, missing) - more.shape[1]))
            more = np.concatenate([more, _orthonormal(noise, locked, space, more)], axis=1)
        space, products = np.concatenate([space, more], axis=1), np.concatenate([products, multiply(more)], axis=1)
    raise RuntimeError(f"eigenvectors did not reach double precision in {OUTER_STEPS} steps")


@dataclass(frozen=True)
class Whitening:
    """What ``fit_whitening`` found; component ``j`` is column ``j`` of ``vectors``."""

    n: int
    sums: list[int]  # of floor(64 * entry), without the shift
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float
    steps: int

    def apply(self, rows: DataFrame) -> DataFrame:
        """``rows`` of ``usable_vectors`` with ``deviation`` and ``whitened`` (array<double>) in place of the packed vector."""
        n, d, sums = self.n, len(self.sums), self.sums
        mean, project = self.mean, self.vectors / np.sqrt(self.values)
        names = [f.name for f in rows.schema if f.name not in ("_x", "_d", "deviation", "whitened")]
        kept = [rows.schema[name] for name in names]

        def run(batches):
            whole = np.array([abs(s) for s in sums], dtype=object).max(initial=0)
            for batch in batches:
                for at in range(0, batch.num_rows, ROWS):
                    part = batch.slice(at, ROWS)
                    x = _matrix(part.column(0), d)
                    deviation = _deviations(x, n, sums, int(whole))
                    white = (x - mean) @ project
                    ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * white.shape[1])
                    lists = pa.ListArray.from_arrays(ends, pa.array(white.reshape(-1)))
                    yield pa.RecordBatch.from_arrays([*part.columns[1:], deviation, lists], names=[*names, "deviation", "whitened"])

        new = [T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))]
        fitting = rows.filter(F.col("_d") == d).select("_x", *[F.col(f"`{name}`") for name in names])
        return fitting.mapInArrow(run, T.StructType([*kept, *new]))


def _deviations(x: np.ndarray, n: int, sums: list[int], largest_sum: int) -> pa.Array:
    """Sums of ``(n * x - S) ** 2`` exactly; null where a long cannot hold one."""
    bound = n * int(np.abs(x).max(initial=0)) + largest_sum
    if bound * bound * max(len(sums), 1) < 1 << 63:
        y = n * x - np.array(sums, dtype=np.int64)
        return pa.array((y * y).sum(axis=1))
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return pa.array([v if v < 1 << 63 else None for v in exact], pa.int64())


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Mean, eigenvalues and eigenvectors of written ``usable_vectors``; ``None`` without any.

    Vectors of another length than most (ties: the longer) are left out, here and in ``apply``.
    Components whose eigenvalue is zero to double precision cannot be scaled and are left out, so that
    there may be fewer than ``components`` of them, and none if all vectors are equal.
    """
    most = rows.groupBy("_d").count().orderBy(F.desc("count"), F.desc("_d")).limit(1).collect()
    if not most:
        return None
    d, n = most[0]["_d"], most[0]["count"]
    rows = rows.filter(F.col("_d") == d)
    sums = _integer_sums(rows, d)
    mean = np.array([s / n for s in sums])
    trace = float(_added(rows, d, 1, lambda x: np.array([np.square(x - mean).sum()]))[0]) / n

    def multiply(u: np.ndarray) -> np.ndarray:
        k = u.shape[1]
        if not k:
            return np.zeros((d, 0))

        def term(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return (centred.T @ (centred @ u)).reshape(-1)

        return _added(rows, d, d * k, term).reshape(d, k) / n

    values, vectors, steps = np.zeros(0), np.zeros((d, 0)), 0
    if trace > 0:
        values, vectors, steps = leading_eigenpairs(multiply, d, min(components, d))
        solid = values > d * ROUNDING * EPS * values[0]
        values, vectors = values[solid], vectors[:, solid]
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(values))])
    k = len(values)
    project = vectors / np.sqrt(values)

    def moments(x: np.ndarray) -> np.ndarray:
        white = (x - mean) @ project
        return np.concatenate([white.sum(axis=0), (white.T @ white).reshape(-1)])

    found = _added(rows, d, k + k * k, moments) / n if k else np.zeros(0)
    covariance = found[k:].reshape(k, k) - np.outer(found[:k], found[:k])
    error = float(np.abs(covariance - np.eye(k)).max(initial=0.0))
    return Whitening(n, sums, mean, values, vectors, trace, error, steps)


def whiten(df: DataFrame, vector_col: str = "embedding", carry: list[str] | None = None, components: int = COMPONENTS) -> DataFrame:
    """One row per usable vector and component, largest eigenvalue first.

    Columns: those in ``carry`` (default: all but the vector; ones called like a new column are left
    out), ``component`` (from 1), ``n`` (vectors fitted), ``deviation`` (exact; null beyond a long), ``whitened``,
    ``explained`` (share of the trace) and ``identity_error``.  The same signs hold for all rows: the largest entry
    of a component is positive.

    Rows are told apart by nothing but themselves, so repeated and null ids and equal vectors count
    one by one.  See ``usable_vectors`` and ``fit_whitening`` for vectors and components that are left
    out.  An empty table, or one whose vectors are all equal, gives no rows.
    """
    new = "component int, n long, deviation long, whitened double, explained double, identity_error double"
    added = set(T.StructType.fromDDL(new).names) | {"_x", "_d"}
    names = [f.name for f in df.schema if f.name not in added and (f.name in carry if carry is not None else f.name != vector_col)]
    rows = materialize(usable_vectors(df, vector_col, names))
    fitted = fit_whitening(rows, components)
    columns = [F.col(f"`{name}`") for name in names]
    if fitted is None or not len(fitted.values):
        return rows.limit(0).select(*columns, *[F.lit(None).cast(f.dataType).alias(f.name) for f in T.StructType.fromDDL(new)])
    explained = F.array(*[F.lit(float(v)) for v in fitted.values / fitted.trace])
    listed = fitted.apply(rows).select(*columns, "deviation", F.posexplode("whitened").alias("_at", "whitened"))
    return listed.select(
        *columns,
        (F.col("_at") + 1).alias("component"),
        F.lit(fitted.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(explained, F.col("_at")).alias("explained"),
        F.lit(fitted.identity_error).alias("identity_error"),
    )
