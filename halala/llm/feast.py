"""Embedding whitening by FEAST: contour integrals of shifted solves give the covariance's eigenvectors.

Vectors are fitted in fixed point, x = floor(64 c) + 1000000, each distinct x once. Spark counts the distinct
vectors, sums them, and sums the products of their centred entries; all of it in whole numbers, so the
covariance (one number for each pair of dimensions, the only thing that reaches the driver) is exact up to
one rounding. On it, `feast`

* brackets the wanted eigenvalues: `below` counts the eigenvalues under a shift by the inertia of the shifted
  matrix (Sturm's sequence of its tridiagonal form), and bisection on it splits the spectrum into intervals
  of few eigenvalues whose ends lie in gaps;
* projects a block of vectors onto an interval's eigenspace: a Gauss-Legendre quadrature over a circle
  around the interval sums solutions of complex shifted systems;
* takes Ritz vectors of the projected block, and repeats until they are eigenvectors to rounding;
* checks by inertia that as many were found as the interval holds.

Rows are then projected on the components and scaled, each where it lies.

Edge cases: vectors that are null or hold null or non-finite entries are dropped, as are those without
entries and those of another length than most vectors have (of equally frequent lengths the greater
counts), and those with entries beyond 64-bit x. Components whose eigenvalue is 0 up to rounding (1e-12 of
the greatest) cannot be scaled and are left out, so a single distinct vector, or an empty table, gives no
rows. Equal eigenvalues are numbered in any order. A deviation beyond 64 bits is null. Repeated rows are fitted once
and all returned. Null ids are returned as null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from halala.llm.shared import written

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 16
NODES, IN_INTERVAL, ROUNDS, PATIENCE = 8, 8, 60, 4
FLAT = 1e-12  # of the greatest eigenvalue: nothing varies there
ROWS = 4096  # rows of a batch that are multiplied at once

WHITENED = "vec_id bigint, component int, deviation bigint, whitened double"


def tridiagonal(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Diagonal and side diagonal of a matrix similar to the symmetric one, by reflections."""
    a = v.astype(np.float64).copy()
    n = len(a)
    for k in range(n - 2):
        x = a[k + 1 :, k].copy()
        size = np.linalg.norm(x)
        if size == 0:
            continue
        x[0] += size if x[0] >= 0 else -size
        x /= np.linalg.norm(x)
        part = a[k + 1 :, k:]
        part -= 2 * np.outer(x, x @ part)
        part = a[k:, k + 1 :]
        part -= 2 * np.outer(part @ x, x)
    return np.diag(a).copy(), np.diag(a, -1).copy()


def below(form: tuple[np.ndarray, np.ndarray], shift: float) -> int:
    """Eigenvalues less than the shift: the negative pivots of the shifted matrix (its inertia)."""
    diagonal, side = form
    tiny = np.finfo(float).tiny
    count, pivot = 0, 1.0
    for i, d in enumerate(diagonal):
        pivot = d - shift - (side[i - 1] ** 2 / pivot if i else 0.0)
        if abs(pivot) < tiny:
            pivot = -tiny
        count += pivot < 0
    return count


def _ends(form: tuple[np.ndarray, np.ndarray], low: float, high: float, first: int, width: float) -> Iterator[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues) that together hold all eigenvalues from number `first` on, highest first."""
    n_low, n_high = below(form, low), below(form, high)
    if n_high <= first or n_low == n_high:
        return
    if n_high - n_low <= IN_INTERVAL and n_low >= first or high - low <= width:
        yield low, high, n_high - n_low
        return
    middle = _gap(form, low, high)
    yield from _ends(form, middle, high, first, width)
    yield from _ends(form, low, middle, first, width)


def _gap(form: tuple[np.ndarray, np.ndarray], low: float, high: float) -> float:
    """A place between the two that splits the eigenvalues there and keeps away from them, if there is one."""
    places = low + (high - low) * np.linspace(0.25, 0.75, 9)
    near = (high - low) / 64
    crowd = [below(form, x + near) - below(form, x - near) for x in places]
    middle = np.abs(places - (low + high) / 2)
    return float(places[min(range(len(places)), key=lambda i: (crowd[i], middle[i]))])


def _interval(v: np.ndarray, low: float, high: float, count: int, draw: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvalues within (low, high) and their vectors."""
    n = len(v)
    centre, radius = (low + high) / 2, (high - low) / 2
    size = min(n, count + max(4, count // 2))
    x, weight = np.polynomial.legendre.leggauss(NODES)
    turn = np.exp(1j * np.pi / 2 * (x + 1))  # the upper half of the circle; the lower one is its mirror
    block = draw.normal(size=(n, size))
    scale, best, idle = np.abs(v).max(), None, 0
    for _ in range(ROUNDS):
        projected = np.zeros((n, size))
        for t, w in zip(turn, weight, strict=True):
            solved = np.linalg.solve((centre + radius * t) * np.eye(n) - v, block)
            projected += w / 2 * radius * (t * solved).real
        basis = np.linalg.qr(projected)[0]
        ritz, turned = np.linalg.eigh(basis.T @ (v @ basis))
        block = basis @ turned
        inside = np.flatnonzero((ritz > low) & (ritz < high))
        residual = np.abs(v @ block[:, inside] - block[:, inside] * ritz[inside]).max(initial=0.0)
        if len(inside) == count:
            idle = 0 if best is None or residual < 0.5 * best[0] else idle + 1
            if best is None or residual < best[0]:
                best = residual, ritz[inside], block[:, inside]
            if residual <= 4 * np.finfo(float).eps * scale or idle == PATIENCE:
                break
    if best is None:
        raise ArithmeticError(f"{count} eigenvalues lie in ({low}, {high}), but they were not found")
    return best[1], best[2]


def feast(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The greatest eigenvalues of a symmetric matrix, falling, and unit vectors as columns; `wanted` of them, or all."""
    n = len(v)
    wanted = min(wanted, n)
    scale = float(np.abs(v).sum(axis=1).max(initial=0.0))
    if not wanted or not scale:
        return np.zeros(0), np.zeros((n, 0))
    v = v / scale
    form = tridiagonal(v)
    draw = np.random.default_rng(11)
    found = [_interval(v, *x, draw) for x in _ends(form, -1.01, 1.01, n - wanted, 1e-13)]
    values = np.concatenate([x for x, _ in found])
    order = np.argsort(-values, kind="stable")[:wanted]
    # The intervals' vectors belong to different eigenvalues; one orthogonalisation removes rounding between them.
    vectors, turned = np.linalg.qr(np.concatenate([y for _, y in found], axis=1)[:, order])
    return values[order] * scale, vectors * np.sign(np.diag(turned))


def fixed_point(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the usable rows of embeddings(vec_id, embedding, …)."""
    entry = "cast(c as double)"
    fits = f"c is not null and not isnan({entry}) and abs({SCALE} * {entry}) < 9.2e18"
    usable = embeddings.where(f"embedding is not null and size(embedding) > 0 and forall(embedding, c -> {fits})")
    usable = usable.select(F.col("vec_id").cast("bigint").alias("vec_id"), "embedding", F.size("embedding").alias("length"))
    lengths = usable.groupBy("length").agg(F.count("*").alias("n")).orderBy(F.desc("n"), F.desc("length")).first()
    kept = usable.where(F.col("length") == (lengths["length"] if lengths else 0))
    return kept.select("vec_id", F.expr(f"transform(embedding, c -> floor({SCALE} * {entry}) + {OFFSET}L)").alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def _products(centre: np.ndarray):
    """Sums of the centred entries and of their products over a task's rows, one row per dimension."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(centre), len(centre) + 1))
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                # Whole numbers in doubles: exact below 2**53, rounded like doubles beyond.
                y = (_matrix(batch.column("x").slice(a, ROWS)) - centre).astype(np.float64)
                total[:, :-1] += y.T @ y
                total[:, -1] += y.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(centre))), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    return of_batches


def _added(fit: DataFrame, of_rows, width: int, n_rows: int) -> np.ndarray:
    """The tasks' rows (i, sums) added up by Spark: `n_rows` rows of `width` numbers."""
    each = fit.mapInArrow(of_rows, "i bigint, sums array<double>").select("i", F.posexplode("sums").alias("j", "part"))
    out = np.zeros((n_rows, width))
    got = each.groupBy("i", "j").agg(F.sum("part").alias("part")).toArrow()  # one row for each pair of dimensions
    out[got.column("i").to_numpy(), got.column("j").to_numpy()] = got.column("part").to_numpy()
    return out


def covariance(n: int, sums: list[int], fit: DataFrame) -> np.ndarray:
    """Covariance of the distinct vectors, from n and their sums; centred on whole numbers before multiplying."""
    d = len(sums)
    centre = np.array([round(s / n) if abs(s) < 1 << 52 else (2 * s + n) // (2 * n) for s in sums], np.int64)
    added = _added(fit, _products(centre), d + 1, d)
    rest = [int(x) for x in added[:, -1]]
    whole = [[(n * int(added[i, j]) - rest[i] * rest[j]) / (n * n) for j in range(d)] for i in range(d)]
    v = np.array(whole)
    return (v + v.T) / 2


def _projected(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Rows on the components, and n * x - S where it fits 64 bits."""
    s = np.array(sums, object)
    if n * max(int(np.abs(x).max(initial=0)), 1) < 1 << 62 and max(abs(y) for y in sums) < 1 << 62:
        away = n * x - s.astype(np.int64)
        return (away / n) @ axes, away
    away = n * x.astype(object) - s
    return (away / n).astype(np.float64) @ axes, None


def _deviation(x: np.ndarray, away: np.ndarray | None, n: int, sums: list[int]) -> list[int | None]:
    if away is not None and len(away) and float(np.abs(away).max()) ** 2 * away.shape[1] < 2**62:
        return (away * away).sum(axis=1).tolist()
    exact = [sum((n * int(c) - s) ** 2 for c, s in zip(row, sums, strict=True)) for row in x]
    return [e if e < 1 << 63 else None for e in exact]


def _identity(n: int, sums: list[int], axes: np.ndarray):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        total = np.zeros((k, k + 1))
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                w = _projected(_matrix(batch.column("x").slice(a, ROWS)), n, sums, axes)[0]
                total[:, :-1] += w.T @ w
                total[:, -1] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    return of_batches


def _whiten(n: int, sums: list[int], axes: np.ndarray):
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = axes.shape[1]
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS):
                part = batch.slice(a, ROWS)
                x = _matrix(part.column("x"))
                w, away = _projected(x, n, sums, axes)
                again = pa.array(np.repeat(np.arange(part.num_rows), k))
                deviation = pa.array(_deviation(x, away, n, sums), pa.int64()).take(again)
                numbers = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), part.num_rows))
                yield pa.RecordBatch.from_arrays([part.column("vec_id").take(again), numbers, deviation, pa.array(w.ravel())], names=["vec_id", "component", "deviation", "whitened"])

    return of_batches


def whitened(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every usable row and component."""
    spark = embeddings.sparkSession
    rows = fixed_point(embeddings)
    fit = written(rows.select("x").distinct())
    length = fit.select(F.size("x").alias("d")).first()
    empty = spark.createDataFrame([], WHITENED)
    found, explained, error, n = empty, [], 0.0, 0
    if length:
        d = length["d"]
        first = fit.agg(F.count("*").alias("n"), *(F.sum(F.col("x")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(d))).first()
        n, sums = first["n"], [int(first[f"s{i}"]) for i in range(d)]
        v = covariance(n, sums, fit)
        values, vectors = feast(v, components)
        held = values > FLAT * values.max(initial=0.0)
        values, vectors = values[held], vectors[:, held]
        if len(values):
            axes = vectors / np.sqrt(values)
            k = len(values)
            added = _added(fit, _identity(n, sums, axes), k + 1, k)
            mean = added[:, -1] / n
            error = float(np.abs(added[:, :-1] / n - np.outer(mean, mean) - np.eye(k)).max())
            explained = (values / np.trace(v)).tolist()
            found = rows.mapInArrow(_whiten(n, sums, axes), WHITENED)
    shares = F.array(*(F.lit(x) for x in explained)) if explained else F.array(F.lit(0.0))
    return found.select(
        "vec_id", "component", F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(shares, F.col("component")).alias("explained"), F.lit(error).alias("identity_error"),
    )
