"""Whitening of embeddings on their leading principal components, found by contour integration (FEAST).

1. Statistics. Entries become integers, so counts, sums and products are exact in any order of tasks: one pass gives n and the
   sums, a second the products of the entries less the rounded mean, from which the covariance follows exactly and is rounded
   once. Each task adds up its own rows; one row per task travels.
2. Intervals. The number of eigenvalues above a shift is the number of positive pivots of the shifted covariance (Sylvester's
   law of inertia). Counts at many shifts at once bracket each wanted eigenvalue; the spectrum is cut in its wide gaps into
   intervals of a few eigenvalues, so that equal eigenvalues are never parted.
3. FEAST. For an interval, the integral of the resolvent around it is the projector onto its eigenvectors. Gauss-Legendre
   quadrature on the upper half circle turns it into complex shifted solves, one Spark task row per interval and node.
   Rayleigh-Ritz in the projected subspace gives eigenvalues and vectors; the vectors are the next start, until the residuals
   are at rounding level.
4. Check. The counts at both ends of an interval say how many eigenvalues lie in it; any other number found is an error.
5. Whitening. All rows are projected in parallel; the covariance of what came out is summed up in another pass.

The covariance has the size of the dimension squared, whatever the number of rows: it, and blocks of a few vectors, are all that
the driver and the solving tasks get.

Edge cases: rows whose vector is null, or holds a null, NaN or infinity, are dropped before anything is counted; repeated rows and
null ids are kept; vectors of different lengths, or entries beyond 2^40 after scaling, are errors; equal eigenvalues give some
orthonormal basis of their space, the same for all rows; components without variance (all rows equal, fewer rows than
components) are left out, as nothing can be divided by their spread; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from formflow.session import materialise

SCALE, SHIFT = 1024, 100_000
NODES, PER_INTERVAL, SWEEPS = 8, 4, 30
#: Eigenvalues below this share of the trace count as no variance.
NO_VARIANCE = 1e-11


# --- exact statistics over all rows ---------------------------------------------------------------------------------------


def usable(vector: str) -> Column:
    """The vector is there and all its entries are finite numbers."""
    bad = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(F.transform(vector, lambda c: c.cast("double")), bad)


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: int, shift: int) -> DataFrame:
    """(vec_id, x): the usable rows, each entry c as floor(scale * c) + shift."""
    whole = F.transform(vector, lambda c: (F.floor(c.cast("double") * scale) + shift).cast("long"))
    return df.where(usable(vector)).select(F.col(vec_id).alias("vec_id"), whole.alias("x"))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.int64).reshape(len(column), -1)


def _added(centre: np.ndarray | None):
    """One row per task: rows, and exact sums (entries as text, so that no task's size can overflow)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, totals = 0, None
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):  # products stay far below 2^63 within such a slice
                x = _matrix(batch.column("x").slice(at, 4096))
                if x.size and np.abs(x - (0 if centre is None else centre)).max() >= 1 << 25 and centre is not None:
                    x = x.astype(object)
                part = x.sum(axis=0) if centre is None else np.concatenate([(x - centre).sum(axis=0), ((x - centre).T @ (x - centre)).ravel()])
                part = part.astype(object)
                totals, n = part if totals is None else totals + part, n + len(x)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([[str(t) for t in totals]], pa.list_(pa.string()))], ["n", "totals"])

    return run


def _sums(rows: DataFrame, centre: np.ndarray | None = None) -> tuple[int, np.ndarray]:
    """n and the exact sums, as Python integers. Tasks' sums are added in Spark by place; one row per place comes back."""
    parts = rows.select("x").mapInArrow(_added(centre), "n long, totals array<string>")
    by_place = parts.select("n", F.posexplode("totals").alias("place", "total")).groupBy("place").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    found = sorted(by_place.select("place", "n", F.col("total").cast("string").alias("total")).collect())
    return (found[0]["n"] if found else 0), np.array([int(r["total"]) for r in found], dtype=object)


@dataclass(frozen=True)
class Statistics:
    n: int
    sums: np.ndarray  #: exact, Python integers
    covariance: np.ndarray  #: divisor n, each entry rounded once


def statistics(rows: DataFrame) -> Statistics:
    """Over written ``rows`` (vec_id, x)."""
    sizes = rows.agg(F.min(F.size("x")).alias("a"), F.max(F.size("x")).alias("b"), F.max(F.array_max(F.transform("x", F.abs))).alias("m")).first()
    if sizes["a"] != sizes["b"]:
        raise ValueError(f"vectors of {sizes['a']} and of {sizes['b']} entries")
    if sizes["m"] is not None and sizes["m"] >= 1 << 40:
        raise ValueError("entries are too large for exact sums")
    n, sums = _sums(rows)
    if not len(sums):
        return Statistics(n, sums, np.zeros((0, 0)))
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    _, both = _sums(rows, centre)
    d = len(sums)
    first, second = both[:d], both[d:].reshape(d, d)
    exact = n * second - np.outer(first, first)  # n^2 times the covariance
    return Statistics(n, sums, np.array([[v / (n * n) for v in row] for row in exact], dtype=np.float64))


# --- eigenvalues by contour integration -----------------------------------------------------------------------------------


def positive_pivots(a: np.ndarray) -> int:
    """How many eigenvalues of a symmetric matrix are positive: symmetric elimination with pivots of one or two rows."""
    a, count = np.array(a, dtype=np.float64), 0
    while len(a):
        diagonal, size = np.abs(np.diag(a)), np.abs(a)
        p = int(diagonal.argmax())
        r, c = divmod(int(size.argmax()), len(a))
        if size[r, c] == 0:
            return count
        if diagonal[p] >= 0.64 * size[r, c]:
            pivot, count = [p], count + int(a[p, p] > 0)
        else:  # a block of two with a positive and a negative eigenvalue
            pivot, count = [r, c], count + 1
        rest = np.delete(np.arange(len(a)), pivot)
        cross = a[np.ix_(rest, pivot)]
        a = a[np.ix_(rest, rest)] - cross @ np.linalg.solve(a[np.ix_(pivot, pivot)], cross.T)
    return count


def _on_rows(spark: SparkSession, inputs: list[tuple], schema: str, body, out: str) -> list:
    """``body(row)`` for each input row, a task each; the results, in any order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield pa.RecordBatch.from_pylist([body(row)])

    return spark.createDataFrame(inputs, schema).repartition(min(len(inputs), 64), *[F.col(c.split()[0]) for c in schema.split(", ")]).mapInArrow(run, out).collect()


def counts_above(spark: SparkSession, matrix: np.ndarray, shifts: list[float]) -> dict[float, int]:
    """Inertia counts: eigenvalues above each shift."""
    unit = np.eye(len(matrix))
    body = lambda r: {"shift": r["shift"], "n": positive_pivots(matrix - r["shift"] * unit)}
    return {r["shift"]: r["n"] for r in _on_rows(spark, [(float(s),) for s in set(shifts)], "shift double", body, "shift double, n long")}


def intervals_of(spark: SparkSession, matrix: np.ndarray, wanted: int, per_interval: int = PER_INTERVAL) -> list[tuple[float, float, int]]:
    """Intervals (low, high, eigenvalues inside) that hold the ``wanted`` largest eigenvalues, cut in gaps, from the top."""
    top = float(np.abs(matrix).sum(axis=1).max()) * 1.01  # no eigenvalue is larger
    known = {-0.01 * top: len(matrix), top: 0}
    for _ in range(12):
        # Further shifts between any two neighbours whose counts differ, as far as the wanted ones reach.
        at = sorted(known)
        wide = [(a, b) for a, b in zip(at, at[1:]) if known[a] > known[b] and known[b] <= wanted and b - a > 2e-4 * top]
        if not wide:
            break
        each = max(3, 64 // len(wide))
        known |= counts_above(spark, matrix, [a + (b - a) * i / (each + 1) for a, b in wide for i in range(1, each + 1)])
    at = sorted(known, reverse=True)
    # Gaps: stretches of equal counts. A cut stands in the middle of one.
    gaps, i = [], 0
    while i < len(at):
        j = i
        while j + 1 < len(at) and known[at[j + 1]] == known[at[i]]:
            j += 1
        gaps.append((known[at[i]], (at[i] + at[j]) / 2, at[i] - at[j]))
        i = j + 1
    cuts, have = [(0, top)], 0
    last = next(k for k, g in enumerate(gaps) if g[0] >= wanted)
    at = 0
    while have < wanted:
        options = [g for g in gaps[: last + 1] if have < g[0] <= have + per_interval] or [next(g for g in gaps if g[0] > have)]
        have, place, _ = max(options, key=lambda g: g[2])
        cuts.append((have, place))
    return [(low, high, b - a) for (a, high), (b, low) in zip(cuts, cuts[1:])]


def _start(dimension: int, columns: int) -> np.ndarray:
    """Any full-rank start serves; fixed, so that every run gives the same digits."""
    return np.random.default_rng(7).standard_normal((dimension, columns))


def feast(spark: SparkSession, matrix: np.ndarray, intervals: list[tuple[float, float, int]], nodes: int = NODES, sweeps: int = SWEEPS) -> tuple[np.ndarray, np.ndarray]:
    """All eigenvalues in the intervals, falling, and their unit vectors in columns."""
    d = len(matrix)
    unit, scale = np.eye(d), np.abs(matrix).sum(axis=1).max()
    x, weight = np.polynomial.legendre.leggauss(nodes)
    angle = np.pi / 2 * (x + 1)
    start = {i: _start(d, min(d, count + max(4, count // 2))) for i, (_, _, count) in enumerate(intervals)}
    done: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for _ in range(sweeps):
        held = {i: q.tobytes() for i, q in start.items()}

        def solved(row):
            low, high, _ = intervals[row["interval"]]
            radius, turn = (high - low) / 2, np.exp(1j * angle[row["node"]])
            q = np.frombuffer(held[row["interval"]]).reshape(d, -1)
            y = np.linalg.solve(((low + high) / 2 + radius * turn) * unit - matrix, q.astype(complex))
            return {"interval": row["interval"], "part": (weight[row["node"]] / 2 * (radius * turn * y).real).tobytes(), "node": row["node"]}

        solves = _on_rows(spark, [(i, k) for i in start for k in range(nodes)], "interval long, node long", solved, "interval long, part binary, node long")
        for i in list(start):
            low, high, count = intervals[i]
            projected = sum(np.frombuffer(r["part"]).reshape(d, -1) for r in sorted(solves, key=lambda r: r["node"]) if r["interval"] == i)
            basis, size, _ = np.linalg.svd(projected, full_matrices=False)
            basis = basis[:, size > 1e-14 * size[0]]
            values, small = np.linalg.eigh(basis.T @ matrix @ basis)  # Rayleigh-Ritz
            vectors = basis @ small
            inside = (values > low) & (values <= high)
            error = np.abs(matrix @ vectors[:, inside] - vectors[:, inside] * values[inside]).max(initial=0.0)
            if inside.sum() == count and error <= 4 * np.finfo(float).eps * scale:
                done[i] = values[inside], vectors[:, inside]
                del start[i]
            else:
                start[i] = vectors
        if not start:
            break
    if start:
        raise ArithmeticError(f"eigenvalues in {[intervals[i] for i in start]} were not all found")
    values = np.concatenate([v for v, _ in done.values()])
    vectors = np.concatenate([v for _, v in done.values()], axis=1)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def principal_components(spark: SparkSession, covariance: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues (as many as wanted, none without variance) and their vectors in columns."""
    trace = float(np.trace(covariance)) if len(covariance) else 0.0
    if trace <= 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    wanted = min(wanted, len(covariance), counts_above(spark, covariance, [NO_VARIANCE * trace])[NO_VARIANCE * trace])
    values, vectors = feast(spark, covariance, intervals_of(spark, covariance, wanted))
    return values[:wanted], vectors[:, :wanted]


# --- whitening ------------------------------------------------------------------------------------------------------------


def _projected(stats: Statistics, values: np.ndarray, vectors: np.ndarray):
    n, sums = stats.n, stats.sums
    centre = np.array([(2 * s + n) // (2 * n) for s in sums], dtype=np.int64)
    rest = np.array([s - n * int(c) for s, c in zip(sums, centre)], dtype=np.int64)  # at most n/2 in size
    weights = vectors / np.sqrt(values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            y = _matrix(batch.column("x")) - centre
            white = (y - rest / n) @ weights
            bound = (int(np.abs(y).max()) + 1) * n
            far = n * y - rest if bound**2 * y.shape[1] < 1 << 63 else n * y.astype(object) - rest.astype(object)
            deviation = [str(v) for v in (far * far).sum(axis=1)]
            rows = pa.ListArray.from_arrays(pa.array(np.arange(0, white.size + 1, white.shape[1]), pa.int32()), pa.array(white.ravel()))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(deviation), rows], ["vec_id", "deviation", "white"])

    return run


def identity_error(white: DataFrame, components: int) -> float:
    """Largest absolute entry of the covariance of the column ``white`` less the identity, means taken off before multiplying."""
    mean = white.agg(F.array(*[F.avg(F.col("white")[k]) for k in range(components)]).alias("m")).first()["m"]
    off = lambda k: F.col("white")[k] - F.lit(mean[k])
    pairs = [(a, b) for a in range(components) for b in range(a, components)]
    moved = white.select(*[off(k).alias(f"w{k}") for k in range(components)])
    found = moved.agg(*[F.avg(F.col(f"w{a}") * F.col(f"w{b}")).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whiten(df: DataFrame, components: int = 8, vec_id: str = "vec_id", vector: str = "embedding", scale: int = SCALE, shift: int = SHIFT) -> DataFrame:
    """One row per usable row and component: vec_id, component, n, deviation (decimal, exact), whitened, explained,
    identity_error, eigenvalue."""
    spark = df.sparkSession
    key = df.schema[vec_id].dataType.simpleString()
    rows = materialise(integer_vectors(df, vec_id, vector, scale, shift), "whitening-rows")
    stats = statistics(rows)
    values, vectors = principal_components(spark, stats.covariance, components)
    out = f"vec_id {key}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double, eigenvalue double"
    if not len(values):
        return spark.createDataFrame([], out)
    white = materialise(rows.mapInArrow(_projected(stats, values, vectors), f"vec_id {key}, deviation string, white array<double>"), "whitening-projected")
    trace, error = float(np.trace(stats.covariance)), identity_error(white, len(values))
    each = lambda numbers: F.array(*[F.lit(float(v)) for v in numbers])[F.col("at")]
    return white.select("vec_id", "deviation", F.posexplode("white").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(stats.n).cast("long").alias("n"), F.col("deviation").cast("decimal(38,0)"),
        "whitened", each(values / trace).alias("explained"), F.lit(error).alias("identity_error"), each(values).alias("eigenvalue"))
