"""Whitening of embeddings: principal components of equal variance, from one exact scatter matrix.

Entries become integers, so sums and products are exact and do not depend on how rows are dealt. The scatter of the centred
vectors is factored by Cholesky with pivots; one-sided Jacobi rotations then make the columns of the triangular factor
orthogonal. Their squared norms are the eigenvalues of the scatter and their directions its eigenvectors.
"""

from __future__ import annotations

import decimal
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sft_tables.llm.common import read_table, stored

SCALE, SHIFT, COMPONENTS = 1024, 100_000, 8
#: Entries from which on an integer would not be exact in a double; such vectors count as not finite.
LARGEST = 2.0**52
ROWS = 4096
EXACT = decimal.Context(prec=60)


def vectors(batch: pa.RecordBatch, size: int, place: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Which rows have ``size`` entries, all of them numbers within bounds, and these rows as integers."""
    column = batch.column(place)
    if len(column) and size:
        length = np.asarray(column.value_lengths().fill_null(-1))
        good = length == size
        flat = column.filter(pa.array(good)).flatten().cast(pa.float64())
        values = np.asarray(flat.fill_null(np.nan)).reshape(-1, size)
        with np.errstate(invalid="ignore", over="ignore"):
            scaled = values * SCALE
            fine = (np.abs(scaled) < LARGEST).all(axis=1)
        good[good] = fine
        return good, np.floor(scaled[fine]).astype(np.int64) + SHIFT
    return np.zeros(len(column), bool), np.zeros((0, size), np.int64)


def dimensions(rows: DataFrame, column: str) -> int:
    """The commonest length of a vector without null or non-finite entries, the greater one of two; 0 without any."""
    usable = F.forall(column, lambda c: c.isNotNull() & (F.abs(c.cast("double") * SCALE) < LARGEST))
    sizes = rows.filter(F.col(column).isNotNull() & usable).groupBy(F.size(column).alias("size")).count()
    found = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return found[0]["size"] if found else 0


def exact_sums(rows: DataFrame, run) -> dict[tuple[int, int], int]:
    """Whole numbers by (i, j), added up over all tasks; the driver sees one row per pair of dimensions."""
    parts = rows.mapInArrow(run, "i int, j int, part decimal(38,0)")
    found = parts.groupBy("i", "j").agg(F.sum("part").alias("total")).collect()
    return {(r["i"], r["j"]): int(r["total"]) for r in found}


def emitted(values: dict[tuple[int, int], int]) -> pa.RecordBatch:
    keys = list(values)
    numbers = pa.array([EXACT.create_decimal(values[k]) for k in keys], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), numbers], ["i", "j", "part"])


def sums(rows: DataFrame, size: int) -> tuple[int, list[int]]:
    """Number of vectors and the sum of each dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, total = 0, [0] * size
        for batch in batches:
            _, x = vectors(batch, size)
            for block in np.array_split(x, max(1, -(-len(x) // 1024))):  # 2**52 * 1024 fits a long
                number += len(block)
                total = [a + int(b) for a, b in zip(total, block.sum(axis=0))]
        if number:
            yield emitted({(-1, -1): number} | {(i, -1): t for i, t in enumerate(total)})

    found = exact_sums(rows, run)
    return found.get((-1, -1), 0), [found.get((i, -1), 0) for i in range(size)]


def products(z: np.ndarray) -> np.ndarray:
    """The sum of outer products of integer rows, exactly: by floating matrix products as long as these are exact."""
    size = z.shape[1]
    out = np.zeros((size, size), object)
    most = int(np.abs(z).max(initial=0))
    rows = 2**53 // max(1, most * most)
    if not rows:
        wide = z.astype(object)
        return wide.T @ wide
    for start in range(0, len(z), min(rows, ROWS)):
        block = z[start:start + min(rows, ROWS)].astype(np.float64)
        out += (block.T @ block).astype(np.int64)
    return out


def scatter(rows: DataFrame, size: int, number: int, total: list[int]) -> list[list[int]]:
    """``number`` times the sum of (x - mean)(x - mean)', as whole numbers.

    Vectors are centred on the whole number nearest to the mean before they are multiplied; what this leaves of the mean is
    taken off exactly.
    """
    centre = [(2 * t + number) // (2 * number) for t in total]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((size, size), object)
        for batch in batches:
            _, x = vectors(batch, size)
            if len(x):
                out += products(x - np.array(centre, np.int64))
        yield emitted({(i, j): int(out[i, j]) for i in range(size) for j in range(i, size)})

    found = exact_sums(rows, run)
    rest = [t - number * c for t, c in zip(total, centre)]
    return [[number * found[min(i, j), max(i, j)] - rest[i] * rest[j] for j in range(size)] for i in range(size)]


def triangular_factor(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(L, order): the rows and columns of a positive semidefinite matrix in the order of their pivots equal L L'.

    L has as many columns as there are pivots that differ from nothing by more than rounding.
    """
    left = matrix.copy()
    size = len(left)
    order, out = np.arange(size), np.zeros((size, size))
    least = size * np.finfo(float).eps * max(0.0, left.diagonal().max(initial=0.0))
    for k in range(size):
        p = k + int(np.argmax(left.diagonal()[k:]))
        if left[p, p] <= least:
            return out[:, :k], order
        for rows in (left, left.T, out, order):
            rows[[k, p]] = rows[[p, k]]
        out[k, k] = np.sqrt(left[k, k])
        out[k + 1:, k] = left[k + 1:, k] / out[k, k]
        left[k + 1:, k + 1:] -= np.outer(out[k + 1:, k], out[k + 1:, k])
    return out, order


def rounds(columns: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """All pairs of columns in rounds of pairs that share none (as in a tournament)."""
    even = columns + columns % 2
    ring = list(range(even))
    out = []
    for _ in range(even - 1):
        pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[:even // 2], reversed(ring[even // 2:])) if max(a, b) < columns]
        out.append((np.array([a for a, _ in pairs]), np.array([b for _, b in pairs])))
        ring = [ring[0], ring[-1], *ring[1:-1]]
    return out


def orthogonal_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """Rotate pairs of columns until all are orthogonal to rounding."""
    out = factor.copy()
    plan = [r for r in rounds(out.shape[1]) if len(r[0])]
    tolerance = np.finfo(float).eps * max(1, len(out)) ** 0.5
    for _ in range(sweeps):
        worst = 0.0
        for p, q in plan:
            left, right = out[:, p], out[:, q]
            a, b, c = (left * left).sum(axis=0), (right * right).sum(axis=0), (left * right).sum(axis=0)
            size = np.sqrt(a * b)
            turn = np.abs(c) > tolerance * size
            if not turn.any():
                continue
            worst = max(worst, float((np.abs(c[turn]) / size[turn]).max()))
            zeta = (b[turn] - a[turn]) / (2 * c[turn])
            t = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.sqrt(1 + zeta * zeta))
            cos = 1 / np.sqrt(1 + t * t)
            sin = cos * t
            left, right = left[:, turn], right[:, turn]
            out[:, p[turn]], out[:, q[turn]] = cos * left - sin * right, sin * left + cos * right
        if not worst:
            break
    return out


@dataclass
class Fit:
    """What was learned: number of vectors, sums of the dimensions, eigenvalues and unit eigenvectors (rows), and the trace."""

    number: int
    total: list[int]
    eigenvalues: np.ndarray
    components: np.ndarray
    trace: float


def eigen(scatter_times_n: list[list[int]], number: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of the covariance, falling, and their unit eigenvectors as rows; only those above rounding."""
    exact = [[float(Fraction(v, number * number)) for v in row] for row in scatter_times_n]
    factor, order = triangular_factor(np.array(exact).reshape(len(exact), len(exact)))
    rotated = orthogonal_columns(factor)
    norms = (rotated * rotated).sum(axis=0)
    best = np.argsort(-norms, kind="stable")
    directions = np.zeros((len(best), len(order)))
    directions[:, order] = (rotated[:, best] / np.sqrt(norms[best])).T
    # the sign that makes the largest entry positive, so that reruns agree
    sign = np.sign(directions[np.arange(len(best)), np.abs(directions).argmax(axis=1)]) if len(best) else np.zeros(0)
    return norms[best], directions * sign[:, None]


def fit(rows: DataFrame, column: str) -> Fit | None:
    """Learn from all usable vectors of a column; None if there is none."""
    size = dimensions(rows, column)
    lone = rows.select(column)
    number, total = sums(lone, size) if size else (0, [])
    if not number:
        return None
    matrix = scatter(lone, size, number, total)
    values, directions = eigen(matrix, number)
    return Fit(number, total, values, directions, float(Fraction(sum(matrix[i][i] for i in range(size)), number * number)))


def projected(rows: DataFrame, fitted: Fit, column: str, key: str, components: int) -> DataFrame:
    """(key, deviation, whitened): of each usable vector the exact sum of (n * x - S) ** 2, and its whitened coordinates."""
    size = len(fitted.total)
    axes = (fitted.components[:components] / np.sqrt(fitted.eigenvalues[:components])[:, None]).T
    number = fitted.number
    whole = [t // number for t in fitted.total]
    part = [t - number * w for t, w in zip(fitted.total, whole)]
    fraction = np.array([float(Fraction(p, number)) for p in part])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good, x = vectors(batch, size, 1)
            z = x - np.array(whole, np.int64)
            white = (z.astype(np.float64) - fraction) @ axes
            # n * x - S = n * z - part, squared and added up: n * n * zz - 2 * n * (z part) + (part part)
            most = int(np.abs(z).max(initial=0))
            if most * most * size < 2**62 and most * number * size < 2**62:
                squares, cross = (z * z).sum(axis=1).tolist(), (z @ np.array(part, np.int64)).tolist()
            else:
                wide = z.astype(object)
                squares, cross = (wide * wide).sum(axis=1).tolist(), (wide @ np.array(part, object)).tolist()
            rest = sum(p * p for p in part)
            deviation = [number * number * s - 2 * number * c + rest for s, c in zip(squares, cross)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).filter(pa.array(good)), pa.array([d if d < 2**63 else None for d in deviation], pa.int64()),
                pa.array(list(white), pa.list_(pa.float64())),
            ], [key, "deviation", "whitened"])

    kind = rows.schema[key].dataType.simpleString()
    return rows.select(key, column).mapInArrow(run, f"`{key}` {kind}, deviation bigint, whitened array<double>")


def identity_error(white: DataFrame, components: int) -> float:
    """The largest absolute entry of the covariance of whitened coordinates minus the identity."""
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    wide = white.select(*[F.col("whitened")[i].alias(f"c{i}") for i in range(components)])
    found = wide.agg(*[F.covar_pop(f"c{i}", f"c{j}").alias(f"v{i}_{j}") for i, j in pairs]).first()
    return max(abs(found[f"v{i}_{j}"] - (i == j)) for i, j in pairs)


def whitened(rows: DataFrame, column: str = "embedding", key: str = "vec_id", components: int = COMPONENTS) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) per usable vector and component.

    Vectors that are null or hold null or non-finite entries are dropped, as are those without the commonest length (of two
    equally common ones the greater; their missing entries count as null) and those with entries of 2**42 and more, whose
    integers a double does not hold. Components are numbered by falling eigenvalue; directions without variance have none,
    so equal vectors give no rows, as does an empty table. Null and repeated keys stay. A deviation that does not fit a long
    is null. Further columns are ignored. Four passes over the vectors; nothing is shuffled but sums; the driver sees
    matrices of the size of one vector squared.
    """
    spark = rows.sparkSession
    schema = f"`{key}` {rows.schema[key].dataType.simpleString()}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    fitted = fit(rows, column)
    most = min(components, len(fitted.eigenvalues)) if fitted else 0
    if not most:
        return spark.createDataFrame([], schema)
    white = stored(projected(rows, fitted, column, key, most), "whitened")
    share = F.array(*[F.lit(float(e / fitted.trace)) for e in fitted.eigenvalues[:most]])
    return white.select(
        F.col(key), F.lit(fitted.number).cast("bigint").alias("n"), "deviation", F.posexplode("whitened").alias("_at", "whitened"),
    ).select(
        key, (F.col("_at") + 1).alias("component"), "n", "deviation", "whitened",
        share[F.col("_at")].alias("explained"), F.lit(identity_error(white, most)).alias("identity_error"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitened(read_table(spark, sf_dir, "embeddings"))
