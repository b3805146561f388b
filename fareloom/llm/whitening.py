"""Embedding whitening: exact covariance by Spark, eigenvectors in float32 refined by matrix products in long double.

Each entry c of a vector becomes the whole number floor(256 * c). Sums and the centred second moments of the distinct
vectors are therefore exact, whatever the order or number of tasks: tasks multiply blocks whose products stay below
2^53, and the d x d sums are added up by a group-by. Only that d x d matrix reaches the driver; it is bounded by the
vectors' length and does not grow with the rows.

The driver takes float32 eigenvectors of it and refines them by Ogita and Aishima's iteration, which is four matrix
products a step, in long double (64 bits of mantissa). Where eigenvalues lie closer than the iteration can tell apart,
the subspace of the cluster is solved by itself: the matrix is shifted by the cluster's mean, projected on it and
decomposed again, so the scale of the small problem is that of the gaps.

Defined cases. Vectors that are null or hold a null, NaN or infinite entry are left out, and so are vectors of another
length than the most frequent one (of several, the longest). Entries beyond 2^62 / 256 count as that. Components without
variance (below 2^-44 of the largest) have no whitened value: null, as is the deviation if it exceeds a long (the
operator itself gives it as decimal). No rows give no rows. Repeated ids and rows are kept, each with its own result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.llm.common import by_value, stored, table

#: One unit of an entry is this share of 1.
SCALE = 256
#: Entries count as this at most, either sign.
LARGEST = 1 << 62
#: Products of entries are split into digits of this many bits and added in blocks of this many rows: below 2^53.
DIGIT, BLOCK = 20, 4096
#: Sums of products travel as two whole numbers below and above this many bits.
HALF = 60
#: Components below this share of the largest variance have none.
NULL_SHARE = 2.0**-44
#: Steps of refinement at most; convergence is quadratic, so a handful is used.
STEPS = 30
#: Values closer than this share of the largest are a cluster however small the residual: the iteration divides what long
#: double rounds off by the gap, and would only stir there.
CLOSE = 2.0**-36


# ---------------------------------------------------------------- whole-number moments, by Spark


def whole_vectors(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """The rows whose vector is usable, with `x`: its entries as whole numbers."""
    entry = F.col(column)
    finite = F.coalesce(
        F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf"))),
        F.lit(False),
    )
    # Bounded before it is made whole, so that no entry leaves the range of a long.
    bounded = lambda c: F.greatest(F.least(c.cast("double") * SCALE, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))
    clean = vectors.filter(finite & (F.size(entry) > 0))
    lengths = clean.groupBy(F.size(entry).alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return clean.filter(F.size(entry) == (lengths.d if lengths else 0)).withColumn(
        "x", F.transform(entry, lambda c: F.floor(bounded(c)).cast("long"))
    )


def matrix_of(column: pa.ChunkedArray | pa.Array, d: int) -> np.ndarray:
    """A column of vectors as rows of a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(-1, d)


def exact_products(z: np.ndarray) -> np.ndarray:
    """z'z in Python's whole numbers, by float64 products of digits that are exact."""
    d = z.shape[1]
    total = np.zeros((d, d), dtype=object)
    for at in range(0, len(z), BLOCK):
        part, digits = z[at : at + BLOCK], []
        while part.any() and len(digits) < 4:
            # Signed digits: the last one takes what is left, which is below 2^4 by then.
            low = part - ((part >> DIGIT) << DIGIT) if len(digits) < 3 else part
            digits.append(low.astype(np.float64))
            part = part >> DIGIT if len(digits) < 4 else np.zeros_like(part)
        for i, a in enumerate(digits):
            for j, b in enumerate(digits):
                total += (a.T @ b).astype(np.int64).astype(object) << (DIGIT * (i + j))
    return total


def summed_entries(fit: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the exact sum of each dimension."""
    placed = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i")
    sums = placed.agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")).orderBy("i").collect()
    return (int(sums[0].n), [int(r.s) for r in sums]) if sums else (0, [])


def centred_products(fit: DataFrame, centre: list[int]) -> np.ndarray:
    """Sum over the vectors of (x - centre)(x - centre)', exact.

    A task gives one row per pair of dimensions; a group-by adds them, in two parts so that no sum overflows.
    """
    d, middle = len(centre), np.array(centre, dtype=np.int64)
    low_bits = (1 << HALF) - 1

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d), dtype=object)
        for batch in batches:
            total += exact_products(matrix_of(batch.column(0), d) - middle)
        i, j = np.triu_indices(d)
        flat = total[i, j]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(i, pa.int32()),
                pa.array(j, pa.int32()),
                pa.array([str(v >> HALF) for v in flat], pa.string()),
                pa.array([int(v & low_bits) for v in flat], pa.int64()),
            ],
            names=["i", "j", "high", "low"],
        )

    parts = fit.select("x").mapInArrow(partial, "i int, j int, high string, low long")
    wide = "decimal(38,0)"
    rows = parts.groupBy("i", "j").agg(
        F.sum(F.col("high").cast(wide)).alias("high"), F.sum(F.col("low").cast(wide)).alias("low")
    )
    out = np.zeros((d, d), dtype=object)
    for r in rows.collect():  # d * (d + 1) / 2 rows
        out[r.i, r.j] = out[r.j, r.i] = (int(r.high) << HALF) + int(r.low)
    return out


# ---------------------------------------------------------------- eigenvectors, refined


def long_double(value: Any, divisor: int) -> np.longdouble:
    """A ratio of whole numbers of any size, to the last bit of a long double but one."""
    if value == 0:
        return np.longdouble(0)
    shift = 66 - (abs(value).bit_length() - divisor.bit_length())
    q = ((abs(value) << shift) if shift >= 0 else (abs(value) >> -shift)) // divisor
    whole = np.longdouble(q >> 33) * np.longdouble(2.0**33) + np.longdouble(q & ((1 << 33) - 1))
    return np.ldexp(whole, -shift) * (1 if value > 0 else -1)


def covariance(products: np.ndarray, rest: list[int], n: int) -> np.ndarray:
    """products / n - (rest / n)(rest / n)' in long double; rest: what the sums keep after centring, at most n / 2."""
    d, out = len(rest), np.zeros((len(rest), len(rest)), dtype=np.longdouble)
    for i in range(d):
        for j in range(i, d):
            out[i, j] = out[j, i] = long_double(n * int(products[i, j]) - rest[i] * rest[j], n * n)
    return out


def _clusters(values: np.ndarray, width: np.longdouble) -> list[np.ndarray]:
    """Runs of two or more values, falling, whose neighbours are not further apart than `width`."""
    cuts = np.flatnonzero(values[:-1] - values[1:] > width) + 1
    return [run for run in np.split(np.arange(len(values)), cuts) if len(run) > 1]


def refine_step(a: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.longdouble, np.longdouble]:
    """One step of the iteration: better vectors, their values, the size of the change, and the gap that it can tell.

    With R = I - V'V and S = V'AV: values S_ii / (1 - R_ii); V + V E with E_ij = (S_ij + l_j R_ij) / (l_j - l_i) for
    values further apart than `gap`, else R_ij / 2, which only makes the vectors orthogonal.
    """
    d = len(a)
    r = np.eye(d, dtype=np.longdouble) - v.T @ v
    s = v.T @ (a @ v)
    s = (s + s.T) / 2
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(np.diag(s))
    size = np.sqrt((a * a).sum())
    gap = 2 * (np.sqrt((off * off).sum()) + size * np.sqrt((r * r).sum()))
    gap = np.maximum(gap, CLOSE * np.abs(values).max())
    apart = values[None, :] - values[:, None]
    told = np.abs(apart) > gap
    e = np.where(told, (s + values[None, :] * r) / np.where(told, apart, 1), r / 2)
    return v + v @ e, values, np.sqrt((e * e).sum()), gap


def sub_solve(a: np.ndarray, v: np.ndarray, cluster: np.ndarray, mean: np.longdouble) -> np.ndarray:
    """The cluster's vectors turned within their subspace to be eigenvectors of the matrix seen from there.

    Shifted by the cluster's mean value before it is projected, and divided by the largest entry, the small matrix spans
    the gaps alone: its float64 vectors tell values apart that agree in all digits the whole matrix's vectors could see.
    """
    w = v[:, cluster]
    s = w.T @ (a @ w - mean * w)
    s = (s + s.T) / 2
    most = np.abs(s).max()
    if most == 0:
        return v
    _, turn = np.linalg.eigh((s / most).astype(np.float64))
    w = w @ turn[:, ::-1].astype(np.longdouble)
    # The turn is orthogonal in float64 only.
    w = w + w @ (np.eye(len(cluster), dtype=np.longdouble) - w.T @ w) / 2
    out = v.copy()
    out[:, cluster] = w
    return out


def eigenpairs(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values, falling, and unit vectors (columns) of a symmetric matrix, to double precision."""
    d = len(a)
    scale = np.abs(a).max() if d else 0
    if scale == 0:
        return np.zeros(d, dtype=np.longdouble), np.eye(d, dtype=np.longdouble)
    a = a / scale
    _, start = np.linalg.eigh(a.astype(np.float32))
    v = start[:, ::-1].astype(np.longdouble)
    enough, before = d * np.finfo(np.longdouble).eps * 8, np.inf
    for _ in range(STEPS):
        v, values, change, gap = refine_step(a, v)
        order = np.argsort(-values, kind="stable")
        v, values = v[:, order], values[order]
        # Done, or down to what rounding stirs up.
        if change < enough or 1e-6 > before < 2 * change:
            break
        before = change
        for group in _clusters(values, gap):
            v = sub_solve(a, v, group, values[group].mean())
    # The last word on a cluster is its own solve; elsewhere it is the iteration.
    for group in _clusters(values, gap):
        v = sub_solve(a, v, group, values[group].mean())
    v = v + v @ (np.eye(d, dtype=np.longdouble) - v.T @ v) / 2
    v = v / np.sqrt((v * v).sum(axis=0))
    values = (v * (a @ v)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, v[:, order]


# ---------------------------------------------------------------- the operator


@dataclass(frozen=True)
class Whitening:
    """What a fit has learned: n vectors, sums, falling variances with unit vectors (rows), and the share each explains."""

    n: int
    sums: list[int]
    centre: list[int]
    variances: list[float]
    components: np.ndarray
    explained: list[float | None]

    @property
    def usable(self) -> list[bool]:
        return [e > NULL_SHARE * self.variances[0] for e in self.variances]


def fit_whitening(fit: DataFrame, keep: int = 4) -> Whitening:
    """fit (x), each distinct vector once -> the leading `keep` components of its covariance (divisor n)."""
    n, sums = summed_entries(fit)
    # Nearest whole number to the mean: what is left of each sum is n / 2 at most.
    centre = [(2 * s + n) // (2 * n) for s in sums]
    rest = [s - n * c for s, c in zip(sums, centre)]
    matrix = covariance(centred_products(fit, centre), rest, n) if n else np.zeros((0, 0), dtype=np.longdouble)
    values, vectors = eigenpairs(matrix)
    trace = np.trace(matrix)
    return Whitening(
        n,
        sums,
        centre,
        [float(e) for e in values[:keep]],
        vectors[:, :keep].T,
        [float(e / trace) if trace else None for e in values[:keep]],
    )


def deviations(z: np.ndarray, rest: list[int], n: int) -> list[int]:
    """Sum over dimensions of (n * z - rest)^2 of each row, exact: n^2 zz - 2n z.rest + rest.rest."""
    own = sum(r * r for r in rest)
    if len(z) and int(np.abs(z).max()) < 1 << 24 and len(rest) <= 4096:
        squares = (z * z).sum(axis=1)
        parts, left, crossed = [], np.array(rest, dtype=np.int64), np.zeros(len(z), dtype=object)
        for k in range(3):  # |rest| < 2^63 in three signed digits of 24 bits
            digit = left - ((left >> 24) << 24) if k < 2 else left
            parts.append((z @ digit).astype(object) << (24 * k))
            left = left >> 24
        for p in parts:
            crossed = crossed + p
        return list(squares.astype(object) * (n * n) - crossed * (2 * n) + own)
    wide = z.astype(object)
    return [int(sum((n * v - r) ** 2 for v, r in zip(row, rest))) for row in wide]


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """rows (x, ...) -> their other columns, `deviation` (decimal text) and `whitened` (one value per component)."""
    d, n, centre = len(model.sums), model.n, np.array(model.centre, dtype=np.int64)
    rest = [s - n * c for s, c in zip(model.sums, model.centre)]
    offset = np.array([float(long_double(r, n)) for r in rest])
    deviation = [e**0.5 if ok else np.inf for e, ok in zip(model.variances, model.usable)]
    turn = (model.components / np.array(deviation, dtype=np.longdouble)[:, None]).astype(np.float64).T
    missing = np.array([not ok for ok in model.usable])
    others = [f for f in rows.schema if f.name not in ("x", "deviation", "whitened")]
    kept = [f.name for f in others]

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z = matrix_of(batch.column(batch.num_columns - 1), d) - centre
            w = (z.astype(np.float64) - offset) @ turn
            mask = np.broadcast_to(missing, w.shape)
            values = pa.array(w.ravel(), pa.float64(), mask=mask.ravel())
            starts = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(k) for k in range(len(kept))]
                + [pa.array([str(v) for v in deviations(z, rest, n)], pa.string()), pa.ListArray.from_arrays(starts, values)],
                names=[*kept, "deviation", "whitened"],
            )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in others] + ["deviation string", "whitened array<double>"])
    return rows.select(*[f"`{k}`" for k in kept], "x").mapInArrow(each, schema)


def identity_error(whitened: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the covariance of `whitened` minus the identity, measured over the rows.

    Spark's covar_pop centres each part before it multiplies.
    """
    usable = [k for k, ok in enumerate(model.usable) if ok]
    value = {k: F.col("whitened")[k] for k in usable}
    pairs = [(a, b) for a in usable for b in usable if a <= b]
    if not pairs:
        return 0.0
    found = whitened.agg(*[F.covar_pop(value[a], value[b]).alias(f"c{a}_{b}") for a, b in pairs]).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each usable embedding on the four leading components; fitted on the distinct whole-number vectors."""
    given = table(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = whole_vectors(given).select("vec_id", "x")
    fit = stored(rows.select("x").distinct(), "whitening-fit")
    model = fit_whitening(fit)
    error = identity_error(whiten(fit, model), model) if model.n else 0.0
    shares = F.array(*[F.lit(s).cast("double") for s in model.explained]) if model.explained else F.array().cast("array<double>")
    placed = whiten(rows, model) if model.n else rows.select("vec_id", F.lit("0").alias("deviation"), F.array().cast("array<double>").alias("whitened"))
    return placed.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened")).select(
        "vec_id",
        (F.col("k") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        _long_or_null(F.col("deviation")).alias("deviation"),
        "whitened",
        F.element_at(shares, F.col("k") + 1).alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def _long_or_null(text: Column) -> Column:
    return text.try_cast("long")


by_value(__name__)
