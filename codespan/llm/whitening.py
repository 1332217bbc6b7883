"""Whitening of embeddings: an eigendecomposition kept up to date by rank-one updates.

Every partition turns its vectors into the spectrum of their centred scatter, the
spectra are merged in rounds, and the merged eigenvectors are refined once against
the whole table (Rayleigh-Ritz), which takes away what the updates have rounded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from codespan.llm.store import keep

SCALE = 256
COMPONENTS = 4
FAN_IN = 8  # spectra merged at a time
EPS = float(np.finfo(np.float64).eps)
MOST = 9.2e18  # deviations that a long can hold


def secular_roots(poles: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 = sum(weights / (root - poles)): the nearest pole of each, and the way from it.

    ``poles`` ascend strictly and ``weights`` are positive, so that one root lies
    above each pole and below the next (the last one within sum(weights)).  All
    roots are found together, each measured from its nearest pole, by rational
    interpolation at the two poles around it; a step that leaves the bracket
    halves it instead.
    """
    k = len(poles)
    i = np.arange(k)
    upper = np.append(poles[1:], poles[-1] + weights.sum())
    gap = upper - poles
    middle = poles[:, None] + gap[:, None] / 2 - poles[None, :]
    near_low = (1 - (weights / middle).sum(axis=1) >= 0) | (i == k - 1)
    origin = np.where(near_low, i, np.minimum(i + 1, k - 1))
    delta = poles[None, :] - poles[origin][:, None]  # poles as seen from each root's origin
    low = np.where(near_low, 0.0, -gap / 2)
    high = np.where(near_low, np.where(i == k - 1, gap, gap / 2), 0.0)
    t = (low + high) / 2
    active = np.ones(k, bool)
    below = np.tri(k, dtype=bool)  # poles up to a root's own
    for _ in range(100):
        way = t[:, None] - delta
        terms = weights / way
        f = 1 - terms.sum(axis=1)
        active &= np.abs(f) > 4 * EPS * (1 + np.abs(terms).sum(axis=1))
        active &= high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high))
        if not active.any():
            break
        low, high = np.where(f < 0, t, low), np.where(f < 0, high, t)
        slopes = terms / way
        own = np.where(below, slopes, 0).sum(axis=1)
        rest = slopes.sum(axis=1) - own
        d1 = delta[i, i] - t
        d2 = np.where(i == k - 1, gap, delta[i, np.minimum(i + 1, k - 1)]) - t
        # f is matched by c + own * d1^2 / (pole - x) + rest * d2^2 / (next pole - x).
        c = f - d1 * own - d2 * rest
        a = (d1 + d2) * f - d1 * d2 * (own + rest)
        b = d1 * d2 * f
        with np.errstate(all="ignore"):
            root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
            step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
            trial = t + step
            inside = np.isfinite(trial) & (trial > low) & (trial < high)
        t = np.where(active, np.where(inside, trial, (low + high) / 2), t)
    return origin, t


def rank_one(values: np.ndarray, vectors: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (ascending) and eigenvectors (columns) of V diag(values) V' + y y'.

    Directions that y does not touch, and all but one of those with equal values,
    are deflated: their eigenpairs stay.  For the others the secular equation gives
    the values, and the vectors come from the weights that have exactly these roots,
    which keeps them orthogonal.
    """
    z = vectors.T @ y
    size = float(z @ z)
    scale = max(float(np.abs(values).max(initial=0)), size)
    if size <= EPS * scale * EPS or scale == 0:
        return values, vectors
    vectors = vectors.copy()
    tolerance = 8 * EPS * scale
    untouched = np.abs(z) * np.sqrt(size) <= tolerance
    z = np.where(untouched, 0, z)
    last = -1
    for j in np.flatnonzero(~untouched):  # of equal values, turn all of z into the last direction
        if last >= 0 and values[j] - values[last] <= tolerance:
            r = np.hypot(z[last], z[j])
            c, s = z[j] / r, z[last] / r
            before, here = vectors[:, last].copy(), vectors[:, j].copy()
            vectors[:, last], vectors[:, j] = c * before - s * here, s * before + c * here
            z[last], z[j] = 0, r
        last = j
    kept = np.flatnonzero(z)
    poles, weights = values[kept], z[kept] ** 2
    origin, t = secular_roots(poles, weights)
    way = t[:, None] - (poles[None, :] - poles[origin][:, None])  # root j minus pole i, without cancellation
    between = poles[:, None] - poles[None, :]
    np.fill_diagonal(between, 1)
    # z_i^2 = prod_j (root_j - pole_i) / prod_{j != i} (pole_j - pole_i), paired so that each quotient is tame.
    quotient = np.prod(way / between, axis=0)
    exact = np.copysign(np.sqrt(np.abs(quotient)), z[kept])
    turned = exact[:, None] / way.T
    turned /= np.linalg.norm(turned, axis=0)
    values = values.copy()
    values[kept] = poles[origin] + t
    vectors[:, kept] = vectors[:, kept] @ turned
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


def absorb(values: np.ndarray, vectors: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spectrum after one rank-one update for each row."""
    for y in rows:
        values, vectors = rank_one(values, vectors, y)
    return values, np.linalg.qr(vectors)[0]


def _vectors(column: pa.Array, width: int) -> np.ndarray:
    """A list column of whole numbers, all lists of ``width``, as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), width)


def _spectra(mean: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One spectrum per partition: its number, eigenvalues and eigenvectors, row by row.

    A batch is first reduced to the triangle R of its QR factorisation, which has
    the batch's scatter (R'R) in as many rows as there are dimensions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(mean)
        values, vectors = np.zeros(d), np.eye(d)
        empty = True
        for batch in batches:
            y = _vectors(batch.column("x"), d) - mean
            if len(y) > d:
                y = np.linalg.qr(y, mode="r")
            values, vectors = absorb(values, vectors, y)
            empty = False
        if not empty:
            yield _spectrum(TaskContext.get().partitionId(), values, vectors)

    return run


def _spectrum(number: int, values: np.ndarray, vectors: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([number], pa.int64()), pa.array([values.tolist()], pa.list_(pa.float64())),
        pa.array([vectors.ravel().tolist()], pa.list_(pa.float64())),
    ], names=["number", "values", "vectors"])


SPECTRUM = "number long, values array<double>, vectors array<double>"


def _merged(rows: pd.DataFrame) -> pd.DataFrame:
    """The spectrum of several together: the rest are added to the first direction by direction."""
    rows = rows.sort_values("number")
    d = len(rows["values"].iloc[0])
    values, vectors = np.array(rows["values"].iloc[0]), np.array(rows["vectors"].iloc[0]).reshape(d, d)
    for v, q in zip(rows["values"].iloc[1:], rows["vectors"].iloc[1:], strict=True):
        parts = np.sqrt(np.maximum(v, 0))[:, None] * np.array(q).reshape(d, d).T
        values, vectors = absorb(values, vectors, parts)
    number = int(rows["number"].iloc[0]) // FAN_IN
    return pd.DataFrame({"number": [number], "values": [values.tolist()], "vectors": [vectors.ravel().tolist()]})


def _moments(mean: np.ndarray, basis: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """i, j, value: sums of products of the centred vectors' coordinates in ``basis``; j = -1 for plain sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = basis.shape[1]
        total, plain = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            t = (_vectors(batch.column("x"), len(mean)) - mean) @ basis
            total += t.T @ t
            plain += t.sum(axis=0)
        i, j = np.meshgrid(np.arange(k), np.arange(-1, k), indexing="ij")
        yield pa.RecordBatch.from_pandas(pd.DataFrame({
            "i": i.ravel(), "j": j.ravel(), "value": np.column_stack([plain, total]).ravel(),
        }), preserve_index=False)

    return run


def _covariance(fit: DataFrame, n: int, mean: np.ndarray, basis: np.ndarray) -> np.ndarray:
    k = basis.shape[1]
    rows = fit.mapInArrow(_moments(mean, basis), "i long, j long, value double")
    out = np.zeros((k, k + 1))
    for r in rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():  # k * (k + 1) numbers
        out[r.i, r.j + 1] = r.value / n
    return out[:, 1:] - np.outer(out[:, 0], out[:, 0])


def whole_vectors(rows: DataFrame, vector: str) -> Column:
    """floor(256 * c) of every entry, null for a vector that is null, empty or holds null or non-finite entries."""
    v = F.transform(F.col(vector), lambda c: c.cast("double"))
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    whole = F.transform(v, lambda c: F.floor(c * SCALE).cast("long"))
    return F.when(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~bad, whole)


def fit_spectrum(fit: DataFrame, n: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (columns) of the covariance of ``fit.x``."""
    mean = sums / n
    spectra = keep(fit.mapInArrow(_spectra(mean), SPECTRUM))
    last = spectra.agg(F.max("number")).first()[0]
    while last:
        group = F.floor(F.col("number") / FAN_IN)
        spectra = keep(spectra.groupBy(group.alias("group")).applyInPandas(_merged, SPECTRUM))
        last //= FAN_IN
    merged = spectra.first()
    basis = np.array(merged["vectors"]).reshape(len(mean), -1)
    ritz = _covariance(fit, n, mean, basis)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    basis = np.linalg.qr(basis @ turn)[0]
    return values[::-1], basis[:, ::-1]


def _projected(
    n: int, sums: np.ndarray, values: np.ndarray, basis: np.ndarray, trace: float, error: float
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(values)
        for batch in batches:
            x = _vectors(batch.column("x"), len(sums)).astype(np.int64)
            off = n * x - sums
            fits = ((float(n) * x - sums) ** 2).sum(axis=1) < MOST
            deviation = np.where(fits, (off * off).sum(axis=1), 0)
            white = ((x - sums / n) @ basis) / np.sqrt(values)
            yield pa.RecordBatch.from_arrays([
                batch.column("vec_id").take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1), len(x)), pa.int32()),
                pa.array(np.full(len(x) * k, n), pa.int64()),
                pa.array(np.repeat(deviation, k), pa.int64(), mask=np.repeat(~fits, k)),
                pa.array(white.ravel(), pa.float64()),
                pa.array(np.tile(values / trace, len(x)), pa.float64()),
                pa.array(np.full(len(x) * k, error), pa.float64()),
            ], names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error.

    Every entry c of a vector becomes x = floor(256 c).  The fit list is each
    distinct x once: n vectors with sums S.  ``components`` leading eigenvectors of
    its covariance (divisor n) are found; ``whitened`` is a row's x - S/n along one,
    over the root of its eigenvalue, ``explained`` the eigenvalue's share of the
    trace, ``deviation`` the exact sum of (n x - S)^2, and ``identity_error`` how far
    the covariance of the whitened fit list is from the identity.

    Rows whose vector is null, empty or holds null or non-finite entries are left
    out, and so are vectors of another length than most have (of equally many, the
    longer).  Repeated rows and null vec_ids are each answered.  Directions without
    spread have no whitening and are not numbered: one distinct vector gives no
    rows, and neither does an empty table.  Equal eigenvalues share any basis of
    their space, the same for all rows.  A deviation from 9.2e18 on, which would not
    fit into 64 bits, is null.
    Other columns are ignored whatever their names.
    """
    x = whole_vectors(rows, vector)
    known = rows.select(F.col("vec_id").cast("long").alias("vec_id"), x.alias("x")).where("x is not null")
    lengths = known.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    common = lengths.orderBy(F.desc("rows"), F.desc("d")).first()
    none = rows.sparkSession.createDataFrame([], OUT)
    if common is None:
        return none
    d = common["d"]
    known = known.where(F.size("x") == d)
    fit = keep(known.select("x").distinct())
    totals = fit.select(F.posexplode("x").alias("i", "v")).groupBy("i").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.count(F.lit(1)).alias("n")
    ).collect()  # a row per dimension
    n, sums = totals[0]["n"], np.zeros(d, np.int64)
    for r in totals:
        sums[r["i"]] = int(r["s"])
    values, basis = fit_spectrum(fit, n, sums)
    trace = float(values.sum())
    spread = int((values > d * EPS * max(values[0], 0)).sum()) if values[0] > 0 else 0
    k = min(components, spread)
    if not k:
        return none
    values, basis = values[:k], basis[:, :k]
    white = _covariance(fit, n, sums / n, basis / np.sqrt(values))
    error = float(np.abs(white - np.eye(k)).max())
    return known.mapInArrow(_projected(n, sums, values, basis, trace, error), OUT)
