"""Whitening of embeddings: pivoted Cholesky of the centred scatter, then one-sided Jacobi.

All sums over vectors are sums of whole numbers, so they are exact and do not depend on how the
rows are dealt to tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.session import freeze

COMPONENTS = 4
SCALE = 256
# Whole numbers below this are exact as doubles, and so are their sums.
_EXACT = 2**53
_SWEEPS = 60
_DIGITS = 38


def scaled_vectors(vectors: DataFrame, vector: str, scale: int, x: str = "x") -> DataFrame:
    """``vectors`` without those that have holes, with every entry as floor(scale * c) under ``x``.

    Null vectors, empty ones and those with null or non-finite entries go. A value beyond the
    range of a long becomes the nearest long.
    """
    given = F.col(vector)
    finite = F.forall(
        given,
        lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))),
    )
    top = float(2**63 - 1024)

    def entry(e):
        value = F.floor(F.greatest(F.least(e.cast("double") * scale, F.lit(top)), F.lit(-top)))
        return value.cast("bigint")

    return vectors.where(given.isNotNull() & (F.size(given) > 0) & finite).withColumn(
        x, F.transform(given, entry)
    )


def _matrices(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a batch, by length."""
    lists = batch.column("x")
    lengths = np.asarray(lists.value_lengths())
    for length in np.unique(lengths):
        part = lists.filter(pa.array(lengths == length))
        values = np.asarray(part.flatten(), dtype=np.int64)
        yield int(length), values.reshape(-1, int(length))


def _whole_products(z: np.ndarray) -> np.ndarray:
    """The sum of z z' over the rows of z, exact, as Python integers where doubles can't hold it."""
    most = int(np.abs(z.astype(object)).max()) if z.dtype == object else int(np.abs(z).max())
    if most < 2**26:
        rows = max(1, _EXACT // max(1, most * most))
        total = np.zeros((z.shape[1], z.shape[1]), dtype=object)
        for start in range(0, len(z), rows):
            part = z[start : start + rows].astype(np.float64)
            total += (part.T @ part).astype(np.int64).astype(object)
        return total
    z = z.astype(object)
    return z.T @ z


def _less(x: np.ndarray, centre: np.ndarray) -> np.ndarray:
    """x less the centre, as Python integers where longs can't hold it."""
    reach = max(int(x.max()), -int(x.min())) + max(map(abs, centre.tolist()), default=0)
    return x - centre.astype(np.int64) if reach < 2**62 else x.astype(object) - centre


def _row_sums(values: Iterator[tuple[int, int, list[int]]]) -> pa.RecordBatch:
    rows = list(values)
    text = [[str(v) for v in row] for _, _, row in rows]
    return pa.RecordBatch.from_arrays(
        [
            pa.array([length for length, _, _ in rows], pa.int32()),
            pa.array([at for _, at, _ in rows], pa.int32()),
            pa.array(text, pa.list_(pa.string())),
        ],
        ["length", "at", "sums"],
    )


_SUMS = "length int, at int, sums array<string>"


def _added(rows: DataFrame) -> dict[int, dict[int, list[int]]]:
    """Sums of tasks added up per row of the matrix: {length: {row: numbers}}.

    A row's group has one list of fixed length per task; what reaches the driver has the size of
    the matrices, whatever the number of vectors.
    """

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = sum(np.array([int(v) for v in sums], dtype=object) for sums in pdf["sums"])
        return pd.DataFrame(
            {
                "length": pdf["length"].iloc[:1],
                "at": pdf["at"].iloc[:1],
                "sums": [[str(v) for v in total]],
            }
        )

    found: dict[int, dict[int, list[int]]] = {}
    for row in rows.groupBy("length", "at").applyInPandas(add, _SUMS).toLocalIterator():
        found.setdefault(row["length"], {})[row["at"]] = [int(v) for v in row["sums"]]
    return found


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors: their number, followed by the sum of every dimension."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for length, x in _matrices(batch):
            small = len(x) * max(int(x.max()), -int(x.min())) < 2**62
            own = x.sum(axis=0).astype(object) if small else x.astype(object).sum(axis=0)
            own = np.concatenate([np.array([len(x)], dtype=object), own])
            found[length] = found.get(length, 0) + own
    yield _row_sums((length, 0, list(sums)) for length, sums in found.items())


def _scatters(centres: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, np.ndarray] = {}
        for batch in batches:
            for length, x in _matrices(batch):
                found[length] = found.get(length, 0) + _whole_products(_less(x, centres[length]))
        yield _row_sums(
            (length, i, list(row)) for length, own in found.items() for i, row in enumerate(own)
        )

    return run


def pivoted_cholesky(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``order, L`` with ``matrix[order][:, order] = L L'``; L has as many columns as the rank.

    The largest remaining diagonal entry is the next pivot. An entry that is left with rounding
    errors of its own first value counts as used up.
    """
    rest = matrix.astype(np.float64).copy()
    size = len(rest)
    order = np.arange(size)
    factor = np.zeros((size, size))
    least = np.diag(rest).copy() * size * np.finfo(float).eps
    for k in range(size):
        diagonal = np.diag(rest)[k:]
        open_ = np.where(diagonal > least[k:], diagonal, -np.inf)
        best = k + int(np.argmax(open_))
        if not open_[best - k] > 0:
            return order, factor[:, :k]
        swap = [best, k]
        for a in (rest, factor):
            a[[k, best]] = a[swap]
        rest[:, [k, best]] = rest[:, swap]
        order[[k, best]], least[[k, best]] = order[swap], least[swap]
        factor[k, k] = np.sqrt(rest[k, k])
        factor[k + 1 :, k] = rest[k + 1 :, k] / factor[k, k]
        rest[k + 1 :, k + 1 :] -= np.outer(factor[k + 1 :, k], factor[k + 1 :, k])
    return order, factor


def one_sided_jacobi(factor: np.ndarray) -> np.ndarray:
    """The columns of the factor rotated against each other until all are orthogonal.

    A sweep meets every pair once, in rounds of disjoint pairs as in a tournament, so that a round
    is a few array operations.
    """
    a = factor.copy()
    columns = a.shape[1]
    if columns < 2:
        return a
    seats = np.arange(columns + columns % 2)
    tolerance = len(a) * np.finfo(float).eps
    for _ in range(_SWEEPS):
        turned = False
        for _ in range(len(seats) - 1):
            half = len(seats) // 2
            p, q = seats[:half], seats[half:][::-1]
            real = (p < columns) & (q < columns)
            p, q = p[real], q[real]
            left, right = a[:, p], a[:, q]
            alpha, beta = (left * left).sum(axis=0), (right * right).sum(axis=0)
            gamma = (left * right).sum(axis=0)
            on = np.abs(gamma) > tolerance * np.sqrt(alpha) * np.sqrt(beta)
            if on.any():
                turned = True
                p, q, left, right = p[on], q[on], left[:, on], right[:, on]
                zeta = (beta[on] - alpha[on]) / (2.0 * gamma[on])
                sign = np.where(zeta >= 0, 1.0, -1.0)
                t = sign / (np.abs(zeta) + np.hypot(1.0, zeta))
                c = 1.0 / np.hypot(1.0, t)
                s = c * t
                a[:, p], a[:, q] = c * left - s * right, s * left + c * right
            seats = np.concatenate([seats[:1], seats[-1:], seats[1:-1]])
        if not turned:
            break
    return a


def components_of(scatter: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """``values, vectors`` (as columns) of the largest eigenvalues of a scatter matrix.

    Fewer than wanted where the rank is smaller. Every vector's largest entry is positive.
    """
    order, factor = pivoted_cholesky(scatter)
    rotated = one_sided_jacobi(factor)
    norms = np.sqrt((rotated * rotated).sum(axis=0))
    first = np.argsort(-norms, kind="stable")[:wanted]
    first = first[norms[first] > 0]
    vectors = np.zeros((len(scatter), len(first)))
    vectors[order] = rotated[:, first] / norms[first]
    if len(first):
        largest = np.abs(vectors).argmax(axis=0)
        vectors *= np.sign(vectors[largest, np.arange(len(first))])
    return norms[first] ** 2, vectors


@dataclass
class Whitening:
    """A whitening of the vectors of one length.

    ``centre + rest / n`` is the mean, with a whole ``centre``; ``sums = n * mean``. ``explained``
    is every component's share of the total variance.
    """

    n: int
    sums: list[int]
    centre: np.ndarray
    rest: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    explained: list[float]
    identity_error: float | None = None

    @classmethod
    def from_sums(cls, n: int, sums: list[int], centre: np.ndarray, products, wanted: int):
        """From exact sums: ``products`` are those of the vectors less the centre."""
        rest = [s - n * int(c) for s, c in zip(sums, centre)]
        size = len(sums)
        # n times the scatter about the mean, a whole number, divided once.
        scatter = np.array(
            [[(n * products[i][j] - rest[i] * rest[j]) / n for j in range(size)] for i in range(size)]
        )
        values, vectors = components_of(scatter, wanted)
        trace = sum(n * products[i][i] - rest[i] * rest[i] for i in range(size)) / n
        return cls(
            n, sums, centre, np.array([r / n for r in rest]), values / n, vectors,
            [float(v / trace) for v in values],
        )

    def whitened(self, x: np.ndarray) -> np.ndarray:
        centred = _less(x, self.centre).astype(np.float64) - self.rest
        return centred @ (self.vectors / np.sqrt(self.values))

    def deviations(self, x: np.ndarray) -> list[int]:
        """Sum over dimensions of (n * x - sum)^2, exact."""
        most = max(int(x.max()), -int(x.min())) * self.n + max(map(abs, self.sums))
        kind = np.int64 if most * most * x.shape[1] < 2**62 else object
        apart = x.astype(kind) * self.n - np.array(self.sums, dtype=kind)
        return (apart * apart).sum(axis=1).tolist()


def _moments(models: dict[int, Whitening]):
    """Per length: the sums of the whitened values, then those of their products."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            lengths = pdf["x"].map(len)
            for length, part in pdf.groupby(lengths):
                w = models[length].whitened(np.stack(part["x"].to_numpy()))
                cells = np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])
                yield pd.DataFrame({"length": length, "at": range(len(cells)), "value": cells})

    return run


def _measure_identity(fit: DataFrame, models: dict[int, Whitening]) -> None:
    """Set every model's largest entry of the whitened vectors' covariance less the identity."""
    rows = fit.mapInPandas(_moments(models), "length int, at int, value double")
    sums: dict[int, dict[int, float]] = {}
    for row in rows.groupBy("length", "at").agg(F.sum("value").alias("value")).collect():
        sums.setdefault(row["length"], {})[row["at"]] = row["value"]
    for length, model in models.items():
        k = len(model.values)
        if k:
            cells = np.array([sums[length][at] for at in range(k + k * k)]) / model.n
            covariance = cells[k:].reshape(k, k) - np.outer(cells[:k], cells[:k])
            model.identity_error = float(np.abs(covariance - np.eye(k)).max())


def fit_whitening(
    vectors: DataFrame, x: str = "x", components: int = COMPONENTS
) -> dict[int, Whitening]:
    """A whitening per length of vectors, fitted on every distinct vector of whole numbers once.

    Copies are added up before the shuffle. The distinct vectors are written once and read three
    times: for their sums, for their scatter about the mean, and to measure what came out. The
    driver gets sums of the size of the scatter matrix and decomposes that.
    """
    fit = freeze(vectors.select(F.col(x).alias("x")).distinct(), "whitening-fit")
    totals = {length: rows[0] for length, rows in _added(fit.mapInArrow(_totals, _SUMS)).items()}
    # The whole number nearest to the mean.
    centres = {
        length: np.array([(2 * s + n) // (2 * n) for s in sums], dtype=object)
        for length, (n, *sums) in totals.items()
    }
    products = _added(fit.mapInArrow(_scatters(centres), _SUMS))
    models = {
        length: Whitening.from_sums(n, sums, centres[length], products[length], components)
        for length, (n, *sums) in totals.items()
    }
    _measure_identity(fit, models)
    return models


def whiten(
    vectors: DataFrame,
    vector: str = "embedding",
    scale: int = SCALE,
    components: int = COMPONENTS,
) -> DataFrame:
    """``vectors`` with ``whitening`` added: ``n, deviation, whitened, explained, identity_error``.

    Rows whose vector is null, empty or has null or non-finite entries are left out; all others
    stay, repeated ones and such without an id too. Entries become floor(scale * c). Vectors of
    different lengths have a whitening each. ``whitened`` and ``explained`` have a value per
    component, numbered by falling eigenvalue, as many as ``components`` or the length if that is
    smaller. Components beyond the rank (all, where there is one distinct vector) have null as
    whitened value and explain nothing; ``identity_error`` is about the others, and null without
    any. ``deviation`` is the sum over dimensions of (n * x - sum)^2, null beyond 38 digits. A
    column named ``whitening`` is replaced. An empty table gives an empty table.
    """
    vectors = vectors.drop("whitening") if vector != "whitening" else vectors
    given = scaled_vectors(vectors, vector, scale, "_x")
    models = fit_whitening(given, "_x", components)

    @F.pandas_udf(
        f"n bigint, deviation decimal({_DIGITS},0), whitened array<double>, "
        "explained array<double>, identity_error double"
    )
    def told(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for xs in parts:
            columns: list[list] = [[None] * len(xs) for _ in range(5)]
            lengths = xs.map(len).to_numpy()
            for length in np.unique(lengths):
                model = models[int(length)]
                at = np.flatnonzero(lengths == length)
                x = np.stack(xs.iloc[at].to_numpy())
                lacking = min(components, int(length)) - len(model.values)
                explained = model.explained + [0.0] * lacking
                rows = zip(at, model.deviations(x), model.whitened(x).tolist())
                for i, deviation, values in rows:
                    columns[0][i] = model.n
                    fits = deviation < 10**_DIGITS
                    columns[1][i] = Decimal(deviation) if fits else None
                    columns[2][i] = values + [None] * lacking
                    columns[3][i] = explained
                    columns[4][i] = model.identity_error
            names = ["n", "deviation", "whitened", "explained", "identity_error"]
            yield pd.DataFrame(dict(zip(names, columns)))

    return given.withColumn("whitening", told("_x")).drop("_x")
