"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

Method: with the centred rows Y (n x d), vectors u (one entry a row) and v (one entry a dimension) are made in turn by Yv and Y'u,
each made orthogonal to all earlier ones, so that Y V = U B with a small upper bidiagonal B.  The singular values of B over sqrt(n) are
the components' deviations, and V times its right singular vectors the components.

Scale: a u is never stored.  Each is a known combination of the products Yv, so u = Yp with a vector p of d numbers that the driver
holds; a pass over the rows computes its entries where the rows are, their products with all earlier u (for the full
reorthogonalisation) and Y'u at once, and sums these few numbers by shuffle.  Rows are written once as blocks of centred doubles of
about ``BLOCK_MB``; there are at most d passes, a second one where cancellation asks for it.  Numbers on the driver: d times the steps.

Steps end when the wanted components have converged or no direction is left.  In the first case another run, on what is orthogonal to
the components found, tells whether a value occurs more often than one run can see.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, received, send

COMPONENTS = 8
BLOCK_MB = 2.0
LARGEST = float(1 << 52)     # 1024 * c beyond this is no exact number of units
SCALE, SHIFT = 1024, 100_000
SUMS = "i int, j int, value double"
#: relative to the largest deviation: residual of a converged component, and deviation below which a direction has none
CONVERGED, NOTHING = 1e-15, 1e-13


def usable(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x array<long>): rows whose vector is not null, holds no null or non-finite entry and none beyond 2^52 / 1024."""
    v = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("e"))
    bad = F.exists("e", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) * SCALE > F.lit(LARGEST)))
    # the entries' own condition holds again inside, as Spark may compute x before it drops the row
    units = F.transform("e", lambda c: F.when(F.abs(c) * SCALE <= F.lit(LARGEST), F.floor(c * SCALE).cast("long") + F.lit(SHIFT).cast("long")))
    return v.where(F.col("e").isNotNull()).where(~bad).select("vec_id", units.alias("x"))


def sums_of(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Of each length of vectors: how many there are and the exact sum of each dimension."""
    parts = rows.select(F.size("x").alias("d"), F.posexplode("x").alias("i", "c")) \
        .groupBy("d", "i").agg(F.count("*").alias("n"), F.sum(F.col("c").cast("decimal(38,0)")).alias("s")).collect()
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(parts, key=lambda r: (r.d, r.i)):
        out.setdefault(r.d, (r.n, []))[1].append(int(r.s))
    return out


def _centred(d: int, n: int, sums: list[int], block_rows: int):
    """Blocks of rows: ids, exact squared deviations (null beyond 64 bits) and centred doubles."""
    total = np.array(sums, dtype=object)

    def run(batches):
        for batch in batches:
            ids, rows = batch.column("vec_id"), len(batch)
            x = np.asarray(batch.column("x").flatten()).reshape(rows, d)
            for lo in range(0, rows, block_rows):
                part = x[lo:lo + block_rows]
                far = max(abs(int(part.max()) * n - min(sums)), abs(int(part.min()) * n - max(sums)))
                if far * far * d < 1 << 63:
                    apart = part * np.int64(n) - np.array(sums, np.int64)
                    square, centred = (apart * apart).sum(axis=1).tolist(), apart / n
                else:
                    apart = part.astype(object) * n - total
                    square, centred = (apart * apart).sum(axis=1).tolist(), (apart / n).astype(np.float64)
                yield pa.RecordBatch.from_arrays([
                    pa.array([ids.slice(lo, len(part)).to_pylist()], pa.list_(pa.int64())),
                    pa.array([[s if s < 1 << 63 else None for s in square]], pa.list_(pa.int64())),
                    pa.array([np.ascontiguousarray(centred).tobytes()], pa.binary()),
                    pa.array([math.fsum(s / n / n for s in square)])], ["ids", "deviations", "y", "trace"])
    return run


def _blocks(batches, d: int):
    for batch in batches:
        for y in batch.column("y"):
            yield np.frombuffer(y.as_buffer(), np.float64).reshape(-1, d)


def _product(sent, d: int):
    """Sums over the rows for a u = Yp: (0, j) u with the j-th earlier u, (1, 0) u with itself, (2, i) Y'u."""
    def run(batches):
        p, earlier = received(sent)
        with_earlier, norm, back = np.zeros(earlier.shape[1]), 0.0, np.zeros(d)
        for y in _blocks(batches, d):
            u = y @ p
            with_earlier += (y @ earlier).T @ u
            norm += float(u @ u)
            back += y.T @ u
        sizes = [len(with_earlier), 1, d]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat([0, 1, 2], sizes), pa.int32()), pa.array(np.concatenate([np.arange(s) for s in sizes]), pa.int32()),
            pa.array(np.concatenate([with_earlier, [norm], back]))], ["i", "j", "value"])
    return run


def _pass(blocks: DataFrame, d: int, p: np.ndarray, earlier: np.ndarray) -> tuple[np.ndarray, float, np.ndarray]:
    sent = send(blocks.sparkSession, (p, earlier))
    held = {(r.i, r.j): r.s for r in blocks.select("y").mapInArrow(_product(sent, d), SUMS).groupBy("i", "j").agg(F.sum("value").alias("s")).collect()}
    sent.unpersist()
    return (np.array([held.get((0, j), 0.0) for j in range(earlier.shape[1])]), math.sqrt(held.get((1, 0), 0.0)),
            np.array([held.get((2, i), 0.0) for i in range(d)]))


def _without(v: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """v made orthogonal to the basis, twice."""
    for _ in range(2):
        v = v - basis @ (basis.T @ v)
    return v


def bidiagonalise(product, d: int, wanted: int, avoid: np.ndarray, seed: int = 1) -> tuple[np.ndarray, np.ndarray, bool]:
    """(singular values, right singular vectors as columns, whether nothing is left) of Y on what is orthogonal to ``avoid``.

    Largest first, ``wanted`` of them at most, none that are nothing.  ``product(p, earlier)`` is the pass over the rows
    described in ``_product``.  Steps end when the wanted values have converged or no direction is left.
    """
    random = np.random.RandomState(seed)
    V, P, back = np.zeros((d, 0)), np.zeros((d, 0)), np.zeros((d, 0))   # v's; p's with u = Yp; Y'u of each u
    alpha, beta, largest, link, v = [], [], 0.0, 0.0, None
    while True:
        if not link:  # the first direction, or a new one where the earlier ones are closed
            v = _without(random.randn(d), np.column_stack([avoid, V]))
            v /= np.linalg.norm(v)
        V = np.column_stack([V, v])
        # u = Yv - link * (u before), made orthogonal to every earlier u
        p = v - (link * P[:, -1] if link else 0.0)
        before = math.inf
        while True:
            c, norm, yu = product(p, P)
            p, yu = p - P @ c, yu - back @ c
            norm = math.sqrt(max(0.0, norm * norm - float(c @ c)))
            if norm <= NOTHING * max(largest, norm) or float(c @ c) <= 0.5 * norm * norm or norm >= before:
                break
            before = norm  # much was taken off: once more, on the rows
        largest = max([largest, norm])
        nothing = norm <= NOTHING * largest
        alpha.append(0.0 if nothing else norm)
        beta.append(link)
        P = np.column_stack([P, np.zeros(d) if nothing else p / norm])
        back = np.column_stack([back, np.zeros(d) if nothing else yu / norm])
        # the next v: Y'u - alpha * v, made orthogonal to every v
        further = _without(back[:, -1] - alpha[-1] * v, np.column_stack([avoid, V]))
        size, closed = float(np.linalg.norm(further)), not link
        link = size if size > NOTHING * largest else 0.0
        left, s, right = np.linalg.svd(np.diag(alpha) + np.diag(beta[1:], 1))
        k = V.shape[1]
        over = k + avoid.shape[1] == d or nothing and closed  # a random direction that Y maps to nothing: so are the others
        if over or k > wanted and np.all(link * np.abs(left[-1, :wanted]) <= CONVERGED * s[0]):
            keep = [i for i in range(min(wanted, k)) if s[i] > NOTHING * s[0]]
            return s[keep], V @ right[keep].T, bool(over)
        v = further / size if link else None


def principal(product, d: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values of Y and their vectors, each as often as it occurs.

    A run from one direction can find a value that occurs several times only once, so runs that ended before all directions were
    used are repeated on what is orthogonal to the vectors found, until that has nothing larger.
    """
    values, vectors = np.zeros(0), np.zeros((d, 0))
    for seed in range(1, d + 1):
        more, with_, over = bidiagonalise(product, d, min(wanted, d - len(values)), vectors, seed)
        least = values[wanted - 1] if len(values) >= wanted else 0.0
        found = len(more) and more[0] > least
        values, vectors = np.concatenate([values, more]), np.column_stack([vectors, with_])
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[:, order]
        if over or not found or len(values) == d:
            break
    return values[:wanted], vectors[:, :wanted]


def _covariance(sent, d: int):
    """Sums over the rows of whitened entries (0, i) and of their products (1 + i, j)."""
    def run(batches):
        into = received(sent)
        k = into.shape[1]
        first, second = np.zeros(k), np.zeros((k, k))
        for y in _blocks(batches, d):
            w = y @ into
            first += w.sum(axis=0)
            second += w.T @ w
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([np.zeros(k, int), 1 + i]), pa.int32()), pa.array(np.concatenate([np.arange(k), j]), pa.int32()),
                                          pa.array(np.concatenate([first, second.ravel()]))], ["i", "j", "value"])
    return run


def _whitened(sent, d: int, n: int):
    def run(batches):
        into, explained, error = received(sent)
        k = into.shape[1]
        for batch in batches:
            for ids, deviations, y in zip(batch.column("ids"), batch.column("deviations"), _blocks([batch], d), strict=True):
                rows, w = len(y), y @ into
                each = pa.array(np.repeat(np.arange(rows), k))
                yield pa.RecordBatch.from_arrays([
                    ids.values.take(each), pa.array(np.tile(np.arange(1, k + 1), rows), pa.int32()), pa.array(np.full(rows * k, n), pa.int64()),
                    deviations.values.take(each), pa.array(w.ravel()),
                    pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])
    return run


RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, components: int = COMPONENTS, block_mb: float = BLOCK_MB) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every usable row and component (from 1, largest first).

    Entries become x = floor(1024 c) + 100000; n vectors x with sums S.  ``whitened`` is x - S/n projected on the component (a unit
    eigenvector of x's covariance, divisor n; its largest entry is positive) over the square root of its eigenvalue, ``explained``
    the eigenvalue over the covariance's trace, ``deviation`` the exact sum of (n x - S)^2 (null where it exceeds 64 bits), and
    ``identity_error`` the largest entry, in size, of the whitened rows' covariance less the identity.

    Left out are vectors that are null or hold a null or non-finite entry, or one beyond 2^52 / 1024.  Vectors of each length are fitted
    apart.  Every row counts, repeated rows and null ids too.  There are at most as many components as dimensions and none
    without deviation, so equal vectors, a single one, empty ones and empty tables give no rows.  Other columns are not read.
    """
    spark = embeddings.sparkSession
    rows = usable(embeddings)
    result = None
    for d, (n, sums) in sums_of(rows).items():
        block_rows = max(1, int(block_mb * (1 << 20) / (8 * d)))
        blocks = materialize(rows.where(F.size("x") == d).mapInArrow(
            _centred(d, n, sums, block_rows), "ids array<long>, deviations array<long>, y binary, trace double"), "centred")
        trace = blocks.agg(F.sum("trace")).first()[0] / n
        if not trace > 0:
            continue
        values, vectors = principal(lambda p, earlier: _pass(blocks, d, p, earlier), d, min(components, d))  # noqa: B023
        vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
        into = vectors * (math.sqrt(n) / values)
        sent = send(spark, into)
        held = {(r.i, r.j): r.s for r in blocks.select("y").mapInArrow(_covariance(sent, d), SUMS).groupBy("i", "j").agg(F.sum("value").alias("s")).collect()}
        k = len(values)
        mean = np.array([held[0, j] for j in range(k)]) / n
        covariance = np.array([[held[1 + i, j] for j in range(k)] for i in range(k)]) / n - np.outer(mean, mean)
        error = float(np.abs(covariance - np.eye(k)).max())
        done = send(spark, (into, values ** 2 / n / trace, error))
        found = blocks.select("ids", "deviations", "y").mapInArrow(_whitened(done, d, n), RESULT)
        result = found if result is None else result.unionByName(found)
    return result if result is not None else spark.createDataFrame([], RESULT)
