"""Embedding whitening: covariance by distributed sums, its components by QDWH spectral divide and conquer, projection in tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from riskloom.session import materialize

#: What an entry is multiplied by before it is rounded down.
SCALE = 256
#: Most dimensions: the driver holds a few square matrices of this size.
MOST_DIMS = 4096
_EPS = float(np.finfo(float).eps)


def integers(vectors: DataFrame) -> DataFrame:
    """``vec_id, x`` of the rows whose vector and entries are all there and finite: ``x`` is floor(SCALE * entry)."""
    finite = F.forall("embedding", lambda c: F.coalesce((c < float("inf")) & (c > float("-inf")), F.lit(False)))
    rows = vectors.where(F.col("embedding").isNotNull()).where(finite)
    return rows.select(F.col("vec_id"), F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE).cast("long")).alias("x"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column whose rows have ``width`` entries each, as a matrix."""
    return np.asarray(column.flatten()).reshape(-1, width)


def total(rows: DataFrame, width: int, part: Callable[[np.ndarray], np.ndarray], like: np.ndarray) -> np.ndarray:
    """The sum over all rows' ``part`` (matrix of rows to an array shaped and typed as ``like``).

    A task adds up its own batches and sends the sum line by line; lines meet in two steps, so that
    neither a task nor the driver receives the sums of all tasks. A step adds lines as they come.
    """
    lines = like.reshape(len(like), -1)

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for b in batches:
            x = matrix(b.column("x"), width)
            for at in range(0, len(x), 4096):
                step = part(x[at : at + 4096]).reshape(lines.shape)
                held = step if held is None else held + step
        if held is not None:
            yield sent(np.arange(len(held)), held)

    def sent(number: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(number.astype(np.int64)), pa.array([v.tobytes() for v in values], pa.binary())], ["line", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, None
        for b in batches:
            for line, raw in zip(b.column("line").to_pylist(), b.column("sums")):
                values = np.frombuffer(raw.as_buffer(), lines.dtype)
                if line != now:
                    if now is not None:
                        yield sent(np.array([now]), held[None])
                    now, held = line, values.copy()
                else:
                    held += values
        if now is not None:
            yield sent(np.array([now]), held[None])

    schema = "line bigint, sums binary"
    sums = rows.select("x").mapInArrow(own, schema).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(64)))
    for keys in (("line", "salt"), ("line",)):
        dealt = sums.repartition(*keys).sortWithinPartitions(*keys)
        if "salt" in keys:
            dealt = dealt.select((F.col("line") * 64 + F.col("salt")).alias("line"), "sums")
            sums = dealt.mapInArrow(add, schema).select(F.floor(F.col("line") / 64).alias("line"), "sums")
        else:
            sums = dealt.select("line", "sums").mapInArrow(add, schema)
    out = np.zeros(lines.shape, lines.dtype)
    for r in sums.collect():
        out[r["line"]] = np.frombuffer(r["sums"], lines.dtype)
    return out.reshape(like.shape)


# --- QDWH spectral divide and conquer ---------------------------------------------------------------


def polar_sign(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a symmetric matrix, by dynamically weighted Halley steps.

    Steps are taken by QR while their weights are large, so that small singular values are not
    lost, and by Cholesky factors afterwards. Every step is made symmetric.
    """
    x = a / np.linalg.norm(a, 1)
    low, one = _EPS, np.eye(len(a))
    for _ in range(30):
        square = min(low * low, 1.0)
        root = (4 * (1 - square) / square**2) ** (1 / 3)
        wide = np.sqrt(1 + root)
        weight = wide + np.sqrt(max(0.0, 8 - 4 * root + 8 * (2 - square) / (square * wide))) / 2
        b = (weight - 1) ** 2 / 4
        c = weight + b - 1
        if c > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(c) * x, one]))
            new = b / c * x + (weight - b / c) / np.sqrt(c) * q[: len(a)] @ q[len(a) :].T
        else:
            half = np.linalg.solve(np.linalg.cholesky(one + c * x @ x), x)
            other = np.linalg.solve(np.linalg.cholesky(one + c * x @ x), one)
            new = b / c * x + (weight - b / c) * half.T @ other
        new = (new + new.T) / 2
        moved, x = np.linalg.norm(new - x), new
        low = min(1.0, low * (weight + b * square) / (1 + c * square))
        if low > 1 - 10 * _EPS and moved < (10 * _EPS) ** (1 / 3):
            break
    return x


def halves(a: np.ndarray) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift, or None if all eigenvalues are equal.

    The first shift is the mean eigenvalue, which lies between the largest and the smallest. Where
    a shift falls on an eigenvalue the projector is not one; the shifts around it are tried then,
    and the one that leaves the smallest coupling is taken.
    """
    m, scale = len(a), np.linalg.norm(a)
    mean = np.trace(a) / m
    apart = a - mean * np.eye(m)
    spread = np.linalg.norm(apart) / np.sqrt(m)
    if spread <= 4 * _EPS * max(scale, 1e-300):
        return None
    best, rng = None, np.random.default_rng(13)
    for step in (0, 0.13, -0.13, 0.31, -0.31, 0.53, -0.53, 0.71, -0.71, 0.93, -0.93):
        projector = (polar_sign(apart - step * spread * np.eye(m)) + np.eye(m)) / 2
        rank = int(round(np.trace(projector)))
        if not 0 < rank < m:
            continue
        q, _ = np.linalg.qr(projector @ rng.standard_normal((m, rank)), mode="complete")
        q, _ = np.linalg.qr(np.hstack([projector @ q[:, :rank], q[:, rank:] - projector @ q[:, rank:]]))
        coupling = np.linalg.norm(q[:, :rank].T @ a @ q[:, rank:]) / scale
        if best is None or coupling < best[0]:
            best = coupling, q[:, :rank], q[:, rank:]
        if coupling < 4 * m * _EPS:
            break
    return best and best[1:]


def spectrum(a: np.ndarray, want: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``want`` largest eigenvalues of a symmetric matrix, falling, and their unit vectors as columns.

    Every split is recursive: the upper subspace is taken apart first, the lower one only as far as
    components are still wanted.
    """

    def vectors(part: np.ndarray, some: int) -> np.ndarray:
        parted = halves(part) if len(part) > 1 else None
        if parted is None:
            return np.eye(len(part))[:, :some]
        upper, lower = parted
        out = upper @ vectors(both(upper.T @ part @ upper), min(some, upper.shape[1]))
        if some > upper.shape[1]:
            out = np.hstack([out, lower @ vectors(both(lower.T @ part @ lower), some - upper.shape[1])])
        return out

    def both(m: np.ndarray) -> np.ndarray:
        return (m + m.T) / 2

    v = vectors(both(a), min(want, len(a)))
    v /= np.linalg.norm(v, axis=0)
    values = np.einsum("ij,ij->j", v, a @ v)
    order = np.argsort(-values, kind="stable")
    return values[order], v[:, order]


# --- the operator -----------------------------------------------------------------------------------


class Whitener:
    """Mean, components and eigenvalues of the distinct integer vectors of a table; ``apply`` projects rows on them."""

    def __init__(self, rows: DataFrame, components: int | None = 4):
        sizes = rows.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
        self.width = sizes["width"] if sizes else 0
        if self.width > MOST_DIMS:
            raise ValueError(f"vectors have {self.width} dimensions, at most {MOST_DIMS} are supported")
        self.n, self.values = 0, np.zeros(0)
        if not self.width:
            return
        fit = materialize(rows.where(F.size("x") == self.width).select("x").distinct(), "fit-list")
        width, mark = self.width, np.zeros(self.width + 1, np.int64)
        sums = total(fit, width, lambda x: np.append(x.sum(axis=0), len(x)), mark)
        self.sums, self.n = sums[:-1], int(sums[-1])
        mean = self.mean = self.sums / self.n

        def product(x: np.ndarray) -> np.ndarray:
            apart = x - mean
            return apart.T @ apart

        self.covariance = total(fit, width, product, np.zeros((width, width))) / self.n
        self.trace = float(np.trace(self.covariance))
        if not self.trace > 0:
            return
        values, vectors = spectrum(self.covariance, components or width)
        real = values > width * _EPS * values[0]
        self.values, self.vectors = values[real], vectors[:, real]
        scaled = self.scaled = self.vectors / np.sqrt(self.values)
        k = len(self.values)
        centre = total(fit, width, lambda x: ((x - mean) @ scaled).sum(axis=0), np.zeros(k)) / self.n

        def white(x: np.ndarray) -> np.ndarray:
            apart = (x - mean) @ scaled - centre
            return apart.T @ apart

        self.error = float(np.abs(total(fit, width, white, np.zeros((k, k))) / self.n - np.eye(k)).max())

    def apply(self, rows: DataFrame) -> DataFrame:
        """``vec_id, deviation, whitened`` per row of the fitted width: the exact squared distance from the
        mean times n, and the list of projections. A distance above 64 bits is null."""
        width, n, sums, mean, scaled = self.width, self.n, self.sums, self.mean, self.scaled
        top = (1 << 63) - 1

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for at in range(0, b.num_rows, 4096):
                    part = b.slice(at, 4096)
                    x = matrix(part.column("x"), width)
                    widest = (n * int(np.abs(x).max(initial=0)) + int(np.abs(sums).max())) ** 2 * width
                    away = x * n - sums if widest <= top else x.astype(object) * n - sums.astype(object)
                    far = [d if d <= top else None for d in (away * away).sum(axis=1).tolist()]
                    white = (x - mean) @ scaled
                    yield pa.RecordBatch.from_arrays(
                        [part.column("vec_id"), pa.array(far, pa.int64()), pa.array(list(white), pa.list_(pa.float64()))], ["vec_id", "deviation", "whitened"]
                    )

        kind = rows.schema["vec_id"].dataType.simpleString()
        return rows.where(F.size("x") == width).mapInArrow(run, f"vec_id {kind}, deviation bigint, whitened array<double>")


def whiten(vectors: DataFrame, components: int = 4) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error`` per row and component.

    Rows whose vector is null or has null or non-finite entries are left out. All others are
    whitened; mean and covariance are those of the distinct integer vectors, each once, so copies
    weigh nothing. Vectors of other lengths than the most frequent one (the longest of these, on a
    tie) are left out too. Components without variance do not appear, so equal vectors, a single
    one, empty vectors and an empty table give no rows. Repeated and null ids are rows like others;
    other columns are ignored.
    """
    rows = integers(vectors)
    fitted = Whitener(rows, components)
    k = len(fitted.values)
    if not k:
        return rows.where("false").selectExpr(
            "vec_id", "0 AS component", "0L AS n", "0L AS deviation", "0D AS whitened", "0D AS explained", "0D AS identity_error"
        )
    share = F.array(*(F.lit(float(v / fitted.trace)) for v in fitted.values))
    each = fitted.apply(rows).select("vec_id", "deviation", F.posexplode("whitened").alias("p", "whitened"))
    return each.select(
        "vec_id", (F.col("p") + 1).cast("int").alias("component"), F.lit(fitted.n).cast("long").alias("n"), "deviation", "whitened",
        F.element_at(share, F.col("p") + 1).alias("explained"), F.lit(fitted.error).alias("identity_error"),
    )
