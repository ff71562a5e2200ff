"""Whitening of embeddings by Chebyshev-filtered subspace iteration.

Every entry c of a vector counts as x = floor(64 c) + 1000000, an integer. The
covariance V of all vectors is never formed: it is applied to a block Q of
``COMPONENTS + EXTRA`` columns by a distributed pass that sums centred
X^T (X Q) over blocks of vectors, a matrix of that block's size a task.

1. A few Lanczos steps bound the spectrum from below.
2. Rayleigh-Ritz in the block gives approximate eigenvectors and eigenvalues.
   The smallest of these and the lower bound enclose the unwanted spectrum.
3. A Chebyshev polynomial of V, small on that interval and steep above it, is
   applied by its three-term recurrence, a pass a degree; QR and Rayleigh-Ritz
   follow. The product V Q of Rayleigh-Ritz is the recurrence's first step.
   Leading vectors that have settled aren't filtered again.
4. Steps 2 and 3 repeat until all components are certified: the residual
   |V q - e q| is at most ``TOLERANCE`` of the largest eigenvalue, or no longer
   falls (it has come to the rounding of the passes) and is below ``FLOOR`` of it.

The integers are stored once, in blocks of vectors as bytes; sums are exact.
The driver holds matrices of dimensions x block only. A task holds one block.

Defined results: rows whose vector is null or holds null or non-finite entries
are left out, and so are vectors of another length than the most frequent one
(of equally frequent ones the longest), which have no place in a covariance;
components without variance (relative to the largest below ``RANK``) have no
unit of length and are left out, so equal vectors alone, a single one or an
empty table give no rows; repeated rows and ids count each; a null vec_id is
kept; other columns are ignored. ``deviation`` is exact as long as it fits a
long; beyond that the query fails.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcel.llm.common import materialise
from parcel.session import ship_package

COMPONENTS, EXTRA = 32, 16
DEGREE, LANCZOS_STEPS = 8, 10
TOLERANCE, FLOOR, RANK = 1e-14, 1e-10, 1e-12
#: Residual at which a leading vector is filtered no more, and how far apart
#: a polynomial may set the columns of a block.
SETTLED, STEEPEST = 1e-13, 1e10
MOST_TURNS = 100
#: An entry's scale and what is added to it.
SCALE, SHIFT = 64, 1_000_000
#: Bytes of a block of vectors.
BLOCK_BYTES = 1 << 20

_BLOCKS = "ids array<long>, x binary"


def usable(embeddings: DataFrame, column: str = "embedding") -> DataFrame:
    """``vec_id, v`` (array of double) of the rows whose vector is complete,
    finite and as long as most."""
    v = F.col(column).cast("array<double>")
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where(F.col("v").isNotNull() & fine)
    most = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).limit(1).collect()
    return rows.where(F.size("v") == (most[0]["d"] if most else 0)).where(F.size("v") > 0)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``vec_id, x`` -> blocks; x without ``SHIFT``, which cancels out."""
    for whole in batches:
        if not whole.num_rows:
            continue
        d = len(whole.column(1)[0])
        rows = max(1, BLOCK_BYTES // (8 * d))
        for at in range(0, whole.num_rows, rows):
            batch = whole.slice(at, rows)
            x = np.ascontiguousarray(batch.column(1).flatten().to_numpy(zero_copy_only=False) - SHIFT, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.column(0).to_pylist()], pa.list_(pa.int64())), pa.array([x.tobytes()], pa.binary())], ["ids", "x"]
            )


def packed(embeddings: DataFrame) -> DataFrame:
    """The integers of all usable vectors, in blocks."""
    ship_package(embeddings.sparkSession)
    x = F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("long"))
    return materialise(usable(embeddings).select("vec_id", x.alias("x")).mapInArrow(_pack, _BLOCKS), "whitening-blocks")


def _blocks_of(batches: Iterator[pa.RecordBatch], d: int) -> Iterator[tuple[pa.Scalar, np.ndarray]]:
    for batch in batches:
        for ids, x in zip(batch.column(0), batch.column(1)):
            yield ids, np.frombuffer(x.as_buffer(), np.int64).reshape(-1, d)


def _summed(blocks: DataFrame, d: int, part: Callable[[np.ndarray], np.ndarray], shape: tuple[int, int], kind: str = "double") -> np.ndarray:
    """The sum of ``part`` (a matrix of this shape) over all blocks: a row of
    the matrix is a row of the table, so any number of tasks adds up in Spark."""
    height, width = shape
    columns = [f"c{j}" for j in range(width)]
    dtype = np.int64 if kind == "long" else np.float64

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, some = np.zeros(shape, dtype), False
        for _, x in _blocks_of(batches, d):
            total, some = total + part(x), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(height), pa.int32()), *map(pa.array, np.ascontiguousarray(total.T))], ["i", *columns])

    parts = blocks.mapInArrow(partial, ", ".join(["i int", *(f"{c} {kind}" for c in columns)]))
    got = parts.groupBy("i").agg(*[F.sum(c).alias(c) for c in columns]).toArrow()
    out = np.zeros(shape, dtype)
    out[got["i"].to_numpy()] = np.column_stack([got[c].to_numpy() for c in columns])
    return out


class Spectrum:
    """The largest eigenvalues of the blocks' covariance and their vectors."""

    def __init__(self, blocks: DataFrame, components: int = COMPONENTS, extra: int = EXTRA, degree: int = DEGREE):
        self.blocks, self.degree, self.passes, self.width = blocks, degree, 0, components + extra
        first = blocks.agg(F.sum(F.size("ids")).alias("n"), (F.first(F.length("x") / (F.size("ids") * 8))).cast("int").alias("d")).first()
        self.n, self.d = int(first["n"] or 0), int(first["d"] or 0)
        self.values, self.vectors, self.trace, self.residual = np.empty(0), np.empty((self.d, 0)), 0.0, 0.0
        if not self.n:
            return
        d, n = self.d, self.n
        self.sums = _summed(blocks, d, lambda x: x.sum(axis=0)[:, None], (d, 1), "long")[:, 0]
        self.mean = mean = np.array([int(s) / n for s in self.sums])
        self.trace = float(_summed(blocks, d, lambda x: np.square(x - mean).sum(axis=0)[:, None], (d, 1)).sum() / n)
        if self.trace > 0:
            self._iterate(components, min(d, components + extra))

    def apply(self, q: np.ndarray) -> np.ndarray:
        """V q: one pass over the vectors. Blocks get the same width in every
        pass, so that Spark compiles the sum once."""
        self.passes += 1
        mean, columns = self.mean, q.shape[1]
        if columns > 1:
            q = np.hstack([q, np.zeros((self.d, max(0, self.width - columns)))])

        def part(x: np.ndarray) -> np.ndarray:
            centred = x - mean
            return centred.T @ (centred @ q)

        return _summed(self.blocks, self.d, part, q.shape)[:, :columns] / self.n

    def _lower_bound(self, rng: np.random.Generator) -> float:
        """Below all eigenvalues but for the probability that the start has
        nothing of the smallest."""
        basis, alpha, beta = [rng.standard_normal(self.d)], [], []
        basis[0] /= np.linalg.norm(basis[0])
        for _ in range(min(LANCZOS_STEPS, self.d)):
            w = self.apply(basis[-1][:, None])[:, 0]
            alpha.append(basis[-1] @ w)
            for _ in range(2):
                for b in basis:
                    w = w - (b @ w) * b
            beta.append(np.linalg.norm(w))
            if beta[-1] <= 1e-12 * self.trace:
                break
            basis.append(w / beta[-1])
        theta, s = np.linalg.eigh(np.diag(alpha) + np.diag(beta[: len(alpha) - 1], 1) + np.diag(beta[: len(alpha) - 1], -1))
        return max(0.0, float(theta[0] - beta[len(alpha) - 1] * abs(s[-1, 0])))

    def _filtered(self, q: np.ndarray, vq: np.ndarray, found: np.ndarray, low: float, cut: float, high: float) -> np.ndarray:
        """The Chebyshev polynomial that is small on [low, cut], scaled to 1 at
        ``high``, of V times q; the vectors ``found`` are kept out. Its degree
        is so low that it sets no two columns more than ``STEEPEST`` apart."""
        centre, half = (low + cut) / 2, max((cut - low) / 2, 1e-3 * (high - low))
        sigma = first = half / (high - centre)
        degree = int(np.clip(np.log(STEEPEST) / np.log(2 / first), 1, self.degree))
        before, now = q, (vq - centre * q) * (sigma / half)
        for _ in range(degree - 1):
            now -= found @ (found.T @ now)
            after = 1 / (2 / first - sigma)
            before, now = now, (self.apply(now) - centre * now) * (2 * after / half) - sigma * after * before
            sigma = after
        return now / np.linalg.norm(now, axis=0)

    def _iterate(self, wanted: int, width: int) -> None:
        rng = np.random.default_rng(12)
        low = self._lower_bound(rng) if width < self.d else 0.0
        q, _ = np.linalg.qr(rng.standard_normal((self.d, width)))
        best = np.inf
        for _ in range(MOST_TURNS):
            vq = self.apply(q)
            theta, u = np.linalg.eigh((q.T @ vq + vq.T @ q) / 2)
            theta, u = theta[::-1], u[:, ::-1]
            q, vq = q @ u, vq @ u
            off = np.linalg.norm(vq - q * theta, axis=0)[:wanted]
            self.residual = float(off.max() / theta[0])
            if self.residual <= TOLERANCE or best <= FLOOR and self.residual > best / 2:
                break
            best = min(best, self.residual)
            done = min(int(np.argmax(off > SETTLED * theta[0])), width - 1)  # the leading ones that have settled
            rest = self._filtered(q[:, done:], vq[:, done:], q[:, :done], low, float(theta[-1]), float(theta[done]))
            q, _ = np.linalg.qr(np.hstack([q[:, :done], rest]))
        else:
            raise ArithmeticError(f"not certified: a residual of {self.residual:.2g} after {MOST_TURNS} turns")
        kept = int((theta[:wanted] > RANK * theta[0]).sum())
        signs = np.sign(q[np.abs(q[:, :kept]).argmax(axis=0), np.arange(kept)])
        self.values, self.vectors = theta[:kept], q[:, :kept] * signs

    def whitener(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def identity_error(self) -> float:
        """Of the whitened vectors' covariance, from a pass over them."""
        k, mean, to = len(self.values), self.mean, self.whitener()

        def part(x: np.ndarray) -> np.ndarray:
            w = (x - mean) @ to
            return np.vstack([w.T @ w, w.sum(axis=0)])

        sums = _summed(self.blocks, self.d, part, (k + 1, k)) / self.n
        return float(np.abs(sums[:k] - np.outer(sums[k], sums[k]) - np.eye(k)).max())


def whitened(found: Spectrum) -> DataFrame:
    """``vec_id, component, deviation, whitened``: a row for each vector and
    component."""
    n, d, k, sums, mean = found.n, found.d, len(found.values), getattr(found, "sums", None), getattr(found, "mean", None)
    to = found.whitener()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, x in _blocks_of(batches, d) if k else ():
            if np.square((x - mean) * n).sum(axis=1).max() > 9e18:
                raise OverflowError("a deviation doesn't fit a long")
            deviation = np.square(n * x - sums).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.values.take(pa.array(np.repeat(np.arange(len(x)), k))),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.repeat(deviation, k)),
                    pa.array(((x - mean) @ to).ravel()),
                ],
                ["vec_id", "component", "deviation", "whitened"],
            )

    return found.blocks.mapInArrow(rows, "vec_id long, component int, deviation long, whitened double")


def query(embeddings: DataFrame) -> DataFrame:
    found = Spectrum(packed(embeddings))
    shares = F.array(*[F.lit(float(e / found.trace)) for e in found.values]).cast("array<double>")
    error = found.identity_error() if len(found.values) else 0.0
    return whitened(found).select(
        "vec_id",
        "component",
        F.lit(found.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("component") - 1).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
