"""Whitening of embeddings by an incremental eigendecomposition.

Each partition keeps the spectrum of what it has seen: count, mean, eigenvalues and
eigenvectors of the scatter. A vector is a centred rank-one update: the new eigenvalues
are the roots of the secular equation between the old ones, after entries that do not
take part (no weight in the update, or equal eigenvalues rotated into one) are deflated;
the update is then adjusted to the roots found, so eigenvectors stay orthogonal. Vectors
come in blocks; a block is first brought to its triangular factor, whose rows have the
block's scatter, and these rows and the difference of the means are the updates. Spectra
of partitions are merged the same way, sixteen at a time: the eigenvectors of one, by
the roots of their eigenvalues, update the other. A last Rayleigh-Ritz pass projects all
vectors on the basis found and solves the small problem; it gives full precision.

What a task or the driver holds is one spectrum (dimensions squared), or sixteen while
merging, however many vectors there are. Entries are whole numbers; their sums and
deviations are exact, and vectors are centred before anything is multiplied.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

STEP, SHIFT = 64, 1_000_000
# Whole numbers a double holds exactly; entries beyond are taken as this bound.
LARGEST = 2**52
BLOCK = 4096
FAN_IN = 16
EPS = np.finfo(float).eps
# Eigenvalues below this share of the largest are rounding: such directions hold no variance and cannot be whitened.
RANK_TOLERANCE = 1e-12


def _deflated(lam: np.ndarray, basis: np.ndarray, z: np.ndarray, rho: float) -> np.ndarray:
    """Places that take part in the update; rotates equal eigenvalues so that one of them carries their weight."""
    tolerance = 8 * EPS * max(float(np.abs(lam).max()), rho * float(z @ z), np.finfo(float).tiny)
    weight = np.sqrt(rho) * np.abs(z)
    small = weight * np.sqrt(rho * float(z @ z)) <= tolerance
    z[small] = 0.0
    held = np.flatnonzero(~small)
    for a, b in zip(held[:-1], held[1:], strict=True):
        if lam[b] - lam[a] <= tolerance:
            r = float(np.hypot(z[a], z[b]))
            c, s = z[b] / r, z[a] / r
            left = c * basis[:, a] - s * basis[:, b]
            basis[:, b] = s * basis[:, a] + c * basis[:, b]
            basis[:, a] = left
            z[a], z[b] = 0.0, r
    return np.flatnonzero(z)


def secular_roots(lam: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z^2 / (lam - x)) for rising distinct ``lam`` and non-zero ``z``.

    Returned as (nearest pole, offset from it), since differences to the poles are what
    eigenvectors are made of. Each root lies between two poles, where the function rises
    from minus to plus infinity; its offset is found by bisection of a bracket that
    Newton steps on the function shrink.
    """
    weights = rho * z * z
    gap = np.append(np.diff(lam), weights.sum())
    middle = 1 + (weights / (lam[None, :] - (lam + gap / 2)[:, None])).sum(axis=1)
    k = len(lam)
    # a root above the middle is measured from the pole above it; the last has none
    up = (middle < 0) & (np.arange(k) < k - 1)
    pole = np.arange(k) + up
    poles = lam[None, :] - lam[pole][:, None]
    low = np.where(up, -gap / 2, 0.0)
    high = np.where(up, 0.0, np.where((np.arange(k) < k - 1), gap / 2, gap))
    at = (low + high) / 2
    for _ in range(80):
        apart = poles - at[:, None]
        part = weights / apart
        value = 1 + part.sum(axis=1)
        below = value < 0
        low, high = np.where(below, at, low), np.where(below, high, at)
        # the pole's own term is large; a step on x * f(x) is close to linear near it
        slope = (part / apart).sum(axis=1)
        step = at - value * at / (value + at * slope)
        inside = (step > low) & (step < high) & np.isfinite(step)
        following = np.where(inside, step, (low + high) / 2)
        if np.all(np.abs(following - at) <= 2 * EPS * np.abs(following)) or np.all(high - low <= 2 * EPS * np.maximum(np.abs(low), np.abs(high))):
            at = following
            break
        at = following
    return pole, at


@dataclass
class Spectrum:
    """Count, mean, rising eigenvalues of the scatter and their unit eigenvectors (columns)."""

    n: float
    mean: np.ndarray
    lam: np.ndarray
    basis: np.ndarray

    @classmethod
    def empty(cls, size: int) -> Spectrum:
        return cls(0.0, np.zeros(size), np.zeros(size), np.eye(size))

    def update(self, vector: np.ndarray, rho: float = 1.0) -> None:
        """Add rho * vector * vector' to the scatter."""
        z = self.basis.T @ vector
        if not rho or not z.any():
            return
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            held = _deflated(self.lam, self.basis, z, rho)
            if not len(held):
                return
            lam, part = self.lam[held], z[held]
            pole, offset = secular_roots(lam, part, rho)
            # lam_j - root_i, without cancellation
            apart = (lam[None, :] - lam[pole][:, None]) - offset[:, None]
            # the update whose roots these are exactly
            up = -apart  # root_i - lam_j
            gaps = lam[None, :] - lam[:, None]  # lam_i' - lam_j at [j, i']
            np.fill_diagonal(gaps, 1.0)
            ratio = np.ones((len(held), len(held)))
            ratio[:] = up.T / gaps  # [j, i]
            np.fill_diagonal(ratio, np.diagonal(up))
            fitted = np.sqrt(np.abs(np.prod(ratio, axis=1))) * np.sign(part)
            vectors = (fitted[None, :] / apart).T  # column i belongs to root i
            good = np.isfinite(vectors).all(axis=0)
            vectors[:, ~good] = 0.0
            vectors[np.flatnonzero(~good), np.flatnonzero(~good)] = 1.0
            vectors /= np.linalg.norm(vectors, axis=0)
        self.lam[held] = lam[pole] + offset
        self.basis[:, held] = self.basis[:, held] @ vectors
        order = np.argsort(self.lam, kind="stable")
        self.lam, self.basis = self.lam[order], self.basis[:, order]

    def shift(self, n: float, mean: np.ndarray) -> None:
        """Join ``n`` vectors of that mean, whose scatter about it is added by itself."""
        if not n:
            return
        total = self.n + n
        apart = mean - self.mean
        if self.n:
            self.update(apart, self.n * n / total)
        self.mean = self.mean + apart * (n / total)
        self.n = total

    def add(self, block: np.ndarray) -> None:
        """Add the rows of a block."""
        mean = block.mean(axis=0)
        centred = block - mean
        self.shift(float(len(block)), mean)
        rows = np.linalg.qr(centred, mode="r") if len(block) > block.shape[1] else centred
        for row in rows:
            self.update(row)

    def merge(self, other: Spectrum) -> None:
        self.shift(other.n, other.mean)
        for value, vector in zip(other.lam, other.basis.T, strict=True):
            if value > 0:
                self.update(vector, float(value))


def whole(block: np.ndarray) -> np.ndarray:
    """floor(64 * c) + 1000000 of every entry."""
    return np.clip(np.floor(STEP * block.astype(float)), -LARGEST, LARGEST).astype(np.int64) + SHIFT


def usable(vectors: DataFrame, column: str) -> DataFrame:
    """Rows whose vector is whole and finite and has the table's dimension.

    The dimension is the commonest length, of equally common ones the largest; vectors of
    another length cannot be compared and take no part, like those with nulls.
    """
    entry = F.col(column)
    good = entry.isNotNull() & (F.size(entry) > 0) & F.forall(entry, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = vectors.where(good)
    # one row per length; the first decides
    length = rows.groupBy(F.size(entry).alias("size")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("size")).first()
    return rows.where(F.size(entry) == (length["size"] if length else 0))


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A batch's vectors as rows."""
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _blocks(rows: Iterator[pa.RecordBatch], place: int) -> Iterator[np.ndarray]:
    for batch in rows:
        for start in range(0, batch.num_rows, BLOCK):
            yield whole(_matrix(batch.column(place).slice(start, BLOCK)))


def _summed(parts: DataFrame, of: Callable[[list[bytes]], bytes]) -> bytes | None:
    """The rows ``(slot, state)`` of all partitions reduced to one, sixteen neighbours at a time, in the order of slots."""

    def reduce(rows: pa.Table) -> pa.Table:
        found = sorted(zip(rows.column("slot").to_pylist(), rows.column("state").to_pylist(), strict=True))
        return pa.table({"slot": pa.array([found[0][0] // FAN_IN], pa.int64()), "state": pa.array([of([s for _, s in found])], pa.binary())})

    left = parts.rdd.getNumPartitions()
    while left > FAN_IN:
        group = F.floor(F.col("slot") / FAN_IN).alias("_group")
        parts = parts.groupBy(group).applyInArrow(reduce, "slot long, state binary")
        left = -(-left // FAN_IN)
    found = sorted((r["slot"], r["state"]) for r in parts.collect())  # sixteen at most
    return of([s for _, s in found]) if found else None


def _per_partition(rows: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], bytes | None]) -> DataFrame:
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = run(batches)
        if state is not None:
            slot = pa.array([TaskContext.get().partitionId()], pa.int64())
            yield pa.RecordBatch.from_arrays([slot, pa.array([state], pa.binary())], ["slot", "state"])

    return rows.mapInArrow(task, "slot long, state binary")


def _added(states: list[bytes]) -> bytes:
    return np.sum([np.frombuffer(s) for s in states], axis=0).tobytes()


@dataclass(frozen=True)
class Whitening:
    """What whitening a vector takes: the fit's count and exact sums, components (columns) and their eigenvalues."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    values: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: whole parts are subtracted as whole numbers."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n / self.n for s in self.sums])
        return (x - base) - rest

    def apply(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """sum((n * x - S)^2) per row, exact; null where it passes 64 bits."""
        base = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([s % self.n for s in self.sums], np.int64)
        apart = x - base
        if not len(x):
            return []
        if (np.abs(apart).max() + 1.0) ** 2 * float(self.n) ** 2 * x.shape[1] < 2.0**62:
            return ((self.n * apart - rest) ** 2).sum(axis=1).tolist()
        exact = [sum((self.n * a - r) ** 2 for a, r in zip(row, rest.tolist(), strict=True)) for row in apart.tolist()]
        return [d if d < 2**63 else None for d in exact]


def _encode(sums: list[int], spectrum: Spectrum) -> bytes:
    """Exact sums as text, then the spectrum's numbers."""
    head = " ".join(map(str, sums)).encode()
    numbers = np.concatenate([[spectrum.n], spectrum.mean, spectrum.lam, spectrum.basis.ravel()])
    return len(head).to_bytes(8, "little") + head + numbers.tobytes()


def _decode(state: bytes) -> tuple[list[int], Spectrum]:
    size = int.from_bytes(state[:8], "little")
    sums = [int(s) for s in state[8:8 + size].split()]
    numbers, d = np.frombuffer(state[8 + size:]), len(sums)
    return sums, Spectrum(float(numbers[0]), numbers[1:1 + d].copy(), numbers[1 + d:1 + 2 * d].copy(), numbers[1 + 2 * d:].reshape(d, d).copy())


def fit_spectrum(rows: DataFrame) -> tuple[list[int], Spectrum] | None:
    """Exact sums per dimension and the merged spectrum of all vectors in ``rows(vector)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        sums, spectrum = None, None
        for block in _blocks(batches, 0):
            if not len(block):
                continue
            if spectrum is None:
                sums, spectrum = [0] * block.shape[1], Spectrum.empty(block.shape[1])
            # two halves, whose sums stay below 64 bits
            high, low = (block >> 26).sum(axis=0).tolist(), (block & (2**26 - 1)).sum(axis=0).tolist()
            sums = [s + (h << 26) + q for s, h, q in zip(sums, high, low, strict=True)]
            spectrum.add(block.astype(float))
        return None if spectrum is None else _encode(sums, spectrum)

    def merge(states: list[bytes]) -> bytes:
        sums, spectrum = _decode(states[0])
        for state in states[1:]:
            more, other = _decode(state)
            sums = [a + b for a, b in zip(sums, more, strict=True)]
            spectrum.merge(other)
        return _encode(sums, spectrum)

    state = _summed(_per_partition(rows, run), merge)
    return None if state is None else _decode(state)


def refine(rows: DataFrame, n: int, sums: list[int], basis: np.ndarray, top: int) -> Whitening:
    """Rayleigh-Ritz on the whole basis: the covariance of all projected vectors, diagonalised."""
    basis, _ = np.linalg.qr(basis)
    start = Whitening(n, tuple(sums), basis, np.ones(basis.shape[1]), 1.0)
    sent = rows.sparkSession.sparkContext.broadcast(start)  # dimensions squared

    def run(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = None
        for block in _blocks(batches, 0):
            projected = sent.value.apply(block)
            own = projected.T @ projected
            total = own if total is None else total + own
        return None if total is None else total.tobytes()

    projected = np.frombuffer(_summed(_per_partition(rows, run), _added)).reshape(basis.shape) / n
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    values, turn = values[::-1], turn[:, ::-1]
    kept = int((values[:top] > max(RANK_TOLERANCE * values[0], 0.0)).sum())
    return Whitening(n, tuple(sums), basis @ turn[:, :kept], values[:kept], float(np.trace(projected)))


def identity_error(rows: DataFrame, fitted: Whitening) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity, measured over all rows."""
    size = len(fitted.values)
    if not size:
        return 0.0
    sent = rows.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> bytes | None:
        total = np.zeros((size + 1, size))
        seen = False
        for block in _blocks(batches, 0):
            white = sent.value.apply(block)
            total[:size] += white.T @ white
            total[size] += white.sum(axis=0)
            seen = seen or len(block) > 0
        return total.tobytes() if seen else None

    total = np.frombuffer(_summed(_per_partition(rows, run), _added)).reshape(size + 1, size) / fitted.n
    return float(np.abs(total[:size] - np.outer(total[size], total[size]) - np.eye(size)).max())


def fit(vectors: DataFrame, column: str = "embedding", top: int = 32) -> tuple[Whitening | None, float]:
    """The whitening of ``vectors`` and its measured identity error; None if no vector is usable."""
    rows = usable(vectors, column).select(column)
    found = fit_spectrum(rows)
    if found is None:
        return None, 0.0
    sums, spectrum = found
    fitted = refine(rows, round(spectrum.n), sums, spectrum.basis, top)
    return fitted, identity_error(rows, fitted)


def whiten(vectors: DataFrame, top: int = 32, column: str = "embedding") -> DataFrame:
    """Whitened components of ``vectors(vec_id, <column>)``, a row per usable vector and component.

    Returns vec_id, component (from 1, by falling eigenvalue), n, deviation, whitened,
    explained, identity_error. Rows with a null vector, an empty one, null or non-finite
    entries, or another length than the table's commonest take no part. Null and repeated
    ids keep all their rows; other columns are ignored. Directions without variance (fewer
    vectors than dimensions, a single vector, constant entries) cannot be whitened and
    have no component. Entries whose 64-fold lies beyond 2^52 count as 2^52; a deviation
    beyond 64 bits is null. An empty table gives an empty result.
    """
    out = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    fitted, error = fit(vectors, column, top)
    rows = usable(vectors, column).select(F.col("vec_id").cast("long").alias("vec_id"), column)
    size = 0 if fitted is None else len(fitted.values)
    if not size:
        return vectors.sparkSession.createDataFrame([], out)
    sent = vectors.sparkSession.sparkContext.broadcast(fitted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        share = model.values / model.trace
        for batch in batches:
            for start in range(0, batch.num_rows, BLOCK):
                part = batch.slice(start, BLOCK)
                x = whole(_matrix(part.column(1)))
                times = np.repeat(np.arange(len(x)), size)
                yield pa.RecordBatch.from_arrays([
                    part.column(0).take(pa.array(times)), pa.array(np.tile(np.arange(1, size + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(times), model.n, np.int64)), pa.array(model.deviations(x), pa.int64()).take(pa.array(times)),
                    pa.array(model.apply(x).ravel()), pa.array(np.tile(share, len(x))), pa.array(np.full(len(times), error)),
                ], ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.mapInArrow(run, out)
