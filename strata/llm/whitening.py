"""Embedding whitening by QDWH spectral divide and conquer (operator 13).

Vectors become integers x = floor(1024 c) + 100000. Their mean and covariance are sums that Spark
adds up; the eigenvectors of the covariance come from polar decompositions; every vector is then
projected with the broadcast components.

1. One pass adds up the integers per dimension (exactly), a second one the products of the centred
   entries: each task adds its rows up in numpy and sends one number per pair of dimensions, which
   Spark adds by pair. The driver gets a matrix whose side is the dimension of the vectors.
2. The matrix is split by spectrum. The polar factor U of A - s I (dynamically weighted Halley
   iterations, QR only) is its matrix sign; (U + I) / 2 projects onto the eigenvectors above the
   shift s, here the mean eigenvalue. Orthonormal bases of both ranges turn A into two smaller
   blocks, which are split in turn; blocks of one row, or equal to a multiple of the identity within
   rounding, are finished. Blocks above the shift come first, so splitting ends once the leading
   components are known.
3. The components (at most ``COMPONENTS`` rows of the dimension) are broadcast. A third pass measures
   the covariance of the whitened values; its largest distance from the identity is reported with
   every row.

Defined results: rows whose vector is null or empty, or holds null or non-finite entries or entries
whose x is beyond 2^62, are dropped. All vectors have the length that most of the others have (the greater
of equally frequent ones); rows of another length are dropped too. A component whose eigenvalue is
zero within rounding (1e-12 of the trace) has no whitened value (null) and does not count for the
error; with no spread at all ``explained`` is null as well and the error 0. A deviation beyond 64 bits
is null. Equal eigenvalues give some orthonormal basis of their space. Rows without an id and repeated
rows are rows like others. An empty table gives an empty result. Other columns are ignored, whatever
their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import documents

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
ZERO = 1e-12                    # eigenvalues below this share of the trace count as zero
_LIMIT = 2.0 ** 62
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- polar decomposition and splitting

def polar(a: np.ndarray) -> np.ndarray:
    """The orthogonal polar factor of a square matrix by QR-based dynamically weighted Halley iterations."""
    size = a.shape[0]
    x = a / np.linalg.norm(a)                        # Frobenius: at least the greatest singular value
    low = max(1.0 / np.sqrt(size) / max(np.linalg.cond(x, 1), 1.0), _EPS)
    eye = np.eye(size)
    for _ in range(60):
        square = low * low
        d = np.cbrt(4 * (1 - square) / square ** 2)
        wa = np.sqrt(1 + d) + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - square) / (square * np.sqrt(1 + d)))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, eye]))
        new = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:size] @ q[size:].T)
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        moved = np.linalg.norm(new - x)
        x = new
        if moved < np.cbrt(_EPS) and 1 - low < 10 * _EPS:
            break
    return x


def _bases(projector: np.ndarray, rank: int) -> tuple[np.ndarray, np.ndarray]:
    """Orthonormal bases of the range of a projector and of its complement: the columns of the projector with
    the largest remainders, orthogonalised, then the complement."""
    size = projector.shape[0]
    left, chosen = projector.copy(), []
    for _ in range(rank):
        j = int(np.argmax(np.einsum("ij,ij->j", left, left)))
        chosen.append(j)
        q = left[:, j] / np.linalg.norm(left[:, j])
        left = left - np.outer(q, q @ left)
    q, _ = np.linalg.qr(projector[:, chosen], mode="complete")
    first = projector @ q[:, :rank]                  # one more step of subspace iteration
    q, _ = np.linalg.qr(np.hstack([first, q[:, rank:]]))
    return q[:, :rank], q[:, rank:size]


def _split(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Bases of the spaces above and below a shift inside the spectrum, or None if there is but one eigenvalue."""
    size = a.shape[0]
    middle = np.trace(a) / size
    spread = np.linalg.norm(a - middle * np.eye(size))
    if size == 1 or spread <= 4 * size * _EPS * scale:
        return None
    # the mean lies strictly inside; beside it if an eigenvalue happens to be the mean
    for away in (0.0, 0.11, -0.13, 0.029, -0.031, 0.0071):
        shifted = a - (middle + away * spread / np.sqrt(size)) * np.eye(size)
        projector = (polar(shifted) + np.eye(size)) / 2
        projector = (projector + projector.T) / 2
        trace = np.trace(projector)
        rank = int(round(trace))
        if 0 < rank < size and abs(trace - rank) < 1e-6:
            upper, lower = _bases(projector, rank)
            if np.abs(upper.T @ a @ lower).max() <= 1e3 * size * _EPS * scale:
                return upper, lower
    return None


def components(v: np.ndarray, most: int = COMPONENTS) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, rows of unit eigenvectors) of the ``most`` leading components of a symmetric matrix."""
    scale = np.linalg.norm(v)
    values, vectors = [], []
    todo = [np.eye(v.shape[0])]                      # bases, the one of the largest eigenvalues on top
    while todo and len(values) < most:
        basis = todo.pop()
        block = basis.T @ v @ basis
        block = (block + block.T) / 2
        parts = _split(block, scale)
        if parts is None:
            values += [float(np.trace(block) / len(block))] * len(block)
            vectors += list(basis.T)
        else:
            todo += [basis @ parts[1], basis @ parts[0]]
    q, r = np.linalg.qr(np.array(vectors).T)         # orthonormal to the last digit across blocks
    vectors = (q * np.sign(np.diag(r))).T
    values = np.array([x @ v @ x for x in vectors])
    order = np.argsort(-values, kind="stable")[:most]
    return values[order], vectors[order]


# ---------------------------------------------------------------- distributed sums

def _integers(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, x) of the usable vectors of a batch, by length."""
    lengths = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    flat = column.flatten()                          # null lists have no entries here
    missing = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).astype(float)
    with np.errstate(all="ignore"):
        scaled = np.floor(SCALE * values)
        good = ~missing & np.isfinite(values) & (np.abs(scaled) < _LIMIT)
    start = np.cumsum(lengths) - lengths
    for n in np.unique(lengths[lengths > 0]):
        rows = np.flatnonzero(lengths == n)
        at = start[rows][:, None] + np.arange(n)
        rows = rows[good[at].all(axis=1)]
        yield rows, scaled[start[rows][:, None] + np.arange(n)].astype(np.int64) + SHIFT


@dataclass(frozen=True)
class Centre:
    """n vectors of equal length with integer sums; mean = whole + rest / n, 0 <= rest < n."""
    n: int
    whole: np.ndarray
    rest: np.ndarray

    @classmethod
    def of(cls, n: int, sums: list[int]) -> Centre:
        return cls(n, np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64))

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n as doubles, the difference taken in integers."""
        return (x - self.whole) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums over the dimensions of (n x - S)^2, exact; None beyond 64 bits."""
        about = x - self.whole
        reach = float(np.abs(self.centred(x)).max(initial=0)) * self.n
        if reach ** 2 * x.shape[1] < 2.0 ** 62:
            return np.square(self.n * about - self.rest).sum(axis=1).tolist()
        exact = [sum((self.n * int(a) - int(r)) ** 2 for a, r in zip(row, self.rest)) for row in about]
        return [e if e < 1 << 63 else None for e in exact]


def _vectors(table: DataFrame, vec_col: str) -> DataFrame:
    return table.select(F.col(f"`{vec_col}`").cast("array<double>").alias("v"))


def fit_centre(table: DataFrame, vec_col: str = "embedding") -> Centre | None:
    """The centre of the usable vectors of the most frequent length; None without any."""
    def run(batches):
        held: dict[int, tuple[int, np.ndarray]] = {}
        for b in batches:
            for rows, x in _integers(b.column(0)):
                if len(rows):
                    n, sums = held.get(x.shape[1], (0, 0))
                    small = np.abs(x).max() < 2.0 ** 62 / len(x)        # else the sum needs more than 64 bits
                    held[x.shape[1]] = n + len(rows), sums + (x if small else x.astype(object)).sum(axis=0).astype(object)
        for d, (n, sums) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([d] * d, pa.int32()), pa.array(range(d), pa.int32()), pa.array([n] * d, pa.int64()),
                 pa.array([str(s) for s in sums], pa.string())], ["d", "i", "n", "s"])

    parts = _vectors(table, vec_col).mapInArrow(run, "d int, i int, n long, s string")
    sums = parts.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    best = parts.where("i = 0").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    if best is None:
        return None
    rows = sums.where(F.col("d") == best.d).orderBy("i").collect()          # one row per dimension
    return Centre.of(best.n, [int(r.s) for r in rows])


def _gram(table: DataFrame, vec_col: str, centre: Centre, project: np.ndarray | None, side: int) -> np.ndarray:
    """Sum of y y' over the centred vectors y, or over their projections with the rows of ``project``."""
    shared = table.sparkSession.sparkContext.broadcast((centre, project))

    def run(batches):
        about, onto = shared.value
        total = np.zeros((side, side))
        for b in batches:
            for _, x in _integers(b.column(0)):
                if x.shape[1] == len(about.whole):
                    y = about.centred(x)
                    y = y if onto is None else y @ onto.T
                    total += y.T @ y
        i, j = np.triu_indices(side)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])],
                                         ["i", "j", "s"])

    rows = (_vectors(table, vec_col).mapInArrow(run, "i int, j int, s double")
            .groupBy("i", "j").agg(F.sum("s").alias("s")).collect())        # one row per pair of dimensions
    out = np.zeros((side, side))
    for r in rows:
        out[r.i, r.j] = out[r.j, r.i] = r.s
    return out


@dataclass(frozen=True)
class Whitening:
    centre: Centre
    values: np.ndarray              # leading eigenvalues, falling
    vectors: np.ndarray             # unit eigenvectors, a row each
    trace: float
    identity_error: float = 0.0

    @property
    def live(self) -> np.ndarray:
        return self.values > ZERO * self.trace

    @property
    def onto(self) -> np.ndarray:
        """Rows that centred vectors are multiplied with (zero for components without spread)."""
        with np.errstate(all="ignore"):
            return np.where(self.live[:, None], self.vectors / np.sqrt(self.values)[:, None], 0.0)


def fit(table: DataFrame, vec_col: str = "embedding", most: int = COMPONENTS) -> Whitening | None:
    centre = fit_centre(table, vec_col)
    if centre is None:
        return None
    v = _gram(table, vec_col, centre, None, len(centre.whole)) / centre.n
    values, vectors = components(v, most)
    made = Whitening(centre, values, vectors, float(np.trace(v)))
    got = _gram(table, vec_col, centre, made.onto, len(values)) / centre.n
    error = np.abs(got - np.diag(made.live.astype(float))).max(initial=0)
    return Whitening(centre, values, vectors, made.trace, float(error))


def whiten(table: DataFrame, made: Whitening | None, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each usable vector and component."""
    spark = table.sparkSession
    kind = table.select(F.col(f"`{id_col}`").alias("vec_id")).schema["vec_id"].dataType.simpleString()
    shape = (f"vec_id {kind}, component int, n long, deviation long, whitened double, explained double, "
             "identity_error double")
    if made is None:
        return spark.createDataFrame([], shape)
    shared = spark.sparkContext.broadcast(made)

    def run(batches):
        w = shared.value
        k, live, onto = len(w.values), w.live, w.onto
        share = [float(e / w.trace) if w.trace > 0 else None for e in w.values]
        for b in batches:
            for rows, x in _integers(b.column(1)):
                if x.shape[1] != len(w.centre.whole) or not len(rows):
                    continue
                m = len(rows)
                white = w.centre.centred(x) @ onto.T
                dead = np.tile(~live, m)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, w.centre.n)), pa.array([d for d in w.centre.deviations(x) for _ in range(k)], pa.int64()),
                     pa.array(white.ravel(), mask=dead), pa.array(share * m, pa.float64()),
                     pa.array(np.full(m * k, w.identity_error))],
                    ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    source = table.select(F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{vec_col}`").cast("array<double>").alias("v"))
    return source.mapInArrow(run, shape)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = documents(spark, sf_dir, "embeddings")
    return whiten(table, fit(table))
