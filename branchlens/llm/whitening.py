"""Operator 12: embedding whitening.

Method: tasks sum the vectors exactly, then the products of the centred vectors, so that only a
matrix as wide as one vector reaches the driver. There FEAST (``contour``) finds the largest
eigenpairs: contour quadrature of complex shifted solves projects onto eigenvalue intervals,
Rayleigh-Ritz extracts the components, inertia counts verify that none is missed. A last pass
projects every vector on the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from branchlens.llm.common import read, small_batches, staged
from branchlens.llm.contour import largest_eigenpairs

COMPONENTS = 8
STEPS, SHIFT = 1024, 100_000  # an entry c counts as floor(STEPS * c) + SHIFT
LIMIT = 1 << 42  # entries from here on, either sign, do not fit
FIELDS = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)
_EXACT = float(1 << 62)


def _vectors(rows: DataFrame, vector: str) -> DataFrame:
    """vec_id, x: the vectors that have entries, all of them finite, as integers."""
    entries = F.transform(F.col(vector), lambda c: c.cast("double"))
    fits = F.forall("v", lambda c: F.coalesce(F.abs(c) < F.lit(float(LIMIT)), F.lit(False)))
    return (
        rows.select(F.col("vec_id").cast("long").alias("vec_id"), entries.alias("v"))
        .where((F.size("v") > 0) & fits)
        .select("vec_id", F.transform("v", lambda c: F.floor(c * STEPS) + F.lit(SHIFT)).alias("x"))
    )


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """The vectors of a batch, which have one length, as rows."""
    values = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return values.reshape(batch.num_rows, -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per length of vectors and dimension: rows and exact sum of a task."""
    totals: dict[int, tuple[int, np.ndarray]] = {}
    for batch in batches:
        lengths = pc.list_value_length(batch.column("x"))
        for d in pc.unique(lengths).to_pylist():
            x = _matrix(batch.filter(pc.equal(lengths, d)))
            n, total = totals.get(d, (0, np.zeros(d, object)))
            # Halves of 32 bits cannot overflow within a batch.
            whole = (x >> 32).sum(axis=0).astype(object) * (1 << 32) + (x & 0xFFFFFFFF).sum(axis=0).astype(object)
            totals[d] = n + len(x), total + whole
    rows = [(d, i, n, Decimal(int(s))) for d, (n, total) in totals.items() for i, s in enumerate(total)]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    types = [pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["d", "i", "n", "s"]
    )


@dataclass(frozen=True)
class Centre:
    """Number and sums of the vectors of the fit list."""

    n: int
    sums: tuple[int, ...]

    def scaled(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact: in 64 bits where that is enough."""
        if float(np.abs(x).max(initial=0)) * self.n < _EXACT and max(map(abs, self.sums)) < _EXACT:
            return x * self.n - np.array(self.sums, np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, scaled: np.ndarray) -> np.ndarray:
        return scaled.astype(float) / self.n

    def deviations(self, scaled: np.ndarray) -> list[int | None]:
        """Sums of squares, exact; None where one does not fit into a long."""
        widest = float(np.abs(scaled).max(initial=0))
        if scaled.dtype != object and widest**2 * scaled.shape[1] < _EXACT:
            return (scaled * scaled).sum(axis=1).tolist()
        exact = scaled.astype(object)
        return [v if v < 1 << 63 else None for v in map(int, (exact * exact).sum(axis=1))]


def _products(centre: Centre, project: np.ndarray | None = None):
    """Sums of the products of centred vectors, (i, j, p) with i <= j, and their sums as (i, -1, p).

    With ``project`` of the projections instead.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d = len(centre.sums) if project is None else project.shape[1]
        square, total = np.zeros((d, d)), np.zeros(d)
        for batch in batches:
            y = centre.centred(centre.scaled(_matrix(batch)))
            y = y if project is None else y @ project
            square += y.T @ y
            total += y.sum(axis=0)
        i, j = np.triu_indices(d)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.concatenate((i, np.arange(d))), pa.int32()),
                pa.array(np.concatenate((j, np.full(d, -1))), pa.int32()),
                pa.array(np.concatenate((square[i, j], total))),
            ],
            names=["i", "j", "p"],
        )

    return run


def _covariance(vectors: DataFrame, centre: Centre, project: np.ndarray | None = None) -> np.ndarray:
    """Covariance with divisor n; what rounding left of the mean is taken off."""
    d = len(centre.sums) if project is None else project.shape[1]
    parts = vectors.select("x").mapInArrow(_products(centre, project), "i int, j int, p double")
    out, mean = np.zeros((d, d)), np.zeros(d)
    for i, j, p in parts.groupBy("i", "j").agg(F.sum("p")).collect():  # as many as the matrix has entries
        if j < 0:
            mean[i] = p / centre.n
        else:
            out[i, j] = out[j, i] = p / centre.n
    return out - np.outer(mean, mean)


def _projected(centre: Centre, project: np.ndarray, explained: np.ndarray, error: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = project.shape[1]
        for batch in batches:
            scaled = centre.scaled(_matrix(batch))
            rows = len(scaled)
            numbers = np.arange(rows).repeat(k)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("vec_id").take(pa.array(numbers)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    pa.array(np.full(rows * k, centre.n)),
                    pa.array(centre.deviations(scaled), pa.int64()).take(pa.array(numbers)),
                    pa.array((centre.centred(scaled) @ project).ravel()),
                    pa.array(np.tile(explained, rows)),
                    pa.array(np.full(rows * k, error)),
                ],
                names=[f.split()[0] for f in FIELDS.split(", ")],
            )

    return run


def whiten(rows: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error of every vector and component.

    Dropped are rows whose vector is null, empty, or holds a null, an infinite or NaN entry, or one of 2^42
    or more (either sign). Vectors of another length than most (of equally many: the shorter
    one) are dropped too. The others are the fit list: n of them, each entry c as
    x = floor(1024 * c) + 100000. Components are unit eigenvectors of the covariance of x (divisor n), numbered from 1
    by falling eigenvalue; the entry of largest absolute value is positive. There are up to
    ``components`` of them, fewer where the covariance has a smaller rank: eigenvalues that are
    zero within rounding give none, so equal vectors alone give no rows. ``deviation`` is exact, null
    where it does not fit into a long. ``explained`` is the component's share of the trace, ``identity_error`` the largest
    absolute entry of the covariance of ``whitened`` minus the identity. Repeated rows and null
    ids count and are returned like any other; other columns are not looked at; an empty
    table gives an empty table.
    """
    spark = rows.sparkSession
    small_batches(spark)
    vectors = _vectors(rows, vector)
    sums = staged(
        vectors.select("x").mapInArrow(_sums, "d int, i int, n long, s decimal(38,0)")
        .groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")),
        "vector-sums",
    )
    most = sums.where("i = 0").orderBy(F.desc("n"), "d").first()
    if most is None:
        return spark.createDataFrame([], FIELDS)
    centre = Centre(most.n, tuple(int(r.s) for r in sums.where(F.col("d") == most.d).orderBy("i").collect()))
    vectors = vectors.where(F.size("x") == most.d)
    covariance = _covariance(vectors, centre)
    values, axes = largest_eigenpairs(covariance, components)
    if not len(values):
        return spark.createDataFrame([], FIELDS)
    project = axes / np.sqrt(values)
    error = float(np.abs(_covariance(vectors, centre, project) - np.eye(len(values))).max())
    return vectors.mapInArrow(_projected(centre, project, values / np.trace(covariance), error), FIELDS)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read(spark, sf_dir, "embeddings"))
