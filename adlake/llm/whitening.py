"""Whitening of embeddings from the weighted covariance of their distinct vectors.

Vectors are first put on a grid, x = floor(256 c), so equal vectors can be grouped exactly. Each distinct vector is one
row with its number of occurrences; the fit weighs it by that number or by one, adds up weighted sums and then, centred,
weighted products as one matrix product per step, and each distinct vector is whitened once. Rows of the table get the
result of their vector by a join on its SHA-256.

A task hands on one small matrix; matrices are added in a tree of bounded fan-in. What reaches the driver is one matrix
of dimension by dimension, whatever the number of vectors.

Defined cases: rows with a NULL vector, a NULL, NaN or infinite entry, or another length than the most frequent one (of
equally frequent ones the longer) are dropped; entries beyond the range of a 64-bit integer count as its ends; repeated rows and
NULL keys are rows like others; components with an eigenvalue of 0 (of rank) have whitened and explained values of 0.0;
a deviation beyond 64 bits is NULL; vectors shorter than the number of components have one component per dimension;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlake.session import cut_lineage

SCALE = 256.0
COMPONENTS = 4
STEP_ENTRIES = 1 << 19  # entries of vectors that one numpy step works on
FAN_IN = 16  # matrices added by one task
ZERO = 1e-13  # share of the total variance up to which an eigenvalue counts as 0
PART = "task bigint, body binary"


def on_grid(vector: Column) -> Column:
    """The vector as whole numbers."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(SCALE)).cast("bigint"))


def usable(vector: Column) -> Column:
    """Whether a vector has finite entries only."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite, F.lit(False))


def digest(x: Column) -> Column:
    return F.unhex(F.sha2(F.array_join(x, ",").cast("binary"), 256))


def grid_rows(table: DataFrame, key: str, vector: str) -> tuple[DataFrame, int]:
    """(key, x) of the rows that can be used, and the number of dimensions."""
    rows = table.where(usable(F.col(vector))).select(F.col(key).alias("key"), F.col(vector).alias("_v"))
    lengths = rows.groupBy(F.size("_v").alias("d")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("d")).first()
    dims = common["d"] if common else 0
    return rows.where(F.size("_v") == dims).select("key", on_grid(F.col("_v")).alias("x")), dims


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """(digest, x, copies): equal vectors are combined before the shuffle."""
    grouped = rows.groupBy("x").agg(F.count("*").alias("copies"))
    return cut_lineage(grouped.select(digest(F.col("x")).alias("digest"), "x", "copies"))


def matrix_of(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


def steps(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    size = max(1, STEP_ENTRIES // max(1, dims))
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            yield batch.slice(at, size)


def weights_of(batch: pa.RecordBatch, by_count: bool) -> np.ndarray:
    return batch.column("copies").to_numpy() if by_count else np.ones(batch.num_rows, np.int64)


def tree_sum(parts: DataFrame) -> np.ndarray:
    """Sum of the arrays in ``body``; parts are added in the order of their tasks, ``FAN_IN`` in one task."""

    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        total = sum(np.frombuffer(b.as_py()) for b in table.column("body"))
        return pa.table({"task": table.column("task")[:1], "body": pa.array([total.tobytes()], pa.binary())})

    table = cut_lineage(parts)
    while (rows := table.count()) > 1:
        lot = F.pmod(F.xxhash64("task"), F.lit(-(-rows // FAN_IN)))
        table = cut_lineage(table.withColumn("lot", lot).groupBy("lot").applyInArrow(add, PART))
    return np.frombuffer(table.first()["body"])


def weighted_sums(vectors: DataFrame, dims: int, by_count: bool) -> tuple[int, list[int]]:
    """Total weight and exact weighted sum per dimension.

    A task adds entries in halves of 32 bits, which cannot overflow, and hands on one row per dimension as text; Spark adds these as decimals.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, weight = np.zeros((2, dims), object), 0
        for batch in steps(batches, dims):
            x, w = matrix_of(batch.column("x"), dims), weights_of(batch, by_count)
            halves = [x >> 32, x & 0xFFFFFFFF]
            if by_count:
                halves = [half.astype(object) * w[:, None] for half in halves]
            total += np.array([half.sum(axis=0) for half in halves], object)
            weight += int(w.sum())
        if weight:
            sums = [str((int(high) << 32) + int(low)) for high, low in zip(*total)]
            yield pa.RecordBatch.from_arrays([pa.array(range(dims), pa.int32()), pa.array([weight] * dims, pa.int64()), pa.array(sums)], ["i", "w", "s"])

    parts = vectors.mapInArrow(run, "i int, w bigint, s string")
    added = parts.groupBy("i").agg(F.sum("w").alias("w"), F.sum(F.col("s").cast("decimal(38,0)")).cast("string").alias("s"))
    found = {r.i: r for r in added.collect()}  # one row per dimension
    return (found[0].w, [int(found[i].s) for i in range(dims)]) if found else (0, [0] * dims)


@dataclass(frozen=True)
class Whitening:
    """A fit: total weight, sums per dimension, and the leading components with their eigenvalues."""

    weight: int
    sums: tuple[int, ...]
    values: np.ndarray  # eigenvalues, falling; one per component
    axes: np.ndarray  # unit eigenvectors in columns
    trace: float

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.weight for s in self.sums])

    @property
    def used(self) -> np.ndarray:
        return self.values > ZERO * self.trace

    def explained(self) -> list[float]:
        return [float(v / self.trace) if ok else 0.0 for v, ok in zip(self.values, self.used)]

    def projection(self) -> np.ndarray:
        return np.where(self.used, self.axes / np.sqrt(np.where(self.used, self.values, 1.0)), 0.0)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Σ (n x - S)² per vector, exactly."""
        n, sums = self.weight, self.sums
        most = max(int(np.abs(x.astype(float)).max(initial=0.0)) + 1, *(abs(s) // n + 1 for s in sums)) * 2 * n
        if len(sums) * most * most < 1 << 62:
            return (((n * x - np.array(sums, np.int64)) ** 2).sum(axis=1)).tolist()
        exact = ((n * x.astype(object) - np.array(sums, object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def fit(vectors: DataFrame, dims: int, components: int = COMPONENTS, by_count: bool = False) -> Whitening | None:
    """Fit on distinct vectors (x, copies); ``by_count`` weighs a vector by its copies. None without vectors."""
    weight, sums = weighted_sums(vectors, dims, by_count)
    if not weight or not dims:
        return None
    mean = np.array([s / weight for s in sums])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in steps(batches, dims):
            centred = matrix_of(batch.column("x"), dims) - mean
            product = (centred * weights_of(batch, by_count)[:, None]).T @ centred
            total = product if total is None else total + product
        if total is not None:
            task = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([task], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["task", "body"])

    covariance = tree_sum(vectors.mapInArrow(run, PART)).reshape(dims, dims) / weight
    values, axes = np.linalg.eigh((covariance + covariance.T) / 2)
    top = slice(None, -min(components, dims) - 1, -1)
    return Whitening(weight, tuple(sums), np.maximum(values[top], 0.0), axes[:, top], float(values.sum()))


def whiten_vectors(vectors: DataFrame, model: Whitening, dims: int) -> DataFrame:
    """(digest, copies, deviation, whitened): every distinct vector once."""
    mean, projection = model.mean, model.projection()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, dims):
            x = matrix_of(batch.column("x"), dims)
            white = (x - mean) @ projection
            lists = pa.FixedSizeListArray.from_arrays(pa.array(white.ravel()), projection.shape[1]).cast(pa.list_(pa.float64()))
            deviation = pa.array(model.deviations(x), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("digest"), batch.column("copies"), deviation, lists], ["digest", "copies", "deviation", "whitened"])

    return cut_lineage(vectors.mapInArrow(run, "digest binary, copies bigint, deviation bigint, whitened array<double>"))


def identity_error(white: DataFrame, model: Whitening, by_count: bool = False) -> float:
    """Largest absolute entry of the covariance of the whitened vectors less the identity, over components of rank."""
    weight = F.col("copies") if by_count else F.lit(1)
    axes = [i for i in range(len(model.values)) if model.used[i]]
    if not axes:
        return 0.0
    cell = {i: F.col("whitened")[i] for i in axes}
    means = white.agg(*[(F.sum(cell[i] * weight) / F.sum(weight)).alias(f"m{i}") for i in axes]).first()
    centred = {i: cell[i] - F.lit(means[f"m{i}"]) for i in axes}
    pairs = [(i, j) for i in axes for j in axes if i <= j]
    products = [(F.sum(centred[i] * centred[j] * weight) / F.sum(weight)).alias(f"c{i}_{j}") for i, j in pairs]
    found = white.agg(*products).first()
    return max(abs(found[f"c{i}_{j}"] - (i == j)) for i, j in pairs)


def whiten(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, by_count: bool = False
) -> DataFrame:
    """One row per usable row and component: key, component, n, deviation, whitened, explained, identity_error."""
    rows, dims = grid_rows(table, key, vector)
    vectors = distinct_vectors(rows)
    model = fit(vectors, dims, components, by_count)
    kind = table.schema[key].dataType.simpleString()
    if model is None:
        empty = f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
        return table.sparkSession.createDataFrame([], empty)
    white = whiten_vectors(vectors, model, dims)
    error = identity_error(white, model, by_count)
    named = rows.select("key", digest(F.col("x")).alias("_of"))
    joined = named.join(white, F.col("_of") == F.col("digest"))
    explained = F.array(*[F.lit(v) for v in model.explained()])
    cells = F.transform("whitened", lambda w, i: F.struct((i + 1).cast("int").alias("component"), w.alias("whitened"), F.get(explained, i).alias("explained")))
    unfolded = joined.select("key", "deviation", F.inline(cells))
    return unfolded.select(
        F.col("key").alias(key), "component", F.lit(model.weight).cast("bigint").alias("n"), "deviation", "whitened", "explained",
        F.lit(float(error)).alias("identity_error"),
    )
