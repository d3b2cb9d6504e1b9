"""Embedding whitening by a covariance weighted with multiplicities.

A vector's components become whole numbers (``grid``).  Equal grid vectors are
one row with their count as its weight; the sums, the covariance (weighted,
centred, one matrix product a block of rows) and the whitened coordinates are
made from these distinct rows, each once, and joined back to all rows.

Sums are whole numbers, so mean and deviation are exact.  The driver holds one
matrix of the vectors' width, never rows.  A vector that many rows share goes
back to them by a broadcast of at most HEAVY such vectors; the rest is shuffled,
and none of that is more than one HEAVY-th of all rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docweave.llm import common

GRID, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Vectors held by more than one HEAVY-th of all rows, fewer than HEAVY of them, are broadcast.
HEAVY = 1000
#: An eigenvalue below this share of the largest is rounding of a zero one.
LEAST = 1e-12


def grid(vector: Column) -> Column:
    """The whole numbers of a vector; null if it is null or holds a null or
    non-finite component."""
    ok = vector.isNotNull() & F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    return F.when(ok, F.transform(vector, lambda c: (F.floor(c.cast("double") * GRID) + OFFSET).cast("long")))


def distinct_rows(rows: DataFrame) -> DataFrame:
    """``(x, weight)``: the different vectors of ``rows (x)`` and how many rows hold each."""
    return common.written(rows.groupBy("x").agg(F.count("*").alias("weight")), "distinct")


def _matrix(column, width: int) -> np.ndarray:
    return column.values.to_numpy()[column.offsets[0].as_py():column.offsets[-1].as_py()].reshape(-1, width)


def _summed(rows: DataFrame, value: str) -> np.ndarray:
    """The sum of arrays of equal length, made by a partial aggregate; a row an entry reaches the driver."""
    out = rows.select(F.posexplode(value).alias("k", "v")).groupBy("k").agg(F.sum("v").alias("v")).toArrow().sort_by("k")
    return out["v"].to_numpy(zero_copy_only=False)


def sums(distinct: DataFrame, width: int) -> tuple[int, np.ndarray]:
    """Rows, and the exact sum of every dimension (Python integers)."""

    def run(batches):
        for batch in batches:
            w = batch.column(1).to_numpy()
            x = _matrix(batch.column(0), width)
            if float(np.abs(x).max(initial=0)) * float(w.sum()) >= 2.0**62:
                x = x.astype(object)
            total = [int(w.sum()), *(x * w[:, None]).sum(0)]
            yield pa.RecordBatch.from_arrays([pa.array([[str(v) for v in total]], pa.list_(pa.string()))], names=["s"])

    parts = distinct.select("x", "weight").mapInArrow(run, "s array<string>")
    out = _summed(parts.select(F.transform("s", lambda v: v.cast("decimal(38,0)")).alias("s")), "s")
    return (int(out[0]), np.array([int(v) for v in out[1:]], object)) if len(out) else (0, np.zeros(width, object))


def covariance(distinct: DataFrame, column: str, n: int, mean: np.ndarray) -> np.ndarray:
    """The covariance of ``column``, weighted and centred before multiplying, divisor n."""
    width = len(mean)

    def run(batches):
        total = np.zeros((width, width))
        for batch in batches:
            # Plain products of matrices; blocks of an Arrow batch bound the memory.
            x = _matrix(batch.column(0), width).astype(float) - mean
            total += (x * batch.column(1).to_numpy()[:, None]).T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], names=["c"])

    parts = distinct.select(column, "weight").mapInArrow(run, "c array<double>")
    out = _summed(parts, "c")
    return (out.reshape(width, width) if len(out) else np.zeros((width, width))) / max(n, 1)


def principal(cov: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and their unit eigenvectors as columns, at most
    ``most``; the largest entry of each is positive.  Zero eigenvalues, along
    which all vectors are equal, have no component."""
    values, vectors = np.linalg.eigh((cov + cov.T) / 2)
    keep = np.argsort(-values, kind="stable")[:most]
    keep = keep[values[keep] > LEAST * max(values.max(initial=0), 0)]
    vectors = vectors[:, keep]
    sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(len(keep))]) if len(keep) else np.ones(0)
    return values[keep], vectors * sign


def whitened_rows(distinct: DataFrame, n: int, total: np.ndarray, values: np.ndarray, vectors: np.ndarray) -> DataFrame:
    """``distinct`` with ``z``, its whitened coordinates, and ``deviation``."""
    width = len(total)
    mean = (total / n).astype(float)
    turned = vectors / np.sqrt(values)

    def run(batches):
        for batch in batches:
            x = _matrix(batch.column(0), width)
            z = (x - mean) @ turned
            away = x.astype(object) * n - total if n * (np.abs(x).max(initial=0) + 1) >= 2**62 else x * n - total.astype(np.int64)
            # Exact: Python's integers where 64 bits might not do.
            big = np.abs(away).max(initial=0)
            squares = (away.astype(object) ** 2).sum(1) if int(big) ** 2 * width >= 2**63 else (away * away).sum(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * z.shape[1], pa.int32()), pa.array(z.ravel())),
                                              pa.array([int(v) for v in squares], pa.int64())], names=["x", "weight", "z", "deviation"])

    return common.written(distinct.select("x", "weight").mapInArrow(run, "x array<long>, weight long, z array<double>, deviation long"), "whitened")


def _joined_back(rows: DataFrame, white: DataFrame, n: int) -> DataFrame:
    """``rows`` with the columns of their vector's whitened row."""
    heavy = white.where(F.col("weight") > n // HEAVY)
    light = white.where(F.col("weight") <= n // HEAVY).drop("weight")
    few = F.broadcast(heavy.drop("weight"))
    shared = rows.join(few, "x")
    rest = rows.join(F.broadcast(heavy.select("x")), "x", "left_anti")
    return shared.unionByName(rest.join(light.hint("shuffle_merge"), "x"))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", most: int = COMPONENTS) -> DataFrame:
    """``(id_col, component, n, deviation, whitened, explained, identity_error)``:
    a row for each remaining vector and component.

    Rows whose vector is null, or holds a null or non-finite component, are
    dropped, and so are vectors of another length than most (the shorter on a
    tie).  Components of eigenvalue zero, as in a table of equal vectors, are
    left out.  Rows that repeat an id are each kept; a null id stays null; other
    columns are ignored; an empty table gives no rows.  ``deviation`` is exact,
    and an error where it does not fit 64 bits.
    """
    rows = vectors.select(F.col(id_col).alias("id"), grid(F.col(vector_col)).alias("x")).where("x IS NOT NULL AND size(x) > 0")
    kind = vectors.schema[id_col].dataType.simpleString()
    spark = vectors.sparkSession
    distinct = distinct_rows(rows.select("x"))
    widths = distinct.groupBy(F.size("x").alias("width")).agg(F.sum("weight").alias("n")).orderBy(F.desc("n"), "width").limit(1).collect()
    empty = spark.createDataFrame([], f"`{id_col}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    if not widths:
        return empty
    width = widths[0]["width"]
    rows, distinct = rows.where(F.size("x") == width), distinct.where(F.size("x") == width)
    n, total = sums(distinct, width)
    cov = covariance(distinct, "x", n, (total / n).astype(float))
    values, vectors_ = principal(cov, most)
    if not len(values):
        return empty
    white = whitened_rows(distinct, n, total, values, vectors_)
    centre = np.array([white.agg(*[F.sum(F.col("z")[i] * F.col("weight")) for i in range(len(values))]).first()], float)[0] / n
    error = float(np.abs(covariance(white, "z", n, centre) - np.eye(len(values))).max())
    explained = F.element_at(F.array(*[F.lit(float(v)) for v in values / np.trace(cov)]), F.col("component"))
    out = _joined_back(rows, white, n).select("id", "deviation", F.posexplode("z").alias("at", "whitened")).withColumn("component", F.col("at") + 1)
    return out.select(F.col("id").alias(id_col), "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened",
                      explained.alias("explained"), F.lit(error).alias("identity_error"))


def q_op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight whitened coordinates of every embedding."""
    return whiten(common.table(spark, sf_dir, "embeddings"))


common.by_value(__name__)
