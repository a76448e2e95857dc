"""Embedding whitening: covariance over distinct vectors, each whitened once and handed to all rows that hold it."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reclake.llm.common import two_hashes
from reclake.llm.registry import query, table
from reclake.llm.vectors import bring_back, finite, lists, matrix, moments
from reclake.session import materialize

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LARGE = 1e14
# Eigenvalues below this share of the variance are rounding, not variance.
FLAT = 1e-12


@dataclass(frozen=True)
class Whitening:
    """``n`` (sum of the fit weights), ``sums`` per dimension, unit ``vectors`` in columns, their ``values``, and the ``trace``."""

    n: int
    sums: list[int]
    span: int
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    def offsets(self, x: np.ndarray) -> np.ndarray:
        """``n * x - sums``, exact: as 64-bit integers where they fit, else as Python integers."""
        if self.n * self.span < 1 << 62:
            # the product may run over, the difference does not: both are taken modulo two to the 64
            sums = np.array([s % (1 << 64) for s in self.sums], np.uint64)
            return (x.astype(np.int64).view(np.uint64) * np.uint64(self.n % (1 << 64)) - sums).view(np.int64)
        return x.astype(object) * self.n - np.array(self.sums, object)

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.offsets(x).astype(float) / self.n


def grid(vector: Column) -> Column:
    """Entries as whole numbers: ``floor(64 * c) + 1000000``."""
    return F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + F.lit(SHIFT))


def gridded(embeddings: DataFrame) -> DataFrame:
    """``vec_id``, ``x`` and two hashes of it, without the rows that have no usable vector."""
    rows = embeddings.filter(finite(F.col("embedding"), LARGE)).select("vec_id", grid(F.col("embedding")).alias("x"))
    one, two = two_hashes(F.col("x"))
    return rows.withColumns({"one": one, "two": two})


def distinct_vectors(rows: DataFrame) -> DataFrame:
    """Each vector once, with the number ``w`` of its rows; counted before the shuffle, so a hot vector costs a row a task."""
    return rows.groupBy("one", "two", "x").agg(F.count("*").alias("w"))


def _exact_sums(found: DataFrame, size: int) -> tuple[int, list[int], int]:
    """Total weight, sums per dimension and the widest range of a dimension, all exact. The driver gets a row per dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, [0] * size
        low, high = np.full(size, np.iinfo(np.int64).max), np.full(size, np.iinfo(np.int64).min)
        for batch in batches:
            if not batch.num_rows:
                continue
            x, w = matrix(batch.column(0), np.int64), batch.column(1).to_numpy()
            n += int(w.sum())
            least, most = x.min(axis=0), x.max(axis=0)
            # counted from the least entry, so that the products stay small
            above = (x - least) * w[:, None] if int((most - least).max()) * int(w.sum()) < 1 << 62 else (x - least).astype(object) * w[:, None]
            sums = [s + int(a) + int(b) * int(w.sum()) for s, a, b in zip(sums, above.sum(axis=0), least, strict=True)]
            low, high = np.minimum(low, least), np.maximum(high, most)
        if n:
            yield pa.RecordBatch.from_arrays([
                pa.array(range(size), pa.int64()), pa.array([n] * size, pa.int64()),
                pa.array([Decimal(s) for s in sums], pa.decimal128(38, 0)), pa.array(low), pa.array(high),
            ], ["at", "n", "s", "low", "high"])

    parts = found.filter(F.size("x") == size).select("x", "w").mapInArrow(run, "at long, n long, s decimal(38,0), low long, high long")
    totals = parts.groupBy("at").agg(F.sum("n"), F.sum("s"), F.min("low"), F.max("high")).orderBy("at").collect()
    if not totals:
        return 0, [0] * size, 0
    return totals[0][1], [int(row[2]) for row in totals], max(row[4] - row[3] for row in totals)


def fit_whitening(found: DataFrame, size: int, components: int = COMPONENTS, by_count: bool = False) -> Whitening | None:
    """Leading components of the covariance of distinct vectors ``x`` of ``size`` entries; None where nothing varies.

    Every vector weighs one, or with ``by_count`` the number of its rows. Sums are exact, vectors are centred before they
    are multiplied, and every task hands on one triangle of products.
    """
    found = found if by_count else found.withColumn("w", F.lit(1).cast("long"))
    n, sums, span = _exact_sums(found, size)
    if not n or not span:
        return None
    plain = Whitening(n, sums, span, np.zeros((size, 0)), np.zeros(0), 0.0)
    _, _, products = moments(found, size, plain.centred, size)
    covariance = products / n
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    trace = float(np.trace(covariance))
    kept = min(components, int((values > FLAT * trace).sum()))
    values, vectors = values[:kept], vectors[:, :kept]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(kept)])
    return Whitening(n, sums, span, vectors * signs, values, trace)


def whiten(found: DataFrame, size: int, fit: Whitening) -> DataFrame:
    """Distinct vectors with ``whitened`` (one entry per component) and ``deviation``, the exact sum of ``(n * x - S)`` squared."""
    small = size * (fit.n * fit.span) ** 2 < 1 << 62
    scale = fit.vectors / np.sqrt(fit.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            offsets = fit.offsets(matrix(batch.column(3), np.int64))
            exact = offsets if small else offsets.astype(object)
            deviation = [Decimal(int(d)) for d in (exact * exact).sum(axis=1)]
            yield pa.RecordBatch.from_arrays([
                *[batch.column(at) for at in range(3)], pa.array(deviation, pa.decimal128(38, 0)),
                lists(offsets.astype(float) / fit.n @ scale, pa.float64()),
            ], ["one", "two", "w", "deviation", "whitened"])

    rows = found.filter(F.size("x") == size).select("one", "two", "w", "x")
    return rows.mapInArrow(run, "one long, two long, w long, deviation decimal(38,0), whitened array<double>")


def identity_error(whitened: DataFrame, components: int, by_count: bool = False) -> float:
    """Largest difference of the covariance of whitened fit vectors from the identity."""
    if not by_count:
        whitened = whitened.withColumn("w", F.lit(1).cast("long"))
    n, sums, products = moments(whitened, components, _as_they_are, components, "whitened")
    centre = sums / n
    return float(np.abs(products / n - np.outer(centre, centre) - np.eye(components)).max())


def _as_they_are(x: np.ndarray) -> np.ndarray:
    return x


def whiten_embeddings(embeddings: DataFrame, components: int = COMPONENTS, by_count: bool = False) -> DataFrame:
    """Per row with a usable vector: ``vec_id``, ``n``, ``deviation``, ``whitened``, ``explained`` (arrays) and ``identity_error``.

    Equal grid vectors are one: they are counted once for the fit, whitened once, and joined back to their rows by a 128-bit
    hash. Null and empty vectors and those with null, non-finite or immense entries (from 1e14) are left out, and so are vectors
    that do not have the commonest number of entries (the smaller of equals). Directions without variance are no components; if
    nothing varies, or the table is empty, there are no rows. A null id is kept as it is; repeated rows are answered each. Other
    columns are dropped.
    """
    rows = gridded(embeddings)
    found = materialize(distinct_vectors(rows), "distinct-vectors")
    sizes = found.groupBy(F.size("x").alias("size")).agg(F.count("*").alias("n"), F.sum("w").alias("rows"))
    common = sizes.orderBy(F.desc("n"), "size").first()
    fit = fit_whitening(found, common["size"], components, by_count) if common else None
    if fit is None:
        schema = "vec_id long, n long, deviation decimal(38,0), whitened array<double>, explained array<double>, identity_error double"
        return embeddings.sparkSession.createDataFrame([], schema)
    done = materialize(whiten(found, common["size"], fit), "whitened")
    error = identity_error(done, len(fit.values), by_count)
    back = bring_back(rows.select("vec_id", "one", "two"), done, ["one", "two"], common["rows"])
    shares = F.array(*[F.lit(float(value / fit.trace)) for value in fit.values])
    return back.select(
        "vec_id", F.lit(fit.n).cast("long").alias("n"), "deviation", "whitened", shares.alias("explained"),
        F.lit(error).alias("identity_error"),
    )


@query("op12_embedding_whitening")
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whiten_embeddings(table(spark, sf_dir, "embeddings"))
    rows = rows.select("*", F.posexplode(F.arrays_zip("whitened", "explained")).alias("_at", "_c"))
    return rows.select(
        "vec_id", (F.col("_at") + 1).alias("component"), "n", F.col("deviation").try_cast("long").alias("deviation"),
        F.col("_c.whitened").alias("whitened"), F.col("_c.explained").alias("explained"), "identity_error",
    )
