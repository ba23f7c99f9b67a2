r"""Embedding whitening by shifted CholeskyQR.

Entries become whole numbers ``floor(64 * c) + 1000000``. The fit list holds each distinct vector of them once. With the
number ``n`` and the exact sums ``S`` of the fit list, a row is centred as ``(n * x - S) / n``, whose numerator is exact.

The centred fit list ``A`` is orthogonalised without ever being gathered: a Gram pass gives ``A'A`` from one partial
matrix per task, its Cholesky factor ``R1`` (of the Gram matrix plus a small shift, so that it exists however close to
singular the matrix is) makes the next pass see ``A / R1`` by a triangular solve, and so on until the Gram matrix is the
identity or after four passes. The product ``R`` of all factors has ``R'R = A'A``, with the error of a single rounding
rather than of a squared condition number. A last factor that has no Cholesky form, because some direction has no
variance, is the root of its eigenvalues. The singular values of ``R`` then give the eigenvalues ``s^2 / n`` of the
covariance, its right singular vectors the components. Only matrices of dimension times dimension reach the driver.

Rows are left out whose vector is null, empty, has a null or non-finite entry or one above 2^55, or another length than
most of the distinct vectors have (the greater of two lengths as frequent). A direction whose variance is zero up to
rounding is no component, so constant dimensions, fewer dimensions than components, a single vector and an empty table
give fewer components or none. A component's sign is such that its greatest entry is positive. A deviation that no long
can hold is null.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stage

#: The grid that entries are cut to.
SCALE, OFFSET = 64, 1_000_000
#: Entries of which 64 times is far from the end of a long.
GREATEST = 2.0**55
#: Numbers that a task computes with at once.
BLOCK = 1 << 20
PASSES = 4


@dataclass(frozen=True)
class Whitening:
    """What is needed to whiten a row: ``components`` has one row of ``dimension`` entries per component."""

    n: int
    dimension: int
    sums: list[int]
    components: np.ndarray
    variances: np.ndarray
    explained: np.ndarray
    identity_error: float


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, vectors) of the usable rows of a list column, by length and in blocks."""
    values, offsets = column.values, np.asarray(column.offsets)
    found = np.asarray(values.fill_null(np.nan)).astype(float, copy=False) if len(values) else np.zeros(0)
    starts, lengths = offsets[:-1], np.diff(offsets)
    lengths = np.where(np.asarray(column.is_null()), 0, lengths)
    for length in np.unique(lengths[lengths > 0]):
        own = np.flatnonzero(lengths == length)
        for part in np.array_split(own, max(1, -(-len(own) * int(length) // BLOCK))):
            block = found[starts[part][:, None] + np.arange(length)]
            usable = (np.abs(block) <= GREATEST).all(axis=1)  # no comparison holds for NaN
            if usable.any():
                yield part[usable], block[usable]


def whole_numbers(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors).astype(np.int64) + OFFSET


def numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, exact: as Python's numbers where a long might not hold them."""
    if n * (int(np.abs(x).max(initial=0)) + 1) + max(map(abs, sums)) < 1 << 62:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def deviations(d: np.ndarray) -> list[int | None]:
    """The sum of squares of each row, null where a long can't hold it."""
    about = (d.astype(float) ** 2).sum(axis=1)
    small = about < 9.2e18  # below it every partial sum fits a long
    out: list[int | None] = [None] * len(d)
    for i, total in zip(np.flatnonzero(small), (d[small].astype(np.int64) ** 2).sum(axis=1).tolist()):
        out[i] = total
    for i in np.flatnonzero(~small & (about < 9.3e18)):
        total = sum(int(v) ** 2 for v in d[i])
        out[i] = total if total < 1 << 63 else None
    return out


def fit_list(rows: DataFrame, vector_col: str) -> DataFrame:
    """``x``: each distinct vector of whole numbers once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, block in _vectors(batch.column(0)):
                x = whole_numbers(block)
                ends = np.arange(0, x.size + 1, x.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(ends, x.ravel())], names=["x"])

    vectors = rows.select(F.col(f"`{vector_col}`").cast("array<double>").alias("v")).where("v is not null")
    return vectors.mapInArrow(run, "x array<long>").distinct()


def _blocks(column: pa.Array, dimension: int) -> Iterator[np.ndarray]:
    """The vectors of one length of a column of the fit list, in blocks."""
    offsets, values = np.asarray(column.offsets), np.asarray(column.values)
    own = np.flatnonzero(np.diff(offsets) == dimension)
    for part in np.array_split(own, max(1, -(-len(own) * dimension // BLOCK))):
        if len(part):
            yield values[offsets[part][:, None] + np.arange(dimension)]


def exact_sums(fit: DataFrame) -> tuple[int, int, list[int]]:
    """(n, dimension, S) of the commonest length of the fit list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            column = batch.column(0)
            for length in np.unique(np.diff(np.asarray(column.offsets))).tolist():
                for block in _blocks(column, length):
                    n, sums = totals.get(length, (0, np.zeros(length, object)))
                    # The high and the low half add up in longs; Python's numbers join them.
                    high, low = block >> 32, block & 0xFFFFFFFF
                    totals[length] = n + len(block), sums + (high.sum(axis=0).astype(object) << 32) + low.sum(axis=0).astype(object)
        rows = [{"length": k, "i": i, "n": n, "total": str(s)} for k, (n, sums) in totals.items() for i, s in enumerate(sums)]
        yield pa.RecordBatch.from_pylist(
            rows, schema=pa.schema({"length": pa.int32(), "i": pa.int32(), "n": pa.int64(), "total": pa.string()})
        )

    parts = fit.mapInArrow(run, "length int, i int, n long, total string")
    sums = parts.groupBy("length", "i").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    sums = stage(sums, "sums")
    first = sums.where("i = 0").orderBy(F.desc("n"), F.desc("length")).first()
    if first is None:
        return 0, 0, []
    # One number per dimension.
    found = sums.where(F.col("length") == first["length"]).orderBy("i").collect()
    return first["n"], first["length"], [int(r["total"]) for r in found]


def gram(fit: DataFrame, n: int, sums: list[int], turn: Callable[[np.ndarray], np.ndarray], size: int) -> np.ndarray:
    """``B'B`` for the rows ``B = turn(A)`` of the centred fit list: a partial matrix per task, whose rows are added up
    by number in a fixed order."""
    dimension = len(sums)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            for block in _blocks(batch.column(0), dimension):
                b = turn(numerators(block, n, sums).astype(float) / n)
                total += b.T @ b
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(size), pa.int32()), pa.array([task] * size, pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["i", "task", "line"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, line in zip(batch.column("i").to_pylist(), batch.column("line")):
                lines[i] = lines.get(i, 0) + np.asarray(line.values)
        yield pa.RecordBatch.from_arrays(
            [pa.array(lines, pa.int32()), pa.array(list(lines.values()), pa.list_(pa.float64()))], names=["i", "line"]
        )

    parts = fit.mapInArrow(partial, "i int, task int, line array<double>")
    added = parts.repartition("i").sortWithinPartitions("i", "task").mapInArrow(add, "i int, line array<double>")
    out = np.zeros((size, size))
    for row in added.collect():  # dimension times dimension numbers
        out[row["i"]] = row["line"]
    return (out + out.T) / 2


def upper_factor(g: np.ndarray, n: int, shifted: bool) -> np.ndarray:
    """An upper triangular ``R`` with ``R'R = G``, or of ``G`` with a shift."""
    d = len(g)
    unit = np.finfo(float).eps
    shift = 11 * (min(n, 1 << 40) * d + d * (d + 1)) * unit * np.linalg.norm(g, 2) if shifted else 0.0
    # The bound grows with n; a hundredth of the trace is always enough to be far from singular.
    shift = min(shift, 0.01 * np.trace(g) / d)
    return np.linalg.cholesky(g + shift * np.eye(d)).T


def orthogonalise(fit: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """The factor ``R`` with ``R'R = A'A``, composed from Gram passes."""
    d = len(sums)
    factors: list[np.ndarray] = []
    sc = fit.sparkSession.sparkContext
    composed = np.eye(d)
    for number in range(PASSES):
        sent = sc.broadcast(list(factors))  # bounded by the dimension

        def solve(rows: np.ndarray) -> np.ndarray:
            for factor in sent.value:
                rows = np.linalg.solve(factor.T, rows.T).T
            return rows

        g = gram(fit, n, sums, solve, d)
        if not g.any():
            return np.zeros((d, d))
        last = number + 1 == PASSES or np.abs(g - np.eye(d)).max() < 1e-10
        try:
            factor = upper_factor(g, n, shifted=number == 0)
        except np.linalg.LinAlgError:
            factor = None if last else upper_factor(g, n, shifted=True)
        if factor is None:
            values, vectors = np.linalg.eigh(g)
            factor = np.sqrt(np.maximum(values, 0))[:, None] * vectors.T
        composed = factor @ composed
        if last:
            break
        factors.append(factor)
    return composed


def fit_whitening(rows: DataFrame, vector_col: str = "embedding", components: int = 16) -> Whitening:
    """The first ``components`` principal directions of the distinct vectors."""
    fit = stage(fit_list(rows, vector_col), "fit-list")
    n, dimension, sums = exact_sums(fit)
    if not n:
        return Whitening(0, 0, [], np.zeros((0, 0)), np.zeros(0), np.zeros(0), 0.0)
    _, singular, turned = np.linalg.svd(orthogonalise(fit, n, sums))
    kept = int((singular[:components] > dimension * np.finfo(float).eps * singular[0]).sum()) if singular[0] else 0
    variances = singular**2 / n
    axes = turned[:kept]
    signs = np.sign(axes[np.arange(kept), np.abs(axes).argmax(axis=1)]) if kept else np.zeros(0)
    axes = axes * signs[:, None]
    error = 0.0
    if kept:
        scaled = (axes / np.sqrt(variances[:kept])[:, None]).T
        covariance = gram(fit, n, sums, lambda a: a @ scaled, kept) / n
        error = float(np.abs(covariance - np.eye(kept)).max())
    explained = variances[:kept] / variances.sum() if kept else np.zeros(0)
    return Whitening(n, dimension, sums, axes, variances[:kept], explained, error)


def whiten(rows: DataFrame, model: Whitening, vector_col: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``deviation`` and ``whitened``, one number per component, for the rows
    that are not left out. Both replace input columns of their names."""
    added = T._parse_datatype_string("deviation long, whitened array<double>").fields
    names = [f.name for f in added]
    kept = [c for c in (rows.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*[rows.schema[c] for c in kept], *added])
    place = len(kept)
    sent = rows.sparkSession.sparkContext.broadcast((model.n, model.dimension, model.sums, model.components, model.variances))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, dimension, sums, axes, variances = sent.value
        scaled = (axes / np.sqrt(variances)[:, None]).T if len(axes) else np.zeros((dimension, 0))
        for batch in batches:
            for places, block in _vectors(batch.column(place)):
                if block.shape[1] != dimension:
                    continue
                d = numerators(whole_numbers(block), n, sums)
                white = (d.astype(float) / n) @ scaled
                ends = np.arange(0, white.size + 1, max(1, white.shape[1]), dtype=np.int32) if white.size else np.zeros(len(d) + 1, np.int32)
                own = batch.take(pa.array(places))
                made = [pa.array(deviations(d), pa.int64()), pa.ListArray.from_arrays(ends, white.ravel())]
                yield pa.RecordBatch.from_arrays([*own.columns[:place], *made], names=schema.names)

    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    return rows.select(*own, F.col(f"`{vector_col}`").cast("array<double>").alias("v")).mapInArrow(run, schema)


def op12_embedding_whitening(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    model = fit_whitening(rows)
    each = whiten(rows, model, keep=["vec_id"]).select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    shares = F.array(*[F.lit(float(x)) for x in model.explained]).cast("array<double>")
    return each.select(
        "vec_id", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("place")).alias("explained"), F.lit(model.identity_error).alias("identity_error"),
    )
