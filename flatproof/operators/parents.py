"""Last-parent propagation: each row gets the nearest parent row above it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK_ROWS = 100_000


def row_chunk(order: str = "source_row_no", rows: int = CHUNK_ROWS) -> Column:
    """Chunks of consecutive row numbers."""
    return F.floor((F.col(order) - 1) / rows)


def time_chunk(order: str, minutes: int = 60) -> Column:
    """Chunks of consecutive minutes, for rows ordered by a timestamp."""
    return F.floor(F.unix_seconds(F.col(order).cast("timestamp")) / (minutes * 60))


def last_parent(
    rows: DataFrame,
    is_parent: Column,
    payload: dict[str, Column],
    partition: str = "file",
    order: str = "source_row_no",
    chunk: Column | None = None,
    name: str = "parent",
) -> DataFrame:
    """Add ``name``: ``payload`` of the last parent at or above each row of its partition.

    Two levels, so that a partition with a large share of all rows is never held by one task:
    rows are windowed per (partition, chunk), and the parent that was open when a chunk began
    comes from a prefix scan over one row per chunk. ``chunk`` must not decrease with ``order``.
    """
    body = F.struct(*[c.alias(n) for n, c in payload.items()])
    chunk = row_chunk(order) if chunk is None else chunk
    # The order value rides along, so that the nearer of two parents is known without a sort.
    marked = rows.withColumns(
        {"_chunk": chunk, "_own": F.when(is_parent, F.struct(F.col(order).alias("at"), body.alias("body")))}
    )
    per_chunk = marked.groupBy(partition, "_chunk").agg(
        F.max_by("_own", F.when(F.col("_own").isNotNull(), F.col(order))).alias("_last")
    )
    above = Window.partitionBy(partition).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        per_chunk.withColumn("_open", F.last("_last", ignorenulls=True).over(above))
        .where(F.col("_open").isNotNull())
        .select(F.col(partition).alias("_p"), F.col("_chunk").alias("_c"), "_open")
    )
    joined = marked.join(
        carried, marked[partition].eqNullSafe(carried["_p"]) & (marked["_chunk"] == carried["_c"]), "left"
    )
    inside = (
        Window.partitionBy(partition, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    )
    nearest = F.coalesce(F.last("_own", ignorenulls=True).over(inside), F.col("_open"))
    return joined.withColumn("_near", nearest).select(*rows.columns, F.col("_near.body").alias(name))
