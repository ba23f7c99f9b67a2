"""The folder poll as an incremental file stream."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import compact_table, has_rows, read_table, upsert_table
from ..session import pin_splits, stage


def stream_lines(spark: SparkSession, path: str, mask: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """New text files of a folder: ``file, part, block, size, modified, line``, as
    :func:`~flatproof.sources.lines.read_lines` gives them. Files are read once (checkpoint); a file
    arrives in one batch, so that a batch can be numbered and checked like a folder.
    """
    pin_splits(spark)
    reader = spark.readStream.schema("value string").option("maxFilesPerTrigger", files_per_trigger)
    if mask:
        reader = reader.option("pathGlobFilter", mask)
    return reader.option("recursiveFileLookup", "true").format("text").load(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("line"),
    )


@dataclass(frozen=True)
class Postings:
    """A history of what was posted, one row per posting key, laid out by a hash of the key.

    ``of`` gives the postings among checked rows (key columns and what a report needs of them), of
    rows that are to be checked as of rows that were; ``order`` tells which of a batch's postings of
    one key is kept. ``mark`` marks the rows that repeat a posting: it gets the rows and the history
    of their keys, None as long as there is none.
    """

    path: str
    keys: list[str]
    of: Callable[[DataFrame], DataFrame]
    mark: Callable[[DataFrame, DataFrame | None], DataFrame]
    order: Column
    buckets: int = 256


def ingest(
    lines: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    table_path: str,
    checkpoint: str,
    keys: list[str],
    order: Column | None = None,
    against_table: Callable[[DataFrame, DataFrame | None], DataFrame] | None = None,
    postings: Postings | None = None,
    compact_every: int = 50,
) -> None:
    """Upsert what arrived since the last run into a table, then stop.

    Each batch is transformed like a batch job and stored as the upsert of its number, so a batch
    that is repeated after a failure replaces what it wrote. ``against_table`` may check rows
    against all that earlier batches stored; ``postings`` checks them against a history of which
    each batch reads the buckets of its own keys, and adds theirs. Every ``compact_every`` batches
    the stored tables are compacted but for the last upsert, the one that can still be repeated.
    """
    spark = lines.sparkSession

    def take(batch: DataFrame, batch_id: int) -> None:
        number = batch_id + 1
        rows = transform(batch).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
        if against_table is not None:
            earlier = has_rows(spark, table_path, number)
            rows = against_table(rows, read_table(spark, table_path, number) if earlier else None)
        if postings is not None:
            rows = stage(rows, "batch")
            known = None
            if has_rows(spark, postings.path, number):
                known = read_table(spark, postings.path, number, only=postings.of(rows))
            rows = stage(postings.mark(rows, known), "marked")
        upsert_table(spark, table_path, rows, keys, order, number)
        if postings is not None:
            made = postings.of(rows)
            upsert_table(spark, postings.path, made, postings.keys, postings.order, number, postings.buckets)
        if number % compact_every == 0:
            for path in [table_path, *([postings.path] if postings else [])]:
                compact_table(spark, path, keep=1)

    query = (
        lines.writeStream.trigger(availableNow=True)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(take)
        .start()
    )
    query.awaitTermination()
