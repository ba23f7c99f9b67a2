"""Text outputs and the quarantine of rejected files."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import glob, remove, scratch_path


def write_lines(
    rows: DataFrame, path: str, file_col: str = "out_file", order: str = "row_no", line_col: str = "file_row",
    partitions: int | None = None, mode: str = "overwrite",
) -> None:
    """Write ordered lines, one ``file_col=value`` folder per output file.

    Rows are range-partitioned by (file, order), so a very large file is written by many tasks as
    parts whose names follow the order, and no task has to hold a whole file.
    """
    keys = [file_col, order]
    ranged = rows.repartitionByRange(partitions, *keys) if partitions else rows.repartitionByRange(*keys)
    ordered = ranged.sortWithinPartitions(*keys).select(file_col, F.col(line_col).alias("value"))
    ordered.write.mode(mode).partitionBy(file_col).text(path)


def write_named_files(
    rows: DataFrame, path: str, file_col: str = "out_file", order: str = "row_no", line_col: str = "file_row"
) -> list[str]:
    """Write each output as one file, ``path`` / its name, with its lines in order; returns the names.

    The lines of a file are sorted and written by one task, as a file of one name has one writer; what
    does not fit memory is sorted on disk. Tasks get ranges of names of about equal size, so that no two
    large files meet in one. The finished files are then put under their names, which
    moves no data. A file that is there already is replaced; a run that stops before leaves it alone.
    Names with a slash are refused. For outputs that may be folders of parts, :func:`write_lines` lets
    many tasks write one output.
    """
    spark = rows.sparkSession
    refused = F.raise_error(F.concat(F.lit("a name with a slash: "), F.col(file_col))).cast("string")
    name = F.when(F.col(file_col).contains("/"), refused).otherwise(F.col(file_col))
    named = rows.select(name.alias("name"), F.col(order).alias("at"), F.col(line_col).alias("value"))
    # One task per name, as parts would be files of their own.
    in_order = named.repartitionByRange("name").sortWithinPartitions("name", "at").select("name", "value")
    made = scratch_path(spark, "named")
    in_order.write.option("maxRecordsPerFile", 0).partitionBy("name").text(made)

    hadoop = spark._jvm.org.apache.hadoop.fs
    store = hadoop.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(hadoop.Path(path))
    parts: dict[str, list[str]] = {}
    for part in glob(spark, f"{made}/name=*/part-*"):
        parts.setdefault(unquote(part.split("/")[-2].removeprefix("name=")), []).append(part)
    several = [n for n, found in parts.items() if len(found) > 1]
    if several:
        raise RuntimeError(f"outputs in several parts: {several[:10]}")
    for n, (part,) in sorted(parts.items()):
        final = hadoop.Path(hadoop.Path(path), hadoop.Path(None, None, n))
        store.delete(final, False)
        if not store.rename(hadoop.Path(part), final):
            raise RuntimeError(f"could not put {part} under the name {n}")
    remove(spark, made)
    return sorted(parts)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """The files of a folder as they are stored: ``path, line_count`` (line ends), ``size, digest`` (SHA-256 of all bytes).
    Spark's readers leave out files without a byte.

    A file is read as lines by many tasks. Its digest is sequential, so one task then takes its lines in
    order, as a stream; it never holds a file.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"),
        F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, size, count, seen, digest = None, 0, 0, 0, hashlib.sha256()

        def done() -> Iterator[pa.RecordBatch]:
            if name is None:
                return
            # The last line has an end of its own, or it stands at the end of the file without.
            if seen not in (size, size + 1):
                raise ValueError(f"{name}: {size} bytes, of which {seen} were read as lines")
            if seen == size:
                digest.update(b"\n")
            row = ([name], [count - (seen > size)], [digest.hexdigest()])
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in row], names=["path", "line_count", "digest"])

        for batch in batches:
            paths = batch.column(0).cast(pa.string()).dictionary_encode()
            codes, sizes = paths.indices.to_numpy(), batch.column(1).to_numpy()
            whole = batch.column(2).cast(pa.large_binary())
            ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
            data = memoryview(whole.buffers()[2])
            cuts = [0, *(np.flatnonzero(np.diff(codes)) + 1).tolist(), len(codes)]
            for start, stop in zip(cuts, cuts[1:]):
                if start == stop:
                    continue
                own = paths.dictionary[int(codes[start])].as_py()
                if own != name:
                    yield from done()
                    name, size, count, seen, digest = own, int(sizes[start]), 0, 0, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(data[int(ends[start]) : int(ends[stop]) - 1])
                count, seen = count + stop - start, seen + int(ends[stop] - ends[start])
        yield from done()

    in_order = lines.repartitionByRange("path").sortWithinPartitions("path", "block", "at").select("path", "size", "line")
    found = in_order.mapInArrow(run, "path string, line_count long, digest string")
    # The metadata hold paths in an encoded form.
    key = F.col("_metadata.file_path")
    files = spark.read.format("binaryFile").load(path).select(key.alias("_key"), F.col("path"), F.col("length").alias("size"))
    named = found.withColumnRenamed("path", "_key")
    return files.join(named, "_key", "left").select("path", "line_count", "size", "digest")


def quarantine(files: DataFrame, reason_col: str = "reason") -> DataFrame:
    """Rejected files with the text that is put beside them: ``file, platform, reason, side_text``."""
    side = F.concat_ws("\n", F.lit("Could not process this file:"), F.col("file"), F.col(reason_col))
    return files.where(F.col(reason_col).isNotNull()).select(
        "file", "platform", F.col(reason_col).alias("reason"), side.alias("side_text")
    )


def write_quarantine(files: DataFrame, path: str, mode: str = "append") -> None:
    quarantine(files).write.mode(mode).partitionBy("platform").parquet(path)
