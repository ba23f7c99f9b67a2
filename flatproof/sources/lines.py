"""Text files as lines, with line numbers that hold when a file is read by many tasks."""

from __future__ import annotations

import re
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import pin_splits, stage

# The file masks of a source folder and the size up to which a file is empty.
FILE_MASKS = ("*.csv", "*.xlsx", "*.xls", "*.txt", "*.mbi")
EMPTY_FILE_BYTES = 100


def _mask(masks: tuple[str, ...] | list[str]) -> str:
    return masks[0] if len(masks) == 1 else "{" + ",".join(masks) + "}"


def list_files(
    spark: SparkSession, dirs: list[str], masks=FILE_MASKS, recursive: bool = False
) -> DataFrame:
    """Files of several folders and masks with their metadata; contents are not read."""
    reader = spark.read.format("binaryFile").option("pathGlobFilter", _mask(list(masks)))
    files = reader.option("recursiveFileLookup", str(recursive).lower()).load(dirs)
    return files.select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("file_name"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )


def read_lines(
    spark: SparkSession,
    paths: list[str],
    masks: list[str] | None = None,
    recursive: bool = False,
    keep: Column | None = None,
) -> DataFrame:
    """Lines of text files: ``file, part, block, size, modified, line``.

    ``keep`` is a predicate on ``line``. ``file`` is the path of the file; a folder written by
    :func:`~flatproof.sources.sinks.write_lines` is regrouped with :func:`as_logical_files`.
    """
    pin_splits(spark)
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if masks:
        reader = reader.option("pathGlobFilter", _mask(masks))
    lines = reader.text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_path").alias("part"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
        F.col("value").alias("line"),
    )
    return lines if keep is None else lines.where(keep)


def literal_path(path: str) -> str:
    """A path in which no character is a pattern."""
    return re.sub(r"([\\*?{}\[\]])", r"\\\1", path)


def _why(error: Exception) -> str:
    """The innermost cause of a failed read, in one line."""
    causes = re.findall(r"^Caused by: (?:[\w.$]+: )?(.*)$", str(error), re.M)
    return (causes[-1] if causes else str(error).split("\n", 1)[0]).strip()


def unreadable_files(spark: SparkSession, paths: list[str], at_once: int = 4) -> list[tuple[str, str]]:
    """Files that can't be read to their end, each with the reason.

    All files are read in one job. Only if that fails, halves of them are read, and halves of those that
    fail, ``at_once`` at a time, down to single files. So good files cost one pass, a broken file some
    more passes over ever fewer files, and a failure that does not come back when a file is read alone
    blames no file.
    """
    parts, broken = [paths] if paths else [], []

    def failure(part: list[str]) -> str | None:
        try:
            spark.read.text([literal_path(p) for p in part]).agg(F.max(F.length("value"))).collect()
        except (PySparkException, Py4JJavaError) as error:
            return _why(error)
        return None

    with ThreadPoolExecutor(at_once) as pool:
        while parts:
            failed = [(part, why) for part, why in zip(parts, pool.map(failure, parts)) if why is not None]
            broken += [(part[0], why) for part, why in failed if len(part) == 1]
            cut = [part for part, _ in failed if len(part) > 1]
            parts = [half for part in cut for half in (part[: len(part) // 2], part[len(part) // 2 :])]
    return sorted(broken)


def read_good_lines(
    spark: SparkSession,
    paths: list[str],
    masks: list[str] | None = None,
    recursive: bool = False,
    keep: Column | None = None,
    on_error: Callable[[str, str], None] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Lines as :func:`read_lines` gives them, of all files that can be read, and the others: ``file,
    platform, reason``, ready for the quarantine. ``on_error`` is called with the path and the reason
    of each of them.

    Good files are read as strictly as ever: a failure that comes later fails the job rather than
    losing lines.
    """
    found = [r["path"] for r in list_files(spark, paths, masks or ["*"], recursive).select("path").collect()]
    broken = unreadable_files(spark, found)
    for path, why in broken:
        if on_error is not None:
            on_error(path, why)
    bad = {path for path, _ in broken}
    good = [literal_path(p) for p in found if p not in bad]
    failed = spark.createDataFrame([(p, "Unknown", why) for p, why in broken], "file string, platform string, reason string")
    if good:
        return read_lines(spark, good, keep=keep), failed
    nothing = "file string, part string, block bigint, size bigint, modified timestamp, line string"
    return spark.createDataFrame([], nothing), failed


def as_logical_files(lines: DataFrame, column: str = "out_file") -> DataFrame:
    """Treat each ``column=value`` folder as one file whose parts follow each other by name."""
    return lines.withColumn("file", F.regexp_extract("part", f"/{column}=([^/]*)/", 1))


def number_lines(lines: DataFrame, skip_blank: bool = False) -> DataFrame:
    """Add ``source_row_no``, the line number inside each file, from 1.

    A first pass counts the lines per block; a prefix sum over the block table gives each block its
    offset; the second pass adds the position inside the block. The block table is written out, so
    that Spark joins it by its true size: a small one goes to the lines, with a large one lines are
    joined by block, which spreads them evenly. Both passes cut files into the same blocks (see
    :func:`~flatproof.session.pin_splits`), and a block without an offset fails the job rather
    than losing numbers.
    """
    if skip_blank:
        lines = lines.where(~T.is_blank(F.col("line")))
    # Two hashes stand for the path of a part, which keeps the block table narrow.
    keys = {"_part": F.xxhash64("part"), "_part2": F.hash("part"), "_block": F.col("block")}
    placed = lines.withColumns({**keys, "_at": F.monotonically_increasing_id()})
    blocks = placed.groupBy("file", "part", *keys).agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = Window.partitionBy("file").orderBy("part", "_block").rowsBetween(Window.unboundedPreceding, -1)
    shift = F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1 - F.col("_first")
    offsets = stage(blocks.select(*keys, shift.alias("_shift")), "block-offsets")
    joined = placed.join(offsets, list(keys), "left")
    missing = F.raise_error(F.lit("line block without offset: files were cut differently in both passes"))
    number = F.coalesce(F.col("_at") + F.col("_shift"), missing.cast("bigint"))
    return joined.select(*lines.columns, number.alias("source_row_no"))


def latest_of_pattern(files: DataFrame, pattern_col: str | None = None, name_col: str = "file_name") -> DataFrame:
    """The last file by name, of all files or per pattern."""
    rest = [c for c in files.columns if c != pattern_col]
    best = F.max_by(F.struct(*rest), F.col(name_col)).alias("_best")
    picked = files.groupBy(pattern_col).agg(best) if pattern_col else files.agg(best)
    return picked.select(*([pattern_col] if pattern_col else []), "_best.*")


def active_folders(registry: DataFrame, environment: str, template_type: str | None = None) -> DataFrame:
    """Active source folders of an environment, ordered by folder."""
    out = registry.where((F.col("environment") == environment) & (F.col("is_active") == 1))
    if template_type is not None:
        out = out.where(F.lower("template_type") == template_type.lower())
    return out.orderBy("folder_name")


def register_folder_views(registry: DataFrame, prefix: str = "header_list") -> list[str]:
    """Temporary views of the registry, one per template type and one of all."""
    names = {"all": None, "new": "new", "old": "old", "own": "own", "none": "none"}
    for suffix, kind in names.items():
        view = registry if kind is None else registry.where(F.lower("template_type") == kind)
        view.createOrReplaceTempView(f"{prefix}_{suffix}")
    return [f"{prefix}_{s}" for s in names]
