"""The file log: one header per file, one row per task, and ids that tie them together."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from .classify import file_id_from_name, without_extension

HEADER_COLUMNS = [
    "platform", "folder_name", "template_type", "ic_type", "to_ftp", "bencode", "original_file_name",
    "original_full_path", "new_file_name", "new_file_full_path",
]


def resolve_file_id(original_name: Column, new_name: Column) -> Column:
    """The id in the new name, else the id in the original name, else the original name."""
    by_new, by_original = (T.blank_to_null(file_id_from_name(c)) for c in (new_name, original_name))
    return F.coalesce(by_new, by_original, without_extension(original_name))


def with_ids(tasks: DataFrame) -> DataFrame:
    """Tasks with ``file_id`` and a ``file_log_id`` that follows from it: the same file always
    gets the same ids, in whatever run or order it is logged."""
    named = tasks.withColumn(
        "original_file_name",
        F.coalesce(
            T.blank_to_null(F.col("original_file_name")), T.blank_to_null(F.col("folder_name")),
            T.blank_to_null(F.col("processing_task")), F.col("platform"),
        ),
    )
    file_id = resolve_file_id(F.col("original_file_name"), T.text("new_file_name"))
    return named.withColumn("file_id", file_id).withColumn("file_log_id", F.xxhash64("file_id"))


def new_headers(tasks: DataFrame, headers: DataFrame | None = None) -> DataFrame:
    """One header per new file: its first task. Files that are logged already are left out."""
    present = [c for c in HEADER_COLUMNS if c in tasks.columns]
    first = F.min_by(F.struct(*present, "created_at"), F.struct("created_at", "task_seq")).alias("_first")
    heads = tasks.groupBy("file_log_id", "file_id").agg(first).select("file_log_id", "file_id", "_first.*")
    if headers is not None:
        heads = heads.join(headers.select("file_log_id"), "file_log_id", "left_anti")
    return heads


def log_tasks(tasks: DataFrame, headers: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """New headers and the task rows to append for a batch of operations."""
    identified = with_ids(tasks)
    detail = identified.withColumn("file_log_task_id", F.xxhash64("file_log_id", "created_at", "task_seq"))
    return new_headers(identified, headers), detail


def log_view(headers: DataFrame, details: DataFrame) -> DataFrame:
    """Headers with the number of their tasks that ended in an error."""
    errors = details.groupBy("file_log_id").agg(
        F.count_if(F.col("processing_task_outcome") == "ERROR").alias("processing_error_count")
    )
    joined = headers.join(errors, "file_log_id", "left")
    return joined.withColumn("processing_error_count", F.coalesce("processing_error_count", F.lit(0)))


def error_counts(owners: DataFrame, rows: DataFrame, key: str, is_error: Column, name: str = "error_count") -> DataFrame:
    """Every owner with its number of errors, zero where it has none."""
    counted = rows.groupBy(key).agg(F.count_if(is_error).alias(name))
    return owners.join(counted, key, "left").withColumn(name, F.coalesce(name, F.lit(0)))


def latest_by_prefix(names: DataFrame, log: DataFrame, name_col: str = "name") -> DataFrame:
    """For each name the highest log id whose original or new file name begins with it, else 0.

    The test is made an equi-join: a log name is listed under its beginnings of the lengths that wanted
    names have. These lengths, some numbers, are read when the plan is made.
    """
    wanted = names.select(F.col(name_col).alias("_name")).where(~T.is_blank(F.col("_name"))).distinct()
    lengths = sorted(r[0] for r in wanted.select(F.length("_name")).distinct().collect())
    entries = log.select("file_log_id", F.explode(F.array("original_file_name", "new_file_name")).alias("_file"))
    fitting = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_file"))
    cut = entries.select("file_log_id", F.explode(F.transform(fitting, lambda n: F.left("_file", n))).alias("_name"))
    best = cut.join(wanted, "_name", "left_semi").groupBy("_name").agg(F.max("file_log_id").alias("file_log_id"))
    joined = names.join(best, names[name_col] == best["_name"], "left").drop("_name")
    return joined.withColumn("file_log_id", F.coalesce("file_log_id", F.lit(0)))


def top_rows(rows: DataFrame, owner: str, order: str, k: int) -> DataFrame:
    """The last ``k`` rows of each owner by ``order``.

    Rows are first cut to the best ``k`` per (owner, slice), so that a hot owner is ranked from a
    few candidates of many tasks.
    """
    slices = F.pmod(F.xxhash64(order), F.lit(64))
    first = Window.partitionBy(owner, "_slice").orderBy(F.desc(order))
    last = Window.partitionBy(owner).orderBy(F.desc(order))
    cut = rows.withColumn("_slice", slices).withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= k)
    return cut.withColumn("rank", F.row_number().over(last)).where(F.col("rank") <= k).drop("_slice", "_rank")
