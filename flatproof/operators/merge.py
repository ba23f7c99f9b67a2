"""Staged rows into stored tables: clean-up, upsert by key, replacement of a period."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..session import glob, remove, scratch_scope, stage

ROW_KEY = ["file", "source_row_no"]
#: Rows of a table with the same key are compared by tasks of about this many rows.
TASK_ROWS = 200_000


def keep_original(rows: DataFrame, row_col: str = "data_row", org_col: str = "org_data_row") -> DataFrame:
    """The original row text, set once: only where it is still blank."""
    if org_col not in rows.columns:
        return rows.withColumn(org_col, F.col(row_col))
    return rows.withColumn(org_col, F.coalesce(T.blank_to_null(F.col(org_col)), F.col(row_col)))


def mark_check(rows: DataFrame, check_type: str = "PreCheck") -> DataFrame:
    return rows.withColumn("check_type", F.lit(check_type))


def clear_result_headers(rows: DataFrame) -> DataFrame:
    """Result header rows carry no error."""
    header = F.coalesce(F.upper("row_type").isin("RA", "[VERSION]"), F.lit(False))
    return rows.withColumns(
        {c: F.when(~header, F.col(c)) for c in ("error_code", "error_message") if c in rows.columns}
    )


def default_sent_name(rows: DataFrame, sent: str = "sent_file", result: str = "result_file") -> DataFrame:
    """A result row without a sent-file name takes the name of its own file."""
    return rows.withColumn(sent, F.coalesce(T.blank_to_null(F.col(sent)), F.col(result)))


def duplicate_keys(rows: DataFrame, keys: list[str] = ROW_KEY) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return rows.groupBy(*keys).agg(F.count("*").alias("row_count")).where(F.col("row_count") > 1)


def latest_per_key(rows: DataFrame, keys: list[str], order: Column, tasks: int | None = None) -> DataFrame:
    """One row per key: the one that is highest in ``order``. Reduced before the shuffle.

    Whole rows are sorted for that. With ``tasks`` they are dealt over so many by key first, and a task
    sorts its share rather than all that it reads.
    """
    if tasks is not None:
        rows = rows.repartition(tasks, *[F.col(f"`{k}`") for k in keys])
    rest = [c for c in rows.columns if c not in keys]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in rest]), order).alias("_best")
    return rows.groupBy(*keys).agg(best).select(
        *keys, *[F.col(f"_best.`{c}`").alias(c) for c in rest]
    ).select(*[F.col(f"`{c}`") for c in rows.columns])


def upsert(
    target: DataFrame, batch: DataFrame, keys: list[str] = ROW_KEY, order: Column | None = None
) -> DataFrame:
    """Target rows that the batch does not replace, and the batch. Columns are aligned by name.

    With ``order``, duplicate keys of the batch keep their highest row.
    """
    if order is not None:
        batch = latest_per_key(batch, keys, order)
    side = batch.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    same = reduce(lambda a, b: a & b, [target[k].eqNullSafe(side[f"_k{i}"]) for i, k in enumerate(keys)])
    kept = target.join(side, same, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)


# --- stored tables ---------------------------------------------------------------------------
#
# A stored table is a folder of upserts: ``keys`` names the key columns with their types, each
# ``part-<n>`` holds the rows of one upsert, and ``whole-<n>`` all rows up to part n. A folder counts
# once Spark's writer has put its ``_SUCCESS`` mark into it, which is the last thing it does; what a
# failed run leaves behind is not read, and is overwritten by the next. An upsert writes its own
# rows and nothing else. There is one writer at a time. The rows of a table with buckets lie in
# folders by a hash of their key, so that who asks for some keys reads the folders of these alone.

PART, BUCKET = "_part", "_bucket"


def has_table(spark: SparkSession, path: str) -> bool:
    return bool(glob(spark, path))


def _committed(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Numbers of the finished folders of a kind, in order."""
    marks = glob(spark, f"{path}/{kind}-*/_SUCCESS")
    return sorted(int(m.split("/")[-2].removeprefix(f"{kind}-")) for m in marks)


def _folder(path: str, kind: str, number: int) -> str:
    return f"{path}/{kind}-{number:012d}"


def _noted(spark: SparkSession, path: str) -> list[tuple]:
    """Place, name and type of the key columns, and the number of buckets."""
    return [tuple(r) for r in spark.read.parquet(f"{path}/keys").orderBy("place").collect()]


def table_keys(spark: SparkSession, path: str) -> list[str]:
    """The key columns of a stored table."""
    return [name for _, name, *_ in _noted(spark, path)]


def _check_columns(spark: SparkSession, path: str, batch: DataFrame, keys: list[str], buckets: int | None) -> int:
    """Note the keys of a new table; refuse other keys, and columns that changed their type. Returns the buckets."""
    types = {f.name: f.dataType.simpleString() for f in batch.schema.fields}
    wanted = [(i, k, types[k]) for i, k in enumerate(keys)]
    if not has_table(spark, f"{path}/keys/_SUCCESS"):
        noted = spark.createDataFrame([(*w, buckets or 0) for w in wanted], "place int, name string, type string, buckets int")
        noted.coalesce(1).write.mode("overwrite").parquet(f"{path}/keys")
        return buckets or 0
    stored = _noted(spark, path)
    if [tuple(r[:3]) for r in stored] != wanted:
        raise ValueError(f"the table is keyed by {stored}, not by {wanted}")
    if buckets is not None and buckets != stored[0][3]:
        raise ValueError(f"the table has {stored[0][3]} buckets, not {buckets}")
    if has_rows(spark, path):
        held = _stored_rows(spark, path, None)
        changed = [f.name for f in held.drop(BUCKET).schema.fields if types.get(f.name, f.dataType.simpleString()) != f.dataType.simpleString()]
        if changed:
            raise ValueError(f"columns with another type than stored: {changed}")
    return stored[0][3]


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, folder: str, keys: list[str], buckets: int) -> None:
    if not buckets:
        rows.write.mode("overwrite").parquet(folder)
        return
    # Dealt by bucket, so that a bucket is one file; rows of a key are distinct, so none is hot.
    dealt = rows.withColumn(BUCKET, _bucket(keys, buckets)).repartition(BUCKET)
    dealt.write.mode("overwrite").partitionBy(BUCKET).parquet(folder)


def _numbers(spark: SparkSession, path: str, before: int | None) -> tuple[int, list[int]]:
    """The latest whole, 0 if there is none, and the parts after it."""
    wholes, parts = (
        [n for n in _committed(spark, path, kind) if before is None or n < before] for kind in ("whole", "part")
    )
    last = wholes[-1] if wholes else 0
    return last, [n for n in parts if n > last]


def _stored_rows(spark: SparkSession, path: str, before: int | None) -> DataFrame:
    """The rows of the latest whole and of the parts after it, with the columns of all of them."""
    last, parts = _numbers(spark, path, before)
    folders = [_folder(path, "whole", last)] * bool(last) + [_folder(path, "part", n) for n in parts]
    if not _noted(spark, path)[0][3]:
        return spark.read.option("mergeSchema", "true").parquet(*folders)
    # Folders with buckets are tables of their own; there are no more than upserts since the last whole.
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [spark.read.parquet(f) for f in folders])


def stored_parts(spark: SparkSession, path: str, before: int | None = None) -> int:
    """How many upserts a table holds that no whole holds."""
    return len(_numbers(spark, path, before)[1])


def has_rows(spark: SparkSession, path: str, before: int | None = None) -> bool:
    """Whether anything is stored, as parts or as a whole."""
    last, parts = _numbers(spark, path, before)
    return bool(last or parts)


def read_table(spark: SparkSession, path: str, before: int | None = None, only: DataFrame | None = None) -> DataFrame:
    """A stored table: per key the row of its last upsert. A column that some upserts lack is NULL in their rows.

    ``before`` leaves out the parts from that number on. The rows of a whole are unique already:
    they are only tested against the keys of the parts that came after it. ``only`` holds the key
    columns: of a table with buckets, only the buckets of these keys are read (their numbers, at
    most the number of buckets, come to the driver); other keys of these buckets may come along.
    """
    noted = _noted(spark, path)
    keys, buckets = [name for _, name, *_ in noted], noted[0][3]
    last, _ = _numbers(spark, path, before)
    rows = _stored_rows(spark, path, before)
    if buckets and only is not None:
        cast = only.select(*[F.col(k).cast(kind).alias(k) for _, k, kind, _ in noted])
        wanted = [r[0] for r in cast.select(_bucket(keys, buckets)).distinct().collect()]
        rows = rows.where(F.col(BUCKET).isin(sorted(wanted)) if wanted else F.lit(False))
    if buckets:
        rows = rows.drop(BUCKET)
    later = rows.where(F.col(PART) > last)
    tasks = later.count() // TASK_ROWS + 1
    if tasks > 1:  # few tasks would be too few for a join with a large whole
        tasks = max(tasks, int(spark.conf.get("spark.sql.shuffle.partitions")))
    fresh = latest_per_key(later, keys, F.col(PART), tasks if tasks > 1 else None)
    return upsert(rows.where(F.col(PART) <= last), fresh, keys).drop(PART)


def upsert_table(
    spark: SparkSession,
    path: str,
    batch: DataFrame,
    keys: list[str] = ROW_KEY,
    order: Column | None = None,
    part: int | None = None,
    buckets: int | None = None,
) -> int:
    """Upsert into a stored table; the batch is computed and written once, stored rows are not touched.

    With ``order``, duplicate keys of the batch keep their highest row, for which the batch is staged;
    without it, they must not occur. ``part`` numbers the upsert, from 1 on (by default the next number); an upsert that is
    repeated under its number replaces what it wrote before, and is refused once a whole holds it.
    ``buckets`` is settled by the first upsert. Returns the number.
    """
    buckets = _check_columns(spark, path, batch, keys, buckets)
    wholes = _committed(spark, path, "whole")
    if part is None:
        part = max([0, *_committed(spark, path, "part"), *wholes]) + 1
    elif wholes and part <= wholes[-1]:
        raise ValueError(f"upsert {part} is part of the whole {wholes[-1]} and can't be repeated")
    folder = _folder(path, "part", part)
    with scratch_scope(spark):
        rows = batch
        if order is not None:
            held = stage(batch.withColumn(PART, order), "batch")
            rows = latest_per_key(held, keys, F.col(PART), held.count() // TASK_ROWS + 1)
        _write(rows.withColumn(PART, F.lit(part).cast("bigint")), folder, keys, buckets)
    return part


def compact_table(spark: SparkSession, path: str, keep: int = 0) -> None:
    """Write the table as one whole and remove what it replaces. Readers that started before must be done.

    ``keep`` leaves that many of the last upserts as they are, so that they can still be repeated. A
    failed run leaves the table as it was.
    """
    whole, parts = _numbers(spark, path, None)
    parts = parts[: len(parts) - keep]
    if not parts:
        return
    noted = _noted(spark, path)
    last = parts[-1]
    rows = read_table(spark, path, last + 1).withColumn(PART, F.lit(last).cast("bigint"))
    _write(rows, _folder(path, "whole", last), [name for _, name, *_ in noted], noted[0][3])
    for n in _committed(spark, path, "part"):
        if n <= last:
            remove(spark, _folder(path, "part", n))
    for n in _committed(spark, path, "whole"):
        if n < last:
            remove(spark, _folder(path, "whole", n))


def clean_invoices(rows: DataFrame, year: int, month: str) -> DataFrame:
    """Invoice lines of a period: amounts without NULL, texts as match keys, period set."""
    amounts = {c: F.coalesce(F.col(c).cast(V.MONEY), F.lit(0).cast(V.MONEY)) for c in
               ("qty", "sales_price", "amount", "open_balance")}
    texts = {c: T.match_key(F.col(c)) for c in ("num", "name", "agent", "memo")}
    period = {"statement_month": F.upper(F.trim(F.lit(month))), "statement_year": F.lit(year)}
    return rows.withColumns({**amounts, **texts, **period})


def replace_period(archive: DataFrame, current: DataFrame, year: int, month: str) -> DataFrame:
    """The archive with one period replaced by the current rows, also where there are none."""
    same = (F.col("statement_year") == year) & (F.col("statement_month") == month.strip().upper())
    kept = archive.where(~F.coalesce(same, F.lit(False)))
    return kept.unionByName(current, allowMissingColumns=True)


# An archive of periods is a folder of numbered writes, ``write=<n>/statement_year=<y>/statement_month=<m>``.
# Of each period the last write counts that Spark has marked as complete: a bulk write has its mark
# at the top, the write of one period in the folder of that period.

PERIOD = ("statement_year", "statement_month")


def _period_folders(spark: SparkSession, path: str) -> dict[tuple[str, str], list[str]]:
    """The finished folders of each period, the last one last."""
    bulk = {m.rpartition("/")[0] for m in glob(spark, f"{path}/write=*/_SUCCESS")}
    each = {m.rpartition("/")[0] for m in glob(spark, f"{path}/write=*/{PERIOD[0]}=*/{PERIOD[1]}=*/_SUCCESS")}
    out: dict[tuple[str, str], list[str]] = {}
    for folder in glob(spark, f"{path}/write=*/{PERIOD[0]}=*/{PERIOD[1]}=*"):
        top, year, month = folder.rsplit("/", 2)
        if top in bulk or folder in each:
            out.setdefault((year, month), []).append(folder)
    return out


def _next_write(spark: SparkSession, path: str) -> str:
    numbers = [int(f.rpartition("=")[2]) for f in glob(spark, f"{path}/write=*")]
    return f"{path}/write={max([0, *numbers]) + 1:012d}"


def write_periods(rows: DataFrame, path: str) -> None:
    """Store rows of any number of periods in place of what is stored for these."""
    spark = rows.sparkSession
    rows.write.partitionBy(*PERIOD).parquet(_next_write(spark, path))
    _remove_replaced(spark, path)


def write_period(rows: DataFrame, path: str, year: int, month: str) -> None:
    """Store the rows of one period in place of what is stored for it, also where there are none.

    Other periods are not touched. The rows are written beside the stored ones, which count until
    the write is complete and are removed then; a run that stops halfway changes nothing.
    """
    spark = rows.sparkSession
    name = month.strip().upper()
    same = (F.col(PERIOD[0]) == year) & (F.upper(F.trim(PERIOD[1])) == name)
    folder = f"{_next_write(spark, path)}/{PERIOD[0]}={year}/{PERIOD[1]}={name}"
    rows.where(same).drop(*PERIOD).write.parquet(folder)
    _remove_replaced(spark, path)


def _remove_replaced(spark: SparkSession, path: str) -> None:
    for folders in _period_folders(spark, path).values():
        for folder in folders[:-1]:
            remove(spark, folder)


def read_periods(spark: SparkSession, path: str) -> DataFrame:
    """All periods of an archive, each from its last complete write."""
    folders = [found[-1] for found in _period_folders(spark, path).values()]
    return spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders).drop("write")


def table_totals(**tables: DataFrame) -> DataFrame:
    """Row count per named table."""
    counts = [df.agg(F.count("*").alias("row_count")).withColumn("table_name", F.lit(n)) for n, df in tables.items()]
    return reduce(DataFrame.unionByName, counts).select("table_name", "row_count")
