"""What the operators share: tables by name, rows carried past clashing names, written-out intermediate tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path, stage

#: A word is a run of characters outside this class (ASCII white space).
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pack(rows: DataFrame, **columns: Column) -> DataFrame:
    """The row as one struct ``row`` beside working columns, so that no input name can clash with them."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("row")
    return rows.select(whole, *[c.alias(n) for n, c in columns.items()])


def unpack(packed: DataFrame, columns: Iterable[str], **computed: Column) -> DataFrame:
    """The input columns again, with computed ones; a computed column replaces an input column of its name."""
    kept = [F.col("row").getField(c).alias(c) for c in columns if c not in computed]
    return packed.select(*kept, *[c.alias(n) for n, c in computed.items()])


def groups_of(sizes: Iterable[int], limit: int) -> Iterator[slice]:
    """Slices of consecutive items of about ``limit`` in total; an item above the limit stands alone."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if i >= start:
        yield slice(start, i + 1)


def running_sums(rows: DataFrame, order: list[str], **sums: Column) -> DataFrame:
    """The rows with the sum of each expression over all earlier rows in ``order``, whose values are distinct.

    The rows are cut into ranges; sums run inside each range and over the table of ranges, one row each.
    """
    cut = stage(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranges")
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranges = cut.groupBy("_range").agg(*[F.sum(c).alias(f"_of_{n}") for n, c in sums.items()])
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    ranges = ranges.select("_range", *[F.sum(f"_of_{n}").over(earlier).alias(f"_to_{n}") for n in sums])
    joined = cut.join(F.broadcast(ranges), "_range")
    zero = F.lit(0)
    added = {n: F.coalesce(F.col(f"_to_{n}"), zero) + F.coalesce(F.sum(c).over(inside), zero) for n, c in sums.items()}
    return joined.select(*rows.columns, *[c.alias(n) for n, c in added.items()])


def map_texts(
    rows: DataFrame,
    text_col: str,
    computed: str,
    prepare: Callable[[], Callable[[list[bytes]], list[pa.Array]]],
    keep: list[str] | None = None,
    block_bytes: int = 4 << 20,
) -> DataFrame:
    """The columns ``keep`` (all by default) and those of the schema text ``computed``, made from the texts.

    ``prepare`` runs once per task and gives a function from some texts, as UTF-8 with null as empty, to one array per
    computed column. It gets about ``block_bytes`` of texts at a time; a longer text comes alone. A computed column
    replaces an input column of its name.
    """
    fields = T._parse_datatype_string(computed).fields
    names = {f.name for f in fields}
    kept = [c for c in (rows.columns if keep is None else keep) if c not in names]
    schema = T.StructType([*[rows.schema[c] for c in kept], *fields])
    place = len(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for batch in batches:
            texts = [t or b"" for t in batch.column(place).cast(pa.binary()).to_pylist()]
            for part in groups_of(map(len, texts), block_bytes):
                own = [batch.column(i).slice(part.start, part.stop - part.start) for i in range(place)]
                yield pa.RecordBatch.from_arrays([*own, *compute(texts[part])], names=schema.names)

    # Plain names on the way, so that no input name can clash or hold a dot.
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(kept)]
    return rows.select(*own, F.col(f"`{text_col}`").alias("text")).mapInArrow(run, schema)
