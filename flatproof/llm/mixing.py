"""Mixing sources to target weights by systematic sampling.

Every document of a source expects the same number of copies, target over source size. The expected copies are
summed along the source, ordered by size, one random offset is added, and a document is emitted once for each whole
number that its interval crosses. Ordered by size, the sample takes long and short documents in their proportion, so
the words taken come near the target.

A source may hold a third of all rows, and so may one id or null. Rows are therefore ranked inside slices (source,
size, one of 256 slices by a hash of id and text); a table with one row per slice carries the prefix sums. These are made
in two levels: over the bands of 4 sizes of a source, and inside a band, whose slices are bounded in number. The sums
over sources, of which there may be many, run along ranges of them. Only DataFrame operations are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, pack, running_sums, stage, unpack

SIZES_PER_BAND = 4
KEYS = ["_null", "_source", "_size", "_slice"]


def word_count(text: Column) -> Column:
    """Words of a text; a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def offset_of(seed: int, null: Column, source: Column) -> Column:
    """The random offset of a source in [0, 1): a hash of seed and name, the same in every run."""
    name = F.concat(F.lit(f"{seed}:"), F.when(null, F.lit("n:")).otherwise(F.lit("s:")), source)
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def source_targets(bands: DataFrame, weights: list[float], max_copies: float) -> DataFrame:
    """Per source its size and target: shares by weight, none above ``max_copies`` times its size.

    ``bands`` has ``_null, _source, _words``. Sources in order of cap over weight are capped as long as that is
    below the level which the remaining weights give; the level is largest where capping ends, so it is a maximum.
    """
    sources = bands.groupBy("_null", "_source").agg(F.sum("_words").alias("source_size"))
    sources = running_sums(sources, ["_null", "_source"], _place=F.lit(1))
    of_place = F.array(*[F.lit(float(w)) for w in weights])
    sources = sources.withColumn("_weight", F.element_at(of_place, (F.col("_place") % len(weights) + 1).cast("int")))
    sources = sources.withColumn("_cap", F.col("source_size") * F.lit(float(max_copies)))
    sources = sources.withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    sources = running_sums(sources, ["_ratio", "_null", "_source"], _caps=F.col("_cap"), _weights=F.col("_weight"))
    sources = stage(sources, "sources")
    # Two numbers, then one.
    words, all_weights = sources.agg(F.sum("source_size"), F.sum("_weight")).first()
    level = (F.lit(words).cast("long") - F.col("_caps")) / (F.lit(all_weights).cast("double") - F.col("_weights"))
    highest = F.lit(sources.agg(F.max(level)).first()[0]).cast("double")
    target = F.least(F.col("_cap"), highest * F.col("_weight"))
    return sources.select("_null", "_source", "source_size", target.alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    max_copies: int = 3,
    seed: int = 0,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """Each row with ``size, source_size, target, copies, taken``; these replace input columns of the same names.

    Sources in order of code points, null last, take the weights in turn. Null and empty texts have size 0; a source
    without words has target 0 and no copies. Rows of one source and size are in order of a hash of id and text, so reruns
    agree; equal rows share what falls to them. An empty table gives an empty result.
    """
    packed = pack(
        docs,
        _null=F.col(source_col).isNull(),
        _source=F.coalesce(F.col(source_col), F.lit("")),
        _size=word_count(F.col(text_col)),
        _key=F.md5(F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(text_col, F.lit(""))))),
    )
    packed = packed.withColumn("_slice", F.left("_key", F.lit(2)))
    # Written out: it is read for the targets and for both levels of sums, the texts for none of them again.
    slices = stage(packed.groupBy(*KEYS).agg(F.count("*").alias("_rows")), "size-slices")
    band = [*KEYS[:2], "_band"]
    slices = slices.withColumn("_band", F.floor(F.col("_size") / SIZES_PER_BAND))
    bands = slices.groupBy(*band).agg(F.sum("_rows").alias("_rows"), F.sum(F.col("_size") * F.col("_rows")).alias("_words"))
    earlier_bands = Window.partitionBy(*band[:2]).orderBy("_band").rowsBetween(Window.unboundedPreceding, -1)
    band_first = F.coalesce(F.sum("_rows").over(earlier_bands), F.lit(0)).alias("_band_first")
    bands = bands.select(*band, band_first).join(source_targets(bands, list(weights), max_copies), band[:2])
    earlier = Window.partitionBy(*band).orderBy("_size", "_slice").rowsBetween(Window.unboundedPreceding, -1)
    inside_band = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_inside_band")
    placed = slices.select(*KEYS, "_band", inside_band).join(bands, band)
    placed = placed.withColumn("_first", F.col("_band_first") + F.col("_inside_band")).drop("_band")
    inside = F.row_number().over(Window.partitionBy(*KEYS).orderBy("_key"))
    ranked = packed.withColumn("_inside", inside).join(placed, KEYS)
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rank, shift = F.col("_first") + F.col("_inside"), offset_of(seed, F.col("_null"), F.col("_source"))
    crossed = F.floor(each * rank + shift) - F.floor(each * (rank - 1) + shift)
    copies = F.least(crossed, F.lit(max_copies)).cast("long")
    return unpack(
        ranked, docs.columns, size=F.col("_size"), source_size=F.col("source_size"), target=F.col("target"),
        copies=copies, taken=copies * F.col("_size"),
    )


def emit_copies(mixed: DataFrame, copy_col: str = "copy") -> DataFrame:
    """One row per copy, numbered from 1; documents without copies go."""
    return mixed.where(F.col("copies") > 0).withColumn(copy_col, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))


def op10_systematic_mix(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return mix_sources(docs.select("doc_id", "source", "text")).select("doc_id", "size", "source_size", "target", "taken")


OP10_SQL = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS n, coalesce(source, '') AS s,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, 'null') || ':' || md5(coalesce(text, ''))) AS h
  FROM documents),
sources AS (
  SELECT n, s, sum(size)::BIGINT AS source_size,
         ((row_number() OVER (ORDER BY n, s) - 1) % 3 + 1)::DOUBLE AS w
  FROM d GROUP BY n, s),
levels AS (
  SELECT *, source_size * 3.0::DOUBLE AS cap,
         (sum(source_size) OVER () - coalesce(sum(source_size * 3.0::DOUBLE) OVER before, 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources
  WINDOW before AS (ORDER BY source_size * 3.0::DOUBLE / w, n, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT n, s, source_size, least(cap, max(level) OVER () * w) AS target,
         ('0x' || md5('0:' || CASE WHEN n THEN 'n:' ELSE 's:' END || s)[1:8])::BIGINT / 4294967296.0::DOUBLE AS u
  FROM levels),
ranked AS (
  SELECT d.*, source_size, target, u, row_number() OVER (PARTITION BY d.n, d.s ORDER BY size, h) AS r,
         CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS e
  FROM d JOIN targets t ON d.n = t.n AND d.s = t.s)
SELECT doc_id, size, source_size, target,
       (least(floor(e * r + u) - floor(e * (r - 1) + u), 3) * size)::BIGINT AS taken
FROM ranked
"""
