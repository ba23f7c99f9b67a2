"""SimHash near-duplicates by multi-index hashing.

Fingerprints are cut into segments. If two fingerprints differ in at most ``max_bits`` bits, one of ``m`` segments
differs in at most ``max_bits // m``. Every fingerprint therefore stands in one table per segment, looks up all values
in the small Hamming ball around each of its own segments, and keeps the matches whose whole distance is small enough.
Links join into groups by connected components.

Look-ups run on distinct fingerprints, so copies cost nothing; both sides of the look-up join are plain shuffles, so
adaptive execution can split a frequent segment value.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups_of, pack, stage
from .graph import connected_components

HASH_SEED = 42
BLOCK_BYTES = 4 << 20
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: bytes, shingle: int) -> bytes:
    """XXH64 of all runs of ``shingle`` words (of the whole sequence if it is shorter), 8 bytes each, big-endian."""
    words = text.lower().split()
    if not words:
        return b""
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    n = max(1, len(words) - shingle + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[-n:].tolist()
    digest = xxhash.xxh64_digest
    return b"".join([digest(joined[a:b], HASH_SEED) for a, b in zip(starts, stops)])


def fingerprints(texts: list[bytes], shingle: int) -> np.ndarray:
    """One fingerprint per text: a bit is set if it is set in more than half of the hashes; zero without words.

    Bits are counted eight at a time in the bytes of 64-bit sums over at most 255 hashes.
    """
    parts = [shingle_hashes(t, shingle) for t in texts]
    sizes = np.fromiter((len(p) // 8 for p in parts), np.int64, len(parts))
    out = np.zeros(len(texts), np.uint64)
    full = np.flatnonzero(sizes)
    if not len(full):
        return out
    hashes = np.frombuffer(b"".join(parts), ">u8").astype(np.uint64)
    counts = sizes[full]
    firsts = np.cumsum(counts) - counts
    pieces = -(-counts // 255)
    owner_first = np.cumsum(pieces) - pieces
    inside = np.arange(pieces.sum()) - np.repeat(owner_first, pieces)
    cuts = np.repeat(firsts, pieces) + 255 * inside
    for bit in range(8):
        lanes = np.add.reduceat((hashes >> np.uint64(bit)) & _LANES, cuts)
        by_lane = lanes.astype("<u8").view(np.uint8).reshape(-1, 8).astype(np.int64)
        sums = np.add.reduceat(by_lane, owner_first, axis=0)
        set_bits = sums * 2 > counts[:, None]
        for lane in range(8):
            out[full] |= set_bits[:, lane].astype(np.uint64) << np.uint64(8 * lane + bit)
    return out


def fingerprint_table(docs: DataFrame, id_col: str, text_col: str, shingle: int, with_hash: bool = False) -> DataFrame:
    """(doc_id, fp) for every row, and before fp the text's 64-bit ``tie`` if ``with_hash``."""
    own = {"doc_id": F.col(id_col)} | ({"tie": F.xxhash64(text_col)} if with_hash else {})
    narrow = docs.select(*[c.alias(n) for n, c in own.items()], F.col(text_col).cast("binary").alias("text"))
    names = list(own)
    schema = T.StructType([*[narrow.schema[n] for n in names], T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or b"" for t in batch.column("text").to_pylist()]
            for part in groups_of(map(len, texts), BLOCK_BYTES):
                found = fingerprints(texts[part], shingle).view(np.int64)
                kept = [batch.column(n).slice(part.start, part.stop - part.start) for n in names]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(found)], names=[*names, "fp"])

    return narrow.mapInArrow(run, schema)


def segments_of(bits: int, m: int) -> list[tuple[int, int]]:
    """(shift, width) of ``m`` nearly equal segments."""
    widths = [bits // m + (i < bits % m) for i in range(m)]
    return [(sum(widths[:i]), w) for i, w in enumerate(widths)]


def ball(width: int, radius: int) -> list[int]:
    """All masks of ``width`` bits with at most ``radius`` set."""
    return [sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(width), r)]


def near_links(distinct: DataFrame, max_bits: int, m: int) -> DataFrame:
    """(u, v): all pairs of distinct fingerprints ``fp`` that differ in at most ``max_bits`` bits; u < v."""
    cut = segments_of(64, m)

    def slot(i: int, shift: int, width: int, masks: list[int]):
        value = F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit((1 << width) - 1))
        return [F.struct(F.lit(i).alias("seg"), value.bitwiseXOR(F.lit(x)).alias("val")) for x in masks]

    def spread(masks_of) -> DataFrame:
        slots = F.array(*[s for i, (a, w) in enumerate(cut) for s in slot(i, a, w, masks_of(w))])
        return distinct.select("fp", F.explode(slots).alias("s")).select("fp", "s.seg", "s.val")

    held = spread(lambda w: [0]).withColumnRenamed("fp", "v")
    asked = spread(lambda w: ball(w, max_bits // m)).withColumnRenamed("fp", "u")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    return asked.join(held, ["seg", "val"]).where((F.col("u") < F.col("v")) & close).select("u", "v").distinct()


def near_duplicates(
    docs: DataFrame,
    shingle: int = 4,
    max_bits: int = 4,
    segments: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, fp, component_id`` for every row; component_id is the smallest id that links reach.

    Texts without words (null, empty, white space) have fingerprint zero and form one group, with whatever lies near
    zero. Ids that are null take part in groups but are never a group's id; a group of such rows has a null id.
    Repeated rows stay. ``segments`` sets the width of the tables: three segments of 21 bits suit up to some 10^8
    distinct fingerprints, two of 32 bits more.
    """
    fps = stage(fingerprint_table(docs, id_col, text_col, shingle), "fingerprints")
    least = stage(fps.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-fingerprints")
    parts = stage(connected_components(near_links(least.select("fp"), max_bits, segments)), "components")
    rooted = parts.join(least, parts["node"] == least["fp"]).select("fp", "root", "least_id")
    groups = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = stage(rooted.join(groups, "root").select("fp", "component_id"), "groups")
    alone = least.join(linked.select("fp"), "fp", "left_anti").select("fp", F.col("least_id").alias("component_id"))
    named = stage(linked.unionByName(alone), "named-groups")
    return fps.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_first_of_groups(
    docs: DataFrame, shingle: int = 4, max_bits: int = 4, segments: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row of each group: the first by id (null last) and hash of the text.

    Groups are told apart by their fingerprints and not by their ids, so rows of one id with unrelated texts, or
    without an id, stand for their own groups. Of rows equal in id and text the least by its other columns stays.
    """
    fps = stage(fingerprint_table(docs, id_col, text_col, shingle, with_hash=True), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "tie")).alias("first")
    heads = stage(fps.groupBy("fp").agg(first), "distinct-fingerprints")
    parts = stage(connected_components(near_links(heads.select("fp"), max_bits, segments)), "components")
    linked = heads.join(parts, heads["fp"] == parts["node"]).groupBy("root").agg(F.min("first").alias("first"))
    alone = heads.join(parts, heads["fp"] == parts["node"], "left_anti")
    # Structs are equal where both sides hold nulls.
    key = F.struct("first.doc_id", "first.tie").alias("kept")
    kept = stage(linked.select(key).unionByName(alone.select(key)).distinct(), "kept")
    packed = pack(docs, key=F.struct(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tie")))
    firsts = packed.join(kept, packed["key"] == kept["kept"], "left_semi")
    # Equal rows are reduced before they are dealt.
    return firsts.groupBy("key").agg(F.min("row").alias("row")).select("row.*")


def op6_simhash(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = near_duplicates(docs)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
