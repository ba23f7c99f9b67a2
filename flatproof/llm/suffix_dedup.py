"""Removal of repeated byte strings by longest previous factors.

A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or
earlier in the same one. Candidate stretches meet as :mod:`.repeats` describes. There, the stretches of a key stand one
after the other in order of address, with separators, in a suffix array. For every suffix the previous and the next
one in suffix order that starts earlier are found; the longest previous factor is the longer of the common prefixes
with these two, and the window is a repeat if that reaches ``length``. Suffixes are sorted, and factors measured, up
to that length.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repeats import Covered, Plan, mixed, repeated_windows
from .suffixes import previous_smaller, suffix_array

GRAM = 24


def byte_symbols() -> Callable[[bytes], np.ndarray]:
    table = mixed(np.arange(1, 257, dtype=np.uint64))
    return lambda text: table[np.frombuffer(text, np.uint8)]


def cut_bytes() -> Callable:
    return lambda text, starts, stops: [text[a:b] for a, b in zip(starts, stops)]


def reaching_factors(symbols: np.ndarray, bits: int, length: int) -> np.ndarray:
    """For each position whether its longest previous factor has at least ``length`` symbols."""
    sa, rank = suffix_array(symbols, bits, length)
    order = sa.astype(np.int64)
    group = rank[order].astype(np.int64)
    # Only suffixes that share ``length`` symbols with a neighbour in suffix order can have such a factor.
    near = np.zeros(len(order), bool)
    near[1:] = group[1:] == group[:-1]
    near[:-1] |= near[1:]
    order, group = order[near], group[near]
    before = previous_smaller(order)
    after = len(order) - 1 - previous_smaller(order[::-1])[::-1]
    reaches = (before >= 0) & (group[before] == group)
    reaches |= (after < len(order)) & (group[np.minimum(after, len(order) - 1)] == group)
    out = np.zeros(len(symbols), bool)
    out[order[reaches]] = True
    return out


def compare_bytes(segments: list[bytes], rows: dict[str, np.ndarray], plan: Plan) -> tuple:
    sizes = np.array([len(s) for s in segments], np.int64)
    ends = np.cumsum(sizes + 1)
    symbols = np.zeros(int(ends[-1]), np.uint64)
    inside = np.ones(len(symbols), bool)
    inside[ends - 1] = False
    symbols[inside] = np.frombuffer(b"".join(segments), np.uint8).astype(np.uint64) + np.uint64(1)
    reaches = reaching_factors(symbols, 9, plan.length)
    # A string with a separator in it is no window.
    starts = ends - sizes - 1
    hits = np.flatnonzero(reaches)
    row = np.searchsorted(ends, hits, side="right")
    first = hits - starts[row]
    real = first < rows["count"][row]
    row, first = row[real], first[real]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(fresh)
    return row[begin], first[begin], np.diff(np.r_[begin, len(row)])


def remove_repeated_bytes(
    docs: DataFrame, length: int = 100, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, spans, kept``, one row per document.

    ``spans`` are the removed byte ranges, ``kept`` the remaining bytes, which may cut a character. Null and empty
    texts have no bytes. Rows with a null id come last in order. Rows that are equal in id and text are one document,
    and both get its row; different texts of one id are in order of a hash. Ids must be integers.
    """
    plan = Plan(length, min(GRAM, length - 1), True, byte_symbols)
    found = repeated_windows(docs, plan, cut_bytes, compare_bytes, id_col, text_col)
    id_type = docs.schema[id_col].dataType
    schema = T._parse_datatype_string(
        "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,stop:long>>, kept binary"
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            covered = Covered(batch, length)
            spans = [covered.ranges(i, len(t)) for i, t in enumerate(texts)]
            kept = []
            for text, cuts in zip(texts, spans):
                edges = [0, *[x for c in cuts for x in c], len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])) if cuts else text)
            removed = [len(t) - len(k) for t, k in zip(texts, kept)]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(map(len, texts), pa.int64()), pa.array(removed, pa.int64()),
                pa.array(map(len, spans), pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kind), pa.array(kept, pa.binary()),
            ], names=schema.names)

    out = found.select(F.when(~F.col("none"), F.col("id")).alias("id"), "text", "windows").mapInArrow(run, schema)
    return out.select(F.col("id").cast(id_type).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "spans", "kept")


def op4_suffix_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = remove_repeated_bytes(docs)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
pieces AS (
  SELECT doc_id, a, h[2 * a + 1 : 2 * a + 1198] AS p
  FROM (SELECT *, unnest(range(0, len(h) // 2 - 99, 500)) AS a FROM d WHERE len(h) >= 200)),
w AS (
  SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) > 1 AS again
  FROM (SELECT doc_id, a + j AS i, md5(p[2 * j + 1 : 2 * j + 200]) AS win
        FROM (SELECT *, unnest(range(0, least(500, len(p) // 2 - 99))) AS j FROM pieces))),
marks AS (
  SELECT doc_id, i, sum(step) AS step FROM (
    SELECT doc_id, i, 1 AS step FROM w WHERE again UNION ALL SELECT doc_id, i + 100, -1 FROM w WHERE again)
  GROUP BY doc_id, i),
levels AS (
  SELECT doc_id, i, level, coalesce(lag(level) OVER o, 0) AS before FROM (
    SELECT *, sum(step) OVER (PARTITION BY doc_id ORDER BY i) AS level FROM marks) WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
edges AS (
  SELECT doc_id, list(i ORDER BY i) FILTER (level > 0 AND before = 0) AS a, list(i ORDER BY i) FILTER (level = 0) AS b
  FROM levels GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, len(h) // 2 AS n_bytes, coalesce(len(a), 0) AS n_spans,
         CASE WHEN a IS NULL THEN h ELSE h[1 : 2 * a[1]] || array_to_string(
           list_transform(range(1, len(a) + 1), lambda j: h[2 * b[j] + 1 : CASE WHEN j < len(a) THEN 2 * a[j + 1] ELSE len(h) END]), '')
         END AS k
  FROM d LEFT JOIN edges e ON d.doc_id = e.doc_id)
SELECT doc_id, n_bytes::BIGINT AS n_bytes, (n_bytes - len(k) // 2)::BIGINT AS n_removed, n_spans::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256
FROM kept
"""
