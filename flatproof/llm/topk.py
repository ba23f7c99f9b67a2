"""Exact k nearest binary codes by Hamming distance, by incremental multi-index hashing.

Codes of up to 64 bits are cut into ``m`` segments, with one table per segment. A query looks up the values at distance
``r`` from its own, segment after segment, for ``r`` = 0, 1, 2 and so on. Once the first ``j`` segments have been
searched to radius ``r`` and the others to ``r - 1``, a code not yet seen differs by at least ``m * r + j`` bits. A
query is done when its k-th verified distance is smaller than that; there is no other stop.

Codes and queries are dealt into blocks of bounded size. A task builds the tables of one block of codes, answers one
block of queries from them, and a last window takes the first ``k`` of the blocks' answers. Work runs on distinct
codes on both sides: equal queries have equal answers, and of equal codes only the ``k`` smallest ids can be among the
first ``k``, since ties go to the smaller id. Copies of a code therefore cost nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import ceil, log2

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage
from .simhash import segments_of

#: Distinct codes, and distinct queries, of one task.
CODE_BLOCK, QUERY_BLOCK, LEAST_QUERIES = 1 << 17, 1 << 14, 128
#: Candidates that a task verifies at once.
CANDIDATES = 1 << 21


def sign_code(vector: Column) -> Column:
    """A bit per dimension, set where the value is positive; the first dimension is the lowest bit. Null for a null
    vector, an error above 64 dimensions. A null or NaN value counts as not positive."""
    def bit(x: Column, i: Column) -> Column:
        positive = F.coalesce((x > 0) & ~F.isnan(x), F.lit(False))
        return F.when(positive, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))

    bits = F.transform(vector, bit)
    code = F.aggregate(bits, F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))
    return F.when(F.size(vector) > 64, F.raise_error(F.lit("codes have up to 64 bits")).cast("long")).otherwise(code)


def smallest_ids(codes: DataFrame, k: int) -> DataFrame:
    """(code, ids): the up to ``k`` smallest ids of each code. Reduced twice, so that no task sees all rows of a code:
    first within 64 slices of a code, then over at most ``64 * k`` ids."""
    slices = codes.withColumn("slice", F.pmod(F.xxhash64("id"), F.lit(64)))
    first = Window.partitionBy("code", "slice").orderBy("id")
    kept = slices.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k)
    ids = F.slice(F.sort_array(F.collect_list("id")), 1, k)
    return kept.groupBy("code").agg(ids.alias("ids"))


class SegmentTable:
    """The codes by the value of one segment: a start per value, and the places of the codes in order of value."""

    def __init__(self, codes: np.ndarray, shift: int, width: int):
        self.shift, self.width = np.uint64(shift), width
        values = self.of(codes)
        self.places = np.argsort(values, kind="stable")
        self.starts = np.searchsorted(values[self.places], np.arange((1 << width) + 1, dtype=np.uint64))

    def of(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> self.shift) & np.uint64((1 << self.width) - 1)

    def look_up(self, queries: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place of query, place of code) of all codes whose segment differs from the query's in ``radius`` bits."""
        masks = [sum(1 << b for b in c) for c in combinations(range(self.width), radius)]
        own = self.of(queries)
        step = max(1, CANDIDATES // max(1, len(queries)))
        for i in range(0, len(masks), step):
            values = own[:, None] ^ np.array(masks[i : i + step], np.uint64)[None, :]
            first, last = self.starts[values].ravel(), self.starts[values + np.uint64(1)].ravel()
            counts = last - first
            owner = np.repeat(np.arange(values.size) // values.shape[1], counts)
            inside = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
            yield owner, self.places[np.repeat(first, counts) + inside]


def _kept(best: tuple, found: tuple, k: int, weights: np.ndarray) -> tuple:
    """The nearest codes of each query, as (query, distance, code): all up to the distance at which ``k`` ids are
    reached. ``weights`` has the number of ids behind each code."""
    query, distance, code = (np.concatenate(x) for x in zip(best, found))
    key = np.unique((query << 40) | (distance << 32) | code)
    query, distance, code = key >> 40, (key >> 32) & 0xFF, key & 0xFFFFFFFF
    total = np.cumsum(weights[code])
    new_query = np.r_[True, query[1:] != query[:-1]] if len(key) else np.zeros(0, bool)
    before_query = np.repeat((total - weights[code])[new_query], np.diff(np.r_[np.flatnonzero(new_query), len(key)]))
    level = np.r_[True, key[1:] >> 32 != key[:-1] >> 32] if len(key) else np.zeros(0, bool)
    lengths = np.diff(np.r_[np.flatnonzero(level), len(key)])
    before_level = np.repeat((total - weights[code])[level], lengths)
    stays = before_level - before_query < k
    return query[stays], distance[stays], code[stays]


def search_block(codes: np.ndarray, weights: np.ndarray, queries: np.ndarray, k: int, bits: int) -> tuple:
    """(place of query, distance, place of code): for each query all codes that can hold its first ``k`` ids."""
    m = max(1, min(bits, round(bits / max(1.0, log2(max(len(codes), 2))))))
    tables = [SegmentTable(codes, shift, min(width, 24)) for shift, width in segments_of(bits, m)]
    best = tuple(np.zeros(0, np.int64) for _ in range(3))
    open_places = np.arange(len(queries))
    for radius in range(max(t.width for t in tables) + 1):
        for j, segment in enumerate(tables):
            for owner, place in segment.look_up(queries[open_places], radius):
                query = open_places[owner]
                distance = np.bitwise_count(queries[query] ^ codes[place]).astype(np.int64)
                best = _kept(best, (query, distance, place), k, weights)
            held = np.bincount(best[0], weights[best[2]], len(queries))
            last = np.zeros(len(queries), np.int64)
            np.maximum.at(last, best[0], best[1])
            covered = (held >= k) & (last < m * radius + j + 1)
            open_places = open_places[~covered[open_places]]
            if not len(open_places):
                return best
    return best


def nearest_codes(
    codes: DataFrame,
    queries: DataFrame,
    k: int = 10,
    bits: int = 64,
    code_block: int = CODE_BLOCK,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """``query_id, place, id, distance``: the first ``k`` codes of each query by distance and id.

    ``codes`` and ``queries`` have ``id`` and ``code`` (long, lowest ``bits`` bits). Rows with a null id or code are left
    out on both sides. A query that is among the codes finds itself. With fewer than ``k`` codes all are returned.
    Repeated (id, code) rows count each. Inside a block the number of segments is the bits over the binary logarithm
    of its codes, at which a segment value holds about one code.
    """
    codes = codes.select("id", "code").where("id is not null and code is not null")
    queries = queries.select("id", "code").where("id is not null and code is not null")
    held = stage(smallest_ids(codes, k), "codes")
    wanted = stage(queries.select("code").distinct(), "queries")
    codes_held, queries_held = held.count(), wanted.count()
    code_blocks = ceil(codes_held / code_block) or 1
    # As many blocks as there are partitions, where there are queries for them; a block answers alike at any size.
    spread = ceil(int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions")) / code_blocks)
    query_blocks = max(ceil(queries_held / query_block), min(spread, ceil(queries_held / LEAST_QUERIES))) or 1
    dealt = lambda blocks: F.pmod(F.xxhash64("code"), F.lit(blocks)).cast("int")
    every = lambda blocks: F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    left = held.select(dealt(code_blocks).alias("c"), every(query_blocks).alias("q"), "code", F.size("ids").alias("n"))
    right = wanted.select(every(code_blocks).alias("c"), dealt(query_blocks).alias("q"), "code")

    def run(code_rows: pa.Table, query_rows: pa.Table) -> pa.Table:
        code = code_rows.column("code").to_numpy().view(np.uint64)
        query = query_rows.column("code").to_numpy().view(np.uint64)
        places, distance, found = np.zeros((3, 0), np.int64)
        if len(code) and len(query):
            weights = code_rows.column("n").to_numpy().astype(np.int64)
            places, distance, found = search_block(code, weights, query, k, bits)
        return pa.table({
            "query": query.view(np.int64)[places], "code": code.view(np.int64)[found], "distance": distance.astype(np.int32),
        })

    near = left.groupBy("c", "q").cogroup(right.groupBy("c", "q")).applyInArrow(run, "query long, code long, distance int")
    listed = near.join(held, "code").select("query", "distance", F.explode("ids").alias("id"))
    order = Window.partitionBy("query").orderBy("distance", "id")
    ranked = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)
    # A written table, so that the join has two plain shuffles and a frequent query code can be split.
    ranked = stage(ranked, "ranked")
    asked = queries.withColumnRenamed("id", "query_id")
    return asked.join(ranked, asked["code"] == ranked["query"]).select("query_id", "place", "id", "distance")


def op9_binary_topk(spark, sf_dir):
    """Codes are the signs of the embeddings; queries are the rows whose id is divisible by 20."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    codes = vectors.select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    return nearest_codes(codes, codes.where(F.col("id") % 20 == 0))


OP9_SQL = """
WITH c AS (SELECT vec_id AS id, list_transform(embedding, lambda x: x > 0) AS code FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
pairs AS (
  SELECT q.id AS query_id, c.id,
         len(list_filter(list_zip(q.code, c.code), lambda p: p[1] <> p[2]))::INT AS distance
  FROM c AS q, c WHERE q.id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY distance, id)::INT AS place FROM pairs)
SELECT query_id, place, id, distance FROM ranked WHERE place <= 10
"""
