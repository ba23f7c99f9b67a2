"""Benchmark decontamination by an FM-index per training shard.

Texts are lower-cased and cut into words; an item is searched by all its windows of consecutive words. The documents
of a task form shards of some megabytes. The words of a shard become symbols; words that no item has are one separator
symbol, and a run of separators is stored once. Each shard gets a suffix array, its Burrows-Wheeler transform in a
wavelet tree, and every 16th suffix position. All windows of the benchmark are searched backwards at once; occurrences
are walked to the next sampled position, and the words they cover are merged into spans per document.

Documents do not move; the benchmark goes to them in blocks of bounded size, one after the other, each pass adding to
the spans found before. A text longer than a shard is cut into pieces that overlap by a window less one word.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups_of, map_texts, running_sums, stage
from .suffixes import suffix_array

SHARD_BYTES = 4 << 20
#: Symbols of a piece of a long text.
PIECE = 1 << 20
SAMPLE = 16
#: Bytes of benchmark texts and ids that are sent to the tasks at once, of a piece of a long text, and ids of a piece.
BENCHMARK_BYTES, PIECE_BYTES, NAMES = 8 << 20, 4 << 20, 4096

#: A word is a run of characters outside this class, after A-Z have been lower-cased.
NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_TO_WORDS = bytes(32 if re.match(NO_WORD.encode(), bytes([c])) else c for c in range(256))
_TRANSLATE = bytes(_TO_WORDS[_LOWER[c]] for c in range(256))
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TRANSLATE).split()


def word_ranges(text: bytes) -> list[tuple[int, int]]:
    """Byte range of each word."""
    return [m.span() for m in _WORD.finditer(text.translate(_TRANSLATE))]


class WaveletTree:
    """A sequence of symbols by the bits of the symbols, level by level, with rank on every level."""

    def __init__(self, symbols: np.ndarray, levels: int, sigma: int):
        self.levels, self.words, self.before, self.zeros = levels, [], [], []
        present = symbols
        for level in range(levels - 1, -1, -1):
            bit = ((present >> level) & 1).astype(bool)
            padded = np.zeros((len(bit) // 64 + 1) * 64, bool)
            padded[: len(bit)] = bit
            word = np.packbits(padded, bitorder="little").view(np.uint64)
            self.words.append(word)
            self.before.append(np.r_[0, np.cumsum(np.bitwise_count(word))].astype(np.int64))
            self.zeros.append(int(len(bit) - bit.sum()))
            present = np.concatenate([present[~bit], present[bit]])
        every = np.arange(sigma)
        self.starts = self._down(every, np.zeros(sigma, np.int64))

    def _ones(self, level: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[level][word] + np.bitwise_count(self.words[level][word] & below)

    def _down(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            ones = self._ones(i, at)
            bit = (symbols >> (self.levels - 1 - i)) & 1
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before its place."""
        return self._down(symbols, at) - self.starts[symbols]

    def symbol_and_rank(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The symbol at each place, and how often it stands before it."""
        symbol = np.zeros(len(at), np.int64)
        for i in range(self.levels):
            ones = self._ones(i, at)
            bit = ((self.words[i][at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(np.int64)
            symbol = (symbol << 1) | bit
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return symbol, at - self.starts[symbol]


class FMIndex:
    """Search in a sequence of symbols 1 to ``sigma - 1``; 0 separates and is never searched for."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        # All symbols one higher, and an end below all others that stands before the first suffix.
        sigma, symbols = sigma + 1, np.r_[symbols + 1, 0]
        levels = (sigma - 1).bit_length()
        sa, _ = suffix_array(symbols, levels)
        sa = sa.astype(np.int64)
        self.size = len(symbols)
        self.tree = WaveletTree(symbols[sa - 1], levels, sigma)
        self.below = np.r_[0, np.cumsum(np.bincount(symbols, minlength=sigma))]
        sampled = sa % SAMPLE == 0
        self.is_sampled = sampled
        self.sample_rank = np.cumsum(sampled) - sampled
        self.samples = sa[sampled]

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First and last row (exclusive) of the suffixes that start with each pattern, a row of ``patterns`` that is
        filled from the right."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.size)
        for i in range(patterns.shape[1]):
            todo = np.flatnonzero((lengths > i) & (low < high))
            symbol = patterns[todo, -1 - i].astype(np.int64) + 1
            low[todo] = self.below[symbol] + self.tree.rank(symbol, low[todo])
            high[todo] = self.below[symbol] + self.tree.rank(symbol, high[todo])
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The position of the suffix in each row."""
        out, todo, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), 0
        at = rows
        while len(todo):
            hit = self.is_sampled[at]
            out[todo[hit]] = self.samples[self.sample_rank[at[hit]]] + steps
            todo, at, steps = todo[~hit], at[~hit], steps + 1
            symbol, rank = self.tree.symbol_and_rank(at)
            at = self.below[symbol] + rank
        return out


def _distinct(column: Callable[[int], np.ndarray], width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """An order in which equal rows stand together, and which rows in it are the first of their kind. ``column`` makes
    one column of the rows at a time."""
    key = np.zeros(size, np.uint64)
    for i in range(width):
        key = (key ^ column(i).astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    same = key[1:] == key[:-1]

    def equal(order: np.ndarray) -> np.ndarray:
        out = np.ones(max(0, size - 1), bool)
        for i in range(width):
            of = column(i)[order]
            out &= of[1:] == of[:-1]
        return out

    found = equal(order)
    if (same & ~found).any():  # two different rows share a hash
        order = np.lexsort([column(i) for i in range(width)]).astype(np.int32)
        found = equal(order)
    return order, np.r_[np.ones(min(1, size), bool), ~found]


class Windows:
    """The distinct windows of some items, as rows of symbols filled from the right, and the items that have each.

    ``items`` are names and texts; an item with several names counts for all of them. Everything is arrays, so a block
    of items takes a few times its own size, and the vocabulary.
    """

    def __init__(self, items: list[tuple[list[str], bytes]], window: int):
        self.window, self.vocabulary, parts = window, {}, []
        for _, text in items:
            symbols = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            parts.append(np.array(symbols, np.int32))
        self.names = [names for names, _ in items]
        sizes = np.array([len(p) for p in parts], np.int32)
        width = np.minimum(sizes, window)
        count = np.where(sizes > 0, sizes - width + 1, 0)
        owner = np.repeat(np.arange(len(parts), dtype=np.int32), count)
        before = (np.cumsum(sizes) - sizes + width - (np.cumsum(count) - count)).astype(np.int32)
        ends = before[owner] + np.arange(len(owner), dtype=np.int32)
        # One more symbol in front, which short windows are filled with; it is no word.
        joined = np.concatenate([np.zeros(1, np.int32), *parts])
        lengths = width[owner]

        def symbol(i: int, of: slice | np.ndarray = slice(None)) -> np.ndarray:
            return joined[np.where(i < lengths[of], ends[of] - np.int32(i), 0)]

        order, first = _distinct(symbol, window, len(owner))
        chosen = order[first]
        self.lengths = lengths[chosen].astype(np.int64)
        self.patterns = np.zeros((len(chosen), window), np.int32)
        for i in range(window):
            self.patterns[:, -1 - i] = symbol(i, chosen)
        # The owners of a window, each once.
        pairs = (np.cumsum(first) - 1) * len(parts)
        pairs += owner[order]
        pairs = np.unique(pairs)
        self.owners = (pairs % max(1, len(parts))).astype(np.int32)
        self.bounds = np.searchsorted(pairs // max(1, len(parts)), np.arange(len(self.lengths) + 1))

    def items_of(self, pattern: int) -> list[str]:
        return [n for o in self.owners[self.bounds[pattern] : self.bounds[pattern + 1]].tolist() for n in self.names[o]]

    def find(self, sequences: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(sequence, first word, pattern) of all occurrences in the sequences of symbols."""
        ends = np.cumsum([len(s) + 1 for s in sequences])
        joined = np.zeros(ends[-1] if len(ends) else 0, np.int64)
        for s, end in zip(sequences, ends):
            joined[end - 1 - len(s) : end - 1] = s
        stored = np.flatnonzero((joined > 0) | np.r_[True, joined[:-1] > 0]) if len(joined) else joined
        if not len(self.lengths) or not joined.any():
            return (np.zeros(0, np.int64),) * 3
        index = FMIndex(joined[stored], len(self.vocabulary) + 1)
        low, high = index.search(self.patterns, self.lengths)
        counts = high - low
        pattern = np.repeat(np.arange(len(counts)), counts)
        inside = np.arange(len(pattern)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = stored[index.locate(np.repeat(low, counts) + inside)]
        sequence = np.searchsorted(ends, at, side="right")
        return sequence, at - np.r_[0, ends[:-1]][sequence], pattern

    def hits(self, texts: list[bytes]) -> tuple[list[int], list[list[tuple[int, int]]], list[list[str]]]:
        """Per text: words, merged spans of hit words, and items with occurring windows."""
        get = self.vocabulary.get
        words = [np.array([get(w, 0) for w in words_of(t)], np.int64) for t in texts]
        step = PIECE - self.window + 1
        pieces = [(i, a) for i, w in enumerate(words) for a in range(0, max(1, len(w) - self.window + 1), step)]
        spans: list[list] = [[] for _ in texts]
        items: list[set] = [set() for _ in texts]
        for part in groups_of([min(PIECE, len(words[i]) - a) for i, a in pieces], PIECE):
            chosen = pieces[part]
            sequence, first, pattern = self.find([words[i][a : a + PIECE] for i, a in chosen])
            for s, f, p in zip(sequence.tolist(), first.tolist(), pattern.tolist()):
                i, a = chosen[s]
                spans[i].append((a + f, a + f + int(self.lengths[p])))
                items[i].update(self.items_of(p))
        return [len(w) for w in words], [merge_spans(s) for s in spans], [sorted(x) for x in items]


def merge_spans(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping and touching spans as one, in order."""
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(stop, out[-1][1]))
        else:
            out.append((start, stop))
    return out


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def _cut_items(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """``names, text``: every distinct text with its ids, at most some thousands in a row, long texts cut into pieces
    that overlap by a window less one word. A null id is ``null``."""
    items = benchmark.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"), F.col(text_col).alias("text")
    ).where("text is not null")
    sizes = items.groupBy("text").agg((F.floor(F.count("*") / NAMES) + 1).alias("parts"))
    dealt = items.join(sizes, "text").withColumn("part", F.pmod(F.xxhash64("name"), F.col("parts")))
    grouped = dealt.groupBy("text", "part").agg(F.sort_array(F.collect_set("name")).alias("names"))

    def cut(batches):
        for batch in batches:
            names, texts = [], []
            for own, text in zip(batch.column("names").to_pylist(), batch.column("text").to_pylist()):
                data = text.encode()
                ranges = word_ranges(data) if len(data) > PIECE_BYTES else []
                if len(ranges) <= window:
                    names.append(own)
                    texts.append(data)
                    continue
                step = max(window, len(ranges) * PIECE_BYTES // len(data))
                for a in range(0, len(ranges) - window + 1, step):
                    stop = min(len(ranges), a + step + window - 1)
                    names.append(own)
                    texts.append(data[ranges[a][0] : ranges[stop - 1][1]])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.list_(pa.string())), pa.array(texts, pa.binary())], names=["names", "text"])

    return grouped.select("names", "text").mapInArrow(cut, "names array<string>, text binary")


def benchmark_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, int]:
    """The pieces of all items with the number of their block, and how many blocks there are. A block has at most
    ``BENCHMARK_BYTES`` and one piece."""
    pieces = _cut_items(benchmark, id_col, text_col, window)
    weight = F.octet_length("text") + F.aggregate("names", F.lit(0), lambda a, n: a + F.octet_length(n))
    keyed = stage(pieces.select("*", F.md5(F.concat(F.col("text"), F.array_join("names", ",").cast("binary"))).alias("key"), weight.alias("weight")), "items")
    # Equal pieces of one text are once enough.
    once = keyed.dropDuplicates(["key"])
    placed = running_sums(once, ["key"], block=F.col("weight"))
    numbered = stage(placed.withColumn("block", F.floor(F.col("block") / BENCHMARK_BYTES).cast("int")), "blocks")
    # Blocks that a long piece leaves empty have no number.
    numbers = sorted(r[0] for r in numbered.select("block").distinct().collect())
    place = F.array_position(F.array(*[F.lit(n) for n in numbers]).cast("array<int>"), F.col("block")) - 1
    return numbered.select("names", "text", place.alias("block")), len(numbers)


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
    keep: list[str] | None = None,
    text_out: bool = False,
) -> DataFrame:
    """The columns ``keep`` (all by default) with ``n_words``, ``spans`` and ``items``; with ``text_out`` also
    ``cleaned``, the text without the spans. These replace columns of the same names.

    ``spans`` are word ranges, merged; ``items`` the ids, as texts, of items with a window in the document. An item with
    fewer words than ``window`` is one window; one without words, or null, is none. Null and empty texts have no
    words. Repeated rows are judged alike; an empty benchmark marks nothing. A benchmark of several blocks is searched
    block by block, with the documents and what was found written to the shared folder in between.
    """
    spark = docs.sparkSession
    computed = ["n_words", "spans", "items", *["cleaned"] * text_out]
    kept = [c for c in (docs.columns if keep is None else keep) if c not in computed]
    own = [f"c{i}" for i in range(len(kept))]
    rows = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(kept, own)], F.col(f"`{text_col}`").alias("t"))
    items, blocks = benchmark_blocks(benchmark, item_id_col, item_text_col, window)
    schema = "n_words long, spans array<struct<start:long,stop:long>>, items array<string>"

    def search(rows: DataFrame, block: int, keep: list[str], clean: bool) -> tuple:
        # At most a block of items.
        found = items.where(F.col("block") == block).select("names", "text").collect()
        sent = spark.sparkContext.broadcast([(list(r["names"]), bytes(r["text"])) for r in found])

        def prepare() -> Callable:
            windows = Windows(sent.value, window)

            def compute(texts: list[bytes]) -> list[pa.Array]:
                counts, spans, names = windows.hits(texts)
                out = [pa.array(counts, pa.int64()), _span_array(spans), pa.array(names, pa.list_(pa.string()))]
                return [*out, _without(texts, spans)] if clean else out

            return compute

        return sent, map_texts(rows, "t", schema + ", cleaned string" * clean, prepare, keep, SHARD_BYTES)

    if blocks <= 1:
        _, found = search(rows, 0, own, text_out)
        return found.select(*[F.col(n).alias(c) for c, n in zip(kept, own)], *computed)
    rows = rows.select("*", F.array().cast("array<struct<start:long,stop:long>>").alias("s"), F.array().cast("array<string>").alias("m"))
    for block in range(blocks):
        sent, found = search(rows, block, [*own, "t", "s", "m"], False)
        both = found.select(*own, "t", "n_words", F.concat("s", "spans").alias("s"), F.array_distinct(F.concat("m", "items")).alias("m"))
        rows = stage(both, f"searched-{block}")
        sent.destroy()
    merged = _merged(rows, own, text_out)
    return merged.select(*[F.col(n).alias(c) for c, n in zip(kept, own)], *computed)


def _span_array(spans: list[list[tuple[int, int]]]) -> pa.Array:
    return pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], SPANS)


def _without(texts: list[bytes], spans: list) -> pa.Array:
    return pa.array([remove_words(t, s) if s else t for t, s in zip(texts, spans)], pa.binary()).cast(pa.string())


def _merged(rows: DataFrame, own: list[str], text_out: bool) -> DataFrame:
    """One set of spans and items from those of all blocks."""
    fields = [rows.schema[c] for c in [*own, "n_words"]]
    fields += T._parse_datatype_string("spans array<struct<start:long,stop:long>>, items array<string>" + ", cleaned string" * text_out).fields
    schema = T.StructType(fields)

    def merge(batches):
        for batch in batches:
            spans = [merge_spans([(x["start"], x["stop"]) for x in s]) for s in batch.column("s").to_pylist()]
            arrays = [*[batch.column(c) for c in [*own, "n_words"]], _span_array(spans), batch.column("m")]
            if text_out:
                arrays.append(_without([t or b"" for t in batch.column("t").cast(pa.binary()).to_pylist()], spans))
            yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return rows.withColumn("m", F.array_sort("m")).mapInArrow(merge, schema)


def remove_words(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    """The text without the words of the spans and what stands between them; a space takes their place."""
    ranges = word_ranges(text)
    pieces, at = [], 0
    for start, stop in spans:
        pieces.append(text[at : ranges[start][0]])
        at = ranges[stop - 1][1]
    pieces.append(text[at:])
    return b" ".join(p for p in (x.strip(b" ") for x in pieces) if p)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text") -> DataFrame:
    """The documents with the benchmark's windows cut from their texts; the columns of ``docs``, all rows.

    A null text stays null, untouched texts stay as they are, and ``n_chars``, where it is a column, follows the text.
    """
    found = find_contamination(docs, benchmark, window, text_col, text_out=True)
    hit = F.size("spans") > 0
    changed = {text_col: F.when(hit, F.col("cleaned")).otherwise(F.col(text_col))}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(hit, F.char_length("cleaned").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return found.withColumns(changed).select(*docs.columns)


def op2_decontamination(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = find_contamination(docs, benchmark, keep=["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


OP2_SQL = r"""
WITH words AS (
  SELECT doc_id, list_transform(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x) AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, sizes WHERE len(w) >= size)),
hits AS (SELECT d.doc_id, d.i, d.size, x.item_id FROM doc_windows AS d JOIN item_windows AS x USING (size, win)),
hit_words AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM (SELECT DISTINCT doc_id, i, size FROM hits)) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(DISTINCT item_id)::BIGINT AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS names
  FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""
