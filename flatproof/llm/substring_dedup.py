"""Removal of repeated passages by seed and extend on words.

A word goes if a window of ``length`` consecutive words that covers it also starts anywhere else, in the same document
or another; all copies go. Seeds are winnowed anchors: word grams that are least by hash within a window, so that equal
windows have equal seeds; :mod:`.repeats` joins the documents on them and settles runs of windows with equal content
hashes. The occurrences of the other seeds are extended both ways, word by word, for as long as others agree; what is
longer than a window on both sides together is a repeat, and adjoining ones are the maximal repeats. No pairs of
occurrences are formed, however many share a seed.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .repeats import Covered, Plan, repeated_windows

GRAM = 10
#: Words whose hashes a task remembers; beyond it, remembering starts anew.
WORDS = 300_000

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word)
        return found


def word_symbols() -> Callable[[bytes], np.ndarray]:
    known = WordHashes()

    def symbols(text: bytes) -> np.ndarray:
        words = text.split()
        return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))

    return symbols


def cut_words() -> Callable:
    def cut(text: bytes, starts: list[int], stops: list[int]) -> list[bytes]:
        words = text.split() if starts else []
        return [b" ".join(words[a:b]) for a, b in zip(starts, stops)]

    return cut


def _classes_of(classes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Classes refined by one more word; -1 for those that share theirs with no other, and for what was -1 or has no word."""
    out = np.full(len(classes), -1)
    alive = np.flatnonzero((classes >= 0) & (words >= 0))
    if len(alive):
        pairs = classes[alive] * (int(words.max()) + 1) + words[alive]
        _, place, count = np.unique(pairs, return_inverse=True, return_counts=True)
        out[alive] = np.where(count[place] > 1, place, -1)
    return out


def extend_seeds(segments: list[bytes], rows: dict[str, np.ndarray], plan: Plan) -> tuple:
    """Places of rows, first windows and numbers of windows that occur more than once among the rows of a key.

    Occurrences of a seed are extended word by word to the left and to the right for as long as others agree: at each
    step those that agree so far and in the next word form a class. A window with ``t`` words before the seed is
    repeated if another occurrence is in its class both ``t`` words to the left and the rest to the right.
    """
    number: dict[bytes, int] = {}
    words = [np.array([number.setdefault(w, len(number)) for w in s.split()], np.int64) for s in segments]
    sizes = np.array([len(w) for w in words])
    joined = np.concatenate([*words, np.zeros(0, np.int64)])
    starts = np.cumsum(sizes) - sizes
    anchor, count = rows["anchor"], rows["count"]

    def word(at: np.ndarray) -> np.ndarray:
        """The word of each row at a place of its own, -1 outside of it."""
        inside = (at >= 0) & (at < sizes)
        return np.where(inside, joined[np.where(inside, starts + at, 0)], -1)

    _, left = np.unique(rows["key"], return_inverse=True)
    most = int(anchor.max(initial=0))
    right = [left]
    for m in range(plan.length):
        right.append(_classes_of(right[-1], word(anchor + m)))
        if m + 1 < plan.length - most:
            right[m] = None  # shorter than any window needs
    found_row, found_first = [], []
    for t in range(most + 1):
        if t:
            left = _classes_of(left, word(anchor - t))
        rest = right[plan.length - t]
        first = anchor - t
        real = np.flatnonzero((first >= 0) & (first < count) & (left >= 0) & (rest >= 0))
        if len(real):
            pairs = left[real] * (int(rest.max()) + 1) + rest[real]
            _, place, n = np.unique(pairs, return_inverse=True, return_counts=True)
            again = real[n[place] > 1]
            found_row.append(again)
            found_first.append(first[again])
    if not found_row:
        return (np.zeros(0, np.int64),) * 3
    row, first = np.concatenate(found_row), np.concatenate(found_first)
    order = np.lexsort((first, row))
    row, first = row[order], first[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (row[1:] != row[:-1]) | (first[1:] != first[:-1] + 1)
    begin = np.flatnonzero(fresh)
    return row[begin], first[begin], np.diff(np.r_[begin, len(row)])


def _plan(length: int) -> Plan:
    return Plan(length, max(1, min(GRAM, length - 1)), False, word_symbols)


def find_repeated_words(
    docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, n_words, n_removed, spans, kept``, one row per document.

    ``spans`` are the removed word ranges, ``kept`` the other words, joined by a space. Words are runs of characters
    other than ASCII white space; null and empty texts have none. Rows that are equal in id and text are one document,
    which is no repeat of itself, and both get its row; with different ids equal texts are repeats. Null ids are
    handled like any other id. Ids must be integers.
    """
    found = repeated_windows(docs, _plan(length), cut_words, extend_seeds, id_col, text_col)
    schema = T._parse_datatype_string(
        "id long, n_words long, n_removed long, spans array<struct<start:long,stop:long>>, kept binary"
    )
    kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))

    def run(batches):
        for batch in batches:
            counts, spans, kept, covered = [], [], [], Covered(batch, length)
            for i, text in enumerate(batch.column("text").to_pylist()):
                words = text.split()
                cuts = covered.ranges(i, len(words))
                counts.append(len(words))
                spans.append(cuts)
                edges = [0, *[x for c in cuts for x in c], len(words)]
                kept.append(b" ".join([w for a, b in zip(edges[::2], edges[1::2]) for w in words[a:b]]))
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array(counts, pa.int64()), pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([[{"start": a, "stop": b} for a, b in s] for s in spans], kind), pa.array(kept, pa.binary()),
            ], names=schema.names)

    out = found.select(F.when(~F.col("none"), F.col("id")).alias("id"), "text", "windows").mapInArrow(run, schema)
    number = F.col("id").cast(docs.schema[id_col].dataType)
    return out.select(number.alias("doc_id"), "n_words", "n_removed", "spans", "kept")


def remove_repeated_words(
    docs: DataFrame, length: int = 35, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The documents, all rows and columns, with repeated passages cut from their texts.

    What stays of a text keeps its white space; a line end stands where a passage was. Texts without repeats, and
    nulls, stay as they are. ``n_chars``, where it is a column, follows a changed text.
    """
    found = repeated_windows(docs, _plan(length), cut_words, extend_seeds, id_col, text_col, carry=True)
    # All columns of the texts, so that both joins with them have the same shuffle.
    rows = found.select("row", "missing", "none", "text", "windows")
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string("text string, changed boolean").fields])

    def run(batches):
        for batch in batches:
            texts, changed, covered = [], [], Covered(batch, length)
            columns = [batch.column(c).to_pylist() for c in ("text", "missing")]
            for i, (text, missing) in enumerate(zip(*columns)):
                ranges = [m.span() for m in _WORD.finditer(text)] if covered.any(i) else []
                cuts = covered.ranges(i, len(ranges))
                changed.append(bool(cuts))
                edges = [0, *[x for c in cuts for x in c], len(ranges)]
                if cuts:
                    text = b"\n".join(text[ranges[a][0] : ranges[b - 1][1]] for a, b in zip(edges[::2], edges[1::2]) if a < b)
                texts.append(None if missing else text)
            texts = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), texts, pa.array(changed)], names=schema.names)

    cut = rows.mapInArrow(run, schema)
    columns = []
    for c in docs.columns:
        if c == text_col:
            columns.append(F.col("text").alias(c))
        elif c == "n_chars":
            size = F.char_length("text").cast(docs.schema[c].dataType)
            columns.append(F.when(F.col("changed"), size).otherwise(F.col("row").getField(c)).alias(c))
        else:
            columns.append(F.col("row").getField(c).alias(c))
    return cut.select(*columns)


def op7_substring_dedup(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = find_repeated_words(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP7_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY win) > 1 AS again
  FROM (SELECT doc_id, i, md5(array_to_string(w[i : i + 34], ' ')) AS win
        FROM (SELECT *, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35))),
removed AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM windows WHERE again),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d),
kept AS (
  SELECT words.doc_id, string_agg(word, ' ' ORDER BY words.p) AS k, count(*) AS n
  FROM words ANTI JOIN removed ON words.doc_id = removed.doc_id AND words.p = removed.p GROUP BY words.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""
