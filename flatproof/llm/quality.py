"""Quality classifier: histogram gradient-boosted trees over document statistics.

Statistics are computed from the whole text of every document. The trees are fitted on the driver from a bounded sample
of labelled rows (``train_rows``, chosen by a hash of the id): features are cut into at most 64 bins by quantiles, and
each level of a tree is found from histograms of gradients. The fitted trees are flat arrays that all documents of a
block walk down together.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, fields
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_texts

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "upper", "digits", "spaces", "line_ends", "stops", "commas", "shouts",
    "bars", "symbols", "high_bytes", "distinct_words", "repeated_words", "commonest_word", "repeated_lines",
    "log_line_bytes", "byte_entropy", "longest_word",
)


def _class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


_CLASSES = np.array([
    _class(bytes(range(65, 91))), _class(b"0123456789"), _class(b" \t"), _class(b"\n\r"), _class(b".?"), _class(b",;:"),
    _class(b"!"), _class(b"|"), _class(b"#$%&*+<=>@[\\]^_`{}~/"), _class(bytes(range(128, 256))),
]).astype(float).T


def statistics(text: bytes) -> list[float]:
    """The features of a text; an empty text has zeros."""
    if not text:
        return [0.0] * len(FEATURES)
    size = len(text)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    upper, digits, spaces, ends, stops, commas, shouts, bars, symbols, high = (counts @ _CLASSES / size).tolist()
    share = counts[counts > 0] / size
    words = text.split()
    n = max(1, len(words))
    tally = Counter(words)
    repeated = sum(map(eq, words, words[1:]))
    lines = [x for x in text.split(b"\n") if x]
    return [
        np.log1p(size), np.log1p(len(words)), size / n, upper, digits, spaces, ends, stops, commas, shouts, bars, symbols,
        high, len(tally) / n, repeated / n, max(tally.values(), default=0) / n,
        1 - len(set(lines)) / max(1, len(lines)), np.log1p(size / max(1, len(lines))), float(-(share * np.log2(share)).sum()),
        max(map(len, tally), default=0) / size,
    ]


@dataclass(frozen=True)
class Trees:
    """All trees as flat arrays: a node splits on ``feature`` at ``limit`` (left if not above) or is a leaf (-1)."""

    base: float
    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.base)
        if len(self.roots):
            node = np.repeat(self.roots[None, :], len(x), axis=0)
            row = np.arange(len(x))[:, None]
            for _ in range(self.depth):
                feature = self.feature[node]
                below = x[row, np.maximum(feature, 0)] <= self.limit[node]
                node = np.where(feature < 0, node, np.where(below, self.left[node], self.right[node]))
            total += self.value[node].sum(axis=1)
        return 1 / (1 + np.exp(-total))


def fit_trees(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 5, rate: float = 0.15, bins: int = 64,
    ridge: float = 1.0, least: int = 10,
) -> Trees:
    """Logistic loss. Without rows, or with one label only, there are no trees and every score is the label's share,
    smoothed by one row of each label."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    nodes: list[list] = []  # feature, limit, left, right, value
    roots: list[int] = []
    if len(y) and 0 < y.sum() < len(y):
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
        columns = x.shape[1]
        offsets = np.arange(columns) * bins
        score = np.full(len(y), base)
        for _ in range(trees):
            p = 1 / (1 + np.exp(-score))
            gradient, curvature = p - y, p * (1 - p)
            roots.append(len(nodes))
            nodes.append([-1, 0.0, -1, -1, 0.0])
            member = np.full(len(y), roots[-1])
            level = [roots[-1]]
            for d in range(depth + 1):
                place = np.full(len(nodes), -1)
                place[level] = np.arange(len(level))
                local = place[member]
                active = local >= 0
                cell = (local[active, None] * columns * bins + offsets + binned[active]).ravel()
                shape = (len(level), columns, bins)
                total = len(level) * columns * bins
                g, h, c = (
                    np.bincount(cell, None if w is None else np.repeat(w[active], columns), total).reshape(shape)
                    for w in (gradient, curvature, None)
                )
                gl, hl, cl = (np.cumsum(v, axis=2) for v in (g, h, c))
                ga, ha, ca = gl[:, :, -1:], hl[:, :, -1:], cl[:, :, -1:]
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(cl < least) | (ca - cl < least)] = 0
                best = gain.reshape(len(level), -1).argmax(axis=1)
                following = []
                for i, node in enumerate(level):
                    feature, cut = divmod(int(best[i]), bins)
                    nodes[node][4] = -rate * float(ga[i, 0, 0] / (ha[i, 0, 0] + ridge))
                    if d == depth or gain[i, feature, cut] <= 1e-6 or cut >= len(edges[feature]):
                        continue
                    left = len(nodes)
                    nodes[node][:4] = [feature, float(edges[feature][cut]), left, left + 1]
                    nodes += [[-1, 0.0, -1, -1, 0.0], [-1, 0.0, -1, -1, 0.0]]
                    own = member == node
                    member[own] = np.where(binned[own, feature] <= cut, left, left + 1)
                    following += [left, left + 1]
                level = following
                if not level:
                    break
            score += np.array([n[4] for n in nodes])[member]
    columns = list(zip(*nodes)) if nodes else [[]] * 5
    kinds = (np.int64, np.float64, np.int64, np.int64, np.float64)
    return Trees(base, *(np.array(c, k) for c, k in zip(columns, kinds)), np.array(roots, np.int64), depth)


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text is divisible by 5. A null id counts as empty text,
    which is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def fit_quality(
    docs: DataFrame,
    labels: DataFrame,
    train_rows: int = 20_000,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> Trees:
    """Trees from at most ``train_rows`` documents with labelled ids that are not held out: the ids come first by their
    hash, and where ids have several rows, a share of the rows by a hash of their texts.

    Null labels and ids are left out; several labels of an id count as 1 if at least half are.
    """
    usable = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col)))
    one = usable.groupBy(F.col(id_col).alias("_id")).agg((F.avg(label_col) >= 0.5).cast("double").alias("_label"))
    chosen = one.orderBy(F.xxhash64("_id"), "_id").limit(train_rows)
    # At most train_rows rows of two numbers.
    rows = docs.select(id_col, text_col).join(F.broadcast(chosen), F.col(id_col) == F.col("_id"))
    found = rows.count()
    if found > train_rows:
        place = F.pmod(F.xxhash64(F.col(text_col), F.lit(1)), F.lit(1 << 20))
        rows = rows.where(place < int(train_rows / found * (1 << 20)) + 1)

    def prepare() -> Callable:
        return lambda texts: [pa.array([statistics(t) for t in texts], pa.list_(pa.float64()))]

    found = map_texts(rows, text_col, "x array<double>", prepare, ["_id", "_label"]).limit(train_rows).collect()
    found.sort(key=lambda r: (r["_id"], r["x"]))
    x = np.array([r["x"] for r in found], float).reshape(len(found), len(FEATURES))
    return fit_trees(x, np.array([r["_label"] for r in found], float))


def score_quality(docs: DataFrame, model: Trees, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) and ``score``, which replaces an input column of its name.

    Null texts are scored like empty ones. Equal texts have equal scores. Only the text is looked at.
    """
    # Bounded by trees and depth; plain arrays, so that executors need no copy of this module.
    sent = docs.sparkSession.sparkContext.broadcast([getattr(model, f.name) for f in fields(model)])

    def prepare() -> Callable:
        trees = Trees(*sent.value)

        def compute(texts: list[bytes]) -> list[pa.Array]:
            x = np.array([statistics(t) for t in texts], float).reshape(len(texts), len(FEATURES))
            return [pa.array(trees.scores(x), pa.float64())]

        return compute

    return map_texts(docs, text_col, "score double", prepare, keep)


def op3_quality_trees(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = score_quality(docs, fit_quality(docs, labels), keep=["doc_id"])
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )
