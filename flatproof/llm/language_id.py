r"""Language identification by interpolated Kneser-Ney models of characters.

A text is lower-cased and read as UTF-16 units; each run of units that are no letters (halves of pairs count as letters)
becomes one space, and the text stands between spaces. So four units are one 64-bit number, and a model of order 4 is
counted exactly. Counts come from every learnt text: a task adds up the grams of its texts, an aggregate adds up tasks.

With ``c`` the count of a gram ``hw`` at order 4 and the number of different units before it at lower orders, ``D`` the
discount ``n1 / (n1 + 2 n2)`` of the order (between 0.1 and 0.95) and ``h'`` the context without its first unit,

    p(w|h) = (c(hw) - D) / c(h) + D * types(h) / c(h) * p(w|h')

down to single units, below which all 65,536 are alike. Stored are the logarithms of ``p`` for each gram that was seen
and of the weight ``D * types / c`` for each context; a gram that was not seen takes its context's weight and the next
order. All of that is DataFrame work over tables of grams.

Scoring looks grams up in sorted arrays of 64-bit hashes, one pair of hashes and values per language. The arrays go to
the tasks in blocks of at most ``model_bytes``: a block holds some languages, or of a language too large for one block the
grams behind some units, since a gram and everything it may fall back to share the last unit of the context. With
several blocks the texts are passed once per block, and the sums so far are written to the shared folder in between.

The language of the lowest cross-entropy per unit wins, of equal ones the least name. Two things are calibrated on all learnt
texts, each scored by models that did not learn it: the scale that makes ``score`` a probability, and for each language the
cross-entropy above which a text is ``rejected`` as none of the languages. For that the texts are dealt into :data:`FOLDS`
folds by a hash, so that copies share one, and for each fold models are made of the counts of the others. Losses are summed
over all texts, limits are exact quantiles, found by ranks along ranges.

Null texts and texts without a letter, and all texts if nothing was learnt, are ``und`` with score 0 and not rejected. Rows
with a null language are not learnt from. Equal texts have equal answers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import groups_of, map_texts, running_sums, stage

ORDER = 4
UNIT = 16
UNKNOWN = "und"
#: Distinct grams that a task holds before it hands its counts on.
HELD_GRAMS = 2 << 20
#: Bytes of a hash and a value.
ENTRY_BYTES = 12
GRAM, CONTEXT = 0, 1
#: Parts of the learnt texts, each of which is scored by the models of the others for calibration.
FOLDS = 3
#: Scales of which the one of the least loss is taken.
SCALES = [2.0 ** (step / 2) for step in range(-4, 21)]

_MASKS = [(1 << UNIT * n) - 1 for n in range(ORDER + 1)]


def letters() -> np.ndarray:
    """Which UTF-16 units are letters; halves of pairs count as such."""
    out = np.fromiter((chr(i).isalpha() for i in range(1 << UNIT)), bool, 1 << UNIT)
    out[0xD800:0xE000] = True
    return out


def units(text: bytes, letter: np.ndarray) -> np.ndarray:
    """The units of a text behind ``ORDER - 1`` spaces, nothing for a text without a letter."""
    said = text.decode("utf-8", "replace")
    raw = np.frombuffer(said.lower().encode("utf-16-le", "surrogatepass"), np.uint16)
    own = letter[raw]
    pairs = (raw >= 0xD800) & (raw < 0xE000)
    if not (own & ~pairs).any() and not any(map(str.isalpha, said)):
        return raw[:0]
    kept = own.copy()
    kept[1:] |= own[:-1]  # the first of a run of others
    body = np.where(own, raw, np.uint16(32))[kept]
    tail = [32] if own[-1] else []
    return np.concatenate([np.full(ORDER - 1, 32, np.uint16), body, np.array(tail, np.uint16)])


def grams(streams: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The grams of all streams, and how many each has."""
    sizes = np.array([max(0, len(s) - ORDER + 1) for s in streams], np.int64)
    if not sizes.sum():
        return np.zeros(0, np.uint64), sizes
    full = [s for s in streams if len(s)]
    joined = np.concatenate(full).astype(np.uint64)
    out = joined[ORDER - 1 :].copy()
    for back in range(1, ORDER):
        out |= joined[ORDER - 1 - back : len(joined) - back] << np.uint64(UNIT * back)
    # Leave out the windows that end in the spaces before a text.
    starts = np.cumsum([0, *map(len, full[:-1])])
    lead = (starts[1:, None] + np.arange(ORDER - 1)).ravel() - (ORDER - 1)
    return np.delete(out, lead), sizes


def count_grams(rows: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """``lang, gram, n``: how often each language has each gram, over all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letter = letters()
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            return keys, np.bincount(place, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)

        def out() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                keys, n = merged(parts)
                for at in range(0, len(keys), 1 << 16):
                    own = slice(at, at + (1 << 16))
                    columns = [pa.array([lang] * len(keys[own]), pa.string()), pa.array(keys[own].view(np.int64)), pa.array(n[own])]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])
            held.clear()

        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = [t or b"" for t in batch.column(1).cast(pa.binary()).to_pylist()]
            for part in groups_of(map(len, texts), 1 << 20):
                for lang in dict.fromkeys(langs[part]):
                    own = [units(t, letter) for t, name in zip(texts[part], langs[part]) if name == lang]
                    held.setdefault(lang, []).append(np.unique(grams(own)[0], return_counts=True))
                    if len(held[lang]) > 16:
                        held[lang] = [merged(held[lang])]
                if sum(len(keys) for parts in held.values() for keys, _ in parts) > HELD_GRAMS:
                    yield from out()
        yield from out()

    known = rows.select(F.col(f"`{lang_col}`").alias("lang"), F.col(f"`{text_col}`").alias("text")).where("lang is not null")
    parts = known.mapInArrow(run, "lang string, gram long, n long")
    return parts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _low(key: str, n: int) -> Column:
    return F.col(key) if n == ORDER else F.col(key).bitwiseAND(F.lit(_MASKS[n]))


def _context(key: str) -> Column:
    return F.shiftrightunsigned(key, UNIT)


def _values(rows: DataFrame, kind: int, n: int, key: Column, p: Column) -> DataFrame:
    return rows.select("lang", F.lit(kind).alias("kind"), F.lit(n).alias("n"), key.alias("key"), F.log(p).alias("value"))


def kneser_ney(counts: DataFrame) -> DataFrame:
    """``lang, kind, n, key, value``: the logarithms of all probabilities and weights, from ``lang, gram, n``. The row of
    order 0 holds the probability of a unit that the language never showed."""
    tables = {ORDER: counts.select("lang", F.col("gram").alias("key"), F.col("n").alias("c"))}
    for n in range(ORDER - 1, 0, -1):
        shorter = tables[n + 1].select("lang", _low("key", n).alias("key"))
        tables[n] = stage(shorter.groupBy("lang", "key").agg(F.count("*").alias("c")), f"grams-{n}")
    once, twice = (F.count_if(F.col("c") == k) for k in (1, 2))
    share = F.least(F.lit(0.95), F.greatest(F.lit(0.1), F.try_divide(once, once + 2 * twice)))
    out, lower = [], None
    for n in range(1, ORDER + 1):
        table = tables[n].withColumn("h", _context("key") if n > 1 else F.lit(0).cast("long"))
        discount = table.groupBy("lang").agg(F.coalesce(share, F.lit(0.5)).alias("d"))
        contexts = table.groupBy("lang", "h").agg(F.sum("c").alias("total"), F.count("*").alias("types"))
        contexts = contexts.join(F.broadcast(discount), "lang")  # one number per language
        contexts = contexts.withColumn("weight", F.col("d") * F.col("types") / F.col("total"))
        joined = table.join(contexts, ["lang", "h"])
        if lower is None:
            below = F.lit(1 / (1 << UNIT))
            out.append(_values(contexts, GRAM, 0, F.lit(0).cast("long"), F.col("weight") * below))
        else:
            joined = joined.withColumn("s", _low("key", n - 1)).join(lower, ["lang", "s"])
            below = F.col("below")
            out.append(_values(contexts, CONTEXT, n, F.col("h"), F.col("weight")))
        p = (F.col("c") - F.col("d")) / F.col("total") + F.col("weight") * below
        known = stage(joined.select("lang", "key", p.alias("p")), f"order-{n}")
        out.append(_values(known, GRAM, n, F.col("key"), F.col("p")))
        lower = known.select("lang", F.col("key").alias("s"), F.col("p").alias("below"))
    whole = out[0]
    for part in out[1:]:
        whole = whole.unionByName(part)
    return whole


def hashes(keys: np.ndarray, n: int, kind: int) -> np.ndarray:
    """64-bit hashes of grams or contexts of an order; different keys of one kind never share one."""
    x = (keys ^ np.uint64(0x9E3779B97F4A7C15 * (2 * n + kind + 1) & (1 << 64) - 1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(31)
    return x * np.uint64(0x94D049BB133111EB)


@dataclass(frozen=True)
class HashArrays:
    """A language, or its part behind some units, as sorted hashes with values."""

    place: int  # of the language
    others: bool
    behind: np.ndarray  # the last units of the contexts that are here, or of those that are elsewhere if ``others``
    floor: float
    keys: np.ndarray
    values: np.ndarray

    def find(self, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return self.keys[at] == wanted, self.values[at]

    def log_probabilities(self, wanted: np.ndarray) -> np.ndarray:
        """The logarithm of the probability of each gram's last unit; 0 for grams that are elsewhere."""
        out = np.zeros(len(wanted))
        left = np.arange(len(wanted))
        if len(self.behind) or not self.others:
            left = left[np.isin(wanted >> np.uint64(UNIT) & np.uint64(_MASKS[1]), self.behind) != self.others]
        for n in range(ORDER, 0, -1):
            own = wanted[left]
            found, values = self.find(hashes(own & np.uint64(_MASKS[n]), n, GRAM))
            out[left[found]] += values[found]
            left, own = left[~found], own[~found]
            if n > 1:
                found, values = self.find(hashes(own >> np.uint64(UNIT) & np.uint64(_MASKS[n - 1]), n, CONTEXT))
                out[left[found]] += values[found]
        out[left] += self.floor
        return out


@dataclass(frozen=True)
class Languages:
    """What was learnt. ``tables`` holds the values of :func:`kneser_ney` with the block of each row."""

    names: list[str]
    tables: DataFrame | None
    blocks: list[dict[int, list[int]]]  # per block, the languages by place with the last units of their contexts
    scale: float = 1.0
    limits: tuple[float, ...] = ()


def _deal_blocks(values: DataFrame, names: list[str], model_bytes: int) -> tuple[DataFrame, list[dict[int, list[int]]]]:
    """The values with the block of each, no block above ``model_bytes``."""
    last_unit = F.when(F.col("kind") == GRAM, _context("key")).otherwise(F.col("key")).bitwiseAND(F.lit(_MASKS[1]))
    behind = F.when(F.col("n") < 2, F.lit(-1)).otherwise(last_unit)
    keyed = stage(values.withColumn("behind", behind.cast("long")), "model")
    sizes = keyed.groupBy("lang", "behind").agg(F.count("*").alias("rows"))
    total = keyed.count()
    place = {name: i for i, name in enumerate(names)}
    if total * ENTRY_BYTES <= model_bytes:
        return keyed.withColumn("block", F.lit(0)), [{i: [] for i in range(len(names))}]
    # At most 65,537 numbers per language.
    dealt, blocks, room, last, shared = [], [], 0, None, {}
    for lang, unit, rows in sorted(map(tuple, sizes.collect())):
        need = rows * ENTRY_BYTES
        if unit == -1:
            shared[lang] = need  # single units go to each block of the language
            continue
        more = need + (shared[lang] if lang != last else 0)
        if more > room:
            blocks.append({})
            room, more = model_bytes, need + shared[lang]
            if more > room:
                raise ValueError(f"model_bytes is below the {more} bytes of the grams behind one unit")
        room, last = room - more, lang
        blocks[-1].setdefault(place[lang], []).append(unit)
        dealt.append((lang, unit, len(blocks) - 1))
    spark = values.sparkSession
    where = spark.createDataFrame(dealt, "lang string, behind long, block int")
    units_of = where.select("lang", "block").distinct()
    grams_in = keyed.where("behind >= 0").join(where, ["lang", "behind"])
    return stage(grams_in.unionByName(keyed.where("behind = -1").join(units_of, "lang")), "model-blocks"), blocks


def _load(model: Languages, block: int) -> list[HashArrays]:
    """A block as arrays; bounded by ``model_bytes``."""
    names = model.names
    found = model.tables.where(F.col("block") == block).select("lang", "kind", "n", "key", "value").toArrow()
    langs = found.column("lang").to_numpy()
    kind, n = (found.column(c).to_numpy() for c in ("kind", "n"))
    keys, values = found.column("key").to_numpy().view(np.uint64), found.column("value").to_numpy()
    out = []
    for place, here in model.blocks[block].items():
        # The last block of a language also has what follows units that it never showed.
        last = not any(place in b for b in model.blocks[block + 1 :])
        elsewhere = [u for b in model.blocks[:block] for u in b.get(place, ())]
        last_units = np.array(elsewhere if last else here, np.uint64)
        own = langs == names[place]
        floor = float(values[own & (n == 0)][0])
        hashed, kept = [], []
        for k in (GRAM, CONTEXT):
            for order in range(1, ORDER + 1):
                part = own & (kind == k) & (n == order)
                hashed.append(hashes(keys[part], order, k))
                kept.append(values[part])
        hashed, kept = np.concatenate(hashed), np.concatenate(kept).astype(np.float32)
        order = np.argsort(hashed)
        out.append(HashArrays(place, last, last_units, floor, hashed[order], kept[order]))
    return out


def score_texts(docs: DataFrame, model: Languages, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``sums``, the logarithm of the text's probability in each language, and
    ``n_units``."""
    spark, size = docs.sparkSession, len(model.names)
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("sums", "n_units")]
    rows = docs
    for block in range(len(model.blocks)):
        arrays = _load(model, block)
        sent = spark.sparkContext.broadcast([(a.place, a.others, a.behind, a.floor, a.keys, a.values) for a in arrays])
        del arrays
        last = block + 1 == len(model.blocks)

        def prepare(sent=sent) -> Callable:
            own, letter = [HashArrays(*a) for a in sent.value], letters()

            def compute(texts: list[bytes]) -> list[pa.Array]:
                found, sizes = grams([units(t, letter) for t in texts])
                distinct, place = np.unique(found, return_inverse=True)
                text = np.repeat(np.arange(len(texts)), sizes)
                sums = np.zeros((len(texts), size))
                for a in own:
                    sums[:, a.place] = np.bincount(text, a.log_probabilities(distinct)[place], len(texts)) if len(found) else 0
                ends = np.arange(0, sums.size + 1, size, dtype=np.int32)
                return [pa.ListArray.from_arrays(ends, sums.ravel()), pa.array(sizes)]

            return compute

        carried = [*kept, *(["_sums"] if block else []), *([] if last else [text_col])]
        rows = map_texts(rows, text_col, "sums array<double>, n_units long", prepare, list(dict.fromkeys(carried)), 1 << 20)
        if block:
            added = F.zip_with("_sums", "sums", lambda a, b: a + b)
            rows = rows.withColumn("sums", added).drop("_sums")
        if not last:
            rows = stage(rows.withColumnRenamed("sums", "_sums").drop("n_units"), f"sums-{block}")
    return rows


def best_scale(scored: DataFrame) -> float:
    """The scale of cross-entropies that makes the likeliest probabilities of the true languages over all rows of
    ``entropies, own`` (that of the true language)."""

    def loss(scale: float) -> Column:
        far = F.aggregate("entropies", F.lit(0.0), lambda a, e: a + F.exp((least - e) * F.lit(scale)))
        return F.sum(F.log(far) + (F.col("own") - least) * F.lit(scale))

    least = F.array_min("entropies")
    losses = scored.agg(*[loss(scale).alias(f"l{i}") for i, scale in enumerate(SCALES)]).first()
    best, found = None, 1.0
    for scale, total in zip(SCALES, losses):
        if total is not None and (best is None or total < best - 1e-12):
            best, found = total, scale
    return found


def quantiles(scored: DataFrame, share: float) -> dict[str, float]:
    """Per language the exact quantile of ``own``, between two values in proportion."""
    equal = scored.groupBy("lang", "own").agg(F.count("*").alias("n"))
    ranked = stage(running_sums(equal, ["lang", "own"], before=F.col("n")), "ranks")
    sizes = ranked.groupBy("lang").agg(F.min("before").alias("start"), F.sum("n").alias("n")).collect()  # one per language
    wanted = [(r["lang"], r["start"] + int((r["n"] - 1) * share) + up) for r in sizes for up in (0, 1)]
    if not wanted:
        return {}
    places = scored.sparkSession.createDataFrame(wanted, "lang string, place long")
    inside = (F.col("place") >= F.col("before")) & (F.col("place") < F.col("before") + F.col("n"))
    values = {(r["lang"], r["place"]): r["own"] for r in ranked.join(F.broadcast(places), "lang").where(inside).collect()}
    out = {}
    for r in sizes:
        at = (r["n"] - 1) * share
        low = values[r["lang"], r["start"] + int(at)]
        out[r["lang"]] = low + (at - int(at)) * (values.get((r["lang"], r["start"] + int(at) + 1), low) - low)
    return out


def _calibrated(known: DataFrame, counts: DataFrame, names: list[str], rejected: float, model_bytes: int) -> tuple:
    """Scale and limits, from all texts with their folds, each scored by the counts of the other folds."""
    parts = []
    for fold in range(FOLDS):
        others = counts.where(F.col("fold") != fold).groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        rest = stage(others, "other-grams")
        left = sorted(r["lang"] for r in rest.select("lang").distinct().collect())
        if not left:
            continue
        model = Languages(left, *_deal_blocks(kneser_ney(rest), left, model_bytes))
        texts = known.where((F.col("fold") == fold) & F.col("lang").isin(left))
        entropies = F.transform("sums", lambda s: -s / F.col("n_units")).alias("entropies")
        scored = score_texts(texts, model, keep=["lang"]).where("n_units > 0").select("lang", entropies)
        place = F.array_position(F.array(*[F.lit(name) for name in left]), F.col("lang")).cast("int")
        parts.append(stage(scored.withColumn("own", F.get("entropies", place - 1)), "calibration"))
    if not parts:
        return 1.0, (float("inf"),) * len(names)
    scored = reduce(DataFrame.unionByName, parts)
    limits = quantiles(scored, 1 - rejected)
    most = max(limits.values(), default=float("inf"))
    return best_scale(scored), tuple(limits.get(name, most) for name in names)


def fit_languages(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    model_bytes: int = 128 << 20,
    rejected: float = 0.002,
) -> Languages:
    """Models from all given rows whose language is not null."""
    known = docs.select(F.col(f"`{text_col}`").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    known = known.where("lang is not null and text is not null").withColumn("fold", F.pmod(F.xxhash64("text"), F.lit(FOLDS)))
    tagged = known.select("text", F.concat(F.col("fold").cast("string"), F.lit(":"), F.col("lang")).alias("tag"))
    found = count_grams(tagged, "text", "tag").withColumnRenamed("lang", "tag")
    at = F.position(F.lit(":"), F.col("tag"))
    lang, fold = F.substring(F.col("tag"), at + 1, F.length("tag")), F.substring_index("tag", ":", 1).cast("int")
    by_fold = stage(found.select(lang.alias("lang"), fold.alias("fold"), "gram", "n"), "fold-grams")
    counts = stage(by_fold.groupBy("lang", "gram").agg(F.sum("n").alias("n")), "grams")
    names = sorted(r["lang"] for r in counts.select("lang").distinct().collect())  # one row per language
    if not names:
        return Languages([], None, [])
    tables, blocks = _deal_blocks(kneser_ney(counts), names, model_bytes)
    return Languages(names, tables, blocks, *_calibrated(known, by_fold, names, rejected, model_bytes))


def identify_languages(docs: DataFrame, model: Languages, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """The columns ``keep`` (all by default) with ``lang_pred``, ``score``, ``cross_entropy`` (null for ``und``) and
    ``rejected``, which replace input columns of their names."""
    names = ("lang_pred", "score", "cross_entropy", "rejected")
    kept = [c for c in (docs.columns if keep is None else keep) if c not in (*names, "sums", "n_units")]
    own = [F.col(f"`{c}`") for c in kept]
    if not model.names:
        none = (F.lit(UNKNOWN), F.lit(0.0), F.lit(None).cast("double"), F.lit(False))
        return docs.select(*own, *[c.alias(n) for c, n in zip(none, names)])
    scored = score_texts(docs, model, text_col, kept)
    entropies = F.transform("sums", lambda s: -s / F.col("n_units"))
    some = F.col("n_units") > 0
    least = F.array_min("_e")
    best = F.array_position("_e", least).cast("int")
    chance = F.aggregate("_e", F.lit(0.0), lambda a, e: a + F.exp((least - e) * F.lit(model.scale)))
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), best - 1)
    ready = scored.withColumn("_e", F.when(some, entropies))
    return ready.select(
        *own, F.coalesce(F.when(some, pick(model.names)), F.lit(UNKNOWN)).alias("lang_pred"),
        F.coalesce(F.when(some, 1 / chance), F.lit(0.0)).alias("score"), F.when(some, least).alias("cross_entropy"),
        F.coalesce(F.when(some, least > pick(model.limits)), F.lit(False)).alias("rejected"),
    )


def held_out(doc_id: Column) -> Column:
    """Whether a row is kept from learning: crc32 of the id as text leaves 2 when divided by 4. A null id counts as empty
    text, which is learnt from."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 4 == 2


def op13_language_id(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    model = fit_languages(docs.where(~held_out(F.col("doc_id"))))
    found = identify_languages(docs.select("doc_id", "text"), model, keep=["doc_id"])
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "cross_entropy", "rejected"
    )
