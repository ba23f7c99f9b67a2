"""Language identification against models counted in dictionaries."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import CLASHING
from pyspark.sql import functions as F

from flatproof.llm import language_id as li

ROWS = "doc_id bigint, text string, lang string"
SF_DIR = "/root/testdata/sf0.001"


def stream(text):
    """Units as one-character strings, spaces in front; nothing without a letter."""
    if not any(map(str.isalpha, text)):
        return []
    raw = text.lower().encode("utf-16-le", "surrogatepass")
    out = [" "] * 3
    for i in range(0, len(raw), 2):
        unit = chr(raw[i] | raw[i + 1] << 8)
        letter = unit.isalpha() or 0xD800 <= ord(unit) < 0xE000
        if letter or out[-1] != " ":
            out.append(unit if letter else " ")
    return out if out[-1] == " " else [*out, " "]


class Plain:
    """Interpolated Kneser-Ney by its definition, over tuples."""

    def __init__(self, texts):
        counts = {4: Counter()}
        for text in texts:
            s = stream(text)
            counts[4].update(tuple(s[i - 3 : i + 1]) for i in range(3, len(s)))
        for n in (3, 2, 1):
            counts[n] = Counter(g[1:] for g in counts[n + 1])
        self.counts, self.d, self.total, self.types = counts, {}, defaultdict(Counter), defaultdict(Counter)
        for n, table in counts.items():
            once, twice = (sum(c == k for c in table.values()) for k in (1, 2))
            self.d[n] = min(0.95, max(0.1, once / (once + 2 * twice) if once + twice else 0.1))
            for g, c in table.items():
                self.total[n][g[:-1]] += c
                self.types[n][g[:-1]] += 1

    def p(self, g):
        n = len(g)
        if not n:
            return 1 / 65536
        below = self.p(g[1:])
        total = self.total[n][g[:-1]]
        if not total:
            return below
        c = self.counts[n][g]
        return (max(c - self.d[n], 0) + self.d[n] * self.types[n][g[:-1]] * below) / total

    def entropy(self, text):
        s = stream(text)
        return -sum(math.log(self.p(tuple(s[i - 3 : i + 1]))) for i in range(3, len(s))) / (len(s) - 3) if s else None


def brute(rows):
    models = {lang: Plain([t or "" for _, t, own in rows if own == lang]) for lang in {r[2] for r in rows if stream(r[1] or "")} - {None}}
    out = []
    for doc, text, _ in rows:
        found = sorted((m.entropy(text or ""), lang) for lang, m in models.items()) if stream(text or "") and models else []
        out.append((doc, found[0][1] if found else "und", found[0][0] if found else None))
    return out


def key(r):
    return (r[0] is None, r[0] or 0, r[1], r[2] or 0)


def same(got, want):
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:2] for r in got] == [r[:2] for r in want]
    assert [r[2] is None for r in got] == [r[2] is None for r in want]
    assert np.allclose([r[2] or 0 for r in got], [r[2] or 0 for r in want], rtol=1e-5)


def words(rng, letters, n):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(1, 7))) for _ in range(n))


def some_rows(seed):
    rng = random.Random(seed)
    rows = []
    for i, (lang, letters) in enumerate([("aa", "abcde "), ("bb", "defgh"), ("cc", "ÄßéÖdef"), ("漢", "漢字学习中")] * 12):
        rows.append((i, words(rng, letters, rng.choice([1, 3, 30, 200])).upper() if i % 3 else words(rng, letters, 8) + "!?", lang))
    rows += [(100, None, "aa"), (101, "", "bb"), (102, " .,;12 34", "aa"), (103, "😀 😀", "cc"), (104, "𐐀𐐁 𐐂", "cc"), (105, "abc", None), (None, "Fed 7", "bb")]
    rows += [(106, "abc de", "aa")] * 30 + [(106, "hhg", "aa"), (107, "x" * 50_000, "bb"), (108, "zq", None), (109, "İstanbul ǅ", "")]
    return rows


def test_units():
    letter = li.letters()
    for text in ["", "  ", "1!", "a", "A1b", " 'Été, 2x ", "😀", "a😀", "𐐀", "\n\nß\tİ", "漢字。", "\x00a\x00"]:
        assert [chr(u) for u in li.units(text.encode(), letter)] == stream(text), text
    streams = [li.units(t, letter) for t in (b"", b"ab c", b"1", b"z")]
    found, sizes = li.grams(streams)
    assert sizes.tolist() == [0, 5, 0, 2]
    s = ["   ab c ", "   z "]
    want = [sum(ord(ch) << 16 * (3 - i) for i, ch in enumerate(x[at - 3 : at + 1])) for x in s for at in range(3, len(x))]
    assert found.tolist() == want


def test_against_plain_models(spark):
    rows = some_rows(1)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    model = li.fit_languages(df)
    extra = [c for c in CLASHING if c not in df.columns]
    wide = df.selectExpr("*", *[f"doc_id as `{c}`" for c in [*extra, "_sums", "_e", "sums", "rejected"]])
    got = li.identify_languages(wide, model)
    assert got.columns == [c for c in wide.columns if c not in ("score", "sums", "rejected")] + ["lang_pred", "score", "cross_entropy", "rejected"]
    got = got.collect()
    same([(r.doc_id, r.lang_pred, r.cross_entropy) for r in got], brute(rows))
    assert all(0 < r.score <= 1 if r.lang_pred != "und" else r.score == 0 and not r.rejected for r in got)


def test_blocks_give_the_same(spark):
    rows = some_rows(2)
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    whole = li.fit_languages(df)
    small = li.fit_languages(df, model_bytes=12_000)
    assert len(whole.blocks) == 1 and len(small.blocks) > 4
    sizes = [sum(len(a.keys) for a in li._load(small, b)) * li.ENTRY_BYTES for b in range(len(small.blocks))]
    assert max(sizes) <= 12_000
    one, other = ([(r.doc_id, r.lang_pred, r.cross_entropy) for r in li.identify_languages(df, m).collect()] for m in (whole, small))
    same(one, other)
    assert np.allclose(whole.limits, small.limits, rtol=1e-5) and whole.scale == small.scale
    with pytest.raises(ValueError, match="one unit"):
        li.fit_languages(df, model_bytes=1000)


def test_nothing_learnt(spark):
    df = spark.createDataFrame([(1, "abc", None), (2, None, "en"), (3, "12", "en")], ROWS)
    for docs in (df, df.limit(0)):
        model = li.fit_languages(docs)
        assert model.names == []
        assert [(r.lang_pred, r.score, r.rejected) for r in li.identify_languages(df, model).collect()] == [("und", 0.0, False)] * 3
    model = li.fit_languages(spark.createDataFrame([(1, "only one", "xx")], ROWS))
    assert [(r.lang_pred, r.score) for r in li.identify_languages(df, model).collect()] == [("xx", 1.0), ("und", 0.0), ("und", 0.0)]
    assert li.identify_languages(df.limit(0), model).collect() == []


def test_rejection(spark):
    rng = random.Random(3)
    rows = [(i, words(rng, "abcde" if i % 2 else "klmno", 60), "ab" if i % 2 else "kl") for i in range(300)]
    model = li.fit_languages(spark.createDataFrame(rows, ROWS))
    odd = [(i, words(rng, "rstuvwxyz", 60), None) for i in range(20)] + [(100 + i, words(rng, "abcde", 60), None) for i in range(100)]
    got = {r.doc_id: r for r in li.identify_languages(spark.createDataFrame(odd, ROWS), model).collect()}
    assert all(got[i].rejected for i in range(20))
    assert sum(got[100 + i].rejected for i in range(100)) <= 5 and all(got[100 + i].lang_pred == "ab" for i in range(100))


def test_calibration_takes_all_texts(spark):
    """Limits and scale come from every learnt text, scored by models without its fold; no sample decides."""
    rng = random.Random(5)
    rows = [(i, words(rng, "abcde" if i % 2 else "klmno", 4), "ab" if i % 2 else "kl") for i in range(900)]
    rows += [(900 + i, words(rng, "abcdeklmno", 4), "ab" if i % 3 else "kl") for i in range(100)] + rows[:50]
    df = spark.createDataFrame(rows, ROWS)
    model = li.fit_languages(df, rejected=0.1)
    fold = {r.text: r.fold for r in df.selectExpr("text", f"pmod(xxhash64(text), {li.FOLDS}) as fold").collect()}
    entropies = []
    for f in range(li.FOLDS):
        others = spark.createDataFrame([r for r in rows if fold[r[1]] != f], ROWS)
        counts = li.stage(li.count_grams(others, "text", "lang"), "test-grams")
        part = li.Languages(["ab", "kl"], *li._deal_blocks(li.kneser_ney(counts), ["ab", "kl"], 1 << 20))
        own = spark.createDataFrame([r for r in rows if fold[r[1]] == f], ROWS)
        entropies += [(r.lang, [-s / r.n_units for s in r.sums]) for r in li.score_texts(own, part, keep=["lang"]).collect()]
    assert len(entropies) == len(rows) == 1050
    for i, (name, limit) in enumerate(zip(model.names, model.limits)):
        assert np.isclose(limit, np.quantile([e[i] for lang, e in entropies if lang == name], 0.9), rtol=1e-6)
    e = np.array([x for _, x in entropies])
    truth = np.array([model.names.index(lang) for lang, _ in entropies])
    e -= e.min(axis=1, keepdims=True)
    losses = [(np.log(np.exp(-e * t).sum(axis=1)) + e[np.arange(len(e)), truth] * t).sum() for t in li.SCALES]
    assert model.scale == li.SCALES[int(np.argmin(losses))]


def test_query_against_plain_models_and_held_out_accuracy(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text", "lang").collect()]
    out = {r[0]: zlib.crc32(str(r[0]).encode()) % 4 == 2 for r in rows}
    want = brute([(i, t, None if out[i] else lang) for i, t, lang in rows])
    got = li.op13_language_id(spark, SF_DIR).collect()
    same([(r.doc_id, r.lang_pred, r.cross_entropy) for r in got], want)
    assert all(r.held_out == out[r.doc_id] for r in got)
    truth = {r[0]: r[2] for r in rows}
    held = [r.lang_pred == truth[r.doc_id] for r in got if r.held_out]
    assert sum(held) / len(held) >= 0.97
