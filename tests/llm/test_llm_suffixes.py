"""Suffix arrays, windows and their two users against brute force."""

import random
from collections import Counter

import numpy as np
import pytest
from conftest import CLASHING, passage, sha

from flatproof.llm import repeats, suffix_dedup
from flatproof.llm.substring_dedup import find_repeated_words, remove_repeated_words
from flatproof.llm.suffix_dedup import remove_repeated_bytes
from flatproof.llm.suffixes import previous_smaller, suffix_array


@pytest.mark.parametrize("seed", range(30))
def test_suffix_array(seed):
    rng = random.Random(seed)
    s = [rng.randrange(rng.choice([1, 2, 5, 200])) for _ in range(rng.randrange(0, 300))]
    sa, rank = suffix_array(np.array(s, np.uint64), 8)
    want = sorted(range(len(s)), key=lambda i: s[i:])
    assert sa.tolist() == want
    assert all(rank[i] == p for p, i in enumerate(want))
    depth = rng.randrange(1, 20)
    sa, rank = suffix_array(np.array(s, np.uint64), 8, depth)
    want = sorted(range(len(s)), key=lambda i: (s[i : i + depth], i))
    assert sa.tolist() == want
    heads = {}
    for p, i in enumerate(want):
        heads.setdefault(tuple(s[i : i + depth]), p)
    assert [heads[tuple(s[i : i + depth])] for i in range(len(s))] == rank.tolist()


@pytest.mark.parametrize("seed", range(20))
def test_previous_smaller(seed):
    rng = random.Random(seed)
    v = [rng.randrange(50) for _ in range(rng.randrange(0, 200))]
    want = [max((j for j in range(i) if v[j] < v[i]), default=-1) for i in range(len(v))]
    assert previous_smaller(np.array(v, np.int64)).tolist() == want


@pytest.mark.parametrize("seed", range(20))
def test_reaching_factors(seed):
    rng = random.Random(seed)
    s = [rng.randrange(2) for _ in range(150)]
    length = rng.randrange(1, 9)
    found = suffix_dedup.reaching_factors(np.array(s, np.uint64), 2, length)
    for i in range(len(s)):
        factor = s[i : i + length]
        assert found[i] == (len(factor) == length and any(s[j : j + length] == factor for j in range(i))) or len(factor) < length


@pytest.mark.parametrize("seed", range(20))
def test_runs_hold_every_window_once_and_depend_on_content_alone(seed):
    rng = random.Random(seed)
    length, gram = rng.choice([(5, 2), (8, 3), (20, 6), (4, 3)])
    pieces = [np.array([rng.randrange(3) for _ in range(rng.randrange(0, 60))], np.uint64) for _ in range(6)]
    pieces = [repeats.mixed(p + np.uint64(1)) for p in pieces]
    up, down = repeats.powers(repeats.BASE, 1000), repeats.powers(repeats.BASE_INVERSE, 1000)
    runs = repeats.window_runs(pieces, length, gram, up, down)
    seen = Counter()
    anchors = {}
    for p, s, n, a, k in zip(runs.piece, runs.start, runs.count, runs.anchor, runs.key):
        assert 1 <= n <= length - gram + 1
        for w in range(s, s + n):
            seen[p, w] += 1
            content = tuple(pieces[p][w : w + length].tolist())
            assert len(content) == length
            assert anchors.setdefault(content, (k, s + a - w)) == (k, s + a - w)
    assert seen == Counter({(p, w): 1 for p, x in enumerate(pieces) for w in range(len(x) - length + 1)})


def brute_bytes(rows, length):
    """Rows (id, text) that differ in id or text, in their order."""
    rows = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), {}
    for doc_id, text in rows:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for i in range(len(b) - length + 1):
            if b[i : i + length] in seen:
                gone[i : i + length] = True
            seen.add(b[i : i + length])
        kept = bytes(c for c, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out[doc_id, text] = (doc_id, len(b), len(b) - len(kept), spans, sha(kept))
    return out


def brute_words(rows, length):
    rows = set(rows)
    split = {r: (r[1] or "").encode().split() for r in rows}
    seen = Counter(tuple(w[i : i + length]) for w in split.values() for i in range(len(w) - length + 1))
    out = {}
    for r, w in split.items():
        gone = np.zeros(len(w), bool)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = True
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[r] = (r[0], len(w), int(gone.sum()), sha(kept))
    return out


def random_rows(rng, sep, letters):
    """Texts of shared and own stretches over a small alphabet."""
    shared = [sep.join(rng.choice(letters) for _ in range(rng.randrange(3, 60))) for _ in range(4)]
    rows = []
    for i in range(40):
        parts = [rng.choice(shared) if rng.random() < 0.6 else sep.join(rng.choice(letters) for _ in range(rng.randrange(1, 30)))
                 for _ in range(rng.randrange(0, 6))]
        rows.append((i, sep.join(parts) if parts else rng.choice([None, ""])))
    return rows + [(i, t) for i, t in rows[:3]]


def byte_report(df):
    return sorted((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in df.collect())


def word_report(df):
    return sorted((r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in df.collect())


@pytest.mark.parametrize(
    "seed, limit, block, held", [(1, 4096, 1 << 20, 1 << 20), (2, 1, 1 << 20, 5), (3, 4096, 64, 5), (4, 1, 64, 1), (5, 3, 1 << 20, 20)]
)
def test_removal_against_brute_force(spark, docs_of, monkeypatch, seed, limit, block, held):
    """Also with anchors split into single windows, with texts cut into pieces, and with buckets that hold few runs."""
    monkeypatch.setattr(repeats, "HELD_RUNS", held)
    monkeypatch.setattr(repeats.Plan, "group_limit", limit)
    monkeypatch.setattr(repeats.Plan.__init__, "__defaults__", (limit,))
    monkeypatch.setattr(repeats, "BLOCK", block)
    rng = random.Random(seed)
    rows = random_rows(rng, "", "abc")
    want = brute_bytes(rows, 12)
    got = byte_report(remove_repeated_bytes(docs_of(rows), 12))
    assert got == sorted(want[r] for r in rows)
    rows = random_rows(rng, " ", ["ab", "c", "dd"])
    want = brute_words(rows, 9)
    assert word_report(find_repeated_words(docs_of(rows), 9)) == sorted(want[r] for r in rows)


def key(row):
    return tuple((x is None, x) for x in row)


def test_odd_documents(docs_of, odd_rows):
    docs = docs_of(odd_rows, CLASHING)
    # The order of two texts of one id is that of a hash, which brute force doesn't know; they share no string.
    want = brute_bytes(odd_rows, 100)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in remove_repeated_bytes(docs).collect()]
    assert sorted(got, key=key) == sorted((want[r] for r in odd_rows), key=key)
    want = brute_words(odd_rows, 35)
    got = [(r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in find_repeated_words(docs).collect()]
    assert sorted(got, key=key) == sorted((want[r] for r in odd_rows), key=key)


def test_cut_documents_keep_rows_columns_and_what_is_clean(docs_of, odd_rows):
    docs = docs_of(odd_rows, CLASHING)
    out = remove_repeated_words(docs)
    assert out.columns == docs.columns
    before = sorted(map(tuple, docs.drop("text", "n_chars").collect()), key=key)
    assert sorted(map(tuple, out.drop("text", "n_chars").collect()), key=key) == before
    texts = {}
    for r in out.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
        assert r.n_chars == (None if r.text is None else len(r.text))
    assert texts[1] == texts[2] == [""] and texts[3] == ["", ""] and texts[14] == [""]
    assert texts[4] == [None] and texts[5] == [""] and texts[6] == [" \t\n\x0b\x0c\r "] and texts[7] == ["one"]
    shared = odd_rows[-1][1]
    assert texts[8][0] == odd_rows[10][1].replace(shared, "").replace("\n\n", "\n")
    assert sorted(texts[9]) == sorted([odd_rows[11][1].replace(" " + shared, ""), odd_rows[12][1]])
    assert texts[10] == [odd_rows[13][1]]


def test_empty_tables(docs_of):
    docs = docs_of([])
    assert remove_repeated_bytes(docs).collect() == []
    assert find_repeated_words(docs).collect() == []
    assert remove_repeated_words(docs).columns == docs.columns


def test_one_text_in_a_third_of_all_rows_reaches_a_bucket_once_per_batch(docs_of):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text if i % 3 == 0 else f"{i} " * 40) for i in range(300)]
    got = {r.doc_id: r.n_removed for r in find_repeated_words(docs_of(rows)).collect()}
    assert all(got[i] == 60 for i in range(0, 300, 3)) and all(got[i] == 40 for i in range(1, 300, 3))
    plan = repeats.Plan(5, 2, True, suffix_dedup.byte_symbols)
    ids = np.arange(100)
    up, down = repeats.powers(repeats.BASE, repeats.BLOCK + 1), repeats.powers(repeats.BASE_INVERSE, repeats.BLOCK + 1)
    batch = repeats._batch_runs(ids, ids * 0, [b"one and the same"] * 100, plan, suffix_dedup.byte_symbols(), up, down)
    moving = batch["flag"] != repeats.DONE
    assert moving.sum() == len(np.unique(batch["content"])) and set(batch["id"][moving]) == {0}


def test_ids_at_the_end_and_many_texts_without_an_id(spark, docs_of):
    last, text = 2**63 - 1, passage(1, 80)
    rows = [(last, text), (last, passage(2, 90)), (1, text)] + [(None, passage(3 + i, 50) + chr(0x4E00 + i * 67) + text) for i in range(30)]
    want = brute_bytes(rows, 100)
    got = [(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))) for r in remove_repeated_bytes(docs_of(rows)).collect()]
    assert sorted(got, key=key) == sorted((want[r] for r in rows), key=key)
    want = brute_words(rows, 35)
    got = [(r.doc_id, r.n_words, r.n_removed, sha(bytes(r.kept))) for r in find_repeated_words(docs_of(rows)).collect()]
    assert sorted(got, key=key) == sorted((want[r] for r in rows), key=key)


@pytest.mark.parametrize("keep_first", [True, False])
def test_a_hot_anchor_stays_within_bounds(monkeypatch, keep_first):
    """One short passage in 100,000 different texts: a bucket holds a bounded number of their runs, and none is lost."""
    monkeypatch.setattr(repeats, "HELD_RUNS", 4096)
    plan = repeats.Plan(35, 10, keep_first, suffix_dedup.byte_symbols)
    bucket, most, out = repeats.Bucket(plan), 0, Counter()
    other = np.arange(2000, dtype=np.uint64) % 50
    for part in range(50):
        rows = {c: np.zeros(2000, k) for c, k in repeats._COLUMNS}
        rows["key"] = np.concatenate([np.full(1950, 7, np.uint64), other[:50] + np.uint64(100)])
        rows["content"] = np.concatenate([repeats.mixed(np.arange(1950, dtype=np.uint64) + np.uint64(1950 * part)), other[:50]])
        rows["id"], rows["count"] = np.arange(2000) + 2000 * part, np.full(2000, 3)
        for kind, found in bucket.add(rows):
            out[kind] += len(found["key"])
        most = max(most, bucket.held)
    for kind, found in bucket.close():
        out[kind] += len(found["key"])
    assert most <= 4096 + 2000
    assert out[repeats.HOT] == 50 * 1950
    assert out[repeats.SPAN] == (49 * 50 if keep_first else 50 * 50) and out[repeats.NEED] == 0


def test_text_moves_once(spark, docs_of):
    docs = docs_of([(i, f"text {i} " * 50) for i in range(50)])
    plan = remove_repeated_bytes(docs)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan
    for found in (remove_repeated_bytes(docs), find_repeated_words(docs), remove_repeated_words(docs)):
        found.collect()
        assert "ReusedExchange" in found._jdf.queryExecution().executedPlan().toString()
