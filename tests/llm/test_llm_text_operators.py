"""Token counts, decontamination, quality and chat windows."""

import hashlib
import json
import random
import tracemalloc
import re

import numpy as np
import public_tokenizers
import pytest
from conftest import CLASHING, passage, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flatproof.llm import chat, decontamination, quality, tokens

JSON = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(JSON)


def library_count(text, path=JSON):
    if path.endswith(".model"):
        import sentencepiece

        return len(sentencepiece.SentencePieceProcessor(model_file=path).encode(text or ""))
    tokenizer = LIBRARY if path == JSON else Tokenizer.from_file(path)
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


ODD_TEXTS = [
    "", " ", "  ", "a  b", " a", "a ", "a\n b", "a \n b", "a\t b c", "it's we'll I 'd 's", "x <|endoftext|> y", "<|endoftext|>",
    "<|endoftext|", "a\u00a0 b", "a \u00a0b", "a\u2003b c\u3000 d", "1 22 333 4x5", "... !!! a.b c,d", "é ñ 漢字 かな", "a\x1c b", "a\x85 b \x85c",
    "tab\tnew\r\nline", "\u200b zero", "🙂 🙂🙂 a", "a\ufeff b", "\x00 \x00", "don't can't  won't",
]


@pytest.mark.parametrize("seed", range(5))
def test_counting_by_piece_is_counting_whole(seed):
    rng = random.Random(seed)
    bits = [*ODD_TEXTS, "the", "and", " ", "\n", "  ", "'s", "abc", "É", "12", "\u00a0", "\u2009", "--"]
    texts = ["".join(rng.choice([*bits, " "]) for _ in range(rng.randrange(1, 30))) for _ in range(300)] + ODD_TEXTS
    with open(JSON, "rb") as file:
        count = tokens.text_counter("x.json", file.read())
    assert count(texts) == [library_count(t) for t in texts]


def test_pieces_make_up_the_text():
    for t in ODD_TEXTS:
        assert "".join(tokens._plain_split(t)) == t


def test_only_plain_byte_level_tokenizers_count_by_piece():
    with open(JSON) as file:
        config = json.load(file)
    assert tokens.counts_by_piece(config)
    assert not tokens.counts_by_piece({**config, "normalizer": {"type": "NFC"}})
    assert not tokens.counts_by_piece(json.load(open(public_tokenizers.path("word_bpe_49k.json"))))


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts(docs_of, odd_rows, tmp_path, name):
    path = public_tokenizers.path(name)
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 100_000]
    docs = docs_of(rows, CLASHING)
    out = tokens.count_tokens(docs, path, str(tmp_path / "cache"))
    got = sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in out.collect())
    want = [(str(i), len((t or "").encode()), library_count(t, path)) for i, t in rows]
    assert got == sorted((*w, w[2] > 512) for w in want)
    assert set(out.columns) == {*docs.columns, "n_bytes", "n_tokens", "over_limit"}


def test_cache_encodes_only_what_it_lacks(spark, docs_of, tmp_path):
    cache = str(tmp_path / "cache")
    stored = lambda: sorted(map(tuple, spark.read.parquet(cache).collect()))
    first = docs_of([(1, "one text"), (2, "one text"), (3, None), (4, "")])
    tokens.count_tokens(first, JSON, cache).collect()
    assert len(stored()) == 2
    before = stored()
    tokens.count_tokens(first, JSON, cache).collect()
    assert stored() == before
    more = docs_of([(1, "one text"), (5, "another text"), (6, "another text")])
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(more, JSON, cache).collect()}
    assert len(stored()) == 3 and got == {1: library_count("one text"), 5: 2, 6: 2}
    # A stored count is used as it is, and not that of another tokenizer.
    digest = hashlib.sha256(b"told").hexdigest()
    told = spark.createDataFrame([(digest, tokens.tokenizer_digest(JSON), 99), (digest, "other", 7)], tokens.CACHE_SCHEMA)
    told.unionByName(told).write.mode("append").parquet(cache)
    assert tokens.count_tokens(docs_of([(1, "told")]), JSON, cache).first().n_tokens == 99
    upper = tokens.count_tokens(docs_of([(1, "TOLD"), (2, "told")]), JSON, cache, normalise=F.lower)
    assert [r.n_tokens for r in upper.collect()] == [99, 99]


def test_no_documents_to_count(docs_of, tmp_path):
    assert tokens.count_tokens(docs_of([]), JSON, str(tmp_path / "cache")).collect() == []


# Decontamination.


def brute_contamination(rows, items, window=10):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    words = lambda t: pattern.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    out = []
    for doc_id, text in rows:
        w, hit, names = words(text), set(), set()
        for name, item in items:
            x = words(item)
            n = min(window, len(x))
            for i in range(len(x) - n + 1 if x else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == x[i : i + n]:
                        hit.update(range(j, j + n))
                        names.add("null" if name is None else str(name))
        out.append((doc_id, len(w), sorted(hit), sorted(names)))
    return sorted(out, key=lambda r: (r[0] is None, r))


def items_table(spark, items):
    return spark.createDataFrame(items, "item_id bigint, text string")


def contamination(df):
    out = [(r.doc_id, r.n_words, sorted(p for s in r.spans for p in range(s.start, s.stop)), r["items"]) for r in df.collect()]
    return sorted(out, key=lambda r: (r[0] is None, r))


def test_fm_index_against_brute_force():
    rng = random.Random(0)
    for _ in range(60):
        sigma = rng.choice([2, 3, 6, 40])
        s = [rng.randrange(sigma) for _ in range(rng.randrange(1, 400))]
        index = decontamination.FMIndex(np.array(s), sigma)
        patterns = [[rng.randrange(1, sigma) for _ in range(rng.randrange(1, 5))] for _ in range(30)]
        filled = np.array([[0] * (5 - len(p)) + p for p in patterns])
        low, high = index.search(filled, np.array([len(p) for p in patterns]))
        for p, a, b in zip(patterns, low, high):
            want = [i for i in range(len(s) - len(p) + 1) if s[i : i + len(p)] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


@pytest.mark.parametrize("seed, blocks, piece", [(1, 1 << 24, 1 << 20), (2, 40, 1 << 20), (3, 1 << 24, 30), (4, 40, 30)])
def test_contamination_against_brute_force(spark, docs_of, monkeypatch, seed, blocks, piece):
    """Also with the benchmark in several blocks, and with texts cut into pieces."""
    monkeypatch.setattr(decontamination, "BENCHMARK_BYTES", blocks)
    monkeypatch.setattr(decontamination, "PIECE", piece)
    rng = random.Random(seed)
    word = lambda: rng.choice(["a", "B", "cc", "d1", "é", "ZZ"])
    sep = lambda: rng.choice([" ", ", ", "-", "\n", " \x7f"])
    items = [(i, "".join(word() + sep() for _ in range(rng.choice([1, 2, 4, 8, 12])))) for i in range(12)]
    items += [(None, "a b cc d1"), (50, None), (51, ""), (52, " ..."), (3, "same id other text")]
    rows = [(i, "".join(word() + sep() for _ in range(rng.randrange(0, 80)))) for i in range(60)] + [(7, None), (8, "")]
    got = contamination(decontamination.find_contamination(docs_of(rows), items_table(spark, items), window=4))
    assert got == brute_contamination(rows, items, 4)


def test_contamination_of_odd_documents(spark, docs_of, odd_rows):
    items = [(1, odd_rows[-1][1]), (2, "one"), (10, passage(2, 80)[:200]), (11, "no such words here")]
    docs = docs_of(odd_rows, CLASHING)
    out = decontamination.find_contamination(docs, items_table(spark, items))
    assert contamination(out) == brute_contamination(odd_rows, items)
    assert set(out.columns) == {*docs.columns, "n_words", "spans", "items"}
    none = decontamination.find_contamination(docs, items_table(spark, []))
    assert contamination(none) == brute_contamination(odd_rows, [])
    assert decontamination.find_contamination(docs_of([]), items_table(spark, items)).collect() == []


def test_decontaminate_cuts_spans_and_leaves_the_rest(spark, docs_of):
    item = passage(20, 14)
    rows = [(1, f"Before it. {item.upper()}! And after."), (2, item), (3, "clean text,\n  kept as it is "), (4, None), (5, "")]
    for blocks in (1 << 24, 10):
        docs = docs_of(rows, ["spans", "cleaned"])
        out = decontamination.decontaminate(docs, items_table(spark, [(1, item), (2, "other words")]))
        assert out.columns == docs.columns
        got = {r.doc_id: r for r in out.collect()}
        assert got[1].text == "Before it. ! And after." and got[2].text == "" and got[3].text == rows[2][1]
        assert got[4].text is None and got[5].text == ""
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got.values())


# Quality.


def test_quality_learns_and_keeps_clean_documents(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = quality.op3_quality_trees(spark, sf_dir).join(labels, "doc_id").collect()
    unseen = [r for r in scored if r.held_out]
    assert len(unseen) > 50
    assert sum(r.predicted == r.quality for r in unseen) / len(unseen) >= 0.95
    assert all(r.predicted == 1 for r in scored if r.quality == 1)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in scored)


def test_held_out_rows_are_never_learnt_from(spark, docs_of):
    from zlib import crc32

    rows = [(i, passage(i, 30) if i % 2 else "$$$ %%% " * 20) for i in range(200)]
    docs = docs_of(rows)
    out = {i for i, _ in rows if crc32(str(i).encode()) % 5 == 0}
    right = [(i, i % 2) for i, _ in rows]
    wrong = [(i, 1 - i % 2 if i in out else i % 2) for i, _ in rows]
    models = [quality.fit_quality(docs, spark.createDataFrame(x, "doc_id bigint, quality int")) for x in (right, wrong)]
    texts = [r.score for r in quality.score_quality(docs, models[0]).orderBy("doc_id").collect()]
    assert texts == [r.score for r in quality.score_quality(docs, models[1]).orderBy("doc_id").collect()]
    assert all((s >= 0.3) == bool(i % 2) for i, s in enumerate(texts))


def test_flat_trees_are_walked_like_trees():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, len(quality.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 3] > 0.5)).astype(float)
    model = quality.fit_trees(x, y, trees=30, depth=4, least=5)

    def walk(row):
        total = model.base
        for node in model.roots:
            while model.feature[node] >= 0:
                node = (model.left if row[model.feature[node]] <= model.limit[node] else model.right)[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose(model.scores(x), [walk(r) for r in x])
    assert ((model.scores(x) >= 0.5) == y).mean() > 0.97


def test_quality_of_odd_documents(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows, CLASHING)
    labels = "doc_id bigint, quality int"
    rows = [(1, 1), (1, 1), (2, 0), (None, 1), (3, None), (7, 1), (10, 0), (11, 1), (99, 1)]
    for some in (rows, [], [(1, 1), (2, 1)]):
        model = quality.fit_quality(docs, spark.createDataFrame(some, labels))
        out = quality.score_quality(docs, model)
        assert set(out.columns) == set(docs.columns)  # "score" is replaced
        got = out.collect()
        assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
        assert len({r.score for r in got if not r.text}) == 1
    assert quality.score_quality(docs_of([]), model).collect() == []
    assert quality.fit_quality(docs_of([]), spark.createDataFrame(rows, labels)).scores(np.zeros((1, 20))) == [0.5]


def test_training_sample_is_bounded(spark, docs_of):
    docs = docs_of([(i, passage(i, 5)) for i in range(300)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(300)], "doc_id bigint, quality int")
    seen = []
    original = quality.fit_trees
    quality.fit_trees = lambda x, y: seen.append(len(y)) or original(x, y)
    try:
        quality.fit_quality(docs, labels, train_rows=50)
    finally:
        quality.fit_trees = original
    assert seen == [50]


def test_training_rows_are_bounded_where_ids_repeat(spark, docs_of):
    docs = docs_of([(i % 2, passage(i, 5)) for i in range(900)] + [(5, "one and the same")] * 300)
    labels = spark.createDataFrame([(0, 1), (1, 0), (5, 1), (3, 0)], "doc_id bigint, quality int")
    assert not any(r[0] for r in labels.select(quality.held_out(F.col("doc_id"))).where("doc_id < 2").collect())
    seen = []
    original = quality.fit_trees
    quality.fit_trees = lambda x, y: seen.append(len(y)) or original(x, y)
    try:
        for most in (40, 10_000):
            quality.fit_quality(docs, labels, train_rows=most)
    finally:
        quality.fit_trees = original
    assert 10 <= seen[0] <= 40 and seen[1] >= 900


# Chat windows.

TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_digest(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort()
        loss = "".join(t for _, _, r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for _, _, r, t in turns)), len(loss), sha(loss))
    return out


def odd_conversations():
    rng = random.Random(5)
    bits = ["\\", "#", "<", "</turn>", "### ", "### 0 user: ", "\n", "a", ": ", "é🙂", " ", "\\\\#", "</turn>\n### 1 assistant: x"]
    rows = []
    for conv in range(25):
        start = rng.random() < 0.4
        for turn in range(rng.randrange(1, 40)):
            role = "system" if turn == 0 and start else ["user", "assistant"][turn % 2]
            rows.append((conv, turn, role, "".join(rng.choice(bits) for _ in range(rng.randrange(0, 60)))))
    rows += [(None, 0, "user", "x"), (None, 1, "assistant", None), (100, None, None, None), (101, 0, "as: sis#t<ant", "y"),
             (102, 0, "assistant", passage(1, 5000)), (102, 1, "assistant", "after a turn above the budget"), (103, 1, "user", "tie"),
             (103, 1, "user", "tie"), (103, 1, "assistant", "tie"), (104, 0, "system", passage(2, 300)), (104, 1, "user", "u"),
             (104, 2, "assistant", passage(3, 300)), (105, 0, "user", "")]
    return rows + [(106, i, ["user", "assistant"][i % 2], f"turn {i}") for i in range(3000)]


@pytest.fixture(scope="module")
def windows(spark):
    rows = odd_conversations()
    turns = spark.createDataFrame(rows, TURNS).repartition(5)
    return rows, chat.format_conversations(turns, JSON, budget=200, history=60, bare_tokens=True).cache()


def test_conversations_read_back(windows):
    rows, made = windows
    got = {r.conv_id: r for r in chat.read_back(made).collect()}
    want = brute_digest(rows)
    assert got.keys() == want.keys()
    for conv, r in got.items():
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == want[conv]
    lengths = {}
    for r in made.collect():
        lengths[r.conv_id] = lengths.get(r.conv_id, 0) + len(r.text)
    assert {c: r.formatted_chars for c, r in got.items()} == lengths


def test_windows_keep_the_budget_the_system_turn_and_the_history(windows):
    rows, made = windows
    counts = {}
    for r in made.orderBy("conv_id", "window").collect():
        turns = chat.parse_window(r.text)
        numbers = [t[0] for t in turns]
        span = list(range(r.first_turn, r.last_turn + 1))
        assert numbers[-len(span) :] == span and numbers == sorted(set(numbers))
        tokens_of = [library_count(t[2]) for t in turns]
        assert r.n_tokens == sum(tokens_of)
        repeated = [t for t in turns if t[0] < r.first_turn]
        system = [t for t in repeated if t[0] == 0 and t[1] == "system"]
        conv = sorted((x for x in rows if x[0] == r.conv_id), key=lambda x: (x[1] is not None, x[1] or 0, x[2] or ""))
        if conv[0][2] == "system" and r.first_turn > 0:
            assert len(system) == 1
        history = [t for t in repeated if t not in system]
        assert [t[0] for t in history] == list(range(r.first_turn - len(history), r.first_turn))
        assert sum(library_count(t[2]) for t in history) <= 60
        if len(span) > 1:
            assert r.n_tokens <= 200
        # The mask covers the assistant texts of the span, and only them.
        said = [chat.unescape(r.text[m.start : m.stop]) for m in r.loss]
        assert said == [t[2] for t in turns if t[0] >= r.first_turn and t[1] == "assistant" and t[2]]
        assert counts.setdefault(r.conv_id, 0) == r.first_turn
        counts[r.conv_id] = r.last_turn + 1


def test_whole_windows_keep_the_budget_as_formatted(windows):
    rows, made = windows
    for r in made.collect():
        assert r.window_tokens == library_count(r.text)
        turns = [(t[0], library_count(chat.format_turn(*t)[0])) for t in chat.parse_window(r.text)]
        if r.first_turn < r.last_turn:
            assert r.window_tokens <= 200
        start = 0 if turns[0][0] < r.first_turn and rows_role(rows, r.conv_id) == "system" else -1
        assert sum(n for number, n in turns if start < number < r.first_turn) <= 60


def rows_role(rows, conv):
    return min((t is not None, t or 0, role or "") for c, t, role, _ in rows if c == conv)[2]


def test_empty_turns_fill_windows_too(spark):
    rows = [(1, None, "user", None)] * 1500 + [(1, i, "assistant", "") for i in range(1500)] + [(2, 0, "user", "x")]
    made = chat.format_conversations(spark.createDataFrame(rows, TURNS).repartition(3), JSON, budget=200, history=60)
    got = made.orderBy("conv_id", "window").collect()
    assert all(r.window_tokens == library_count(r.text) <= 200 for r in got)
    spans = [(r.first_turn, r.last_turn) for r in got if r.conv_id == 1]
    assert [a for a, _ in spans] == [0, *(b + 1 for _, b in spans[:-1])] and spans[-1][1] == 2999
    # Windows are well filled: with one more turn each would be above the budget.
    assert all(r.window_tokens > 185 for r in got[:-2])


def test_other_tokenizers_count_the_formatted_turns(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    turns = spark.createDataFrame([(1, i, "user", "a # b <c>") for i in range(50)], TURNS)
    for r in chat.format_conversations(turns, path, budget=100, history=30).collect():
        assert r.window_tokens == sum(len(model.encode(chat.format_turn(*t)[0])) for t in chat.parse_window(r.text)) <= 100


def test_no_conversations_and_clashing_columns(spark):
    turns = spark.createDataFrame([], TURNS)
    assert chat.read_back(chat.format_conversations(turns, JSON)).collect() == []
    more = spark.createDataFrame([(1, 0, "user", "x")], TURNS).selectExpr("*", "'y' tokens", "1 window", "2 loss")
    assert chat.format_conversations(more, JSON).count() == 1


def test_escaping_is_reversible():
    rng = random.Random(1)
    for _ in range(500):
        role, text = ("".join(rng.choice("\\#<:/turn> \na") for _ in range(rng.randrange(12))) for _ in range(2))
        piece, start, stop = chat.format_turn(3, role, text)
        assert chat.parse_window(piece * 2) == [(3, role, text)] * 2
        assert chat.unescape(piece[start:stop]) == text


def test_a_block_of_a_benchmark_takes_bounded_memory():
    """Two megabytes of items: as many times its size as a block of the full size takes."""
    rng = random.Random(7)
    vocabulary = [f"w{i:x}".encode() for i in range(30_000)]
    items = [([str(i)], b" ".join(rng.choices(vocabulary, k=200))) for i in range(1700)]
    tracemalloc.start()
    made = decontamination.Windows(items, 10)
    text = b" ".join(rng.choices(vocabulary, k=20_000)) + b" " + items[3][1]
    _, spans, names = made.hits([text])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert spans[0][-1] == (20_000, 20_200) and "3" in names[0]
    assert peak < 32 * sum(len(t) for _, t in items)


def test_items_with_many_names_and_long_items(spark, docs_of, monkeypatch):
    monkeypatch.setattr(decontamination, "NAMES", 5)
    monkeypatch.setattr(decontamination, "PIECE_BYTES", 64)
    monkeypatch.setattr(decontamination, "BENCHMARK_BYTES", 300)
    rng = random.Random(8)
    long = " ".join(rng.choice(["a", "b", "cc", "dé"]) for _ in range(400))
    items = [(i, "one text of many names") for i in range(40)] + [(100, long), (101, long), (102, "a b")]
    rows = [(1, "x one text of many names y"), (2, long[200:330]), (3, None), (4, "a b cc"), (5, "nothing")]
    got = contamination(decontamination.find_contamination(docs_of(rows), items_table(spark, items), window=4))
    assert got == brute_contamination(rows, items, 4)
