"""SimHash groups, binary top-k, mixing and URL templates against brute force."""

import random
import re
import time
from collections import Counter, defaultdict
from fractions import Fraction

import pytest
import xxhash
from conftest import CLASHING, passage
from pyspark.sql import functions as F

from flatproof.llm import graph, mixing, simhash, topk, url_templates

# SimHash.


def brute_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + shingle]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_groups(prints, max_bits):
    """Group id (smallest id reachable) of each (id, fingerprint)."""
    distinct = sorted({f for _, f in prints})
    root = {f: f for f in distinct}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= max_bits:
                root[find(a)] = find(b)
    least = defaultdict(list)
    for i, f in prints:
        if i is not None:
            least[find(f)].append(i)
    return [(i, f, min(least[find(f)], default=None)) for i, f in prints]


@pytest.mark.parametrize("seed", range(8))
def test_fingerprints(seed):
    rng = random.Random(seed)
    texts = [" ".join(rng.choice(["Ab", "c", "É", "dd\x1f"]) for _ in range(rng.choice([0, 1, 3, 4, 5, 300, 3000]))) for _ in range(20)]
    texts += ["a b c d a b c d\t\n a b c d", " \t", ""]
    got = simhash.fingerprints([t.encode() for t in texts], 4)
    assert got.tolist() == [brute_fingerprint(t) for t in texts]


def unsigned(x):
    return x & (1 << 64) - 1


@pytest.mark.parametrize("max_bits, segments", [(4, 3), (4, 2), (2, 4), (0, 3), (7, 5)])
def test_links_are_complete(spark, max_bits, segments):
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(40)] + [0, 1, (1 << 64) - 1]
    for p in prints[:25]:
        for _ in range(6):
            for b in rng.sample(range(64), rng.randrange(1, max_bits + 3)):
                p ^= 1 << b
            prints.append(p)
    prints = sorted(set(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = simhash.near_links(spark.createDataFrame(signed, "fp bigint"), max_bits, segments).collect()
    got = {tuple(sorted((unsigned(r.u), unsigned(r.v)))) for r in links}
    assert got == {(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= max_bits}
    assert len(got) == len(links)


def test_components_of_chains_stars_and_rings(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)] + [(2000 + i, 2000 + (i + 1) % 7) for i in range(7)]
    links += [(5000, 5000), (-3, -9), (3000, 3001), (3001, 3000)]
    rng = random.Random(0)
    rng.shuffle(links)
    got = dict(map(tuple, graph.connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()))
    want = {i: 0 for i in range(61)} | {1000 + i: 1000 for i in range(50)} | {2000 + i: 2000 for i in range(7)}
    assert got == want | {-3: -9, -9: -9, 3000: 3000, 3001: 3000}
    assert graph.connected_components(spark.createDataFrame([], "u bigint, v bigint")).collect() == []


def near_copy(rng, text):
    words = text.split()
    words[rng.randrange(len(words))] = "changed"
    return " ".join(words)


def test_groups_against_brute_force(docs_of, odd_rows):
    rng = random.Random(3)
    rows = list(odd_rows)
    for i in range(40):
        base = passage(100 + i % 8, 300)
        rows.append((100 + i, near_copy(rng, base) if i % 3 else base))
    docs = docs_of(rows, CLASHING)
    got = [(r.doc_id, unsigned(r.fp), r.component_id) for r in simhash.near_duplicates(docs).collect()]
    want = brute_groups([(i, brute_fingerprint(t)) for i, t in rows], 4)
    order = lambda r: (r[0] is None, r[0] or 0, r[1])
    assert sorted(got, key=order) == sorted(want, key=order)
    assert simhash.near_duplicates(docs_of([])).collect() == []
    assert simhash.keep_first_of_groups(docs_of([])).collect() == []


def test_of_equal_rows_the_least_stays(docs_of):
    text = passage(1, 40)
    rows = [(1, text, "c"), (1, text, "a"), (1, text, "b"), (2, text, "z"), (3, passage(2, 40), "x")]
    for _ in range(2):
        rows.reverse()
        kept = simhash.keep_first_of_groups(docs_of(rows, ["row"]))
        assert sorted((r.doc_id, r.source) for r in kept.collect()) == [(1, "a"), (3, "x")]


# Binary top-k.


def brute_topk(codes, queries, k):
    out = []
    for q, a in queries:
        if q is None or a is None:
            continue
        near = sorted(((a ^ c) & (1 << 64) - 1).bit_count() * (1 << 70) + i for i, c in codes if i is not None and c is not None)
        out += [(q, p + 1, n % (1 << 70), n >> 70) for p, n in enumerate(near[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed, k, code_block, query_block", [(1, 10, 1 << 17, 1 << 14), (2, 1, 50, 20), (3, 25, 50, 1 << 14), (4, 300, 1 << 17, 7)])
def test_topk_against_brute_force(spark, seed, k, code_block, query_block):
    """Also with several blocks, with copies of a code, and with fewer codes than places."""
    rng = random.Random(seed)
    some = [rng.getrandbits(64) - (1 << 63) for _ in range(60)]
    codes = [(i, rng.choice(some) ^ (1 << rng.randrange(63)) if rng.random() < 0.7 else some[0]) for i in range(250)]
    codes += [(None, 5), (900, None)]
    table = spark.createDataFrame(codes, "id bigint, code bigint").selectExpr("*", "1 place", "2 distance", "3 n")
    queries = [c for c in codes if c[0] is None or c[0] % 20 == 0] + [(1000, 12345)]
    asked = spark.createDataFrame(queries, "id bigint, code bigint")
    found = topk.nearest_codes(table, asked, k, code_block=code_block, query_block=query_block)
    assert sorted((r.query_id, r.place, r.id, r.distance) for r in found.collect()) == brute_topk(codes, queries, k)


def test_topk_of_nothing(spark):
    none = spark.createDataFrame([], "id bigint, code bigint")
    one = spark.createDataFrame([(1, 7)], "id bigint, code bigint")
    assert topk.nearest_codes(none, one).collect() == [] and topk.nearest_codes(one, none).collect() == []
    assert [tuple(r) for r in topk.nearest_codes(one, one).collect()] == [(1, 1, 1, 0)]


def test_topk_stops_early_only_where_all_nearer_codes_are_seen():
    import numpy as np

    rng = np.random.default_rng(0)
    codes = rng.integers(0, 1 << 16, 3000).astype(np.uint64)
    codes = np.unique(codes)
    queries = rng.integers(0, 1 << 16, 50).astype(np.uint64)
    place, distance, code = topk.search_block(codes, np.ones(len(codes), np.int64), queries, 5, 16)
    for q in range(50):
        every = np.sort(np.bitwise_count(codes ^ queries[q]))
        assert sorted(distance[place == q])[:5] == every[:5].tolist()


def test_sign_codes(spark):
    rows = [(1, [1.0, -1.0, 0.0, 2.0]), (2, [0.0] * 63 + [1.0]), (3, None), (4, []), (5, [None, 1.0, float("nan")])]
    table = spark.createDataFrame(rows, "id bigint, v array<float>")
    got = {r.id: r.c for r in table.select("id", topk.sign_code(F.col("v")).alias("c")).collect()}
    assert got == {1: 9, 2: -(1 << 63), 3: None, 4: 0, 5: 2}


# Mixing.


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Exact targets by resharing the excess again and again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, capped = sum(sizes.values()), set()
    while True:
        left = total - sum(cap * sizes[s] for s in capped)
        w = sum(weight[s] for s in names if s not in capped)
        target = {s: Fraction(cap * sizes[s]) if s in capped else Fraction(left * weight[s], w) for s in names}
        over = {s for s in names if target[s] > cap * sizes[s]}
        if not over:
            return target
        capped |= over


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mixed_rows(seed):
    rng = random.Random(seed)
    names = ["a", "b", "ä", "Z", None, "z9", "", "tiny"]
    return [(i, "w " * rng.randrange(0, 90), rng.choices(names, [40, 5, 5, 1, 5, 1, 3, 0.3])[0]) for i in range(900)]


@pytest.mark.parametrize("seed", range(3))
def test_mixture(docs_of, seed):
    rows = mixed_rows(seed) + [(5, "w w", "a"), (5, "w w", "a"), (None, None, "a"), (None, "x y", None), (7, "", "empty source")]
    docs = docs_of(rows, CLASHING)
    got = mixing.mix_sources(docs).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += words(text)
    target = brute_targets(sizes)
    taken = Counter()
    for r in got:
        assert r.size == words(r.text) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(float(target[r.source]), rel=1e-12)
        assert r.taken == r.copies * r.size and 0 <= r.copies <= 3
        each = target[r.source] / sizes[r.source] if sizes[r.source] else 0
        assert int(each) <= r.copies <= -(-each // 1)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 2 * 90
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix_sources(docs.repartition(7)).collect()))
    copies = mixing.emit_copies(mixing.mix_sources(docs))
    assert copies.count() == sum(r.copies for r in got)


def test_mixture_of_nothing(docs_of):
    assert mixing.mix_sources(docs_of([])).collect() == []
    got = mixing.mix_sources(docs_of([(1, None), (2, " ")])).collect()
    assert [(r.target, r.copies) for r in got] == [(0.0, 0)] * 2


def test_a_lone_source_is_taken_once(docs_of):
    got = mixing.mix_sources(docs_of([(i, "a b c") for i in range(50)])).collect()
    assert all(r.copies == 1 for r in got)


# URLs.


def split_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute_rule(host, path, rules):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: len(r.text), default=None)


URLS = [
    "http://a.example.com/de/5?x=1", "https://EXAMPLE.net/en/1#t", "https://example.net/fr/1", "http://x.net", "http://x.net/",
    "http://y.org/fr/2", "http://y.org/en/2", "http://notnet/en/", "http://badexample.com/de/1", "ftp://a.b/c://d.net/x", "no url", "",
    None, "://", "http://", "http://?q", "http://h#f/x", "http://h/p\nq/r?s", "http://ÄÖ.net/x", "http://u@x.net:80/", "http://e.com//a///b/",
    "http://example.com/de", "http://example.com/de/", "http://" + "s/" * 3000,
]


def test_urls_and_rules(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id bigint, url string")
    pages = pages.selectExpr("*", "'x' as host", "'y' as shape", "'z' as template", "1 as id", "2 as row")
    labels = spark.createDataFrame([], "id bigint, bad boolean")
    out = url_templates.filter_urls(pages, labels)
    for r in out.collect():
        assert (r.host, r.path) == split_url(r.url)
        rule = brute_rule(r.host, r.path, url_templates.RULES)
        assert r.rule == (rule.text if rule else None)
        assert r.verdict == (rule.verdict if rule else "allow")
        assert r.template is not None and r.template_bad == 0
    assert out.count() == len(URLS)


def test_templates(spark):
    rows, labels = [], []

    def add(url, n, labelled=0, bad=0):
        for i in range(n):
            rows.append((len(rows), url.format(i)))
            if i < labelled:
                labels.append((len(rows) - 1, i < bad))

    add("http://h.org/shop/{}", 40, 30, 28)  # bad branch
    add("http://h.org/news/{}.html", 60, 40, 1)  # good branch
    add("http://h.org/blog/{}.html", 60, 40, 2)  # like the other good one
    add("http://u.org/user{}/post", 50, 10, 1)  # names: one variable segment
    add("http://v.org/a", 5, 5, 5)
    add("http://few.org/x", 3, 1, 1)  # one bad page is no proof
    add("http://d.org/1/2/3/4/5/6/7/8/9/{}", 5)
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    marks = spark.createDataFrame(labels + [(None, True), (10**9, True)], "id bigint, bad boolean")
    got = url_templates.filter_urls(pages, marks.unionByName(marks), rules=()).collect()
    found = {(r.host, r.path.split("/")[1][:4]): (r.template, r.verdict) for r in got}
    assert found["h.org", "shop"][1] == "block"
    assert found["h.org", "news"][1] == found["h.org", "blog"][1] == "allow"
    assert {r.template for r in got if r.host == "u.org"} == {"/*/post"}
    assert found["v.org", "a"][1] == "block" and found["few.org", "x"][1] == "allow"
    assert {r.template for r in got if r.host == "d.org"} == {"/{num}" * 6 + "/**"}
    assert url_templates.filter_urls(spark.createDataFrame([], "page_id bigint, url string"), marks).collect() == []


def planted(spark, *sites):
    """The pages of filter_urls from (url, pages, labelled, bad)."""
    rows, labels = [], []
    for url, n, labelled, bad in sites:
        for i in range(n):
            rows.append((len(rows), url.format(i)))
            if i < labelled:
                labels.append((len(rows) - 1, i < bad))
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    return url_templates.filter_urls(pages, spark.createDataFrame(labels, "id bigint, bad boolean"), rules=()).collect()


def test_a_heavy_section_among_many_one_page_slugs_stands_alone(spark):
    got = planted(
        spark, ("http://s.org/name{}/1", 300, 300, 15), ("http://s.org/casino/{}", 150, 150, 148), ("http://s.org/little/{}", 6, 6, 6),
        ("http://r.org/name{}/1", 300, 300, 285), ("http://r.org/docs/{}", 150, 150, 2),
    )
    found = {}
    for r in got:
        found.setdefault((r.host, r.path.split("/")[1][:4]), set()).add((r.template, r.verdict))
    assert found["s.org", "casi"] == {("/casino/{num}", "block")}
    assert found["s.org", "litt"] == {("/little/{num}", "block")}
    assert found["s.org", "name"] == {("/*/{num}", "allow")}
    assert found["r.org", "docs"] == {("/docs/{num}", "allow")}
    assert found["r.org", "name"] == {("/*/{num}", "block")}


def test_pages_that_differ_deep_in_their_paths(spark):
    got = planted(
        spark, ("http://e.org/a/b/c/d/e/f/spam/{}", 40, 40, 39), ("http://e.org/a/b/c/d/e/f/docs/{}", 70, 70, 1),
        ("http://e.org/a/b/c/d/e/f", 5, 5, 0),
        # Below a variable segment, and beside a closed node.
        ("http://w.org/1/2/3/4/5/6/name{}/x/spam/1/2", 40, 40, 39), ("http://w.org/1/2/3/4/5/6/name{}/x/docs/1/2", 70, 70, 1),
        ("http://w.org/own/2/3/4/5/6/7/8/{}", 9, 9, 9), ("http://w.org/own/2/3/4/5/6/7/9/z{}", 9, 9, 9),
    )
    n = "/{num}"
    assert {r.verdict for r in got if "spam" in r.path} == {"block"} and {r.verdict for r in got if "docs" in r.path} == {"allow"}
    assert {r.template for r in got if r.host == "e.org" and "spam" in r.path} == {"/a/b/c/d/e/f/spam/**"}
    assert {r.template for r in got if r.host == "e.org" and r.path.endswith("/f")} == {"/a/b/c/d/e/f"}
    assert {r.template for r in got if r.host == "w.org" and "spam" in r.path} == {n * 6 + "/*/x/spam" + n * 2}
    assert {r.template for r in got if "/own/" in r.path} == {"/own" + n * 5 + "/**"}
    assert len(got) == 40 + 70 + 5 + 40 + 70 + 9 + 9


def test_native_operators_run_no_python(spark, docs_of):
    docs = docs_of(mixed_rows(1))
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    frames = [mixing.mix_sources(docs), url_templates.filter_urls(pages, spark.createDataFrame([], "id bigint, bad boolean"))]
    for df in frames:
        plan = df._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


def test_long_paths_take_few_steps(spark):
    """Pages that differ in their 40th segment only are told apart, and URLs of 1,000 segments hold nothing up."""
    deep = "/".join(f"s{chr(97 + i % 26)}{'x' * (i // 26)}" for i in range(39))
    pages = [(i, f"http://h.org/{deep}/{'good' if i % 2 else 'bad'}/p{chr(97 + i % 26)}{'q' * (i // 26)}") for i in range(60)]
    long = [[("ab"[n] + "yz"[(i * n) % 2]) * 2 for i in range(1000)] for n in range(2)]
    pages += [(100 + n, "http://long.org/" + "/".join(s)) for n, s in enumerate(long)]
    labels = [(i, i % 2 == 0) for i in range(40)] + [(100, True), (101, False)]
    start = time.time()
    out = url_templates.filter_urls(
        spark.createDataFrame(pages, "page_id bigint, url string"), spark.createDataFrame(labels, "id bigint, bad boolean")
    )
    got = {r.page_id: r.verdict for r in out.collect()}
    assert time.time() - start < 60
    assert all(got[i] == ("allow" if i % 2 else "block") for i in range(60))
