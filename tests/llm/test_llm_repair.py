"""Structure repair against plain enumeration and a row-by-row walk."""

import itertools
import random
import zlib

import pytest
from conftest import CLASHING, sha
from pyspark.sql import functions as F

from flatproof.llm import structure_repair as sr

ROWS = "conv_id bigint, turn bigint, role string, text string"
BLANK = " \t\n\x0b\x0c\r"


def faults(rows):
    """Rows in order -> [(initial, role, text, fault)]."""
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(BLANK)
        fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
        seen.add((role, text))
        out.append((role[:1] or " ", role, text, fault))
    return out


def accepted(roles):
    body = roles[1:] if roles[:1] == "s" else roles
    return not roles or (len(body) >= 2 and len(body) % 2 == 0 and all(r == "ua"[i % 2] for i, r in enumerate(body)))


def every_way(rows, most_inserts):
    """All (cost, audit, repaired) by trying every sequence of edits."""
    choices = []
    for initial, role, text, fault in rows:
        own = [(2, "D", [])]
        if fault not in ("blank", "duplicate"):
            more = 5 if fault == "truncated" else 0
            own.append((more, "K", [(initial, role, text)]))
            own += [(1 + more, "R", [(n[0], n, text)]) for n in ("user", "assistant")]
        choices.append(own)
    inserted = [
        [(5 * len(c), "I" * len(c), [(n[0], n, "") for n in c]) for k in range(most_inserts + 1) for c in itertools.product(("user", "assistant"), repeat=k)]
        for _ in range(len(rows) + 1)
    ]
    spots = [inserted[0]]
    for own, ins in zip(choices, inserted[1:]):
        spots += [own, ins]
    for way in itertools.product(*spots):
        turns = [t for part in way for t in part[2]]
        if accepted("".join(t[0] for t in turns)):
            yield sum(p[0] for p in way), "".join(p[1] for p in way), tuple(f"{t[1]}:{t[2]}" for t in turns)


def walk(rows):
    """The least (cost, audit) by going over the rows once, state by state."""
    names = {"u": "user", "a": "assistant"}

    def inserts(at):
        at = dict(at)
        for _ in range(2):
            for q, initial in ((0, "u"), (1, "u"), (3, "u"), (2, "a")):
                if q in at:
                    cost, audit, turns = at[q]
                    way = (cost + 5, audit + "I", (*turns, (names[initial], "")))
                    to = sr.STATE[initial]
                    at[to] = min(at.get(to, way), way)
        return at

    at = inserts({0: (0, "", ())})
    for initial, role, text, fault in rows:
        new = {}

        def offer(q, way):
            new[q] = min(new.get(q, way), way)

        for q, (cost, audit, turns) in at.items():
            offer(q, (cost + 2, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            more = 5 if fault == "truncated" else 0
            for to in sr.NEXT[q]:
                if to == initial:
                    offer(sr.STATE[to], (cost + more, audit + "K", (*turns, (role, text))))
                elif to in names:
                    offer(sr.STATE[to], (cost + 1 + more, audit + "R", (*turns, (names[to], text))))
        at = inserts(new)
    return min(at[q] for q in (0, 3) if q in at)


def steps_of(rows):
    return [sr.deletions(1) if f in ("blank", "duplicate") else sr.row_step(i, f == "truncated") for i, _, _, f in rows]


def some_rows(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", "", "ubiquitous"]
    texts = ["Hello.", "Yes!", "what", "", " \t", "Why?", "a. b", "é.", "…"]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{rng.random()}" + rng.choice(["", ".", "? "])) for _ in range(n)]


@pytest.mark.parametrize("seed", range(60))
def test_search_against_every_way(seed):
    rng = random.Random(seed)
    rows = faults(some_rows(rng, rng.randrange(4)))
    want = min(every_way(rows, 2))
    assert sr.cheapest(steps_of(rows), [0], sr.ACCEPTING) == want[:2]
    # One audit has one result.
    assert len({w[2] for w in every_way(rows, 2) if w[:2] == want[:2]}) == 1


@pytest.mark.parametrize("seed", range(40))
def test_search_chunks_and_edits_against_a_walk(seed):
    rng = random.Random(seed)
    rows = faults(some_rows(rng, rng.randrange(1, 120)))
    cost, audit, turns = walk(rows)
    steps = steps_of(rows)
    assert sr.cheapest(steps, [0], sr.ACCEPTING) == (cost, audit)
    cuts = sorted(rng.sample(range(len(steps) + 1), min(len(steps), rng.randrange(1, 9))))
    parts = [steps[a:b] for a, b in zip([0, *cuts], [*cuts, len(steps)]) if b > a]
    tables = [sr.table_of(p, i == 0, i == len(parts) - 1) for i, p in enumerate(parts)]
    assert sr.table_of(tables, True, True) == {(0, 0): (cost, audit)}
    # The audit cut by the same parts gives the same turns.
    chunks = [{"place": i, "rows": len(p)} for i, p in enumerate(parts)]
    made, at = [], 0
    for place, letters, state in sr.audit_slices(audit, chunks):
        own = [{"role": r[1], "text": r[2], "copies": 1} for r in rows[at : at + len(parts[place])]]
        at += len(own)
        made += [(t["role"], t["text"]) for t in sr.apply_audit(own, letters, state)]
    assert tuple(made) == turns


def brute(rows):
    """Conversation -> all columns, from (conv, turn, role, text)."""
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
        marked = faults([(r[2], r[3]) for r in own])
        cost, audit, turns = walk(marked)
        numbers = {r[1] for r in own if r[1] is not None}
        gaps = max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0
        kinds = [m[3] for m in marked]
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marked, marked[1:]))
        lines = "\n".join(f"{r}:{x}" for r, x in turns)
        out[conv] = (min(gaps, 2**63 - 1), *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha(lines))
    return out


def repaired(spark, df):
    found = sr.repair_conversations(df)
    digests = {r.conv_id: r.repaired_sha256 for r in sr.digest_turns(found.turns).collect()}
    got = {}
    for r in found.conversations.collect():
        assert r.conv_id not in got
        got[r.conv_id] = (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, digests.pop(r.conv_id))
    assert not digests
    return got, found


def test_conversations_against_the_walk(spark):
    rng = random.Random(5)
    rows = []
    for conv in [*range(60), -9, 2**63 - 1]:
        for turn, (role, text) in enumerate(some_rows(rng, rng.choice([1, 2, 5, 9, 30]))):
            rows.append((conv, turn * rng.choice([1, 1, 2]), role, text))
    rows += [(100, None, "user", "a."), (100, None, "user", "a."), (100, 2, None, None), (100, 2, "assistant", None), (100, -(2**63), "user", "z?"),
             (100, 2**63 - 1, "user", "z?")]
    rows += [(None, t, "user", "hi.") for t in (None, 1, 1, 3)] + [(101, None, None, "x" * 300_000)] + [(102, 1, "user", "same.")] * 50
    rows += [(103, None, "system", "Only.")]
    df = spark.createDataFrame(rows, ROWS).repartition(5)
    got, _ = repaired(spark, df.selectExpr("*", *[f"'x' as `{c}`" for c in CLASHING if c not in df.columns]))
    assert got == brute(rows)


def test_a_long_conversation_is_spread(spark, monkeypatch):
    monkeypatch.setattr(sr, "CHUNK_ROWS", 16)
    rng = random.Random(6)
    rows = [(7, t, *row) for t, row in enumerate(some_rows(rng, 1500))] + [(7, 40, "user", "again.")] * 30
    rows += [(c, t, *row) for c in range(8) if c != 7 for t, row in enumerate(some_rows(rng, 70))]
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    shuffles = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "20")
    try:
        got, found = repaired(spark, spark.createDataFrame(rows, ROWS))
        places = [r[0] for r in found.turns.where("conv_id = 7").select(F.shiftright("place", 32)).collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
        spark.conf.set("spark.sql.shuffle.partitions", shuffles)
    assert got == brute(rows)
    assert len(set(places)) >= 10 and max(map(places.count, set(places))) <= 15


def test_no_conversations(spark):
    got, found = repaired(spark, spark.createDataFrame([], ROWS))
    assert got == {} and found.turns.collect() == []


def test_damage(spark):
    rows = [(c, t, "system" if not t else "assistant", f"a. b! {c}?") for c in range(40) for t in range(4)] + [(None, None, None, None)]
    want = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if fault == 1 else "".join(x for x in text if x not in ".!?") if fault == 2 else text
        want += [(conv, turn, "user" if fault == 4 else role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    got = [tuple(r) for r in sr.damage_rows(spark.createDataFrame(rows, ROWS)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
