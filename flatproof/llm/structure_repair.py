r"""Conversation structure repair: the cheapest edits that give every conversation a lawful order of roles.

The repaired roles of a conversation read ``(s?(ua)+)?`` by their initials. Edits run over a lattice: node (i, q) stands
behind the first ``i`` rows with the roles so far in state ``q`` (0 nothing yet, 1 behind a system turn, 2 behind a
user's, 3 behind an assistant's). Keep costs 0, Rerole to user or assistant 1, Delete 2, Insert of an empty user or
assistant turn 5; a truncated row that is not deleted costs 5 more, and blank and repeated rows must be deleted. Of the
cheapest ways the one with the least audit (the initials of its edits in order, compared as ASCII) is taken.

The way is found by a bidirectional Dijkstra: a forward heap from the start and a reverse heap from the accepting nodes
pop their nodes by cost. Once they have met at some cost, both go on until no other crossing can cost as little; of all
crossings of that cost the least concatenated audit wins. Each node keeps the least audit of its cheapest ways only.
That is enough: letters and rows decide the cost, so of two ways of equal cost to one node neither audit is a prefix of
the other, and what follows can't turn their order round.

A conversation need not fit a task. Rows are range-partitioned by conversation and place, so a long one is spread over
many tasks, which cut it into chunks. A chunk becomes a table of the cheapest audit from each state to each state, and
chunks are again the steps of a lattice: a task joins its chunks, and the runs of one conversation in several tasks are
joined eight at a time. The audit is then cut by chunks, so that the edits are made where the texts are. Equal rows of a
conversation are counted before and travel as one row.

Rows are ordered by turn (null first), role and text. Null roles and texts are one space, an empty role counts as one
for its initial; rows with a null id form one conversation with a null id. Extra columns are not looked at. No rows give
no conversations. Gaps count from the smallest to the largest turn that is not null, at most the greatest long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from heapq import heappop, heappush
from itertools import groupby

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from .common import stage

#: The costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: ASCII white space as the trimming functions take it.
BLANKS = " \t\n\x0b\x0c\r"

STATES = range(4)
NEXT = {0: "su", 1: "u", 2: "a", 3: "u"}  # initials that may follow in a state
STATE = {"s": 1, "u": 2, "a": 3}
ACCEPTING = (0, 3)
LAWFUL = {"su", "ua", "au"}
#: The names that a rerole or an insert gives.
NAMES = {"u": "user", "a": "assistant"}

CHUNK_ROWS, CHUNK_BYTES = 256, 4 << 20
FAN_IN = 8
GREATEST = (1 << 63) - 1

Way = tuple[int, str]  # cost, audit
Table = dict[tuple[int, int], Way]  # the cheapest way from a state to a state


def row_step(initial: str, truncated: bool) -> Table:
    """The ways over one row that may stay."""
    extra = TRUNCATED if truncated else 0
    step = {(q, q): (DELETE, "D") for q in STATES}
    for q in STATES:
        for role in NEXT[q]:
            if role == initial:
                step[q, STATE[role]] = (extra, "K")
            elif role in NAMES:
                step[q, STATE[role]] = (REROLE + extra, "R")
    return step


def deletions(rows: int) -> Table:
    """The ways over rows that must go."""
    return {(q, q): (DELETE * rows, "D" * rows) for q in STATES}


_INSERTS = [(q, STATE[role]) for q in STATES for role in NEXT[q] if role in NAMES]


def cheapest(steps: list[Table], sources: Iterable[int], targets: Iterable[int]) -> Way | None:
    """The cheapest way over all steps from a state of ``sources`` to one of ``targets``, with the least audit."""
    last = len(steps)
    moves = [{}, {}]  # per side: node -> [(node, cost, audit)]
    for i in range(last + 1):
        for a, b in _INSERTS:
            moves[0].setdefault((i, a), []).append(((i, b), INSERT, "I"))
            moves[1].setdefault((i, b), []).append(((i, a), INSERT, "I"))
    for i, step in enumerate(steps):
        for (a, b), (cost, audit) in step.items():
            moves[0].setdefault((i, a), []).append(((i + 1, b), cost, audit))
            moves[1].setdefault((i + 1, b), []).append(((i, a), cost, audit))
    # A heap pops equal costs in the order of its direction, so that ways of no cost reach a node before it is settled.
    heaps, labels, settled = ([], []), ({}, {}), (set(), set())
    best: Way | None = None

    def reach(side: int, node: tuple[int, int], way: Way) -> None:
        known = labels[side].get(node)
        if known is None or way < known:
            labels[side][node] = way
            if known is None or way[0] < known[0]:
                heappush(heaps[side], (way[0], -node[0] if side else node[0], node))

    def settle(side: int) -> None:
        nonlocal best
        node = heappop(heaps[side])[2]
        if node in settled[side]:
            return
        settled[side].add(node)
        cost, audit = labels[side][node]
        ahead, there = labels[1 - side], settled[1 - side]
        meetings = [(node, cost, audit)] if node in there else []
        for other, more, letters in moves[side].get(node, ()):
            whole = letters + audit if side else audit + letters
            if other in there:
                meetings.append((other, cost + more, whole))
            if other not in settled[side]:
                reach(side, other, (cost + more, whole))
        for other, so_far, own in meetings:
            rest, letters = ahead[other]
            if best is None or so_far + rest <= best[0]:
                way = (so_far + rest, letters + own if side else own + letters)
                best = way if best is None else min(best, way)

    for q in targets:
        reach(1, (last, q), (0, ""))
    for _ in targets:
        settle(1)
    for q in sources:
        reach(0, (0, q), (0, ""))
    for _ in sources:
        settle(0)
    while heaps[0] and heaps[1] and (best is None or heaps[0][0][0] + heaps[1][0][0] <= best[0]):
        settle(0 if heaps[0][0][0] <= heaps[1][0][0] else 1)
    return best


@dataclass
class Piece:
    """What is known of consecutive rows of a conversation: faults, turns and the table of cheapest ways."""

    rows: int = 0
    blank: int = 0
    duplicate: int = 0
    truncated: int = 0
    illegal: int = 0
    head: str = ""  # initials of the first and the last row
    tail: str = ""
    least: int | None = None  # turns
    most: int | None = None
    turns: int = 0
    chunks: list[dict] = field(default_factory=list)  # place and rows of each chunk
    table: Table = field(default_factory=dict)


def join_pieces(pieces: list[Piece], starts: bool, ends: bool) -> Piece:
    """One piece of consecutive ones, ``starts`` and ``ends`` with the conversation. Turns come in order."""
    out = Piece()
    for piece in pieces:
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns"):
            setattr(out, name, getattr(out, name) + getattr(piece, name))
        if out.tail:
            out.illegal += out.tail + piece.head not in LAWFUL
        if piece.turns:
            out.turns -= piece.least == out.most
            out.least = piece.least if out.least is None else out.least
            out.most = piece.most
        out.head = out.head or piece.head
        out.tail = piece.tail
        out.chunks += piece.chunks
    out.table = table_of([p.table for p in pieces], starts, ends)
    return out


def table_of(steps: list[Table], starts: bool, ends: bool) -> Table:
    """The table over some steps. A whole conversation has one way only, which is put under (0, 0)."""
    if starts and ends:
        return {(0, 0): cheapest(steps, [0], ACCEPTING)}
    ways = {(a, b): cheapest(steps, [a], [b]) for a in ([0] if starts else STATES) for b in (ACCEPTING if ends else STATES)}
    return {pair: way for pair, way in ways.items() if way is not None}


class Chunk:
    """Rows of one conversation, up to a bound."""

    def __init__(self):
        self.piece, self.steps, self.turns, self.bytes = Piece(), [], [], 0

    def add(self, turn: int | None, role: str, text: str, copies: int, seen: bool, blank: bool, truncated: bool) -> None:
        initial = role[:1] or " "
        piece = self.piece
        piece.rows += copies
        piece.illegal += copies - 1  # no role may follow itself
        if piece.tail:
            piece.illegal += piece.tail + initial not in LAWFUL
        piece.head, piece.tail = piece.head or initial, initial
        if turn is not None:
            piece.turns += turn != piece.most
            piece.least = turn if piece.least is None else piece.least
            piece.most = turn
        gone = copies if blank or seen else copies - 1
        piece.blank += copies if blank else 0
        piece.duplicate += 0 if blank else gone
        if gone < copies:
            piece.truncated += truncated
            self.steps.append(row_step(initial, truncated))
        if gone:
            self.steps.append(deletions(gone))
        self.turns.append({"role": role, "text": text, "copies": copies})
        self.bytes += len(text)

    def full(self) -> bool:
        return len(self.turns) >= CHUNK_ROWS or self.bytes >= CHUNK_BYTES


def apply_audit(turns: Iterable[dict], audit: str, state: int) -> list[dict]:
    """The turns after the edits of an audit, which begins in ``state``."""
    out, at = [], 0

    def put(initial: str, role: str, text: str) -> None:
        nonlocal state
        out.append({"role": role, "text": text, "copies": 1})
        state = STATE[initial]

    def inserts() -> None:
        nonlocal at
        while audit[at : at + 1] == "I":
            initial = "a" if state == 2 else "u"
            put(initial, NAMES[initial], "")
            at += 1

    for turn in turns:
        for _ in range(turn["copies"]):
            inserts()
            edit = audit[at]
            at += 1
            if edit == "K":
                put(turn["role"][:1], turn["role"], turn["text"])
            elif edit == "R":
                initial = "a" if state == 2 else "u"
                put(initial, NAMES[initial], turn["text"])
    inserts()
    return out


def audit_slices(audit: str, chunks: list[dict]) -> Iterator[tuple[int, str, int]]:
    """Place, letters and first state of each chunk. Inserts between two chunks go with the first."""
    system = (len(audit) - audit.count("D")) % 2
    at = made = 0
    for chunk in chunks:
        start, before, left = at, made, chunk["rows"]
        while at < len(audit) and (left or audit[at] == "I"):
            left -= audit[at] != "I"
            made += audit[at] != "D"
            at += 1
        state = (1 if system and before == 1 else 0 if not before else 3 if (before - system) % 2 == 0 else 2)
        yield chunk["place"], audit[start:at], state


_TURNS = "array<struct<role:string,text:string,copies:long>>"
_TABLE = "array<struct<entry:int,exit:int,cost:long,audit:string>>"
_PIECE = (
    "struct<rows:long,blank:long,duplicate:long,truncated:long,illegal:long,head:string,tail:string,least:long,most:long,"
    f"turns:long,chunks:array<struct<place:long,rows:long>>,table:{_TABLE}>"
)


def _packed(piece: Piece) -> dict:
    table = [{"entry": a, "exit": b, "cost": way[0], "audit": way[1]} for (a, b), way in piece.table.items()]
    return {**vars(piece), "table": table}


def _unpacked(packed: dict) -> Piece:
    return Piece(**{**packed, "table": {(t["entry"], t["exit"]): (t["cost"], t["audit"]) for t in packed["table"]}})


def _batches(rows: Iterable[dict], schema: pa.Schema, size: int = 512) -> Iterator[pa.RecordBatch]:
    """Record batches of up to ``size`` rows, or about ``CHUNK_BYTES`` of turns."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(t["text"]) for t in row.get("turns") or ())
        if len(held) >= size or weight >= CHUNK_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema=schema)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema=schema)


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


class _Run:
    """The rows of one conversation in one task. Pieces are joined eight at a time as they come."""

    def __init__(self, conv, place: int, starts: bool):
        self.conv, self.starts, self.first, self.place = conv, starts, place, place
        self.chunk = Chunk()
        self.levels: list[list[Piece]] = []

    def add(self, *row) -> Iterator[dict]:
        if self.chunk.full():
            yield self.close_chunk(False)
        self.chunk.add(*row)

    def close_chunk(self, ends: bool) -> dict:
        piece, turns = self.chunk.piece, self.chunk.turns
        starts = self.starts and self.place == self.first
        piece.table = table_of(self.chunk.steps, starts, ends)
        piece.chunks = [{"place": self.place, "rows": piece.rows}]
        alone = starts and ends
        if alone:
            turns = apply_audit(turns, piece.table[0, 0][1], 0)
        self.keep(piece, 0)
        out = {"conv_id": self.conv, "place": self.place, "alone": alone, "turns": turns, "piece": None}
        self.place += 1
        self.chunk = Chunk()
        return out

    def is_first(self, level: int) -> bool:
        return self.starts and not any(self.levels[level + 1 :])

    def keep(self, piece: Piece, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        held = self.levels[level]
        if len(held) == FAN_IN:
            joined = join_pieces(held, self.is_first(level), False)
            self.levels[level] = [piece]
            self.keep(joined, level + 1)
        else:
            held.append(piece)

    def close(self, ends: bool) -> Iterator[dict]:
        yield self.close_chunk(ends)
        pieces: list[Piece] = []
        for level, held in enumerate(self.levels):  # the highest level holds the earliest rows
            pieces = [*held, *pieces]
            if len(pieces) > 1:
                pieces = [join_pieces(pieces, self.is_first(level), ends)]
        alone = self.starts and ends
        yield {"conv_id": self.conv, "place": self.first, "alone": alone, "turns": None, "piece": _packed(pieces[0])}


def _cut_runs(rows: Iterator[tuple], task: int) -> Iterator[dict]:
    """Chunks and one piece per run, of rows in order. Only the first and the last run of a task may go on elsewhere.
    The place of a chunk is the number of its task and its number there."""
    run = None
    for conv, *row in rows:
        if run is None or conv != run.conv:
            if run is not None:
                yield from run.close(True)
            run = _Run(conv, run.place if run else task << 32, run is not None or task == 0)
        yield from run.add(*row)
    if run is not None:
        yield from run.close(False)


@dataclass(frozen=True)
class Repaired:
    """``conversations``: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, one row each.

    ``turns``: the repaired turns, ``conv_id, place, alone, turns``: arrays of role and text, in the order of ``place``;
    ``alone`` marks an array that holds all of its conversation.
    """

    conversations: DataFrame
    turns: DataFrame


def prepared_rows(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """``conv_id, turn, role, text, copies, seen, blank, truncated``: equal rows counted, ``seen`` where an earlier turn
    has the same role and text. Both are found by aggregates, so no key gathers its rows in one task."""
    one = rows.select(
        F.col(f"`{id_col}`").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
        *[F.coalesce(F.col(f"`{c}`"), F.lit(" ")).alias(n) for c, n in ((role_col, "role"), (text_col, "text"))],
    )
    counted = one.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    # Structs are equal where both hold nulls; one that begins with whether there is a turn puts null first.
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    order = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    keyed = stage(counted.select("*", F.struct("conv_id", said.alias("said")).alias("key"), order.alias("when")), "turns")
    firsts = keyed.groupBy("key").agg(F.min("when").alias("first"))
    end = F.rtrim("text", F.lit(BLANKS))
    return keyed.join(firsts, "key").select(
        "conv_id", "turn", "role", "text", "copies", (F.col("when") > F.col("first")).alias("seen"),
        (F.length(end) == 0).alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )


def _join_round(pieces: DataFrame, bits: int, last: bool, out: T.StructType) -> DataFrame:
    """Neighbouring pieces of a conversation joined into one, as far as they share a block of tasks. The last round
    joins whole conversations."""
    kind = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def joined() -> Iterator[dict]:
            for (conv, _), rows in groupby(_rows(batches), lambda r: (r["conv_id"], r["place"] >> bits)):
                rows = list(rows)
                piece = join_pieces([_unpacked(r["piece"]) for r in rows], last, last)
                yield {"conv_id": conv, "place": rows[0]["place"], "piece": _packed(piece)}

        yield from _batches(joined(), kind, 16)

    dealt = pieces.repartition("conv_id", F.shiftright("place", bits)).sortWithinPartitions("conv_id", "place")
    return dealt.mapInArrow(run, out)


def repair_conversations(
    rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> Repaired:
    """The cheapest repair of every conversation; see the module."""
    prepared = stage(prepared_rows(rows, id_col, turn_col, role_col, text_col), "faults")

    def schema(rest: str) -> T.StructType:
        own = T.StructField("conv_id", prepared.schema["conv_id"].dataType)
        return T.StructType([own, *T._parse_datatype_string(rest).fields])

    lattice = schema(f"place long, alone boolean, turns {_TURNS}, piece {_PIECE}")
    lattice_arrow = to_arrow_schema(lattice)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for row in zip(*[c.to_pylist() for c in b.columns]))
        yield from _batches(_cut_runs(rows, TaskContext.get().partitionId()), lattice_arrow)

    # Texts compare by their beginnings alike, and long ones don't reach the driver with the sample of the ranges.
    ranges = ("conv_id", "turn", "role", F.substring("text", 1, 64))
    in_order = prepared.repartitionByRange(*ranges).sortWithinPartitions("conv_id", "turn", "role", "text")
    cuts = stage(in_order.mapInArrow(cut, lattice), "lattice")
    runs = cuts.where(F.col("piece").isNotNull())
    chunks = cuts.where(F.col("turns").isNotNull()).select("conv_id", "place", "alone", "turns")

    pieces = runs.where(~F.col("alone")).select("conv_id", "place", "piece")
    tasks = pieces.agg(F.max(F.shiftright("place", 32))).first()[0]  # one number
    bits = 32
    while tasks is not None:
        tasks, bits = tasks // FAN_IN, bits + 3
        pieces = _join_round(pieces, bits, not tasks, schema(f"place long, piece {_PIECE}"))
        tasks = tasks or None
    whole = runs.where("alone").select("conv_id", "place", "piece").unionByName(pieces)

    slices = schema("place long, letters string, state int")
    slices_arrow = to_arrow_schema(slices)

    def cut_audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            {"conv_id": r["conv_id"], "place": place, "letters": letters, "state": state}
            for r in _rows(batches)
            for place, letters, state in audit_slices(r["piece"]["table"][0]["audit"], r["piece"]["chunks"])
        )
        yield from _batches(found, slices_arrow)

    several = runs.where(F.col("alone") & (F.size("piece.chunks") > 1)).select("conv_id", "place", "piece")
    edits = several.unionByName(pieces).select("conv_id", "piece").mapInArrow(cut_audits, slices).drop("conv_id")
    turns = schema(f"place long, alone boolean, turns {_TURNS}")
    turns_arrow = to_arrow_schema(turns)

    def edit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = (
            {"conv_id": r["conv_id"], "place": r["place"], "alone": False,
             "turns": apply_audit(r["turns"], r["letters"], r["state"])}
            for r in _rows(batches)
        )
        yield from _batches(done, turns_arrow)

    edited = chunks.where(~F.col("alone")).join(edits, "place")  # a place is one chunk of one conversation
    edited = edited.select("conv_id", "place", "turns", "letters", "state").mapInArrow(edit, turns)

    way = F.col("piece.table")[0]
    most, least, distinct = (F.col(f"piece.{c}").cast("decimal(20,0)") for c in ("most", "least", "turns"))
    gaps = F.when(distinct == 0, 0).otherwise(F.least(most - least + F.lit(1).cast("decimal(20,0)") - distinct, F.lit(GREATEST)))
    conversations = whole.select(
        "conv_id", gaps.cast("long").alias("gaps"),
        *[F.col(f"piece.{c}").alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
        way["cost"].alias("cost"), way["audit"].alias("audit"),
    )
    bare = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns")
    return Repaired(conversations, chunks.where("alone").unionByName(edited).select("conv_id", "place", "alone", bare))


def digest_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of ``role:text`` of all turns of a conversation, joined by line ends. Conversations
    of several chunks pass as streams, since such a digest has an order."""
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit(":"), t["text"])), "\n")
    short = turns.where("alone").select("conv_id", F.sha2(lines, 256).alias("repaired_sha256"))
    out = short.schema
    kind = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digests() -> Iterator[dict]:
            for conv, rows in groupby(_rows(batches), lambda r: r["conv_id"]):
                state, between = hashlib.sha256(), b""
                for row in rows:
                    for turn in row["turns"]:
                        state.update(between + f"{turn['role']}:{turn['text']}".encode())
                        between = b"\n"
                yield {"conv_id": conv, "repaired_sha256": state.hexdigest()}

        yield from _batches(digests(), kind)

    long = turns.where(~F.col("alone")).select("conv_id", "place", "turns")
    dealt = long.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return short.unionByName(dealt.mapInArrow(run, out))


# The registered query.


def damage_rows(turns: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` with faults put in, by crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1
    empties its text, 2 removes its ``.``, ``!`` and ``?``, 3 repeats it, 4 gives it to the user. Null ids and turns are one
    space in that key, null roles and texts one space."""
    space = F.lit(" ")
    key = F.concat(*[F.coalesce(c, space) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    fault = F.crc32(key) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    damaged = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    copies = F.explode(F.when(fault == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return turns.where(fault != 0).select(
        "conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"), damaged.alias("text"), copies.alias("copy")
    ).drop("copy")


#: Fixed value: the digest of nothing.
EMPTY_SHA = hashlib.sha256().hexdigest()


def op11_structure_repair(spark, sf_dir):
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = repair_conversations(damage_rows(turns))
    key = F.struct("conv_id").alias("key")
    ids = turns.select(key).distinct()
    digests = digest_turns(found.turns).select(key, "repaired_sha256")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    joined = ids.join(found.conversations.select(key, *counts, "audit"), "key", "left").join(digests, "key", "left")
    return joined.select(
        "key.conv_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"),
    )


def _less(*ways: str) -> str:
    return f"least({', '.join(ways)})"


def _then(way: str, cost: str, letter: str) -> str:
    """SQL for a way of ten digits of cost and an audit, with an edit added. Null stays null."""
    return f"(lpad(CAST(CAST(left({way}, 10) AS BIGINT) + {cost} AS VARCHAR), 10, '0') || substr({way}, 11) || '{letter}')"


def _kept(way: str, role: str) -> str:
    own = f"CASE WHEN ini = '{role}' THEN {_then(way, '5 * cut', 'K')} END"
    return own if role == "s" else f"coalesce({own}, {_then(way, '(1 + 5 * cut)', 'R')})"


def _row(role: str, state: int, *before: int) -> str:
    ways = [f"CASE WHEN NOT gone THEN {_kept(f's{q}', role)} END" for q in before]
    return _less(_then(f"s{state}", "2", "D"), *ways)


OP11_SQL = f"""
WITH RECURSIVE bits(b, c, k) AS (
  SELECT CAST(b AS UBIGINT), CAST(b AS UBIGINT), 0 FROM range(256) t(b)
  UNION ALL
  SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::UBIGINT) ELSE c >> 1 END, k + 1 FROM bits WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE k = 8),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_prepend(4294967295::UBIGINT, list_transform(string_split(
      coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: ascii(x)::UBIGINT)),
      lambda a, x: xor(a >> 8, t[CAST(xor(a & 255, x) AS INT) + 1])) AS h
  FROM conversations, crc),
faults AS (SELECT *, xor(h, 4294967295::UBIGINT) % 20 AS f FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM faults, range(2) c(n) WHERE f <> 0 AND (n = 0 OR f = 3)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body FROM damaged),
seen AS (
  SELECT *, body = '' AS blank, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
    right(body, 1) NOT IN ('.', '!', '?') AS open, CASE WHEN role = '' THEN ' ' ELSE left(role, 1) END AS ini,
    lag(CASE WHEN role = '' THEN ' ' ELSE left(role, 1) END) OVER (PARTITION BY conv_id ORDER BY i) AS prev
  FROM placed),
marked AS (
  SELECT conv_id, i, turn, role, text, ini, blank OR again AS gone,
    CAST(NOT blank AND NOT again AND open AS INT) AS cut,
    CAST(blank AS INT) AS b, CAST(again AND NOT blank AS INT) AS d,
    CAST(prev IS NOT NULL AND prev || ini NOT IN ('su', 'ua', 'au') AS INT) AS ill
  FROM seen),
stats AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    sum(b) AS blank, sum(d) AS duplicate, sum(cut) AS truncated, sum(ill) AS illegal FROM marked GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::BIGINT AS i, '0000000000' AS s0, CAST(NULL AS VARCHAR) AS s1, '0000000005I' AS s2, '0000000010II' AS s3
  FROM stats
  UNION ALL
  SELECT conv_id, i, r0, r1, u, {_less('r3', _then('u', '5', 'I'))} FROM (
    SELECT *, {_less('r2', _then('r0', '5', 'I'), _then('r1', '5', 'I'), _then('r3', '5', 'I'))} AS u FROM (
      SELECT w.conv_id, m.i, {_then('s0', '2', 'D')} AS r0, {_row('s', 1, 0)} AS r1, {_row('u', 2, 0, 1, 3)} AS r2,
        {_row('a', 3, 2)} AS r3
      FROM walk w JOIN marked m ON m.conv_id IS NOT DISTINCT FROM w.conv_id AND m.i = w.i + 1))),
ends AS (
  SELECT s.*, CAST(left(least(s0, s3), 10) AS BIGINT) AS cost, substr(least(s0, s3), 11) AS audit
  FROM stats s JOIN walk w ON w.conv_id IS NOT DISTINCT FROM s.conv_id AND w.i = s.n),
letters AS (
  SELECT conv_id, p, substr(audit, p, 1) AS e, length(replace(audit, 'D', '')) % 2 AS sys
  FROM (SELECT conv_id, audit, unnest(range(1, length(audit) + 1)) AS p FROM ends)),
edits AS (
  SELECT *, sum(CAST(e <> 'I' AS INT)) OVER w AS i, sum(CAST(e <> 'D' AS INT)) OVER w AS k
  FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
repaired AS (
  SELECT e.conv_id, e.k, CASE WHEN e = 'K' THEN m.role WHEN (k - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' ||
    CASE WHEN e = 'I' THEN '' ELSE m.text END AS line
  FROM edits e LEFT JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.i = e.i WHERE e <> 'D'),
digests AS (SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY k)) AS sha FROM repaired GROUP BY conv_id)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(CAST(blank AS BIGINT), 0) AS blank,
  coalesce(CAST(duplicate AS BIGINT), 0) AS duplicate, coalesce(CAST(truncated AS BIGINT), 0) AS truncated,
  coalesce(CAST(illegal AS BIGINT), 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(sha, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN digests d ON d.conv_id IS NOT DISTINCT FROM o.conv_id
"""
