r"""Chat formatting in budgeted windows.

A conversation becomes windows of at most ``budget`` tokens. Prefix sums of the turns' tokens choose spans of whole
turns; every window starts with the conversation's system turn, repeats up to ``history`` tokens of the turns before
its span, and then holds the span. The loss mask covers the text of assistant turns of the span alone, so that each
target is learnt once however often it is repeated. A single turn that is above the budget, alone or with the system
turn, has a window to itself; no other window is above it.

Budget and history count the tokens of turns as they are formatted, with number, role, marks and escapes, so an empty
turn has some too. Byte-level tokenizers start a new word behind each turn, so the sum over a window is the count of
its text; with other tokenizers it is the sum of turns that are counted alone.

The template of a turn is ``### <number> <role>: <text></turn>`` and a line end; numbers count from 0 in the whole
conversation. In roles and texts ``\``, ``#`` and ``<`` are written ``\\``, ``\#`` and ``\<``, so no text can look
like a mark, and reading back is exact. A null role is empty; an empty role is read back as empty.

Turns are numbered and counted before, dealt by conversation and turn number. Then the rows of a conversation pass
through one task in order, but as a stream: the state is the turns of the present window,
its history and the system turn. A conversation of any length needs memory for one window and one Arrow batch.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import TOKENIZER_BYTES, counts_by_piece, text_counter

_CONTROL = re.compile(r"[\\#<]")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"### (\d+) ((?:[^\\#<:]++|\\.)*+): ((?:[^\\#<]++|\\.)*+)</turn>\n", re.S)
_ROLE = re.compile(r"[\\#<:]")

Turn = tuple[int, str, str, int | None, int]  # number, role, text, tokens of the text, tokens of the formatted turn


def escape(text: str) -> str:
    return _CONTROL.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def format_turn(number: int, role: str, text: str) -> tuple[str, int, int]:
    """The formatted turn, and where its text starts and ends in it."""
    head = f"### {number} " + _ROLE.sub(lambda m: "\\" + m[0], role) + ": "
    body = escape(text)
    return f"{head}{body}</turn>\n", len(head), len(head) + len(body)


def parse_window(text: str) -> list[tuple[int, str, str]]:
    """(number, role, text) of each turn of a formatted window. Anything else in it is an error."""
    out, at = [], 0
    while at < len(text):
        turn = _TURN.match(text, at)
        if turn is None:
            raise ValueError(f"no turn at {at}")
        out.append((int(turn[1]), unescape(turn[2]), unescape(turn[3])))
        at = turn.end()
    return out


def format_window(number: int, system: Turn | None, past: list[Turn], span: list[Turn]) -> dict:
    repeated = [t for t in ([system] if system else []) if t[0] < span[0][0]]
    repeated += [t for t in past if not repeated or t[0] != repeated[0][0]]
    pieces, mask, at = [], [], 0
    for turn in [*repeated, *span]:
        piece, start, stop = format_turn(*turn[:3])
        if turn[1] == "assistant" and turn[0] >= span[0][0] and stop > start:
            mask.append({"start": at + start, "stop": at + stop})
        pieces.append(piece)
        at += len(piece)
    return {
        "window": number, "text": "".join(pieces), "loss": mask, "first_turn": span[0][0], "last_turn": span[-1][0],
        "n_tokens": None if span[0][3] is None else sum(t[3] for t in [*repeated, *span]), "window_tokens": sum(t[4] for t in [*repeated, *span]),
    }


class Windows:
    """The windows of one conversation, turn by turn."""

    def __init__(self, budget: int, history: int):
        self.budget, self.history = budget, history
        self.system: Turn | None = None
        self.past: list[Turn] = []
        self.span: list[Turn] = []
        self.turns = self.made = 0
        self.held = 0  # formatted tokens of system turn and history of the present window
        self.sum = 0  # formatted tokens of the span

    def add(self, role: str, text: str, tokens: int, formatted: int) -> Iterator[dict]:
        turn = (self.turns, role, text, tokens, formatted)
        if self.span and self.held + self.sum + formatted > self.budget:
            yield self.close()
        if not self.span:
            self.start(formatted)
        if self.turns == 0 and role == "system":
            self.system = turn
        self.turns += 1
        self.span.append(turn)
        self.sum += formatted

    def start(self, formatted: int) -> None:
        """Choose the history that a span starting with a turn of ``formatted`` tokens repeats: the latest turns whose
        suffix sums fit the history and leave the turn its room."""
        system = self.system[4] if self.system else 0
        room = min(self.history, self.budget - system - formatted)
        sums = list(accumulate(t[4] for t in reversed(self.past)))
        fit = sum(1 for s in sums if s <= room)
        self.past = self.past[len(self.past) - fit :]
        self.held = system + (sums[fit - 1] if fit else 0)
        self.sum = 0

    def close(self) -> dict:
        out = format_window(self.made, self.system, self.past, self.span)
        self.made += 1
        # What later windows may repeat: no more than the history holds.
        kept, total = [], 0
        for turn in reversed([*self.past, *self.span]):
            total += turn[4]
            if total > self.history:
                break
            if self.system is None or turn[0] != self.system[0]:
                kept.append(turn)
        self.past, self.span = kept[::-1], []
        return out


def turn_counter(name: str, content: bytes, count: Callable[[list[str]], list[int]]) -> Callable[[list[str]], list[int]]:
    """A function from formatted turns to token counts of at least 1."""
    if name.endswith(".model") or not counts_by_piece(json.loads(content)):
        return lambda turns: [max(1, n) for n in count(turns)]
    # The line end is a word of its own behind ``>``.
    end = count(["\n"])[0]
    return lambda turns: [max(1, n + end) for n in count([t[:-1] for t in turns])]


def number_turns(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id, turn, role, text`` with ``number``, from 0 in each conversation, in the order of turn (null
    first), role and text. Texts are dealt by conversation and turn, so that a long conversation is spread."""
    # Structs are equal where both sides hold nulls.
    keyed = rows.withColumn("key", F.struct("conv_id", "turn"))
    sizes = keyed.groupBy("key").agg(F.count("*").alias("size"))
    before = Window.partitionBy("key.conv_id").orderBy("key.turn").rowsBetween(Window.unboundedPreceding, -1)
    firsts = sizes.select("key", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    place = F.row_number().over(Window.partitionBy("key").orderBy("role", "text"))
    placed = keyed.withColumn("place", place).join(firsts, "key")
    return placed.select("conv_id", "role", "text", (F.col("first") + F.col("place") - 1).alias("number"))


LOSS = "array<struct<start:long,stop:long>>"
OUT_ROWS = 256


def format_conversations(
    turns: DataFrame,
    tokenizer_path: str,
    budget: int = 1024,
    history: int = 256,
    id_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    bare_tokens: bool = False,
) -> DataFrame:
    """``conv_id, window, text, loss, first_turn, last_turn, n_tokens, window_tokens``, one row per window.

    ``window_tokens`` are the tokens of the formatted turns, which ``budget`` and ``history`` bound; ``n_tokens``, null
    unless ``bare_tokens`` asks for a second encoding, those of the bare texts of the turns. ``loss`` lists the code point ranges of the formatted text under the loss mask. Turns are ordered by turn number
    (null first), then role and text; rows with equal keys are turns of their own. Null texts and roles are empty.
    Rows with a null conversation form one conversation with a null id. No rows give no windows.
    """
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    if len(content) > TOKENIZER_BYTES:
        raise ValueError(f"the tokenizer file has more than {TOKENIZER_BYTES} bytes")
    name = tokenizer_path.rpartition("/")[2]
    sent = turns.sparkSession.sparkContext.broadcast(content)
    rows = turns.select(
        F.col(id_col).alias("conv_id"), F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"), F.coalesce(text_col, F.lit("")).alias("text"),
    )
    numbered = number_turns(rows)
    added = [T.StructField(c, T.LongType()) for c in ("tokens", "formatted")]
    counted_schema = T.StructType([*numbered.schema.fields, *added])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = text_counter(name, sent.value)
        turn_count = turn_counter(name, sent.value, counter)
        for batch in batches:
            numbers, roles, texts = (batch.column(c).to_pylist() for c in ("number", "role", "text"))
            formatted = turn_count([format_turn(*turn)[0] for turn in zip(numbers, roles, texts)])
            bare = pa.array(counter(texts), pa.int64()) if bare_tokens else pa.nulls(len(texts), pa.int64())
            found = [bare, pa.array(formatted, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=counted_schema.names)

    id_field = rows.schema["conv_id"]
    schema = T.StructType([
        T.StructField("conv_id", id_field.dataType),
        *T._parse_datatype_string(
            f"window long, text string, loss {LOSS}, first_turn long, last_turn long, n_tokens long, window_tokens long"
        ).fields,
    ])

    def form(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _stream(batches, lambda: Windows(budget, history))

    counted = numbered.mapInArrow(count, counted_schema)
    in_order = counted.repartition("conv_id").sortWithinPartitions("conv_id", "number")
    return in_order.mapInArrow(form, schema)


def _arrow(rows: list[dict], id_type: pa.DataType) -> pa.RecordBatch:
    loss = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
    kinds = {"conv_id": id_type, "window": pa.int64(), "text": pa.string(), "loss": loss, "first_turn": pa.int64(),
             "last_turn": pa.int64(), "n_tokens": pa.int64(), "window_tokens": pa.int64()}
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in kinds.items()], names=list(kinds))


def _stream(batches: Iterator[pa.RecordBatch], make: Callable[[], Windows]) -> Iterator[pa.RecordBatch]:
    present, state, out, kind = None, None, [], None
    for batch in batches:
        kind = batch.column("conv_id").type
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "tokens", "formatted")]
        for conv, role, text, tokens, formatted in zip(*columns):
            if state is None or conv != present:
                if state is not None:
                    out.append({"conv_id": present, **state.close()})
                present, state = conv, make()
            out += [{"conv_id": conv, **w} for w in state.add(role, text, tokens, formatted)]
            if len(out) >= OUT_ROWS:
                yield _arrow(out, kind)
                out = []
    if state is not None:
        out.append({"conv_id": present, **state.close()})
    if out:
        yield _arrow(out, kind)


def read_back(windows: DataFrame) -> DataFrame:
    """Digest per conversation, read from formatted windows: ``conv_id, n_turns, turns_sha256, loss_chars,
    loss_sha256, formatted_chars, n_windows``. Windows pass as a stream in order."""
    schema = T.StructType([
        T.StructField("conv_id", windows.schema["conv_id"].dataType),
        *T._parse_datatype_string(
            "n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_windows long"
        ).fields,
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        present, state, out, kind = None, None, [], None
        for batch in batches:
            kind = batch.column("conv_id").type
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "text", "loss")]
            for conv, text, loss in zip(*columns):
                if state is None or conv != present:
                    if state is not None:
                        out.append(_digest(present, state))
                    present, state = conv, [0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
                for number, role, said in parse_window(text):
                    if number == state[0]:
                        state[1].update(f"{role}\n{said}\n".encode())
                        state[0] += 1
                for part in loss:
                    said = unescape(text[part["start"] : part["stop"]])
                    state[2] += len(said)
                    state[3].update(said.encode())
                state[4] += len(text)
                state[5] += 1
        if state is not None:
            out.append(_digest(present, state))
        if out:
            columns = list(zip(*out))
            kinds = [kind, pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=schema.names)

    narrow = windows.select("conv_id", "window", "text", "loss")
    return narrow.repartition("conv_id").sortWithinPartitions("conv_id", "window").mapInArrow(run, schema)


def _digest(conv, state: list) -> tuple:
    turns, said, chars, loss, formatted, made = state
    return conv, turns, said.hexdigest(), chars, loss.hexdigest(), formatted, made


#: The conversation that the registered query adds.
EXTRA_ID, EXTRA_TEXT = -7, r"\### Assistant: </turn> ok"


def op8_chat_windows(spark, sf_dir):
    import public_tokenizers

    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    extra = spark.createDataFrame(
        [(EXTRA_ID, 0, "user", EXTRA_TEXT), (EXTRA_ID, 1, "assistant", EXTRA_TEXT)], turns.schema
    )
    windows = format_conversations(turns.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json"))
    return read_back(windows).drop("n_windows")
