"""Finding repeated windows of a corpus: what substring removal by bytes and by words has in common.

A document is a sequence of symbols. A window is ``length`` consecutive symbols; the task is to find the windows whose
content starts elsewhere too. Every window has an anchor: of the grams of ``gram`` symbols inside it, the one with the
least hash, the first of equals. Equal windows have equal anchors at equal places. Consecutive windows with the same
anchor form a run; a run is at most ``length - gram + 1`` windows long and on average half of that.

1. Runs (:func:`window_runs`) are computed where the documents are. Their narrow rows go, packed, to the bucket of their
   anchor's hash.
2. In a bucket (:func:`settle`) runs of equal content form a class. Members beyond the first of a class are settled
   there. Only if an anchor has several classes may parts of runs be equal; then one representative of each class
   is asked for.
3. The texts of the representatives are fetched, joined by document, and compared by the operator's own method.
4. The windows found are joined to the documents.

Runs of one content are reduced to one per Arrow batch before they move, so a passage that a third of all documents
share arrives once per batch. An anchor with more than ``group_limit`` classes (a passage within ever new text) is
split into single windows, keyed by their whole content: an exact way that gathers only equal windows. Buckets are taken
one after the other, and a bucket holds a bounded number of runs besides one per class of the keys that are not hot.

Documents are addressed by id and a sub-number, which is 0 unless rows share an id and differ in text. Rows that are
equal in id and text are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import groups_of, running_sums, stage

#: Symbols that are hashed at once; a longer document is cut into pieces that overlap by a window less one symbol.
BLOCK = 1 << 19
#: Bytes of texts whose runs are reduced and packed together.
PART_BYTES = 12 << 20
#: Runs that a bucket holds before it reduces them.
HELD_RUNS = 1 << 20
_PLACE = np.uint64((1 << 21) - 1)

#: An odd multiplier and its inverse modulo 2**64, and odd constants for mixing.
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)
MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)

SPAN, NEED, HOT = 0, 1, 2


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread all bits of each number over the whole of it."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(MIX[0])
    x ^= x >> np.uint64(27)
    x *= np.uint64(MIX[1])
    x ^= x >> np.uint64(31)
    return x


class Hashes:
    """Hashes of all stretches of a sequence of 64-bit symbols from its prefix sums."""

    def __init__(self, symbols: np.ndarray, up: np.ndarray, down: np.ndarray):
        n = len(symbols)
        self.down = down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(symbols * up[:n], dtype=np.uint64, out=self.sums[1:])

    def fixed(self, size: int) -> np.ndarray:
        """Of every stretch of ``size`` symbols."""
        n = len(self.sums) - size
        return mixed((self.sums[size:] - self.sums[:n]) * self.down[:n]) if n > 0 else np.zeros(0, np.uint64)

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """Of the stretches from start to stop; the length counts."""
        return mixed(((self.sums[stop] - self.sums[start]) * self.down[start]) + (stop - start).astype(np.uint64))


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` consecutive values."""
    size, out = 1, values
    while size * 2 <= width:
        out = np.minimum(out[:-size], out[size:])
        size *= 2
    return np.minimum(out[: len(values) - width + 1], out[width - size :]) if size < width else out


@dataclass
class Runs:
    """One row per run: first window, number of windows, place of the anchor after the first window's start, hash of
    the anchor, hash of the content; ``piece`` is the place of the piece that it is in."""

    piece: np.ndarray
    start: np.ndarray
    count: np.ndarray
    anchor: np.ndarray
    key: np.ndarray
    content: np.ndarray


def window_runs(pieces: list[np.ndarray], length: int, gram: int, up: np.ndarray, down: np.ndarray) -> Runs:
    """The runs of some sequences of symbols, together at most some ``BLOCK`` symbols; starts count from a piece's first."""
    sizes = np.array([len(p) for p in pieces], np.int64)
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    if total < length:
        none = np.zeros(0, np.int64)
        return Runs(none, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    hashes = Hashes(np.concatenate(pieces), up, down)
    grams = hashes.fixed(gram)
    places = np.arange(len(grams), dtype=np.uint64)
    least = sliding_least((grams & ~_PLACE) | places, length - gram + 1)
    anchor = (least & _PLACE).astype(np.int64)
    valid = np.zeros(len(anchor) + 1, bool)
    opens = np.zeros(len(anchor) + 1, np.int32)
    long = sizes >= length
    np.add.at(opens, (ends - sizes)[long], 1)
    np.add.at(opens, (ends - length + 1)[long], -1)
    valid[:-1] = np.cumsum(opens[:-1]) > 0
    first = valid[:-1].copy()
    first[1:] &= (anchor[1:] != anchor[:-1]) | ~valid[:-2]
    begin = np.zeros(len(anchor), bool)
    begin[(ends - sizes)[long]] = True
    start = np.flatnonzero(first | begin)
    stop = np.r_[start[1:], len(anchor)]
    last_valid = np.searchsorted(ends, start, side="right")
    stop = np.minimum(stop, ends[last_valid] - length + 1)
    offsets = (ends - sizes)[last_valid]
    return Runs(
        last_valid, start - offsets, stop - start, anchor[start] - start, grams[anchor[start]],
        hashes.of(start, stop + length - 1),
    )


def addressed(docs: DataFrame, id_col: str, text_col: str, carry: bool = False) -> DataFrame:
    """(id, sub, none, text): a null id is the greatest long, and ``none`` is true; ``sub`` numbers the different texts of one
    id, those of a null id behind those of the greatest long. With ``carry`` also ``row``, the whole row but for its text,
    and ``missing``, whether the text is null.

    The table of ids with several texts is written out; where it is small or empty Spark sends it along, and no text
    moves for it. Its numbers are running sums, since all rows may have one id, or none.
    """
    if not isinstance(docs.schema[id_col].dataType, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer column")
    number = F.coalesce(F.col(id_col).cast("long"), F.lit((1 << 63) - 1)).alias("id")
    none = F.col(id_col).isNull().alias("none")
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    others = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("row")
    carried = [others, F.col(text_col).isNull().alias("missing")] if carry else []
    rows = docs.select(number, none, text, *carried)
    key = ["id", "none", "tie"]
    pairs = rows.select("id", "none", F.xxhash64("text").alias("tie")).distinct()
    several = pairs.groupBy("id").count().where("count > 1").select("id")
    shared = running_sums(pairs.join(several, "id").select(*key), key, at=F.lit(1))
    firsts = shared.groupBy("id").agg(F.min("at").alias("first"))
    place = (F.col("at") - F.col("first")).cast("int").alias("sub")
    numbered = stage(shared.join(firsts, "id").select(*key, place).where("sub > 0"), "shared-ids")
    tied = rows.withColumn("tie", F.xxhash64("text")).join(numbered, key, "left")
    return tied.select("id", F.coalesce("sub", F.lit(0)).alias("sub"), "none", "text", *["row", "missing"][: 2 * carry])


_COLUMNS = (("key", "<u8"), ("content", "<u8"), ("id", "<i8"), ("sub", "<i4"), ("start", "<i4"), ("count", "<u2"),
            ("anchor", "<u2"), ("flag", "u1"))
FREE, DONE, TWIN = 0, 1, 2  # flag: open; settled, goes along as a span; stands for several of its batch


def _pack(columns: dict[str, np.ndarray]) -> bytes:
    """The columns byte plane by byte plane, which leaves equal bytes side by side for the shuffle's compression."""
    return b"".join(
        np.ascontiguousarray(columns[name].astype(kind)).view(np.uint8).reshape(-1, np.dtype(kind).itemsize).T.tobytes()
        for name, kind in _COLUMNS
    )


def _unpack(data: bytes) -> dict[str, np.ndarray]:
    width = sum(np.dtype(k).itemsize for _, k in _COLUMNS)
    n, at, out = len(data) // width, 0, {}
    for name, kind in _COLUMNS:
        size = np.dtype(kind).itemsize
        planes = np.frombuffer(data, np.uint8, n * size, at).reshape(size, n)
        out[name] = np.ascontiguousarray(planes.T).view(kind).reshape(n)
        at += n * size
    return out


@dataclass(frozen=True)
class Plan:
    """``symbols`` makes the 64-bit symbols of a text; ``segment`` the bytes of some consecutive symbols of it."""

    length: int
    gram: int
    keep_first: bool
    make_symbols: Callable[[], Callable[[bytes], np.ndarray]]
    group_limit: int = 512


def _batch_runs(ids: np.ndarray, subs: np.ndarray, texts: list[bytes], plan: Plan, symbols, up, down) -> dict:
    """The rows of :data:`_COLUMNS` for the documents of one Arrow batch, runs of equal content reduced to one."""
    order = np.lexsort((subs, ids))
    # Rows that are equal in id and text are one document.
    order = order[np.r_[True, (ids[order][1:] != ids[order][:-1]) | (subs[order][1:] != subs[order][:-1])]]
    ids, subs, parts = ids[order], subs[order], []
    for part in groups_of([len(texts[i]) for i in order], BLOCK):
        pieces, of, offset = [], [], []
        for place in range(part.start, part.stop):
            sequence = symbols(texts[order[place]])
            step = BLOCK - plan.length + 1
            for a in range(0, max(1, len(sequence) - plan.length + 1), step):
                pieces.append(sequence[a : a + BLOCK])
                of.append(place)
                offset.append(a)
        of, offset = np.array(of, np.int64), np.array(offset, np.int64)
        for some in groups_of([len(p) for p in pieces], BLOCK):
            runs = window_runs(pieces[some], plan.length, plan.gram, up, down)
            piece = runs.piece + some.start
            parts.append({
                "key": runs.key, "content": runs.content, "id": ids[of[piece]], "sub": subs[of[piece]],
                "start": runs.start + offset[piece], "count": runs.count, "anchor": runs.anchor,
            })
    rows = {c: np.concatenate([p[c] for p in parts]) if parts else np.zeros(0, np.int64) for c, _ in _COLUMNS[:-1]}
    return _reduce(rows, plan.keep_first)


def _reduce(rows: dict, keep_first: bool) -> dict:
    """Rows in order of address: of each content the first goes on open; the others are settled. Without
    ``keep_first`` the first is settled as well and goes on as one that has a twin."""
    n = len(rows["content"])
    order = np.argsort(rows["content"], kind="stable")
    content = rows["content"][order]
    first = np.ones(n, bool)
    first[1:] = content[1:] != content[:-1]
    size = np.diff(np.r_[np.flatnonzero(first), n])
    flag = np.where(first, FREE, DONE)
    out = {c: rows[c][order] for c in rows}
    twin = np.zeros(n, bool)
    twin[np.flatnonzero(first)] = size > 1
    if not keep_first:
        flag[twin] = TWIN
        out = {c: np.concatenate([v, v[twin]]) for c, v in out.items()}
        flag = np.concatenate([flag, np.full(int(twin.sum()), DONE)])
    out["flag"] = flag
    return out


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """Ids, sub-numbers and texts of some :data:`PART_BYTES` of documents at a time."""
    for batch in batches:
        for part in groups_of(pc.binary_length(batch.column("text")).to_pylist(), PART_BYTES):
            some = batch.slice(part.start, part.stop - part.start)
            ids, subs = (some.column(c).to_numpy().astype(np.int64) for c in ("id", "sub"))
            yield ids, subs, some.column("text").to_pylist()


def packed_runs(texts: DataFrame, plan: Plan, buckets: int) -> DataFrame:
    """(bucket, data): the runs of all documents; settled ones go to a bucket of their document."""
    length, gram = plan.length, plan.gram
    assert 0 < gram < length < 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols = plan.make_symbols()
        up, down = powers(BASE, BLOCK + 1), powers(BASE_INVERSE, BLOCK + 1)
        for ids, subs, texts in _parts(batches):
            rows = _batch_runs(ids, subs, texts, plan, symbols, up, down)
            route = np.where(rows["flag"] == DONE, mixed(rows["id"].astype(np.uint64)), rows["key"])
            bucket = (route >> np.uint64(8)) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
            filled = np.flatnonzero(cuts[1:] > cuts[:-1])
            for some in range(0, len(filled), 256):
                chosen = filled[some : some + 256]
                data = [_pack({c: v[order[cuts[b] : cuts[b + 1]]] for c, v in rows.items()}) for b in chosen]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chosen.astype(np.int32)), pa.array(data, pa.binary())], names=["bucket", "data"]
                )

    return texts.mapInArrow(run, "bucket int, data binary")


FOUND = "kind int, key long, id long, sub int, start int, count int, anchor int"


def _classes(rows: dict) -> tuple[dict, np.ndarray, np.ndarray]:
    """Rows in order of key, content and address without repeated addresses; first of class, first of key."""
    order = np.lexsort((rows["start"], rows["sub"], rows["id"], rows["content"], rows["key"]))
    rows = {c: v[order] for c, v in rows.items()}
    n = len(order)

    def changes(*names: str) -> np.ndarray:
        out = np.zeros(n, bool)
        out[:1] = True
        for c in names:
            out[1:] |= rows[c][1:] != rows[c][:-1]
        return out

    fresh = changes("key", "content", "id", "sub", "start")
    rows = {c: v[fresh] for c, v in rows.items()}
    n = int(fresh.sum())
    return rows, changes("key", "content"), changes("key")


def settle_bucket(rows: dict, plan: Plan) -> dict:
    """Rows of :data:`FOUND` for the runs of some whole keys."""
    done = rows["flag"] == DONE
    spans = [{c: v[done] for c, v in rows.items()}]
    rows, first, first_key = _classes({c: v[~done] for c, v in rows.items()})
    n = len(first)
    class_of = np.cumsum(first) - 1
    size = np.bincount(class_of, minlength=0)
    several = size[class_of] > 1 if n else np.zeros(0, bool)
    twin = rows["flag"] == TWIN
    spans.append({c: v[~first if plan.keep_first else several & ~twin] for c, v in rows.items()})
    # One representative per class; those of keys with several classes are compared further.
    key_of = np.cumsum(first_key) - 1
    classes = np.bincount(key_of[first], minlength=0)
    wanted = first & (classes[key_of] > 1) if n else first
    if not plan.keep_first and n:
        # Nothing is left to be found where every class has several members.
        has_twin = np.bincount(class_of, twin, len(size)) > 0
        open_class = (size == 1) & ~has_twin
        open_keys = np.bincount(key_of[first], open_class, len(classes)) > 0
        wanted &= open_keys[key_of]
    hot = wanted & (classes[key_of] > plan.group_limit) if n else wanted
    out = [(SPAN, x) for x in spans] + [(NEED, {c: v[wanted & ~hot] for c, v in rows.items()}),
                                        (HOT, {c: v[hot] for c, v in rows.items()})]
    joined = {c: np.concatenate([x[c] for _, x in out]) for c in ("key", "id", "sub", "start", "count", "anchor")}
    joined["kind"] = np.concatenate([np.full(len(x["id"]), k) for k, x in out])
    return joined


def _found_batch(rows: dict) -> pa.RecordBatch:
    kinds = {"kind": np.int32, "key": np.int64, "id": np.int64, "sub": np.int32, "start": np.int32, "count": np.int32,
             "anchor": np.int32}
    arrays = [pa.array(rows[c].view(np.int64) if c == "key" else rows[c].astype(k)) for c, k in kinds.items()]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


class Bucket:
    """The runs of one bucket as they come in, in bounded memory.

    Once ``HELD_RUNS`` are held they are reduced: of each class one representative stays, the settled members go out. A
    key that has more than ``group_limit`` classes by then is hot: its representatives go out as runs to be looked at
    window by window, and so does whatever comes for it later, unseen. What stays is bounded by the number of keys.
    """

    def __init__(self, plan: Plan):
        self.plan, self.parts, self.held, self.room = plan, [], 0, HELD_RUNS
        self.hot = np.zeros(0, np.uint64)

    def add(self, rows: dict) -> Iterator[tuple[int, dict]]:
        done = rows["flag"] == DONE
        yield SPAN, {c: v[done] for c, v in rows.items()}
        rows = {c: v[~done] for c, v in rows.items()}
        if len(self.hot):
            hot = np.isin(rows["key"], self.hot)
            yield HOT, {c: v[hot] for c, v in rows.items()}
            rows = {c: v[~hot] for c, v in rows.items()}
        self.parts.append(rows)
        self.held += len(rows["key"])
        if self.held > self.room:
            yield from self.reduce()

    def reduce(self) -> Iterator[tuple[int, dict]]:
        rows, first, first_key = _classes({c: np.concatenate([p[c] for p in self.parts]) for c, _ in _COLUMNS})
        class_of = np.cumsum(first) - 1
        several = np.bincount(class_of)[class_of] > 1
        if self.plan.keep_first:
            yield SPAN, {c: v[~first] for c, v in rows.items()}
        else:
            # A representative that was told of a twin before has gone out already.
            yield SPAN, {c: v[several & (rows["flag"] != TWIN)] for c, v in rows.items()}
            twin = np.bincount(class_of, rows["flag"] == TWIN) > 0
            rows["flag"] = np.where(several | twin[class_of], TWIN, rows["flag"])
        key_of = np.cumsum(first_key) - 1
        hot = np.bincount(key_of[first])[key_of] > self.plan.group_limit
        yield HOT, {c: v[first & hot] for c, v in rows.items()}
        self.hot = np.union1d(self.hot, rows["key"][first & hot])
        self.parts = [{c: v[first & ~hot] for c, v in rows.items()}]
        self.held = int((first & ~hot).sum())
        self.room = max(HELD_RUNS, 2 * self.held)

    def close(self) -> Iterator[tuple[int, dict]]:
        rows = {c: np.concatenate([p[c] for p in self.parts]) for c, _ in _COLUMNS}
        found = settle_bucket(rows, self.plan)
        for kind in (SPAN, NEED, HOT):
            own = found["kind"] == kind
            yield kind, {c: v[own] for c, v in found.items()}


def _found_batches(found: Iterator[tuple[int, dict]]) -> Iterator[pa.RecordBatch]:
    """Batches of :data:`FOUND` of a fair size, from pieces of any."""
    held, size = [], 0

    def batch() -> pa.RecordBatch:
        return _found_batch({c: np.concatenate([h[c] for h in held]) for c in held[0]})

    for kind, rows in found:
        n = len(rows["key"])
        for a in range(0, n, 1 << 17):
            part = {c: rows[c][a : a + (1 << 17)] for c in ("key", "id", "sub", "start", "count", "anchor")}
            held.append({**part, "kind": np.full(len(part["key"]), kind)})
            size += len(part["key"])
            if size >= 1 << 17:
                yield batch()
                held, size = [], 0
    if held:
        yield batch()


def settle(packed: DataFrame, plan: Plan) -> DataFrame:
    """Rows of :data:`FOUND`; a task has its buckets one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple[int, dict]]:
            number, bucket = None, None
            for batch in batches:
                for b, data in zip(batch.column("bucket").to_pylist(), batch.column("data")):
                    if b != number:
                        if bucket is not None:
                            yield from bucket.close()
                        number, bucket = b, Bucket(plan)
                    yield from bucket.add(_unpack(data.as_buffer().to_pybytes()))
            if bucket is not None:
                yield from bucket.close()

        yield from _found_batches(found())

    return packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, FOUND)


SEGMENTS = "key long, id long, sub int, start int, count int, anchor int, segment binary"


def _segments(texts: DataFrame, asked: DataFrame, plan: Plan, cut: Callable[[], Callable]) -> DataFrame:
    """The text of every run that is asked for; a run of a key with very many classes as single windows, without text,
    equal ones reduced to one per Arrow batch.

    ``cut`` makes a function from a text, starts and stops (in symbols) to the bytes of these stretches.
    """
    one = F.struct("kind", "key", "start", "count", "anchor")
    lists = asked.groupBy("id", "sub").agg(F.collect_list(one).alias("runs"))
    joined = texts.join(lists.hint("shuffle_hash"), ["id", "sub"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, stretches = plan.make_symbols(), cut()
        up = down = None
        for batch in batches:
            ids, subs = (batch.column(c).to_numpy() for c in ("id", "sub"))
            bounds, runs = list_columns(batch.column("runs"))
            held, size, single = [], 0, []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = {c: v[bounds[i] : bounds[i + 1]] for c, v in runs.items()}
                need = own["kind"] == NEED
                if need.any():
                    start, count = own["start"][need], own["count"][need]
                    cuts = stretches(text, start.tolist(), (start + count + plan.length - 1).tolist())
                    held.append((own["key"][need], ids[i], subs[i], start, count, own["anchor"][need], cuts))
                    size += len(cuts)
                if not need.all():
                    if up is None:
                        up, down = powers(BASE, 2 * plan.length), powers(BASE_INVERSE, 2 * plan.length)
                    sequence = symbols(text)
                    for first, n in zip(own["start"][~need].tolist(), own["count"][~need].tolist()):
                        key = Hashes(sequence[first : first + n + plan.length - 1], up, down).fixed(plan.length)
                        single.append((key, np.full(n, ids[i]), np.full(n, subs[i]), first + np.arange(n)))
                if size > 20_000:
                    yield _segment_batch(held)
                    held, size = [], 0
            if held:
                yield _segment_batch(held)
            if single:
                yield _single_windows(*(np.concatenate(v) for v in zip(*single)), plan.keep_first)

    return joined.mapInArrow(run, SEGMENTS)


def _single_windows(key: np.ndarray, id_: np.ndarray, sub: np.ndarray, start: np.ndarray, keep_first: bool) -> pa.RecordBatch:
    """Rows of :data:`SEGMENTS` for single windows: equal ones of a batch reduced to one. ``anchor`` holds the flag; what
    is settled goes along as ranges, dealt by document."""
    order = np.lexsort((start, sub, id_, key))
    rows = {c: v[order] for c, v in (("id", id_), ("sub", sub), ("start", start))}
    rows["content"] = key[order]
    # Rows that are equal in id and text are one document.
    fresh = np.ones(len(order), bool)
    fresh[1:] = rows["content"][1:] != rows["content"][:-1]
    for c in ("id", "sub", "start"):
        fresh[1:] |= rows[c][1:] != rows[c][:-1]
    rows = _reduce({c: v[fresh] for c, v in rows.items()}, keep_first)
    done = rows["flag"] == DONE
    place = {c: rows[c][done] for c in ("id", "sub", "start")}
    order = np.lexsort((place["start"], place["sub"], place["id"]))
    place = {c: v[order] for c, v in place.items()}
    begin = np.ones(len(order), bool)
    begin[1:] = place["start"][1:] != place["start"][:-1] + 1
    for c in ("id", "sub"):
        begin[1:] |= place[c][1:] != place[c][:-1]
    first = np.flatnonzero(begin)
    counts = np.diff(np.r_[first, len(order)])
    route = mixed(place["id"][first].astype(np.uint64))
    columns = [np.concatenate([route, rows["content"][~done]]).view(np.int64)]
    columns += [np.concatenate([place[c][first], rows[c][~done]]) for c in ("id", "sub", "start")]
    columns += [np.concatenate([counts, np.ones(int((~done).sum()), np.int64)]), np.concatenate([np.full(len(first), DONE), rows["flag"][~done]])]
    kinds = (np.int64, np.int64, np.int32, np.int32, np.int32, np.int32)
    arrays = [pa.array(v.astype(k)) for v, k in zip(columns, kinds)]
    arrays.append(pa.nulls(len(columns[0]), pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=["key", "id", "sub", "start", "count", "anchor", "segment"])


def list_columns(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """A column of lists of structs as the bounds of each list and the struct's columns, without Python objects."""
    values = column.values
    return column.offsets.to_numpy(), {f.name: values.field(i).to_numpy() for i, f in enumerate(values.type)}


def _segment_batch(held: list[tuple]) -> pa.RecordBatch:
    sizes = [len(h[0]) for h in held]
    key, id_, sub, start, count, anchor, cuts = zip(*held)
    columns = [
        pa.array(np.concatenate(key)), pa.array(np.repeat(np.array(id_, np.int64), sizes)),
        pa.array(np.repeat(np.array(sub, np.int32), sizes)),
        *[pa.array(np.concatenate(v).astype(np.int32)) for v in (start, count, anchor)],
        pa.array([c for x in cuts for c in x], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, names=["key", "id", "sub", "start", "count", "anchor", "segment"])


SPANS = "id long, sub int, start int, count int"


def _by_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows in order of key as tables of whole keys, of about :data:`BLOCK` bytes of text. Settled ranges belong to no key and
    go along with what comes."""
    held, size = [], 0
    for batch in batches:
        for a in range(0, batch.num_rows, 4096):
            part = batch.slice(a, 4096)
            if not part.num_rows:
                continue
            if size >= 8 * BLOCK:
                keys = part.column("key").to_numpy()
                last = held[-1].column("key")[-1].as_py()
                same = int(np.searchsorted(keys != last, True))
                if same < len(keys):
                    yield pa.Table.from_batches([*held, part.slice(0, same)])
                    held, size, part = [], 0, part.slice(same)
            held.append(part)
            size += part.nbytes
    if held:
        yield pa.Table.from_batches(held)


def _resolve(segments: DataFrame, plan: Plan, compare: Callable) -> DataFrame:
    """(id, sub, start, count): repeated windows among the segments of each key.

    ``compare`` gets the columns of some whole keys, in order of key and address, and returns places of rows, first
    windows inside them and numbers of windows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _by_keys(batches):
            yield from resolved(table)

    def resolved(table: pa.Table) -> Iterator[pa.RecordBatch]:
        numbers = {c: table.column(c).to_numpy() for c in ("key", "id", "sub", "start", "count", "anchor")}
        order = np.lexsort((numbers["start"], numbers["sub"], numbers["id"], numbers["key"]))
        # Rows that are equal in id and text are one document.
        fresh = np.zeros(len(order), bool)
        fresh[0] = True
        for c in ("key", "id", "sub", "start"):
            fresh[1:] |= numbers[c][order[1:]] != numbers[c][order[:-1]]
        order = order[fresh]
        numbers = {c: v[order].astype(np.int64) for c, v in numbers.items()}
        texts = table.column("segment").to_pylist()
        texts = [texts[i] for i in order]
        single = np.array([t is None for t in texts], bool)
        parts = []
        # Settled ranges pass through; of single windows equal keys are equal windows.
        passed = np.flatnonzero(single & (numbers["anchor"] == DONE))
        parts.append((passed, np.zeros(len(passed), np.int64), numbers["count"][passed]))
        some = np.flatnonzero(single & (numbers["anchor"] != DONE))
        if len(some):
            key = numbers["key"][some]
            begins = np.r_[True, key[1:] != key[:-1]]
            sizes = np.diff(np.r_[np.flatnonzero(begins), len(key)])
            twin = numbers["anchor"][some] == TWIN
            repeated = ~begins if plan.keep_first else np.repeat(sizes > 1, sizes) & ~twin
            parts.append((some[repeated], np.zeros(int(repeated.sum()), np.int64), np.ones(int(repeated.sum()), np.int64)))
        rest = np.flatnonzero(~single)
        key = numbers["key"][rest]
        begins = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        weights = np.add.reduceat([len(texts[i]) for i in rest], begins) if len(begins) else []
        bounds = np.r_[begins, len(rest)]
        for group in groups_of(weights, BLOCK):
            places = rest[bounds[group.start] : bounds[group.stop]]
            rows, first, count = compare(
                [texts[i] for i in places], {c: v[places] for c, v in numbers.items()}, plan
            )
            parts.append((places[rows], first, count))
        if parts:
            rows, first, count = (np.concatenate(x) for x in zip(*parts))
            for a in range(0, len(rows), 1 << 17):
                r = rows[a : a + (1 << 17)]
                arrays = [
                    pa.array(numbers["id"][r]), pa.array(numbers["sub"][r].astype(np.int32)),
                    pa.array((numbers["start"][r] + first[a : a + (1 << 17)]).astype(np.int32)),
                    pa.array(count[a : a + (1 << 17)].astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "sub", "start", "count"])

    return segments.repartition("key").sortWithinPartitions("key").mapInArrow(run, SPANS)


def repeated_windows(
    docs: DataFrame, plan: Plan, cut: Callable, compare: Callable, id_col: str, text_col: str, carry: bool = False
) -> DataFrame:
    """(id, sub, text, windows): every document with the ranges (start, count) of its repeated windows, or null. With
    ``carry`` also what :func:`addressed` carries.

    The texts are dealt by document once; both joins with them use that shuffle.
    """
    spark = docs.sparkSession
    named = addressed(docs, id_col, text_col, carry)
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = stage(settle(packed_runs(named.select("id", "sub", "text"), plan, buckets), plan), "runs")
    texts = named.repartition("id", "sub")
    segments = _segments(texts, found.where(F.col("kind") != SPAN), plan, cut)
    spans = found.where(F.col("kind") == SPAN).select("id", "sub", "start", "count")
    spans = spans.unionByName(_resolve(segments, plan, compare))
    ranges = spans.groupBy("id", "sub").agg(F.collect_list(F.struct("start", "count")).alias("windows"))
    return texts.join(ranges.hint("shuffle_hash"), ["id", "sub"], "left")


class Covered:
    """What the windows of a batch of :func:`repeated_windows` cover."""

    def __init__(self, batch: pa.RecordBatch, length: int):
        self.length = length
        bounds, self.windows = list_columns(batch.column("windows"))
        self.bounds = bounds.tolist()

    def any(self, row: int) -> bool:
        return self.bounds[row] < self.bounds[row + 1]

    def ranges(self, row: int, size: int) -> list[tuple[int, int]]:
        """Maximal ranges of covered symbols of a document of ``size`` symbols, in order."""
        if not self.any(row):
            return []
        own = slice(self.bounds[row], self.bounds[row + 1])
        starts = self.windows["start"][own]
        edges = np.zeros(size + 1, np.int32)
        np.add.at(edges, starts, 1)
        np.add.at(edges, starts + self.windows["count"][own] + self.length - 1, -1)
        inside = np.r_[False, np.cumsum(edges[:-1]) > 0, False]
        change = np.flatnonzero(inside[1:] != inside[:-1])
        return list(zip(change[::2].tolist(), change[1::2].tolist()))
