"""Token counts through a digest cache.

The cache is a table of (content digest, tokenizer digest, token count) in shared storage. Documents are joined to it
by the digest of their normalised content; of the contents it lacks, one document each is encoded, and the new counts
are appended. Texts move once, spread evenly by document; digests and counts are narrow.

Inside a task, byte-level tokenizers count by piece: a text is cut before single spaces between two visible characters,
where such a tokenizer always starts a new word, and the counts of pieces are remembered. The library encodes each
distinct piece. Other tokenizers, and texts that hold one of the tokenizer's special strings, are encoded whole.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable, Iterator
from importlib.metadata import version

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import has_table
from .common import groups_of, pack, scratch_path, stage, unpack

BLOCK_BYTES = 4 << 20
#: Pieces remembered by a task; beyond it, remembering starts anew.
PIECES = 400_000
#: Largest tokenizer file that is sent to the tasks.
TOKENIZER_BYTES = 64 << 20

CACHE_SCHEMA = "content_digest string, tokenizer_digest string, n_tokens long"


def tokenizer_digest(path: str) -> str:
    """Digest of the tokenizer file, its library and the library's version: what a stored count depends on."""
    library = "sentencepiece" if path.endswith(".model") else "tokenizers"
    with open(path, "rb") as file:
        return hashlib.sha256(f"{library} {version(library)}\n".encode() + file.read()).hexdigest()


def counts_by_piece(config: dict) -> bool:
    """Whether the tokenizer is byte-level BPE that splits by its usual pattern and changes no text before that."""
    steps = config.get("pre_tokenizer") or {}
    plain = steps.get("type") == "ByteLevel" and steps.get("use_regex", True) and not steps.get("add_prefix_space")
    model = config.get("model") or {}
    steady = model.get("type") == "BPE" and not model.get("dropout") and not model.get("ignore_merges")
    return bool(plain and steady and not config.get("normalizer") and not config.get("truncation"))


def pieces_of(text: str) -> list[str]:
    """The text cut before each single space that stands between two visible characters."""
    parts = text.split(" ")
    out = [parts[0]]
    for part in parts[1:]:
        last = out[-1]
        if part and last and not part[0].isspace() and not last[-1].isspace():
            out.append(" " + part)
        else:
            out[-1] = f"{last} {part}"
    return out


def _plain_split(text: str) -> list[str]:
    """As :func:`pieces_of`, at the speed of ``split`` where all white space at stake is single spaces."""
    parts = text.split(" ")
    if all([p and not p[0].isspace() and not p[-1].isspace() for p in parts]):
        return [parts[0], *[" " + p for p in parts[1:]]]
    return pieces_of(text)


def text_counter(name: str, content: bytes) -> Callable[[list[str]], list[int]]:
    """A function from texts to token counts, without begin, end or added special tokens, for tokenizer file content."""
    if name.endswith(".model"):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(content.decode())
    tokenizer.no_truncation()
    tokenizer.no_padding()

    def whole(texts: list[str]) -> list[int]:
        # The fast form leaves out offsets, which a count doesn't need.
        return [len(x) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    config = json.loads(content)
    if not counts_by_piece(config):
        return whole
    special = [t["content"] for t in config.get("added_tokens", [])]
    known: dict[str, int] = {}

    def by_piece(texts: list[str]) -> list[int]:
        cut = [None if any(s in t for s in special) else _plain_split(t) for t in texts]
        fresh = list(set().union(*[c for c in cut if c]).difference(known))
        if len(known) + len(fresh) > PIECES:
            known.clear()
            fresh = list(set().union(*[c for c in cut if c]))
        for i in range(0, len(fresh), 10_000):
            known.update(zip(fresh[i : i + 10_000], whole(fresh[i : i + 10_000])))
        get = known.__getitem__
        odd = iter(whole([t for t, c in zip(texts, cut) if c is None]))
        return [next(odd) if c is None else sum(map(get, c)) for c in cut]

    return by_piece


def read_cache(spark: SparkSession, path: str, tokenizer: str) -> DataFrame:
    """(content_digest, n_tokens) of one tokenizer; a count that two runs both stored is there once."""
    if not has_table(spark, path):
        return spark.createDataFrame([], "content_digest string, n_tokens long")
    stored = spark.read.schema(CACHE_SCHEMA).parquet(path).where(F.col("tokenizer_digest") == tokenizer)
    return stored.groupBy("content_digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(
    docs: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    normalise: Callable[[Column], Column] = lambda text: text,
    limit: int = 512,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Each row with ``n_bytes, n_tokens, over_limit``; these replace input columns of the same names.

    ``normalise`` maps a text column to the content that is counted; the default leaves texts as they are. A null text
    counts as empty, which has no tokens. Rows with a null id, repeated ids and repeated rows are all counted. The
    cache may be absent, hold counts of other tokenizers, or be appended to by several runs at once.
    """
    spark = docs.sparkSession
    digest = tokenizer_digest(tokenizer_path)
    with open(tokenizer_path, "rb") as file:
        content = file.read()
    if len(content) > TOKENIZER_BYTES:
        raise ValueError(f"the tokenizer file has more than {TOKENIZER_BYTES} bytes")
    name = os.path.basename(tokenizer_path)
    sent = spark.sparkContext.broadcast(content)
    text = F.coalesce(normalise(F.col(text_col)), F.lit(""))
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))

    narrow = docs.select(key.alias("key"), F.sha2(text, 256).alias("content_digest"))
    one_each = narrow.groupBy("content_digest").agg(F.min("key").alias("key"))
    missing = one_each.join(read_cache(spark, cache_path, digest), "content_digest", "left_anti")
    wanted = missing.withColumnRenamed("content_digest", "_digest").withColumnRenamed("key", "_key")
    texts = docs.select(key.alias("key"), F.sha2(text, 256).alias("content_digest"), text.alias("text"))
    chosen = texts.join(
        wanted.hint("shuffle_hash"), (F.col("key") == F.col("_key")) & (F.col("content_digest") == F.col("_digest"))
    ).select("content_digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = text_counter(name, sent.value)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            counts = []
            for part in groups_of(map(len, texts), BLOCK_BYTES):
                counts += count(texts[part])
            stamp = pa.array([digest] * len(counts), pa.string())
            columns = [batch.column("content_digest"), stamp, pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["content_digest", "tokenizer_digest", "n_tokens"])

    chosen.mapInArrow(run, CACHE_SCHEMA).write.mode("append").parquet(cache_path)
    # A written table on this side, so that the join has two plain shuffles and a frequent digest can be split.
    stored = read_cache(spark, cache_path, digest)
    counts = stage(one_each.select("content_digest").join(stored, "content_digest", "left"), "counts")
    counts = counts.withColumnRenamed("content_digest", "_digest")
    packed = pack(docs, content_digest=F.sha2(text, 256), n_bytes=F.octet_length(text).cast("long"))
    counted = packed.join(counts, F.col("content_digest") == F.col("_digest"), "left")
    # A ``normalise`` that gives another text each time must not lose rows.
    lost = F.raise_error(F.lit("a text without a count: it is not the same each time it is normalised")).cast("long")
    n_tokens = F.coalesce("n_tokens", lost)
    return unpack(counted, docs.columns, n_bytes=F.col("n_bytes"), n_tokens=n_tokens, over_limit=n_tokens > limit)


def op1_token_counts(spark, sf_dir):
    """With a new cache, so that every distinct text is encoded."""
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = count_tokens(docs, path, scratch_path(spark, "token-cache"))
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")
