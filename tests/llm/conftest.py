"""Documents with everything that may go wrong, and brute-force versions of the operators."""

import hashlib
import random

import pytest

pytest.importorskip("flatproof.llm.queries")

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (id, text) or (id, text, source)."""

    def make(rows, extra=None):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        docs = spark.createDataFrame(full, DOCS)
        for name in extra or []:
            docs = docs.selectExpr("*", f"concat('own ', doc_id) as `{name}`")
        return docs.repartition(3)

    return make


def passage(seed: int, words: int) -> str:
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("aeiounrst") for _ in range(rng.randint(2, 8))) for _ in range(words))


#: Names that the operators use inside or add.
CLASHING = ["id", "sub", "row", "key", "text of the row", "size", "copies", "score", "spans", "items", "n_words", "_id",
            "content_digest", "n_tokens", "tie", "place", "kind", "missing", "a.b"]


@pytest.fixture(scope="session")
def odd_rows():
    shared = passage(1, 60)
    return [
        (1, passage(2, 80)), (2, passage(2, 80)), (3, passage(2, 80)), (3, passage(2, 80)),  # copies and a repeated row
        (4, None), (5, ""), (6, " \t\n\x0b\x0c\r "), (7, "one"), (None, passage(3, 50)), (None, None),
        (8, passage(4, 10) + "\n" + shared + "\n" + passage(5, 10)), (9, passage(6, 12) + " " + shared),
        (9, passage(7, 40)),  # an id with two texts
        (10, passage(8, 30_000)), (11, "é" * 300 + " ñ   ü " + "漢字" * 60), (12, "é" * 300 + "!"),
        (13, "same line here\n" * 40), (-5, "x" * 1000), (14, shared),
    ]
