"""The pipeline on whole small tables, and every registered query of the package."""

import os

import corpus_pipeline
import pytest
from conftest import CLASHING, passage
from pyspark.sql import functions as F
from test_llm_sets import brute_fingerprint, brute_groups, brute_targets, words
from test_llm_suffixes import brute_words
from test_llm_text_operators import brute_contamination

from flatproof.llm import mixing, quality
from flatproof.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The rows before each stage and after the last."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs.collect()]
    for i, (_, step) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        step(spark, docs, SF_DIR).write.parquet(path)
        docs = spark.read.parquet(path)
        out.append(docs.collect())
    return out


def test_stages_are_named_and_keep_the_columns(spark, steps):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "SimHash near-dedup", "substring dedup", "benchmark decontamination",
        "mixing sources to target weights",
    ]
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    for rows in steps[:-1]:
        assert list(rows[0].asDict()) == columns
        assert all(r.n_chars == len(r.text) for r in rows)


def test_quality_stage_keeps_what_the_query_accepts(spark, steps):
    accepted = {r.doc_id for r in quality.op3_quality_trees(spark, SF_DIR).where("predicted = 1").collect()}
    assert {r.doc_id for r in steps[1]} == accepted
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = {r.doc_id for r in steps[1]}
    assert all(i in kept for i, q in labels.items() if q == 1)
    assert sum(i in kept for i, q in labels.items() if q == 0) <= 1


def test_near_duplicate_stage_against_brute_force(steps):
    groups = brute_groups([(r.doc_id, brute_fingerprint(r.text)) for r in steps[1]], 4)
    assert sorted(r.doc_id for r in steps[2]) == sorted({c for _, _, c in groups})
    before = {r.doc_id: r for r in steps[1]}
    assert all(r == before[r.doc_id] for r in steps[2])


def test_substring_stage_against_brute_force(steps):
    from conftest import sha

    want = brute_words([(r.doc_id, r.text) for r in steps[2]], 35)
    got = {r.doc_id: sha(b" ".join(r.text.encode().split())) for r in steps[3]}
    assert got == {i: digest for (i, _), (_, _, _, digest) in want.items()}
    before = {r.doc_id: r.text for r in steps[2]}
    untouched = {i for (i, _), w in want.items() if w[2] == 0}
    assert untouched and all(r.text == before[r.doc_id] for r in steps[3] if r.doc_id in untouched)
    assert len(untouched) < len(steps[3])


def test_decontamination_stage_against_brute_force(spark, steps):
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    hits = {d: len(h) for d, _, h, _ in brute_contamination([(r.doc_id, r.text) for r in steps[3]], items)}
    before = {r.doc_id: r.text for r in steps[3]}
    after = brute_contamination([(r.doc_id, r.text) for r in steps[4]], items)
    assert len(after) == len(steps[3])
    for r in steps[4]:
        if not hits[r.doc_id]:
            assert r.text == before[r.doc_id]
    counts = {d: n for d, n, _, _ in after}
    whole = {d: n for d, n, _, _ in brute_contamination(list(before.items()), items)}
    assert all(counts[d] == whole[d] - hits[d] for d in counts)


def test_mixing_stage(steps):
    sizes = {}
    for r in steps[4]:
        sizes[r.source] = sizes.get(r.source, 0) + words(r.text)
    target, taken, longest = brute_targets(sizes), {}, max(words(r.text) for r in steps[4])
    copies = {}
    for r in steps[5]:
        taken[r.source] = taken.get(r.source, 0) + words(r.text)
        copies.setdefault(r.doc_id, []).append(r.copy)
    assert all(sorted(c) == list(range(1, len(c) + 1)) and len(c) <= 3 for c in copies.values())
    assert all(abs(taken.get(s, 0) - t) <= 2 * longest for s, t in target.items())


def test_run_applies_all_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF_DIR)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps[-1]))


def test_pipeline_of_odd_documents(spark, odd_rows, docs_of, tmp_path):
    tables = tmp_path / "tables"
    docs_of(odd_rows, ["score", "spans", "row", "copies"]).write.parquet(f"{tables}/documents.parquet")
    spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, None, None)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tables}/labels.parquet")
    spark.createDataFrame([(1, None), (None, "one")], "item_id bigint, text string").write.parquet(f"{tables}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tables))
    assert {"doc_id", "text", "score", "spans", "row", "copies", "copy"} <= set(out.columns)
    assert out.where(F.col("doc_id") == 10).count() >= 1
    docs_of([]).write.parquet(f"{tmp_path}/none/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{tables}/{t}.parquet").write.parquet(f"{tmp_path}/none/{t}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").collect() == []


def test_near_duplicate_stage_keeps_one_row_of_each_group(docs_of):
    """Rows that share an id, or have none, count by their texts."""
    copies = {s: [passage(s, 60), passage(s, 60).upper()] for s in (1, 2, 3, 4)}
    rows = [(0, passage(50 + i, 60)) for i in range(20)]  # a placeholder id with unrelated texts
    rows += [(0, passage(50, 60))] * 3  # equal in id and text
    rows += [(9, copies[1][0]), (9, copies[2][0]), (8, copies[2][1])]  # one text of id 9 leads, the other is a copy of 8's
    rows += [(None, copies[3][0]), (None, copies[3][0]), (None, copies[3][1])]  # a group without ids
    rows += [(None, copies[4][0]), (30, copies[4][1])]  # an id comes before none
    rows += [(None, None), (None, ""), (None, " ")]  # texts without words
    kept = [(r.doc_id, r.text) for r in corpus_pipeline.simhash_near_dedup(None, docs_of(rows, CLASHING), None).collect()]
    groups = brute_groups([(n, brute_fingerprint(t)) for n, (_, t) in enumerate(rows)], 4)
    by_group = {}
    for n, _, group in groups:
        by_group.setdefault(group, set()).add(rows[n])
    assert len(kept) == len(by_group) == 20 + 2 + 1 + 1 + 1
    assert all(sum(k in members for k in kept) == 1 for members in by_group.values())
    ids = {group: min((i is None, i or 0) for i, _ in members) for group, members in by_group.items()}
    assert sorted((i is None, i or 0) for i, _ in kept) == sorted(ids.values())
    assert {(9, copies[1][0]), (8, copies[2][1]), (30, copies[4][1])} <= set(kept)
    assert sorted(corpus_pipeline.simhash_near_dedup(None, docs_of([]), None).collect()) == []


def test_each_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


def test_mixture_comes_near_its_targets_on_whole_tables(spark):
    rows = mixing.op10_systematic_mix(spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "source")
    sums = rows.join(docs, "doc_id").groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("largest")
    ).collect()
    assert all(abs(r.taken - r.target) <= 2 * r.largest for r in sums)
