import hashlib
import os

import pytest
from pyspark.sql import functions as F

from flatproof.operators import merge
from flatproof.sources import lines as L
from flatproof.sources import sinks, tables
from flatproof.streaming.ingest import ingest, stream_lines


def write(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_listing_and_masks(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    write(one, "a.csv", "x" * 150)
    write(one, "b.dat", "x")
    write(one, ".hidden.csv", "x")
    write(two, "c.mbi", "x" * 50)
    write(os.path.join(two, "deep"), "d.txt", "x")
    got = {r["file_name"]: r["size"] for r in L.list_files(spark, [one, two]).collect()}
    assert got == {"a.csv": 150, "c.mbi": 50}
    assert L.list_files(spark, [one, two], recursive=True).count() == 3
    files = L.list_files(spark, [one, two], recursive=True)
    assert L.latest_of_pattern(files).first()["file_name"] == "d.txt"


def test_line_numbers_over_many_splits(spark, tmp_path):
    """A file cut into many blocks, a small one, and one with blank lines."""
    folder = str(tmp_path / "in")
    write(folder, "big.txt", "".join(f"line {i}\n" for i in range(1, 5001)))
    write(folder, "small.txt", "one\ntwo\r\nthree")
    write(folder, "blank.txt", "a\n\n  \nb\n")
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "64")
    try:
        src = L.read_lines(spark, [folder], masks=["*.txt"])
        assert src.select("part", "block").distinct().count() > 10
        base = F.element_at(F.split("file", "/"), -1).alias("name")
        got = L.number_lines(src).select(base, "source_row_no", "line").collect()
        big = sorted((r["source_row_no"], r["line"]) for r in got if r["name"] == "big.txt")
        assert big == [(i, f"line {i}") for i in range(1, 5001)]
        assert [(r["source_row_no"], r["line"]) for r in got if r["name"] == "small.txt"] == [(1, "one"), (2, "two"), (3, "three")]
        assert [r["source_row_no"] for r in got if r["line"] == "b"] == [4]
        dense = L.number_lines(src, skip_blank=True).select(base, "source_row_no", "line").collect()
        assert [(r["source_row_no"], r["line"]) for r in dense if r["name"] == "blank.txt"] == [(1, "a"), (2, "b")]
        plan = L.number_lines(src)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    finally:
        for k, v in old.items():
            spark.conf.set(k, v) if v else spark.conf.unset(k)


def test_line_predicate(spark, tmp_path):
    write(str(tmp_path), "f.txt", "IB,1\nnote\nIC,2\n")
    kept = L.read_lines(spark, [str(tmp_path)], keep=F.col("line").rlike("^I[B-Z],"))
    assert sorted(r["line"] for r in L.number_lines(kept).collect()) == ["IB,1", "IC,2"]


def test_ordered_text_output_with_a_hot_file(spark, tmp_path):
    """A file with most rows is written as several ordered parts and reads back in order."""
    rows = spark.range(3000).selectExpr(
        "if(id % 10 = 0, 'rare', 'hot') as out_file", "3000 - id as row_no", "cast(3000 - id as string) as file_row"
    )
    path = str(tmp_path / "out")
    sinks.write_lines(rows, path, partitions=6)
    hot = [f for f in os.listdir(os.path.join(path, "out_file=hot")) if f.startswith("part-")]
    assert len(hot) > 1
    lines = L.as_logical_files(L.read_lines(spark, [path], recursive=True))
    got = L.number_lines(lines).where("file = 'hot'").orderBy("source_row_no").collect()
    values = [int(r["line"]) for r in got]
    assert values == sorted(values) and len(values) == 2700
    assert [r["source_row_no"] for r in got] == list(range(1, 2701))


def test_csv_inputs(spark, tmp_path):
    path = write(
        str(tmp_path), "crm.csv",
        'bencode,crm,mail,services,contact,contact_mail,start\n"""EMP001""",Ann,a@x.org,"s, t",c,d,2020\nEMP002,Bo,,,,\n',
    )
    got = tables.read_account_managers(spark, [path]).collect()
    assert (got[0]["bencode"], got[0]["emp_services"], got[1]["crm"]) == ("EMP001", "s, t", "Bo")
    invoices = write(
        str(tmp_path), "inv.csv",
        "Type,Date,Num,Name,Memo,Agent,Qty,Sales Price,Amount,Open Balance\n"
        'Invoice,01/31/2024,77,Client,Fee,Agent,2,"1,000.50","2,001.00",\nInvoice,bad,78,C,F,A,x,,,5\n',
    )
    inv = tables.read_invoices(spark, [invoices]).collect()
    assert (str(inv[0]["sales_price"]), str(inv[0]["open_balance"]), str(inv[0]["date"])) == ("1000.50", "0.00", "2024-01-31")
    assert (inv[1]["date"], str(inv[1]["qty"])) == (None, "0.00")
    like = spark.createDataFrame([(1, "x")], "id int, name string")
    typed = write(str(tmp_path), "t.csv", "a,b\n5,five\nzz,none\n")
    assert [tuple(r) for r in tables.read_csv_like_table(spark, [typed], like).collect()] == [(5, "five"), (None, "none")]


def test_source_folders(spark):
    reg = spark.createDataFrame(
        [("b", "Old", "PROD", 1), ("a", "New", "PROD", 1), ("c", "New", "TEST", 1), ("d", "None", "PROD", 0)],
        "folder_name string, template_type string, environment string, is_active int",
    )
    assert [r["folder_name"] for r in L.active_folders(reg, "PROD").collect()] == ["a", "b"]
    views = L.register_folder_views(reg)
    assert spark.table("header_list_new").count() == 2 and spark.table("header_list_all").count() == 4 and len(views) == 5


def test_quarantine(spark, tmp_path):
    files = spark.createDataFrame([("f1", "A", "bad header"), ("f2", "C", None)], "file string, platform string, reason string")
    path = str(tmp_path / "q")
    sinks.write_quarantine(files, path)
    row = spark.read.parquet(path).first()
    assert (row["file"], row["platform"]) == ("f1", "A") and "bad header" in row["side_text"]


def _rows(spark, lo, hi, v, extra=""):
    return spark.range(lo, hi).selectExpr("concat('f', id) as file", "id as source_row_no", f"{v} as v", *([extra] if extra else []))


def _files(path):
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, fs in os.walk(path) for f in fs}


def test_an_upsert_writes_its_own_rows_and_nothing_else(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(spark, path, _rows(spark, 0, 40, 1))
    before = _files(path)
    merge.upsert_table(spark, path, _rows(spark, 39, 42, 2).unionByName(_rows(spark, 39, 40, 3)), order=F.col("v"))
    after = _files(path)
    assert before.items() <= after.items()
    assert all("part-000000000002" in f for f in after.keys() - before.keys())
    got = {r["source_row_no"]: r["v"] for r in merge.read_table(spark, path).collect()}
    assert len(got) == 42 and got[38] == 1 and got[39] == 3 and got[41] == 2


def test_a_new_column_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(spark, path, _rows(spark, 0, 3, 1))
    merge.upsert_table(spark, path, _rows(spark, 2, 4, 2, "'x' as note"))
    merge.upsert_table(spark, path, _rows(spark, 3, 5, 3))
    for _ in range(2):
        got = {r["source_row_no"]: (r["v"], r["note"]) for r in merge.read_table(spark, path).collect()}
        assert got == {0: (1, None), 1: (1, None), 2: (2, "x"), 3: (3, None), 4: (3, None)}
        merge.compact_table(spark, path)
    assert merge.stored_parts(spark, path) == 0 and any("whole-" in f for f in _files(path))
    assert merge.upsert_table(spark, path, _rows(spark, 0, 1, 9)) == 4
    assert merge.read_table(spark, path).count() == 5


def test_what_a_failed_run_leaves_is_not_read(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(spark, path, _rows(spark, 0, 3, 1))
    merge.upsert_table(spark, path, _rows(spark, 0, 9, 2))
    os.remove(f"{path}/part-000000000002/_SUCCESS")
    assert sorted(r["v"] for r in merge.read_table(spark, path).collect()) == [1, 1, 1]
    assert merge.upsert_table(spark, path, _rows(spark, 2, 5, 3)) == 2
    assert sorted(r["v"] for r in merge.read_table(spark, path).collect()) == [1, 1, 3, 3, 3]
    merge.upsert_table(spark, path, _rows(spark, 2, 5, 3), part=2)
    assert merge.read_table(spark, path).count() == 5


def test_other_keys_and_types_are_refused(spark, tmp_path):
    path = str(tmp_path / "t")
    merge.upsert_table(spark, path, _rows(spark, 0, 3, 1))
    with pytest.raises(ValueError, match="keyed by"):
        merge.upsert_table(spark, path, _rows(spark, 0, 3, 1).withColumn("source_row_no", F.col("source_row_no").cast("int")))
    with pytest.raises(ValueError, match="keyed by"):
        merge.upsert_table(spark, path, _rows(spark, 0, 3, 1), ["file"])
    with pytest.raises(ValueError, match="another type"):
        merge.upsert_table(spark, path, _rows(spark, 0, 3, 1).withColumn("v", F.lit("a")))
    assert merge.read_table(spark, path).count() == 3


def test_period_is_replaced_and_emptied(spark, tmp_path):
    path = str(tmp_path / "archive")
    make = lambda y, m, v: spark.createDataFrame([(v, y, m)], "v int, statement_year int, statement_month string")
    read = lambda: {(r["statement_month"], r["v"]) for r in merge.read_periods(spark, path).collect()}
    merge.write_periods(make(2024, "MAY", 5).union(make(2024, "JULY", 7)), path)
    merge.write_period(make(2024, "MAY", 1).union(make(2024, "JUNE", 2)), path, 2024, "May")
    merge.write_period(make(2024, "JUNE", 9), path, 2024, "june")
    assert read() == {("MAY", 1), ("JUNE", 9), ("JULY", 7)}
    merge.write_period(make(2024, "JUNE", 9), path, 2024, "May")
    assert read() == {("JUNE", 9), ("JULY", 7)}
    merge.write_periods(make(2024, "MAY", 3), path)
    assert read() == {("MAY", 3), ("JUNE", 9), ("JULY", 7)}


def test_a_period_survives_a_write_that_stops(spark, tmp_path):
    path = str(tmp_path / "archive")
    make = lambda v: spark.createDataFrame([(i, 2024, "MAY") for i in v], "v int, statement_year int, statement_month string")
    read = lambda: sorted(r["v"] for r in merge.read_periods(spark, path).collect())
    merge.write_period(make([1, 2]), path, 2024, "May")
    broken = make(range(50)).withColumn("v", F.when(F.col("v") == 40, F.raise_error(F.lit("stop")).cast("int")).otherwise(F.col("v")))
    for write in (lambda: merge.write_period(broken, path, 2024, "May"), lambda: merge.write_periods(broken, path)):
        with pytest.raises(Exception, match="stop"):
            write()
        assert read() == [1, 2]
    merge.write_period(make([3]), path, 2024, "May")
    assert read() == [3]


def test_compaction_keeps_what_may_be_repeated(spark, tmp_path):
    path = str(tmp_path / "t")
    for v in (1, 2, 3):
        merge.upsert_table(spark, path, _rows(spark, v, v + 2, v))
    merge.compact_table(spark, path, keep=1)
    assert merge.stored_parts(spark, path) == 1 and merge.has_rows(spark, path, 3) and not merge.has_rows(spark, path, 2)
    assert {r["source_row_no"]: r["v"] for r in merge.read_table(spark, path, 3).collect()} == {1: 1, 2: 2, 3: 2}
    merge.upsert_table(spark, path, _rows(spark, 3, 5, 9), part=3)
    assert {r["source_row_no"]: r["v"] for r in merge.read_table(spark, path).collect()} == {1: 1, 2: 2, 3: 9, 4: 9}
    merge.compact_table(spark, path)
    assert merge.stored_parts(spark, path) == 0 and merge.has_rows(spark, path)
    with pytest.raises(ValueError, match="can't be repeated"):
        merge.upsert_table(spark, path, _rows(spark, 3, 5, 9), part=3)
    merge.compact_table(spark, path)
    assert merge.read_table(spark, path).count() == 4


def test_only_the_buckets_of_the_wanted_keys_are_read(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = lambda lo, hi, v: spark.range(lo, hi).selectExpr("id as k", "cast(null as string) as j", f"{v} as v")
    merge.upsert_table(spark, path, rows(0, 400, 1), ["k", "j"], buckets=16)
    merge.upsert_table(spark, path, rows(390, 410, 2).selectExpr("*", "'n' as note"), ["k", "j"])
    for _ in range(2):
        whole = merge.read_table(spark, path)
        assert whole.count() == 410 and whole.where("v = 2").count() == 20 and whole.columns == ["k", "j", "v", "note"]
        # The wanted keys may come as another type.
        some = merge.read_table(spark, path, only=spark.createDataFrame([(395, None)], "k int, j string"))
        assert [r["v"] for r in some.where("k = 395").collect()] == [2]
        assert "PartitionFilters: [_bucket" in some._jdf.queryExecution().executedPlan().toString().replace("isnotnull(_bucket", "_bucket")
        assert 0 < some.count() < 60
        assert merge.read_table(spark, path, only=rows(0, 0, 1)).count() == 0
        merge.compact_table(spark, path)
    with pytest.raises(ValueError, match="buckets"):
        merge.upsert_table(spark, path, rows(0, 1, 1).selectExpr("*", "'n' as note"), ["k", "j"], buckets=8)


def test_stream_takes_each_file_once(spark, tmp_path):
    inbox, table, seen = (str(tmp_path / n) for n in ("inbox", "table", "seen"))
    parts = lambda df: df.select(
        F.split("line", ",")[0].alias("k"), F.split("line", ",")[1].alias("v"), "file"
    )
    run = lambda **kw: ingest(stream_lines(spark, inbox, "*.txt"), parts, table, seen, ["k"], **kw)
    write(inbox, "1.txt", "a,1\nb,2\n")
    run()
    write(inbox, "2.txt", "b,3\nc,4\n")

    def mark(rows, stored):
        known = stored.select(F.col("k").alias("_k")).distinct()
        joined = rows.join(known, rows["k"] == known["_k"], "left")
        return joined.withColumn("v", F.when(F.col("_k").isNotNull(), F.concat("v", F.lit("*"))).otherwise(F.col("v"))).drop("_k")

    run(against_table=mark)
    got = {r["k"]: (r["v"], r["batch_id"]) for r in merge.read_table(spark, table).collect()}
    assert got == {"a": ("1", 0), "b": ("3*", 1), "c": ("4", 1)}
    run(against_table=mark)
    assert merge.read_table(spark, table).count() == 3


def test_broken_files_are_named_and_the_others_read(spark, tmp_path):
    import gzip

    folder = tmp_path / "in [x]"
    folder.mkdir()
    for i in range(9):
        data = gzip.compress(f"{i},a\n{i},b\n".encode() * 500)
        (folder / f"f{i}.txt.gz").write_bytes(data[: len(data) // 2] if i in (2, 7) else data)
    (folder / "plain{1}.txt").write_text("p\n")
    (folder / "empty.txt").write_text("")
    told = []
    lines, failed = L.read_good_lines(spark, [str(tmp_path)], ["*.gz", "*.txt"], recursive=True, on_error=lambda p, why: told.append((p, why)))
    counts = {r["file"].rpartition("/")[2]: r["count"] for r in lines.groupBy("file").count().collect()}
    assert sum(counts.values()) == 7 * 1000 + 1 and not any("f2" in f or "f7" in f for f in counts)
    got = [(r["file"], r["reason"]) for r in failed.orderBy("file").collect()]
    assert got == told and ["f2.txt.gz", "f7.txt.gz"] == [f.rpartition("/")[2] for f, _ in got]
    assert all("Unexpected end of input stream" in why for _, why in got)
    side = sinks.quarantine(failed).first()["side_text"]
    assert side.startswith("Could not process this file:\n") and "f2.txt.gz\nUnexpected" in side
    only = tmp_path / "only"
    only.mkdir()
    (only / "x.gz").write_bytes(b"no gzip")
    lines, failed = L.read_good_lines(spark, [str(only)])
    assert lines.count() == 0 and failed.count() == 1 and lines.columns == L.read_lines(spark, [L.literal_path(str(folder))]).columns


def test_outputs_under_their_names(spark, tmp_path):
    path = tmp_path / "out"
    path.mkdir()
    (path / "a.mbi").write_text("old")
    (path / "stays").write_text("old")
    rows = spark.range(3000).selectExpr("if(id % 3 = 0, 'a.mbi', 'b%20 c=d.err') as out_file", "-id as row_no", "concat('é', id) as file_row")
    assert sinks.write_named_files(rows.repartition(7), str(path)) == ["a.mbi", "b%20 c=d.err"]
    expect = lambda ids: "".join(f"é{i}\n" for i in sorted(ids, reverse=True))
    assert (path / "a.mbi").read_text() == expect(range(0, 3000, 3))
    assert (path / "b%20 c=d.err").read_text() == expect(i for i in range(3000) if i % 3)
    assert (path / "stays").read_text() == "old"
    with pytest.raises(Exception, match="slash"):
        sinks.write_named_files(rows.withColumn("out_file", F.lit("x/y")), str(path))
    assert sinks.write_named_files(rows.limit(0), str(path)) == []


def test_upserts_sort_a_share_of_the_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(merge, "TASK_ROWS", 100)
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("if(id % 9 = 0, null, 'f') as file", "id % 600 as source_row_no", "id as v")
    merge.upsert_table(spark, path, rows, order=F.col("v"))
    merge.upsert_table(spark, path, rows.where("id < 50").withColumn("v", F.lit(-1).cast("bigint")), order=F.col("v"))
    got = merge.read_table(spark, path)
    assert "REPARTITION_BY_NUM" in got._jdf.queryExecution().executedPlan().toString()
    own = {(None if i % 9 == 0 else "f", i % 600): -1 if i < 50 else i for i in range(1000)}
    own.update({(None if i % 9 == 0 else "f", i): -1 for i in range(50)})
    assert sorted(map(str, got.collect())) == sorted(str(r) for r in spark.createDataFrame(
        [(*k, v) for k, v in own.items()], "file string, source_row_no bigint, v bigint").collect())
    most = got.where("v >= 0").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most < 250


def test_digests_of_stored_files(spark, tmp_path):
    """Files are digested as streams of lines, in order of their bytes, and never as one value."""
    made = {
        "a b%20=c.mbi": "".join(f"é{i}\r\n" for i in range(90_000)).encode(), "no end": b"x\n\ny\n\n\nlast", "ends": b"\n\n",
        "odd": b"\xff\x00\n\r\xfe\n", "one": b"z",
    }
    for name, body in made.items():
        (tmp_path / name).write_bytes(body)
    limit = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60000")
    try:
        found = sinks.file_digests(spark, str(tmp_path))
        got = {r.path.rpartition("/")[2]: (r.line_count, r.size, r.digest) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    assert got == {n: (b.count(b"\n"), len(b), hashlib.sha256(b).hexdigest()) for n, b in made.items()}
    assert "content" not in plan


def test_a_scope_leaves_nothing_behind(spark):
    from flatproof import session

    kept = session.stage(spark.range(3).toDF("id"), "kept")
    with pytest.raises(ValueError), session.scratch_scope(spark):
        inside = session.scratch_path(spark, "inside")
        session.stage(spark.range(3).toDF("id"), "x")
        with session.scratch_scope(spark):
            session.stage(spark.range(3).toDF("id"), "y")
        spark.range(2).write.parquet(inside)
        raise ValueError
    assert not session.glob(spark, inside) and not session.glob(spark, f"{session.session_scratch(spark)}/scope-*")
    assert kept.count() == 3 and "scope" not in session.scratch_path(spark, "z")
