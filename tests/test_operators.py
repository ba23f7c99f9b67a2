import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from flatproof.functions import text as T
from flatproof.operators import classify as K
from flatproof.operators import commission, export, lineage, lookups, merge, results
from flatproof.operators.parents import last_parent, row_chunk


def test_last_parent_against_brute_force(spark):
    """One hot partition with most rows, chunks of seven rows, and parents missing at first."""
    rng = random.Random(7)
    rows = [("hot" if i % 10 else f"f{i}", i, "P" if rng.random() < 0.05 and i > 40 else "x") for i in range(1, 1001)]
    df = spark.createDataFrame(rows, "file string, n bigint, kind string")
    got = last_parent(df, F.col("kind") == "P", {"n": F.col("n")}, "file", "n", row_chunk("n", 7))
    found = {(r["file"], r["n"]): r["parent"]["n"] if r["parent"] else None for r in got.collect()}
    want, open_ = {}, {}
    for f, n, kind in rows:
        if kind == "P":
            open_[f] = n
        want[f, n] = open_.get(f)
    assert found == want


def test_contains_join_against_brute_force(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice("ABC") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    codes = ["".join(rng.choice("ABC") for _ in range(n)) for n in (2, 3, 3, 4, 5, 6)]
    rows = spark.createDataFrame(list(enumerate(texts)), "id int, t string")
    names = spark.createDataFrame([(c,) for c in codes], "code string")
    got = sorted((r["id"], r["code"]) for r in results.rows_with_codes(rows, "t", names, "code").collect())
    want = sorted((i, c) for i, t in enumerate(texts) for c in set(codes) if t.find(c) > 0)
    assert got == want
    # The pieces of a text are as many for two lengths as for ten.
    ten = spark.createDataFrame([("ABCA" * n,) for n in range(1, 11)], "code string")
    assert sorted((r["id"], r["code"]) for r in results.rows_with_codes(rows, "t", ten, "code").collect()) == sorted(
        (i, "ABCA" * n) for i, t in enumerate(texts) for n in range(1, 11) if t.find("ABCA" * n) > 0
    )
    pieces = lambda codes: results.rows_with_codes(rows, "t", codes, "code")._jdf.queryExecution().analyzed().toString().count("sequence(")
    assert pieces(ten) == pieces(ten.where("length(code) in (8, 12)"))
    plan = results.rows_with_codes(rows, "t", names, "code")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_code_at_the_start_only_does_not_count(spark):
    rows = spark.createDataFrame([(1, "EMP1,x"), (2, "x,EMP1"), (3, "EMP1,EMP1")], "id int, t string")
    codes = spark.createDataFrame([("EMP1",)], "code string")
    # The first occurrence decides, as in a search for its position.
    assert [r["id"] for r in results.rows_with_codes(rows, "t", codes, "code").collect()] == [2]


def test_top_rows_of_a_hot_owner(spark):
    rows = spark.range(1000).selectExpr("if(id < 990, 'hot', 'cold') as o", "id")
    got = lineage.top_rows(rows, "o", "id", 2).orderBy("o", "rank").collect()
    assert [(r["o"], r["id"], r["rank"]) for r in got] == [
        ("cold", 999, 1), ("cold", 998, 2), ("hot", 989, 1), ("hot", 988, 2)
    ]


def test_file_names(spark):
    names = ["client file--New [x],v.csv", "a--3--rest.csv", "plain.txt", "x--2.mbi", "Test_a.CSV", "--lead.csv"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    n = F.col("n")
    out = df.select(
        T.file_name_clean(n), K.strip_file_id(n), K.file_id_from_name(n), K.header_type_from_name(n), K.is_test_file(n),
        K.add_file_id(n, F.lit("123")), K.ftp_file_name(n, 10),
    ).collect()
    assert [r[0] for r in out][:2] == ["client_file_New_xv.csv", "a_3_rest.csv"]
    assert [r[1] for r in out] == ["client file", "a", "plain", "x", "Test_a", ""]
    assert [r[2] for r in out] == ["New [x],v", "3--rest", "", "2", "", ""]
    assert [r[3] for r in out] == ["NotApplicable", "New", "NotApplicable", "NotApplicable", "NotApplicable", "NotApplicable"]
    assert [r[4] for r in out] == [False, False, False, False, True, False]
    assert out[1][5] == "a--123.csv" and out[0][6] == "client.csv"
    ids = df.select(K.file_id(n, F.lit("2024-01-01"))).collect()
    assert len({r[0] for r in ids}) == len(names) and all(len(r[0]) == 32 for r in ids)
    many = spark.range(300_000).select(K.file_id(F.concat(F.lit("in/file_"), "id"), F.lit("2024-01-01")).alias("i"))
    assert many.distinct().count() == 300_000
    typed = df.select(K.add_id_and_header_type(F.lit("in/b.csv"), F.lit("77"), F.lit("New")).alias("t")).first()["t"]
    assert typed == "77--3--b.csv"
    assert df.select(K.header_type_from_name(F.lit(typed))).first()[0] == "New"
    assert df.select(K.is_excel_file(F.lit("a.XLSX")), K.is_empty_file(F.lit(100))).first() == (True, True)


def test_text_functions(spark):
    one = spark.range(1).select(
        T.ssn_dashed(F.lit("12-3456")), T.ssn_dashed(F.lit(" ")), T.mid(F.lit("abcdef"), 3, 2), T.csv_quote(F.lit('a"b')),
        T.pad_left(F.lit("12345"), 3), T.match_key(F.lit(" A & b, Co. ")), T.display_name(F.lit(" a & b ")),
    ).first()
    assert tuple(one) == ("000-12-3456", "", "cd", '"a""b"', "12345", "ABCO", "A  B")


def test_result_clean_up(spark):
    rows = spark.createDataFrame(
        [
            ("r1", 1, "RA", "RA,EMP_IB_20240115.mbi,Result Template", "9", "x"),
            ("r1", 2, "RB", "RB,EMP001,1,15028,", "15028", ""),
            ("r1", 3, "RB", "RB,EMP001,1,777,other.csv", "777", "own text"),
            ("r2", 1, "RB", "RB,EMP001,1,15028,", "15028", None),
        ],
        "result_file string, source_row_no int, row_type string, error_row string, error_code string, error_message string",
    )
    codes = spark.createDataFrame([("15028", "inactive"), ("15028", "zzz")], "error_code string, user_desc string")
    out = {(r["result_file"], r["source_row_no"]): r for r in results.clean_results(rows, codes).collect()}
    assert {r["sent_file"] for k, r in out.items() if k[0] == "r1"} == {"EMP_IB_20240115.mbi"}
    assert out["r2", 1]["sent_file"] == "r2"
    assert out["r1", 1]["error_code"] is None
    assert [out[k]["error_message"] for k in (("r1", 2), ("r1", 3), ("r2", 1))] == ["inactive", "own text", "inactive"]


def test_error_codes(spark):
    codes = [("15028", True), ("0", False), ("", False), (None, False), ("X1", False), ("-1", False), ("00", True)]
    df = spark.createDataFrame(codes, "error_code string, want boolean")
    kept = {r["error_code"] for r in results.result_errors(df).collect()}
    assert kept == {c for c, want in codes if want}


def test_errors_by_member(spark):
    errors = spark.createDataFrame(
        [("s", 1, "E", "1", "D"), ("s", 2, "E", "2", None)], "sent_file string, row_num int, EmployerId string, EmployeeID string, DependentID string"
    )
    sent = spark.createDataFrame(
        [("s", 9, "E", "1", "D", "line")], "file string, row_num int, EmployerId string, EmployeeID string, DependentID string, data_row string"
    )
    out = {r["error_row_num"]: r["sent_line"] for r in results.errors_with_sent_by_member(errors, sent).collect()}
    assert out == {1: "line", 2: None}


def test_log_ids_and_headers(spark):
    d = dt.datetime
    tasks = spark.createDataFrame(
        [
            ("A", "in", "x.csv", "x--77.csv", "New", "Success", d(2024, 1, 1), 1),
            ("A", "in", "x--77.csv", "", "Check", "ERROR", d(2024, 1, 2), 2),
            ("A", "in", "plain.csv", "", "Found", "Success", d(2024, 1, 1), 3),
            ("A", "in", "", "", "Poll", "Success", d(2024, 1, 1), 4),
        ],
        "platform string, folder_name string, original_file_name string, new_file_name string, processing_task string, "
        "processing_task_outcome string, created_at timestamp, task_seq int",
    )
    heads, details = lineage.log_tasks(tasks)
    view = {r["file_id"]: r["processing_error_count"] for r in lineage.log_view(heads, details).collect()}
    assert view == {"77": 1, "plain": 0, "in": 0}
    assert details.count() == 4
    again, _ = lineage.log_tasks(tasks, heads)
    assert again.count() == 0


def test_commission_tiers_and_units(spark):
    invoices = spark.createDataFrame(
        [(1, "77 ", "Client A", "Fee & 1", "Ann & Co", 3.0, 10.0, 30.0, 0.0, dt.date(2024, 1, 5)),
         (2, "78", "Client B", "Fee 2", "ann co", 1.0, 16.67, 16.67, 0.0, dt.date(2024, 1, 5))],
        "id bigint, num string, name string, memo string, agent string, qty double, sales_price double, amount double, open_balance double, date date",
    )
    columns = (
        "id bigint, broker_name string, qb_broker_name string, client_name string, qb_client_name string, qb_fee string, fee_memo string, "
        "unit string, broker_status string, email string, paylocity_id string, commission_rate decimal(18,4), start_date date, client_id bigint"
    )
    from decimal import Decimal as D

    base = ("Ann", "ANN CO", "Client A", "client a", "FEE1", "m")
    agreements = spark.createDataFrame(
        [(10, *base, "Per Qt", "Active", "", "", D("0.3350"), None, 1), (11, *base, "Flat Rate", "Active", "", "", D("7.5"), None, 1),
         (12, *base, "Per Amount", "Active", "", "", D("0.1000"), None, 1), (13, *base, "?", "Active", "", "", D("1"), None, 1),
         (14, "None", "", "x", "client a", "FEE1", "m", "Flat Rate", "Active", "", "", D("1"), None, 1)],
        columns,
    )
    out = {r["broker_id"]: r["commission_amount"] for r in commission.match_tier(invoices, agreements).collect()}
    assert out == {10: D("1.01"), 11: D("7.50"), 12: D("3.00"), 13: None}
    loose = (("agent", "qb_broker_name"),)
    sent = spark.createDataFrame([(" 77", D("5.00")), ("77", D("6.00"))], "invoice_num string, open_balance decimal(18,2)")
    both = commission.commission_result(invoices, agreements, sent=sent, tiers=(commission.TIER_0, loose)).collect()
    assert len(both) == 8 and {r["total_invoice_sent_open_balance"] for r in both if r["id"] == 1} == {D("11.00")}
    assert {r["total_invoice_sent_open_balance"] for r in both if r["id"] == 2} == {None}


def test_clear_default_and_keep(spark):
    rows = spark.createDataFrame([("RA", "1", "m", "", "res", "new", ""), ("RB", "1", "m", "s", "res", "new", "old")],
                                 "row_type string, error_code string, error_message string, sent_file string, result_file string, data_row string, org_data_row string")
    out = merge.keep_original(merge.default_sent_name(merge.clear_result_headers(rows))).orderBy("row_type").collect()
    assert (out[0]["error_code"], out[0]["sent_file"], out[0]["org_data_row"]) == (None, "res", "new")
    assert (out[1]["error_code"], out[1]["sent_file"], out[1]["org_data_row"]) == ("1", "s", "old")


def test_members_fall_back_from_division_to_client(spark):
    members = spark.createDataFrame([(1, 1, 11, "123-45-6789"), (2, 1, 12, "000000005")], "member_id int, client_id int, client_division_id int, ssn string")
    rows = spark.createDataFrame([(1, 11, "123456789"), (1, 11, "5"), (2, 21, "5"), (1, 12, "")], "client_id int, client_division_id int, SSN string")
    out = [r["m"] for r in lookups.member_by_ssn(rows, members, "m").collect()]
    assert sorted(out, key=str) == [1, 2, None, None]
    assert [r["m"] for r in lookups.member_by_ssn(rows.where("SSN = '5' and client_id = 1"), members, "m", by_client=False).collect()] == [None]


def test_output_names(spark):
    rows = spark.createDataFrame([(s, p) for s in export.SPLITS for p in "AC"], "s string, p string")
    got = {(r["s"], r["p"]): r["n"] for r in rows.select("*", export.output_name(F.lit("f"), F.col("s"), F.col("p")).alias("n")).collect()}
    assert got["passed_lines", "A"] == "f-1-PassedLines.mbi" and got["passed_lines", "C"] == "f-1-PassedLines.csv"
    assert got["all_lines_with_errors", "A"] == "f-4-allLines.err"


@pytest.fixture
def tiny_skew(spark):
    """Settings under which a key with most rows of a small table counts as skewed."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def test_a_hot_key_is_split_in_every_look_up(spark, tiny_skew):
    """Nine rows of ten share a key; the look-ups' own joins must be dealt out, not left to one task."""
    n = 60_000
    hot = "if(id % 10 = 0, cast(id as string), 'hot')"
    rows = spark.range(0, n, 1, 8).selectExpr(
        f"{hot} as k", "id as source_row_no", "1 as file_seq", f"{hot} as ClientName", f"{hot} as ClientDivisionName",
        f"{hot} as error_code", "'' as error_message", "cast(null as string) as result_file", "'' as error_row",
        "if(id % 10 = 0, id, -1) as client_id", "if(id % 10 = 0, id, -1) as client_division_id", "'1' as SSN", f"{hot} as PlanName",
    )
    master = spark.range(0, 3 * n, 1, 8).selectExpr("if(id = 1, 'hot', cast(id as string)) as m", "id", "1 as v")
    known = lookups.first_known(master.withColumnRenamed("m", "k"), rows, ["k"], ["file_seq", "source_row_no"])
    codes = master.selectExpr("m as error_code", "'text' as user_desc")
    clients = master.selectExpr("m as client_name", "if(id = 1, -1, id) as client_id")
    divisions = master.selectExpr("if(id = 1, -1, id) as client_id", "m as division_name", "id as client_division_id")
    members = master.selectExpr("if(id = 1, -1, id) as client_division_id", "-1 as client_id", "'1' as ssn", "id as member_id")
    plans = master.selectExpr("if(id = 1, -1, id) as client_id", "m as plan_name", "id as client_plan_qb_id")
    links = plans.selectExpr("client_plan_qb_id", "client_id as client_division_id")
    lookup_rows = rows.drop("client_id", "client_division_id")
    tried = {
        "exists": lookups.exists(rows, master, {"k": "m"}, "found"),
        "exists_before": lookups.exists_before(rows, known, {"k": "k"}, ["file_seq", "source_row_no"], "found"),
        "clients_by_name": lookups.clients_by_name(lookup_rows, clients, divisions),
        "member_by_ssn": lookups.member_by_ssn(rows, members, "member", by_client=False),
        "client_plan": lookups.client_plan(rows, plans, links),
        "with_error_texts": results.with_error_texts(rows, codes),
        "earlier_posting": lookups.earlier_posting(
            rows.where("k <> 'hot' or source_row_no < 50000"), ["k"], "file_seq", "source_row_no", {"at": F.col("file_seq")}
        ),
    }
    for name, df in tried.items():
        assert df.collect()
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString(), name


def test_latest_by_prefix(spark):
    rng = random.Random(9)
    log = [(i, "".join(rng.choice("ab") for _ in range(rng.randrange(9))), rng.choice([None, "", "abba--1.mbi"])) for i in range(200)]
    names = ["", " ", "a", "ab", "abba--1", "bbbbb", "zz", "a", None]
    entries = spark.createDataFrame(log, "file_log_id bigint, original_file_name string, new_file_name string")
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    got = sorted((r["name"] or "", r["file_log_id"]) for r in lineage.latest_by_prefix(wanted, entries).collect())
    best = lambda n: max([i for i, a, b in log if n and n.strip() and (a.startswith(n) or (b or "").startswith(n))], default=0)
    assert got == sorted((n or "", best(n)) for n in names)
    assert [r["file_log_id"] for r in lineage.latest_by_prefix(wanted.where("name = ' '"), entries).collect()] == [0]


def test_sql_functions_agree_with_the_columns(spark):
    from flatproof.functions import text as T
    from flatproof.functions import values as V
    from flatproof.operators import classify as K
    from flatproof.sql_functions import register_functions

    assert "file_error_count" not in register_functions(spark)
    values = ["in/a--b.mbi", "--x.csv", "a--b--c", "", None, "1,234.50", " 12 ", "x", "0", "15028", "Ab-1 c", "a.b--7.x/y--9.z"]
    df = spark.createDataFrame([(v, w) for v in values for w in values], "a string, b string")
    df.createOrReplaceTempView("values_of_functions")
    got = spark.sql("""SELECT file_id_from_name(a) f, file_log_id(a, b) i, match_key(a) m, money_or_zero(a) p, is_error_code(a) e
        FROM values_of_functions""").collect()
    a = F.col("a")
    code = F.coalesce(results.is_error_code(a), F.lit(False))
    want = df.select(K.file_id_from_name(a), F.xxhash64(lineage.resolve_file_id(a, T.text("b"))), T.match_key(a), V.money_or_zero(a), code).collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in want]


def test_unique_errors_need_no_comparison_of_whole_rows(spark):
    errors = spark.createDataFrame([(i, f"E{i % 3}", "x" * 50) for i in range(20)], "row_num int, EmployerId string, error_row string")
    managers = spark.createDataFrame([("E0", "a", "a@x"), ("E0", "a", "a@x"), ("E1", "b", "b@x")], "bencode string, crm string, crm_email string")
    plain, unique = (results.with_manager(errors, managers, unique=u) for u in (False, True))
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, unique.collect()), key=repr)
    aggregates = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate [")
    assert aggregates(unique) == aggregates(plain) - 1
