import datetime as dt

import pytest
from pyspark.sql import functions as F

from flatproof.operators import classify, export
from flatproof.plans import check

IB = "IB,TPA01,EMP001,{ee},{ee},Doe,Jo,Q,19800115,5550101000,1 Main St,,Town,IL,62701,US,jo@example.org,5550101001,2"
IC = "IC,TPA01,{er},PLAN-1,{ee},FSA,20240101,{end},2,100.00,0.00,10.00,5.00,{eff},"
IH = "IH,TPA01,EMP001,FSA,20240101,20241231,{ee},1,10.00,5.00,{eff}"


@pytest.fixture
def masters(spark):
    d = dt.date
    return check.MastersA(
        spark.createDataFrame([("EMP001", "One", "Active")], "employer_id string, employer_name string, employer_status string"),
        spark.createDataFrame([("EMP001", "100000001", 1)], "employerid string, employeeid string, is_active int"),
        spark.createDataFrame(
            [("EMP001", "FSA", "PLAN-1", d(2024, 1, 1), d(2024, 12, 31))],
            "employer_id string, account_type_code string, plan_id string, planstart date, planend date",
        ),
        spark.createDataFrame(
            [("EMP001", "100000001", "FSA", "PLAN-1", d(2024, 1, 1), d(2024, 12, 31))],
            "employerid string, employeeid string, plancode string, plandesc string, planstart date, planend date",
        ),
    )


def errors(rows):
    return {(r["file"], r["source_row_no"]): r["error_code"] for r in rows.collect()}


def test_platform_a_end_to_end(spark, numbered, masters):
    ee, new = "100000001", "200000002"
    lines = numbered(
        one=[
            "IA,XX,TPA01,Import Template",
            IC.format(er="EMP001", ee=new, end="20241231", eff="20240201"),  # before its demographics row
            IB.format(ee=new),
            IC.format(er="EMP001", ee=new, end="20241231", eff="20240201"),  # after it
            IC.format(er="EMP999", ee=ee, end="20241231", eff="20240201"),
            IC.format(er="EMP001", ee=ee, end="20241130", eff="20240201"),
            IC.format(er="EMP001", ee=ee, end="20241231", eff="20250201"),
            IC.format(er="EMP001", ee=ee, end="20241231", eff="2024-99-99"),
            "IY,unknown record type",
            "",
            "Please email completed file to us",
            IH.format(ee=new, eff="20240301"),  # plan added by row 4
            IH.format(ee="300000003", eff="20240301"),
            IH.format(ee=ee, eff="20240115"),
        ],
        two=[IH.format(ee=ee, eff="20240115"), IH.format(ee=ee, eff="20240116")],
        wrong=["IZ,TPA01,EMP001"],
    )
    rows, wrong = check.check_a(lines, masters)
    rows = rows.cache()
    got = errors(rows)
    assert got == {
        ("one", 1): "", ("one", 2): "EmployeeID", ("one", 3): "", ("one", 4): "", ("one", 5): "EmployerId",
        ("one", 6): "PlanId", ("one", 7): "PlanId", ("one", 8): "EffectiveDate", ("one", 9): "Invalid Record Type",
        ("one", 12): "", ("one", 13): "AccountTypeCode", ("one", 14): "",
        ("two", 1): "DuplicatePosting", ("two", 2): "",
    }
    message = {r["source_row_no"]: r["error_message"] for r in rows.where("file = 'one'").collect()}
    assert message[5] == "The Employer ID 'EMP999' could not be found"
    assert message[7].startswith("The AccountTypeID 'FSA' and Plan ID 'PLAN-1' ended on '20241231'")
    dup = rows.where("file = 'two' and source_row_no = 1").first()["error_message"]
    assert "as part of file 'one'" in dup
    assert [r["file"] for r in wrong.collect()] == ["wrong"]

    outcome = {r["file"]: (r["outcome"], r["outcome_code"]) for r in check.outcomes(rows, wrong).collect()}
    assert outcome == {
        "one": ("PartialFail", "300"), "two": ("PartialFail", "300"), "wrong": ("CompleteFail", "400")
    }

    report = check.run_reports(check.outcomes(rows, wrong)).where("file = 'wrong'").first()["report"]
    assert '"outcome":"CompleteFail"' in report and '"code":"400"' in report

    splits = export.export_splits(rows, F.lit("B9")).cache()
    by_split = {}
    for r in splits.where("file = 'one'").orderBy("split", "row_no").collect():
        by_split.setdefault(r["split"], []).append(r["file_row"])
    body = {k: len(v) - 1 for k, v in by_split.items()}
    assert body["passed_lines"] + body["rejected_lines"] == body["original_file"] == body["all_lines_with_errors"] == 11
    for name, n in body.items():
        assert by_split[name][0] == f"IA,{n},TPA01,Import Template,B9"
    assert any(x.endswith(",OK") for x in by_split["all_lines_with_errors"])
    assert all(",Warning: " in x for x in by_split["rejected_lines_with_errors"][1:])

    names = {r["out_file"] for r in check.deliver(rows, "A").select("out_file").distinct().collect()}
    assert "one-1-PassedLines.mbi" in names and "one-2-RejectedLines.err" in names


def test_repeat_posting_against_the_stored_history(spark, numbered, masters):
    first, _ = check.check_a(numbered(one=[IH.format(ee="100000001", eff="20240115")]), masters)
    stored = first.withColumns({"row_id": F.lit(5), "created_at": F.lit("2024-01-20").cast("timestamp")})
    again, _ = check.check_a(numbered(three=[IH.format(ee="100000001", eff="20240115")]), masters, stored)
    row = again.first()
    assert row["error_code"] == "DuplicatePosting"
    assert "'20240120' as part of file 'one'" in row["error_message"]


def test_tpa_option(spark, numbered, masters):
    line = IH.format(ee="100000001", eff="20240115").replace("TPA01", "")
    lenient, _ = check.check_a(numbered(f=[line]), masters)
    strict, _ = check.check_a(numbered(f=[line]), masters, options=check.CheckOptions(require_tpa=True))
    assert (lenient.first()["error_code"], strict.first()["error_code"]) == ("", "TpaId")


def test_more_rows_than_the_old_cap(spark, masters):
    many = spark.range(1, 12001).selectExpr(
        "'big' as file", "id as source_row_no", "'IZ,TPA01,EMP001,100000001,20240101,,East' as line",
        "timestamp_micros(1) as modified", "100000 as size",
    )
    rows, _ = check.check_a(many, masters)
    assert rows.count() == 12000 and rows.where("error_code <> ''").count() == 0


def c_line(code, **values):
    from flatproof.spec import platform_c_layouts

    spec = platform_c_layouts()[code]
    return ",".join([code, *[values.get(n, "") for n in spec.names]])


QB = dict(
    ClientName="Acme", ClientDivisionName="East", FirstName="Jo", LastName="Doe", SSN="123-45-6789", Address1="1 Main",
    City="Town", StateOrProvince="IL", PostalCode="62701", PremiumAddressSameAsPrimary="TRUE", Sex="F", DOB="1/5/1980",
    TobaccoUse="NO", EmployeeType="FTE", EmployeePayrollType="EXEMPT", PremiumCouponType="NONE", UsesHCTC="FALSE",
    Active="yes", AllowMemberSSO="F",
)
PLAN = dict(
    PlanName="Dental A", StartDate="02/01/2024", CoverageLevel="EE", SendPlanChangeLetterForLegacy="TRUE",
)
SPM = dict(
    ClientName="Acme", ClientDivisionName="East", FirstName="Al", LastName="Roe", SSN="987654321", Address1="2 Main",
    City="Town", StateOrProvince="IL", PostalCode="62701", Sex="M", DOB="01/05/1980", BillingStartDate="01/01/2024",
    BillingEndDate="12/31/2024", BillingType="RETIREE", BillingFrequency="MONTHLY", IsCOBRAEligible="1",
    IsCOBRAEligibleAtTermination="1", SubsequentGracePeriodNrOfDays="30", SPMSubsequentGracePeriodOptionType="IGNORE",
    IsLegacy="0", TobaccoUse="NO", EnrollmentDate="01/01/2024", EmployeeType="FTE", EmployeePayrollType="EXEMPT",
    PremiumCouponType="NONE", Active="1", AllowMemberSSO="0", EventDate="01/01/2024",
)


@pytest.fixture
def masters_c(spark):
    member = "member_id int, client_id int, client_division_id int, ssn string"
    return check.MastersC(
        spark.createDataFrame([(1, "Acme"), (2, "Other")], "client_id int, client_name string"),
        spark.createDataFrame([(11, 1, "East"), (12, 1, "West"), (21, 2, "East")],
                              "client_division_id int, client_id int, division_name string"),
        {
            "QB": spark.createDataFrame([(5, 1, 12, "123-45-6789")], member),
            "SPM": spark.createDataFrame([(6, 1, 11, "987654321")], member),
            "NPM": spark.createDataFrame([(7, 11, "111-22-3333")], "member_id int, client_division_id int, ssn string"),
        },
        spark.createDataFrame([(51, 1, "Dental A"), (52, 1, "Vision B")],
                              "client_plan_qb_id int, client_id int, plan_name string"),
        spark.createDataFrame([(11, 51), (12, 52)], "client_division_id int, client_plan_qb_id int"),
    )


def test_platform_c_end_to_end(spark, numbered, masters_c):
    lines = numbered(
        c=[
            "[VERSION],1.2",
            c_line("[QB]", **QB),
            c_line("[QBPLAN]", **PLAN),
            c_line("[QBPLAN]", **{**PLAN, "PlanName": "Vision B"}),  # not linked to this division
            c_line("[QBPLAN]", **{**PLAN, "PlanName": "None"}),
            c_line("[SPMPLAN]", **PLAN),  # under a QB
            "",
            c_line("[SPM]", **SPM),
            c_line("[SPMPLAN]", **PLAN),
            c_line("[QBPLAN]", **PLAN),  # under an SPM
            c_line("[MEMBERUSERDEFINEDFIELD]", UserDefinedFieldName="x"),
            c_line("[QB]", **{**QB, "ClientName": "Nobody"}),
            c_line("[QBPLAN]", **PLAN),  # its QB is not valid
            c_line("[QB]", **{**QB, "ClientDivisionName": "North"}),
            c_line("[QBLOOKUP]", ClientName="Acme", SSN="123456789", QualifyingEventDate="01/01/2024"),
            c_line("[QBNOTE]", NoteType="MANUAL", DateTime="20240131 15:04:00", NoteText="hi"),
            c_line("[QBLOOKUP]", ClientName="Acme", SSN="000000001", QualifyingEventDate="01/01/2024"),
            c_line("[NPMLOOKUP]", ClientName="Acme", SSN="111223333"),
            "[NOSUCH],1",
        ],
        d=["[VERSION],1.0", c_line("[QBPLAN]", **PLAN)],
    )
    rows = check.check_c(lines, masters_c).cache()
    got = errors(rows)
    missing = "ClientAndDivision;Client And Division Does Not Exist"
    assert got == {
        ("c", 1): "", ("c", 2): "", ("c", 3): "", ("c", 4): "No Such Plan Found", ("c", 5): "No Such Plan Found",
        ("c", 6): "No Current SPM", ("c", 8): "", ("c", 9): "", ("c", 10): "No Current QB", ("c", 11): "",
        ("c", 12): missing, ("c", 13): "No Current QB", ("c", 14): "ClientAndDivision", ("c", 15): "", ("c", 16): "",
        ("c", 17): "QB Not Found", ("c", 18): "", ("c", 19): "Invalid Record Type",
        ("d", 1): "", ("d", 2): "No Current QB",
    }
    qb = rows.where("file = 'c' and source_row_no = 2").first()
    assert (qb["SSN"], qb["DOB"], qb["Active"], qb["AllowMemberSSO"]) == ("123456789", "01/05/1980", "1", "0")
    assert qb["org_data_row"] != qb["data_row"]
    again = check.check_c(lines, masters_c, check.CheckOptions(fail_if_member_exists=True))
    assert errors(again)["c", 2] == "QB Already exists"


def test_classification_and_headers(spark, numbered):
    lines = numbered(
        a=["x", "IB,TPA01"], c=["[VERSION],1", "[QB],Acme,East", "[SPM],x"], u=["hello"], late=["x", "[VERSION],1.2"],
    )
    facts = {r["file"]: r for r in classify.classify_files(lines).collect()}
    assert {f: r["platform"] for f, r in facts.items()} == {"a": "A", "c": "C", "u": "Unknown", "late": "Unknown"}
    assert (facts["c"]["has_qb"], facts["c"]["has_spm"], facts["c"]["has_npm"], facts["c"]["version"]) == (True, True, False, "1.0")
    loose = {r["file"]: r["platform"] for r in classify.classify_files(lines, loose=True).collect()}
    assert loose["u"] == "A"

    templates = {"Old": "IA,XX,TPA01,Old Template", "New": "IA,XX,TPA01,New Template"}
    src = numbered(
        old=["IA,3,TPA01,Own", IB.format(ee="1"), "", "please EMAIL completed file to x"],
        new=[IC.format(er="EMP001", ee="1", end="20241231", eff="")],
        odd=["IA,1,TPA01,Own", "IZ,1,2"],
        mixed=["IA,3,TPA01,Own", "IC" + "," * 13, "IZ" + "," * 6],
        wide=["IA,3,TPA01,Own", "IZ,1,2", "IC" + "," * 15, "IC" + "," * 13],
    )
    out = {}
    for r in check.prepare_headers(src, templates).orderBy("file", "source_row_no").collect():
        out.setdefault(r["file"], []).append(r["line"])
    assert out["old"] == ["IA,XX,TPA01,Old Template", IB.format(ee="1")]
    assert out["new"][0] == "IA,XX,TPA01,New Template"
    assert out["odd"] == ["IA,1,TPA01,Own", "IZ,1,2"]
    # The first line that fits a layout decides; segmented funding takes the new template.
    assert out["mixed"][0] == "IA,XX,TPA01,Old Template" and len(out["mixed"]) == 3
    assert out["wide"][0] == "IA,XX,TPA01,New Template" and len(out["wide"]) == 4


def test_c_flags_are_prepared(spark, numbered):
    lines = numbered(f=["[QB]," + ",".join(QB.get(n, "") for n in check.platform_c_layouts()["[QB]"].names)])
    out = export.prepare_c_flags(lines, export.c_flag_positions()).first()["line"].split(",")
    names = ["", *check.platform_c_layouts()["[QB]"].names]
    assert (out[names.index("Active")], out[names.index("AllowMemberSSO")], out[names.index("UsesHCTC")]) == ("1", "0", "0")


def test_routing(spark, numbered):
    files = spark.createDataFrame(
        [("in/a.mbi", 500), ("in/b_test.mbi", 500), ("in/c.csv", 50), ("in/d.txt", 500), ("in/e.csv", 500)], "file string, size int"
    )
    facts = spark.createDataFrame([("in/a.mbi", "A"), ("in/b_test.mbi", "A"), ("in/c.csv", "C"), ("in/e.csv", "C")], "file string, platform string")
    results = spark.createDataFrame(
        [("in/a.mbi", "Ok", "200"), ("in/b_test.mbi", "PartialFail", "300"), ("in/e.csv", "PartialFail", "300")],
        "file string, outcome string, outcome_code string",
    )
    out = {r["file"]: r["destination"] for r in check.route(files, facts, results).collect()}
    assert out == {
        "in/a.mbi": "a/passed", "in/b_test.mbi": "a/test", "in/c.csv": "c/empty", "in/d.txt": "unknown/holding",
        "in/e.csv": "c/rejects",
    }


def test_result_files(spark, numbered):
    from flatproof.plans.reconcile import load_results

    lines = numbered(
        r1=[
            "RA,EMP001_IB_AL_20240115.mbi,Result Template", "RB,EMP001,123456789,0,", "RC,EMP001,123456789,PLAN-1,20240101,20241231,15028",
            "RE,EMP001,123456789,D1,PLAN-1,20240101,20241231,99,own", "not a result", "RZ,EMP001,123456789, 15028 ,",
        ],
    )
    codes = spark.createDataFrame([("15028", "inactive")], "error_code string, user_desc string")
    out = {r["source_row_no"]: r for r in load_results(lines, codes).collect()}
    assert sorted(out) == [1, 2, 3, 4, 6]
    assert {r["sent_file"] for r in out.values()} == {"EMP001_IB_AL_20240115.mbi"}
    assert (out[1]["error_code"], out[3]["PlanId"], out[3]["error_message"]) == (None, "PLAN-1", "inactive")
    assert (out[4]["DependentID"], out[4]["error_message"], out[6]["error_message"]) == ("D1", "own", "inactive")


def test_from_text_files_to_text_outputs(spark, masters, tmp_path):
    """Files on disk are read, checked, stored twice, split and written."""
    from flatproof.operators.merge import read_table, upsert_table
    from flatproof.sources.lines import as_logical_files, number_lines, read_lines
    from flatproof.sources.sinks import write_lines

    inbox, table, outbox = (str(tmp_path / n) for n in ("inbox", "table", "outbox"))
    (tmp_path / "inbox").mkdir()
    good = IH.format(ee="100000001", eff="20240115")
    (tmp_path / "inbox" / "a.mbi").write_text("\n".join(["IA,XX,TPA01,T", good, "", good.replace(",1,10", ",3,10")]) + "\n")
    (tmp_path / "inbox" / "b.mbi").write_text(good.replace("20240115", "20240116") + "\n")
    lines = number_lines(read_lines(spark, [inbox], masks=["*.mbi"]))
    rows, wrong = check.check_a(lines, masters)
    assert wrong.count() == 0
    for _ in range(2):
        upsert_table(spark, table, rows)
    stored = read_table(spark, table)
    assert stored.count() == 4
    write_lines(check.deliver(stored, "A", F.lit("B1")), outbox)
    out = {}
    for r in number_lines(as_logical_files(read_lines(spark, [outbox], recursive=True))).orderBy("source_row_no").collect():
        out.setdefault(r["file"], []).append(r["line"])
    assert out["a.mbi-1-PassedLines.mbi"] == ["IA,1,TPA01,T,B1", good]
    assert out["a.mbi-2-RejectedLines.err"][1].endswith("DepositType must always be one of 1. '3' is not valid")
    assert out["b.mbi"] == [good.replace("20240115", "20240116")]
    assert len(out) == 6


def test_lines_of_one_split_are_checked_by_many_tasks(spark, numbered):
    """The work of the rules follows the lines, not the bytes or splits of files."""
    wide = spark.conf.get("spark.sql.codegen.hugeMethodLimit")
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "65535")
    try:
        c = numbered(c=["[VERSION],1.2", *(f"[QB],client {i},div" for i in range(200))]).coalesce(1)
        a = numbered(a=["IA,XX,TPA01,T", *(f"IZ,TPA01,EMP001,{i},20240101,,East" for i in range(200))]).coalesce(1)
        for rows in (check.validate_c(c), check.validate_a(a)[0]):
            tasks = rows.groupBy(F.spark_partition_id().alias("task")).agg(F.count("*").alias("n")).collect()
            assert sum(t.n for t in tasks) == 201 and len(tasks) > 1 and max(t.n for t in tasks) < 120
        assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"
    finally:
        spark.conf.set("spark.sql.codegen.hugeMethodLimit", wide)


def test_sent_names_are_joined_by_their_size(spark):
    """A few names are sent to the rows of large files; the rows are not dealt by file."""
    from flatproof.operators import results
    from flatproof.session import stage

    rows = spark.range(30_000).selectExpr(
        "if(id % 3 > 0, 'hot', if(id % 2 > 0, null, 'other')) as result_file", "id as source_row_no",
        "if(id = 1, 'RA,x.mbi,T', 'RB,' || id) as error_row",
    )
    rows = stage(rows, "result-rows")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20000")
    try:
        got = results.with_sent_file(rows)
        plan = got._jdf.queryExecution().sparkPlan().toString()
        counts = {(r.result_file, r.sent_file): r["count"] for r in got.groupBy("result_file", "sent_file").count().collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert counts == {("hot", "x.mbi"): 20_000, ("other", "other"): 5_000, (None, None): 5_000}
