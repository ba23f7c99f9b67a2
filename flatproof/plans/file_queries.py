"""Whole file checks on lines that Spark derives from the supplied tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.classify import classify_files
from ..operators.parse import delimited_line
from ..session import spread, stage
from ..spec import platform_a_layouts, platform_c_layouts
from . import check, reconcile
from .queries import account_managers, error_catalogue, money, query, table

LATE = 5_000_000_000_000
DEPOSITS = 1_000_000_000_000


def _line(code: str, names: list[str], values: dict) -> Column:
    """A line of a layout; fields without a value stay blank."""
    cells = [values.get(n, "") for n in names]
    return delimited_line(F.lit(code), *[F.lit(c) if isinstance(c, str) else c for c in cells])


def a_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files per nation: members with their plans and urgent deposits, then the other deposits.

    Members of one segment come after their plan rows, members of another have a bad address.
    """
    customer = spread(table(spark, sf_dir, "customer"))
    orders = spread(table(spark, sf_dir, "orders"))
    layouts = platform_a_layouts()
    er = F.concat(F.lit("EMP"), F.lpad(F.col("c_nationkey").cast("string"), 3, "0"))
    ee = F.col("c_custkey").cast("string")
    file_a = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), F.lit("_a"))
    at = F.when(F.col("c_mktsegment") == "MACHINERY", " at ").otherwise("@")
    member = _line(
        "IB",
        layouts["IB", "Old"].names,
        {
            "TpaId": "TPA01", "EmployerId": er, "EmployeeID": ee, "EmployeeSocialSecurityNumber": ee, "LastName": F.col("c_name"),
            "State": "il", "Country": "US", "Zip": "62701-1234", "BirthDate": "1/15/1980", "EmployeeStatus": "2",
            "Email": F.concat(F.lit("c"), ee, at, F.lit("example.org")),
        },
    )
    plan = _line(
        "IC",
        layouts["IC", "New"].names,
        {
            "TpaId": "TPA01", "EmployerId": er, "PlanId": "PLAN-1", "EmployeeID": ee, "AccountTypeCode": "FSA",
            "PlanStartDate": "01/01/2024", "PlanEndDate": "20241231", "AccountStatus": "2",
            "OriginalPrefunded": F.format_number(money("c_acctbal"), 2),
            "EffectiveDate": F.when(F.col("c_custkey") % 7 == 0, "20250101").otherwise("2024-03-01"),
        },
    )
    place = F.col("c_custkey") * 10
    late = F.when(F.col("c_mktsegment") == "BUILDING", LATE).otherwise(0)
    members = customer.select(file_a.alias("file"), (place + late).alias("source_row_no"), member.alias("line"))
    plans = customer.select(file_a.alias("file"), (place + 1).alias("source_row_no"), plan.alias("line"))

    owned = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    deposit = _line(
        "IH",
        layouts["IH", "Old"].names,
        {
            "TpaId": "TPA01", "EmployerId": er, "EmployeeID": ee, "AccountTypeCode": "FSA", "PlanStartDate": "20240101",
            "PlanEndDate": "20241231", "DepositType": F.when(F.col("o_orderstatus") == "P", "3").otherwise("1"),
            "EmployeeDepositAmount": F.format_number(money("o_totalprice"), 2),
            "EffectiveDate": F.concat(F.lit("2024"), F.date_format("o_orderdate", "MM"), F.lit("15")),
        },
    )
    part = F.when(F.col("o_orderpriority") == "1-URGENT", "_a").otherwise("_b")
    deposits = owned.select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string"), part).alias("file"),
        (F.col("o_orderkey") + DEPOSITS).alias("source_row_no"),
        deposit.alias("line"),
    )
    lines = members.unionByName(plans).unionByName(deposits)
    arrived = F.when(F.col("file").endswith("_a"), 1).otherwise(2)
    return stage(lines.withColumn("modified", F.timestamp_seconds(arrived)), "a-files")


def a_masters(spark: SparkSession, sf_dir: str) -> check.MastersA:
    nation, customer = table(spark, sf_dir, "nation"), table(spark, sf_dir, "customer")
    code = lambda c: F.concat(F.lit("EMP"), F.lpad(F.col(c).cast("string"), 3, "0"))
    day = lambda d: F.lit(d).cast("date")
    held = customer.where("c_acctbal > 5000").select(
        code("c_nationkey").alias("employerid"), F.lpad(F.col("c_custkey").cast("string"), 9, "0").alias("employeeid")
    )
    start = F.when(F.col("n_regionkey") == 3, "2024-02-01").otherwise("2024-01-01").cast("date")
    return check.MastersA(
        nation.where("n_regionkey <> 4").select(code("n_nationkey").alias("employer_id")),
        held,
        nation.select(
            code("n_nationkey").alias("employer_id"), F.lit("FSA").alias("account_type_code"),
            F.lit("PLAN-1").alias("plan_id"), start.alias("planstart"), day("2024-12-31").alias("planend"),
        ),
        held.withColumns(
            {"plancode": F.lit("FSA"), "plandesc": F.lit("PLAN-1"), "planstart": day("2024-01-01"), "planend": day("2024-12-31")}
        ),
    )


A_CTE = """
c AS (SELECT *, n_regionkey AS region, c_acctbal > 5000 AS held,
    c_mktsegment <> 'MACHINERY' AND n_regionkey <> 4 AS joins FROM customer JOIN nation ON c_nationkey = n_nationkey),
ic AS (SELECT *, CASE WHEN region = 4 THEN 'EmployerId' WHEN region = 3 OR c_custkey % 7 = 0 THEN 'PlanId'
    WHEN NOT held AND NOT (joins AND c_mktsegment <> 'BUILDING') THEN 'EmployeeID' ELSE '' END AS code FROM c),
ih AS (SELECT o.*, ic.c_nationkey, 'nation_' || c_nationkey || CASE WHEN o_orderpriority = '1-URGENT' THEN '_a' ELSE '_b' END AS file,
    month(o_orderdate) AS m, CASE WHEN o_orderstatus = 'P' THEN 'DepositType' WHEN region = 4 THEN 'EmployerId'
    WHEN NOT held AND code <> '' THEN 'AccountTypeCode' ELSE '' END AS code
  FROM orders o JOIN ic ON o_custkey = c_custkey),
posted AS (SELECT DISTINCT o_custkey, m FROM ih WHERE code = '' AND file LIKE '%_a'),
rows_ AS (
  SELECT 'nation_' || c_nationkey || '_a' AS file, 'IB' AS row_type,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Email' WHEN region = 4 THEN 'EmployerId' ELSE '' END AS error_code FROM c
  UNION ALL SELECT 'nation_' || c_nationkey || '_a', 'IC', code FROM ic
  UNION ALL SELECT file, 'IH', CASE WHEN code = '' AND right(file, 2) = '_b' AND p.m IS NOT NULL THEN 'DuplicatePosting' ELSE code END
    FROM ih LEFT JOIN posted p ON p.o_custkey = ih.o_custkey AND p.m = ih.m)"""


def checked_a_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, _ = check.check_a(a_lines(spark, sf_dir), a_masters(spark, sf_dir))
    return rows


@query(
    f"""WITH {A_CTE}
SELECT file, row_type, error_code, count(*) AS row_count FROM rows_ GROUP BY 1, 2, 3"""
)
def a_file_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform A from lines to checked rows: layouts, rules, look-ups in order, repeat postings."""
    rows = checked_a_files(spark, sf_dir)
    return rows.groupBy("file", "row_type", "error_code").agg(F.count("*").alias("row_count"))


C_MAIN = {
    "FirstName": "Jo", "Address1": "1 Main St", "City": "Town", "StateOrProvince": "IL", "PostalCode": "62701",
    "TobaccoUse": "NO", "EmployeeType": "FTE", "EmployeePayrollType": "EXEMPT", "PremiumCouponType": "NONE",
    "Active": "yes", "AllowMemberSSO": "F", "Sex": "F", "PremiumAddressSameAsPrimary": "TRUE", "UsesHCTC": "no",
    "BillingStartDate": "01/01/2024", "BillingEndDate": "12/31/2024", "BillingType": "RETIREE", "BillingFrequency": "MONTHLY",
    "IsCOBRAEligible": "1", "IsCOBRAEligibleAtTermination": "1", "SubsequentGracePeriodNrOfDays": "30",
    "SPMSubsequentGracePeriodOptionType": "IGNORE", "IsLegacy": "0", "EnrollmentDate": "01/01/2024", "EventDate": "01/01/2024",
}
C_PLAN = {"StartDate": "2/1/2024", "CoverageLevel": "EE", "SendPlanChangeLetterForLegacy": "TRUE"}


def c_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per region: a member row per customer and a plan row of either family below it."""
    home = (
        spread(table(spark, sf_dir, "customer"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    layouts = platform_c_layouts()
    client = F.when(F.col("c_custkey") % 13 == 0, "NOWHERE").otherwise(F.col("r_name"))
    division = F.when(F.col("c_custkey") % 17 == 0, "NOWHERE").otherwise(F.col("n_name"))
    values = {
        **C_MAIN, "ClientName": client, "ClientDivisionName": division, "LastName": F.col("c_name"),
        "SSN": F.col("c_custkey").cast("string"), "DOB": F.when(F.col("c_acctbal") < 0, "31/31/1980").otherwise("19800131"),
    }
    is_qb = F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY")
    main = F.when(is_qb, _line("[QB]", layouts["[QB]"].names, values)).otherwise(
        _line("[SPM]", layouts["[SPM]"].names, values)
    )
    plan = {**C_PLAN, "PlanName": F.col("c_mktsegment")}
    entries = F.array(
        F.struct(F.lit(0).alias("n"), main.alias("line")),
        F.struct(F.lit(1).alias("n"), _line("[QBPLAN]", layouts["[QBPLAN]"].names, plan).alias("line")),
        F.struct(F.lit(2).alias("n"), _line("[SPMPLAN]", layouts["[SPMPLAN]"].names, plan).alias("line")),
    )
    exploded = home.select(
        F.concat(F.lit("region_"), F.col("r_regionkey").cast("string")).alias("file"), "c_custkey", F.explode(entries).alias("e")
    )
    lines = exploded.select(
        "file", (F.col("c_custkey") * 3 + F.col("e.n") + 1).alias("source_row_no"), F.col("e.line").alias("line")
    )
    return stage(lines, "c-files")


def c_masters(spark: SparkSession, sf_dir: str) -> check.MastersC:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    held = customer.where("c_acctbal > 9000").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    plan_id = F.concat_ws("/", F.col("n_regionkey").cast("string"), "c_mktsegment")
    members = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("member_id"), F.col("n_regionkey").alias("client_id"),
        F.col("n_nationkey").alias("client_division_id"), F.col("s_suppkey").cast("string").alias("ssn"),
    )
    return check.MastersC(
        region.select(F.col("r_regionkey").alias("client_id"), F.col("r_name").alias("client_name")),
        nation.select(
            F.col("n_nationkey").alias("client_division_id"), F.col("n_regionkey").alias("client_id"),
            F.col("n_name").alias("division_name"),
        ),
        {"QB": members, "SPM": members, "NPM": members.drop("client_id")},
        held.select(
            plan_id.alias("client_plan_qb_id"), F.col("n_regionkey").alias("client_id"), F.col("c_mktsegment").alias("plan_name")
        ).distinct(),
        held.select(F.col("n_nationkey").alias("client_division_id"), plan_id.alias("client_plan_qb_id")).distinct(),
    )


@query(
    """WITH c AS (SELECT c.*, n_regionkey AS region, c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY') AS qb,
    c_custkey % 13 = 0 AS no_client, c_custkey % 17 = 0 AND c_custkey % 13 <> 0 AS no_division
  FROM customer c JOIN nation ON c_nationkey = n_nationkey),
plans AS (SELECT DISTINCT region, c_mktsegment AS plan FROM c WHERE c_acctbal > 9000),
links AS (SELECT DISTINCT c_nationkey AS division, c_mktsegment AS plan FROM c WHERE c_acctbal > 9000),
j AS (SELECT c.*, p.plan IS NOT NULL AND l.plan IS NOT NULL AS plan_ok FROM c
  LEFT JOIN plans p ON p.region = c.region AND p.plan = c.c_mktsegment
  LEFT JOIN links l ON l.division = c.c_nationkey AND l.plan = c.c_mktsegment),
rows_ AS (
  SELECT region, CASE WHEN qb THEN '[QB]' ELSE '[SPM]' END AS row_type, array_to_string([x FOR x IN [
      CASE WHEN c_acctbal < 0 THEN 'DOB' END, CASE WHEN no_client THEN 'ClientAndDivision;Client And Division Does Not Exist' END,
      CASE WHEN no_division THEN 'ClientAndDivision' END] IF x IS NOT NULL], ';') AS error_code FROM j
  UNION ALL SELECT region, '[QBPLAN]', CASE WHEN NOT qb OR no_client OR no_division THEN 'No Current QB'
      WHEN NOT plan_ok THEN 'No Such Plan Found' ELSE '' END FROM j
  UNION ALL SELECT region, '[SPMPLAN]', CASE WHEN qb OR no_client OR no_division THEN 'No Current SPM' ELSE '' END FROM j)
SELECT 'region_' || region AS file, row_type, error_code, count(*) AS row_count FROM rows_ GROUP BY 1, 2, 3"""
)
def c_file_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform C from lines to checked rows: layouts, rules, main rows, parents and plans."""
    rows = check.check_c(c_lines(spark, sf_dir), c_masters(spark, sf_dir))
    return rows.groupBy("file", "row_type", "error_code").agg(F.count("*").alias("row_count"))


@query(
    f"""WITH {A_CTE},
f AS (SELECT file, count(*) AS n, count(*) FILTER (error_code <> '') AS bad FROM rows_ GROUP BY 1)
SELECT file, n AS row_count, bad AS error_rows, CASE WHEN bad > 0 THEN 'PartialFail' ELSE 'Ok' END AS outcome,
  'a/' || CASE WHEN bad > 0 THEN 'rejects' ELSE 'passed' END AS destination FROM f"""
)
def file_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where each checked platform A file goes."""
    lines = a_lines(spark, sf_dir)
    rows, wrong = check.check_a(lines, a_masters(spark, sf_dir))
    outcome = check.outcomes(rows, wrong)
    files = lines.groupBy("file").agg(F.sum(F.length("line") + 1).alias("size"))
    routed = check.route(files, classify_files(lines), outcome)
    return routed.join(outcome.select("file", "row_count", "error_rows"), "file").select(
        "file", "row_count", "error_rows", "outcome", "destination"
    )


TEMPLATES = {"Old": "IA,XX,TPA01,Old Template", "New": "IA,XX,TPA01,New Template"}


@query(
    """WITH f AS (SELECT 'nation_' || c_nationkey AS file, count(*) AS n, any_value(c_nationkey % 5) AS k FROM customer GROUP BY c_nationkey)
SELECT file, CASE k WHEN 0 THEN 'IA,XX,TPA01,Old Template' WHEN 2 THEN 'IA,9,TPA01,Own' ELSE 'IA,XX,TPA01,New Template' END AS header,
  n AS line_count FROM f"""
)
def standard_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header step: own headers are replaced by the template of the layout, notices are dropped.

    The first line of a file decides: some files begin with an old enrolment and go on with
    deposits, some the other way round, some are of segmented funding, some fit no layout.
    """
    c = table(spark, sf_dir, "customer")
    heads_of = c.groupBy("c_nationkey").agg(F.min("c_custkey").alias("first_key"))
    c = c.join(heads_of, "c_nationkey")
    kind, first = F.col("c_nationkey") % 5, F.col("c_custkey") == F.col("first_key")
    old, deposit = (F.concat(F.lit(code), F.repeat(F.lit(","), F.lit(n - 1))) for code, n in (("IC", 14), ("IZ", 7)))
    body = (
        F.when(kind == 0, F.when(first, old).otherwise(deposit))
        .when(kind == 1, F.concat(F.lit("IC"), F.repeat(F.lit(","), F.lit(14))))
        .when(kind == 2, F.concat(F.lit("IC"), F.repeat(F.lit(","), F.lit(16))))
        .when(kind == 3, F.concat(F.lit("IC"), F.repeat(F.lit(","), F.lit(15))))
        .otherwise(F.when(first, deposit).otherwise(old))
    )
    entries = F.array(
        F.struct(F.lit(0).alias("n"), body.alias("line")),
        F.struct(F.lit(1).alias("n"), F.lit("Please email completed file to x@example.org").alias("line")),
        F.struct(F.lit(2).alias("n"), F.lit("  ").alias("line")),
    )
    file = F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("file")
    lines = c.select(file, "c_custkey", F.explode(entries).alias("e")).select(
        "file", (F.col("c_custkey") * 3 + F.col("e.n") + 2).alias("source_row_no"), F.col("e.line").alias("line")
    )
    heads = c.select(file).distinct().select("file", F.lit(1).cast("bigint").alias("source_row_no"), F.lit("IA,9,TPA01,Own").alias("line"))
    out = check.prepare_headers(heads.unionByName(lines), TEMPLATES)
    is_head = F.col("line").startswith("IA,")
    return out.groupBy("file").agg(
        F.max(F.when(is_head, F.col("line"))).alias("header"), F.count_if(~is_head).alias("line_count")
    )


RESULT_LINES_CTE = """
li AS (SELECT 'res_' || l_returnflag || '.csv' AS rf, l_orderkey, l_linenumber, l_suppkey, l_partkey,
    CASE WHEN l_discount > 0.05 THEN '15028' WHEN l_tax > 0.04 THEN '0' ELSE '777' END AS code, l_linestatus = 'O' AS is_rb FROM lineitem),
err AS (SELECT DISTINCT 'sent_' || substr(rf, 5, 1) || '.mbi' AS sent_file, 'NATION_' || (l_suppkey % 30) AS er, code,
    CASE WHEN is_rb THEN 'RB' ELSE 'RC' END AS row_type, l_orderkey * 10 + l_linenumber AS n,
    CASE WHEN code = '15028' THEN 'Employer must be active' WHEN is_rb THEN 'own text' END AS msg, l_partkey, l_suppkey
  FROM li WHERE code <> '0')"""


@query(
    f"""WITH {RESULT_LINES_CTE}
SELECT e.sent_file, e.row_type, e.code AS error_code, e.msg AS error_message, m.crm, count(*) AS row_count,
  count(s.l_orderkey) AS matched
FROM (SELECT DISTINCT sent_file, row_type, code, msg, er, n, l_partkey, l_suppkey FROM err) e
LEFT JOIN (SELECT DISTINCT 'sent_' || l_returnflag || '.mbi' AS f, l_orderkey, l_orderkey * 10 + l_linenumber AS n FROM lineitem
  WHERE l_quantity > 25) s ON s.f = e.sent_file AND s.n = e.n
LEFT JOIN (SELECT n_name, 'mgr ' || n_regionkey AS crm FROM nation) m ON m.n_name = e.er
GROUP BY 1, 2, 3, 4, 5"""
)
def result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files from lines to a report: two record layouts, sent names, texts, sent rows, managers."""
    li = spread(table(spark, sf_dir, "lineitem"))
    code = F.when(F.col("l_discount") > 0.05, "15028").when(F.col("l_tax") > 0.04, "0").otherwise("777")
    er = F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 30).cast("string"))
    ee = F.concat_ws("-", F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string"))
    known = F.when(code == "15028", "").otherwise("own text")
    rb = delimited_line(F.lit("RB"), er, ee, code, known)
    rc = delimited_line(F.lit("RC"), er, ee, F.lit("PLAN-1"), F.lit("20240101"), F.lit("20241231"), code)
    number = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    file = F.concat(F.lit("out/res_"), F.col("l_returnflag"), F.lit(".csv"))
    body = li.select(
        file.alias("file"), number.alias("source_row_no"), F.when(F.col("l_linestatus") == "O", rb).otherwise(rc).alias("line")
    )
    head = F.concat(F.lit("RA,sent_"), F.col("l_returnflag"), F.lit(".mbi,Result Template"))
    heads = li.select(file.alias("file"), F.lit(0).cast("bigint").alias("source_row_no"), head.alias("line")).distinct()
    sent = li.where("l_quantity > 25").select(
        F.concat(F.lit("sent_"), F.col("l_returnflag"), F.lit(".mbi")).alias("file"), number.alias("row_num"),
        F.lit("line").alias("data_row"),
    ).distinct()
    loaded = reconcile.load_results(heads.unionByName(body), error_catalogue(spark, sf_dir))
    report = reconcile.error_report(loaded, sent, account_managers(spark, sf_dir))
    return report.groupBy("sent_file", "row_type", "error_code", "error_message", "crm").agg(
        F.count("*").alias("row_count"), F.count("sent_row_num").alias("matched")
    )
