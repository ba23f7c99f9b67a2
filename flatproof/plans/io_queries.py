"""Registered queries of sources, sinks and small steps, each beside the SQL that checks it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as K
from ..operators import export, lookups, merge, results, rules
from ..operators.parse import delimited_line, parse_record
from ..session import scratch_path
from ..sources import lines as L
from ..sources import sinks, tables
from ..spec import record
from ..streaming.ingest import ingest, stream_lines
from . import check, reconcile
from .queries import error_catalogue, money, query, table

KINDS = record(
    "PT",
    [
        "PartKey:int*", "Zip:zip[4]", "Phone:phone[4]", "SSN:ssn[9..9]", "Alnum:alnum", "AlnumDash:alnumdash", "Alpha:alpha",
        "AlphaDash:alphadash", "NumDash:numdash", "YesNo:yesno", "TrueFalse:truefalse", "Price:money", "Size:int",
        "Email:email", "Day:isodate", "UsDay:usdate",
    ],
)


def kind_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as lines with a value of every kind, some of them faulty."""
    p = table(spark, sf_dir, "part")
    price, both = money("p_retailprice").cast("string"), F.concat_ws("-", "p_name", "p_brand")
    key, odd = F.col("p_partkey").cast("string"), F.col("p_partkey") % 3
    yes = F.when(odd == 0, "Yes").when(odd == 1, "0").otherwise("maybe")
    true = F.when(odd == 0, "TRUE").when(odd == 1, "no").otherwise("?")
    size = F.when(odd == 2, "x").otherwise(F.col("p_size").cast("string"))
    email = F.concat(F.lit("p"), key, F.when(odd == 0, "").otherwise("@"), F.lit("example.org"))
    day = F.when(odd == 0, "2/3/2024").when(odd == 1, "20240203").otherwise("2024-02-31")
    line = delimited_line(
        F.lit("PT"), key, price, price, key, both, both, both, both, both, yes, true, price, size, email, day, day
    )
    return p.select("p_partkey", line.alias("line"))


def _kinds_sql(platform: str) -> str:
    """The cleaned values and the failing fields of a platform; only flags differ."""
    on_c = platform == "C"
    yes = "['1', '0', 'maybe']" if on_c else "['Yes', '0', 'maybe']"
    true = "['1', '0', '?']" if on_c else "['TRUE', 'no', '?']"
    bad = {
        "YesNo": "o = 2" if on_c else "o > 0", "TrueFalse": "o = 2" if on_c else "o > 0", "Size": "o = 2",
        "Email": "o = 0", "Day": "o = 2", "UsDay": "o = 2",
    }
    codes = ", ".join(f"CASE WHEN {test} THEN '{name}' END" for name, test in bad.items())
    return rf"""SELECT '{platform}' AS platform, k AS part_key, left(regexp_replace(price, '[^0-9]', '', 'g'), 4) AS zip,
  right(regexp_replace(price, '[^0-9]', '', 'g'), 4) AS phone,
  CASE WHEN length(k) < 9 THEN lpad(k, 9, '0') ELSE k END AS ssn,
  trim(regexp_replace(both_, '[^a-zA-Z0-9\s]', '', 'g')) AS alnum, trim(regexp_replace(both_, '[^a-zA-Z0-9\-]', '', 'g')) AS alnum_dash,
  trim(regexp_replace(both_, '[^a-zA-Z]', '', 'g')) AS alpha, trim(regexp_replace(both_, '[^a-zA-Z\-]', '', 'g')) AS alpha_dash,
  regexp_replace(both_, '[^0-9\-]', '', 'g') AS num_dash, {yes}[o + 1] AS yes_no, {true}[o + 1] AS true_false, price,
  CASE WHEN o = 2 THEN 'x' ELSE CAST(p_size AS VARCHAR) END AS size,
  CASE WHEN o = 2 THEN '2024-02-31' ELSE '20240203' END AS day, CASE WHEN o = 2 THEN '2024-02-31' ELSE '02/03/2024' END AS us_day,
  array_to_string([x FOR x IN [{codes}] IF x IS NOT NULL], ';') AS error_code FROM src"""


@query(
    f"""WITH src AS (SELECT CAST(p_partkey AS VARCHAR) AS k, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS price,
  p_name || '-' || p_brand AS both_, p_partkey % 3 AS o, p_size FROM part)
{_kinds_sql("A")} UNION ALL {_kinds_sql("C")}"""
)
def engine_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every kind of field through the rule engine, on both platforms: cleaned values and failing fields."""
    parsed = parse_record(kind_lines(spark, sf_dir), KINDS)

    def checked(platform: str) -> DataFrame:
        flat = rules.flatten_errors(rules.apply_rules(parsed, KINDS, rules.RuleOptions(platform)))
        return flat.select(
            F.lit(platform).alias("platform"), F.col("PartKey").alias("part_key"), F.col("Zip").alias("zip"),
            F.col("Phone").alias("phone"), F.col("SSN").alias("ssn"), F.col("Alnum").alias("alnum"),
            F.col("AlnumDash").alias("alnum_dash"), F.col("Alpha").alias("alpha"), F.col("AlphaDash").alias("alpha_dash"),
            F.col("NumDash").alias("num_dash"), F.col("YesNo").alias("yes_no"), F.col("TrueFalse").alias("true_false"),
            F.col("Price").alias("price"), F.col("Size").alias("size"), F.col("Day").alias("day"), F.col("UsDay").alias("us_day"),
            "error_code",
        )

    return checked("A").unionByName(checked("C"))


@query(
    """SELECT 'N' || c_nationkey AS bencode, c_name AS org_name, count(*) AS row_count FROM customer GROUP BY 1, 2"""
)
def account_manager_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The account-manager list, written with quotes and read back by layout."""
    names = tables.csv_layout("managers").names
    c = table(spark, sf_dir, "customer")
    values = {
        "bencode": F.concat(F.lit('"N'), F.col("c_nationkey").cast("string"), F.lit('"')), names[1]: F.col("c_name"),
    }
    path = scratch_path(spark, "managers")
    c.select(*[values.get(n, F.lit(f"a, {n}")).alias(n) for n in names]).write.option("header", "true").option(
        "escape", '"'
    ).csv(path)
    read = tables.read_account_managers(spark, [path])
    return read.groupBy("bencode", F.col(names[1]).alias("org_name")).agg(F.count("*").alias("row_count"))


@query(
    """SELECT CAST(l_shipdate AS DATE) AS day, CAST(sum(CASE WHEN l_returnflag = 'N' THEN CAST(l_extendedprice AS DECIMAL(18,2)) ELSE 0 END)
  AS DECIMAL(18,2)) AS amount, CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS qty, count(*) AS row_count
FROM lineitem GROUP BY 1"""
)
def invoice_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An invoice export, written as text and read back typed; unreadable amounts are zero."""
    names = tables.csv_layout("invoice").names
    li = table(spark, sf_dir, "lineitem")
    amount = F.when(F.col("l_returnflag") == "N", F.format_number(money("l_extendedprice"), 2)).otherwise("n/a")
    values = {
        "date": F.date_format("l_shipdate", "MM/dd/yyyy"), "qty": money("l_quantity").cast("string"), "amount": amount,
        "num": F.col("l_orderkey").cast("string"),
    }
    path = scratch_path(spark, "invoices")
    li.select(*[values.get(n, F.lit("")).alias(n) for n in names]).write.option("header", "true").csv(path)
    read = tables.read_invoices(spark, [path])
    return read.groupBy(F.col("date").alias("day")).agg(
        F.sum("amount").cast("decimal(18,2)").alias("amount"), F.sum("qty").cast("decimal(18,2)").alias("qty"),
        F.count("*").alias("row_count"),
    )


@query(
    """SELECT replace(o_orderpriority, ' ', '_') AS out_file, sum(length(CAST(o_orderkey AS VARCHAR)) + 1)::BIGINT AS size FROM orders GROUP BY 1"""
)
def listed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of written files by name, from their listing alone."""
    o = table(spark, sf_dir, "orders").select(
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("out_file"), F.col("o_orderkey").alias("row_no"),
        F.col("o_orderkey").cast("string").alias("file_row"),
    )
    path = scratch_path(spark, "listed")
    sinks.write_lines(o, path)
    files = L.list_files(spark, [path], masks=["*.txt", "*.csv"], recursive=True)
    name = F.regexp_extract("path", "/out_file=([^/]*)/", 1)
    return files.groupBy(name.alias("out_file")).agg(F.sum("size").alias("size"))


@query(
    """SELECT 'sent_' || c_custkey || '.mbi' AS file, CASE c_nationkey % 2 WHEN 0 THEN 'A' ELSE 'C' END AS platform,
  'Could not process this file:' || chr(10) || 'sent_' || c_custkey || '.mbi' || chr(10) || 'no layout fits' AS side_text
FROM customer WHERE c_acctbal < 0"""
)
def quarantined_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rejected files, written by platform with the text beside them and read back."""
    c = table(spark, sf_dir, "customer")
    files = c.select(
        F.concat(F.lit("sent_"), F.col("c_custkey").cast("string"), F.lit(".mbi")).alias("file"),
        F.when(F.col("c_nationkey") % 2 == 0, "A").otherwise("C").alias("platform"),
        F.when(F.col("c_acctbal") < 0, "no layout fits").alias("reason"),
    )
    path = scratch_path(spark, "quarantine")
    sinks.write_quarantine(files, path)
    return spark.read.parquet(path).select("file", "platform", "side_text")


@query(
    """SELECT 's' || lpad(CAST(s_suppkey AS VARCHAR), 6, '0') AS folder_name, 'New' AS template_type FROM supplier
WHERE s_nationkey % 3 = 0 AND s_suppkey % 2 = 0 AND s_acctbal > 0"""
)
def active_source_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    registry = s.select(
        F.concat(F.lit("s"), F.lpad(F.col("s_suppkey").cast("string"), 6, "0")).alias("folder_name"),
        F.when(F.col("s_nationkey") % 3 == 0, "New").otherwise("Old").alias("template_type"),
        F.when(F.col("s_suppkey") % 2 == 0, "PROD").otherwise("TEST").alias("environment"),
        (F.col("s_acctbal") > 0).cast("int").alias("is_active"),
    )
    return L.active_folders(registry, "PROD", "new").select("folder_name", "template_type")


@query(
    """SELECT c_custkey AS key, CASE WHEN c_custkey % 4 = 0 THEN 'TPA ID cannot be blank. It must always be TPA01'
  WHEN c_custkey % 4 = 1 THEN 'TPA ID ''TPA' || (c_nationkey + 10) || ''' is invalid. It must always be TPA01' END AS message FROM customer"""
)
def tpa_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The constant organisation id: blank, wrong and right ones."""
    kind = F.col("c_custkey") % 4
    wrong = F.concat(F.lit("TPA"), (F.col("c_nationkey") + 10).cast("string"))
    rows = table(spark, sf_dir, "customer").withColumn(
        "TpaId", F.when(kind == 0, " ").when(kind == 1, wrong).otherwise("TPA01")
    )
    return rows.select(F.col("c_custkey").alias("key"), lookups.tpa_error("TPA01", True)["message"].alias("message"))


@query(
    """SELECT o_orderkey AS plan_id, o_custkey AS client_id FROM orders
WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')"""
)
def plans_of_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    plans = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("plan_id"), F.col("o_custkey").alias("client_id"))
    clients = table(spark, sf_dir, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("client_id"))
    return lookups.plans_of_clients(plans, clients).select("plan_id", "client_id")


@query(
    """SELECT o_orderkey AS key, 'PreCheck' AS check_type, o_orderstatus AS data_row,
  CASE WHEN o_orderkey % 3 = 0 THEN o_orderstatus ELSE o_orderpriority END AS org_data_row FROM orders"""
)
def original_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The original row text is set once, where it is blank; rows carry their kind of check."""
    original = F.when(F.col("o_orderkey") % 3 == 0, "").otherwise(F.col("o_orderpriority"))
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("data_row"), original.alias("org_data_row")
    )
    return merge.mark_check(merge.keep_original(rows)).select("key", "check_type", "data_row", "org_data_row")


@query(
    """SELECT 'f' || (o_custkey % 20) AS file, o_orderkey AS row_no,
  o_orderstatus || CASE WHEN o_orderstatus = 'P' THEN ',Warning: bad' ELSE ',OK' END AS file_row FROM orders"""
)
def returned_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the check of a file returns: all its lines with their outcome."""
    rows = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("f"), (F.col("o_custkey") % 20).cast("string")).alias("file"), F.col("o_orderkey").alias("source_row_no"),
        F.lit("IB").alias("row_type"), F.col("o_orderstatus").alias("data_row"), F.col("o_orderstatus").alias("org_data_row"),
        F.when(F.col("o_orderstatus") == "P", "bad").otherwise("").alias("error_message"),
    )
    return export.return_texts(export.split_rows(rows)).select("file", "row_no", "file_row")


@query(
    """SELECT c_custkey AS key, CASE c_custkey % 2 WHEN 0 THEN '[QB],' || c_name || ',' || ['1', '0', 'maybe'][c_custkey % 3 + 1]
  ELSE '[SPM],' || c_name || ',' || ['Yes', 'f', 'maybe'][c_custkey % 3 + 1] END AS line FROM customer"""
)
def prepared_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boolean words of platform C lines as 1 and 0, at the places that are flags."""
    kind = F.col("c_custkey") % 3
    word = F.when(kind == 0, "Yes").when(kind == 1, "f").otherwise("maybe")
    code = F.when(F.col("c_custkey") % 2 == 0, "[QB]").otherwise("[SPM]")
    lines = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("key"), F.concat_ws(",", code, "c_name", word).alias("line")
    )
    return export.prepare_c_flags(lines, {"[QB]": [2]})


@query(
    """WITH f AS (SELECT o_orderpriority AS file, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS bad FROM orders GROUP BY 1)
SELECT file, '{"file":"' || file || '","outcome":"PartialFail","code":"300","row_count":' || n || ',"error_rows":' || bad || '}' AS report FROM f"""
)
def run_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON text per checked file."""
    errors = F.when(F.col("o_orderstatus") == "P", F.array(rules.error("Status", F.lit("bad")))).otherwise(rules.no_errors())
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("file"), errors.alias("errors"), F.lit("OR").alias("row_type")
    )
    return check.run_reports(check.outcomes(rows))


@query(
    """SELECT o_orderpriority AS file, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS source_row_no,
  'OR,' || o_orderkey AS line FROM orders"""
)
def stream_numbered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that arrive as a stream, two to a batch, with their lines numbered and stored by file and number."""
    inbox, held, seen = (scratch_path(spark, n) for n in ("arriving", "numbered", "seen"))
    o = table(spark, sf_dir, "orders").select(
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("out_file"), "o_orderkey",
        F.concat_ws(",", F.lit("OR"), F.col("o_orderkey").cast("string")).alias("value"),
    )
    # One part per file, so that a file arrives as a whole.
    o.repartition("out_file").sortWithinPartitions("out_file", "o_orderkey").select("out_file", "value").write.partitionBy(
        "out_file"
    ).text(inbox)
    numbered = lambda batch: L.number_lines(L.as_logical_files(batch)).select("file", "source_row_no", "line")
    ingest(stream_lines(spark, inbox, files_per_trigger=2), numbered, held, seen, merge.ROW_KEY)
    stored = merge.read_table(spark, held)
    return stored.select(F.replace("file", F.lit("_"), F.lit(" ")).alias("file"), "source_row_no", "line")


@query(
    """WITH li AS (SELECT l_returnflag, l_orderkey, l_linenumber, max(l_discount) AS d, max(l_tax) AS t, max(l_linestatus) = 'O' AS rb
    FROM lineitem GROUP BY 1, 2, 3),
coded AS (SELECT *, CASE WHEN d > 0.05 THEN '15028' WHEN t > 0.04 THEN '0' WHEN l_returnflag = 'R' THEN '20001' ELSE '777' END AS code FROM li)
SELECT 'res_' || l_returnflag || '.csv' AS result_file, 'sent_' || l_returnflag || '.mbi' AS sent_file,
  CASE WHEN rb THEN 'RB' ELSE 'RC' END AS row_type, code AS error_code, count(*) AS row_count FROM coded GROUP BY 1, 2, 3, 4
UNION ALL SELECT DISTINCT 'res_' || l_returnflag || '.csv', 'sent_' || l_returnflag || '.mbi', 'RA', NULL, 1 FROM lineitem"""
)
def stored_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result files loaded and stored by file and row number; one file comes again with other codes."""
    li = table(spark, sf_dir, "lineitem").groupBy("l_returnflag", "l_orderkey", "l_linenumber").agg(
        F.max("l_discount").alias("d"), F.max("l_tax").alias("t"), F.max("l_linestatus").alias("s")
    )

    def loaded(rows: DataFrame, other: str) -> DataFrame:
        code = F.when(F.col("d") > 0.05, "15028").when(F.col("t") > 0.04, "0").otherwise(other)
        rb = delimited_line(F.lit("RB"), F.lit("EMP"), F.lit("1-2"), code, F.lit(""))
        rc = delimited_line(F.lit("RC"), F.lit("EMP"), F.lit("1-2"), F.lit("PLAN-1"), F.lit("20240101"), F.lit("20241231"), code)
        file = F.concat(F.lit("out/res_"), F.col("l_returnflag"), F.lit(".csv")).alias("file")
        body = rows.select(
            file, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("source_row_no"),
            F.when(F.col("s") == "O", rb).otherwise(rc).alias("line"),
        )
        head = F.concat(F.lit("RA,sent_"), F.col("l_returnflag"), F.lit(".mbi,Result Template")).alias("line")
        heads = rows.select(file, F.lit(0).cast("bigint").alias("source_row_no"), head).distinct()
        return reconcile.load_results(heads.unionByName(body), error_catalogue(spark, sf_dir))

    path = scratch_path(spark, "results")
    reconcile.store_results(spark, path, loaded(li, "777"))
    reconcile.store_results(spark, path, loaded(li.where("l_returnflag = 'R'"), "20001"))
    stored = merge.read_table(spark, path)
    return stored.groupBy("result_file", "sent_file", "row_type", "error_code").agg(F.count("*").alias("row_count"))


@query(
    """WITH r AS (SELECT c_custkey, r_name, n_name, c_custkey % 2 = 0 AS known FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
SELECT c_custkey AS key, '[QBLOOKUP]' AS row_type, known AS main_ok, CASE WHEN known THEN '' ELSE 'QB Not Found' END AS error_code,
  CASE WHEN known THEN '' ELSE 'QB with SSN ''' || c_custkey || ''' not found' END AS message FROM r
UNION ALL SELECT c_custkey, '[QB]', NOT known, CASE WHEN known THEN 'QB Already exists' ELSE '' END,
  CASE WHEN known THEN 'Duplicate QB. QB with SSN ''' || c_custkey || ''' already exists' ELSE '' END FROM r"""
)
def look_up_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Member rows that must exist, and member rows that must not."""
    home = (
        table(spark, sf_dir, "customer")
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    clients = table(spark, sf_dir, "region").selectExpr("r_regionkey as client_id", "r_name as client_name")
    divisions = table(spark, sf_dir, "nation").selectExpr(
        "n_nationkey as client_division_id", "n_regionkey as client_id", "n_name as division_name"
    )
    # Every customer is a member; the numbers of odd ones are other numbers.
    members = home.selectExpr(
        "c_custkey as member_id", "n_regionkey as client_id", "c_nationkey as client_division_id",
        "cast(c_custkey + (c_custkey % 2) * 500000000 as string) as ssn",
    )
    none = members.where("member_id is null")
    families = {"QB": members, "SPM": none, "NPM": none.drop("client_id")}
    mains = home.select(
        F.col("c_custkey").alias("key"), F.explode(F.array(F.lit("[QBLOOKUP]"), F.lit("[QB]"))).alias("row_type"), "r_name",
        "n_name",
    ).select(
        "key", "row_type", F.col("r_name").alias("ClientName"),
        F.when(F.col("row_type") == "[QB]", F.col("n_name")).otherwise("").alias("ClientDivisionName"),
        F.col("key").cast("string").alias("SSN"), rules.no_errors().alias("errors"),
    )
    out = lookups.check_main_rows(mains, clients, divisions, families, fail_if_exists=True)
    return out.select(
        "key", "row_type", "main_ok", F.array_join("errors.code", ";").alias("error_code"),
        F.array_join(F.transform("errors", lambda e: F.trim(e["message"])), ";").alias("message"),
    )


@query(
    """SELECT 'f' AS file, c_custkey AS source_row_no,
  CASE WHEN c_custkey % 5 = 0 THEN 'The Employer ID ''NOWHERE'' could not be found'
       ELSE 'The Employee ID ''X' || c_custkey || ''' could not be found for Employer Id ''EMP' || c_nationkey || '''' END AS message
FROM customer WHERE c_custkey % 5 = 0 OR c_custkey % 3 = 0"""
)
def dependent_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dependents of unknown employers and employees."""
    c = table(spark, sf_dir, "customer")
    employer = F.concat(F.lit("EMP"), F.col("c_nationkey").cast("string"))
    key = F.col("c_custkey").cast("string")
    blank = F.lit("")
    rows = c.select(
        F.lit("f").alias("file"), F.col("c_custkey").alias("source_row_no"), F.lit(1).alias("file_seq"),
        F.lit("ID").alias("row_type"), F.lit("ID/New").alias("layout"), rules.no_errors().alias("errors"), F.lit("TPA01").alias("TpaId"),
        F.when(F.col("c_custkey") % 5 == 0, "NOWHERE").otherwise(employer).alias("EmployerId"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("X"), key)).otherwise(key).alias("EmployeeID"),
        *[blank.alias(n) for n in ("AccountTypeCode", "PlanId", "PlanStartDate", "PlanEndDate", "EffectiveDate", "DepositType")],
    )
    employers = c.select(employer.alias("employer_id")).distinct()
    employees = c.select(employer.alias("employerid"), key.alias("employeeid"))
    plans = employees.selectExpr(
        "employerid as employer_id", "employerid", "employeeid", "'' as account_type_code", "'' as plan_id", "'' as plancode",
        "'' as plandesc", "cast(null as timestamp) as planstart", "cast(null as timestamp) as planend",
    ).where("employeeid is null")
    found = lookups.lookup_errors_a(rows, employers, employees, plans, plans)
    return found.select("file", "source_row_no", F.trim(F.col("found")[0]["message"]).alias("message"))


@query(
    r"""WITH p AS (SELECT page_id, url, md5(url || '|2024-01-01') AS id, regexp_extract(url, '(\.[^./]*)$', 1) AS ext,
    string_split(url, '/')[-1] AS base FROM pages)
SELECT page_id, id AS file_id, string_split(regexp_replace(base, '\.[^./]*$', ''), '--')[1] || '--' || id || ext AS with_id,
  id || '--3--' || base AS with_type, left(regexp_replace(url, '\.[^./]*$', ''), 16) || ext AS transfer_name,
  lower(ext) IN ('.xlsx', '.xls') AS is_excel FROM p"""
)
def transfer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of files on their way: with an id, with id and header type, cut to a length."""
    name = F.col("url")
    new_id = K.file_id(name, F.lit("2024-01-01"))
    return table(spark, sf_dir, "pages").select(
        "page_id", new_id.alias("file_id"), K.add_file_id(name, new_id).alias("with_id"),
        K.add_id_and_header_type(name, new_id, F.lit("New")).alias("with_type"), K.ftp_file_name(name, 20).alias("transfer_name"),
        K.is_excel_file(name).alias("is_excel"),
    )


@query(
    """SELECT o_orderkey AS error_row_num, CASE WHEN o_orderkey % 2 = 0 THEN c_custkey END AS sent_row_num,
  CASE WHEN o_orderkey % 2 = 0 THEN c_name END AS sent_line FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def errors_by_member(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors with the sent row of the same member, where there is one."""
    c = table(spark, sf_dir, "customer")
    sent = c.select(
        F.lit("s.mbi").alias("file"), F.col("c_nationkey").cast("string").alias("EmployerId"),
        F.col("c_custkey").cast("string").alias("EmployeeID"), F.lit("").alias("DependentID"), F.col("c_custkey").alias("row_num"),
        F.col("c_name").alias("data_row"),
    )
    errors = table(spark, sf_dir, "orders").join(c, F.col("o_custkey") == F.col("c_custkey")).select(
        F.lit("s.mbi").alias("sent_file"), F.col("c_nationkey").cast("string").alias("EmployerId"),
        F.col("c_custkey").cast("string").alias("EmployeeID"),
        F.when(F.col("o_orderkey") % 2 == 0, "").otherwise("D1").alias("DependentID"), F.col("o_orderkey").alias("row_num"),
    )
    return results.errors_with_sent_by_member(errors, sent).select("error_row_num", "sent_row_num", "sent_line")


@query(
    """WITH c AS (SELECT CASE l_returnflag WHEN 'R' THEN 'R' ELSE 'I' END || substr('ABCDEFHZ', CAST(l_linenumber AS INTEGER), 1) AS code FROM lineitem)
SELECT code, count(*) AS line_count, right(code, 1) = 'A' AS is_header, left(code, 1) = 'R' AND code <> 'RA' AS is_result
FROM c WHERE code <> 'RG' GROUP BY code"""
)
def catalogue_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines by record type of the catalogue, by its table and by the tests on codes."""
    letter = F.substring(F.lit("ABCDEFHZ"), F.col("l_linenumber").cast("int"), F.lit(1))
    code = F.concat(F.when(F.col("l_returnflag") == "R", "R").otherwise("I"), letter)
    lines = table(spark, sf_dir, "lineitem").select(F.concat(code, F.lit(",x")).alias("line"))
    known = K.catalogue_table(spark).select("code", "is_header", "is_result")
    coded = lines.withColumn("code", K.a_code(F.col("line")))
    tested = coded.join(known, "code").where(
        (K.is_result_code(F.col("code")) == F.col("is_result")) & (K.is_header_code(F.col("code")) == F.col("is_header"))
    )
    return tested.groupBy("code", "is_header", "is_result").agg(F.count("*").alias("line_count"))
