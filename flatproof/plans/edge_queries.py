"""Registered queries of hard cases: very long lines, broken files, repeated runs, each beside the SQL that checks it."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import lookups, merge, rules
from ..operators.parse import column_count, delimited_line, first_field, parse_by_layout
from ..session import glob, remove, scratch_path, spread
from ..sources import lines as L
from ..sources import sinks
from ..spec import platform_c_layouts, record
from ..sql_functions import register_functions
from ..streaming.ingest import Postings, ingest, stream_lines
from . import check, reconcile
from .file_queries import c_masters
from .queries import ORDER_TEXT_CTE, error_catalogue, money, query, stored_orders, table

LAYOUTS = {"LN": record("LN", ["Key:int*", "Name:text[1..5]", "Contact:email"]), "LX": record("LX", ["Key:int*"])}

MANY, LARGE = 100_000, 1_000_000


def long_line_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per nation a line with very many quoted values, one with a very long quoted first value, and two with very long
    addresses, of which one ends in a dot."""
    key = F.col("n_nationkey").cast("string")
    labels = F.repeat(F.lit("a."), F.lit(MANY))

    def entry(kind: str, *parts) -> F.Column:
        cells = [F.lit(p) if isinstance(p, str) else p for p in parts]
        return F.struct(F.lit(kind).alias("kind"), F.concat(*cells).alias("line"))

    many = F.repeat(F.lit('"a,""b",'), F.lit(MANY))
    entries = F.array(
        entry("fields", "LN,", key, ",", many, "z"),
        entry("first", '"', F.repeat(F.lit('x""'), F.lit(LARGE // 3)), '",', key, ",n,c@example.org"),
        entry("address", "LN,", key, ",n,c@", labels, "org"),
        entry("bad address", "LN,", key, ",n,c@", labels),
    )
    every = table(spark, sf_dir, "nation").select("n_nationkey", F.explode(entries).alias("e"))
    return spread(every.select("n_nationkey", "e.kind", "e.line"))


@query(
    f"""SELECT n_nationkey AS key, kind, columns, type_length, error_code FROM nation, (VALUES
  ('fields', {MANY + 3}, 2, 'Contact'), ('first', 4, {LARGE // 3 * 3}, 'Invalid Record Type'), ('address', 4, 2, ''),
  ('bad address', 4, 2, 'Contact')) k(kind, columns, type_length, error_code)"""
)
def long_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that no person would write, through parsing and rules: each takes time in proportion to its length."""
    lines = long_line_rows(spark, sf_dir)
    code = first_field(F.col("line"))
    sized = lines.withColumns({"columns": column_count(F.col("line")), "type_length": F.length(code)})
    parsed = parse_by_layout(sized, LAYOUTS, F.when(code.isin(*LAYOUTS), code))
    checked = rules.apply_rules_by_layout(parsed, LAYOUTS)
    unknown = F.when(F.col("layout").isNull(), rules.error("Invalid Record Type", F.lit("The record type is invalid")))
    return rules.add_error(checked, unknown).select(
        F.col("n_nationkey").alias("key"), "kind", "columns", "type_length", F.array_join("errors.code", ";").alias("error_code")
    )


# --- repeat postings in a stream -----------------------------------------------------------

POSTING = ["user_id", "event_type", "slot"]


def posting_rows(batch: DataFrame) -> DataFrame:
    """Lines of events as rows."""
    value = lambda n, kind: F.split("line", ",")[n].cast(kind)
    return batch.select(
        value(0, "bigint").alias("event_id"), value(1, "bigint").alias("user_id"), value(2, "string").alias("event_type"),
        value(3, "int").alias("slot"), value(4, "date").alias("day"),
    )


def mark_repeats(rows: DataFrame, known: DataFrame | None) -> DataFrame:
    """Rows with the earlier posting that they repeat, of the history or of an earlier day of the batch."""
    found = lookups.earlier_posting(
        rows.drop("previous_id"), POSTING, "day", "event_id", {"event_id": F.col("event_id")}, known, "event_id", name="previous"
    )
    return found.withColumn("previous_id", F.col("previous.event_id")).drop("previous")


def accepted_postings(rows: DataFrame) -> DataFrame:
    """The postings of rows: all of rows that are not marked yet, those without an earlier posting of others."""
    kept = rows.where("previous_id is null") if "previous_id" in rows.columns else rows
    return kept.select(*POSTING, "event_id")


def repeat_last_batch(spark: SparkSession, checkpoint: str) -> None:
    """Take back the mark of the last batch of a stream, as if the run had stopped before it was set."""
    marks = [m for m in glob(spark, f"{checkpoint}/commits/*") if m.rpartition("/")[2].isdigit()]
    last = max(marks, key=lambda m: int(m.rpartition("/")[2]))
    remove(spark, last)


@query(
    """WITH e AS (SELECT event_id, user_id, event_type, day(ts) % 10 AS slot, CAST(ts AS DATE) AS d FROM events),
first_day AS (SELECT user_id, event_type, slot, min(d) AS d1 FROM e GROUP BY 1, 2, 3),
posted AS (SELECT user_id, event_type, slot, f.d1, max(event_id) AS prev FROM e JOIN first_day f USING (user_id, event_type, slot)
  WHERE e.d = f.d1 GROUP BY 1, 2, 3, 4)
SELECT event_id, CASE WHEN d > d1 THEN prev END AS previous_id FROM e JOIN posted USING (user_id, event_type, slot)"""
)
def stream_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Postings that repeat one of an earlier batch, through a stream of three batches. The second one compacts the tables
    and runs twice."""
    inbox, held, seen, past = (scratch_path(spark, n) for n in ("postings", "held", "seen", "past"))
    e = table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))
    cells = (F.col(c).cast("string") for c in ("event_id", "user_id", "event_type"))
    line = F.concat_ws(",", *cells, (F.dayofmonth("ts") % 10).cast("string"), F.col("day").cast("string")).alias("value")
    postings = Postings(past, POSTING, accepted_postings, mark_repeats, F.col("event_id"), buckets=16)

    def run() -> None:
        lines = stream_lines(spark, inbox, files_per_trigger=1_000_000)
        ingest(lines, posting_rows, held, seen, ["event_id"], postings=postings, compact_every=2)

    third = F.ntile(3).over(Window.orderBy("day"))
    days = e.select("day").distinct().select("day", third.alias("third"))
    placed = e.join(F.broadcast(days), "day")  # one row per day
    for number in (1, 2, 3):
        placed.where(F.col("third") == number).select(line).write.mode("append").text(inbox)
        run()
        if number == 2:
            repeat_last_batch(spark, seen)
            run()
    return merge.read_table(spark, held).select("event_id", "previous_id")


# --- files ---------------------------------------------------------------------------------


@query(
    f"""WITH {ORDER_TEXT_CTE},
bad AS (SELECT file, count(*) FILTER (len(codes) > 0) AS b, count(*) AS a FROM txt GROUP BY 1),
named AS (SELECT file || ['-0-OriginalFile.mbi', '-1-PassedLines.mbi', '-2-RejectedLines.err', '-3-RejectedLines.mbi',
    '-4-allLines.err'][n + 1] AS out_file, row_no, file_row FROM splits
  UNION ALL SELECT file || t.ending, -1, 'IA,' || CASE t.k WHEN 0 THEN a WHEN 1 THEN a - b ELSE b END || ',TPA01,Orders Template,B7'
  FROM bad, (VALUES ('-0-OriginalFile.mbi', 0), ('-1-PassedLines.mbi', 1), ('-2-RejectedLines.err', 2), ('-3-RejectedLines.mbi', 2),
    ('-4-allLines.err', 0)) t(ending, k))
SELECT out_file, count(*) AS line_count, sum(length(file_row) + 1)::BIGINT AS size,
  sha256(string_agg(file_row, chr(10) ORDER BY row_no) || chr(10)) AS digest FROM named GROUP BY 1"""
)
def named_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The outputs of the checked files, one file each under its exact name, as their bytes are on disk."""
    outputs = check.deliver(stored_orders(spark, sf_dir), "A", F.lit("B7"))
    path = scratch_path(spark, "outbox")
    sinks.write_named_files(outputs, path)
    name = F.element_at(F.split("path", "/"), -1)
    return sinks.file_digests(spark, path).select(name.alias("out_file"), "line_count", "size", "digest")


def damage_file(spark: SparkSession, path: str) -> None:
    """Cut a file to half its bytes, as a broken transfer leaves it."""
    content = spark.read.format("binaryFile").load(path).first()["content"]
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    stream.write(bytearray(content[: len(content) // 2]))
    stream.close()


@query(
    """SELECT replace(o_orderpriority, ' ', '_') AS file, CASE WHEN o_orderpriority <> '1-URGENT' THEN count(*) END AS line_count,
  CASE WHEN o_orderpriority = '1-URGENT' THEN 'Could not process this file:' || chr(10) || '1-URGENT' || chr(10) ||
    'Unexpected end of input stream' END AS side_text FROM orders GROUP BY o_orderpriority"""
)
def broken_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compressed files of which one is broken: the lines of the others, and the quarantine's text of that one."""
    inbox, held = scratch_path(spark, "mixed"), scratch_path(spark, "broken")
    o = table(spark, sf_dir, "orders").select(
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("out_file"),
        F.concat_ws(",", F.lit("OR"), F.col("o_orderkey").cast("string"), F.col("o_totalprice").cast("string")).alias("value"),
    )
    o.repartition("out_file").write.partitionBy("out_file").option("compression", "gzip").text(inbox)
    damage_file(spark, glob(spark, f"{inbox}/out_file=1-URGENT/part-*")[0])
    lines, failed = L.read_good_lines(spark, [inbox], ["*.gz"], recursive=True)
    sinks.write_quarantine(failed.withColumn("file", F.regexp_extract("file", "/out_file=([^/]*)/", 1)), held)
    none = lambda kind: F.lit(None).cast(kind)
    read = L.as_logical_files(lines).groupBy("file").agg(F.count("*").alias("line_count"), none("string").alias("side_text"))
    return read.unionByName(spark.read.parquet(held).select("file", none("bigint").alias("line_count"), "side_text"))


# --- platform C ----------------------------------------------------------------------------


def mixed_c_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per region: a version line, and per supplier a look-up with a row below it, a member without plans with a
    row below it, and a row of no known type."""
    home = (
        table(spark, sf_dir, "supplier")
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    key = F.col("s_suppkey").cast("string")
    layouts = platform_c_layouts()

    def line(code: str, values: dict) -> F.Column:
        cells = [values.get(n, F.lit("")) for n in layouts[code].names]
        return delimited_line(F.lit(code), *[F.lit(c) if isinstance(c, str) else c for c in cells])

    member = {
        "SSN": key, "ClientName": F.col("r_name"), "FirstName": "Jo", "LastName": F.col("s_name"), "Address1": "1 Main St",
        "City": "Town", "StateOrProvince": "IL", "PostalCode": "62701",
        "ClientDivisionName": F.when(F.col("s_suppkey") % 5 == 0, "NOWHERE").otherwise(F.col("n_name")),
    }
    entries = [
        line("[QBLOOKUP]", {"ClientName": F.col("r_name"), "SSN": key, "QualifyingEventDate": "1/15/2024"}),
        line("[MEMBERUSERDEFINEDFIELD]", {"UserDefinedFieldName": "size", "UserDefinedFieldValue": 'a "big", one'}),
        line("[NPM]", member),
        line("[NPMHIPAADATA]", {"CoverageLevel": "EE", "OriginalEnrollmentDate": "01/01/2020", "PlanName": "P1"}),
        F.concat(F.lit("[XYZ],"), key),
    ]
    body = F.posexplode(F.array(*entries)).alias("n", "line")
    file = F.concat(F.lit("region_"), F.col("r_regionkey").cast("string")).alias("file")
    rows = home.select(file, "s_suppkey", body).select(
        "file", (F.col("s_suppkey") * 5 + F.col("n") + 2).alias("source_row_no"), "line"
    )
    version = F.when(F.col("r_regionkey") == 4, "9.9").otherwise("1.2")
    heads = table(spark, sf_dir, "region").select(
        file, F.lit(1).cast("bigint").alias("source_row_no"), F.concat(F.lit("[VERSION],"), version).alias("line")
    )
    return heads.unionByName(rows)


@query(
    """WITH s AS (SELECT s_suppkey AS k, CAST(s_suppkey AS VARCHAR) AS ssn, n_name, r_name, r_regionkey, s_suppkey % 2 = 0 AS held,
    s_suppkey % 5 = 0 AS lost FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
r AS (
  SELECT r_regionkey, 1 AS no, '[VERSION]' AS row_type, CASE WHEN r_regionkey = 4 THEN 'VersionNumber' ELSE '' END AS error_code,
    CASE WHEN r_regionkey = 4 THEN 'VersionNumber must always be one of 1.0|1.1|1.2|1. ''9.9'' is not valid' ELSE '' END AS error_message FROM region
  UNION ALL SELECT r_regionkey, k * 5 + 2, '[QBLOOKUP]', CASE WHEN held THEN '' ELSE 'QB Not Found' END,
    CASE WHEN held THEN '' ELSE 'QB with SSN ''' || ssn || ''' not found' END FROM s
  UNION ALL SELECT r_regionkey, k * 5 + 3, '[MEMBERUSERDEFINEDFIELD]', CASE WHEN held THEN '' ELSE 'No Current QB, SPM, NPM' END,
    CASE WHEN held THEN '' ELSE 'Could Not Process this Record Type ''[MEMBERUSERDEFINEDFIELD]'' as no Valid QB, SPM, NPM is referenced above' END FROM s
  UNION ALL SELECT r_regionkey, k * 5 + 4, '[NPM]', CASE WHEN lost THEN 'ClientAndDivision;ClientDivisionId' ELSE '' END,
    CASE WHEN lost THEN 'The Division Name ''NOWHERE'' could not be found for Client ''' || r_name ||
      ''';The Client and Division ID cannot be blank' ELSE '' END FROM s
  UNION ALL SELECT r_regionkey, k * 5 + 5, '[NPMHIPAADATA]', CASE WHEN lost THEN 'No Current NPM' ELSE '' END,
    CASE WHEN lost THEN 'Could Not Process this Record Type ''[NPMHIPAADATA]'' as no Valid NPM is referenced above' ELSE '' END FROM s
  UNION ALL SELECT r_regionkey, k * 5 + 6, '[XYZ]', 'Invalid Record Type', 'Record Type ''[XYZ]'' is invalid' FROM s)
SELECT 'region_' || r_regionkey AS file, no AS source_row_no, row_type, error_code, error_message FROM r"""
)
def c_check_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row of mixed platform C files with the whole text of its errors."""
    masters = c_masters(spark, sf_dir)
    members = {**masters.members, "QB": masters.members["QB"].where("member_id % 2 = 0")}
    rows = check.check_c(mixed_c_lines(spark, sf_dir), replace(masters, members=members))
    texts = F.array_join(F.transform(F.split("error_message", ";"), lambda t: F.trim(t)), ";")
    return rows.select("file", "source_row_no", "row_type", "error_code", texts.alias("error_message"))


@query(
    """WITH c AS (SELECT *, c_nationkey = 7 AS again, CASE c_custkey % 3 WHEN 0 THEN '15028' WHEN 1 THEN '777' ELSE '' END AS code FROM customer)
SELECT 'res_' || c_nationkey || '.csv' AS result_file, c_custkey + 1 AS row_num, 'sent_' || c_nationkey || '.csv' AS sent_file,
  '[QBLOOKUP]' AS row_type, 'Client, ' || c_mktsegment AS client, CAST(c_custkey AS VARCHAR) AS ssn,
  CASE WHEN again THEN '777' ELSE nullif(code, '') END AS error_code,
  CASE WHEN again OR code = '777' THEN 'own text' WHEN code = '15028' THEN 'Employer must be active' END AS error_message FROM c
UNION ALL SELECT DISTINCT 'res_' || c_nationkey || '.csv', 0, 'sent_' || c_nationkey || '.csv', '[VERSION]', NULL, NULL, NULL, NULL FROM customer"""
)
def c_result_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Platform C result files loaded and stored by file and row number; one file comes again with other codes."""
    c = table(spark, sf_dir, "customer")
    nation = F.col("c_nationkey").cast("string")
    file = F.concat(F.lit("out/res_"), nation, F.lit(".csv")).alias("file")

    def loaded(rows: DataFrame, code: F.Column) -> DataFrame:
        own = F.when(code == "777", "own text").otherwise("")
        client = F.concat(F.lit("Client, "), F.col("c_mktsegment"))
        line = delimited_line(F.lit("[QBLOOKUP]"), client, F.col("c_custkey").cast("string"), F.lit("1/15/2024"), code, own)
        body = rows.select(
            file, (F.col("c_custkey") + 1).alias("source_row_no"), F.concat(line, F.lit(reconcile.SPARE_COMMAS)).alias("line")
        )
        head = F.concat(F.lit("[VERSION],sent_"), nation, F.lit(".csv,1,bad")).alias("line")
        heads = rows.select(file, F.lit(0).cast("bigint").alias("source_row_no"), head).distinct()
        return reconcile.load_results_c(heads.unionByName(body), error_catalogue(spark, sf_dir))

    path = scratch_path(spark, "c-results")
    code = F.when(F.col("c_custkey") % 3 == 0, "15028").when(F.col("c_custkey") % 3 == 1, "777").otherwise("")
    reconcile.store_results(spark, path, loaded(c, code))
    reconcile.store_results(spark, path, loaded(c.where("c_nationkey = 7"), F.lit("777")))
    return merge.read_table(spark, path).select(
        "result_file", "row_num", "sent_file", "row_type", F.col("ClientName").alias("client"), F.col("SSN").alias("ssn"),
        "error_code", "error_message",
    )


# --- SQL functions -------------------------------------------------------------------------


@query(
    """WITH bad AS (SELECT o_custkey % 50 AS log, count(*) FILTER (o_orderstatus = 'P') AS n FROM orders GROUP BY 1)
SELECT o_orderkey AS order_key, CAST(i AS INTEGER) AS id, string_split(o_orderpriority, '-')[i] AS val, 'RB' AS row_type,
  CAST(o_custkey AS VARCHAR) AS employee_id, CASE WHEN o_orderstatus = 'F' THEN '0' ELSE '777' END AS error_code, CAST(NULL AS VARCHAR) AS dummy,
  o_orderstatus <> 'F' AS is_error, n AS error_count, regexp_replace(o_orderpriority, '[^0-9A-Z]', '', 'g') AS name_key,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price, 'id' || o_orderkey AS file_id
FROM orders JOIN bad ON log = o_custkey % 50, range(1, 3) r(i)"""
)
def sql_functions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query in SQL alone, with scalar functions, one that reads the table of tasks, and table functions in LATERAL."""
    o = table(spark, sf_dir, "orders")
    status = F.when(F.col("o_orderstatus") == "P", "ERROR").otherwise("Completed")
    o.select((F.col("o_custkey") % 50).alias("file_log_id"), status.alias("processing_task_outcome")).createOrReplaceTempView("logged_tasks")
    code = F.when(F.col("o_orderstatus") == "F", "0").otherwise("777")
    line = F.concat_ws(",", F.lit('"RB"'), F.lit("EMP"), F.col("o_custkey").cast("string"), F.lit("P,20240101,20241231"), code, F.lit('"a text"'))
    o.select(
        F.col("o_orderkey").alias("order_key"), (F.col("o_custkey") % 50).alias("log_id"), F.col("o_orderpriority").alias("names"),
        line.alias("line"), F.format_number(money("o_totalprice"), 2).alias("amount"),
    ).createOrReplaceTempView("result_lines")
    register_functions(spark, "logged_tasks")
    return spark.sql("""
        SELECT l.order_key, s.id, s.val, r.row_type, r.employee_id, r.error_code, r.dummy, is_error_code(r.error_code) AS is_error,
          file_error_count(l.log_id) AS error_count, match_key(l.names) AS name_key, money_or_zero(l.amount) AS price,
          file_id_from_name(concat('in/x--id', l.order_key, '.mbi')) AS file_id
        FROM result_lines l, LATERAL csv_split(l.names, '-') s, LATERAL split_error_row(l.line) r""")
