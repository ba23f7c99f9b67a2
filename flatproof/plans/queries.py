"""The registered queries: every operator on the supplied tables, with the SQL that checks it.

A query calls the library on rows that Spark derives from whole tables; the SQL states the same
result directly. Both name their columns alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..operators import classify as K
from ..operators import commission as C
from ..operators import export, lineage, lookups, merge, results, rules
from ..operators.parents import last_parent, time_chunk
from ..operators.parse import delimited_line, parse_record, split_result_rows, split_to_rows
from ..session import scratch_path, spread, stage
from ..sources.lines import as_logical_files, latest_of_pattern, number_lines, read_lines
from ..sources.sinks import write_lines
from ..spec import record
from ..streaming.ingest import ingest, stream_lines

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def money(column: str):
    return F.col(column).cast(V.MONEY)


# --- rule engine ---------------------------------------------------------------------------

ORDER_SPEC = record(
    "OR",
    [
        "OrderKey:int[1..4]",
        "CustKey:int*",
        "Status:text[1..1]{F|O}",
        "TotalPrice:decimal<0..400000>",
        "OrderDate:isodate*",
        "Priority:alnumdash[3..15]",
        "Origin:const{IMPORT}",
        "Kind:text=STANDARD",
        "Rush:yesno",
        "Contact:email",
        "Reference:ssn[9..9]",
    ],
)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as delimited lines, in the varied and partly faulty forms clients send."""
    o = spread(table(spark, sf_dir, "orders"))
    date = (
        F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "MM/dd/yyyy"))
        .when(F.col("o_orderstatus") == "O", F.date_format("o_orderdate", "yyyyMMdd"))
        .when(F.col("o_custkey") % 7 == 0, "2024-13-01")
        .otherwise(F.date_format("o_orderdate", "dd-MMM-yyyy"))
    )
    price = F.format_number(money("o_totalprice"), 2)
    rush = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Yes")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "maybe")
        .otherwise("no")
    )
    at = F.when(F.col("o_custkey") % 11 == 0, "").otherwise("@")
    # Only the price holds commas.
    line = F.concat_ws(
        ",",
        F.lit("OR"),
        F.concat(F.lit(" "), F.col("o_orderkey").cast("string")),
        F.col("o_custkey").cast("string"),
        F.col("o_orderstatus"),
        T.csv_quote(price),
        date,
        F.col("o_orderpriority"),
        F.when(F.col("o_orderstatus") == "F", "client").otherwise(""),
        F.when(F.col("o_orderstatus") == "O", "special").otherwise(""),
        rush,
        F.concat(F.lit("c"), F.col("o_custkey").cast("string"), at, F.lit("example.org")),
        F.concat(F.lit("1-"), F.col("o_orderkey").cast("string")),
    )
    return o.select(
        F.concat(F.lit("orders_"), F.left("o_orderpriority", F.lit(1)), F.lit(".csv")).alias("file"),
        F.col("o_orderkey").alias("source_row_no"),
        line.alias("line"),
    )


def checked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(parse_record(order_lines(spark, sf_dir), ORDER_SPEC), ORDER_SPEC)


# The cleaned values and broken rules of each order, stated directly.
ORDER_CTE = r"""
src AS (
  SELECT *, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
    CASE WHEN o_orderstatus = 'P' AND o_custkey % 7 = 0 THEN '2024-13-01'
         ELSE strftime(o_orderdate, '%Y%m%d') END AS odate,
    CASE WHEN o_orderpriority = '1-URGENT' THEN 'Yes' WHEN o_orderpriority = '3-MEDIUM' THEN 'maybe'
         ELSE 'no' END AS rush,
    'c' || o_custkey || CASE WHEN o_custkey % 11 = 0 THEN '' ELSE '@' END || 'example.org' AS contact,
    CASE WHEN length('1' || o_orderkey) < 9 THEN lpad('1' || o_orderkey, 9, '0')
         ELSE '1' || o_orderkey END AS reference
  FROM orders),
chk AS (
  SELECT *,
    'orders_' || left(o_orderpriority, 1) || '.csv' AS file,
    [x FOR x IN [
      CASE WHEN length(CAST(o_orderkey AS VARCHAR)) > 4 THEN 'OrderKey' END,
      CASE WHEN o_orderstatus NOT IN ('F','O') THEN 'Status' END,
      CASE WHEN price > 400000 THEN 'TotalPrice' END,
      CASE WHEN odate = '2024-13-01' THEN 'OrderDate' END,
      CASE WHEN rush = 'maybe' THEN 'Rush' END,
      CASE WHEN contact NOT LIKE '%@%' THEN 'Contact' END,
      CASE WHEN length(reference) > 9 THEN 'Reference' END] IF x IS NOT NULL] AS codes,
    'OR,' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',' || price || ',' || odate || ',' ||
      replace(o_orderpriority, ' ', '') || ',' ||
      CASE WHEN o_orderstatus = 'F' THEN 'IMPORT' ELSE '' END || ',' ||
      CASE WHEN o_orderstatus = 'O' THEN 'special' ELSE 'STANDARD' END || ',' || rush || ',' || contact || ',' ||
      reference AS data_row
  FROM src)
"""


# The lines as they came, the text of each broken rule, and the lines of the five splits.
ORDER_TEXT_CTE = ORDER_CTE + r""",
texts AS (
  SELECT *, format('{:,}', CAST(floor(price) AS BIGINT)) || '.' ||
    lpad(CAST(CAST((price - floor(price)) * 100 AS BIGINT) AS VARCHAR), 2, '0') AS shown FROM chk),
worded AS (
  SELECT *, [c || ' ' || CASE c WHEN 'OrderKey' THEN 'must be maximum 4 characters long. '' ' || o_orderkey
      WHEN 'Status' THEN 'must always be one of F|O. ''' || o_orderstatus
      WHEN 'TotalPrice' THEN 'must be a number with a value less than 400000. ''' || shown
      WHEN 'OrderDate' THEN 'must be in format YYYYMMDD. ''' || odate WHEN 'Rush' THEN 'must be either Yes or No. ''maybe'
      WHEN 'Contact' THEN 'must be a valid Email. ''' || contact ELSE 'must be maximum 9 characters long. ''1-' || o_orderkey END
      || ''' is not valid' FOR c IN codes] AS messages,
    'OR, ' || o_orderkey || ',' || o_custkey || ',' || o_orderstatus || ',"' || shown || '",' ||
      CASE WHEN o_orderstatus = 'F' THEN strftime(o_orderdate, '%m/%d/%Y') WHEN o_orderstatus = 'O' THEN strftime(o_orderdate, '%Y%m%d')
      WHEN o_custkey % 7 = 0 THEN '2024-13-01' ELSE strftime(o_orderdate, '%d-%b-%Y') END || ',' || o_orderpriority || ',' ||
      CASE WHEN o_orderstatus = 'F' THEN 'client' ELSE '' END || ',' || CASE WHEN o_orderstatus = 'O' THEN 'special' ELSE '' END || ',' ||
      rush || ',' || contact || ',1-' || o_orderkey AS org_row FROM texts),
txt AS (SELECT *, data_row || ',Warning: ' || array_to_string(messages, ';') AS warned FROM worded),
splits AS (
  SELECT file, 'original_file' AS split, o_orderkey AS row_no, org_row AS file_row, 0 AS n FROM txt
  UNION ALL SELECT file, 'passed_lines', o_orderkey, data_row, 1 FROM txt WHERE len(codes) = 0
  UNION ALL SELECT file, 'rejected_lines_with_errors', o_orderkey, warned, 2 FROM txt WHERE len(codes) > 0
  UNION ALL SELECT file, 'rejected_lines', o_orderkey, data_row, 3 FROM txt WHERE len(codes) > 0
  UNION ALL SELECT file, 'all_lines_with_errors', o_orderkey,
    CASE WHEN len(codes) > 0 THEN warned ELSE data_row || ',OK' END, 4 FROM txt)
"""


@query(
    f"""WITH {ORDER_CTE}
SELECT u.code AS error_code, count(*) AS row_count FROM chk, unnest(codes) AS u(code) GROUP BY 1"""
)
def rule_engine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = checked_orders(spark, sf_dir).select(F.explode("errors.code").alias("error_code"))
    return found.groupBy("error_code").agg(F.count("*").alias("row_count"))


@query(
    f"""WITH {ORDER_CTE}
SELECT o_orderkey AS order_key, data_row, array_to_string(codes, ';') AS error_code FROM chk"""
)
def rule_engine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = rules.flatten_errors(checked_orders(spark, sf_dir))
    return flat.select(F.col("source_row_no").alias("order_key"), "data_row", "error_code")


@query(
    f"""WITH {ORDER_CTE}
SELECT file, count(*) AS row_count, count(*) FILTER (len(codes) > 0) AS error_rows,
  CASE WHEN count(*) FILTER (len(codes) > 0) > 0 THEN 'PartialFail' ELSE 'Ok' END AS outcome,
  CASE WHEN count(*) FILTER (len(codes) > 0) > 0 THEN '300' ELSE '200' END AS outcome_code
FROM chk GROUP BY 1"""
)
def file_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.file_outcomes(checked_orders(spark, sf_dir))


@query(
    f"""WITH {ORDER_TEXT_CTE}
SELECT file, o_orderkey AS row_no, o_orderkey || ': ' || codes[len(codes)] || ' : ' || messages[len(messages)] AS report
FROM txt WHERE len(codes) > 0"""
)
def row_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole report of each row with errors."""
    return rules.row_reports(checked_orders(spark, sf_dir)).select("file", F.col("source_row_no").alias("row_no"), "report")


@query(
    """SELECT c_custkey AS cust_key, c_name || ', "' || c_mktsegment || '"' AS label,
  CAST(c_nationkey AS BIGINT) AS nation_key, CAST(c_acctbal AS DECIMAL(18,2)) AS balance,
  c_acctbal >= 0 AS in_credit, DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER) AS since,
  'CU,' || c_custkey || ',"' || c_name || ', ""' || c_mktsegment || '""' || '",' || c_nationkey || ',' ||
    CAST(c_acctbal AS DECIMAL(18,2)) || ',' || CASE WHEN c_acctbal >= 0 THEN '1' ELSE '0' END || ',' ||
    strftime(DATE '1992-01-01' + CAST(c_custkey % 1000 AS INTEGER), '%m/%d/%Y') AS data_row
FROM customer"""
)
def line_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = record(
        "CU",
        ["CustKey:int*", "Label:text", "NationKey:int", "Balance:money", "InCredit:flag", "Since:usdate"],
    )
    c = table(spark, sf_dir, "customer")
    since = F.date_add(F.lit("1992-01-01").cast("date"), (F.col("c_custkey") % 1000).cast("int"))
    line = delimited_line(
        F.lit("CU"),
        F.col("c_custkey").cast("string"),
        F.concat(F.col("c_name"), F.lit(', "'), F.col("c_mktsegment"), F.lit('"')),
        F.col("c_nationkey").cast("string"),
        F.concat(F.lit(" "), money("c_acctbal").cast("string")),
        F.when(F.col("c_acctbal") >= 0, "yes").otherwise("F"),
        F.date_format(since, "M/d/yyyy"),
    )
    rows = rules.apply_rules(parse_record(c.select(line.alias("line")), spec), spec, rules.RuleOptions("C"))
    return rules.typed(rows, spec).select(
        F.col("CustKey").alias("cust_key"), F.col("Label").alias("label"), F.col("NationKey").alias("nation_key"),
        F.col("Balance").alias("balance"), F.col("InCredit").alias("in_credit"), F.col("Since").alias("since"),
        "data_row",
    )


# --- classification ------------------------------------------------------------------------


@query(
    """WITH codes(event_type, record_type) AS (VALUES ('signup', 'Demographics'), ('purchase', 'EmployeeDeposit'),
  ('click', 'EmployeeHrInfo'), ('error', 'ResultsDemographics'))
SELECT 'user_' || user_id AS file, coalesce(c.record_type, 'Unknown') AS record_type, count(*) AS row_count,
  min(event_id) AS first_row, max(event_id) AS last_row
FROM events e LEFT JOIN codes c USING (event_type) GROUP BY 1, 2"""
)
def type_dispatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    codes = {"signup": "IB", "purchase": "IH", "click": "IZ", "view": "IY", "error": "RB"}
    code = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])[F.col("event_type")]
    lines = e.select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("file"),
        F.col("event_id").alias("source_row_no"),
        delimited_line(code, F.col("props"), F.col("value").cast("string")).alias("line"),
    )
    return K.record_type_rows(lines)


DOCUMENT_LINES = """lines AS (
  SELECT source || '-' || (doc_id // 100) AS file, doc_id,
    CASE lang WHEN 'de' THEN '[VERSION],1.' || (doc_id % 4) WHEN 'es' THEN '[SPM],' || text
              WHEN 'fr' THEN '[QB],' || text ELSE 'IB,' || text END AS line, lang
  FROM documents)"""


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as the lines of files; whole texts, one line each."""
    d = table(spark, sf_dir, "documents")
    line = (
        F.when(F.col("lang") == "de", F.concat(F.lit("[VERSION],1."), (F.col("doc_id") % 4).cast("string")))
        .when(F.col("lang") == "es", F.concat(F.lit("[SPM],"), F.col("text")))
        .when(F.col("lang") == "fr", F.concat(F.lit("[QB],"), F.col("text")))
        .otherwise(F.concat(F.lit("IB,"), F.col("text")))
    )
    return d.select(
        F.concat_ws("-", "source", F.floor(F.col("doc_id") / 100).cast("string")).alias("file"),
        F.col("doc_id").alias("source_row_no"),
        line.alias("line"),
        F.lit(0).alias("size"),
    )


@query(
    f"""WITH {DOCUMENT_LINES},
facts AS (SELECT file, count(*) AS line_count, arg_min(lang = 'de', doc_id) AS is_c,
  bool_or(line LIKE 'IB,%') AS has_a, bool_or(lang = 'fr') AS qb, bool_or(lang = 'es') AS spm,
  arg_min(doc_id % 4, doc_id) FILTER (lang = 'de') AS v FROM lines GROUP BY 1)
SELECT file, line_count, CASE WHEN is_c THEN 'C' WHEN has_a THEN 'A' ELSE 'Unknown' END AS platform,
  is_c AND qb AS has_qb, is_c AND spm AS has_spm, false AS has_npm,
  CASE WHEN is_c AND v < 3 THEN '1.' || v END AS version FROM facts"""
)
def file_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    return K.classify_files(document_lines(spark, sf_dir))


@query(
    """WITH rows_ AS (
  SELECT 'nation_' || c_nationkey AS file, c_custkey,
    CASE c_custkey % 3 WHEN 0 THEN 'IB' WHEN 1 THEN 'IC' ELSE 'IZ' END AS code,
    CASE c_custkey % 3 WHEN 0 THEN 19 + 5 * (c_nationkey % 2) WHEN 1 THEN 14 + (c_nationkey % 4) ELSE 7 END
      + CASE WHEN c_acctbal < -900 THEN 1 ELSE 0 END AS cols FROM customer),
first_rows AS (SELECT file, code, arg_min(cols, c_custkey) AS columns FROM rows_ GROUP BY 1, 2),
typed AS (SELECT *, CASE WHEN code = 'IB' AND columns = 19 THEN 'Old' WHEN code = 'IB' AND columns = 24 THEN 'New'
    WHEN code = 'IC' AND columns = 14 THEN 'Old' WHEN code = 'IC' AND columns = 15 THEN 'New'
    WHEN code = 'IC' AND columns = 16 THEN 'SegmentedFunding' WHEN code = 'IZ' AND columns = 7 THEN 'New' END
    AS header_type FROM first_rows)
SELECT file, code, CAST(columns AS INTEGER) AS columns, header_type, header_type IS NOT NULL AS fits FROM typed"""
)
def layout_detect(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    kind = F.col("c_custkey") % 3
    width = (
        F.when(kind == 0, 19 + 5 * (F.col("c_nationkey") % 2)).when(kind == 1, 14 + F.col("c_nationkey") % 4).otherwise(7)
        + F.when(F.col("c_acctbal") < -900, 1).otherwise(0)
    )
    code = F.when(kind == 0, "IB").when(kind == 1, "IC").otherwise("IZ")
    line = F.concat(code, F.lit(',"x,y"'), F.repeat(F.lit(","), width - 2))
    lines = c.select(
        F.concat(F.lit("nation_"), F.col("c_nationkey").cast("string")).alias("file"),
        F.col("c_custkey").alias("source_row_no"),
        line.alias("line"),
    )
    return K.header_types(lines)


@query(
    r"""WITH named AS (
  SELECT page_id, CAST(length(html) AS BIGINT) AS size,
    replace(replace(split_part(split_part(split_part(url, '//', 2), '?', 1), '#', 1), '/', '--'), '.html', '') || '.csv' AS name,
    CASE page_id % 3 WHEN 0 THEN 'A' WHEN 1 THEN 'C' ELSE 'Unknown' END AS platform,
    CASE page_id % 2 WHEN 0 THEN 'Ok' ELSE 'PartialFail' END AS outcome FROM pages),
bare AS (SELECT *, left(name, length(name) - 4) AS stem,
    name LIKE '%spam%' AS is_test_like, contains(lower(name), 'test') AS is_test FROM named)
SELECT page_id, split_part(stem, '--', 1) AS stripped,
  CASE WHEN strpos(stem, '--') > 1 THEN trim(substr(stem, strpos(stem, '--') + 2)) ELSE '' END AS file_id,
  CASE WHEN len(string_split(name, '--')) >= 3 THEN
    CASE split_part(name, '--', 2) WHEN '1' THEN 'Own' WHEN '2' THEN 'Old' WHEN '3' THEN 'New' WHEN '5' THEN 'NoChange'
    ELSE 'NotApplicable' END ELSE 'NotApplicable' END AS header_type,
  CASE WHEN is_test THEN 'TEST_' ELSE '' END ||
    CASE WHEN size <= 100 THEN 'EMPTY_' || trim(replace(replace(name, '--', '_'), '-', '_')) ELSE
    'client_' || (page_id % 5) || '_IB_' || CASE platform WHEN 'A' THEN 'AL' WHEN 'C' THEN 'CO' ELSE 'UNKNOWN' END ||
    '_20240115.csv' END AS uniform_name,
  lower(platform) || '/' || CASE WHEN size <= 100 THEN 'empty' WHEN platform = 'Unknown' THEN 'holding'
    WHEN is_test THEN 'test' WHEN outcome = 'Ok' THEN 'passed' ELSE 'rejects' END AS destination
FROM bare"""
)
def file_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    path = F.substring_index(F.substring_index(F.element_at(F.split("url", "//"), 2), "?", 1), "#", 1)
    name = F.concat(F.replace(F.replace(path, F.lit("/"), F.lit("--")), F.lit(".html"), F.lit("")), F.lit(".csv"))
    files = p.select(
        "page_id",
        name.alias("name"),
        F.length("html").cast("bigint").alias("size"),
        F.when(F.col("page_id") % 3 == 0, "A").when(F.col("page_id") % 3 == 1, "C").otherwise("Unknown").alias("platform"),
        F.when(F.col("page_id") % 2 == 0, "Ok").otherwise("PartialFail").alias("outcome"),
        F.concat(F.lit("client "), (F.col("page_id") % 5).cast("string")).alias("client"),
    )
    n, size = F.col("name"), F.col("size")
    day = F.lit("2024-01-15").cast("date")
    return files.select(
        "page_id",
        K.strip_file_id(n).alias("stripped"),
        K.file_id_from_name(n).alias("file_id"),
        K.header_type_from_name(n).alias("header_type"),
        K.uniform_name(n, F.col("platform"), F.col("client"), F.lit("[IB]"), day, size).alias("uniform_name"),
        K.destination(F.col("platform"), F.col("outcome"), K.is_test_file(n), K.is_empty_file(size)).alias("destination"),
    )


@query(
    f"""WITH {DOCUMENT_LINES},
c_files AS (SELECT file, arg_min(lang = 'de', doc_id) AS is_c FROM lines GROUP BY 1),
parts AS (SELECT file, doc_id, is_c, lang, string_split(line, ',') AS p FROM lines JOIN c_files USING (file)),
hits AS (SELECT file, doc_id, p, CASE WHEN is_c THEN CASE lang WHEN 'es' THEN 'SPM' WHEN 'fr' THEN 'QB' END
    WHEN lang = 'en' THEN 'IB' END AS kind FROM parts),
named AS (SELECT file, doc_id, kind, CASE WHEN kind <> 'IB' THEN trim(p[2])
    WHEN upper(trim(p[3])) LIKE 'BEN%' THEN trim(p[3]) ELSE 'UNKNOWN' END AS client FROM hits)
SELECT file, arg_min(kind, doc_id) FILTER (kind IS NOT NULL) AS record_type,
  arg_min(client, doc_id) FILTER (kind IS NOT NULL) AS client FROM named GROUP BY 1"""
)
def naming_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = document_lines(spark, sf_dir)
    facts = K.classify_files(lines).select("file", "platform")
    return K.naming_facts(lines.join(facts, "file")).select("file", "record_type", "client")


# --- scalar functions ----------------------------------------------------------------------


@query(
    r"""SELECT p_partkey AS part_key, regexp_replace(p_brand, '[^0-9]', '', 'g') AS digits,
  regexp_replace(p_name || '-' || p_brand, '[^a-zA-Z0-9\s]', '', 'g') AS alnum,
  regexp_replace(p_name || '-' || p_brand, '[^a-zA-Z0-9\-]', '', 'g') AS alnum_dash,
  regexp_replace(p_name || '-' || p_brand, '[^a-zA-Z]', '', 'g') AS alpha,
  regexp_replace(p_name || '-' || p_brand, '[^a-zA-Z\-]', '', 'g') AS alpha_dash,
  regexp_replace(p_name || '-' || p_brand, '[^0-9\-]', '', 'g') AS num_dash,
  left(regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '[^0-9]', '', 'g'), 4) AS zip,
  right(regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR), '[^0-9]', '', 'g'), 4) AS phone,
  lpad(CAST(p_partkey AS VARCHAR), CAST(greatest(9, length(CAST(p_partkey AS VARCHAR))) AS INTEGER), '0') AS ssn,
  left(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 3) || '-' || substr(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 4, 2)
    || '-' || right(lpad(CAST(p_partkey AS VARCHAR), 9, '0'), 4) AS ssn_dashed,
  regexp_replace(upper(trim(p_name || ' & ' || p_type)), '[^A-Z0-9]', '', 'g') AS match_key,
  replace(trim(upper(p_name || ' & ' || p_type)), '&', '') AS display_name,
  replace(replace(replace(replace(p_name || '--' || p_brand || ' [x]', '--', '_'), ' ', '_'), '[', ''), ']', '') AS file_name,
  substr(p_name, 3, 4) AS mid, '"' || replace(p_name || '"', '"', '""') || '"' AS quoted
FROM part"""
)
def text_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    both = F.concat_ws("-", "p_name", "p_brand")
    key = F.col("p_partkey").cast("string")
    price = money("p_retailprice").cast("string")
    labelled = F.concat_ws(" & ", "p_name", "p_type")
    return p.select(
        F.col("p_partkey").alias("part_key"),
        T.digits(F.col("p_brand")).alias("digits"),
        T.keep(both, T.NOT_ALNUM_OR_SPACE).alias("alnum"),
        T.keep(both, T.NOT_ALNUM_OR_DASH).alias("alnum_dash"),
        T.keep(both, T.NOT_ALPHA).alias("alpha"),
        T.keep(both, T.NOT_ALPHA_OR_DASH).alias("alpha_dash"),
        T.keep(both, T.NOT_DIGIT_OR_DASH).alias("num_dash"),
        T.zip_code(price, 4).alias("zip"),
        T.phone(price, 4).alias("phone"),
        T.ssn_clean(key, 9).alias("ssn"),
        T.ssn_dashed(key).alias("ssn_dashed"),
        T.match_key(labelled).alias("match_key"),
        T.display_name(labelled).alias("display_name"),
        T.file_name_clean(F.concat(F.col("p_name"), F.lit("--"), F.col("p_brand"), F.lit(" [x]"))).alias("file_name"),
        T.mid(F.col("p_name"), 3, 4).alias("mid"),
        T.csv_quote(F.concat(F.col("p_name"), F.lit('"'))).alias("quoted"),
    )


@query(
    """SELECT o_orderkey AS order_key,
  CAST(o_orderdate AS DATE) AS d_iso, CAST(o_orderdate AS DATE) AS d_us, CAST(o_orderdate AS DATE) AS d_long,
  CAST(NULL AS DATE) AS d_bad, strftime(o_orderdate, '%Y%m%d') AS iso, strftime(o_orderdate, '%m/%d/%Y') AS us,
  CAST(o_totalprice AS DECIMAL(18,2)) AS price, CAST(0 AS DECIMAL(18,2)) AS bad_price,
  o_orderkey AS whole, CAST(NULL AS BIGINT) AS bad_whole, o_orderstatus = 'F' AS flag FROM orders"""
)
def date_and_number_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    text = lambda pattern: F.date_format("o_orderdate", pattern)
    day = F.col("o_orderdate").cast("timestamp")
    status = F.when(F.col("o_orderstatus") == "F", "t").when(F.col("o_orderstatus") == "O", "No").otherwise("?")
    return o.select(
        F.col("o_orderkey").alias("order_key"),
        V.to_date(text("yyyyMMdd HH:mm:ss")).alias("d_iso"),
        V.to_date(text("M/d/yyyy")).alias("d_us"),
        V.to_date(text("dd-MMM-yyyy")).alias("d_long"),
        V.to_date(F.concat(F.lit("x"), text("yyyyMMdd"))).alias("d_bad"),
        V.iso_date(day).alias("iso"),
        V.us_date(day).alias("us"),
        V.money_or_zero(F.format_number(money("o_totalprice"), 2)).alias("price"),
        V.money_or_zero(F.col("o_orderpriority")).alias("bad_price"),
        V.to_int(F.col("o_orderkey").cast("string")).alias("whole"),
        V.to_int(F.col("o_orderpriority")).alias("bad_whole"),
        V.to_bool(status).alias("flag"),
    )


@query(
    """SELECT p_partkey AS part_key, CAST(i AS INTEGER) AS id, parts[i] AS val
FROM (SELECT p_partkey, string_split(p_name || ' ' || p_brand, ' ') AS parts FROM part),
  unnest(range(1, len(parts) + 1)) AS r(i)"""
)
def split_rows_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("part_key"), F.concat_ws(" ", "p_name", "p_brand").alias("parts")
    )
    return split_to_rows(p, "parts", " ").select("part_key", "id", "val")


# --- look-ups ------------------------------------------------------------------------------


@query(
    """SELECT l_returnflag, p_partkey IS NOT NULL AS found, count(*) AS row_count,
  CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS amount
FROM lineitem LEFT JOIN (SELECT p_partkey FROM part WHERE p_size <= 25) ON l_partkey = p_partkey GROUP BY 1, 2"""
)
def existence_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = table(spark, sf_dir, "part").where("p_size <= 25")
    rows = lookups.exists(table(spark, sf_dir, "lineitem"), active, {"l_partkey": "p_partkey"}, "found")
    return rows.groupBy("l_returnflag", "found").agg(
        F.count("*").alias("row_count"), F.sum(money("l_extendedprice")).cast(V.MONEY).alias("amount")
    )


@query(
    """SELECT l_returnflag, count(*) AS row_count FROM lineitem
WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_size <= 25 AND p_partkey = l_partkey) GROUP BY 1"""
)
def missing_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    active = table(spark, sf_dir, "part").where("p_size <= 25")
    rows = lookups.missing(table(spark, sf_dir, "lineitem"), active, {"l_partkey": "p_partkey"})
    return rows.groupBy("l_returnflag").agg(F.count("*").alias("row_count"))


@query(
    """WITH rows_ AS (
  SELECT 'Brand#' || (l_suppkey % 25) AS er, CASE l_linenumber % 2 WHEN 0 THEN 'ECONOMY' ELSE 'SMALL' END AS acct,
    CASE WHEN l_returnflag = 'N' THEN '' ELSE 'P' || CAST(l_quantity AS INTEGER) END AS plan,
    CASE WHEN l_linestatus = 'O' THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS s,
    CASE WHEN l_linenumber = 7 THEN DATE '2023-12-31' ELSE DATE '2024-12-31' END AS e,
    DATE '2024-01-15' + CAST(l_partkey % 400 AS INTEGER) AS eff, l_returnflag FROM lineitem),
plans AS (SELECT DISTINCT p_brand AS er, p_type AS acct, 'P' || p_size AS plan,
    CASE WHEN p_size % 2 = 0 THEN DATE '2024-01-01' ELSE DATE '2024-02-01' END AS s, DATE '2024-12-31' AS e FROM part),
any_plan AS (SELECT DISTINCT er, acct, plan FROM plans UNION SELECT DISTINCT er, acct, '' FROM plans),
any_period AS (SELECT DISTINCT er, acct, plan, s, e FROM plans UNION SELECT DISTINCT er, acct, '', s, e FROM plans),
flagged AS (SELECT r.*, a.er IS NOT NULL AS has_plan, p.er IS NOT NULL AS has_period FROM rows_ r
  LEFT JOIN any_plan a ON r.er = a.er AND r.acct = a.acct AND r.plan = a.plan
  LEFT JOIN any_period p ON r.er = p.er AND r.acct = p.acct AND r.plan = p.plan AND r.s = p.s AND r.e = p.e)
SELECT l_returnflag, CASE WHEN NOT has_plan THEN 'no plan' WHEN NOT has_period THEN 'no period'
  WHEN eff > e THEN 'ended' WHEN s > e THEN 'period reversed' WHEN eff < s THEN 'not started' ELSE 'ok' END AS verdict,
  count(*) AS row_count FROM flagged GROUP BY 1, 2"""
)
def optional_key_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    eff = F.date_add(F.lit("2024-01-15").cast("date"), (F.col("l_partkey") % 400).cast("int"))
    rows = li.select(
        F.concat(F.lit("Brand#"), (F.col("l_suppkey") % 25).cast("string")).alias("EmployerId"),
        F.when(F.col("l_linenumber") % 2 == 0, "ECONOMY").otherwise("SMALL").alias("AccountTypeCode"),
        F.when(F.col("l_returnflag") == "N", "")
        .otherwise(F.concat(F.lit("P"), F.col("l_quantity").cast("int").cast("string")))
        .alias("PlanId"),
        F.when(F.col("l_linestatus") == "O", "20240101").otherwise("20240201").alias("PlanStartDate"),
        F.when(F.col("l_linenumber") == 7, "20231231").otherwise("20241231").alias("PlanEndDate"),
        F.date_format(eff, "yyyyMMdd").alias("EffectiveDate"),
        "l_returnflag",
    )
    start = F.when(F.col("p_size") % 2 == 0, "2024-01-01").otherwise("2024-02-01").cast("date")
    plans = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("EmployerId"),
        F.col("p_type").alias("AccountTypeCode"),
        F.concat(F.lit("P"), F.col("p_size").cast("string")).alias("PlanId"),
        start.alias("planstart"),
        F.lit("2024-12-31").cast("date").alias("planend"),
    )
    judged = lookups.with_plan_verdict(rows, plans, ["EmployerId", "AccountTypeCode"], ["EffectiveDate"])
    return judged.groupBy("l_returnflag", F.col("plan_verdict").alias("verdict")).agg(F.count("*").alias("row_count"))


@query(
    """SELECT p.user_id, count(*) AS purchases, count(*) FILTER (
    EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = p.user_id AND c.c_acctbal < 0)
    OR p.event_id > f.first_id) AS known
FROM events p LEFT JOIN (SELECT user_id, min(event_id) AS first_id FROM events WHERE event_type = 'signup' GROUP BY 1) f
  ON p.user_id = f.user_id
WHERE p.event_type = 'purchase' GROUP BY 1"""
)
def order_aware_existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    members = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    known = lookups.first_known(members, e.where("event_type = 'signup'"), ["user_id"], ["event_id"])
    purchases = e.where("event_type = 'purchase'")
    rows = lookups.exists_before(purchases, known, {"user_id": "user_id"}, ["event_id"], "is_known")
    return rows.groupBy("user_id").agg(F.count("*").alias("purchases"), F.count_if("is_known").alias("known"))


@query(
    """SELECT o_orderpriority, CASE WHEN l_shipdate < o_orderdate THEN 'before'
  WHEN l_shipdate > o_orderdate + INTERVAL 90 DAY THEN 'after' ELSE 'inside' END AS status, count(*) AS row_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2"""
)
def date_window_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_shipdate").cast("date").alias("shipped"))
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", F.col("o_orderdate").cast("date").alias("ordered")
    )
    joined = li.join(o, li["l_orderkey"] == o["o_orderkey"])
    status = lookups.period_status(F.col("shipped"), F.col("ordered"), F.date_add("ordered", 90))
    return joined.groupBy("o_orderpriority", status.alias("status")).agg(F.count("*").alias("row_count"))


@query(
    """WITH keyed AS (SELECT event_id, user_id, event_type, day(ts) % 10 AS slot, CAST(ts AS DATE) AS d FROM events),
past AS (SELECT user_id, event_type, slot, max(event_id) AS prev FROM keyed WHERE d < DATE '2024-01-16' GROUP BY 1, 2, 3),
now_ AS (SELECT * FROM keyed WHERE d >= DATE '2024-01-16'),
first_day AS (SELECT user_id, event_type, slot, min(d) AS d1 FROM now_ GROUP BY 1, 2, 3),
first_last AS (SELECT n.user_id, n.event_type, n.slot, f.d1, max(event_id) AS prev FROM now_ n JOIN first_day f
  ON n.user_id = f.user_id AND n.event_type = f.event_type AND n.slot = f.slot AND n.d = f.d1 GROUP BY 1, 2, 3, 4)
SELECT n.event_id, coalesce(p.prev, CASE WHEN f.d1 < n.d THEN f.prev END) AS previous_id FROM now_ n
LEFT JOIN past p ON n.user_id = p.user_id AND n.event_type = p.event_type AND n.slot = p.slot
LEFT JOIN first_last f ON n.user_id = f.user_id AND n.event_type = f.event_type AND n.slot = f.slot"""
)
def duplicate_posting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first half of the events is history, the second half a batch with one file per day."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", (F.dayofmonth("ts") % 10).alias("slot"), F.col("ts").cast("date").alias("day")
    )
    cut = F.lit("2024-01-16").cast("date")
    found = lookups.earlier_posting(
        e.where(F.col("day") >= cut), ["user_id", "event_type", "slot"], "day", "event_id",
        {"event_id": F.col("event_id")}, e.where(F.col("day") < cut), "event_id", name="previous",
    )
    return found.select("event_id", F.col("previous.event_id").alias("previous_id"))


@query(
    """SELECT event_id, max(CASE WHEN event_type = 'signup' THEN event_id END)
    OVER (PARTITION BY user_id ORDER BY ts) AS parent_id,
  event_type <> 'signup' AND max(CASE WHEN event_type = 'signup' THEN event_id END)
    OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS orphan FROM events"""
)
def parent_propagation(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "ts")
    is_parent = F.col("event_type") == "signup"
    placed = last_parent(
        e, is_parent, {"event_id": F.col("event_id")}, "user_id", "ts", time_chunk("ts", minutes=24 * 60)
    )
    return placed.select(
        "event_id",
        F.col("parent.event_id").alias("parent_id"),
        (~is_parent & F.col("parent").isNull()).alias("orphan"),
    )


@query(
    """WITH members AS (SELECT s_suppkey AS member_id, s_suppkey % 50 AS ssn, s_nationkey AS division, n_regionkey AS client
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
rows_ AS (SELECT c_custkey, c_custkey % 60 AS ssn, c_nationkey AS division, n_regionkey AS client
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
d AS (SELECT division, ssn, min(member_id) AS m FROM members GROUP BY 1, 2),
c AS (SELECT client, ssn, min(member_id) AS m FROM members GROUP BY 1, 2)
SELECT c_custkey AS cust_key, coalesce(d.m, c.m) AS member_id FROM rows_ r
LEFT JOIN d ON r.division = d.division AND r.ssn = d.ssn LEFT JOIN c ON r.client = c.client AND r.ssn = c.ssn"""
)
def fallback_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("client_division_id"), F.col("n_regionkey").alias("client_id")
    )
    dashed = T.ssn_dashed((F.col("s_suppkey") % 50).cast("string"))
    members = (
        table(spark, sf_dir, "supplier")
        .select(F.col("s_suppkey").alias("member_id"), F.col("s_nationkey").alias("client_division_id"), dashed.alias("ssn"))
        .join(nation, "client_division_id")
    )
    rows = (
        table(spark, sf_dir, "customer")
        .select("c_custkey", F.col("c_nationkey").alias("client_division_id"), (F.col("c_custkey") % 60).cast("string").alias("SSN"))
        .join(nation, "client_division_id")
    )
    found = lookups.member_by_ssn(rows, members, "member_id")
    return found.select(F.col("c_custkey").alias("cust_key"), "member_id")


@query(
    """WITH rows_ AS (SELECT c_custkey, CASE WHEN c_custkey % 13 = 0 THEN 'NOWHERE' ELSE r.r_name END AS client,
    n2.n_name AS division, c_mktsegment AS plan FROM customer
  JOIN nation n1 ON c_nationkey = n1.n_nationkey JOIN region r ON n1.n_regionkey = r.r_regionkey
  JOIN nation n2 ON n2.n_nationkey = (c_custkey % 25)),
plans AS (SELECT DISTINCT n_regionkey AS client_id, c_mktsegment AS plan FROM customer JOIN nation ON c_nationkey = n_nationkey
  WHERE c_acctbal > 9000),
links AS (SELECT DISTINCT c_nationkey AS division_id, n_regionkey AS client_id, c_mktsegment AS plan
  FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 9000)
SELECT CAST(rg.r_regionkey AS INTEGER) AS client_id, CAST(n.n_nationkey AS INTEGER) AS division_id,
  p.plan IS NOT NULL AS has_client_plan, l.plan IS NOT NULL AS has_division_plan, count(*) AS row_count
FROM rows_ x LEFT JOIN region rg ON rg.r_name = x.client
LEFT JOIN nation n ON n.n_name = x.division AND n.n_regionkey = rg.r_regionkey
LEFT JOIN plans p ON p.client_id = rg.r_regionkey AND p.plan = x.plan
LEFT JOIN links l ON l.division_id = n.n_nationkey AND l.client_id = rg.r_regionkey AND l.plan = x.plan
GROUP BY 1, 2, 3, 4"""
)
def client_division(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    customer = table(spark, sf_dir, "customer")
    clients = region.select(F.col("r_regionkey").alias("client_id"), F.col("r_name").alias("client_name"))
    divisions = nation.select(
        F.col("n_nationkey").alias("client_division_id"), F.col("n_regionkey").alias("client_id"),
        F.col("n_name").alias("division_name"),
    )
    held = customer.where("c_acctbal > 9000").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    plan_id = F.concat_ws("/", F.col("n_regionkey").cast("string"), "c_mktsegment")
    plans = held.select(
        plan_id.alias("client_plan_qb_id"), F.col("n_regionkey").alias("client_id"), F.col("c_mktsegment").alias("plan_name")
    ).distinct()
    links = held.select(F.col("n_nationkey").alias("client_division_id"), plan_id.alias("client_plan_qb_id")).distinct()
    home = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = home.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 13 == 0, "NOWHERE").otherwise(F.col("r_name")).alias("ClientName"),
        F.concat(F.lit("NATION_"), (F.col("c_custkey") % 25).cast("string")).alias("ClientDivisionName"),
        F.col("c_mktsegment").alias("PlanName"),
    )
    rows = lookups.client_plan(lookups.clients_by_name(named, clients, divisions), plans, links)
    return rows.groupBy(
        "client_id", F.col("client_division_id").alias("division_id"), "has_client_plan", "has_division_plan"
    ).agg(F.count("*").alias("row_count"))


@query(
    """SELECT c_name AS client_name, event_type AS division_name FROM customer
LEFT JOIN (SELECT DISTINCT user_id, event_type FROM events) ON user_id = c_custkey"""
)
def clients_with_divisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    clients = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("client_id"), F.col("c_name").alias("client_name"))
    divisions = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("client_id"), F.col("event_type").alias("division_name")
    ).distinct()
    return lookups.clients_with_divisions(clients, divisions).select("client_name", "division_name")


# --- merge and export ----------------------------------------------------------------------


@query(
    """WITH b AS (SELECT o_orderkey, 'NEW' AS o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)) + 1 AS price, 1 AS version
    FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey, 'NEWER', CAST(o_totalprice AS DECIMAL(18,2)) + 2, 2 FROM orders
    WHERE o_orderstatus = 'P' AND o_orderpriority = '1-URGENT'
  UNION ALL SELECT o_orderkey + 100000000, 'ADDED', CAST(o_totalprice AS DECIMAL(18,2)), 1 FROM orders
    WHERE o_orderpriority = '2-HIGH'),
one AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY version DESC) = 1)
SELECT o_orderkey AS order_key, o_orderstatus AS status, CAST(price AS DECIMAL(18,2)) AS price, version FROM one
UNION ALL SELECT o_orderkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)), 0 FROM orders
WHERE o_orderkey NOT IN (SELECT o_orderkey FROM one)"""
)
def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")

    def rows(src: DataFrame, status, add: int, version: int, shift: int = 0) -> DataFrame:
        return src.select(
            (F.col("o_orderkey") + shift).alias("order_key"),
            (F.lit(status) if isinstance(status, str) else status).alias("status"),
            (money("o_totalprice") + add).cast(V.MONEY).alias("price"),
            F.lit(version).alias("version"),
        )

    open_orders = o.where("o_orderstatus = 'P'")
    batch = (
        rows(open_orders, "NEW", 1, 1)
        .unionByName(rows(open_orders.where("o_orderpriority = '1-URGENT'"), "NEWER", 2, 2))
        .unionByName(rows(o.where("o_orderpriority = '2-HIGH'"), "ADDED", 0, 1, 100_000_000))
    )
    return merge.upsert(rows(o, F.col("o_orderstatus"), 0, 0), batch, ["order_key"], F.col("version"))


@query(
    """WITH b AS (
  SELECT o_orderkey AS order_key, o_orderstatus AS status, NULL AS note, 1 AS part FROM orders
  UNION ALL SELECT o_orderkey, 'NEW', o_orderpriority, 2 FROM orders WHERE o_orderstatus = 'P'
  UNION ALL SELECT o_orderkey + 100000000, 'ADDED', NULL, 3 FROM orders WHERE o_orderpriority = '2-HIGH'
  UNION ALL SELECT o_orderkey, 'LATE', NULL, 3 FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '2-HIGH')
SELECT order_key, status, note FROM b QUALIFY row_number() OVER (PARTITION BY order_key ORDER BY part DESC) = 1"""
)
def stored_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three upserts through storage: the second brings a column, the third runs twice and is compacted."""
    o = table(spark, sf_dir, "orders")
    path = scratch_path(spark, "upserts")
    note = F.lit(None).cast("string").alias("note")

    def rows(src: DataFrame, status, shift: int = 0) -> DataFrame:
        return src.select((F.col("o_orderkey") + shift).alias("order_key"), status.alias("status"))

    late = o.where("o_orderpriority = '2-HIGH'")
    third = rows(late, F.lit("ADDED"), 100_000_000).unionByName(rows(late.where("o_orderstatus = 'P'"), F.lit("LATE")))
    merge.upsert_table(spark, path, rows(o, F.col("o_orderstatus")), ["order_key"])
    open_orders = o.where("o_orderstatus = 'P'")
    noted = open_orders.select("o_orderkey", F.col("o_orderpriority").alias("note")).withColumnRenamed("o_orderkey", "order_key")
    merge.upsert_table(spark, path, rows(open_orders, F.lit("NEW")).join(noted, "order_key"), ["order_key"])
    part = merge.upsert_table(spark, path, third.select("*", note), ["order_key"])
    merge.upsert_table(spark, path, third.select("*", note), ["order_key"], part=part)
    merge.compact_table(spark, path)
    return merge.read_table(spark, path).select("order_key", "status", "note")


@query(
    """SELECT CAST(year(l_shipdate) AS INTEGER) AS statement_year, upper(monthname(l_shipdate)) AS statement_month,
  count(*) AS row_count FROM lineitem
WHERE NOT (year(l_shipdate) = 1995 AND month(l_shipdate) = 3) GROUP BY 1, 2"""
)
def stored_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An archive by period, through storage, in which one period was emptied."""
    path = scratch_path(spark, "periods")
    month = F.upper(F.date_format("l_shipdate", "MMMM")).alias("statement_month")
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", F.year("l_shipdate").alias("statement_year"), month
    )
    merge.write_periods(lines, path)
    merge.write_period(lines.where(F.lit(False)), path, 1995, "March")
    stored = merge.read_periods(spark, path)
    return stored.groupBy("statement_year", "statement_month").agg(F.count("*").alias("row_count"))


def stored_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Checked orders as the stored table that exports read, with one header row per file."""
    flat = merge.mark_check(merge.keep_original(rules.flatten_errors(checked_orders(spark, sf_dir))))
    body = flat.select("file", "source_row_no", "row_type", "data_row", "org_data_row", "error_message", "errors")
    line = F.lit("IA,XX,TPA01,Orders Template")
    files = order_lines(spark, sf_dir).select("file").distinct()
    heads = files.select(
        "file", F.lit(-1).cast("bigint").alias("source_row_no"), F.lit("IA").alias("row_type"), line.alias("data_row"),
        line.alias("org_data_row"), F.lit("").alias("error_message"), rules.no_errors().alias("errors"),
    )
    return stage(heads.unionByName(body), "stored-orders")


@query(
    f"""WITH {ORDER_TEXT_CTE}
SELECT file, split, row_no, file_row FROM splits"""
)
def split_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines of all five splits, with the texts of their errors."""
    shown = export.split_rows(stored_orders(spark, sf_dir))
    return shown.select("file", "split", "row_no", "file_row")


@query(
    f"""WITH {ORDER_CTE},
n AS (SELECT file, count(*) AS a, count(*) FILTER (len(codes) = 0) AS g FROM chk GROUP BY 1),
heads AS (SELECT file, u.split, u.n FROM n, unnest([{{'split': 'original_file', 'n': a}},
  {{'split': 'passed_lines', 'n': g}}, {{'split': 'rejected_lines', 'n': a - g}},
  {{'split': 'rejected_lines_with_errors', 'n': a - g}}, {{'split': 'all_lines_with_errors', 'n': a}}]) AS t(u))
SELECT file, split, 'IA,' || n || ',TPA01,Orders Template,B7' AS header, n AS line_count FROM heads"""
)
def header_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The header of every split, and the lines that really follow it."""
    lines = export.export_splits(stored_orders(spark, sf_dir), F.lit("B7"))
    head = F.col("row_no") < 0
    return lines.groupBy("file", "split").agg(
        F.max(F.when(head, F.col("file_row"))).alias("header"), F.count_if(~head).alias("line_count")
    )


@query(
    f"""WITH {ORDER_CTE},
bad AS (SELECT file, count(*) FILTER (len(codes) > 0) AS n FROM chk GROUP BY 1)
SELECT file || CASE s WHEN 0 THEN '-0-OriginalFile.mbi' WHEN 1 THEN '-1-PassedLines.mbi' WHEN 2 THEN '-2-RejectedLines.err'
  WHEN 3 THEN '-3-RejectedLines.mbi' ELSE '-4-allLines.err' END AS out_file,
  1 + count(*) FILTER (s IN (0, 4) OR (s = 1 AND len(codes) = 0) OR (s IN (2, 3) AND len(codes) > 0)) AS line_count
FROM chk JOIN bad USING (file), range(5) AS r(s) WHERE n > 0 GROUP BY file, s"""
)
def delivered_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which output files the checked files give, and how long each is."""
    stored = stored_orders(spark, sf_dir)
    outcome = stage(rules.file_outcomes(stored), "outcomes")
    chosen = export.outputs_of_files(stored, outcome)
    name = export.output_name(F.col("file"), F.col("split"), F.lit("A"))
    return chosen.groupBy(name.alias("out_file")).agg(F.count("*").alias("line_count"))


@query(
    """SELECT l_orderkey, l_linenumber, count(*) AS row_count FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def dup_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT 'orders' AS table_name, count(*) AS row_count FROM orders
UNION ALL SELECT 'lineitem', count(*) FROM lineitem UNION ALL SELECT 'events', count(*) FROM events"""
)
def table_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merge.table_totals(**{n: table(spark, sf_dir, n) for n in ("orders", "lineitem", "events")})


@query(
    """WITH arch AS (SELECT l_orderkey, l_linenumber, year(l_shipdate) AS y, upper(monthname(l_shipdate)) AS m,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, 'archived' AS origin FROM lineitem),
cur AS (SELECT o_orderkey, 0, 1998, 'MARCH', CASE WHEN o_orderstatus = 'P' THEN 0 ELSE CAST(o_totalprice AS DECIMAL(18,2)) END,
    upper(regexp_replace(o_orderpriority, '[^0-9A-Za-z]', '', 'g')) FROM orders WHERE year(o_orderdate) = 1998 AND month(o_orderdate) = 3)
SELECT CAST(y AS INTEGER) AS statement_year, m AS statement_month, origin AS memo, count(*) AS row_count,
  CAST(sum(amount) AS DECIMAL(18,2)) AS amount
FROM (SELECT * FROM arch WHERE NOT (y = 1998 AND m = 'MARCH') UNION ALL SELECT * FROM cur) GROUP BY 1, 2, 3"""
)
def period_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    zero = F.lit(0).cast(V.MONEY)
    li = table(spark, sf_dir, "lineitem")
    archive = li.select(
        F.col("l_orderkey").cast("string").alias("num"), F.lit("").alias("name"), F.lit("").alias("agent"),
        F.lit("archived").alias("memo"), money("l_quantity").alias("qty"), zero.alias("sales_price"),
        money("l_extendedprice").alias("amount"), zero.alias("open_balance"),
        F.upper(F.date_format("l_shipdate", "MMMM")).alias("statement_month"), F.year("l_shipdate").alias("statement_year"),
    )
    o = table(spark, sf_dir, "orders").where("year(o_orderdate) = 1998 and month(o_orderdate) = 3")
    amount = F.when(F.col("o_orderstatus") != "P", money("o_totalprice"))
    current = o.select(
        F.col("o_orderkey").cast("string").alias("num"), F.lit("n").alias("name"), F.lit("a").alias("agent"),
        F.col("o_orderpriority").alias("memo"), F.lit(None).cast(V.MONEY).alias("qty"),
        F.lit(None).cast(V.MONEY).alias("sales_price"), amount.alias("amount"), F.lit(None).cast(V.MONEY).alias("open_balance"),
    )
    replaced = merge.replace_period(archive, merge.clean_invoices(current, 1998, " March"), 1998, "March")
    return replaced.groupBy("statement_year", "statement_month", "memo").agg(
        F.count("*").alias("row_count"), F.sum("amount").cast(V.MONEY).alias("amount")
    )


# --- results -------------------------------------------------------------------------------

RESULT_CTE = """
sent AS (SELECT 'sent_' || (o_custkey % 40) || '.mbi' AS file, o_orderkey AS row_num, 'OR,' || o_orderkey || ',' || o_orderstatus AS data_row FROM orders),
res AS (SELECT 'sent_' || (l_suppkey % 50) || '.mbi' AS sent_file, l_orderkey AS row_num, 'NATION_' || (l_suppkey % 30) AS er,
  CASE l_returnflag WHEN 'N' THEN '0' WHEN 'A' THEN '15028' ELSE CASE WHEN l_linestatus = 'O' THEN 'X1' ELSE '20001' END END AS code FROM lineitem),
err AS (SELECT sent_file, row_num, er, code, CASE code WHEN '15028' THEN 'Employer must be active' END AS msg FROM res
  WHERE TRY_CAST(code AS DOUBLE) IS NOT NULL AND code > '0'),
crm AS (SELECT n_name AS bencode, 'mgr ' || n_regionkey AS crm FROM nation)"""


def sent_and_results(spark: SparkSession, sf_dir: str):
    sent = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("sent_"), (F.col("o_custkey") % 40).cast("string"), F.lit(".mbi")).alias("file"),
        F.col("o_orderkey").alias("row_num"),
        F.concat_ws(",", F.lit("OR"), F.col("o_orderkey").cast("string"), "o_orderstatus").alias("data_row"),
    )
    code = (
        F.when(F.col("l_returnflag") == "N", "0")
        .when(F.col("l_returnflag") == "A", "15028")
        .when(F.col("l_linestatus") == "O", "X1")
        .otherwise("20001")
    )
    res = table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("sent_"), (F.col("l_suppkey") % 50).cast("string"), F.lit(".mbi")).alias("sent_file"),
        F.col("l_orderkey").alias("row_num"),
        F.concat(F.lit("NATION_"), (F.col("l_suppkey") % 30).cast("string")).alias("EmployerId"),
        code.alias("error_code"),
        F.lit("").alias("error_message"),
        F.lit("RB").alias("row_type"),
    )
    return sent, res


def account_managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("bencode"), F.concat(F.lit("mgr "), F.col("n_regionkey").cast("string")).alias("crm"),
        F.lit("m@example.org").alias("crm_email"),
    )


def error_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Error codes with their texts, taken from the line flags."""
    flags = table(spark, sf_dir, "lineitem").select("l_returnflag").distinct()
    known = F.col("l_returnflag") == "A"
    return flags.select(
        F.when(known, "15028").otherwise(F.concat(F.lit("9"), F.col("l_returnflag"))).alias("error_code"),
        F.when(known, "Employer must be active").otherwise("Unused").alias("user_desc"),
    )


@query(
    f"""WITH {RESULT_CTE},
full_ AS (SELECT DISTINCT e.*, s.row_num AS sent_row, s.data_row, c.crm FROM err e
  LEFT JOIN sent s ON e.sent_file = s.file AND e.row_num = s.row_num LEFT JOIN crm c ON e.er = c.bencode)
SELECT sent_file, crm, code AS error_code, msg AS error_message, count(*) AS row_count, count(sent_row) AS matched,
  max(data_row) AS sample_line FROM full_ GROUP BY 1, 2, 3, 4"""
)
def reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, res = sent_and_results(spark, sf_dir)
    texts = results.with_error_texts(res, error_catalogue(spark, sf_dir))
    errors = results.errors_with_sent(results.result_errors(texts), sent)
    full = results.with_manager(errors, account_managers(spark, sf_dir))
    return full.groupBy("sent_file", "crm", "error_code", "error_message").agg(
        F.count("*").alias("row_count"), F.count("sent_row_num").alias("matched"), F.max("sent_line").alias("sample_line")
    )


@query(
    f"""WITH {RESULT_CTE}
SELECT DISTINCT sent_file, 'no sent file' AS finding FROM res WHERE sent_file NOT IN (SELECT file FROM sent)
UNION ALL SELECT DISTINCT file, 'no result' FROM sent WHERE file NOT IN (SELECT sent_file FROM res WHERE code <> '0' AND er <> 'NATION_3')"""
)
def reconcile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent, res = sent_and_results(spark, sf_dir)
    answered = res.where("error_code <> '0' and EmployerId <> 'NATION_3'")
    unknown = results.results_without_sent(res, sent).withColumn("finding", F.lit("no sent file"))
    silent = results.sent_without_results(sent, answered).withColumn("finding", F.lit("no result"))
    return unknown.unionByName(silent)


@query(
    f"""WITH {RESULT_CTE}
SELECT DISTINCT 'message' AS kind, msg AS value FROM err UNION ALL SELECT DISTINCT 'file', sent_file FROM err
UNION ALL SELECT DISTINCT 'manager', bencode || '/' || crm FROM crm"""
)
def distinct_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, res = sent_and_results(spark, sf_dir)
    errors = results.result_errors(results.with_error_texts(res, error_catalogue(spark, sf_dir)))
    messages = results.distinct_messages(errors).select(F.lit("message").alias("kind"), F.col("error_message").alias("value"))
    files = results.files_with_errors(errors).select(F.lit("file").alias("kind"), F.col("sent_file").alias("value"))
    managers = results.manager_list(account_managers(spark, sf_dir)).select(
        F.lit("manager").alias("kind"), F.concat_ws("/", "bencode", "crm").alias("value")
    )
    return messages.unionByName(files).unionByName(managers)


QUEUE_CTE = r"""
err AS (SELECT 'user_' || user_id AS sent_file, event_id AS n, regexp_extract(props, '([0-9]+)', 1) AS code FROM events WHERE event_type = 'error'),
tracked AS (SELECT DISTINCT regexp_extract(props, '([0-9]+)', 1) AS code FROM events WHERE event_type = 'click' AND value < 1),
queue AS (SELECT * FROM err WHERE n IN (SELECT event_id FROM events WHERE value < 10))"""


def queue_inputs(spark: SparkSession, sf_dir: str):
    e = table(spark, sf_dir, "events")
    code = F.regexp_extract("props", "([0-9]+)", 1)
    errors = e.where("event_type = 'error'").select(
        F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("sent_file"),
        F.col("event_id").alias("error_row_num"),
        code.alias("error_code"),
        F.concat(F.lit("error "), code).alias("error_message"),
        F.concat(F.lit("NATION_"), (F.col("user_id") % 30).cast("string")).alias("EmployerId"),
        F.lit("").alias("crm"),
        "value",
    )
    tracked = e.where("event_type = 'click' and value < 1").select(
        code.alias("error_code"), F.concat(F.lit("error "), code).alias("error_message"),
        F.lit(True).alias("crm"), F.lit(True).alias("processing"), F.lit(True).alias("control"),
    ).distinct()
    queue = errors.where("value < 10").drop("value").withColumns(
        {c: F.lit(True) for c in ("crm_check", "proc_check", "archive_check")}
    )
    managers = table(spark, sf_dir, "nation").select(
        F.col("n_name").alias("bencode"), F.concat(F.lit('""'), F.col("n_name")).alias("crm")
    )
    return results.track_new_errors(errors.drop("value"), tracked, queue, managers)


@query(
    f"""WITH {QUEUE_CTE}
SELECT code AS error_code, 'error ' || code AS error_message, true AS crm FROM tracked
UNION ALL SELECT DISTINCT code, 'error ' || code, false FROM err WHERE code NOT IN (SELECT code FROM tracked)"""
)
def tracked_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, _ = queue_inputs(spark, sf_dir)
    return codes.select("error_code", "error_message", "crm")


@query(
    f"""WITH {QUEUE_CTE}
SELECT sent_file, n AS error_row_num, code AS error_code, n IN (SELECT n FROM queue) AS proc_check,
  coalesce(n_name, '') AS crm
FROM err LEFT JOIN nation ON n_name = 'NATION_' || (CAST(substr(sent_file, 6) AS INTEGER) % 30)"""
)
def new_error_queue(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, queue = queue_inputs(spark, sf_dir)
    return queue.select("sent_file", "error_row_num", "error_code", "proc_check", "crm")


@query(
    """WITH rows_ AS (SELECT o_orderpriority AS rf, o_orderkey,
    row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) = 1 AS head,
    CASE WHEN o_orderstatus = 'P' THEN '15028' WHEN o_orderstatus = 'F' THEN '0' ELSE '777' END AS code FROM orders)
SELECT rf AS result_file, CASE WHEN rf = '5-LOW' THEN rf ELSE 'sent_' || left(rf, 1) || '.mbi' END AS sent_file,
  CASE WHEN head THEN 'RA' ELSE 'RB' END AS row_type, CASE WHEN head THEN NULL ELSE code END AS error_code,
  CASE WHEN NOT head AND code = '15028' THEN 'Employer must be active' END AS error_message,
  count(*) AS row_count FROM rows_ GROUP BY 1, 2, 3, 4, 5"""
)
def result_cleanup(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    heads = o.groupBy("o_orderpriority").agg(F.min("o_orderkey").alias("_head"))
    rows = o.join(heads, "o_orderpriority")
    is_head = F.col("o_orderkey") == F.col("_head")
    name = F.when(F.col("o_orderpriority") == "5-LOW", "none").otherwise(
        F.concat(F.lit("sent_"), F.left("o_orderpriority", F.lit(1)), F.lit(".mbi"))
    )
    code = F.when(F.col("o_orderstatus") == "P", "15028").when(F.col("o_orderstatus") == "F", "0").otherwise("777")
    lines = rows.select(
        F.col("o_orderpriority").alias("result_file"),
        F.col("o_orderkey").alias("source_row_no"),
        F.when(is_head, F.concat(F.lit("RA, "), name, F.lit(",Result Template,,,,1,bad,")))
        .otherwise(F.concat(F.lit('RB,EMP001,123456789,"PLAN-1",20240101,20241231,'), code, F.lit(",,")))
        .alias("error_row"),
    )
    cleaned = results.clean_results(split_result_rows(lines, "error_row"), error_catalogue(spark, sf_dir))
    return cleaned.groupBy("result_file", "sent_file", "row_type", "error_code", "error_message").agg(
        F.count("*").alias("row_count")
    )


@query(
    """WITH codes AS (SELECT DISTINCT '/' || lang || '/' AS code FROM documents
  UNION SELECT '/' || n_nationkey FROM nation UNION SELECT lower(left(r_name, 2)) FROM region)
SELECT code, count(*) AS page_count, sum(page_id)::BIGINT AS page_sum FROM pages JOIN codes ON strpos(url, code) > 1 GROUP BY 1"""
)
def contains_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    langs = table(spark, sf_dir, "documents").select(F.concat(F.lit("/"), F.col("lang"), F.lit("/")).alias("code"))
    keys = table(spark, sf_dir, "nation").select(F.concat(F.lit("/"), F.col("n_nationkey").cast("string")))
    heads = table(spark, sf_dir, "region").select(F.lower(F.left("r_name", F.lit(2))))
    codes = langs.union(keys).union(heads).distinct()
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    hits = results.rows_with_codes(pages, "url", codes, "code")
    return hits.groupBy("code").agg(F.count("*").alias("page_count"), F.sum("page_id").alias("page_sum"))


# --- lineage -------------------------------------------------------------------------------


@query(
    """SELECT s.source AS name, coalesce(max(d.doc_id), 0) AS file_log_id
FROM (SELECT DISTINCT source FROM documents UNION SELECT 'missing') s LEFT JOIN documents d
ON starts_with(d.source || '_' || d.lang, s.source) OR starts_with(d.lang || '_' || d.doc_id, s.source) GROUP BY 1"""
)
def latest_by_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    log = d.select(
        F.col("doc_id").alias("file_log_id"),
        F.concat_ws("_", "source", "lang").alias("original_file_name"),
        F.concat_ws("_", "lang", F.col("doc_id").cast("string")).alias("new_file_name"),
    )
    names = d.select(F.col("source").alias("name")).union(d.select(F.lit("missing"))).distinct()
    return lineage.latest_by_prefix(names, log)


@query(
    """SELECT source, doc_id, CAST(rank AS INTEGER) AS rank FROM (SELECT source, doc_id,
  row_number() OVER (PARTITION BY source ORDER BY doc_id DESC) AS rank FROM documents) WHERE rank <= 3"""
)
def top_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("source", "doc_id")
    return lineage.top_rows(d, "source", "doc_id", 3).select("source", "doc_id", "rank")


@query("""SELECT lang, max(source || '_' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || '.csv') AS file_name,
  arg_max(doc_id, source || '_' || lpad(CAST(doc_id AS VARCHAR), 12, '0')) AS doc_id FROM documents GROUP BY 1""")
def latest_of_pattern_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    number = F.lpad(F.col("doc_id").cast("string"), 12, "0")
    files = d.select("lang", "doc_id", F.concat(F.col("source"), F.lit("_"), number, F.lit(".csv")).alias("file_name"))
    return latest_of_pattern(files, "lang")


@query(
    """SELECT c_custkey AS user_id, coalesce(n, 0) AS error_count FROM customer LEFT JOIN (SELECT user_id,
  count(*) AS n FROM events WHERE event_type = 'error' AND value > 50 GROUP BY 1) ON user_id = c_custkey"""
)
def error_count_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    owners = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    events = table(spark, sf_dir, "events")
    is_error = (F.col("event_type") == "error") & (F.col("value") > 50)
    return lineage.error_counts(owners, events, "user_id", is_error)


@query(
    """SELECT CASE WHEN user_id % 2 = 0 THEN CAST(1000 + user_id AS VARCHAR) ELSE 'upload_' || user_id END AS file_id,
  arg_min(event_type, event_id) AS first_task, min(event_id) AS first_seq, count(*) AS task_count,
  count(*) FILTER (event_type = 'error') AS processing_error_count FROM events
WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0) GROUP BY 1"""
)
def lineage_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logged tasks; some files are in the log already."""
    e = table(spark, sf_dir, "events")
    user = F.col("user_id").cast("string")
    tasks = e.select(
        F.lit("A").alias("platform"),
        F.lit("inbox").alias("folder_name"),
        F.concat(F.lit("upload_"), user, F.lit(".csv")).alias("original_file_name"),
        F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("upload--"), (1000 + F.col("user_id")).cast("string"), F.lit(".csv")))
        .otherwise("")
        .alias("new_file_name"),
        F.col("event_type").alias("processing_task"),
        F.when(F.col("event_type") == "error", "ERROR").otherwise("Success").alias("processing_task_outcome"),
        F.col("ts").alias("created_at"),
        F.col("event_id").alias("task_seq"),
        "user_id",
    )
    owners = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("user_id"))
    logged = lineage.with_ids(tasks.join(owners, "user_id", "left_semi")).select("file_log_id").distinct()
    heads, details = lineage.log_tasks(tasks, logged)
    counts = details.groupBy("file_log_id").agg(
        F.count("*").alias("task_count"),
        F.min_by("processing_task", "task_seq").alias("first_task"),
        F.min("task_seq").alias("first_seq"),
    )
    view = lineage.log_view(heads, details).join(counts, "file_log_id")
    return view.select("file_id", "first_task", "first_seq", "task_count", "processing_error_count")


# --- commission ----------------------------------------------------------------------------

INVOICE_CTE = r"""
inv AS (SELECT l_orderkey AS id, ' ' || l_orderkey AS num, s_name AS agent, p_brand AS name, p_type AS memo,
    CAST(l_quantity AS DECIMAL(18,2)) AS qty, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, CAST(l_shipdate AS DATE) AS d
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey),
agr AS (SELECT s_suppkey AS id, s_name AS broker, 'brand ' || (s_suppkey % 25) AS client, 'brand ' || ((s_suppkey + 1) % 25) AS client2, ['ECONOMY', 'LARGE', 'MEDIUM', 'PROMO', 'SMALL', 'STANDARD'][1 + s_nationkey % 6] AS fee,
    CASE s_suppkey % 4 WHEN 0 THEN 'Per Qt' WHEN 1 THEN 'Per Amount' WHEN 2 THEN 'Flat Rate' ELSE 'Other' END AS unit,
    CAST(abs(CAST(s_acctbal AS DECIMAL(18,2))) * 0.01 AS DECIMAL(18,4)) AS rate FROM supplier),
pairs AS (SELECT inv.id, inv.num, agr.id AS broker_id, broker, inv.name, client, client2, fee, memo, qty, amount, unit, d,
    CAST(CASE unit WHEN 'Per Qt' THEN rate * qty WHEN 'Per Amount' THEN rate * amount WHEN 'Flat Rate' THEN rate END AS DECIMAL(18,2)) AS commission
  FROM inv JOIN agr ON regexp_replace(upper(agent), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(broker), '[^A-Z0-9]', '', 'g')
   AND memo = fee),
hit AS (SELECT * FROM pairs WHERE regexp_replace(upper(name), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(client), '[^A-Z0-9]', '', 'g')),
hit2 AS (SELECT * FROM pairs WHERE regexp_replace(upper(name), '[^A-Z0-9]', '', 'g') = regexp_replace(upper(client2), '[^A-Z0-9]', '', 'g'))"""


def invoice_inputs(spark: SparkSession, sf_dir: str):
    li, s, p = (table(spark, sf_dir, n) for n in ("lineitem", "supplier", "part"))
    joined = li.join(s, li["l_suppkey"] == s["s_suppkey"]).join(p, li["l_partkey"] == p["p_partkey"])
    zero = F.lit(0).cast(V.MONEY)
    invoices = joined.select(
        F.col("l_orderkey").alias("id"),
        F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("num"),
        F.col("s_name").alias("agent"), F.col("p_brand").alias("name"), F.col("p_type").alias("memo"),
        money("l_quantity").alias("qty"), zero.alias("sales_price"), money("l_extendedprice").alias("amount"),
        zero.alias("open_balance"), F.col("l_shipdate").cast("date").alias("date"),
    )
    kinds = F.array(*[F.lit(k) for k in ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")])
    unit = (
        F.when(F.col("s_suppkey") % 4 == 0, "Per Qt").when(F.col("s_suppkey") % 4 == 1, "Per Amount")
        .when(F.col("s_suppkey") % 4 == 2, "Flat Rate").otherwise("Other")
    )
    fee = F.get(kinds, F.col("s_nationkey") % 6)
    agreements = s.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("broker_name"), F.col("s_name").alias("qb_broker_name"),
        F.concat(F.lit("brand "), ((F.col("s_suppkey") + 1) % 25).cast("string")).alias("client_name"),
        F.concat(F.lit("brand "), (F.col("s_suppkey") % 25).cast("string")).alias("qb_client_name"),
        fee.alias("qb_fee"), fee.alias("fee_memo"), unit.alias("unit"), F.lit("Active").alias("broker_status"),
        F.lit("").alias("email"), F.lit("").alias("paylocity_id"),
        (F.abs(money("s_acctbal")) * F.lit("0.01").cast("decimal(3,2)")).cast(C.RATE).alias("commission_rate"),
        F.lit("2020-01-01").cast("date").alias("start_date"), F.col("s_suppkey").alias("client_id"),
    )
    return invoices, agreements


@query(
    f"""WITH {INVOICE_CTE}
SELECT id, num, broker AS broker_name, upper(name) AS qb_client, upper(fee) AS qb_fee, qty, amount, unit, commission AS commission_amount FROM hit"""
)
def commission_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = C.match_tier(*invoice_inputs(spark, sf_dir))
    return matched.select(
        "id", "num", "broker_name", "qb_client", "qb_fee", "qty", "amount", "unit", "commission_amount"
    )


def commission_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices, agreements = invoice_inputs(spark, sf_dir)
    manual = manual_additions(spark, sf_dir)
    sent = table(spark, sf_dir, "orders").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit("  ")).alias("invoice_num"), money("o_totalprice").alias("open_balance")
    )
    by_fee = (("agent", "qb_broker_name"), ("memo", "qb_fee"), ("name", "client_name"))
    return C.commission_result(
        invoices, agreements, manual, sent, (C.TIER_0, by_fee), F.lit("2024-01-31").cast("date")
    )


def manual_additions(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    amount = (F.col("n_nationkey") * 10 + 5).cast(V.MONEY)
    return n.select(
        F.col("n_nationkey").cast("bigint").alias("detail_id"),
        F.lit(None).cast("bigint").alias("header_id"),
        F.col("n_regionkey").cast("bigint").alias("broker_id"),
        F.concat(F.lit("Broker "), F.col("n_regionkey").cast("string")).alias("broker_name"),
        F.col("n_name").alias("qb_client_name"), F.col("n_name").alias("client_name"),
        F.lit("MANUAL").alias("qb_fee"), F.lit("MANUAL").alias("fee_memo"), F.lit(1).cast(V.MONEY).alias("quantity"),
        amount.alias("sales_price"), amount.alias("total_price"), F.lit(1).cast(C.RATE).alias("commission_rate"),
        F.lit("Flat Rate").alias("unit"), F.lit("Appended").alias("status"), F.lit("Appended").alias("broker_status"),
        F.lit("").alias("paylocity_id"), F.lit("2024-01-01").cast("date").alias("start_date"),
    )


COMMISSION_CTE = f"""{INVOICE_CTE},
merged AS (SELECT DISTINCT id, num, broker_id, broker, name, fee, qty, amount, unit, d, commission FROM hit
  UNION SELECT id, num, broker_id, broker, name, fee, qty, amount, unit, d, commission FROM hit2
  UNION SELECT n_nationkey, n_regionkey || '-' || n_nationkey || '-2024-01-01', n_regionkey, 'Broker ' || n_regionkey, n_name, 'MANUAL',
    1, n_nationkey * 10 + 5, 'Flat Rate', DATE '2024-01-01', n_nationkey * 10 + 5 FROM nation),
with_sent AS (SELECT m.*, s.bal FROM merged m LEFT JOIN (SELECT CAST(o_orderkey AS VARCHAR) AS inv,
  sum(CAST(o_totalprice AS DECIMAL(18,2))) AS bal FROM orders GROUP BY 1) s ON trim(m.num) = s.inv)"""


@query(
    f"""WITH {COMMISSION_CTE}
SELECT broker AS broker_name, unit, count(*) AS line_count, CAST(sum(commission) AS DECIMAL(18,2)) AS commission,
  CAST(sum(bal) AS DECIMAL(18,2)) AS sent_balance FROM with_sent GROUP BY 1, 2"""
)
def commission_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = commission_lines(spark, sf_dir)
    return lines.groupBy("broker_name", "unit").agg(
        F.count("*").alias("line_count"),
        F.sum("commission_amount").cast(V.MONEY).alias("commission"),
        F.sum("total_invoice_sent_open_balance").cast(V.MONEY).alias("sent_balance"),
    )


@query(
    f"""WITH {COMMISSION_CTE}
SELECT broker_id, broker AS broker_name, 'JANUARY' AS month, 2024 AS year, count(*) AS line_count,
  CAST(sum(commission) AS DECIMAL(18,2)) AS total, min(trim(num)) AS first_invoice
FROM with_sent JOIN (SELECT DISTINCT broker_id AS b, broker AS header_name FROM with_sent) h
  ON h.b = broker_id AND h.header_name = broker
GROUP BY 1, 2"""
)
def statement(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = commission_lines(spark, sf_dir)
    heads = C.statement_headers(lines, 2024, "JANUARY", F.lit("2024-01-31").cast("date"))
    details = C.statement_details(heads, lines)
    return details.groupBy("broker_id", "broker_name", "month", "year").agg(
        F.count("*").alias("line_count"),
        F.sum("total_price").cast(V.MONEY).alias("total"),
        F.min("invoice_num").alias("first_invoice"),
    )


@query(
    f"""WITH {INVOICE_CTE},
lines AS (SELECT DISTINCT id, num, broker_id, broker, name, fee, qty, amount, unit, d, commission FROM hit),
shown AS (SELECT broker, CASE id % 3 WHEN 0 THEN 'paid' WHEN 1 THEN 'pending' ELSE 'open' END AS pay, commission FROM lines)
SELECT broker AS broker_name, pay AS line_payment_status, count(*) AS line_count, CAST(sum(commission) AS DECIMAL(18,2)) AS total
FROM shown WHERE pay <> 'open' GROUP BY 1, 2
UNION ALL SELECT 'Broker ' || n_regionkey, 'Appended', count(*), CAST(sum(n_nationkey * 10 + 5) AS DECIMAL(18,2)) FROM nation GROUP BY 1, 2"""
)
def statement_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    invoices, agreements = invoice_inputs(spark, sf_dir)
    lines = C.commission_result(invoices, agreements)
    heads = C.statement_headers(lines, 2024, "JANUARY")
    number = F.col("invoice_num").cast("bigint") % 3
    paid = F.when(number == 0, "paid").when(number == 1, "pending").otherwise("open")
    details = C.statement_details(heads, lines).withColumn("line_payment_status", paid)
    view = C.statement_view(details, manual_additions(spark, sf_dir))
    return view.groupBy("broker_name", "line_payment_status").agg(
        F.count("*").alias("line_count"), F.sum("total_price").cast(V.MONEY).alias("total")
    )


# --- files and streams ---------------------------------------------------------------------


@query(
    """SELECT o_orderpriority AS file, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS source_row_no,
  'OR,' || o_orderkey || ',' || o_orderstatus AS line FROM orders"""
)
def line_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written as ordered text files, read back and numbered."""
    o = table(spark, sf_dir, "orders").select(
        F.replace("o_orderpriority", F.lit(" "), F.lit("_")).alias("out_file"),
        F.col("o_orderkey").alias("row_no"),
        F.concat_ws(",", F.lit("OR"), F.col("o_orderkey").cast("string"), "o_orderstatus").alias("file_row"),
    )
    path = scratch_path(spark, "lines")
    write_lines(o, path)
    lines = as_logical_files(read_lines(spark, [path], recursive=True))
    numbered = number_lines(lines)
    return numbered.select(F.replace("file", F.lit("_"), F.lit(" ")).alias("file"), "source_row_no", "line")


@query("SELECT event_id, event_type, CAST(value AS DECIMAL(18,2)) AS value, user_id FROM events")
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as text files, taken in by an incremental stream and upserted by id."""
    e = table(spark, sf_dir, "events")
    inbox, held, seen = (scratch_path(spark, n) for n in ("inbox", "stored", "seen"))
    line = F.concat_ws(
        ",", F.lit("EV"), F.col("event_id").cast("string"), F.col("event_type"), money("value").cast("string"),
        F.col("user_id").cast("string"),
    )
    # Several batches: files of a user group each, three to a batch.
    e.repartition(8, F.col("user_id") % 8).select(line.alias("value")).write.text(inbox)
    spec = record("EV", ["EventId:int*", "EventType:text", "Value:money", "UserId:int"])

    def as_rows(batch: DataFrame) -> DataFrame:
        checked = rules.apply_rules(parse_record(batch, spec), spec, rules.RuleOptions("C"))
        return rules.typed(checked, spec).select(
            F.col("EventId").alias("event_id"), F.col("EventType").alias("event_type"), F.col("Value").alias("value"),
            F.col("UserId").alias("user_id"),
        )

    ingest(stream_lines(spark, inbox, files_per_trigger=3), as_rows, held, seen, ["event_id"])
    return merge.read_table(spark, held).select("event_id", "event_type", "value", "user_id")
