"""Which platform, layout, name and destination a file has; which record type a line has."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.lines import EMPTY_FILE_BYTES
from ..spec import platform_a_catalogue, platform_a_header_rules, platform_a_layouts, platform_c_layouts, platform_c_versions
from .parse import column_count, first_field, split_csv

# Header types and their numbers in file names.
HEADER_TYPES = {"NotApplicable": 0, "Own": 1, "Old": 2, "New": 3, "SegmentedFunding": 4, "NoChange": 5}

# Fixed value: a notice that clients leave above or below their records. Callers add their own texts.
NOTICES = ("please email completed file to",)

UNKNOWN_TYPE = "Unknown"
UNKNOWN_BRACKET = "[UNKNOWN]"


# --- lines ---------------------------------------------------------------------------------


def a_code(line: Column) -> Column:
    """The first value of a line if it is a known record code of platform A, else NULL."""
    code = F.upper(F.trim(first_field(line)))
    return F.when((F.length(code) == 2) & code.isin(*platform_a_catalogue()), code)


def a_record_type(code: Column) -> Column:
    """Record code to record type; anything that is not a known two-character code is Unknown."""
    pairs = [F.lit(x) for c, entry in platform_a_catalogue().items() for x in (c, entry["title"])]
    return F.coalesce(F.create_map(*pairs)[F.upper(code)], F.lit(UNKNOWN_TYPE))


def is_result_code(code: Column) -> Column:
    return F.upper(code).isin(*[c for c, e in platform_a_catalogue().items() if e.get("result")])


def is_header_code(code: Column) -> Column:
    return F.upper(code).isin(*[c for c, e in platform_a_catalogue().items() if e.get("header")])


def catalogue_table(spark) -> DataFrame:
    rows = [
        (code, e["title"], bool(e.get("header")), bool(e.get("result")))
        for code, e in platform_a_catalogue().items()
    ]
    return spark.createDataFrame(rows, "code string, record_type string, is_header boolean, is_result boolean")


def _head(line: Column) -> Column:
    return F.left(F.trim(line), F.lit(3))


def is_a_header_line(line: Column) -> Column:
    return _head(line) == "IA,"


def is_a_record_line(line: Column) -> Column:
    return _head(line).rlike("^I[B-Z],")


def is_result_header_line(line: Column) -> Column:
    return _head(line) == "RA,"


def is_result_record_line(line: Column) -> Column:
    return _head(line).rlike("^R[B-Z],")


def is_a_import_line(line: Column, notices: tuple[str, ...] = NOTICES) -> Column:
    """Not blank, and a record or at least not a known notice."""
    noticed = F.lit(False)
    for notice in notices:
        noticed = noticed | F.lower(line).contains(notice.lower())
    return ~T.is_blank(line) & (is_a_record_line(line) | ~noticed)


def c_record_type(line: Column) -> Column:
    """The bracket code of a line in upper case."""
    return F.when(T.is_blank(line), UNKNOWN_BRACKET).otherwise(F.upper(F.trim(first_field(line))))


def is_c_layout(code: Column) -> Column:
    return code.isin(*platform_c_layouts())


# --- files ---------------------------------------------------------------------------------


def classify_files(
    lines: DataFrame, file_col: str = "file", order: str = "source_row_no", line_col: str = "line",
    notices: tuple[str, ...] = NOTICES, loose: bool = False,
) -> DataFrame:
    """Per file: the platform, what a C file contains and its version.

    C if the first line holds the version tag, else A if a line is an A record (``loose``: if any
    line counts as an import line), else Unknown. One aggregation with map-side partials.
    """
    line = F.col(line_col)
    a_line = is_a_import_line(line, notices) if loose else is_a_record_line(line)
    tag = F.upper(F.trim(first_field(line)))
    version_row = F.when((tag == "[VERSION]") & (column_count(line) >= 2), F.col(order))
    # The version as its place in the known list: fixed-width values keep the aggregation hashed.
    known = list(platform_c_versions())
    version = F.array_position(F.array(*[F.lit(v) for v in known]), F.trim(F.try_element_at(split_csv(line), F.lit(2))))
    facts = lines.groupBy(file_col).agg(
        F.count("*").alias("line_count"),
        F.min_by(F.upper(line).contains("[VERSION],"), F.col(order)).alias("_c_first"),
        F.bool_or(a_line).alias("_has_a"),
        F.bool_or(tag == "[QB]").alias("_qb"),
        F.bool_or(tag == "[SPM]").alias("_spm"),
        F.bool_or(tag == "[NPM]").alias("_npm"),
        F.min_by(F.when(version_row.isNotNull(), version.cast("int")), version_row).alias("_version"),
    )
    is_c = F.coalesce(F.col("_c_first"), F.lit(False))
    platform = F.when(is_c, "C").when(F.col("_has_a"), "A").otherwise("Unknown")
    return facts.select(
        file_col,
        "line_count",
        platform.alias("platform"),
        (is_c & F.col("_qb")).alias("has_qb"),
        (is_c & F.col("_spm")).alias("has_spm"),
        (is_c & F.col("_npm")).alias("has_npm"),
        F.when(is_c, c_version(F.get(F.array(*[F.lit(v) for v in known]), F.col("_version") - 1))).alias("version"),
    )


def c_version(version: Column) -> Column:
    """Version text; ``1`` is read as ``1.0``."""
    return F.when(version == "1", "1.0").otherwise(version)


def record_type_rows(lines: DataFrame, file_col: str = "file", order: str = "source_row_no", line_col: str = "line"):
    """Per file and record type: how many rows and the first and last row number."""
    typed = lines.withColumn("record_type", a_record_type(first_field(F.col(line_col))))
    return typed.groupBy(file_col, "record_type").agg(
        F.count("*").alias("row_count"), F.min(order).alias("first_row"), F.max(order).alias("last_row")
    )


def header_type_for(code: Column, columns: Column) -> Column:
    """Header type from the column count of the first data row; NULL where the count fits none."""
    rules = platform_a_header_rules()
    result = F.when(is_result_code(code), "New")
    for rule_code, counts in rules.items():
        for count, header_type in counts.items():
            result = result.when((code == rule_code) & (columns == count), header_type)
    for layout_code, header_type in platform_a_layouts():
        if header_type == "New" and layout_code not in rules and layout_code.startswith("I"):
            width = platform_a_layouts()[layout_code, "New"].width
            result = result.when((code == layout_code) & (columns == width), "New")
    return result


def header_types(
    lines: DataFrame, file_col: str = "file", order: str = "source_row_no", line_col: str = "line"
) -> DataFrame:
    """Per file and A record code: column count of the first row, header type, and whether it fits.

    Header rows and rows of an unknown type say nothing about the layout and are left out. Codes
    without a layout take no part in the check.
    """
    line = F.col(line_col)
    with_layout = sorted({code for code, _ in platform_a_layouts()})
    rows = lines.withColumn("code", a_code(line)).where(F.col("code").isin(*with_layout))
    first = rows.groupBy(file_col, "code").agg(F.min_by(column_count(line), F.col(order)).alias("columns"))
    found = first.withColumn("header_type", header_type_for(F.col("code"), F.col("columns")))
    return found.withColumn("fits", F.col("header_type").isNotNull())


def file_header_types(
    lines: DataFrame, file_col: str = "file", order: str = "source_row_no", line_col: str = "line"
) -> DataFrame:
    """Per file with record lines the header type of its first line that decides: whose code and
    column count fit a layout. NULL if there is none."""
    line = F.col(line_col)
    with_layout = sorted({code for code, _ in platform_a_layouts()})
    rows = lines.withColumn("code", a_code(line)).where(F.col("code").isin(*with_layout))
    kind = header_type_for(F.col("code"), column_count(line))
    first = F.min_by(kind, F.when(kind.isNotNull(), F.col(order)))
    return rows.groupBy(file_col).agg(first.alias("header_type"))


# --- file names ----------------------------------------------------------------------------


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def extension(name: Column) -> Column:
    """The extension with its dot, or blank."""
    return F.regexp_extract(name, r"(\.[^./]*)$", 1)


def without_extension(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^./]*$", "")


def is_test_file(name: Column) -> Column:
    return F.lower(base_name(name)).contains("test")


def is_empty_file(size: Column) -> Column:
    return size <= EMPTY_FILE_BYTES


def is_excel_file(name: Column) -> Column:
    return F.lower(extension(name)).isin(".xlsx", ".xls")


def header_type_from_name(name: Column) -> Column:
    """The header type in the second of three ``--`` parts, else NotApplicable."""
    parts = F.split(name, "--")
    pairs = [
        F.lit(x) for t in ("NotApplicable", "New", "Old", "NoChange", "Own") for x in (str(HEADER_TYPES[t]), t)
    ]
    named = F.create_map(*pairs)[F.try_element_at(parts, F.lit(2))]
    return F.when(F.size(parts) >= 3, F.coalesce(named, F.lit("NotApplicable"))).otherwise("NotApplicable")


def strip_file_id(name: Column) -> Column:
    """The part of a name before its id."""
    return F.substring_index(without_extension(base_name(name)), "--", 1)


def file_id_from_name(name: Column) -> Column:
    """The id after the first ``--`` of a name, or blank."""
    bare = without_extension(base_name(name))
    at = F.instr(bare, "--")
    return F.when(at > 1, F.trim(F.substring(bare, at + 2, F.length(bare)))).otherwise("")


def file_id(path: Column, modified: Column) -> Column:
    """128 bits of path and time as hexadecimal text: the same file always gets the same id."""
    return F.md5(F.concat_ws("|", path.cast("string"), modified.cast("string")))


def add_file_id(name: Column, new_id: Column) -> Column:
    return F.trim(F.concat(strip_file_id(name), F.lit("--"), new_id, extension(name)))


def add_id_and_header_type(name: Column, new_id: Column, header_type: Column) -> Column:
    """``id--N--name``, the form from which :func:`header_type_from_name` reads the type."""
    pairs = [F.lit(x) for t, n in HEADER_TYPES.items() for x in (t, str(n))]
    number = F.coalesce(F.create_map(*pairs)[header_type], F.lit(str(HEADER_TYPES["NotApplicable"])))
    return F.trim(F.concat_ws("--", new_id, number, base_name(name)))


def ftp_file_name(name: Column, max_len: int = 60) -> Column:
    """The name cut to the length the transfer allows, extension kept."""
    return F.concat(F.left(without_extension(name), F.lit(max_len - 4)), extension(name))


def uniform_name(
    source: Column, platform: Column, client: Column, record_type: Column, date: Column, size: Column
) -> Column:
    """``[TEST_]client_recordtype_platform_date.ext``; empty files keep their name."""
    marker = F.when(is_test_file(source), "TEST_").otherwise("")
    code = F.when(platform == "A", "AL").when(platform == "C", "CO").otherwise("UNKNOWN")
    named = F.concat(
        marker,
        F.concat_ws(
            "_",
            F.coalesce(T.blank_to_null(client), F.lit("UNKNOWN")),
            F.coalesce(T.blank_to_null(record_type), F.lit("XX")),
            code,
            F.date_format(date, "yyyyMMdd"),
        ),
        extension(source),
    )
    empty = F.concat(marker, F.lit("EMPTY_"), base_name(source))
    return T.file_name_clean(F.when(is_empty_file(size), empty).otherwise(named))


def naming_facts(
    lines: DataFrame, platform_col: str = "platform", file_col: str = "file", order: str = "source_row_no",
    line_col: str = "line", client_prefix: str = "BEN",
) -> DataFrame:
    """Per file: client and record type from its first qualifying row."""
    line = F.col(line_col)
    values = split_csv(line)
    value = lambda n: F.trim(F.try_element_at(values, F.lit(n)))
    first = F.upper(value(1))
    is_a = (F.col(platform_col) == "A") & first.rlike("^I[^A]$")
    is_member = (F.col(platform_col) == "C") & first.isin("[QB]", "[SPM]")
    is_npm = (F.col(platform_col) == "C") & (first == "[NPM]")
    client = (
        F.when(is_a & F.upper(value(3)).startswith(client_prefix), value(3))
        .when(is_a, "UNKNOWN")
        .when(is_member, value(2))
        .when(is_npm, value(4))
    )
    at = F.when(is_a | is_member | is_npm, F.col(order))
    kind = F.regexp_replace(first, r"[\[\]]", "")
    return lines.groupBy(file_col).agg(
        F.min_by(client, at).alias("client"),
        F.min_by(F.when(at.isNotNull(), kind), at).alias("record_type"),
    )


def destination(platform: Column, outcome: Column, test: Column, empty: Column) -> Column:
    """Where a file goes: empty, test, passed, rejects or holding, below its platform."""
    area = (
        F.when(empty, "empty")
        .when(platform == "Unknown", "holding")
        .when(outcome.isNull(), "holding")
        .when(test, "test")
        .when(outcome == "Ok", "passed")
        .otherwise("rejects")
    )
    return F.concat_ws("/", F.lower(platform), area)
