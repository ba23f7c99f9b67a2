"""Result files: load, clean, and what follows from them."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import classify as K
from ..operators import merge, results
from ..operators.parse import parse_by_layout
from ..spec import parse_field, platform_a_layouts, platform_c_layouts


def load_results(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Numbered lines of result files as cleaned rows, all record types in one pass.

    Each row keeps its text (``error_row``), its file and number, the sent file of its result file,
    and the error code with its text. Lines that are no result lines are left out.
    """
    line = F.col("line")
    kept = lines.where(K.is_result_record_line(line) | K.is_result_header_line(line))
    layouts = {code: spec for (code, _), spec in platform_a_layouts().items() if code.startswith("R")}
    code = K.a_code(line)
    parsed = parse_by_layout(kept, layouts, F.when(code.isin(*layouts), code))
    return _cleaned(parsed, codes)


def _cleaned(parsed: DataFrame, codes: DataFrame) -> DataFrame:
    line = F.col("line")
    rows = parsed.withColumns(
        {
            "result_file": K.base_name(F.col("file")),
            "error_row": line,
            "org_error_row": line,
            "row_num": F.col("source_row_no"),
            "error_code": F.trim("error_code"),
        }
    )
    return results.clean_results(rows, codes)


#: Commas that exports of platform C leave at the end of lines.
SPARE_COMMAS = "," * 20


def load_results_c(lines: DataFrame, codes: DataFrame) -> DataFrame:
    """Numbered lines of platform C result files as cleaned rows, all record types in one pass.

    A result line is the line that was sent, of any bracket layout, with an error code and a text behind
    its fields. Like :func:`load_results`: each row keeps its text, file and number, the sent file named in
    its result file, and the error code with its text; the version row is the header and has no error.
    """
    answer = tuple(parse_field(f"{name}:text") for name in ("error_code", "error_message"))
    layouts = {code: replace(spec, fields=spec.fields + answer) for code, spec in platform_c_layouts().items()}
    line = F.replace("line", F.lit(SPARE_COMMAS), F.lit(""))
    kept = lines.where(F.trim("line") != "").withColumn("line", line)
    code = K.c_record_type(F.col("line"))
    parsed = parse_by_layout(kept, layouts, F.when(K.is_c_layout(code), code))
    return _cleaned(parsed.withColumn("row_type", code), codes)


RESULT_KEY = ["result_file", "row_num"]


def store_results(spark: SparkSession, path: str, loaded: DataFrame) -> int:
    """Store loaded results, one row per result file and row number; returns the number of the upsert.

    A result file that comes again replaces its rows. Of two files of one name in different
    folders the rows of the last folder by name are kept.
    """
    return merge.upsert_table(spark, path, loaded, RESULT_KEY, F.col("file"))


def error_report(
    loaded: DataFrame, sent: DataFrame, managers: DataFrame, client: str = "EmployerId", unique: bool = False
) -> DataFrame:
    """Errors of loaded results with the sent row and the account manager, each once. Results and sent rows
    that come from stored tables are ``unique``."""
    columns = [
        "sent_file", "result_file", "row_type", "error_row", "error_code", "error_message", "EmployerId", "EmployeeID",
        "DependentID", "PlanId", "row_num",
    ]
    errors = results.result_errors(loaded).select(*columns)
    return results.with_manager(results.errors_with_sent(errors, sent), managers, client, unique)
