"""From lines to checked rows: classify, parse, validate, look up, split, log."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import classify as K
from ..operators import export, lookups, merge, rules
from ..operators.parse import parse_by_layout
from ..session import compile_methods, spread, stage
from ..spec import platform_a_layouts, platform_c_layouts


@dataclass(frozen=True)
class MastersA:
    employers: DataFrame
    employees: DataFrame
    employer_plans: DataFrame
    employee_plans: DataFrame


@dataclass(frozen=True)
class MastersC:
    clients: DataFrame
    divisions: DataFrame
    members: dict[str, DataFrame]
    plans: DataFrame
    plan_links: DataFrame


@dataclass(frozen=True)
class CheckOptions:
    tpa_id: str = "TPA01"
    require_tpa: bool = False
    check_optional_lists: bool = False
    last_error_only: bool = False
    fail_if_member_exists: bool = False
    notices: tuple[str, ...] = K.NOTICES
    # Write the validated rows once and run the look-ups on that table.
    staged: bool = True
    extra: dict = field(default_factory=dict)


def file_order(lines: DataFrame) -> Column:
    """Files in order of arrival, then of name; never of tasks."""
    arrived = F.unix_micros("modified") if "modified" in lines.columns else F.lit(0).cast("bigint")
    return F.struct(arrived.alias("arrived"), F.col("file").alias("name"))


def wrong_layout_files(header_types: DataFrame) -> DataFrame:
    """Files with a record type whose column count fits no layout, with the reason."""
    text = F.concat(
        F.lit("Could not determine the header type: "), F.col("code"), F.lit(" rows have "),
        F.col("columns").cast("string"), F.lit(" columns"),
    )
    bad = header_types.where(~F.col("fits"))
    return bad.groupBy("file").agg(F.min(text).alias("reason")).withColumn("platform", F.lit("A"))


def validate_a(lines: DataFrame, options: CheckOptions = CheckOptions()) -> tuple[DataFrame, DataFrame]:
    """Numbered lines of platform A files as validated rows, and the files with a wrong layout.

    The lines are read twice: once for the header types, which are one row per file and record
    type, and once for the rows. Numbered lines that come straight from text are worth a stage.
    """
    compile_methods(lines.sparkSession)
    found = K.header_types(lines)
    if options.staged:
        found = stage(found, "header-types")
    wrong = wrong_layout_files(found)
    if options.staged:
        wrong = stage(wrong, "wrong-layouts")
    kept = lines.where(K.is_a_import_line(F.col("line"), options.notices) | K.is_a_header_line(F.col("line")))
    # Few bytes of compressed lines are much work; the files' splits say little about it.
    good = spread(kept.join(wrong.select("file"), "file", "left_anti"))
    coded = good.withColumn("code", K.a_code(F.col("line")))
    per_code = found.select("file", "code", "header_type")
    layouts = {f"{c}/{h}": s for (c, h), s in platform_a_layouts(options.tpa_id).items() if c.startswith("I")}
    keyed = coded.join(per_code, ["file", "code"], "left").withColumn("file_seq", file_order(lines))
    key = F.when(F.col("code").startswith("I") & (F.col("code") != "IA"), F.concat_ws("/", "code", "header_type"))
    parsed = parse_by_layout(keyed, layouts, key)
    checked = rules.apply_rules_by_layout(
        parsed, layouts, rules.RuleOptions("A", options.check_optional_lists)
    )
    unknown = F.when(
        F.col("code").isNull(),
        rules.error(
            "Invalid Record Type",
            F.concat(F.lit("Record Type '"), F.coalesce("row_type", F.lit("")), F.lit("' is invalid")),
        ),
    )
    return rules.add_error(checked, unknown), wrong


def check_a(
    lines: DataFrame, masters: MastersA, history: DataFrame | None = None, options: CheckOptions = CheckOptions()
) -> tuple[DataFrame, DataFrame]:
    """Checked rows of platform A files, ready to store, and the files with a wrong layout."""
    hold = stage if options.staged else _as_is
    validated, wrong = validate_a(lines, options)
    validated = hold(validated, "a-rows")
    found = lookups.lookup_errors_a(
        validated, masters.employers, masters.employees, masters.employer_plans, masters.employee_plans,
        options.tpa_id, options.require_tpa, history, hold,
    )
    return _storable(lookups.attach_errors(validated, found), options), wrong


def _as_is(df: DataFrame, label: str) -> DataFrame:
    return df


def validate_c(lines: DataFrame, options: CheckOptions = CheckOptions()) -> DataFrame:
    """Numbered lines of platform C files as validated rows."""
    compile_methods(lines.sparkSession)
    layouts = platform_c_layouts()
    code = K.c_record_type(F.col("line"))
    coded = spread(lines.where(F.trim("line") != "")).withColumns({"code": code, "file_seq": file_order(lines)})
    parsed = parse_by_layout(coded, layouts, F.when(K.is_c_layout(F.col("code")), F.col("code")))
    parsed = parsed.withColumn("row_type", F.col("code"))
    checked = rules.apply_rules_by_layout(
        parsed, layouts, rules.RuleOptions("C", options.check_optional_lists)
    )
    unknown = F.when(
        F.col("layout").isNull(),
        rules.error(
            "Invalid Record Type", F.concat(F.lit("Record Type '"), F.col("code"), F.lit("' is invalid"))
        ),
    )
    return rules.add_error(checked, unknown)


def check_c(lines: DataFrame, masters: MastersC, options: CheckOptions = CheckOptions()) -> DataFrame:
    """Checked rows of platform C files, ready to store."""
    hold = stage if options.staged else _as_is
    validated = hold(validate_c(lines, options), "c-rows")
    found = lookups.lookup_errors_c(
        validated, masters.clients, masters.divisions, masters.members, masters.plans, masters.plan_links,
        options.fail_if_member_exists, hold,
    )
    return _storable(lookups.attach_errors(validated, found), options)


def _storable(rows: DataFrame, options: CheckOptions) -> DataFrame:
    flat = rules.flatten_errors(rows, last_only=options.last_error_only)
    return merge.mark_check(merge.keep_original(flat)).withColumn("created_at", F.current_timestamp())


def outcomes(rows: DataFrame, wrong: DataFrame | None = None) -> DataFrame:
    """Per file: rows, rows with errors, outcome and code. Files with a wrong layout fail as a whole."""
    counted = rules.file_outcomes(rows)
    if wrong is None:
        return counted
    zero = F.lit(0).cast("bigint")
    failed = wrong.select(
        "file", zero.alias("row_count"), zero.alias("error_rows"), F.lit("CompleteFail").alias("outcome"),
        F.lit(rules.OUTCOMES["Error"]).alias("outcome_code"),
    )
    return counted.unionByName(failed)


def run_reports(results: DataFrame) -> DataFrame:
    """One JSON text per file, for whoever waits for the outcome."""
    body = F.struct("file", "outcome", F.col("outcome_code").alias("code"), "row_count", "error_rows")
    return results.select("file", F.to_json(body).alias("report"))


def deliver(rows: DataFrame, platform: str, batch_id: Column | None = None) -> DataFrame:
    """Output lines of checked files: ``out_file, row_no, file_row``.

    Pass stored rows: they are read for the outcomes, for the header counts and for the lines. The
    outcomes, one row per file, are staged, so that Spark joins them by their true size and does
    not shuffle the lines of large files by name.
    """
    results = stage(outcomes(rows), "outcomes")
    chosen = export.outputs_of_files(rows, results, batch_id, platform=platform)
    name = export.output_name(K.base_name(F.col("file")), F.col("split"), F.lit(platform))
    plain = F.when(F.col("outcome") == "Ok", K.base_name(F.col("file"))).otherwise(name)
    return chosen.select(plain.alias("out_file"), "row_no", "file_row")


def route(files: DataFrame, facts: DataFrame, results: DataFrame) -> DataFrame:
    """Files with platform and destination. ``files``: ``file, size``; ``results`` from :func:`outcomes`."""
    joined = files.join(facts.select("file", "platform"), "file", "left").join(
        results.select("file", "outcome", "outcome_code"), "file", "left"
    )
    platform = F.coalesce("platform", F.lit("Unknown"))
    place = K.destination(platform, F.col("outcome"), K.is_test_file(F.col("file")), K.is_empty_file(F.col("size")))
    return joined.withColumns({"platform": platform, "destination": place})


def prepare_headers(
    lines: DataFrame, templates: dict[str, str], notices: tuple[str, ...] = K.NOTICES
) -> DataFrame:
    """The header step: keep import lines, find each file's header type, put the standard header on top.

    The type is that of the first line that decides. The table of types, one row per file, is
    staged, so that Spark joins the lines to it by its true size.
    """
    kinds = stage(K.file_header_types(lines), "file-header-types")
    line = F.col("line")
    kept = lines.where(K.is_a_import_line(line, notices) | K.is_a_header_line(line))
    return export.add_standard_header(kept, kinds, templates)
