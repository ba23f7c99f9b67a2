"""Outputs of a checked file: standard headers, the five splits and their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.values import FALSE_WORDS, TRUE_WORDS
from ..spec import platform_c_layouts
from .classify import c_record_type
from .parse import split_csv

# The splits of a file in order, and the ending of each output name.
SPLITS = {
    "original_file": ("-0-OriginalFile", True),
    "passed_lines": ("-1-PassedLines", True),
    "rejected_lines_with_errors": ("-2-RejectedLines.err", False),
    "rejected_lines": ("-3-RejectedLines", True),
    "all_lines_with_errors": ("-4-allLines.err", False),
}
PLATFORM_EXTENSION = {"A": ".mbi", "C": ".csv"}
COUNT_MARK = "XX"


def standard_headers(header_type: Column, templates: dict[str, str]) -> Column:
    """The header line for a header type; types without a template keep their own header.

    A file of segmented funding takes the template of the new layout.
    """
    header_type = F.when(header_type == "SegmentedFunding", "New").otherwise(header_type)
    value = None
    for kind, line in templates.items():
        value = F.when(header_type == kind, F.lit(line)) if value is None else value.when(header_type == kind, F.lit(line))
    return value


def add_standard_header(
    lines: DataFrame, files: DataFrame, templates: dict[str, str], file_col: str = "file",
    order: str = "source_row_no", line_col: str = "line",
) -> DataFrame:
    """Replace the incoming header of each file by the template of its header type.

    ``files`` holds ``file`` and ``header_type``, best as a stored table, which Spark joins by its
    size. Files without a template (Own, None) pass through.
    The count mark of the template stays, because each split has its own count.
    """
    header = files.select(F.col(file_col), standard_headers(F.col("header_type"), templates).alias("_header"))
    joined = lines.join(header, file_col, "left")
    old = F.left(F.ltrim(F.col(line_col)), F.lit(3)) == "IA,"
    body = joined.where(F.col("_header").isNull() | ~old).select(file_col, order, line_col)
    heads = header.where(F.col("_header").isNotNull()).select(
        file_col, F.lit(0).cast(lines.schema[order].dataType).alias(order), F.col("_header").alias(line_col)
    )
    return heads.unionByName(body)


def _is_header(platform: str) -> Column:
    code = F.upper(F.coalesce("row_type", F.lit("")))
    return code == ("IA" if platform == "A" else "[VERSION]")


def split_rows(rows: DataFrame, file_col: str = "file", order: str = "source_row_no", platform: str = "A") -> DataFrame:
    """Each checked row under every split it belongs to: ``file, split, row_no, file_row``.

    ``rows`` hold ``row_type, data_row, org_data_row, error_message``. Header rows are left out;
    they are added per split by :func:`split_headers`. Rows with an ``outcome`` give the splits
    that are delivered for it: a passed file its passed lines, any other file all five. One narrow
    pass, no shuffle.
    """
    every = F.lit(True) if "outcome" not in rows.columns else F.coalesce(F.col("outcome") != "Ok", F.lit(True))
    message = T.text("error_message")
    bad = message != ""
    data, org = F.trim(T.text("data_row")), F.trim(T.text("org_data_row"))
    note = F.trim(F.concat(data, F.lit(","), F.when(bad, F.concat(F.lit("Warning: "), message)).otherwise("OK")))

    def entry(name: str, text: Column) -> Column:
        return F.struct(F.lit(name).alias("split"), text.alias("file_row"))

    entries = F.array_compact(
        F.array(
            F.when(every, entry("original_file", org)),
            F.when(~bad, entry("passed_lines", data)),
            F.when(every & bad, entry("rejected_lines_with_errors", note)),
            F.when(every & bad, entry("rejected_lines", data)),
            F.when(every, entry("all_lines_with_errors", note)),
        )
    )
    body = rows.where(~_is_header("A")) if platform == "A" else rows
    return body.select(file_col, F.col(order).alias("row_no"), F.explode(entries).alias("_e")).select(
        file_col, "_e.split", "row_no", "_e.file_row"
    )


def split_headers(
    rows: DataFrame, batch_id: Column | None = None, file_col: str = "file", order: str = "source_row_no"
) -> DataFrame:
    """The header row of each (file, split) with the split's own row count in place of the mark."""
    message = T.text("error_message")
    body = ~_is_header("A")
    counts = rows.groupBy(file_col).agg(
        F.count_if(body).alias("_all"),
        F.count_if(body & (message == "")).alias("_good"),
        F.min_by(F.when(~body, F.trim("data_row")), F.when(~body, F.col(order))).alias("_header"),
        F.min(F.when(~body, F.col(order))).alias("row_no"),
    )
    per_split = F.array(
        *[
            F.struct(F.lit(name).alias("split"), size.alias("n"))
            for name, size in (
                ("original_file", F.col("_all")),
                ("passed_lines", F.col("_good")),
                ("rejected_lines_with_errors", F.col("_all") - F.col("_good")),
                ("rejected_lines", F.col("_all") - F.col("_good")),
                ("all_lines_with_errors", F.col("_all")),
            )
        ]
    )
    batch_id = F.lit("") if batch_id is None else batch_id.cast("string")
    exploded = counts.where(F.col("_header").isNotNull()).select(
        file_col, "row_no", "_header", F.explode(per_split).alias("_e")
    )
    line = F.replace(F.concat(F.col("_header"), F.lit(","), batch_id), F.lit(COUNT_MARK), F.col("_e.n").cast("string"))
    return exploded.select(file_col, "_e.split", "row_no", line.alias("file_row"))


def export_splits(
    rows: DataFrame, batch_id: Column | None = None, file_col: str = "file", order: str = "source_row_no",
    platform: str = "A",
) -> DataFrame:
    """All output lines of all files with header rows; order by ``file, split, row_no``."""
    body = split_rows(rows, file_col, order, platform)
    return split_headers(rows, batch_id, file_col, order).unionByName(body) if platform == "A" else body


def output_name(file_name: Column, split: Column, platform: Column) -> Column:
    """The name of an output file: the source name and the ending of its split."""
    pairs = [F.lit(x) for name, (ending, _) in SPLITS.items() for x in (name, ending)]
    typed = [F.lit(x) for name, (_, ext) in SPLITS.items() for x in (name, ext)]
    ext = F.when(F.create_map(*typed)[split], F.create_map(*[F.lit(x) for p in PLATFORM_EXTENSION.items() for x in p])[platform])
    return F.concat(file_name, F.create_map(*pairs)[split], F.coalesce(ext, F.lit("")))


def outputs_of_files(
    rows: DataFrame, outcomes: DataFrame, batch_id: Column | None = None, file_col: str = "file",
    order: str = "source_row_no", platform: str = "A",
) -> DataFrame:
    """The output lines that are delivered, with the ``outcome`` of their file: a passed file gives
    its passed lines only, others all five splits.

    The outcome is joined to the rows before they are put under splits, so lines that nobody gets
    are never made. ``outcomes``, one row per file, is best a stored table.
    """
    results = outcomes.select(file_col, "outcome")
    body = split_rows(rows.join(results, file_col), file_col, order, platform)
    if platform == "A":
        heads = split_headers(rows, batch_id, file_col, order).join(results, file_col)
        heads = heads.where((F.col("outcome") != "Ok") | (F.col("split") == "passed_lines")).drop("outcome")
        body = heads.unionByName(body)
    return body.join(results, file_col)


def return_texts(splits: DataFrame) -> DataFrame:
    """What the check of a single file returns: all its lines with errors, in order of ``row_no``."""
    return splits.where(F.col("split") == "all_lines_with_errors")


def prepare_c_flags(lines: DataFrame, positions: dict[str, list[int]], line_col: str = "line") -> DataFrame:
    """Rewrite boolean words of platform C lines as 1 and 0 before the check.

    ``positions`` gives, per bracket code, the value positions (the code is 0) that are flags.
    """
    pairs = [x for code, at in positions.items() for x in (F.lit(code), F.array(*[F.lit(p) for p in at]))]
    marks = F.create_map(*pairs)[c_record_type(F.col(line_col))]

    def rebuild(one: Column) -> Column:
        def fix(value: Column, at: Column) -> Column:
            word = F.upper(F.trim(value))
            flag = F.when(word.isin(*TRUE_WORDS), "1").when(word.isin(*FALSE_WORDS), "0").otherwise(value)
            return F.when(F.array_contains(one["marks"], at), flag).otherwise(value)

        return F.array_join(F.transform(one["values"], fix), ",")

    # Through an array of one, so that the marks are looked up once for a line and not for each value.
    whole = F.array(F.struct(split_csv(F.col(line_col)).alias("values"), marks.alias("marks")))
    rebuilt = F.transform(whole, rebuild)[0]
    return lines.withColumn(line_col, F.when(marks.isNotNull(), rebuilt).otherwise(F.col(line_col)))


def c_flag_positions() -> dict[str, list[int]]:
    found = {
        code: [i + 1 for i, f in enumerate(spec.fields) if f.kind in ("flag", "yesno", "truefalse")]
        for code, spec in platform_c_layouts().items()
    }
    return {code: places for code, places in found.items() if places}
