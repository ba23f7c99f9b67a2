"""Result files: clean-up, error texts, reconciliation with what was sent, the error queue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..session import stage
from .lookups import one_per_key
from .merge import clear_result_headers, default_sent_name

def sent_name(text: Column) -> Column:
    """The first piece between commas or quotes that holds a file ending, up to that ending; blank if none does.

    Cut at the first ending by positions, which a long text without any costs one scan.
    """
    small = F.translate(text, "MBICSV", "mbicsv")
    ends = [F.position(F.lit(e), small) for e in (".mbi", ".csv")]
    first = F.least(*[F.when(e > 0, e) for e in ends])
    head = F.left(F.translate(text, '"', ","), first + 3)
    # Few rows hold a file ending; only these are cut.
    named = small.contains(".mbi") | small.contains(".csv")
    return F.when(named, F.trim(F.substring_index(head, ",", -1))).otherwise("")


def sent_file_names(rows: DataFrame, result_file: str = "result_file", order: str = "source_row_no",
                    row_col: str = "error_row") -> DataFrame:
    """Per result file the sent-file name in its first row that holds one."""
    name = sent_name(F.col(row_col))
    at = F.when(name != "", F.col(order))
    return rows.groupBy(result_file).agg(F.min_by(name, at).alias("sent_file"))


def with_sent_file(rows: DataFrame, result_file: str = "result_file", order: str = "source_row_no",
                   row_col: str = "error_row") -> DataFrame:
    """Add the sent-file name of each result file to all its rows; default to the result name.

    The names, one row per file, are staged, so that Spark joins them by their true size and does not
    deal the rows of large files by file.
    """
    names = sent_file_names(rows, result_file, order, row_col)
    names = stage(names.withColumnRenamed(result_file, "_rf"), "sent-names")
    joined = rows.drop("sent_file").join(names, F.col(result_file) == F.col("_rf"), "left").drop("_rf")
    return default_sent_name(joined, "sent_file", result_file)


def with_error_texts(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Take the text of a known error code from the catalogue where the row has none.

    The texts are staged like the sent names, since few codes stand in most rows.
    """
    known = one_per_key(codes, {"_code": F.col("error_code")}, F.min("user_desc").alias("error_message_calc"))
    known = stage(known, "error-texts")
    joined = rows.join(known, rows["error_code"] == known["_code"], "left").drop("_code")
    message = F.coalesce(T.blank_to_null(F.col("error_message")), F.col("error_message_calc"))
    return joined.withColumn("error_message", message)


def clean_results(rows: DataFrame, codes: DataFrame) -> DataFrame:
    """Staged result rows made ready to store: names, cleared headers, error texts."""
    return with_error_texts(clear_result_headers(with_sent_file(rows)), codes)


def is_error_code(code: Column) -> Column:
    """A numeric code that sorts after ``0`` as text."""
    return code.try_cast("double").isNotNull() & (code > "0")


def result_errors(results: DataFrame) -> DataFrame:
    return results.where(F.coalesce(is_error_code(F.col("error_code")), F.lit(False)))


def errors_with_sent(errors: DataFrame, sent: DataFrame) -> DataFrame:
    """Errors with the sent row of the same file and row number, where there is one."""
    side = sent.select(
        F.col("file").alias("_f"), F.col("row_num").alias("sent_row_num"), F.col("data_row").alias("sent_line")
    )
    cond = (errors["sent_file"] == side["_f"]) & (errors["row_num"] == side["sent_row_num"])
    return errors.join(side, cond, "left").drop("_f").withColumnRenamed("row_num", "error_row_num")


def errors_with_sent_by_member(errors: DataFrame, sent: DataFrame) -> DataFrame:
    """As :func:`errors_with_sent`, matched by employer, employee and dependent."""
    side = sent.select(
        F.col("file").alias("_f"), F.col("EmployerId").alias("_er"), F.col("EmployeeID").alias("_ee"),
        F.col("DependentID").alias("_dep"), F.col("row_num").alias("sent_row_num"),
        F.col("data_row").alias("sent_line"),
    )
    cond = (
        (errors["sent_file"] == side["_f"]) & (errors["EmployerId"] == side["_er"])
        & (errors["EmployeeID"] == side["_ee"]) & (errors["DependentID"] == side["_dep"])
    )
    return errors.join(side, cond, "left").drop("_f", "_er", "_ee", "_dep").withColumnRenamed(
        "row_num", "error_row_num"
    )


def manager_list(managers: DataFrame) -> DataFrame:
    return managers.select("bencode", "crm", "crm_email").distinct()


def with_manager(rows: DataFrame, managers: DataFrame, client: str = "EmployerId", unique: bool = False) -> DataFrame:
    """Distinct error rows with the account manager of their client.

    Rows of stored results are ``unique`` by file and number, so that wide rows need not be compared.
    """
    side = manager_list(managers).withColumnRenamed("bencode", "_client")
    joined = rows.join(side, rows[client] == side["_client"], "left").drop("_client")
    return joined if unique else joined.distinct()


def distinct_messages(errors: DataFrame) -> DataFrame:
    return errors.select("error_message").distinct()


def files_with_errors(errors: DataFrame) -> DataFrame:
    return errors.select("sent_file").distinct()


def results_without_sent(results: DataFrame, sent: DataFrame) -> DataFrame:
    """Sent-file names of results for which no sent file is stored."""
    names = results.where(F.col("sent_file").isNotNull()).select("sent_file").distinct()
    return names.join(sent.select(F.col("file").alias("sent_file")), "sent_file", "left_anti")


def sent_without_results(sent: DataFrame, results: DataFrame) -> DataFrame:
    """Sent files for which no result came back."""
    names = sent.select(F.col("file").alias("sent_file")).distinct()
    return names.join(results.select("sent_file"), "sent_file", "left_anti")


# --- the error queue -----------------------------------------------------------------------


def new_tracked_codes(errors: DataFrame, tracked: DataFrame) -> DataFrame:
    """Codes with their texts that are not tracked yet, with the flags they start with."""
    fresh = errors.join(tracked.select("error_code"), "error_code", "left_anti")
    return fresh.select(
        "error_code", "error_message", F.lit(False).alias("crm"), F.lit(True).alias("processing"),
        F.lit(True).alias("control"),
    ).distinct()


def new_queue_rows(errors: DataFrame, tracked: DataFrame, queue: DataFrame) -> DataFrame:
    """Errors of tracked codes that are not in the queue by (sent file, error row number)."""
    known = errors.join(tracked.select("error_code"), "error_code", "left_semi")
    present = queue.select(F.col("sent_file").alias("_f"), F.col("error_row_num").alias("_n"))
    absent = known.join(
        present, (known["sent_file"] == present["_f"]) & (known["error_row_num"] == present["_n"]), "left_anti"
    )
    flags = {c: F.lit(False) for c in ("crm_check", "proc_check", "archive_check")}
    return absent.distinct().withColumns(flags)


def update_queue_managers(queue: DataFrame, managers: DataFrame, client: str = "EmployerId") -> DataFrame:
    """The manager of each queue row from the list, without doubled quotes; kept where unknown."""
    named = managers.groupBy(F.col("bencode").alias("_client")).agg(F.min("crm").alias("_crm"))
    joined = queue.join(named, queue[client] == named["_client"], "left")
    cleaned = F.replace("_crm", F.lit('""'), F.lit(""))
    return joined.withColumn("crm", F.coalesce(cleaned, F.col("crm"))).drop("_client", "_crm")


def track_new_errors(
    errors: DataFrame, tracked: DataFrame, queue: DataFrame, managers: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Tracked codes and queue after the errors were taken in, in that order."""
    codes = tracked.unionByName(new_tracked_codes(errors, tracked))
    rows = new_queue_rows(errors, codes, queue)
    merged = queue.unionByName(rows, allowMissingColumns=True)
    return codes, update_queue_managers(merged, managers)


# --- clients in rows -----------------------------------------------------------------------


#: The length of the pieces that lead from texts to codes. Shorter codes are looked up as a whole.
GRAM = 4


def _grams(text: Column, size: Column | int) -> Column:
    """The different pieces of a length in a text."""
    size = F.lit(size) if isinstance(size, int) else size
    last = F.length(text) - size + 1
    cut = F.transform(F.sequence(F.lit(1), last), lambda i: F.substring(text, i, size))
    return F.when(last >= 1, F.array_distinct(cut)).otherwise(F.array().cast("array<string>"))


def rows_with_codes(
    rows: DataFrame, text_col: str, codes: DataFrame, code_col: str, after_first: bool = True, sample: int = 100_000
) -> DataFrame:
    """Pairs of rows and codes where the text contains the code (not at its very start).

    An equi-join on pieces of :data:`GRAM` characters: a code stands under the one of its pieces that is
    rarest among the texts, a row under each of its different pieces, and what meets is tested. A row
    gives its pieces once, however many lengths the codes have; codes shorter than a piece add their few
    lengths, which are read when the plan is made. The rarest piece is that of the first ``sample`` rows,
    which decides how many pairs are tested, not which are found.
    """
    keyed = codes.select(code_col).where(T.text(code_col) != "").distinct()
    sized = keyed.withColumn("_size", F.least(F.length(code_col), F.lit(GRAM)))
    sizes = sorted(r[0] for r in sized.select("_size").distinct().collect())
    if not sizes:
        return rows.withColumn(code_col, F.lit(None).cast("string")).where(F.lit(False))
    pieces = F.concat(*[_grams(F.col(text_col), n) for n in sizes])
    seen = rows.select(F.col(text_col)).limit(sample).select(F.explode(pieces).alias("_piece"))
    counts = seen.groupBy("_piece").agg(F.count("*").alias("_n"))
    own = sized.select(code_col, F.explode(_grams(F.col(code_col), F.col("_size"))).alias("_piece"))
    ranked = own.join(counts, "_piece", "left")
    rarest = F.min_by("_piece", F.struct(F.coalesce("_n", F.lit(0)), "_piece")).alias("_piece")
    placed = ranked.groupBy(code_col).agg(rarest)
    met = rows.select("*", F.explode(pieces).alias("_piece")).join(placed, "_piece").select(*rows.columns, code_col)
    return met.where(F.position(F.col(code_col), F.col(text_col)) > (1 if after_first else 0))
