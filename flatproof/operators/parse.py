"""Lines to columns: delimited parsing by layout and splits to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..spec import RecordSpec

CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE"}
#: A line with more separators than this is cut to its layout's fields before it is parsed.
MANY_FIELDS = 10_000
# Stand-ins while a line is split: in texts the first is always followed by the third, in marks by the second.
_ESCAPE, _CUT, _OWN = "\x01", "\x02", "\x03"


def csv_fields(line: Column, width: int) -> Column:
    """A struct ``c0..cN`` of the first ``width`` values; missing ones are NULL.

    The parser refuses lines with very many fields, so such a line is first cut to those that are asked for.
    """
    schema = ", ".join(f"c{i} string" for i in range(width))
    short = F.when(F.length(line) <= MANY_FIELDS, line).when(
        _count(line, ",") > MANY_FIELDS, F.array_join(F.slice(split_csv(line), 1, width), ",")
    ).otherwise(line)
    return F.from_csv(short, F.lit(schema), CSV_OPTIONS)


def _count(text: Column, char: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))


def split_csv(line: Column) -> Column:
    """All values of a line as an array, quotes kept. A comma separates if an even number of quotes follows it.

    The line is taken apart at its quotes, and commas count in every other piece from the last one on. The work is in
    proportion to the line, however long or badly quoted.
    """
    pieces = F.split(F.replace(line, F.lit(_ESCAPE), F.lit(_ESCAPE + _OWN)), '"')

    def mark(whole: Column) -> Column:
        def piece(text: Column, at: Column) -> Column:
            return F.when((whole["last"] - at) % 2 == 0, F.replace(text, F.lit(","), F.lit(_ESCAPE + _CUT))).otherwise(text)

        return F.transform(whole["pieces"], piece)

    # Through an array of one, so that the line is taken apart once and not again for each piece.
    one = F.array(F.struct(pieces.alias("pieces"), (_count(line, '"')).alias("last")))
    marked = F.transform(one, mark)[0]
    values = F.split(F.array_join(marked, '"'), _ESCAPE + _CUT)
    restored = F.when(
        line.contains(_ESCAPE), F.transform(values, lambda v: F.replace(v, F.lit(_ESCAPE + _OWN), F.lit(_ESCAPE)))
    ).otherwise(values)
    return F.when(line.contains('"'), restored).otherwise(F.split(line, ","))


def column_count(line: Column) -> Column:
    """The number of values that :func:`split_csv` gives. Read backwards, quoted parts are closed by the next quote or
    by the start of the line, and the commas outside them separate."""
    outside = F.regexp_replace(F.reverse(line), r'"[^"]*("|\z)', "")
    return F.when(line.contains('"'), _count(outside, ",") + 1).otherwise(_count(line, ",") + 1)


def first_field(line: Column) -> Column:
    """The first value, a quoted one without its outer quotes (doubled ones stay). Quotes are told apart by pairing them
    from the left: the first one without a partner closes the value, or else the last pair does."""
    rest = F.substring(line, 2, 2**31 - 1)
    paired = F.replace(rest, F.lit('""'), F.lit("  "))
    close, from_end = F.position(F.lit('"'), paired), F.position(F.lit('"'), F.reverse(rest))
    quoted = (
        F.when(close > 0, F.left(rest, close - 1))
        .when(from_end > 0, F.left(rest, F.length(rest) - from_end - 1))
        .otherwise("")
    )
    return F.when(line.startswith('"'), quoted).otherwise(F.substring_index(line, ",", 1))


def parse_record(lines: DataFrame, spec: RecordSpec, line_col: str = "line") -> DataFrame:
    """Lines of one record type as named text columns.

    Keeps the input columns, and adds ``row_type``, the fields, ``org_data_row`` and ``data_row``.
    """
    parsed = lines.withColumn("_csv", csv_fields(F.col(line_col), spec.width))
    fields = [F.col("_csv")[f"c{i + 1}"].alias(n) for i, n in enumerate(spec.names)]
    return parsed.select(
        *lines.columns,
        F.col("_csv")["c0"].alias("row_type"),
        *fields,
        F.col(line_col).alias("org_data_row"),
        F.col(line_col).alias("data_row"),
    )


def parse_by_layout(
    lines: DataFrame, layouts: Mapping[str, RecordSpec], key: Column, line_col: str = "line"
) -> DataFrame:
    """Lines of many record types in one pass, as one wide sparse row each.

    ``key`` tells the layout of a line. A logical field sits at a different position in each
    layout, so each output column picks its position by the key.
    """
    width = max(spec.width for spec in layouts.values())
    parsed = lines.withColumns({"_csv": csv_fields(F.col(line_col), width), "layout": key})
    positions: dict[str, dict[int, list[str]]] = {}
    for layout_key, spec in layouts.items():
        for i, name in enumerate(spec.names):
            positions.setdefault(name, {}).setdefault(i + 1, []).append(layout_key)
    columns = []
    for name, places in positions.items():
        whens = [
            f"when layout in ({', '.join(repr(k) for k in keys)}) then _csv.c{position}"
            for position, keys in sorted(places.items())
        ]
        columns.append(f"case {' '.join(whens)} end as `{name}`")
    return parsed.selectExpr(
        *[f"`{c}`" for c in lines.columns],
        "layout",
        "_csv.c0 as row_type",
        *columns,
        f"`{line_col}` as org_data_row",
        f"`{line_col}` as data_row",
    )


def split_to_rows(df: DataFrame, column: str, delimiter: str = ",") -> DataFrame:
    """One row per part with its ordinal (``id`` from 1) and the part without quotes (``val``)."""
    parts = F.split(F.col(column), F.lit(_quote_regex(delimiter)))
    return df.select("*", F.posexplode(parts).alias("_pos", "_part")).select(
        *df.columns,
        (F.col("_pos") + 1).alias("id"),
        F.replace("_part", F.lit('"'), F.lit("")).alias("val"),
    )


def _quote_regex(literal: str) -> str:
    return "\\Q" + literal + "\\E"


# The nine fields of a result row.
RESULT_FIELDS = (
    "row_type", "bencode", "employee_id", "plan_id", "start_date", "end_date", "error_code",
    "error_message", "dummy",
)


def split_result_rows(df: DataFrame, column: str) -> DataFrame:
    """Result rows as their nine fixed fields. Commas always separate; quotes are dropped."""
    parsed = df.withColumn("_parts", F.split(F.replace(F.col(column), F.lit('"'), F.lit("")), ","))
    fields = [F.try_element_at("_parts", F.lit(i + 1)).alias(n) for i, n in enumerate(RESULT_FIELDS)]
    return parsed.select(*df.columns, *fields)


def delimited_line(*values: Column) -> Column:
    """Values joined to a line, quoted where needed."""
    return F.concat_ws(",", *[T.csv_quote_if_needed(T.text(v)) for v in values])
