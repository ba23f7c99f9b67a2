"""Functions for people who query the stored tables in SQL.

:func:`register_functions` makes them known to a session as temporary functions. They are SQL themselves, so Spark
optimises through them: a table function in ``LATERAL`` is a projection, a look-up by id becomes a join.

| Function | Result |
| --- | --- |
| ``csv_split(line, delimiter)`` | table ``id, val``: the parts of a line without quotes, numbered from 1 |
| ``split_error_row(line)`` | table of the nine fields of a result row, NULL where the row is shorter |
| ``file_id_from_name(name)`` | the id after the first ``--`` of a file name, blank without one |
| ``file_log_id(original_name, new_name)`` | the id under which a file is logged |
| ``file_error_count(log_id)`` | how many tasks of a logged file ended in an error, from the table of tasks |
| ``match_key(name)`` | the key for matching names |
| ``money_or_zero(text)`` | an amount with two digits, zero where there is none |
| ``is_error_code(code)`` | whether the code of a result row is one of an error |
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from .functions import values as V
from .operators.parse import RESULT_FIELDS

_BARE = r"regexp_replace(element_at(split({0}, '/'), -1), '\\.[^./]*$', '')"


def _definitions(tasks: str) -> dict[str, str]:
    fields = ", ".join(f"{name} STRING" for name in RESULT_FIELDS)
    parts = ", ".join(f"get(parts, {i})" for i in range(len(RESULT_FIELDS)))
    bare = _BARE.format("name")
    return {
        "csv_split(line STRING, delimiter STRING)": r"""RETURNS TABLE (id INT, val STRING) RETURN
            SELECT pos + 1, replace(part, '"', '')
            FROM (SELECT posexplode(split(line, concat('\\Q', delimiter, '\\E'))) AS (pos, part))""",
        "split_error_row(line STRING)": f"""RETURNS TABLE ({fields}) RETURN
            SELECT {parts} FROM (SELECT split(replace(line, '"', ''), ',') AS parts)""",
        "file_id_from_name(name STRING)": f"""RETURNS STRING RETURN
            if(instr({bare}, '--') > 1, trim(substr({bare}, instr({bare}, '--') + 2)), '')""",
        "file_log_id(original_name STRING, new_name STRING)": f"""RETURNS BIGINT RETURN
            xxhash64(coalesce(nullif(file_id_from_name(coalesce(new_name, '')), ''), nullif(file_id_from_name(original_name), ''),
                regexp_replace(original_name, '\\\\.[^./]*$', '')))""",
        "file_error_count(log_id BIGINT)": f"""RETURNS BIGINT RETURN
            (SELECT count_if(processing_task_outcome = 'ERROR') FROM {tasks} WHERE file_log_id = log_id)""",
        "match_key(name STRING)": """RETURNS STRING RETURN
            regexp_replace(upper(trim(coalesce(name, ''))), '[^A-Z0-9]', '')""",
        "money_or_zero(text STRING)": f"""RETURNS {V.MONEY} RETURN
            coalesce(try_cast(trim(translate(text, ', ', '')) AS {V.MONEY}), CAST(0 AS {V.MONEY}))""",
        "is_error_code(code STRING)": """RETURNS BOOLEAN RETURN
            coalesce(try_cast(code AS DOUBLE) IS NOT NULL AND code > '0', false)""",
    }


def register_functions(spark: SparkSession, tasks: str | None = None) -> list[str]:
    """Make the functions known to a session; returns their names.

    ``tasks`` names the table or view of logged tasks (``file_log_id, processing_task_outcome``); without it there is
    no ``file_error_count``.
    """
    made = []
    for head, body in _definitions(tasks or "").items():
        name = head.partition("(")[0]
        if name == "file_error_count" and tasks is None:
            continue
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} {body}")
        made.append(name)
    return made
