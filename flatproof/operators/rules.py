"""The rule engine: field specs become column expressions.

The work goes through a few narrow projections (original text, prepared text, parsed dates,
cleaned value, errors), each of which reads plain columns of the one before. That keeps every
generated expression small, parses each value once, and lets one pass over the lines check
all record types: a field that a layout does not have is NULL, and NULL passes through every
rule without an error.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from ..spec import BLANK_ONLY, FieldSpec, RecordSpec

ERROR_TYPE = "array<struct<code:string,message:string>>"

# Fields that are padded like an SSN whatever their kind, by platform.
SSN_LIKE = {
    "A": {"EmployeeSocialSecurityNumber", "EmployeeID"},
    "C": {"EmployeeSocialSecurityNumber", "SSN", "MemberId"},
}

# Kind -> how a date is written, and how the error names that form.
DATE_KINDS = {
    "isodate": (V.ISO_DATE, "YYYYMMDD"),
    "isodatetime": (V.ISO_DATETIME, "YYYYMMDD HHMMSS"),
    "usdate": (V.US_DATE, "MM/DD/YYYY"),
    "usdatetime": (V.US_DATETIME, "MM/DD/YYYY HH:MM AM"),
}
FLAG_KINDS = ("yesno", "flag", "truefalse")
MONEY_KINDS = ("decimal", "money")

# Kind -> the characters it drops.
DROPPED = {
    "zip": T.NOT_DIGIT,
    "phone": T.NOT_DIGIT,
    "alnum": T.NOT_ALNUM_OR_SPACE,
    "alnumdash": T.NOT_ALNUM_OR_DASH,
    "alpha": T.NOT_ALPHA,
    "alphadash": T.NOT_ALPHA_OR_DASH,
    "numdash": T.NOT_DIGIT_OR_DASH,
}


@dataclass(frozen=True)
class RuleOptions:
    platform: str = "A"
    # Apply allowed lists to optional fields too (blank stays allowed).
    check_optional_lists: bool = False


def _is_ssn(field: FieldSpec, options: RuleOptions) -> bool:
    return field.kind == "ssn" or field.name in SSN_LIKE[options.platform]


# Rules are written as SQL text. A layout has hundreds of rules, and text goes to the JVM in one
# call per field where column objects would take dozens.


def sql_text(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _words(values) -> str:
    return "(" + ", ".join(sql_text(v) for v in values) + ")"


def _prepared(raw: str, field: FieldSpec) -> str:
    """Trimmed text without the characters that the kind drops."""
    if field.kind in DROPPED:
        return f"regexp_replace(trim({raw}), {sql_text(DROPPED[field.kind])}, '')"
    if field.kind == "int" or field.kind in MONEY_KINDS:
        return f"translate({raw}, ', ', '')"
    if field.kind in DATE_KINDS:
        return f"trim(regexp_replace({raw}, {sql_text(T.NOT_DATE_CHAR)}, ''))"
    return f"trim({raw})"


def _formatted(value: str, when: str | None, field: FieldSpec, options: RuleOptions) -> str:
    """The prepared text in the form of its kind; what cannot be read stays as it is."""
    kind = field.kind
    if kind == "zip":
        return f"left({value}, {field.max_len})"
    if kind == "phone":
        return f"right({value}, {field.max_len})"
    if kind == "const":
        return f"if({value} <> '', {sql_text(field.fixed)}, {value})"
    if kind == "int":
        return f"if(rlike({value}, '{V.WHOLE}'), coalesce(cast(try_cast({value} as bigint) as string), {value}), {value})"
    if kind in MONEY_KINDS:
        return f"coalesce(cast(try_cast({value} as {V.MONEY}) as string), {value})"
    if kind in DATE_KINDS:
        return f"coalesce(date_format({when}, '{DATE_KINDS[kind][0]}'), {value})"
    if kind in FLAG_KINDS and options.platform == "C":
        return (
            f"case when upper({value}) in {_words(V.TRUE_WORDS)} then '1' "
            f"when upper({value}) in {_words(V.FALSE_WORDS)} then '0' else {value} end"
        )
    return f"trim({value})" if kind in DROPPED else value


def _cleaned(value: str, when: str | None, field: FieldSpec, options: RuleOptions) -> str:
    """Formatted, defaulted, padded and forced blank where the field asks for it."""
    out = _formatted(value, when, field, options)
    if field.default:
        out = f"if(({out}) = '', {sql_text(field.default)}, {out})"
    if _is_ssn(field, options):
        # Pad short values only: lpad alone would cut long ones.
        bare = f"regexp_replace({out}, {sql_text(T.NOT_ALNUM_OR_SPACE)}, '')"
        out = (
            f"case when ({out}) = '' then '' when length({bare}) < {field.min_len} "
            f"then lpad({bare}, {field.min_len}, '0') else {bare} end"
        )
    if field.allowed == (BLANK_ONLY,) and (field.required or options.check_optional_lists):
        out = f"if(({out}) is not null, '', null)"
    return out


def _reads_twice(field: FieldSpec, options: RuleOptions) -> bool:
    plain = field.kind in DROPPED or field.kind in ("any", "text", "email")
    flag = field.kind in FLAG_KINDS and options.platform == "A"
    return not (plain or flag) or bool(field.default) or _is_ssn(field, options)


def _unreadable(value: str, when: str | None, field: FieldSpec, options: RuleOptions):
    """The test and wording of the format error of a kind, on the cleaned value."""
    kind = field.kind
    if kind == "email":
        chars, empty = sql_text(T.EMAIL_CHARS), sql_text(T.EMAIL_EMPTY_LABEL)
        return f"(not rlike({value}, {chars}) or rlike({value}, {empty}))", "must be a valid Email"
    if kind == "int":
        return f"(not rlike({value}, '{V.WHOLE}') or try_cast({value} as bigint) is null)", "must be numbers only"
    if kind in MONEY_KINDS:
        return f"try_cast({value} as {V.MONEY}) is null", "must be a Currency Value"
    if kind in DATE_KINDS:
        return f"{when} is null", f"must be in format {DATE_KINDS[kind][1]}"
    if kind in FLAG_KINDS and options.platform == "C":
        return f"{value} not in ('0', '1')", "must be either 1/Yes/True or 0/No/False"
    if kind == "yesno":
        return f"lower({value}) not in ('yes', 'no')", "must be either Yes or No"
    if kind == "truefalse":
        return f"lower({value}) not in ('true', 'false')", "must be either True or False"
    return None


def field_rules(
    value: str, when: str | None, field: FieldSpec, options: RuleOptions
) -> list[tuple[str, str]]:
    """(test, wording) of each rule of a field on its cleaned value, in the order rules apply."""
    rules: list[tuple[str, str]] = []
    unreadable = _unreadable(value, when, field, options)
    if unreadable:
        rules.append((f"{value} <> '' and {unreadable[0]}", unreadable[1]))
    if field.allowed and field.kind != "const" and field.allowed != (BLANK_ONLY,):
        wording = f"must always be one of {'|'.join(field.allowed)}"
        if field.required:
            rules.append((f"{value} not in {_words(field.allowed)}", wording))
        elif options.check_optional_lists:
            rules.append((f"{value} <> '' and {value} not in {_words(field.allowed)}", wording))
    if field.min_len:
        rules.append((f"length({value}) < {field.min_len}", f"must be minimum {field.min_len} characters long"))
    if field.max_len:
        rules.append((f"length({value}) > {field.max_len}", f"must be maximum {field.max_len} characters long"))
    if field.min_value or field.max_value:
        number = f"try_cast({value} as {V.MONEY})"
        zero_if_bad = f"{value} is not null and coalesce({number}, 0)"
        rules.append((f"{value} is not null and {number} is null", "must be a number"))
        rules.append(
            (f"{zero_if_bad} < {field.min_value}", f"must be a number with a value greater than {field.min_value}")
        )
        rules.append(
            (f"{zero_if_bad} > {field.max_value}", f"must be a number with a value less than {field.max_value}")
        )
    return rules


def no_errors() -> Column:
    return F.array().cast(ERROR_TYPE)


def _choose(cases: list[tuple[list[int], str]], every: int) -> str:
    """The expression of the layout of a row; no test where one expression serves all layouts."""
    if len(cases) == 1 and len(cases[0][0]) == every:
        return cases[0][1]
    whens = [f"when _layout_no in ({', '.join(map(str, numbers))}) then {expr}" for numbers, expr in cases]
    return f"case {' '.join(whens)} end"


def apply_rules_by_layout(
    rows: DataFrame,
    layouts: Mapping[str, RecordSpec],
    options: RuleOptions = RuleOptions(),
    layout_col: str = "layout",
    code_col: str = "row_type",
    row_col: str = "data_row",
) -> DataFrame:
    """Clean and validate the fields of all rows in place, in one pass.

    ``rows`` hold one text column per field and the name of their layout. Adds ``errors`` (all of
    a row, in the field order of its layout) and ``changed``; where a value changed, ``data_row``
    is rebuilt from the cleaned values.
    """
    number = {key: i for i, key in enumerate(layouts)}
    every = len(layouts)
    fields: dict[str, dict[FieldSpec, list[int]]] = {}
    for key, spec in layouts.items():
        for f in spec.fields:
            fields.setdefault(f.name, {}).setdefault(f, []).append(number[key])
    index = {name: i for i, name in enumerate(fields)}
    kept = [f"`{c}`" for c in rows.columns if c not in fields and c != row_col]
    has_row = row_col in rows.columns
    raw = {n: f"_raw_{i}" for n, i in index.items()}
    text = {n: f"_text_{i}" for n, i in index.items()}
    mark = {n: f"_err_{i}" for n, i in index.items()}

    # The number of the layout of a row, then the original texts: blank where a value is missing,
    # NULL only where the layout lacks the field.
    book = ", ".join(f"{sql_text(key)}, {n}" for key, n in number.items())
    layout_no = "0" if every == 1 else f"map({book})[{layout_col}]"
    out = rows.selectExpr("*", f"{layout_no} as _layout_no")
    originals = []
    for name, specs in fields.items():
        has = sorted(n for numbers in specs.values() for n in numbers)
        found = f"coalesce(`{name}`, '')"
        if every > 1:
            test = "is not null" if len(has) == every else f"in ({', '.join(map(str, has))})"
            found = f"if(_layout_no {test}, {found}, null)"
        originals.append(f"{found} as {raw[name]}")
    own_row = [f"`{row_col}`"] if has_row else []
    out = out.selectExpr(*kept, *own_row, "_layout_no", *originals)
    # Only texts that are read more than once get a column of their own.
    held = {n for n, specs in fields.items() if any(_reads_twice(f, options) for f in specs)}
    out = out.selectExpr(
        "*",
        *[
            f"{_choose([(k, _prepared(raw[n], f)) for f, k in specs.items()], every)} as {text[n]}"
            for n, specs in fields.items()
            if n in held
        ],
    )

    def prepared(name: str, f: FieldSpec) -> str:
        return text[name] if name in held else _prepared(raw[name], f)

    dates = [n for n, specs in fields.items() if any(f.kind in DATE_KINDS for f in specs)]
    if dates:
        texts = F.array(*[text[n] for n in dates])
        out = out.withColumn("_dates", F.transform(texts, lambda t: F.when(t != "", V.to_timestamp(t))))
    parsed = {n: f"_dates[{i}]" for i, n in enumerate(dates)}
    out = out.selectExpr(
        "*",
        *[
            f"{_choose([(k, _cleaned(prepared(n, f), parsed.get(n), f, options)) for f, k in specs.items()], every)} as `{n}`"
            for n, specs in fields.items()
        ],
    ).drop(*[text[n] for n in held])

    # The broken rules of a field are the bits of one number, so that a row without errors costs no
    # allocation. The texts are put together only where a bit is set.
    wordings: list[tuple[str, str]] = []
    most = 0  # rules of a field
    base: dict[tuple[str, FieldSpec], int] = {}
    noted = {}
    for name, specs in fields.items():
        cases = []
        for f, k in specs.items():
            rules = field_rules(f"`{name}`", parsed.get(name), f, options)
            if rules:
                base[name, f] = len(wordings)
                wordings += [(name, wording) for _, wording in rules]
                most = max(most, len(rules))
                cases.append((k, " + ".join(f"if({test}, {1 << i}, 0)" for i, (test, _) in enumerate(rules))))
        if cases:
            noted[name] = _choose(cases, every)
    out = out.selectExpr("*", *[f"coalesce({expr}, 0) as {mark[n]}" for n, expr in noted.items()])

    found, rebuilt = [], []
    quoted = "v -> if(contains(v, ',') or contains(v, '\"'), concat('\"', replace(v, '\"', '\"\"'), '\"'), v)"
    for key, spec in layouts.items():
        marks = [
            f"struct({base[f.name, f]} as base, {mark[f.name]} as bad, {raw[f.name]} as text)"
            for f in spec.fields
            if (f.name, f) in base
        ]
        if marks:
            found.append(([number[key]], f"array({', '.join(marks)})"))
        values = ", ".join(f"`{n}`" for n in spec.names)
        # Values are quoted one by one only if the plain row shows more commas than separators, or quotes.
        plain = f"concat_ws(',', {code_col}, {values})"
        tidy = f"not contains({plain}, '\"') and length({plain}) - length(replace({plain}, ',', '')) = {len(spec.names)}"
        careful = f"concat({code_col}, ',', array_join(transform(array({values}), {quoted}), ','))"
        rebuilt.append(([number[key]], f"if({tidy}, {plain}, {careful})"))
    differs = " or ".join(f"`{n}` <> {raw[n]}" for n in fields)
    bad = " or ".join(f"{mark[n]} <> 0" for n in noted) or "false"
    out = out.selectExpr("*", f"coalesce({differs}, false) as changed", f"({bad}) as _bad")
    errors = f"cast(array() as {ERROR_TYPE})"
    if found:
        entries = ", ".join(f"struct({sql_text(n)} as name, {sql_text(w)} as wording)" for n, w in wordings)
        bits = ", ".join(map(str, range(most)))
        worded = (
            f"struct(array({entries})[f.base + b].name as code, concat(array({entries})[f.base + b].name, ' ', "
            f"array({entries})[f.base + b].wording, '. \\'', f.text, '\\' is not valid') as message)"
        )
        errors = (
            f"if(_bad, flatten(transform(filter({_choose(found, every)}, f -> f.bad <> 0), "
            f"f -> transform(filter(array({bits}), b -> (f.bad & shiftleft(1, b)) <> 0), b -> {worded}))), {errors})"
        )
    row = [f"if(changed, {_choose(rebuilt, every)}, `{row_col}`) as `{row_col}`"] if has_row else []
    # The outcome is handed on through a generator of one row: a later filter on errors would
    # otherwise be pushed below all projections above and compute every rule a second time.
    outcome = f"inline(array(struct({errors} as errors, changed as changed)))"
    return out.selectExpr(*kept, *[f"`{n}`" for n in fields], *row, outcome)


def apply_rules(
    rows: DataFrame,
    spec: RecordSpec,
    options: RuleOptions = RuleOptions(),
    code_col: str = "row_type",
    row_col: str = "data_row",
) -> DataFrame:
    """:func:`apply_rules_by_layout` for rows of a single layout."""
    return apply_rules_by_layout(rows, {spec.code: spec}, options, code_col=code_col, row_col=row_col)


def add_error(rows: DataFrame, error: Column) -> DataFrame:
    """Append a nullable error struct to the errors of each row."""
    extra = F.array_compact(F.array(error)).cast(ERROR_TYPE)
    return rows.withColumn("errors", F.concat("errors", extra))


def error(code: str | Column, message: Column) -> Column:
    code = F.lit(code) if isinstance(code, str) else code
    return F.struct(code.alias("code"), message.alias("message"))


def has_error() -> Column:
    return F.size("errors") > 0


def flatten_errors(rows: DataFrame, last_only: bool = False, separator: str = ";") -> DataFrame:
    """``error_code`` and ``error_message`` as text: all errors, or only the last one."""
    if last_only:
        last = F.try_element_at("errors", F.lit(-1))
        code, message = T.text(last["code"]), T.text(last["message"])
    else:
        code = F.array_join(F.transform("errors", lambda e: e["code"]), separator)
        message = F.array_join(F.transform("errors", lambda e: e["message"]), separator)
    return rows.withColumns({"error_code": code, "error_message": message})


def row_reports(rows: DataFrame, row_no: str = "source_row_no") -> DataFrame:
    """One text per row with errors: its number, and the code and text of the last error."""
    last = F.try_element_at("errors", F.lit(-1))
    report = F.concat_ws("", F.col(row_no).cast("string"), F.lit(": "), last["code"], F.lit(" : "), last["message"])
    return rows.where(has_error()).withColumn("report", report)


def typed_value(value: Column, field: FieldSpec) -> Column:
    """The cleaned text in its logical type, NULL where blank or unreadable."""
    if field.kind == "int":
        return V.to_int(value)
    if field.kind in MONEY_KINDS:
        return V.to_money(value)
    if field.kind in ("isodate", "usdate"):
        return F.try_to_timestamp(value, F.lit(DATE_KINDS[field.kind][0])).cast("date")
    if field.kind in DATE_KINDS:
        return F.try_to_timestamp(value, F.lit(DATE_KINDS[field.kind][0]))
    if field.kind in FLAG_KINDS:
        return V.to_flag(value)
    return T.blank_to_null(value)


def typed(rows: DataFrame, spec: RecordSpec) -> DataFrame:
    return rows.withColumns({f.name: typed_value(F.col(f"`{f.name}`"), f) for f in spec.fields})


# File outcomes and their result codes.
OUTCOMES = {"Ok": "200", "PartialFail": "300", "CompleteFail": "300", "Error": "400"}


def file_outcomes(rows: DataFrame, file_col: str = "file", complete_fail: Column | None = None) -> DataFrame:
    """Per file: rows, rows with errors and the outcome. Aggregates before it shuffles."""
    failed = F.lit(False) if complete_fail is None else F.coalesce(complete_fail, F.lit(False))
    counted = rows.groupBy(file_col).agg(
        F.count("*").alias("row_count"),
        F.count_if(has_error()).alias("error_rows"),
        F.bool_or(failed).alias("_failed"),
    )
    outcome = (
        F.when(F.col("_failed"), "CompleteFail").when(F.col("error_rows") > 0, "PartialFail").otherwise("Ok")
    )
    code = F.when(outcome == "Ok", OUTCOMES["Ok"]).otherwise(OUTCOMES["PartialFail"])
    return counted.select(
        file_col, "row_count", "error_rows", outcome.alias("outcome"), code.alias("outcome_code")
    )
