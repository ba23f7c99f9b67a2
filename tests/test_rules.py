import pytest
from pyspark.sql import functions as F

from flatproof.operators import rules
from flatproof.operators.parse import (
    column_count, first_field, parse_record, split_csv, split_result_rows, split_to_rows,
)
from flatproof.spec import parse_field, platform_a_layouts, platform_c_layouts, record


def check(spark, field, value, platform="A", **options):
    spec = record("XX", [field])
    rows = spark.createDataFrame([("XX", value)], f"row_type string, `{spec.names[0]}` string")
    out = rules.apply_rules(rows, spec, rules.RuleOptions(platform, **options)).first()
    return out[spec.names[0]], [e["message"].split(". '")[0] for e in out["errors"]]


CASES = [
    # field, value, platform, cleaned, wording of the errors
    ("A:text", "  x ", "A", "x", []),
    ("A:text", None, "A", "", []),
    ("A:email", "jo@example.org", "A", "jo@example.org", []),
    ("A:email", "jo.example.org", "A", "jo.example.org", ["A must be a valid Email"]),
    ("A:zip[5]", "62701-1234", "A", "62701", []),
    ("A:phone[10]", "+1 (555) 010-1000", "A", "5550101000", []),
    ("A:alnum", "1 Main St., #4", "A", "1 Main St 4", []),
    ("A:alnumdash", "PLAN 1-A!", "A", "PLAN1-A", []),
    ("A:alpha", "O'Neil 2nd", "A", "ONeilnd", []),
    ("A:alphadash", "Ann-Lee 3", "A", "Ann-Lee", []),
    ("A:numdash", "12-3a", "A", "12-3", []),
    ("A:const{K}", "zzz", "A", "K", []),
    ("A:const{K}", "", "A", "", []),
    ("A:int", " 1,200 ", "A", "1200", []),
    ("A:int", "007", "A", "7", []),
    ("A:int", "1.5", "A", "1.5", ["A must be numbers only"]),
    ("A:decimal", "1,234.5", "A", "1234.50", []),
    ("A:decimal", "16777217.01", "A", "16777217.01", []),
    ("A:decimal", "abc", "A", "abc", ["A must be a Currency Value"]),
    ("A:isodate", "20240131", "A", "20240131", []),
    ("A:isodate", "01/31/2024", "A", "20240131", []),
    ("A:isodate", "1/5/2024", "A", "20240105", []),
    ("A:isodate", "31-Jan-2024", "A", "20240131", []),
    ("A:isodate", "31-JAN-2024 01:02:03 PM", "A", "20240131", []),
    ("A:isodate", "20240131 10:11:12", "A", "20240131", []),
    ("A:isodate", "2024-13-01", "A", "2024-13-01", ["A must be in format YYYYMMDD"]),
    ("A:isodate", "20240230", "A", "20240230", ["A must be in format YYYYMMDD"]),
    ("A:isodate", "", "A", "", []),
    ("A:isodatetime", "20240131 10:11:12", "A", "20240131 101112", []),
    ("A:usdate", "20240131", "C", "01/31/2024", []),
    ("A:usdate", "31 of Jan", "C", "31 of Jan", ["A must be in format MM/DD/YYYY"]),
    ("A:usdatetime", "20240131 15:04:00", "C", "01/31/2024 03:04 PM", []),
    ("A:yesno", "yes", "A", "yes", []),
    ("A:yesno", "1", "A", "1", ["A must be either Yes or No"]),
    ("A:truefalse", "False", "A", "False", []),
    ("A:flag", "T", "C", "1", []),
    ("A:flag", "no", "C", "0", []),
    ("A:flag", "maybe", "C", "maybe", ["A must be either 1/Yes/True or 0/No/False"]),
    ("A:int[1..1]{2|5}=2", "", "A", "2", []),
    ("A:int[1..1]{2|5}=2", "3", "A", "3", ["A must always be one of 2|5"]),
    ("A:ssn[9..9]", "1234567", "A", "001234567", []),
    ("A:ssn[9..9]", "123-45-6789", "A", "123456789", []),
    ("A:ssn[9..9]", "123 45 6789", "A", "123 45 6789", ["A must be maximum 9 characters long"]),
    ("EmployeeID:text[9..9]", "42", "A", "000000042", []),
    ("SSN:ssn[9]*", "42", "C", "42", []),
    ("A:text*", "", "A", "", ["A must be minimum 1 characters long"]),
    ("A:text[2..3]", "abcd", "A", "abcd", ["A must be maximum 3 characters long"]),
    ("A:decimal<5..10>", "4", "A", "4.00", ["A must be a number with a value greater than 5"]),
    ("A:decimal<5..10>", "11", "A", "11.00", ["A must be a number with a value less than 10"]),
    ("A:text{a|b}", "c", "A", "c", []),
    ("A:text*{<BLANK>}", "c", "A", "", ["A must be minimum 1 characters long"]),
    ("A:money*{0|0.00}", "0", "C", "0.00", []),
]


def test_each_rule(spark):
    """Every rule in one job: each case is a field of its own layout."""
    for platform in ("A", "C"):
        cases = [c for c in CASES if c[2] == platform]
        fields, values = [], []
        for i, (field, value, *_rest) in enumerate(cases):
            name, kind = field.split(":", 1)
            fields.append(f"{name if name in ('EmployeeID', 'SSN') else f'{name}{i}'}:{kind}")
            values.append(value)
        spec = record("XX", fields)
        schema = "row_type string, " + ", ".join(f"`{n}` string" for n in spec.names)
        out = rules.apply_rules(
            spark.createDataFrame([("XX", *values)], schema), spec, rules.RuleOptions(platform)
        ).first()
        for name, (field, value, _, cleaned, wordings) in zip(spec.names, cases):
            own = field.split(":")[0]
            found = [e["message"].split(". '")[0].replace(name, own, 1) for e in out["errors"] if e["code"] == name]
            assert (out[name], found) == (cleaned, wordings), (field, value)


def test_optional_lists_are_an_option(spark):
    assert check(spark, "A:text{a|b}", "c", check_optional_lists=True)[1] == ["A must always be one of a|b"]
    assert check(spark, "A:text{a|b}", "", check_optional_lists=True)[1] == []
    assert check(spark, "A:text{<BLANK>}", "x", check_optional_lists=True) == ("", [])


def test_all_errors_are_kept_and_the_row_is_rebuilt(spark):
    spec = record("IB", ["Name:alpha", "Born:isodate", "Mail:email", "Note:text"])
    lines = spark.createDataFrame([('IB,"Do,e ",01/02/2024,nope,"a ""b"", c"',)], "line string")
    rows = rules.apply_rules(parse_record(lines, spec), spec)
    flat = rules.flatten_errors(rows).first()
    assert flat["data_row"] == 'IB,Doe,20240102,nope,"a ""b"", c"'
    assert flat["org_data_row"].startswith('IB,"Do,e "')
    assert flat["error_code"] == "Mail"
    bad = spark.createDataFrame([("IB,x,99,nope,",)], "line string")
    two = rules.apply_rules(parse_record(bad, spec), spec)
    assert rules.flatten_errors(two).first()["error_code"] == "Born;Mail"
    assert rules.flatten_errors(two, last_only=True).first()["error_code"] == "Mail"
    report = rules.row_reports(two.withColumn("source_row_no", F.lit(7))).first()["report"]
    assert report == "7: Mail : Mail must be a valid Email. 'nope' is not valid"


def test_unchanged_rows_keep_their_text(spark):
    spec = record("XX", ["A:text", "B:text"])
    lines = spark.createDataFrame([("XX,a",), ("XX,a,b,extra",)], "line string")
    out = rules.apply_rules(parse_record(lines, spec), spec).collect()
    assert [(r["data_row"], r["changed"]) for r in out] == [("XX,a", False), ("XX,a,b,extra", False)]


def test_typed_values(spark):
    spec = record("XX", ["N:int", "M:money", "D:usdate", "F:flag", "T:text"])
    lines = spark.createDataFrame([("XX,5,1.5,1/2/2024,yes,",), ("XX,x,y,z,q,t",)], "line string")
    rows = rules.typed(rules.apply_rules(parse_record(lines, spec), spec, rules.RuleOptions("C")), spec)
    good, bad = [tuple(r)[:5] for r in rows.select("N", "M", "D", "F", "T").collect()]
    assert str(good) == "(5, Decimal('1.50'), datetime.date(2024, 1, 2), True, None)"
    assert bad == (None, None, None, None, "t")


def test_a_filter_on_errors_does_not_repeat_the_rules(spark):
    spec = platform_a_layouts()["IB", "New"]
    lines = spark.createDataFrame([("IB",)], "line string")
    rows = rules.apply_rules(parse_record(lines, spec), spec).where(rules.has_error())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_csv") == 1
    assert "BatchEvalPython" not in plan


def test_layouts_have_the_expected_widths():
    a = {f"{c}/{h}": s.width for (c, h), s in platform_a_layouts().items()}
    assert (a["IB/Old"], a["IB/New"], a["IC/Old"], a["IC/New"], a["IC/SegmentedFunding"]) == (19, 24, 14, 15, 16)
    assert (a["IH/Old"], a["IZ/New"], a["RC/New"], a["RE/New"]) == (11, 7, 7, 9)
    c = platform_c_layouts()
    assert len(c) == 32
    assert (len(c["[QB]"].fields), len(c["[SPM]"].fields), len(c["[NPM]"].fields)) == (39, 48, 21)
    assert parse_field("A:text[3]*{a|b}=a").allowed == ("a", "b")
    with pytest.raises(ValueError):
        parse_field("A:nonsense")


def test_splitting(spark):
    df = spark.createDataFrame(
        [('a,"b,c","d ""q"" e",',), ("plain,x",), ('"first, one",2',)], "line string"
    )
    out = df.select(split_csv(F.col("line")), column_count(F.col("line")), first_field(F.col("line"))).collect()
    assert list(out[0][0]) == ["a", '"b,c"', '"d ""q"" e"', ""] and out[0][1] == 4
    assert (out[1][1], out[1][2], out[2][1], out[2][2]) == (2, "plain", 2, "first, one")
    parts = split_to_rows(spark.createDataFrame([('x|"y"|',)], "v string"), "v", "|").collect()
    assert [(r["id"], r["val"]) for r in parts] == [(1, "x"), (2, "y"), (3, "")]
    row = 'RC,EMP001,123456789,FSA,20210101,20211231,15028,"Text",'
    fields = split_result_rows(spark.createDataFrame([(row,), ("RB,EMP001",)], "r string"), "r").collect()
    assert fields[0]["error_code"] == "15028" and fields[0]["error_message"] == "Text" and fields[0]["dummy"] == ""
    assert fields[1]["error_code"] is None
