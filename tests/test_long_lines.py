"""Splitting at quotes, addresses and sent names: the same as the plain patterns say, and in time for any length."""

import random
import re

import pytest
from pyspark.sql import functions as F

from flatproof.functions import text as T
from flatproof.operators.parse import MANY_FIELDS, column_count, csv_fields, first_field, split_csv
from flatproof.operators.results import sent_name
from flatproof.operators.rules import apply_rules
from flatproof.spec import record

SEPARATOR = re.compile(r',(?=(?:[^"]*"[^"]*")*[^"]*\Z)')
ADDRESS = re.compile(r"[\w!#$%&'*+/=?^`{|}~\-]+(\.[\w!#$%&'*+/=?^`{|}~\-]+)*@[A-Za-z0-9\-]+(\.[A-Za-z0-9\-]+)*", re.A)


def some(seed, alphabet, n, most):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randrange(most))) for _ in range(n)]


def column(spark, values):
    return spark.createDataFrame([(v,) for v in values], "v string")


def test_split_count_and_first_value(spark):
    lines = some(1, ["a", '"', ",", "\x01", "\x02", "\x03", '""', " ", "\n"], 3000, 12)
    lines += ['"a"",x', '""', '"""', '"a""', "", '"', ",", '"a\n,b",c', "é,\"ü,\"\"\""]
    v = F.col("v")
    for r in column(spark, lines).select("v", split_csv(v).alias("s"), column_count(v).alias("n"), first_field(v).alias("f")).collect():
        want = SEPARATOR.split(r.v)
        assert (r.s, r.n) == (want, len(want)), r.v
        quoted = re.match(r'"((?:[^"]|"")*)"', r.v)
        assert r.f == ((quoted[1] if quoted else "") if r.v[:1] == '"' else r.v.split(",")[0]), r.v


def test_addresses(spark):
    v, values = F.col("v"), some(2, "a.@b-!_", 4000, 9) + ["a@b\n", "a@b.c", "\n", ""]
    for r in column(spark, values).select("v", (v.rlike(T.EMAIL_CHARS) & ~v.rlike(T.EMAIL_EMPTY_LABEL)).alias("ok")).collect():
        assert r.ok == bool(ADDRESS.fullmatch(r.v)), r.v


def test_sent_names(spark):
    values = some(3, ["a", '"', ",", ".mbi", ".CSV", " ", ".Mbi", ".", "İ"], 3000, 9)
    for r in column(spark, values).select("v", sent_name(F.col("v")).alias("n")).collect():
        found = re.search(r'([^,"]*?\.(?i:mbi|csv))', r.v)
        assert r.n == (found[1].strip(" ") if found else ""), r.v


def test_many_fields_are_cut_for_the_parser(spark):
    lines = ["a," + '"b,""c",' * MANY_FIELDS + "z", "a" + "," * (3 * MANY_FIELDS), "a,b", "x" * (2 * MANY_FIELDS) + ",y", '"' * 200_001 + ",q", None]
    got = column(spark, lines).select(csv_fields(F.col("v"), 3).alias("c")).select("c.*").collect()
    assert [tuple(r) for r in got[:3]] == [("a", 'b,"c', 'b,"c'), ("a", None, None), ("a", "b", None)]
    assert got[3].c1 == "y" and got[5].c0 is None


@pytest.mark.parametrize("address, fails", [("a." * 100_000 + "a@b", False), ("a@" + "b." * 100_000, True), ("a" * 1_000_000, True)])
def test_long_addresses(spark, address, fails):
    spec = record("XX", ["Contact:email"])
    rows = spark.createDataFrame([("XX", address, f"XX,{address}")], "row_type string, Contact string, data_row string")
    assert bool(apply_rules(rows, spec).first()["errors"]) == fails
