"""Delimited inputs with a known layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions import text as T
from ..functions import values as V
from ..spec import RecordSpec, csv_layout


def _string_schema(names: list[str]) -> ST.StructType:
    return ST.StructType([ST.StructField(n, ST.StringType()) for n in names])


def read_csv(
    spark: SparkSession, paths: list[str], spec: RecordSpec, header: bool = True, delimiter: str = ","
) -> DataFrame:
    """A CSV by layout: every column as text, quotes removed, in layout order."""
    reader = spark.read.schema(_string_schema(spec.names))
    return reader.csv(
        paths, header=header, sep=delimiter, quote='"', escape='"', mode="PERMISSIVE", enforceSchema=True
    )


def read_csv_like_table(
    spark: SparkSession, paths: list[str], table: DataFrame, header: bool = True
) -> DataFrame:
    """A CSV in the column order and types of an existing table; unreadable values become NULL."""
    raw = spark.read.schema(_string_schema(table.columns)).csv(
        paths, header=header, quote='"', escape='"', mode="PERMISSIVE"
    )
    return raw.select(
        *[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in table.schema.fields]
    )


def read_account_managers(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The account-manager list; stray quotes are dropped from client codes."""
    managers = read_csv(spark, paths, csv_layout("managers"))
    return managers.withColumn("bencode", F.replace("bencode", F.lit('"'), F.lit("")))


def read_invoices(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Invoice export lines, typed; blank or unreadable amounts read as zero."""
    raw = read_csv(spark, paths, csv_layout("invoice"))
    return type_invoices(raw)


def type_invoices(raw: DataFrame) -> DataFrame:
    amounts = ("qty", "sales_price", "amount", "open_balance")
    return raw.withColumns(
        {
            "date": V.to_date(F.trim("date")),
            **{a: V.money_or_zero(T.text(a)) for a in amounts},
        }
    )
