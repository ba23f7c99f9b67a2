"""Broker commissions: invoice lines matched to agreements, priced and put on statements."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import values as V
from .lookups import one_per_key

RATE = "decimal(18,4)"

# (invoice column, agreement column) pairs that must agree, on their match keys.
TIER_0 = (("agent", "qb_broker_name"), ("name", "qb_client_name"), ("memo", "qb_fee"))

RESULT_COLUMNS = [
    "id", "broker_name", "qb_broker_name", "qb_agent", "client_name", "qb_client", "qb_fee", "memo", "qty",
    "sales_price", "amount", "open_balance", "commission_rate", "unit", "commission_amount", "broker_status",
    "email", "qb_client_name", "fee_memo", "broker_id", "date", "paylocity_id", "start_date", "num",
    "invoice_date", "client_id",
]


def commission_amount(unit: Column, rate: Column, qty: Column, amount: Column) -> Column:
    """Rate by quantity, by amount or flat; NULL for any other unit. Rounded half up to cents."""
    rate = rate.cast(RATE)
    return (
        F.when(unit == "Per Qt", rate * qty.cast(V.MONEY))
        .when(unit == "Per Amount", rate * amount.cast(V.MONEY))
        .when(unit == "Flat Rate", rate)
        .cast(V.MONEY)
    )


def match_tier(
    invoices: DataFrame, agreements: DataFrame, tier: Sequence[tuple[str, str]] = TIER_0
) -> DataFrame:
    """Invoice lines joined to the agreements that agree on all keys of a tier.

    Agreements without a broker name match nothing. A plain equi-join: Spark broadcasts the
    agreements when they are small, and splits hot brokers when they are not.
    """
    left = invoices.select(
        *[F.col(c).alias(f"i_{c}") for c in invoices.columns],
        *[T.match_key(F.col(i)).alias(f"_i{n}") for n, (i, _) in enumerate(tier)],
    )
    right = agreements.where(T.match_key(F.col("qb_broker_name")) != "").select(
        *[F.col(c).alias(f"b_{c}") for c in agreements.columns],
        *[T.match_key(F.col(b)).alias(f"_b{n}") for n, (_, b) in enumerate(tier)],
    )
    cond = reduce(lambda a, b: a & b, [left[f"_i{n}"] == right[f"_b{n}"] for n in range(len(tier))])
    joined = left.join(right, cond)
    column = F.col
    amount = commission_amount(
        column("b_unit"), column("b_commission_rate"), column("i_qty"), column("i_amount")
    )
    return joined.select(
        column("i_id").alias("id"),
        column("b_broker_name").alias("broker_name"),
        T.display_name(column("b_qb_broker_name")).alias("qb_broker_name"),
        T.display_name(column("i_agent")).alias("qb_agent"),
        T.display_name(column("b_client_name")).alias("client_name"),
        T.display_name(column("i_name")).alias("qb_client"),
        F.trim(F.upper(column("b_qb_fee"))).alias("qb_fee"),
        F.trim(F.upper(column("i_memo"))).alias("memo"),
        column("i_qty").cast(V.MONEY).alias("qty"),
        column("i_sales_price").cast(V.MONEY).alias("sales_price"),
        column("i_amount").cast(V.MONEY).alias("amount"),
        column("i_open_balance").cast(V.MONEY).alias("open_balance"),
        column("b_commission_rate").cast(RATE).alias("commission_rate"),
        column("b_unit").alias("unit"),
        amount.alias("commission_amount"),
        column("b_broker_status").alias("broker_status"),
        column("b_email").alias("email"),
        column("b_qb_client_name").alias("qb_client_name"),
        column("b_fee_memo").alias("fee_memo"),
        column("b_id").alias("broker_id"),
        column("i_date").alias("date"),
        column("b_paylocity_id").alias("paylocity_id"),
        column("b_start_date").alias("start_date"),
        column("i_num").alias("num"),
        column("i_date").alias("invoice_date"),
        column("b_client_id").alias("client_id"),
    )


def addition_number(broker_id: Column, detail_id: Column, start_date: Column) -> Column:
    """The invoice number of a manual addition, at most 49 characters."""
    parts = [F.coalesce(c.cast("string"), F.lit("")) for c in (broker_id, detail_id, start_date)]
    return F.left(F.concat(parts[0], F.lit("-"), parts[1], F.lit("-"), parts[2]), F.lit(49))


def additions(rows: DataFrame, on_date: Column) -> DataFrame:
    """Manual statement additions in the shape of matched invoice lines."""
    c = F.col
    zero = F.lit(0).cast(V.MONEY)
    return rows.select(
        c("detail_id").cast("bigint").alias("id"),
        c("broker_name"),
        c("broker_name").alias("qb_broker_name"),
        c("broker_name").alias("qb_agent"),
        c("qb_client_name").alias("client_name"),
        c("qb_client_name").alias("qb_client"),
        c("qb_fee"),
        c("qb_fee").alias("memo"),
        c("quantity").cast(V.MONEY).alias("qty"),
        c("sales_price").cast(V.MONEY).alias("sales_price"),
        c("sales_price").cast(V.MONEY).alias("amount"),
        zero.alias("open_balance"),
        c("commission_rate").cast(RATE).alias("commission_rate"),
        c("unit"),
        c("total_price").cast(V.MONEY).alias("commission_amount"),
        c("status").alias("broker_status"),
        F.lit("").alias("email"),
        c("qb_client_name"),
        c("qb_fee").alias("fee_memo"),
        c("broker_id").cast("bigint").alias("broker_id"),
        on_date.cast("date").alias("date"),
        c("paylocity_id"),
        c("start_date"),
        addition_number(c("broker_id"), c("detail_id"), c("start_date")).alias("num"),
        c("start_date").alias("invoice_date"),
        F.lit(0).cast("bigint").alias("client_id"),
    )


def sent_balances(sent: DataFrame) -> DataFrame:
    """Open balance of sent invoices per trimmed number."""
    return sent.groupBy(F.trim("invoice_num").alias("_num")).agg(
        F.sum(F.col("open_balance").cast(V.MONEY)).cast(V.MONEY).alias("total_invoice_sent_open_balance")
    )


def commission_result(
    invoices: DataFrame,
    agreements: DataFrame,
    manual: DataFrame | None = None,
    sent: DataFrame | None = None,
    tiers: Sequence[Sequence[tuple[str, str]]] = (TIER_0,),
    on_date: Column | None = None,
) -> DataFrame:
    """All matched lines of all tiers and the additions, each once, with the sent balance."""
    sources = [match_tier(invoices, agreements, tier) for tier in tiers]
    if manual is not None:
        sources.append(additions(manual, F.current_date() if on_date is None else on_date))
    merged = reduce(DataFrame.unionByName, sources).distinct()
    if sent is None:
        return merged.withColumn("total_invoice_sent_open_balance", F.lit(None).cast(V.MONEY))
    balances = sent_balances(sent)
    return merged.join(balances, F.trim("num") == balances["_num"], "left").drop("_num")


def header_key(broker_id: Column, broker_name: Column, payroll_id: Column, year: Column, month: Column) -> Column:
    """A header id that is the same whenever a period is built again, from all that tells headers apart."""
    return F.xxhash64(broker_id, broker_name, payroll_id, year, month)


def statement_headers(result: DataFrame, year: int, month: str, on_date: Column | None = None) -> DataFrame:
    """One header per broker, name and payroll id of a period."""
    brokers = result.where((T.text("broker_name") != "") & F.col("broker_id").isNotNull())
    heads = one_per_key(brokers, {c: F.col(c) for c in ("broker_id", "broker_name", "paylocity_id")})
    return heads.select(
        header_key(
            F.col("broker_id"), F.col("broker_name"), F.col("paylocity_id"), F.lit(year), F.lit(month)
        ).alias("header_id"),
        F.lit(month).alias("month"),
        F.lit(year).alias("year"),
        "broker_id",
        "broker_name",
        F.lit(0).alias("flag"),
        (F.current_date() if on_date is None else on_date).alias("change_date"),
        "paylocity_id",
    )


def statement_details(headers: DataFrame, result: DataFrame) -> DataFrame:
    """The lines of each header: those of its broker, name and payroll id, so that a line of a broker
    with two names is billed once."""
    lines = result.select(*[F.col(c).alias(f"_{c}") for c in result.columns])
    own = [headers[c].eqNullSafe(lines[f"_{c}"]) for c in ("broker_id", "broker_name", "paylocity_id")]
    joined = headers.join(lines, own[0] & own[1] & own[2], "left")
    c = F.col
    return joined.select(
        F.xxhash64("header_id", "_id", "_num", "_qb_client", "_qb_fee", "_memo").alias("detail_id"),
        "header_id",
        c("_qb_client").alias("qb_client_name"),
        c("_client_name").alias("client_name"),
        c("_broker_id").alias("broker_id"),
        c("_broker_name").alias("broker_name"),
        c("_qb_fee").alias("qb_fee"),
        c("_memo").alias("fee_memo"),
        c("_qty").alias("quantity"),
        c("_commission_rate").alias("commission_rate"),
        c("_unit").alias("unit"),
        c("_paylocity_id").alias("status"),
        c("_sales_price").alias("sales_price"),
        c("_commission_amount").alias("total_price"),
        c("_start_date").alias("start_date"),
        c("_broker_status").alias("broker_status"),
        c("_open_balance").alias("open_balance"),
        F.trim("_num").alias("invoice_num"),
        c("_invoice_date").alias("invoice_date"),
        "month",
        "year",
    )


STATEMENT_COLUMNS = [
    "detail_id", "header_id", "invoice_date", "invoice_num", "qb_client_name", "client_name", "broker_id",
    "broker_name", "qb_fee", "fee_memo", "quantity", "commission_rate", "unit", "status", "sales_price",
    "total_price", "start_date", "broker_status", "open_balance", "month", "year", "line_payment_status",
]


def statement_view(details: DataFrame, manual: DataFrame) -> DataFrame:
    """What a statement shows: paid or pending lines that were not appended, and all additions."""
    shown = details.where(
        (F.col("broker_status") != "Appended") & F.col("line_payment_status").isin("paid", "pending")
    )
    number = addition_number(F.col("broker_id"), F.col("detail_id"), F.col("start_date"))
    added = manual.withColumns(
        {
            "invoice_date": F.col("start_date"),
            "invoice_num": number,
            "open_balance": F.lit(0).cast(V.MONEY),
            "month": F.lit(None).cast("string"),
            "year": F.lit(None).cast("int"),
            "line_payment_status": F.lit("Appended"),
        }
    )
    return shown.select(*STATEMENT_COLUMNS).unionByName(added.select(*STATEMENT_COLUMNS))
