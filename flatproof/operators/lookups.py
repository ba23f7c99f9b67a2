"""Reference checks: does what a row refers to exist in the master data?

Every check is an equi-join against a side that was reduced to one row per key first, so no
check multiplies rows and a hot key only makes one side of a join large. The skew handling of
adaptive execution splits a hot key where both sides of a join come straight from a shuffle; the
reduced side is therefore dealt anew behind its aggregate (:func:`one_per_key`). Where look-ups
by the same key follow each other, ``spark.sql.adaptive.forceOptimizeSkewedJoin``, which
:func:`~flatproof.session.build_session` sets, lets the first one split it all the same.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NullType

from ..functions import text as T
from ..functions import values as V
from .parents import last_parent
from .rules import ERROR_TYPE, add_error, error, has_error, no_errors

ANY_PLAN = "*"


def _same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [left[l] == right[r] for l, r in pairs])


def one_per_key(rows: DataFrame, keys: dict[str, Column], *found: Column) -> DataFrame:
    """One row per key with what is ``found`` for it, reduced before the shuffle.

    The rows are grouped by the keys as one struct. A join by the single columns then deals the few
    reduced rows anew, and with that it is a join of two shuffles, whose hot keys Spark can split;
    straight from an aggregate by those columns it would not be.
    """
    key = F.struct(*[c.alias(n) for n, c in keys.items()]).alias("_key")
    reduced = rows.groupBy(key).agg(*found) if found else rows.select(key).distinct()
    rest = [c for c in reduced.columns if c != "_key"]
    return reduced.select(*[F.col("_key").getField(n).alias(n) for n in keys], *rest)


def exists(rows: DataFrame, master: DataFrame, on: dict[str, str], flag: str) -> DataFrame:
    """Add a boolean: is there a master row with these keys? ``on`` maps row to master columns."""
    keys = one_per_key(master, {f"_k{i}": F.col(m) for i, m in enumerate(on.values())})
    keys = keys.withColumn("_hit", F.lit(True))
    cond = _same(rows, keys, [(r, f"_k{i}") for i, r in enumerate(on)])
    joined = rows.join(keys, cond, "left")
    return joined.select(*rows.columns, F.coalesce("_hit", F.lit(False)).alias(flag))


def missing(rows: DataFrame, master: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows whose keys are not in the master."""
    return rows.join(master, _same(rows, master, list(on.items())), "left_anti")


def first_known(
    master: DataFrame | None, added: DataFrame | None, keys: list[str], order: list[str]
) -> DataFrame:
    """Per key the place from which on it is known: before all rows for master keys, else the
    first row that adds it. Columns: ``keys``, ``in_master`` and ``known_from`` (a struct of ``order``)."""
    parts = []
    if added is not None:
        parts.append(added.select(*keys, F.lit(False).alias("in_master"), F.struct(*order).alias("known_from")))
    if master is not None:
        never = F.lit(None).cast(parts[0].schema["known_from"].dataType) if parts else F.lit(None).cast("void")
        parts.append(master.select(*keys, F.lit(True).alias("in_master"), never.alias("known_from")))
    known = reduce(DataFrame.unionByName, parts)
    if added is None:
        return one_per_key(known, {k: F.col(k) for k in [*keys, "in_master", "known_from"]})
    return one_per_key(
        known, {k: F.col(k) for k in keys}, F.bool_or("in_master").alias("in_master"),
        F.min("known_from").alias("known_from"),
    )


def exists_before(
    rows: DataFrame, known: DataFrame, on: dict[str, str], order: list[str], flag: str
) -> DataFrame:
    """Add a boolean: was the key known before this row? ``known`` comes from :func:`first_known`."""
    side = known.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(on.values())], "in_master", "known_from")
    cond = _same(rows, side, [(r, f"_k{i}") for i, r in enumerate(on)])
    before = F.col("in_master")
    if not isinstance(known.schema["known_from"].dataType, NullType):
        before = before | F.coalesce(F.col("known_from") < F.struct(*order), F.lit(False))
    return rows.join(side, cond, "left").select(*rows.columns, F.coalesce(before, F.lit(False)).alias(flag))


def optional_key(column: Column) -> Column:
    """A key that matches everything when blank."""
    return F.coalesce(T.blank_to_null(F.trim(column)), F.lit(ANY_PLAN))


def with_any_key(master: DataFrame, column: str) -> DataFrame:
    """Each master row under its own key and under the key of rows that leave it blank."""
    both = F.array_distinct(F.array(optional_key(F.col(column)), F.lit(ANY_PLAN)))
    return master.withColumn(column, F.explode(both))


# --- platform A ----------------------------------------------------------------------------
#
# The wording of the errors of both platforms, which those who get the files look for.


def employer_error(found: Column) -> Column:
    employer = F.col("EmployerId")
    text = F.when(T.is_blank(employer), F.lit("The Employer ID cannot be blank")).when(
        ~found, F.concat(F.lit("The Employer ID '"), employer, F.lit("' could not be found"))
    )
    return F.when(text.isNotNull(), error("EmployerId", text))


def employee_error(found: Column) -> Column:
    text = (
        F.when(T.is_blank(F.col("EmployerId")), F.lit("The Employer ID cannot be blank"))
        .when(T.is_blank(F.col("EmployeeID")), F.lit("The Employee ID cannot be blank"))
        .when(
            ~found,
            F.concat(
                F.lit("The Employee ID '"), F.col("EmployeeID"), F.lit("' could not be found for Employer Id '"),
                F.col("EmployerId"), F.lit("'"),
            ),
        )
    )
    return F.when(text.isNotNull(), error("EmployeeID", text))


def tpa_error(tpa_id: str, required: bool) -> Column:
    """A wrong TPA id; a blank one only when it is required."""
    tpa = T.text("TpaId")
    text = F.when(
        F.lit(required) & T.is_blank(tpa), F.lit(f"TPA ID cannot be blank. It must always be {tpa_id}")
    ).when(
        ~T.is_blank(tpa) & (tpa != tpa_id),
        F.concat(F.lit("TPA ID '"), tpa, F.lit(f"' is invalid. It must always be {tpa_id}")),
    )
    return F.when(text.isNotNull(), error("TpaId", text))


def plan_verdict(owner: str, has_plan: Column, has_period: Column) -> Column:
    """What is wrong with the plan of a row: the plan must exist, with the same period; the period
    must be ordered and hold the effective date. ``ok`` if nothing is.

    Dates are cleaned ``yyyyMMdd`` text here, which compares like dates.
    """
    start, end, eff = (T.text(c) for c in ("PlanStartDate", "PlanEndDate", "EffectiveDate"))
    return (
        F.when(T.is_blank(F.col("EmployerId")), "no employer")
        .when(T.is_blank(F.col(owner)), "no owner")
        .when(T.is_blank(F.col("AccountTypeCode")), "no account type")
        .when(~has_plan, "no plan")
        .when(~has_period, "no period")
        .when((eff != "") & (eff > end), "ended")
        .when(start > end, "period reversed")
        .when((eff != "") & (eff < start), "not started")
        .otherwise("ok")
    )


def plan_error(code: str, owner: str, owner_label: str, verdict: Column) -> Column:
    """The error for a verdict, NULL for a plan in order."""
    start, end, eff = (T.text(c) for c in ("PlanStartDate", "PlanEndDate", "EffectiveDate"))
    plan = F.when(T.is_blank(F.col("PlanId")), F.lit("")).otherwise(
        F.concat(F.lit(" and Plan ID '"), F.col("PlanId"), F.lit("'"))
    )
    blanks = {
        "no employer": "The Employer ID cannot be blank",
        "no owner": f"The {owner_label} cannot be blank",
        "no account type": "The AccountTypeCode cannot be blank",
    }
    missing = F.concat(F.lit(f"' could not be found for {owner_label} '"), F.col(owner), F.lit("'"))
    details = {
        "no plan": F.concat(F.lit(f" could not be found for {owner_label} '"), F.col(owner), F.lit("'")),
        "no period": F.concat(F.lit(" and Plan Start date '"), start, F.lit("' and Plan End date '"), end, missing),
        "ended": F.concat(F.lit(" ended on '"), end, F.lit("' and is no longer active on '"), eff, F.lit("'")),
        "period reversed": F.concat(
            F.lit(" Start Date '"), start, F.lit("' must be before the Plan End Date '"), end,
            F.lit(f"' for {owner_label} '"), F.col(owner), F.lit("'"),
        ),
        "not started": F.concat(
            F.lit(" starts only on '"), start, F.lit("' and is not yet started on '"), eff, F.lit("'")
        ),
    }
    blank = detail = None
    for kind, wording in blanks.items():
        blank = F.when(verdict == kind, wording) if blank is None else blank.when(verdict == kind, wording)
    for kind, wording in details.items():
        detail = F.when(verdict == kind, wording) if detail is None else detail.when(verdict == kind, wording)
    head = F.concat(F.lit("The AccountTypeID '"), F.col("AccountTypeCode"), F.lit("'"), plan)
    return F.when(verdict != "ok", error(code, F.coalesce(blank, F.concat(head, detail))))


def with_plan_verdict(
    rows: DataFrame, plans: DataFrame, on: list[str], order: list[str], added: DataFrame | None = None
) -> DataFrame:
    """Add ``plan_verdict`` for rows with columns ``on`` (its last but one names the owner of the
    plan), ``PlanId`` and dates.

    ``plans`` have columns ``on``, ``PlanId`` and the dates ``planstart`` and ``planend``; ``added``
    are rows like ``rows``. A blank plan id matches any plan of the key.
    """
    keyed = rows.withColumn("_plan", optional_key(F.col("PlanId")))
    dates = {"planstart": V.iso_date(F.col("planstart")), "planend": V.iso_date(F.col("planend"))}
    master = with_any_key(plans.withColumns(dates), "PlanId")
    extra = None
    if added is not None:
        periods = {"planstart": F.col("PlanStartDate"), "planend": F.col("PlanEndDate")}
        extra = with_any_key(added.withColumns(periods), "PlanId")
    plan_keys = [*on, "PlanId"]
    period_keys = [*plan_keys, "planstart", "planend"]
    on_plan = {**{c: c for c in on}, "_plan": "PlanId"}
    out = exists_before(keyed, first_known(master, extra, plan_keys, order), on_plan, order, "_has_plan")
    out = exists_before(
        out,
        first_known(master, extra, period_keys, order),
        {**on_plan, "PlanStartDate": "planstart", "PlanEndDate": "planend"},
        order,
        "_has_period",
    )
    verdict = plan_verdict(on[-2], F.col("_has_plan"), F.col("_has_period"))
    return out.withColumn("plan_verdict", verdict).drop("_plan", "_has_plan", "_has_period")


ROW_ID = ["file", "source_row_no"]
A_KEYS = [
    "row_type", "TpaId", "EmployerId", "EmployeeID", "AccountTypeCode", "PlanId", "PlanStartDate", "PlanEndDate",
    "EffectiveDate", "DepositType",
]


def attach_errors(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Rows with the errors found for them (``file, source_row_no, found``) behind their own.

    Look-ups run on the few columns they need, and only rows that failed come back, so the wide
    rows take part in one join, and in none that shuffles them while few rows fail.
    """
    side = found.select(*[F.col(c).alias(f"_{c}") for c in ROW_ID], "found")
    joined = rows.join(side, _same(rows, side, [(c, f"_{c}") for c in ROW_ID]), "left")
    errors = F.concat("errors", F.coalesce("found", no_errors()))
    kept = [F.col(f"`{c}`") for c in rows.columns if c != "errors"]
    return joined.select(*kept, errors.alias("errors"))


def lookup_errors_a(
    rows: DataFrame,
    employers: DataFrame,
    employees: DataFrame,
    employer_plans: DataFrame,
    employee_plans: DataFrame,
    tpa_id: str = "TPA01",
    require_tpa: bool = False,
    history: DataFrame | None = None,
    hold: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
) -> DataFrame:
    """The errors of the reference checks of platform A: ``file, source_row_no, found``.

    Only rows that passed the rules are checked, and per row only the first failing check counts,
    in the field order of its layout. Demographics rows add their employee, and enrolment rows
    their plan, for the rows that come later. Deposits that pass are checked for repeats. ``hold``
    may store an intermediate result that is read more than once.
    """
    order = ["file_seq", "source_row_no"]
    code = F.col("row_type")
    employers = employers.select(F.col("employer_id").alias("EmployerId"))
    employees = employees.select(F.col("employerid").alias("EmployerId"), F.col("employeeid").alias("EmployeeID"))
    er_plans = employer_plans.select(
        F.col("employer_id").alias("EmployerId"), F.col("account_type_code").alias("AccountTypeCode"),
        F.col("plan_id").alias("PlanId"), "planstart", "planend",
    )
    ee_plans = employee_plans.select(
        F.col("employerid").alias("EmployerId"), F.col("employeeid").alias("EmployeeID"),
        F.col("plancode").alias("AccountTypeCode"), F.col("plandesc").alias("PlanId"), "planstart", "planend",
    )
    # Headers, result rows and codes without a layout are not checked.
    out = rows.where(~has_error() & F.col("layout").isNotNull()).select(*ROW_ID, "file_seq", *A_KEYS)
    out = exists(out, employers, {"EmployerId": "EmployerId"}, "_has_employer")
    out = out.withColumn(
        "_first", F.coalesce(tpa_error(tpa_id, require_tpa), employer_error(F.col("_has_employer")))
    )

    joiners = out.where((code == "IB") & F.col("_first").isNull())
    known = first_known(employees, joiners, ["EmployerId", "EmployeeID"], order)
    who = {"EmployerId": "EmployerId", "EmployeeID": "EmployeeID"}
    out = exists_before(out, known, who, order, "_has_employee")
    no_employee = F.when(code != "IB", employee_error(F.col("_has_employee")))

    enrolled = with_plan_verdict(out.where(code == "IC"), er_plans, ["EmployerId", "AccountTypeCode"], order)
    enrol_error = plan_error("PlanId", "EmployerId", "Employer Id", F.col("plan_verdict"))
    enrolled = hold(
        enrolled.withColumn("_lookup", F.coalesce("_first", enrol_error, no_employee)).drop("plan_verdict"), "enrolled"
    )

    adds = enrolled.where(F.col("_lookup").isNull())
    deposits = with_plan_verdict(
        out.where(code == "IH"), ee_plans, ["EmployerId", "EmployeeID", "AccountTypeCode"], order, adds
    )
    deposit_error = plan_error("AccountTypeCode", "EmployeeID", "Employee Id", F.col("plan_verdict"))
    deposits = hold(
        deposits.withColumn("_lookup", F.coalesce("_first", deposit_error, no_employee)).drop("plan_verdict"), "deposits"
    )
    repeats = repeat_deposits(deposits.where(F.col("_lookup").isNull()), history)

    others = out.where(~code.isin("IC", "IH")).withColumn("_lookup", F.coalesce("_first", no_employee))
    failed = [d.where(F.col("_lookup").isNotNull()).select(*ROW_ID, "_lookup") for d in (enrolled, deposits, others, repeats)]
    return reduce(DataFrame.unionByName, failed).select(*ROW_ID, F.array("_lookup").cast(ERROR_TYPE).alias("found"))


# --- repeat postings -----------------------------------------------------------------------


def earlier_posting(
    rows: DataFrame,
    keys: list[str],
    batch: str,
    row: str,
    report: dict[str, Column],
    history: DataFrame | None = None,
    history_order: str | None = None,
    counts: Column | None = None,
    name: str = "earlier",
) -> DataFrame:
    """Add ``name``: where the same posting (``keys``) was made before, else NULL.

    The latest posting of the history counts first; without one, the earliest ``batch`` of these
    rows that holds the posting, and in it the last row. Rows outside ``counts`` are not postings.
    The side that is joined has one row per key, reduced before the shuffle.
    """
    counts = F.lit(True) if counts is None else counts
    body = F.struct(*[c.alias(n) for n, c in report.items()])
    own = rows.where(counts).select(
        *keys, F.col(batch).alias("_batch"), F.col(row).cast("bigint").alias("_row"), body.alias("_body"),
        F.lit(None).cast("bigint").alias("_past"),
    )
    if history is not None:
        past = history.select(
            *keys, F.lit(None).cast(rows.schema[batch].dataType).alias("_batch"),
            F.lit(None).cast("bigint").alias("_row"), body.alias("_body"), F.col(history_order).cast("bigint").alias("_past"),
        )
        own = own.unionByName(past)
    place = F.when(F.col("_batch").isNotNull(), F.struct(F.col("_batch"), (-F.col("_row")).alias("_r")))
    side = one_per_key(
        own, {f"_k{i}": F.col(k) for i, k in enumerate(keys)},
        F.max_by("_body", "_past").alias("_past_body"),
        F.min("_batch").alias("_first_batch"),
        F.min_by("_body", place).alias("_first_body"),
    )
    same = reduce(lambda a, b: a & b, [rows[k].eqNullSafe(side[f"_k{i}"]) for i, k in enumerate(keys)])
    joined = rows.join(side, same, "left")
    found = F.when(F.col("_past_body").isNotNull(), F.col("_past_body")).when(
        F.col("_first_batch") < F.col(batch), F.col("_first_body")
    )
    return joined.select(*rows.columns, F.when(counts, found).alias(name))


DEPOSIT_KEYS = [
    "TpaId", "EmployerId", "EmployeeID", "AccountTypeCode", "PlanStartDate", "PlanEndDate", "EffectiveDate",
    "DepositType",
]


def repeat_deposits(
    rows: DataFrame, history: DataFrame | None = None, history_order: str = "row_id", batch: str = "file_seq",
    row: str = "source_row_no",
) -> DataFrame:
    """Add ``_lookup``, the repeat-posting error, to deposit rows that were posted before.

    ``history`` holds stored rows with ``file``, ``created_at``, ``check_type`` and ``error_message``.
    """
    dated = rows if "created_at" in rows.columns else rows.withColumn("created_at", F.current_timestamp())
    if history is not None:
        history = history.where(
            (F.col("check_type") == "PreCheck") & (T.text("error_message") == "") & (F.col("row_type") == "IH")
        )
    report = {"file": F.col("file"), "on": V.iso_date(F.col("created_at"))}
    found = earlier_posting(dated, DEPOSIT_KEYS, batch, row, report, history, history_order)
    text = F.concat(
        F.lit("Potential Duplicate Posting! Was probably posted earlier on '"), F.col("earlier.on"),
        F.lit("' as part of file '"), F.col("earlier.file"), F.lit("'"),
    )
    return found.withColumn("_lookup", F.when(F.col("earlier").isNotNull(), error("DuplicatePosting", text)))


# --- platform C ----------------------------------------------------------------------------


def clients_by_name(rows: DataFrame, clients: DataFrame, divisions: DataFrame) -> DataFrame:
    """Add ``client_id`` and ``client_division_id`` by client name and division name.

    A name that occurs twice takes the lowest id. The division counts only below its client.
    """
    named = one_per_key(clients, {"_cn": F.col("client_name")}, F.min("client_id").alias("client_id"))
    divided = one_per_key(
        divisions, {"_dc": F.col("client_id"), "_dn": F.col("division_name")},
        F.min("client_division_id").alias("client_division_id"),
    )
    out = rows.join(named, rows["ClientName"] == named["_cn"], "left").drop("_cn")
    return out.join(
        divided, (out["client_id"] == divided["_dc"]) & (out["ClientDivisionName"] == divided["_dn"]), "left"
    ).drop("_dc", "_dn")


def member_key(ssn: Column) -> Column:
    """SSN with or without dashes as nine digits."""
    return F.when(~T.is_blank(ssn), T.pad_left(T.ssn_digits(ssn), 9))


def member_by_ssn(
    rows: DataFrame, members: DataFrame, name: str, by_client: bool = True, ssn: str = "SSN"
) -> DataFrame:
    """Add ``name``: the member with this SSN in the division of the row, else in its client."""
    keyed = rows.withColumn("_ssn", member_key(F.col(ssn)))
    ids = members.withColumn("_ssn_key", member_key(F.col("ssn")))
    in_division = one_per_key(
        ids, {"_d": F.col("client_division_id"), "_dk": F.col("_ssn_key")}, F.min("member_id").alias("_in_division")
    )
    out = keyed.join(
        in_division, (keyed["client_division_id"] == in_division["_d"]) & (keyed["_ssn"] == in_division["_dk"]), "left"
    ).drop("_d", "_dk")
    found = F.col("_in_division")
    if by_client:
        in_client = one_per_key(
            ids, {"_c": F.col("client_id"), "_ck": F.col("_ssn_key")}, F.min("member_id").alias("_in_client")
        )
        out = out.join(
            in_client, (out["client_id"] == in_client["_c"]) & (out["_ssn"] == in_client["_ck"]), "left"
        ).drop("_c", "_ck")
        found = F.coalesce("_in_division", "_in_client")
    return out.withColumn(name, found).drop("_ssn", "_in_division", "_in_client")


def client_plan(rows: DataFrame, plans: DataFrame, links: DataFrame, plan: str = "PlanName") -> DataFrame:
    """Add ``has_client_plan`` (by name) and ``has_division_plan`` (the plan is linked to the division)."""
    by_name = {"client_id": "client_id", plan: "plan_name"}
    out = exists(rows, plans, by_name, "has_client_plan")
    linked = links.select("client_division_id", "client_plan_qb_id").join(
        plans.select("client_plan_qb_id", "client_id", "plan_name"), "client_plan_qb_id"
    )
    return exists(
        out, linked, {"client_division_id": "client_division_id", **by_name}, "has_division_plan"
    )


def plans_of_clients(plans: DataFrame, clients: DataFrame) -> DataFrame:
    """Plans (or members) of the given clients."""
    return plans.join(clients.select("client_id").distinct(), "client_id", "left_semi")


def clients_with_divisions(clients: DataFrame, divisions: DataFrame) -> DataFrame:
    """Every client with its divisions, and clients without one."""
    return clients.join(divisions, "client_id", "left")


MAIN_CODES = ("[QB]", "[QBLOOKUP]", "[SPM]", "[SPMLOOKUP]", "[NPM]", "[NPMLOOKUP]")
PLAN_CODES = ("[QBPLANINITIAL]", "[QBPLAN]", "[QBDEPENDENTPLANINITIAL]", "[QBDEPENDENTPLAN]")
ANY_PARENT_CODES = ("[MEMBERUSERDEFINEDFIELD]",)
FAMILIES = ("QB", "SPM", "NPM")


def family_of(code: Column) -> Column:
    """The member family of a bracket code: by its beginning."""
    out = None
    for family in FAMILIES:
        test = code.startswith(f"[{family}")
        out = F.when(test, family) if out is None else out.when(test, family)
    return out


def check_main_rows(
    mains: DataFrame, clients: DataFrame, divisions: DataFrame, members: dict[str, DataFrame],
    fail_if_exists: bool = False,
) -> DataFrame:
    """Main rows of platform C: client, division and member. Adds ``client_id``,
    ``client_division_id`` and ``main_ok`` (may rows below refer to this one?).

    ``members`` holds one table per family. NPM members belong to a division only; a look-up row
    names no division, so an NPM look-up searches all divisions of the client.
    """
    out = clients_by_name(mains, clients, divisions)
    npm = members["NPM"].join(divisions.select("client_division_id", "client_id"), "client_division_id")
    everyone = reduce(
        DataFrame.unionByName,
        [
            (npm if family == "NPM" else members[family]).select(
                "member_id", "client_id", "client_division_id", F.lit(family).alias("family"),
                F.concat_ws(":", F.lit(family), member_key(F.col("ssn"))).alias("ssn"),
            )
            for family in FAMILIES
        ],
    )
    family = family_of(F.col("row_type"))
    lookup = F.col("row_type").endswith("LOOKUP]")
    ssn_key = F.concat_ws(":", family, member_key(F.col("SSN")))
    in_division = one_per_key(
        everyone, {"_d": F.col("client_division_id"), "_dk": F.col("ssn")}, F.min("member_id").alias("_in_division")
    )
    in_client = one_per_key(
        everyone, {"_c": F.col("client_id"), "_ck": F.col("ssn")}, F.min("member_id").alias("_in_client")
    )
    out = out.withColumn("_ssn", ssn_key)
    out = out.join(
        in_division, (out["client_division_id"] == in_division["_d"]) & (out["_ssn"] == in_division["_dk"]), "left"
    )
    out = out.join(in_client, (out["client_id"] == in_client["_c"]) & (out["_ssn"] == in_client["_ck"]), "left")
    client_wide = (family != "NPM") | lookup
    member = F.coalesce("_in_division", F.when(client_wide, F.col("_in_client")))
    client, division = T.text("ClientName"), T.text("ClientDivisionName")
    no_client = F.col("client_id").isNull()
    no_division = ~no_client & ~T.is_blank(division) & F.col("client_division_id").isNull()
    no_npm_division = ~no_client & (family == "NPM") & ~lookup & F.col("client_division_id").isNull()
    no_ssn = ~no_client & T.is_blank(F.col("SSN"))
    unknown = ~no_client & lookup & member.isNull()
    exists_already = ~no_client & ~lookup & member.isNotNull() & F.lit(fail_if_exists)
    quoted = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    tests = [
        (no_client, error("ClientAndDivision", quoted("The Client Name '", client, "' could not be found"))),
        (
            no_client,
            error(
                "Client And Division Does Not Exist",
                quoted("Client with '", client, "' and Division Name '", division, "' Not Found."),
            ),
        ),
        (
            no_division,
            error(
                "ClientAndDivision",
                quoted("The Division Name '", division, "' could not be found for Client '", client, "'"),
            ),
        ),
        (no_npm_division, error("ClientDivisionId", F.lit("The Client and Division ID cannot be blank"))),
        (no_ssn, error("SSN", F.lit("The SSN cannot be blank"))),
        (
            unknown,
            error(quoted(family, " Not Found"), quoted(family, " with SSN '", T.text("SSN"), "' not found")),
        ),
        (
            exists_already,
            error(
                quoted(family, " Already exists"),
                quoted("Duplicate ", family, ". ", family, " with SSN '", T.text("SSN"), "' already exists"),
            ),
        ),
    ]
    bad = reduce(lambda a, b: a | b, [t for t, _ in tests])
    for test, found in tests:
        out = add_error(out, F.when(test, found))
    return out.select(*mains.columns, "client_id", "client_division_id", (~bad).alias("main_ok"))


C_KEYS = ["row_type", "ClientName", "ClientDivisionName", "SSN", "PlanName"]


def lookup_errors_c(
    rows: DataFrame,
    clients: DataFrame,
    divisions: DataFrame,
    members: dict[str, DataFrame],
    plans: DataFrame,
    plan_links: DataFrame,
    fail_if_exists: bool = False,
    hold: Callable[[DataFrame, str], DataFrame] = lambda df, label: df,
) -> DataFrame:
    """The errors of the reference checks of platform C: ``file, source_row_no, found``.

    Main rows are looked up, every other row gets the main row above it, and plan rows are checked
    against the client of theirs. Rows that failed a rule are checked all the same.
    """
    file_col, order = ROW_ID
    code = F.col("row_type")
    rows = rows.select(*ROW_ID, *C_KEYS, no_errors().alias("errors"))
    main = F.coalesce(code.isin(*MAIN_CODES), F.lit(False))
    mains = hold(check_main_rows(rows.where(main), clients, divisions, members, fail_if_exists), "mains")
    others = rows.where(~main).withColumns(
        {
            "client_id": F.lit(None).cast(mains.schema["client_id"].dataType),
            "client_division_id": F.lit(None).cast(mains.schema["client_division_id"].dataType),
            "main_ok": F.lit(None).cast("boolean"),
        }
    )
    payload = {
        "family": family_of(code),
        "ok": F.col("main_ok") & ~T.is_blank(F.col("SSN")),
        "client_id": F.col("client_id"),
        "client_division_id": F.col("client_division_id"),
        "client": F.col("ClientName"),
        "division": F.col("ClientDivisionName"),
    }
    placed = last_parent(mains.unionByName(others), main, payload, file_col, order)

    parent = F.col("parent")
    family = family_of(code)
    needs_parent = ~main & (family.isNotNull() | code.isin(*ANY_PARENT_CODES))
    fits = F.coalesce(parent["ok"] & (family.isNull() | (parent["family"] == family)), F.lit(False))
    wanted = F.coalesce(family, F.lit(", ".join(FAMILIES)))
    orphan = error(
        F.concat(F.lit("No Current "), wanted),
        F.concat(
            F.lit("Could Not Process this Record Type '"), code, F.lit("' as no Valid "), wanted,
            F.lit(" is referenced above"),
        ),
    )
    placed = add_error(placed, F.when(needs_parent & ~fits, orphan)).withColumn(
        "_plan_row", F.coalesce(code.isin(*PLAN_CODES) & fits, F.lit(False))
    )

    planned = placed.where("_plan_row").withColumns(
        {"client_id": parent["client_id"], "client_division_id": parent["client_division_id"]}
    )
    planned = client_plan(planned, plans, plan_links)
    head = F.concat(
        F.lit("The Plan '"), T.text("PlanName"), F.lit("' could not be found for Client '"),
        T.text(parent["client"]), F.lit("'"),
    )
    no_plan = F.when(~F.col("has_client_plan"), head).when(
        F.col("client_division_id").isNotNull() & ~F.col("has_division_plan"),
        F.concat(head, F.lit(" and Division '"), T.text(parent["division"]), F.lit("'")),
    )
    planned = add_error(planned, F.when(no_plan.isNotNull(), error("No Such Plan Found", no_plan)))
    rest = placed.where(~F.col("_plan_row"))
    both = planned.select(*ROW_ID, "errors").unionByName(rest.select(*ROW_ID, "errors"))
    return both.where(has_error()).withColumnRenamed("errors", "found")


def period_status(value: Column, start: Column, end: Column) -> Column:
    """Where a date lies: ``before`` its period, ``after`` it, or ``inside``; NULL if unknown."""
    return F.when(value < start, "before").when(value > end, "after").when(
        (value >= start) & (value <= end), "inside"
    )
