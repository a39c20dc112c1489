"""Lists in pages, with their totals.

One page of one list is an ordered cut; the whole list is never collected. Pages of many groups
at once (the history of every employee) come from one range sort by group and order: a row's place
in its group is its place in the whole less its group's first, so a group that holds a third
of all rows is ranked in many tasks.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import NAME_LETTER, page_count
from ledgerflow.operators.ids import dense_ids
from ledgerflow.sources.scratch import stored

SORTS = ["name_asc", "name_desc", "id_asc", "id_desc"]


def page_of(df: DataFrame, order: list[Column], page: int, size: int) -> DataFrame:
    """One page, each row with the list's ``total`` and ``pages``."""
    total = df.agg(F.count(F.lit(1)).alias("total")).withColumn("pages", page_count("total", size))
    return df.orderBy(*order).offset((page - 1) * size).limit(size).join(F.broadcast(total))        # one row


def page_of_groups(df: DataFrame, group: str, order: list[Column], page: int, size: int) -> DataFrame:
    """The page of every group, with ``rank`` in the group, ``total`` and ``pages``."""
    placed = stored(dense_ids(df, [F.col(group), *order], name="_place"), "places")
    per = placed.groupBy(group).agg(F.min("_place").alias("_first"), F.count(F.lit(1)).alias("total")).withColumnRenamed(group, "_g")
    out = placed.join(per, placed[group] == per._g).withColumn("rank", F.col("_place") - F.col("_first") + 1)
    low = (page - 1) * size
    return out.where((F.col("rank") > low) & (F.col("rank") <= low + size)).withColumn("pages", page_count("total", size, zero_is_one=False)).drop("_place", "_first", "_g")


def employee_history_page(payments: DataFrame, members: DataFrame, employees: DataFrame, date_from=None, date_to=None, page: int = 1, size: int = 20) -> DataFrame:
    """T14, J10 for every canonical employee: a page of the payments of all its members (no reversals, dates
    inclusive), newest first, as recorded, with the name and id phone of the employee of record: name as
    parsed, else of the record, else ``(unknown)``; id phone of the record, its phone, the payout phone."""
    q = payments.where(~F.col("is_reversal"))
    if date_from is not None:
        q = q.where(F.col("txn_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        q = q.where(F.col("txn_date") <= F.lit(date_to).cast("date"))
    narrow = q.select("id", "txn_date", "employee_id").join(members, F.col("employee_id") == F.col("member_id")).drop("member_id")
    cut = page_of_groups(narrow, "canonical_id", [F.col("txn_date").desc_nulls_first(), F.col("id").desc()], page, size)
    rest = q.drop("txn_date", "employee_id")
    e = employees.select(F.col("id").alias("_e"), F.col("full_name").alias("_name"), F.col("employee_id_phone").alias("_idp"), F.col("primary_phone").alias("_ph"))
    j = cut.join(rest, "id").join(e, F.col("employee_id") == F.col("_e"), "left")
    return j.select("canonical_id", "rank", "total", "pages", "id", *[c for c in ("txn_ref", "accounting_period", "txn_category", "payout_method", "payout_phone") if c in rest.columns],
                    "txn_date", "amount", F.col("employee_id").alias("original_employee_id"), F.col("_name").alias("original_employee_name"),
                    F.coalesce("employee_name_raw", "_name", F.lit("(unknown)")).alias("employee_name"), F.coalesce("_idp", "_ph", "payout_phone").alias("employee_id_phone"))


def payment_detail(payments: DataFrame, employees: DataFrame, canonical: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """Payments, all or those of ``ids(id)``, with the canonical employee and the display fallbacks."""
    p = payments if ids is None else payments.join(ids.select("id").distinct(), "id", "left_semi")
    e = employees.select(F.col("id").alias("_id"), F.col("full_name").alias("_n"), F.col("employee_id_phone").alias("_i"), F.col("primary_phone").alias("_p"), F.col("employee_code").alias("_code"))
    own = canonical.select(F.col("id").alias("_own"), F.col("canonical_id").alias("_can"))
    both = own.join(e.toDF("_own", "_en", "_ei", "_ep", "_ecode"), "_own", "left").join(e.toDF("_can", "_cn", "_ci", "_cp", "_ccode"), "_can", "left")
    j = p.join(both, p.employee_id == both._own, "left")
    return j.select(*p.columns, F.col("_can").alias("canonical_employee_id"), F.col("_ccode").alias("employee_code"),
                    F.coalesce("employee_name_raw", "_cn", "_en", F.lit("(unknown)")).alias("employee_display_name"),
                    F.coalesce("_ci", "_ei", "_cp", "_ep", "payout_phone").alias("employee_display_id_phone"),
                    F.coalesce("_cp", "_ep", "payout_phone").alias("employee_display_phone"))


def employee_order(sort: str) -> list[Column]:
    """O2: by name (rows with a letter in it first) or by id, either way."""
    letter = F.coalesce(F.col("full_name"), F.lit("")).rlike(NAME_LETTER)
    name = F.lower(F.coalesce(F.when(F.col("full_name") != "", F.col("full_name")), "primary_phone", "employee_id_phone"))
    return {"name_asc": [letter.desc(), name.asc_nulls_last(), F.col("id").asc()], "name_desc": [letter.desc(), name.desc_nulls_last(), F.col("id").asc()],
            "id_asc": [F.col("id").asc()], "id_desc": [F.col("id").desc()]}[sort]


def employee_page(employees: DataFrame, sort: str = "name_asc", page: int = 1, size: int = 50, status: str | None = "active", canonical_only: bool = True) -> DataFrame:
    """I18's page of rows, in any of ``SORTS``, cut before anything is joined to it, with the list's total."""
    e = employees if status is None else employees.where(F.col("status") == status)
    if canonical_only:
        e = e.where(F.col("canonical_employee_id").isNull())
    return page_of(e, employee_order(sort), page, size)


def run_list(runs: DataFrame, page: int = 1, size: int = 50) -> DataFrame:
    """Gap or pipeline runs, the latest first."""
    return page_of(runs, [F.col("started_at").desc_nulls_last(), F.col("run_id").desc()], page, size)


def sync_status(checkpoints: DataFrame) -> DataFrame:
    """Checkpoints by their last sync, the latest first, never synced ones last."""
    return checkpoints.orderBy(F.col("last_sync_at").desc_nulls_last(), "source", "source_number", "chat_jid")
