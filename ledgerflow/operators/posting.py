"""Routing, posting and the ledger (§3.1, T1-T7, A9, N5).

The whole message -> ledger path is one DAG: parse (narrow), route (narrow
plus a join to the allowed senders), match (joins on distinct keys), post
(anti join on the payment key) and the ledger (one aggregate on employee and
period, partially aggregated map-side). Nothing is collected.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.functions.text import (norm_phone, payment_ref, income_ref, period,
                                       reversal_ref)
from ledgerflow.operators import identity, matching
from ledgerflow.operators.ids import dense_ids

COMMANDS = ["cash_command", "income_command"]
POSTABLE = ["payment", "cash_command", "income_command"]


def route(parsed: DataFrame, authorized: DataFrame, parity: bool = False) -> DataFrame:
    """Decide each parsed message's path (§3.1 routing table).

    ``parsed`` needs ``message_id, message_type, payment, confidence,
    is_from_me, sender_phone``. Adds ``sender_norm``, ``authorized``,
    ``action`` (match / cash / income / skip), ``review_reason``,
    ``has_result`` and ``end_state`` for messages that stop here.

    parity=True keeps the source system's silent skips (Q9); the default
    sends unauthorised commands and payments not sent by the owner to review.
    """
    auth = authorized.select(F.col("command").alias("_ac"), F.col("phone").alias("_ap")).distinct() \
        .withColumn("_ok", F.lit(True))
    sender = F.coalesce(norm_phone("sender_phone"), F.col("sender_phone"), F.lit(""))
    p = parsed.withColumn("sender_norm", sender)
    p = p.join(auth, (p.message_type == auth._ac) & (p.sender_norm == auth._ap), "left") \
         .withColumn("authorized", F.coalesce("_ok", F.lit(False))).drop("_ac", "_ap", "_ok")
    mtype = F.col("message_type")
    from_me = F.coalesce(F.col("is_from_me"), F.lit(False))
    is_cmd = mtype.isin(*COMMANDS)
    amount = F.col("payment.amount")
    reason = (
        F.when((mtype == "other") & ~from_me, "accountant_other")
        .when(mtype == "other", "admin_other")
        .when(mtype == "balance_summary", "balance_summary")
        .when(is_cmd & ~F.col("authorized"), None if parity else "unauthorized_command")
        .when((mtype == "payment") & ~from_me & F.lit(parity), None)
        .when(amount.isNull(), "no_amount_in_parse")
        .when(amount <= 0, "non_positive_amount")
        .when((mtype == "payment") & ~from_me, "not_owner")
    )
    action = (
        F.when(~mtype.isin(*POSTABLE), "skip")
        .when(is_cmd & ~F.col("authorized"), "skip")
        .when(amount.isNull() | (amount <= 0), "skip")
        .when(mtype == "cash_command", "cash")
        .when(mtype == "income_command", "income")
        .when(from_me, "match")
        .otherwise("skip")
    )
    return p.select(
        "*",
        action.alias("action"),
        reason.alias("review_reason"),
        (~((mtype == "other") & ~from_me)).alias("has_result"),
    )


def review_rows_from_routing(routed: DataFrame) -> DataFrame:
    """Review rows for messages that stop at routing."""
    detected = F.col("message_type").isin(*POSTABLE)
    return routed.where(F.col("review_reason").isNotNull()).select(
        "message_id",
        F.col("review_reason").alias("reason"),
        F.col("raw_content"),
        F.when(detected, F.col("payment.amount")).alias("detected_amount"),
        F.when(detected, F.col("payment.payout_phone")).alias("detected_payout_phone"),
        F.when(detected, F.col("payment.name_raw")).alias("detected_employee_name"),
        F.when(detected, F.col("payment.payout_method")).alias("detected_payout_method"),
        F.when(detected, F.col("payment.txn_date")).alias("detected_txn_date"),
        F.col("confidence").alias("parser_confidence"),
        F.lit("pending").alias("review_status"),
    )


def match_requests(routed: DataFrame) -> DataFrame:
    """Payments from the owner and income commands, as match requests."""
    r = routed.where(F.col("action").isin("match", "income"))
    emp_phone_income = F.coalesce("payment.payout_phone", "payment.id_phone")
    return r.select(
        "message_id", "message_type", "action", "raw_content", "sender_norm",
        F.col("payment.name_raw").alias("name_raw"),
        F.when(F.col("action") == "income", emp_phone_income).otherwise(F.col("payment.payout_phone")).alias("payout_phone"),
        F.when(F.col("action") == "income", emp_phone_income).otherwise(F.col("payment.id_phone")).alias("id_phone"),
        F.col("payment.payout_method").alias("payout_method"),
        F.col("payment.amount").alias("amount"),
        F.col("payment.txn_date").alias("txn_date"),
    )


def match_or_create(requests: DataFrame, employees: DataFrame, aliases: DataFrame, fuzzy_names: bool = True) -> matching.Matched:
    """I1, I2, I3, I5 over a batch, in message order; the fuzzy tier can be left out (see ``matching``)."""
    return matching.match_in_order(requests, employees, aliases, fuzzy_names=fuzzy_names)


def _payment_rows(df: DataFrame, parity: bool, created_by) -> DataFrame:
    per = period("txn_date")
    return df.select(
        payment_ref("message_id", "employee_id", "amount", per, "payout_method", parity).alias("txn_ref"),
        "message_id", "employee_id",
        F.col("name_raw").alias("employee_name_raw"),
        "amount", "payout_phone", "payout_method", "txn_date",
        F.col("txn_category"),
        F.col("raw_content").alias("source_message_text"),
        F.lit(False).alias("is_reversal"),
        F.lit(None).cast("long").alias("reversed_txn_id"),
        per.alias("accounting_period"),
        created_by.alias("created_by"),
    )


def _first_per_key(rows: DataFrame, existing: DataFrame | None, order_col: str) -> DataFrame:
    """The first row of each ``txn_ref`` in ``order_col`` order (ties: the
    smallest row), without the keys already posted. The aggregate combines
    map-side, so a key repeated many times collapses before the shuffle."""
    rest = [c for c in rows.columns if c not in ("txn_ref", order_col)]
    first = rows.groupBy("txn_ref").agg(F.min(F.struct(order_col, *rest)).alias("_f")).select("txn_ref", "_f.*") \
                .select(*rows.columns)
    return first if existing is None else first.join(existing.select("txn_ref"), "txn_ref", "left_anti")


def _next_id(existing: DataFrame | None):
    return 0 if existing is None else existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()


def keyed_payments(candidates: DataFrame, existing: DataFrame | None, order_col: str = "message_id",
                   parity: bool = False, created_by=None) -> DataFrame:
    """The payments T1 adds, before they get ids: one per key, none posted before."""
    rows = _payment_rows(candidates, parity, created_by if created_by is not None else F.lit("system"))
    return _first_per_key(rows, existing, order_col)


def keyed_amounts(candidates: DataFrame, existing: DataFrame | None, order_col: str = "message_id",
                  parity: bool = False) -> DataFrame:
    """The payments T1 adds, in the columns that the ledger reads: no text is shuffled for it."""
    per = period("txn_date")
    rows = candidates.select(payment_ref("message_id", "employee_id", "amount", per, "payout_method", parity).alias("txn_ref"),
                             order_col, "employee_id", "amount", "txn_category", per.alias("accounting_period"))
    return _first_per_key(rows, existing, order_col)


def post_payments(candidates: DataFrame, existing: DataFrame | None, order_col: str = "message_id",
                  parity: bool = False, created_by=None) -> DataFrame:
    """Key each payment (F13), keep the first of each key in the batch, drop
    keys already posted (idempotent), give new ids in ``order_col`` order after
    the current maximum."""
    rows = keyed_payments(candidates, existing, order_col, parity, created_by)
    return dense_ids(rows, [F.col(order_col), F.col("txn_ref")], start=_next_id(existing))


def cash_commands(routed: DataFrame, employees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T5: an allowed cash command posts a cash salary to the employee whose
    primary or id phone is the command's phone (any status, no alias, no
    canonical; lowest id). Returns ``(payment_candidates, review_rows)``."""
    c = routed.where(F.col("action") == "cash").select(
        "message_id", "raw_content", "sender_norm", "confidence",
        F.col("payment.name_raw").alias("name_raw"),
        F.coalesce("payment.payout_phone", "payment.id_phone").alias("emp_phone"),
        F.col("payment.amount").alias("amount"),
        F.col("payment.txn_date").alias("txn_date"))
    master = identity.prepare_master(employees)
    by_phone = (master.select("id", F.col("primary_phone").alias("ph"))
                .unionByName(master.select("id", F.col("employee_id_phone").alias("ph")))
                .where(F.col("ph").isNotNull())
                .groupBy("ph").agg(F.min("id").alias("_emp")))
    j = c.join(by_phone, c.emp_phone == by_phone.ph, "left").drop("ph")
    found = j.where(F.col("_emp").isNotNull()).select(
        "message_id", F.col("_emp").alias("employee_id"), "name_raw",
        F.col("emp_phone").alias("payout_phone"), F.lit("cash").alias("payout_method"),
        "amount", "txn_date", F.lit("salary").alias("txn_category"), "raw_content",
        F.when(F.col("sender_norm") != "", norm_phone("sender_norm")).alias("_by"))
    missing = j.where(F.col("_emp").isNull()).select(
        "message_id", F.lit("cash_command_no_employee").alias("reason"), "raw_content",
        F.col("amount").alias("detected_amount"),
        F.col("emp_phone").alias("detected_payout_phone"),
        F.col("name_raw").alias("detected_employee_name"),
        F.lit(None).cast("string").alias("detected_payout_method"),
        F.lit(None).cast("date").alias("detected_txn_date"),
        F.col("confidence").alias("parser_confidence"),
        F.lit("pending").alias("review_status"))
    return found, missing


def post_income(assigned: DataFrame, existing: DataFrame | None = None, parity: bool = False) -> DataFrame:
    """Income commands to the income table (F14 key); no ledger."""
    inc = assigned.where(F.col("action") == "income")
    per = period("txn_date")
    rows = inc.select(
        income_ref("message_id", "employee_id", "amount", per, parity).alias("txn_ref"),
        "message_id", "employee_id", F.col("name_raw").alias("employee_name_raw"),
        "amount", "txn_date", per.alias("accounting_period"),
        norm_phone("sender_norm").alias("reported_by_phone"),
        F.col("raw_content").alias("source_message_text"))
    rows = _first_per_key(rows, existing, "message_id")
    return dense_ids(rows, [F.col("message_id"), F.col("txn_ref")], start=_next_id(existing))


def reverse_payments(payments: DataFrame, requests: DataFrame, reason_col: str = "reason",
                     actor_col: str = "actor") -> tuple[DataFrame, DataFrame]:
    """``requests(request_id, txn_id, reason, actor)`` -> (reversal rows,
    rejected requests with a reason). A reversal is a negative copy with the
    same date, period, category and method; the original is never changed."""
    rev_refs = payments.where("is_reversal").select(F.col("txn_ref").alias("_rref"))
    p = payments.select(*[F.col(c).alias(f"o_{c}") for c in payments.columns])
    j = requests.join(p, requests.txn_id == p.o_id, "left")
    j = j.withColumn("_rev_ref", reversal_ref("o_txn_ref"))
    j = j.join(rev_refs, j._rev_ref == rev_refs._rref, "left")
    # one reversal per original even if it is requested twice in a batch
    w = Window.partitionBy("txn_id").orderBy("request_id")
    j = j.withColumn("_n", F.row_number().over(w))
    reject = (F.when(F.col("o_id").isNull(), "not_found")
              .when(F.col("o_is_reversal"), "already_a_reversal")
              .when(F.col("_rref").isNotNull() | (F.col("_n") > 1), "already_reversed"))
    j = j.withColumn("reject_reason", reject)
    rejected = j.where(F.col("reject_reason").isNotNull()).select("request_id", "txn_id", "reject_reason")
    ok = j.where(F.col("reject_reason").isNull())
    rows = ok.select(
        F.col("_rev_ref").alias("txn_ref"), F.col("o_message_id").alias("message_id"),
        F.col("o_employee_id").alias("employee_id"), F.col("o_employee_name_raw").alias("employee_name_raw"),
        (-F.col("o_amount")).cast("decimal(12,2)").alias("amount"), F.col("o_payout_phone").alias("payout_phone"),
        F.col("o_payout_method").alias("payout_method"), F.col("o_txn_date").alias("txn_date"),
        F.col("o_txn_category").alias("txn_category"),
        F.concat(F.lit("REVERSAL: "), F.col(reason_col)).alias("source_message_text"),
        F.lit(True).alias("is_reversal"), F.col("txn_id").cast("long").alias("reversed_txn_id"),
        F.col("o_accounting_period").alias("accounting_period"),
        F.coalesce(F.col(actor_col), F.lit("admin")).alias("created_by"),
        "request_id")
    start = payments.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return dense_ids(rows, [F.col("request_id")], start=start).drop("request_id"), rejected


def ledger(payments: DataFrame, parity: bool = False, carry_forward: bool = False) -> DataFrame:
    """Per employee and period: paid (every category but advance, Q3),
    advance, count, closing balance.

    Closing is ``opening + earned - paid - advance`` (opening and earned are
    0, Q2). parity=True reproduces the source system's 0 closing for a
    period holding one payment (Q1). carry_forward=True makes each period's
    opening the previous period's closing, as a window per employee.
    """
    p = payments.where(F.col("employee_id").isNotNull())
    adv = F.col("txn_category") == "advance"
    g = p.groupBy("employee_id", "accounting_period").agg(
        F.sum(F.when(~adv, F.col("amount")).otherwise(F.lit(0))).cast("decimal(22,2)").alias("total_paid"),
        F.sum(F.when(adv, F.col("amount")).otherwise(F.lit(0))).cast("decimal(22,2)").alias("total_advance"),
        F.count(F.lit(1)).cast("int").alias("txn_count"),
    )
    out = g.withColumn("opening_balance", F.lit(0).cast("decimal(22,2)")) \
           .withColumn("total_earned", F.lit(0).cast("decimal(22,2)"))
    net = F.col("opening_balance") + F.col("total_earned") - F.col("total_paid") - F.col("total_advance")
    if carry_forward:
        w = Window.partitionBy("employee_id").orderBy("accounting_period") \
                  .rowsBetween(Window.unboundedPreceding, -1)
        prior = F.coalesce(F.sum(F.col("total_earned") - F.col("total_paid") - F.col("total_advance")).over(w),
                           F.lit(0))
        out = out.withColumn("opening_balance", prior.cast("decimal(22,2)"))
    closing = F.when(F.lit(parity) & (F.col("txn_count") == 1), F.lit(0)).otherwise(net)
    return out.withColumn("closing_balance", closing.cast("decimal(22,2)"))


def ledger_running(payments: DataFrame, chunk: int = 1 << 16) -> DataFrame:
    """The closing balance after each payment, per employee and period,
    in id order.

    A running sum split in two so a hot (employee, period) is not one task:
    sums inside id chunks (window per group and chunk), then the totals of
    earlier chunks (a window over one row per chunk) are added.
    """
    p = payments.where(F.col("employee_id").isNotNull()) \
                .withColumn("_chunk", F.floor(F.col("id") / F.lit(chunk)))
    grp = ["employee_id", "accounting_period"]
    wl = Window.partitionBy(*grp, "_chunk").orderBy("id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = p.select("id", *grp, "_chunk", "amount",
                     F.sum("amount").over(wl).alias("_run"), F.count(F.lit(1)).over(wl).alias("_seq"))
    totals = p.groupBy(*grp, "_chunk").agg(F.sum("amount").alias("_ct"), F.count(F.lit(1)).alias("_cn"))
    wp = Window.partitionBy(*grp).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offs = totals.select(*grp, "_chunk", F.coalesce(F.sum("_ct").over(wp), F.lit(0)).alias("_off"),
                         F.coalesce(F.sum("_cn").over(wp), F.lit(0)).alias("_noff"))
    j = local.join(offs, [*grp, "_chunk"])
    return j.select("id", *grp, "amount",
                    (-(F.col("_off") + F.col("_run"))).cast("decimal(22,2)").alias("closing_after"),
                    (F.col("_noff") + F.col("_seq")).cast("long").alias("seq"))


def manual_payments(requests: DataFrame, existing: DataFrame | None = None, parity: bool = False) -> DataFrame:
    """``requests(request_id, employee_id, amount, payout_method, txn_date,
    txn_category, note, actor)`` posted as payments with no message id and
    ``manual: <note>`` as text. fixed (Q6): the request id is part of the key,
    so two equal manual payments stay two; parity: the source system's key
    (no message id) collapses them into one (first request wins)."""
    per = period("txn_date")
    key_id = F.lit(None).cast("long") if parity else F.concat(F.lit("manual-"), F.col("request_id"))
    rows = requests.select(
        "request_id",
        payment_ref(key_id, "employee_id", "amount", per, "payout_method", parity).alias("txn_ref"),
        F.lit(None).cast("long").alias("message_id"), "employee_id",
        F.lit(None).cast("string").alias("employee_name_raw"), F.col("amount").cast("decimal(12,2)").alias("amount"),
        F.lit(None).cast("string").alias("payout_phone"), "payout_method", "txn_date", "txn_category",
        F.concat(F.lit("manual: "), F.coalesce("note", F.lit(""))).alias("source_message_text"),
        F.lit(False).alias("is_reversal"), F.lit(None).cast("long").alias("reversed_txn_id"),
        per.alias("accounting_period"), F.coalesce("actor", F.lit("admin")).alias("created_by"))
    first = rows.groupBy("txn_ref").agg(F.min("request_id").alias("request_id"))
    rows = rows.join(first, ["txn_ref", "request_id"])
    if existing is not None:
        rows = rows.join(existing.select("txn_ref"), "txn_ref", "left_anti")
        start = existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    else:
        start = 0
    return dense_ids(rows, [F.col("request_id")], start=start)
