"""T1, T2, T8, T9, T11 end to end: what a decision posts, changes and leaves in the audit.

Each operator takes the tables as they are and a batch of requests in request order, and gives
the rows to append, the new state of what it changes, what it refused and one audit row for
each change. Keys posted before are not posted again; the request resolves to the row there.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import payment_ref, period
from ledgerflow.operators import posting
from ledgerflow.operators.edits import audit_row
from ledgerflow.operators.review import CATEGORIES
from ledgerflow.sources.scratch import stored

METHODS = ["bkash", "nagad", "cash", "rocket", "bank", "unknown"]
_KEEP = {"ignoreNullFields": "false"}


@dataclass
class Closed:
    """Payments added, the changed table (reviews or states; none for postings), refused requests, audit rows."""

    payments: DataFrame | None
    table: DataFrame | None
    rejected: DataFrame
    audit: DataFrame


def _text(c: str) -> Column:
    return F.col(c).cast("string").alias(c)


def _created(rows: DataFrame) -> DataFrame:
    """The audit row of each payment added."""
    after = F.to_json(F.struct("txn_ref", "employee_id", _text("amount"), "payout_method", _text("txn_date"), "accounting_period", "txn_category"), _KEEP)
    return rows.select(*audit_row("create", "transaction", F.col("id"), F.lit(None).cast("string"), after, F.col("created_by"), F.lit(None)))


def post(candidates: DataFrame, existing: DataFrame | None, order_col: str = "message_id", created_by: Column | None = None, parity: bool = False) -> Closed:
    """T1 with its audit. ``rejected`` lists the candidates whose key was there, in the batch or before it,
    with the id of the payment they resolve to."""
    rows = stored(posting.post_payments(candidates, existing, order_col, parity, created_by), "payments")
    ref = payment_ref("message_id", "employee_id", "amount", period("txn_date"), "payout_method", parity)
    known = rows.select("txn_ref", "id", F.col(order_col).alias("_by"))
    if existing is not None:
        known = known.unionByName(existing.select("txn_ref", "id", F.lit(None).cast(rows.schema[order_col].dataType).alias("_by")))
    asked = candidates.select(order_col, ref.alias("txn_ref"))
    # the candidate that made the row is no repeat; of equal candidates of one order, one made it
    per = asked.groupBy("txn_ref", order_col).agg(F.count(F.lit(1)).alias("_n")).join(known, "txn_ref")
    again = per.withColumn("copies", F.col("_n") - F.coalesce((F.col("_by") == F.col(order_col)).cast("int"), F.lit(0))).where(F.col("copies") > 0)
    return Closed(rows, None, again.select(order_col, "txn_ref", "id", "copies"), _created(rows))


def reverse(payments: DataFrame, requests: DataFrame) -> Closed:
    """T2 with its audit: ``requests(request_id, txn_id, reason, actor)``. Refused: not found, a reversal itself,
    reversed before or earlier in the batch."""
    rows, rejected = posting.reverse_payments(payments, requests)
    rows = stored(rows, "reversals")
    original = payments.select(F.col("id").alias("reversed_txn_id"), F.col("amount").alias("_amount"))
    j = rows.join(original, "reversed_txn_id").join(requests.select(F.col("txn_id").alias("reversed_txn_id"), "request_id", "reason"), "reversed_txn_id") \
            .join(rejected.select("request_id"), "request_id", "left_anti")
    audit = j.select(*audit_row("reverse", "transaction", F.col("reversed_txn_id"),
                                F.to_json(F.struct(F.col("reversed_txn_id").alias("id"), F.col("_amount").cast("string").alias("amount"))),
                                F.to_json(F.struct(F.col("id").alias("reversal_id"), F.col("txn_ref").alias("reversal_ref"))), F.col("created_by"), F.col("reason")))
    return Closed(rows, None, rejected, audit)


def decide_items(review: DataFrame, decisions: DataFrame, payments: DataFrame | None, today: Column | None = None, parity: bool = False) -> Closed:
    """T8 + T9 for ``decisions(request_id, item_id, action, employee_id, amount, payout_method, txn_date,
    txn_category, reviewer, note)``, action ``promote``, ``dismiss`` or ``duplicate``, in request order.

    An item is promoted once, by its first valid promotion: that posts a payment (amount, method and
    date from the decision, else detected, else unknown method and today) and closes the item with the
    payment's id. Before that it may be dismissed, again and again, and promoted afterwards; after it
    every decision on it is refused.
    """
    today = today if today is not None else F.current_date()
    keep = [c for c in review.columns if c not in ("review_status", "resolved_employee_id", "promoted_txn_id", "reviewer", "review_note", "reviewed", "reviewed_at")]
    old = lambda c, kind: F.col(c) if c in review.columns else F.lit(None).cast(kind)
    item = review.select(F.col("id").alias("item_id"), "message_id", "review_status", "detected_amount", old("detected_payout_phone", "string").alias("_phone"),
                         old("detected_employee_name", "string").alias("_name"), old("detected_payout_method", "string").alias("_method"),
                         old("detected_txn_date", "date").alias("_date"), old("raw_content", "string").alias("raw_content"), old("promoted_txn_id", "long").alias("_txn"))
    j = decisions.join(item, "item_id", "left")
    promote = F.col("action") == "promote"
    amount = F.coalesce(F.col("amount").cast("decimal(12,2)"), F.col("detected_amount")).cast("decimal(12,2)")
    method = F.coalesce("payout_method", "_method", F.lit("unknown"))
    category = F.coalesce("txn_category", F.lit("salary"))
    there = F.col("review_status").isNotNull()
    bad = (F.when(~F.coalesce(F.col("action").isin("promote", "dismiss", "duplicate"), F.lit(False)), "invalid_action").when(~there, "not_found")
           .when((F.col("review_status") == "promoted") | F.col("_txn").isNotNull(), "already_promoted")
           .when(promote & F.col("employee_id").isNull(), "no_employee").when(promote & (amount.isNull() | (amount <= 0)), "no_positive_amount")
           .when(promote & ~category.isin(CATEGORIES), "bad_category"))
    j = stored(j.withColumns({"reject_reason": bad, "_amount": amount, "_m": F.when(method.isin(METHODS), method).otherwise("unknown"), "_c": category,
                              "_d": F.coalesce("txn_date", "_date", today)}), "decisions")
    per = j.where(F.col("reject_reason").isNull()).groupBy("item_id").agg(
        F.min(F.when(promote, F.col("request_id"))).alias("_promoted"))
    j = j.join(per, "item_id", "left")
    late = F.coalesce(F.col("request_id") > F.col("_promoted"), F.lit(False))
    j = stored(j.withColumn("reject_reason", F.coalesce("reject_reason", F.when(late, "already_promoted"))), "decisions")
    rejected = j.where(F.col("reject_reason").isNotNull()).select("request_id", "item_id", "reject_reason")
    ok = j.where(F.col("reject_reason").isNull())
    # the state before each decision: the last one applied before it in the batch, else the stored one
    status = F.when(F.col("action") == "dismiss", "dismissed").when(F.col("action") == "duplicate", "duplicate").otherwise("promoted")
    mine = ok.select("item_id", F.col("request_id").alias("_r"), status.alias("_s"))
    before = ok.join(mine, "item_id").where(F.col("_r") < F.col("request_id")).groupBy("request_id").agg(F.max_by("_s", "_r").alias("_was"))
    ok = stored(ok.join(before, "request_id", "left").withColumns({"_was": F.coalesce("_was", "review_status"), "_now": status}), "applied")
    done = ok.where(promote)
    cands = done.select("request_id", "message_id", "employee_id", F.col("_name").alias("name_raw"), F.col("_amount").alias("amount"), F.col("_phone").alias("payout_phone"),
                        F.col("_m").alias("payout_method"), F.col("_d").alias("txn_date"), F.col("_c").alias("txn_category"), "raw_content",
                        F.concat(F.lit("review:"), "reviewer").alias("_by"))
    rows = stored(posting.post_payments(cands.withColumn("_order", F.col("message_id")), payments, "message_id", parity, F.col("_by")), "payments")
    refs = rows.select("txn_ref", F.col("id").alias("txn_id"))
    if payments is not None:
        refs = refs.unionByName(payments.select("txn_ref", F.col("id").alias("txn_id")))
    ref = payment_ref("message_id", "employee_id", "amount", period("txn_date"), "payout_method", parity)
    paid = stored(cands.withColumn("txn_ref", ref).join(refs, "txn_ref").select("request_id", "txn_ref", "txn_id"), "promoted")
    full = ok.join(paid, "request_id", "left")
    olds = F.when(promote, F.to_json(F.struct(F.col("_was").alias("review_status"), _text("detected_amount"), F.col("_name").alias("detected_employee_name"),
                                              F.col("_method").alias("detected_payout_method")), _KEEP)).otherwise(F.to_json(F.struct(F.col("_was").alias("review_status"))))
    news = F.when(promote, F.to_json(F.struct(
        F.col("_now").alias("review_status"), F.col("employee_id").alias("resolved_employee_id"), F.col("txn_id").alias("promoted_txn_id"), "txn_ref",
        F.col("_amount").cast("string").alias("amount"), F.col("_m").alias("payout_method"), F.col("_d").cast("string").alias("txn_date"), F.col("_c").alias("txn_category"),
        F.col("amount").isNotNull().alias("amount_override_used")), _KEEP)).otherwise(F.to_json(F.struct(F.col("_now").alias("review_status"))))
    audit = full.select("request_id", *audit_row("", "review_item", F.col("item_id"), olds, news, F.col("reviewer"), F.col("note")), F.col("action").alias("_a")) \
        .withColumn("action", F.col("_a")).drop("_a", "request_id")
    last = full.groupBy("item_id").agg(F.max_by(F.struct("_now", "reviewer", "note", "employee_id", "txn_id"), "request_id").alias("l"))
    hit = F.col("item_id").isNotNull()
    gone = F.col("l._now") == "promoted"
    table = review.join(last, review.id == last.item_id, "left").select(
        *keep, F.when(hit, F.col("l._now")).otherwise(F.col("review_status")).alias("review_status"),
        F.when(gone, F.col("l.employee_id")).otherwise(old("resolved_employee_id", "long")).alias("resolved_employee_id"),
        F.when(gone, F.col("l.txn_id")).otherwise(old("promoted_txn_id", "long")).alias("promoted_txn_id"),
        F.when(hit, F.col("l.reviewer")).otherwise(old("reviewer", "string")).alias("reviewer"),
        F.when(hit, F.coalesce("l.note", old("review_note", "string"))).otherwise(old("review_note", "string")).alias("review_note"),
        (hit | F.coalesce(old("reviewed", "boolean"), F.lit(False))).alias("reviewed"))
    return Closed(rows, table, rejected, _created(rows).unionByName(audit))


def requeue(state: DataFrame, requests: DataFrame) -> Closed:
    """T11 with its audit: ``requests(request_id, message_id, reviewer, reset_attempts)``; any message that has a
    state goes back to pending, its error cleared, its attempts reset unless told otherwise."""
    j = requests.join(state.select("message_id", F.col("status").alias("_status"), F.col("attempts").alias("_attempts")), "message_id", "left")
    rejected = j.where(F.col("_status").isNull()).select("request_id", "message_id", F.lit("not_found").alias("reject_reason"))
    reset = F.coalesce("reset_attempts", F.lit(True))
    ok = stored(j.where(F.col("_status").isNotNull()).withColumn("_reset", reset), "requeued")
    per = ok.groupBy("message_id").agg(F.min("request_id").alias("_first"), F.min(F.when(F.col("_reset"), F.col("request_id"))).alias("_zero"))
    ok = ok.join(per, "message_id")
    # attempts before a request: none once an earlier one has reset them
    had = F.when(F.coalesce(F.col("_zero") < F.col("request_id"), F.lit(False)), F.lit(0)).otherwise(F.col("_attempts"))
    was = F.when(F.col("request_id") == F.col("_first"), F.col("_status")).otherwise("pending")
    audit = ok.select(*audit_row("dlq_requeue", "message", F.col("message_id"), F.to_json(F.struct("message_id", was.alias("status"), had.alias("attempts"))),
                                 F.to_json(F.struct(F.lit("pending").alias("status"), F.when(F.col("_reset"), F.lit(0)).otherwise(had).alias("attempts"))),
                                 F.col("reviewer"), F.lit(None)))
    p = per.select(F.col("message_id").alias("_m"), F.col("_zero").isNotNull().alias("_z"))
    hit = F.col("_m").isNotNull()
    table = state.join(p, state.message_id == p._m, "left").withColumns(
        {"status": F.when(hit, "pending").otherwise(F.col("status")), "attempts": F.when(hit & F.col("_z"), F.lit(0)).otherwise(F.col("attempts")),
         "last_error": F.when(~hit, F.col("last_error")) if "last_error" in state.columns else F.lit(None).cast("string")}).drop("_m", "_z")
    return Closed(None, table, rejected, audit)
