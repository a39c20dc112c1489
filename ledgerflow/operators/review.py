"""Review queue decisions, message state transitions and audit rows
(T8-T12, S14).

Decisions arrive as tables and are applied with joins, so a batch of any
size is one job; every change also yields an audit row.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TERMINAL = ["done", "skipped", "failed"]
CATEGORIES = ["salary", "advance", "bonus", "deduction", "correction", "income"]


def audit_rows(before: DataFrame, after: DataFrame, key: str, fields: list[str], family: str,
               entity_type: str, actor: Column | str = "system", reason: Column | str | None = None) -> DataFrame:
    """One row per changed entity: create / update / delete with the
    before and after state as JSON (nulls kept)."""
    opts = {"ignoreNullFields": "false"}
    b = before.select(F.col(key).alias("_k"), F.to_json(F.struct(*fields), opts).alias("before_state"))
    a = after.select(F.col(key).alias("_k"), F.to_json(F.struct(*fields), opts).alias("after_state"))
    j = b.join(a, "_k", "full_outer")
    action = (F.when(F.col("before_state").isNull(), "create")
              .when(F.col("after_state").isNull(), "delete")
              .otherwise("update"))
    changed = ~F.col("before_state").eqNullSafe(F.col("after_state"))
    lit = lambda v: F.lit(v) if isinstance(v, str) or v is None else v
    return j.where(changed).select(
        F.lit(family).alias("family"), F.lit(entity_type).alias("entity_type"),
        F.col("_k").cast("long").alias("entity_id"), action.alias("action"),
        "before_state", "after_state", lit(actor).alias("actor"), lit(reason).cast("string").alias("reason"))


def promote(review: DataFrame, decisions: DataFrame, today: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """``decisions(item_id, employee_id, amount, payout_method, txn_date,
    txn_category, reviewer)`` -> (payment candidates, rejected with reason).
    Amount = override or detected and > 0; method = override, detected,
    unknown; date = override, detected, today; the category must be known;
    items already promoted are rejected (dismissed ones may be promoted)."""
    today = today if today is not None else F.current_date()
    r = review.select(F.col("id").alias("item_id"), "message_id", "review_status", "detected_amount",
                      "detected_payout_method", "detected_txn_date", "raw_content")
    j = decisions.join(r, "item_id", "left")
    amount = F.coalesce(F.col("amount").cast("decimal(12,2)"), F.col("detected_amount"))
    category = F.coalesce(F.col("txn_category"), F.lit("salary"))
    reject = (F.when(F.col("review_status").isNull(), "not_found")
              .when(F.col("review_status") == "promoted", "already_promoted")
              .when(amount.isNull() | (amount <= 0), "no_positive_amount")
              .when(~category.isin(*CATEGORIES), "bad_category")
              .when(F.col("employee_id").isNull(), "no_employee"))
    j = j.withColumn("reject_reason", reject)
    ok = j.where(F.col("reject_reason").isNull()).select(
        "item_id", "message_id", "employee_id", amount.alias("amount"),
        F.coalesce("payout_method", "detected_payout_method", F.lit("unknown")).alias("payout_method"),
        F.coalesce("txn_date", "detected_txn_date", today).alias("txn_date"),
        category.alias("txn_category"), "raw_content", F.col("reviewer").alias("created_by"))
    return ok, j.where(F.col("reject_reason").isNotNull()).select("item_id", "reject_reason")


def close_items(review: DataFrame, decisions: DataFrame, status: str) -> DataFrame:
    """Dismiss or mark duplicate; a promoted item cannot be closed.
    Returns the new review table (changed rows carry reviewer and note)."""
    d = decisions.select(F.col("item_id").alias("_i"), F.col("reviewer").alias("_rv"), F.col("note").alias("_nt"))
    j = review.join(d, review.id == d._i, "left")
    apply = F.col("_i").isNotNull() & (F.col("review_status") != "promoted")
    out = (j.withColumn("review_status", F.when(apply, F.lit(status)).otherwise(F.col("review_status")))
           .withColumn("reviewer", F.when(apply, F.col("_rv")).otherwise(F.col("reviewer")))
           .withColumn("review_note", F.when(apply, F.col("_nt")).otherwise(F.col("review_note"))))
    return out.drop("_i", "_rv", "_nt")


def mark_reviewed(review: DataFrame, item_ids: DataFrame, now: Column | None = None) -> DataFrame:
    """Flag and time only."""
    now = now if now is not None else F.current_timestamp()
    ids = item_ids.select(F.col("item_id").alias("_i")).distinct()
    j = review.join(ids, review.id == ids._i, "left")
    hit = F.col("_i").isNotNull()
    return (j.withColumn("reviewed", hit | F.coalesce(F.col("reviewed"), F.lit(False)))
             .withColumn("reviewed_at", F.when(hit, now).otherwise(F.col("reviewed_at"))).drop("_i"))


def requeue(state: DataFrame, message_ids: DataFrame, attempts: int = 0) -> DataFrame:
    """Any listed message back to pending, error cleared, attempts reset."""
    ids = message_ids.select(F.col("message_id").alias("_m")).distinct()
    j = state.join(ids, state.message_id == ids._m, "left")
    hit = F.col("_m").isNotNull()
    return (j.withColumn("status", F.when(hit, F.lit("pending")).otherwise(F.col("status")))
             .withColumn("attempts", F.when(hit, F.lit(attempts)).otherwise(F.col("attempts")))
             .withColumn("last_error", F.when(hit, F.lit(None).cast("string")).otherwise(F.col("last_error")))
             .drop("_m"))


def apply_transitions(state: DataFrame, transitions: DataFrame, parity: bool = True) -> DataFrame:
    """T12 as a fold of ``transitions(message_id, seq, status, error, at)``.

    parity=True: attempts rise by one at every transition (the source
    system's rule, Q7); parity=False counts failures only. The processed time
    is the time of the last transition into a terminal state. One aggregate
    per message (``max_by`` picks the last transition), no per-row loop.
    """
    t = transitions.groupBy("message_id").agg(
        F.max_by(F.struct("status", "error"), "seq").alias("_last"),
        F.count(F.lit(1)).alias("_n"),
        F.count_if(F.col("status") == "failed").alias("_fails"),
        F.max(F.when(F.col("status").isin(*TERMINAL), F.col("at"))).alias("_done_at"))
    j = state.join(t, "message_id", "left")
    bump = F.col("_n") if parity else F.col("_fails")
    has = F.col("_n").isNotNull()
    return (j.withColumn("status", F.when(has, F.col("_last.status")).otherwise(F.col("status")))
             .withColumn("last_error", F.when(has, F.col("_last.error")).otherwise(F.col("last_error")))
             .withColumn("attempts", (F.col("attempts") + F.coalesce(bump, F.lit(0))).cast("int"))
             .withColumn("processed_at", F.coalesce(F.col("_done_at"), F.col("processed_at")))
             .drop("_last", "_n", "_fails", "_done_at"))


AUDIT_PAGE = 100


def audit_list(audit: DataFrame, entity_id: int | None = None, action: str | None = None,
               actor: str | None = None, limit: int = AUDIT_PAGE, offset: int = 0) -> DataFrame:
    """Audit rows filtered by entity, action and actor, newest first
    (O7), one page. Rows of one batch share its time, so the order inside a
    batch is by entity id, descending. The page is a top-(offset + limit)
    per partition merged once (``TakeOrderedAndProject``), never a full sort."""
    f = audit
    for col, val in (("entity_id", entity_id), ("action", action), ("actor", actor)):
        if val is not None:
            f = f.where(F.col(col) == F.lit(val))
    return f.orderBy(F.col("entity_id").desc(), F.col("action")).offset(offset).limit(limit)
