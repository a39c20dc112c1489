"""Decisions end to end: what they post, change and leave in the audit."""
import datetime as dt
import json
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import closing, posting

CAND = ("message_id long, employee_id long, name_raw string, amount decimal(12,2), payout_phone string, payout_method string, txn_date date, "
        "txn_category string, raw_content string")
DAY = dt.date(2026, 1, 15)


def cand(m, e, amount="100.00", method="cash"):
    return (m, e, "A", Decimal(amount), "01700000001", method, DAY, "salary", "t")


def test_posting_against_what_is_there(spark):
    first = closing.post(spark.createDataFrame([cand(1, 7), cand(2, 7)], CAND), None, created_by=F.lit("system"))
    assert first.rejected.count() == 0
    there = first.payments
    out = closing.post(spark.createDataFrame([cand(2, 7), cand(3, 7), cand(3, 7), cand(4, 8, "5.50")], CAND), there, created_by=F.lit("me"))
    assert [(r.id, r.message_id) for r in out.payments.orderBy("id").collect()] == [(3, 3), (4, 4)]
    assert sorted((r.message_id, r.id, r.copies) for r in out.rejected.collect()) == [(2, 2, 1), (3, 3, 1)]
    audit = {r.entity_id: (r.action, json.loads(r.after_state)["amount"], r.before_state, r.actor) for r in out.audit.collect()}
    assert audit == {3: ("create", "100.00", None, "me"), 4: ("create", "5.50", None, "me")}


def test_reversals(spark):
    there = closing.post(spark.createDataFrame([cand(1, 7), cand(2, 7), cand(3, 8)], CAND), None, created_by=F.lit("system")).payments
    req = "request_id long, txn_id long, reason string, actor string"
    out = closing.reverse(there, spark.createDataFrame([(1, 1, "wrong", "a"), (2, 1, "again", "a"), (3, 9, "x", "a")], req))
    assert [(r.id, r.txn_ref[:4], r.amount, r.reversed_txn_id) for r in out.payments.collect()] == [(4, "REV-", Decimal("-100.00"), 1)]
    assert {r.request_id: r.reject_reason for r in out.rejected.collect()} == {2: "already_reversed", 3: "not_found"}
    a = out.audit.collect()
    assert [(r.action, r.entity_id, json.loads(r.before_state), json.loads(r.after_state)["reversal_id"], r.reason) for r in a] == [
        ("reverse", 1, {"id": 1, "amount": "100.00"}, 4, "wrong")]
    now = there.unionByName(out.payments)
    more = closing.reverse(now, spark.createDataFrame([(4, 1, "r", "a"), (5, 4, "r", "a"), (6, 2, "r", None)], req))
    assert {r.request_id: r.reject_reason for r in more.rejected.collect()} == {4: "already_reversed", 5: "already_a_reversal"}
    assert [(r.id, r.created_by) for r in more.payments.collect()] == [(5, "admin")]
    led = posting.ledger(now.unionByName(more.payments)).collect()
    assert sorted((r.employee_id, r.total_paid, r.txn_count) for r in led) == [(7, Decimal("0.00"), 4), (8, Decimal("100.00"), 1)]


def test_decisions_on_review_items(spark):
    review = spark.createDataFrame(
        [(1, 11, "pending", Decimal("50.00"), "0171", "Rahim", "bkash", None, "t1"), (2, 12, "pending", None, None, None, "gold", DAY, "t2"),
         (3, 13, "promoted", Decimal("5.00"), None, None, None, None, "t3"), (4, 14, "dismissed", Decimal("9.00"), None, None, None, None, "t4"),
         (5, 15, "pending", Decimal("7.00"), None, None, None, None, "t5"), (6, 16, "pending", Decimal("7.00"), None, None, None, None, "t6")],
        "id long, message_id long, review_status string, detected_amount decimal(12,2), detected_payout_phone string, detected_employee_name string, "
        "detected_payout_method string, detected_txn_date date, raw_content string")
    dec = spark.createDataFrame(
        [(1, 1, "dismiss", None, None, None, None, None, "ann", "no"), (2, 1, "promote", 7, None, None, None, None, "bob", None),
         (3, 1, "dismiss", None, None, None, None, None, "ann", "late"), (4, 2, "promote", 7, None, None, None, None, "bob", None),
         (5, 2, "promote", 7, 12.5, None, None, "advance", "bob", "by hand"), (6, 3, "promote", 7, None, None, None, None, "bob", None),
         (7, 4, "promote", 8, None, "nagad", None, "gift", "bob", None), (8, 4, "promote", 8, None, "nagad", None, "bonus", "bob", None),
         (9, 5, "dismiss", None, None, None, None, None, "ann", "a"), (10, 5, "duplicate", None, None, None, None, None, "ann", "b"),
         (11, 99, "dismiss", None, None, None, None, None, "ann", "a"), (12, 6, "promote", None, None, None, None, None, "bob", None), (13, 6, "fix", None, None, None, None, None, "bob", None)],
        "request_id long, item_id long, action string, employee_id long, amount double, payout_method string, txn_date date, txn_category string, reviewer string, note string")
    out = closing.decide_items(review, dec, None, today=F.lit(DAY))
    assert {r.request_id: r.reject_reason for r in out.rejected.collect()} == {
        3: "already_promoted", 4: "no_positive_amount", 6: "already_promoted", 7: "bad_category", 11: "not_found", 12: "no_employee", 13: "invalid_action"}
    pay = {r.message_id: (r.id, r.employee_id, r.amount, r.payout_method, r.txn_category, r.created_by, r.payout_phone, r.employee_name_raw) for r in out.payments.collect()}
    assert pay == {11: (1, 7, Decimal("50.00"), "bkash", "salary", "review:bob", "0171", "Rahim"), 12: (2, 7, Decimal("12.50"), "unknown", "advance", "review:bob", None, None),
                   14: (3, 8, Decimal("9.00"), "nagad", "bonus", "review:bob", None, None)}
    now = {r.id: (r.review_status, r.resolved_employee_id, r.promoted_txn_id, r.reviewer, r.review_note, r.reviewed) for r in out.table.collect()}
    assert now == {1: ("promoted", 7, 1, "bob", None, True), 2: ("promoted", 7, 2, "bob", "by hand", True), 3: ("promoted", None, None, None, None, False),
                   4: ("promoted", 8, 3, "bob", None, True), 5: ("duplicate", None, None, "ann", "b", True), 6: ("pending", None, None, None, None, False)}
    audit = sorted((r.action, r.entity_id, r.before_state and json.loads(r.before_state).get("review_status"), json.loads(r.after_state).get("review_status")) for r in out.audit.collect())
    assert audit == [("create", 1, None, None), ("create", 2, None, None), ("create", 3, None, None), ("dismiss", 1, "pending", "dismissed"), ("dismiss", 5, "pending", "dismissed"),
                     ("duplicate", 5, "dismissed", "duplicate"), ("promote", 1, "dismissed", "promoted"), ("promote", 2, "pending", "promoted"), ("promote", 4, "dismissed", "promoted")]
    # the same promotions against the payments there: nothing is posted twice, items resolve to the rows there
    again = closing.decide_items(review, dec.where("request_id IN (2, 8)"), out.payments, today=F.lit(DAY))
    assert again.payments.count() == 0
    assert {r.id: r.promoted_txn_id for r in again.table.where("promoted_txn_id IS NOT NULL").collect()} == {1: 1, 4: 3}


def test_requeue(spark):
    state = spark.createDataFrame([(1, "failed", 5, "e"), (2, "done", 2, None), (3, "failed", 6, "e")], "message_id long, status string, attempts int, last_error string")
    req = spark.createDataFrame([(1, 1, "a", None), (2, 2, "a", False), (3, 2, "a", True), (4, 9, "a", None), (5, 2, "a", False)], "request_id long, message_id long, reviewer string, reset_attempts boolean")
    out = closing.requeue(state, req)
    assert {r.message_id: (r.status, r.attempts, r.last_error) for r in out.table.collect()} == {1: ("pending", 0, None), 2: ("pending", 0, None), 3: ("failed", 6, "e")}
    assert [r.request_id for r in out.rejected.collect()] == [4]
    audit = sorted((r.entity_id, json.loads(r.before_state)["status"], json.loads(r.before_state)["attempts"], json.loads(r.after_state)["attempts"]) for r in out.audit.collect())
    assert audit == [(1, "failed", 5, 0), (2, "done", 2, 2), (2, "pending", 0, 0), (2, "pending", 2, 0)]
