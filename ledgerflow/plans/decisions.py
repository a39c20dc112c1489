"""Queries on postings and decisions end to end, and on pages."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import closing, edits, identity, pages
from ledgerflow.plans import oracle as o
from ledgerflow.plans.queries import HISTORY_FROM, HISTORY_TO, _CANON, _REV, _day, _dbl, _payments_rev, query
from ledgerflow.sources import fixtures as fx

_NO_TEXT = lambda: F.lit(None).cast("string")
PAGE, SIZE = 2, 5


def _candidates(spark, sf):
    return fx.payments(spark, sf).select(
        F.col("id").alias("message_id"), "employee_id", _NO_TEXT().alias("name_raw"), "amount", _NO_TEXT().alias("payout_phone"), "payout_method", "txn_date",
        "txn_category", _NO_TEXT().alias("raw_content"))


@query("post_existing", o.with_ctes(["fx_payments"], [
    ("a", "SELECT id AS message_id, row_number() OVER (ORDER BY id) AS id FROM fx_payments WHERE id % 3 <> 0"),
    ("b", "SELECT id AS message_id, (SELECT count(*) FROM a) + row_number() OVER (ORDER BY id) AS id FROM fx_payments WHERE id % 3 = 0")],
    """SELECT message_id, id, 'repeated' AS outcome FROM a UNION ALL SELECT message_id, id, 'created' FROM b"""))
def post_existing(spark, sf):
    """T1 against what an earlier batch posted: two thirds are there, the rest is new."""
    c = _candidates(spark, sf)
    there = closing.post(c.where(F.col("message_id") % 3 != 0), None, created_by=F.lit("system")).payments
    out = closing.post(c, there, created_by=F.lit("system"))
    made = out.audit.select(F.col("entity_id").alias("id"), F.lit("created").alias("outcome")).join(out.payments.select("id", "message_id"), "id")
    return made.select("message_id", "id", "outcome").unionByName(out.rejected.select("message_id", "id", F.lit("repeated").alias("outcome")))


@query("reversal_batches", o.with_ctes(["fx_payments"], [
    ("n", "SELECT count(*) AS n FROM fx_payments"),
    ("p", "SELECT row_number() OVER (ORDER BY id) AS id FROM fx_payments"),
    ("r1", "SELECT id, n + row_number() OVER (ORDER BY id) AS rev FROM p, n WHERE id % 5 = 0"),
    ("top", "SELECT max(rev) AS t FROM r1"),
    ("ask", """SELECT id AS request_id, id AS txn_id FROM p WHERE id % 10 = 0 UNION ALL SELECT 10000000 + id, id FROM p WHERE id % 7 = 3
UNION ALL SELECT 20000000 + rev, rev FROM r1 UNION ALL SELECT 90000000 + id, 90000000 + id FROM p WHERE id % 50 = 0"""),
    ("fine", "SELECT request_id, row_number() OVER (ORDER BY request_id) AS k FROM ask WHERE txn_id % 7 = 3 AND request_id > 10000000 AND request_id < 20000000 AND txn_id % 5 <> 0")],
    """SELECT ask.request_id, ask.txn_id, CASE WHEN f.k IS NOT NULL THEN 'reversed' WHEN ask.txn_id > 90000000 THEN 'not_found'
  WHEN ask.request_id > 20000000 THEN 'already_a_reversal' ELSE 'already_reversed' END AS outcome, t + f.k AS reversal_id
FROM ask LEFT JOIN fine f USING (request_id), top"""))
def reversal_batches(spark, sf):
    """T2 twice: the second batch meets reversed payments, reversals and payments that are not there."""
    there = closing.post(_candidates(spark, sf), None, created_by=F.lit("system")).payments
    ask = lambda df, at: df.select((F.col("id") + at).alias("request_id"), F.col("id").alias("txn_id"), F.lit("wrong").alias("reason"), F.lit("ann").alias("actor"))
    first = closing.reverse(there, ask(there.where(F.col("id") % 5 == 0), 0))
    now = there.unionByName(first.payments.select(*there.columns))
    req = (ask(there.where(F.col("id") % 10 == 0), 0).unionByName(ask(there.where(F.col("id") % 7 == 3), 10000000)).unionByName(ask(first.payments, 20000000))
           .unionByName(ask(there.where(F.col("id") % 50 == 0).select((F.col("id") + 90000000).alias("id")), 0)))
    out = closing.reverse(now, req)
    ok = out.audit.select(F.col("entity_id").alias("txn_id"), F.get_json_object("after_state", "$.reversal_id").cast("long").alias("reversal_id"))
    done = req.join(out.rejected.select("request_id"), "request_id", "left_anti").join(ok, "txn_id").select("request_id", "txn_id", F.lit("reversed").alias("outcome"), "reversal_id")
    return done.unionByName(out.rejected.select("request_id", "txn_id", F.col("reject_reason").alias("outcome"), F.lit(None).cast("long").alias("reversal_id")))


@query("review_decisions", o.with_ctes(["fx_review_items"], [
    ("r", "SELECT *, review_status <> 'promoted' AS live, review_status <> 'promoted' AND coalesce(detected_amount, 0) > 0 AS pays FROM fx_review_items"),
    ("pay", "SELECT id, row_number() OVER (ORDER BY message_id) AS txn FROM r WHERE pays")],
    """SELECT r.id, CASE WHEN pays THEN 'promoted' WHEN live AND r.id % 2 = 0 THEN 'dismissed' ELSE review_status END AS review_status,
  CASE WHEN pays THEN message_id % 100 + 1 END AS resolved_employee_id, txn AS promoted_txn_id,
  CASE WHEN pays THEN 'bob' WHEN live AND r.id % 2 = 0 THEN 'ann' END AS reviewer,
  CASE WHEN pays THEN 1 ELSE 0 END + CASE WHEN live AND r.id % 2 = 0 THEN 1 ELSE 0 END AS n_audit,
  CASE WHEN pays THEN 0 ELSE 1 END + CASE WHEN live THEN 0 WHEN r.id % 2 = 0 THEN 1 ELSE 0 END AS n_refused
FROM r LEFT JOIN pay USING (id)"""))
def review_decisions(spark, sf):
    """T8 + T9: every item is promoted, every other one after a dismissal; payments posted, items closed, audit written."""
    r, i = fx.review_items(spark, sf).drop("reviewed_at"), F.col("id")
    none = lambda kind: F.lit(None).cast(kind)
    ask = lambda df, at, action, who, emp: df.select(
        (2 * i + at).alias("request_id"), i.alias("item_id"), F.lit(action).alias("action"), emp.alias("employee_id"), none("double").alias("amount"),
        none("string").alias("payout_method"), F.lit("2026-01-15").cast("date").alias("txn_date"), none("string").alias("txn_category"), F.lit(who).alias("reviewer"), none("string").alias("note"))
    d = ask(r.where(i % 2 == 0), 0, "dismiss", "ann", none("long")).unionByName(ask(r, 1, "promote", "bob", F.col("message_id") % 100 + 1))
    out = closing.decide_items(r, d, None)
    n = out.audit.where("entity_type = 'review_item'").groupBy(F.col("entity_id").alias("_a")).agg(F.count(F.lit(1)).alias("n_audit"))
    no = out.rejected.groupBy(F.col("item_id").alias("_r")).agg(F.count(F.lit(1)).alias("n_refused"))
    return out.table.join(n, i == F.col("_a"), "left").join(no, i == F.col("_r"), "left").select(
        "id", "review_status", "resolved_employee_id", "promoted_txn_id", "reviewer", F.coalesce("n_audit", F.lit(0)).alias("n_audit"), F.coalesce("n_refused", F.lit(0)).alias("n_refused"))


@query("requeue_audit", o.with_ctes(["fx_message_state"], [], """SELECT message_id, status AS old_status, attempts AS old_attempts,
  CASE WHEN message_id % 2 = 0 THEN attempts ELSE 0 END AS new_attempts FROM fx_message_state WHERE status = 'failed' AND attempts >= 5
UNION ALL SELECT message_id + 50000000, NULL, NULL, NULL FROM fx_message_state WHERE message_id % 100 = 1"""))
def requeue_audit(spark, sf):
    """T11 on the dead letters, every other one without a reset, and on messages that have no state."""
    s = fx.message_state(spark, sf).withColumn("last_error", F.lit("e"))
    m = F.col("message_id")
    req = s.where("status = 'failed' AND attempts >= 5").select(m.alias("request_id"), m, F.lit("ann").alias("reviewer"), (m % 2 != 0).alias("reset_attempts")).unionByName(
        s.where(m % 100 == 1).select((m + 50000000).alias("request_id"), (m + 50000000).alias("message_id"), F.lit("ann").alias("reviewer"), F.lit(True).alias("reset_attempts")))
    out = closing.requeue(s, req)
    got = lambda side, field: F.get_json_object(side, f"$.{field}")
    done = out.audit.select(F.col("entity_id").alias("message_id"), got("before_state", "status").alias("old_status"), got("before_state", "attempts").cast("int").alias("old_attempts"),
                            got("after_state", "attempts").cast("int").alias("new_attempts"))
    return done.unionByName(out.rejected.select("message_id", _NO_TEXT().alias("old_status"), F.lit(None).cast("int").alias("old_attempts"), F.lit(None).cast("int").alias("new_attempts")))


@query("employee_history_page", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON + [
    ("h", f"""SELECT c.canonical_id, pr.*, row_number() OVER (PARTITION BY c.canonical_id ORDER BY txn_date DESC, pr.id DESC) AS rank,
  count(*) OVER (PARTITION BY c.canonical_id) AS total
FROM pr JOIN canon c ON c.id = pr.employee_id WHERE NOT is_reversal AND txn_date BETWEEN DATE '{HISTORY_FROM}' AND DATE '{HISTORY_TO}'""")],
    f"""SELECT h.canonical_id, rank, total, CAST(ceil(total / {SIZE}.0) AS BIGINT) AS pages, h.id, strftime(txn_date, '%Y-%m-%d') AS txn_date, CAST(amount AS DOUBLE) AS amount,
  h.employee_id AS original_employee_id, e.full_name AS employee_name, e.primary_phone AS employee_id_phone
FROM h JOIN emp e ON e.id = h.employee_id WHERE rank > {(PAGE - 1) * SIZE} AND rank <= {PAGE * SIZE}""", recursive=True))
def employee_history_page(spark, sf):
    """T14, J10, F23's history variant: the second page of every employee's history."""
    emp = identity.prepare_master(fx.employees(spark, sf))
    p = _payments_rev(spark, sf).withColumns({"employee_name_raw": _NO_TEXT(), "payout_phone": _NO_TEXT()})
    h = pages.employee_history_page(p, identity.members(emp), emp, HISTORY_FROM, HISTORY_TO, page=PAGE, size=SIZE)
    return h.select("canonical_id", "rank", "total", "pages", "id", _day("txn_date").alias("txn_date"), _dbl("amount").alias("amount"), "original_employee_id", "employee_name", "employee_id_phone")


@query("payment_detail", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON, """SELECT pr.id, pr.employee_id, c.canonical_id AS canonical_employee_id, ce.employee_code,
  ce.full_name AS employee_display_name, ce.primary_phone AS employee_display_phone, CAST(pr.amount AS DOUBLE) AS amount, pr.is_reversal
FROM pr JOIN canon c ON c.id = pr.employee_id JOIN emp ce ON ce.id = c.canonical_id""", recursive=True))
def payment_detail(spark, sf):
    """Every payment with its canonical employee."""
    emp = identity.prepare_master(fx.employees(spark, sf))
    p = _payments_rev(spark, sf).withColumns({"employee_name_raw": _NO_TEXT(), "payout_phone": _NO_TEXT()})
    d = pages.payment_detail(p, emp, identity.resolve_canonical(emp))
    return d.select("id", "employee_id", "canonical_employee_id", "employee_code", "employee_display_name", "employee_display_phone", _dbl("amount").alias("amount"), "is_reversal")


@query("employee_pages", o.with_ctes(["fx_employees"], [
    ("e", """SELECT *, regexp_matches(coalesce(full_name, ''), '[A-Za-z\\x{0980}-\\x{09FF}]') AS letter, lower(coalesce(nullif(full_name, ''), primary_phone)) AS name
FROM fx_employees WHERE status = 'active' AND canonical_employee_id IS NULL"""),
    ("s", """SELECT 'name_asc' AS sort, id, row_number() OVER (ORDER BY letter DESC, name ASC NULLS LAST, id) AS rank FROM e
UNION ALL SELECT 'name_desc', id, row_number() OVER (ORDER BY letter DESC, name DESC NULLS LAST, id) FROM e
UNION ALL SELECT 'id_asc', id, row_number() OVER (ORDER BY id) FROM e UNION ALL SELECT 'id_desc', id, row_number() OVER (ORDER BY id DESC) FROM e""")],
    f"""SELECT sort, s.id, e.employee_code, (SELECT count(*) FROM e) AS total, CAST(ceil((SELECT count(*) FROM e) / 50.0) AS BIGINT) AS pages
FROM s JOIN e USING (id) WHERE rank > 50 AND rank <= 100"""))
def employee_pages(spark, sf):
    """The second page of the list in each of its sorts."""
    emp = identity.prepare_master(fx.employees(spark, sf))
    out = None
    for sort in pages.SORTS:
        part = pages.employee_page(emp, sort, page=2, size=50).select(F.lit(sort).alias("sort"), "id", "employee_code", "total", "pages")
        out = part if out is None else out.unionByName(part)
    return out


@query("edit_employees", o.with_ctes(["fx_employees"], [
    ("w", """SELECT e.*, id % 10 AS d, concat('01', lpad(CAST(710000000 + id // 10 AS VARCHAR), 9, '0')) AS x, id - id % 10 + 2 AS two, id - id % 10 + 3 AS three FROM fx_employees e"""),
    ("m", """SELECT w.*, a.status = 'active' AS on2, b.status = 'active' AS on3,
  CASE WHEN d = 3 AND a.status = 'active' THEN two WHEN d = 4 AND a.status = 'active' THEN two WHEN d = 4 AND b.status = 'active' THEN three END AS merged
FROM w LEFT JOIN fx_employees a ON a.id = w.two LEFT JOIN fx_employees b ON b.id = w.three""")],
    """SELECT id, CASE WHEN d = 3 THEN concat('New ', CAST(id AS VARCHAR)) ELSE full_name END AS full_name,
  CASE WHEN d IN (2, 3, 4) AND merged IS NULL THEN x END AS employee_id_phone, coalesce(merged, canonical_employee_id) AS canonical_employee_id,
  CASE WHEN d IN (2, 3, 4) THEN CAST(coalesce(merged, id) AS BIGINT) END AS final_id
FROM m"""))
def edit_employees(spark, sf):
    """Three rows of each ten are given one id phone, one after the other; a holder that is active takes the others in."""
    e, i = fx.employees(spark, sf), F.col("id")
    req = e.where((i % 10).isin(2, 3, 4)).select(
        i.alias("request_id"), i.alias("employee_id"), F.when(i % 10 == 3, F.concat(F.lit(" New "), i.cast("string"))).alias("full_name"), _NO_TEXT().alias("primary_phone"),
        F.concat(F.lit("+8801"), F.lpad((710000000 + F.floor(i / 10)).cast("string"), 9, "0")).alias("employee_id_phone"),
        F.lit(None).cast("array<struct<alias_type:string,alias_value:string>>").alias("aliases"))
    out = edits.edit_employees(e, fx.aliases(spark, sf), req)
    f = out.outcomes.select(F.col("employee_id").alias("_f"), "final_id")
    return out.employees.join(f, i == F.col("_f"), "left").select("id", "full_name", "employee_id_phone", "canonical_employee_id", "final_id")
