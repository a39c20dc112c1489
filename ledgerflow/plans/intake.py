"""Queries on intake and fill-in: chats to read, conformed store rows, extractions, a filtered reconciliation."""
from __future__ import annotations

from pyspark.sql import functions as F

from ledgerflow.operators import reports
from ledgerflow.operators.parse import apply_extractions
from ledgerflow.plans import oracle as o
from ledgerflow.plans.queries import _REV, _dbl, _parsed, _payments_rev, query, sql_with_parse
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import ingest

PERIOD, SOURCE = "1996-03", "bridge1"
CHATS = " 01700000001@c , ,01700000002@c,01700000003@c "
# the times of the store below, by row number modulo eight, as formats of both engines; the last two are no times
_TIMES = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss'Z'", "yyyy-MM-dd HH:mm:ss'+00:00'", "yyyy-MM-dd'T'HH:mm:ss'+06:00'",
          "yyyy-MM-dd HH:mm:ss'-0330'", "dd/MM/yyyy", "yyyy-MM-dd'T'HH:mm"]


@query("conform_store", o.with_ctes(["fx_messages"], [
    ("r", "SELECT id - 1 AS k, wa_message_id, raw_content, timestamp_wa, is_from_me FROM fx_messages")],
    """SELECT CAST(k AS VARCHAR) AS wa_message_id, concat('0170000000', CAST(k % 5 AS VARCHAR), '@c') AS chat_jid,
  CASE WHEN k % 11 = 1 THEN 'spoken' ELSE raw_content END AS raw_content,
  strftime(timestamp_wa - CASE k % 8 WHEN 4 THEN INTERVAL 6 HOUR WHEN 5 THEN -INTERVAL '3 hours 30 minutes' ELSE INTERVAL 0 HOUR END, '%Y-%m-%d %H:%M:%S') AS timestamp_wa,
  CASE WHEN k % 7 = 0 THEN false ELSE is_from_me END AS is_from_me
FROM r WHERE k % 5 BETWEEN 1 AND 3 AND k % 8 < 6 AND k % 11 NOT IN (0, 2)"""))
def conform_store(spark, sf):
    """Store rows of the wanted chats with a text and a time: texts empty, blank or in the other
    column, times in eight notations, from-me as a number or missing."""
    m, k = fx.messages(spark, sf), F.col("id") - 1
    time = F.get(F.array(*[F.date_format("timestamp_wa", f) for f in _TIMES]), (k % 8).cast("int"))
    raw = m.select(
        k.alias("id"), F.concat(F.lit("0170000000"), (k % 5).cast("string"), F.lit("@c")).alias("chat_jid"), F.lit("x").alias("sender"),
        F.when(k % 11 == 0, None).when(k % 11 == 1, "").when(k % 11 == 2, " \t").otherwise(F.col("raw_content")).alias("content"),
        F.when(k % 11 == 1, "spoken").when(k % 11 == 2, "not read").alias("processed_text"), time.alias("timestamp"),
        F.when(k % 7 != 0, F.col("is_from_me").cast("int")).alias("is_from_me"), F.lit("text").alias("media_type"))
    wanted = ingest.target_chats(CHATS, spark)
    rows = ingest.conform_message(raw).join(F.broadcast(wanted), "chat_jid", "left_semi")         # one row a configured chat
    return rows.select("wa_message_id", "chat_jid", "raw_content", F.date_format("timestamp_wa", "yyyy-MM-dd HH:mm:ss").alias("timestamp_wa"), "is_from_me")


@query("fill_in", sql_with_parse(["fx_messages"], [
    ("x", """SELECT id AS xid, id % 3 <> 0 AS pays, CASE WHEN id % 5 = 0 THEN NULL ELSE CAST(id % 1000 AS DECIMAL(12,2)) END AS amt FROM fx_messages WHERE id % 2 = 0"""),
    ("j", "SELECT p.*, x.*, coalesce(confidence < 0.7 AND pays, false) AS used FROM parsed p LEFT JOIN x ON x.xid = p.message_id")],
    """SELECT message_id, used AS ai_enhanced,
  CASE WHEN used THEN CASE WHEN amt IS NOT NULL AND amt <> 0 THEN 'payment' ELSE 'other' END ELSE message_type END AS message_type,
  CAST(CASE WHEN used THEN CASE WHEN amt <> 0 THEN amt END ELSE amount END AS DOUBLE) AS amount,
  CASE WHEN used THEN CASE WHEN amt <> 0 THEN 'Karim' END ELSE name_raw END AS name_raw,
  CASE WHEN used THEN CASE WHEN amt <> 0 THEN '01712345678' END ELSE payout_phone END AS payout_phone,
  CASE WHEN used THEN NULL ELSE id_phone END AS id_phone,
  CASE WHEN used THEN CASE WHEN amt <> 0 THEN 'nagad' END ELSE payout_method END AS payout_method,
  CASE WHEN used THEN CASE WHEN message_id % 4 = 0 THEN 0.7 ELSE 0.65 END ELSE confidence END AS confidence
FROM j"""))
def fill_in(spark, sf):
    """Every message's parse, with the supplied extractions where the parser found an amount alone."""
    m, i = fx.messages(spark, sf), F.col("id")
    ex = m.where(i % 2 == 0).select(
        i.alias("message_id"), (i % 3 != 0).alias("is_payment"), F.lit("Karim").alias("employee_name"), F.lit("+8801712345678").alias("payout_phone"),
        F.lit("N").alias("payout_method"), F.when(i % 5 != 0, (i % 1000).cast("decimal(12,2)")).alias("amount"), F.when(i % 4 != 0, F.lit(0.65)).alias("confidence"),
        F.lit("n").alias("notes"))
    p = apply_extractions(_parsed(spark, sf), ex, m)
    f = lambda c: F.col(f"payment.{c}").alias(c)
    return p.select("message_id", "ai_enhanced", "message_type", _dbl("payment.amount").alias("amount"), f("name_raw"), f("payout_phone"), f("id_phone"), f("payout_method"), "confidence")


@query("reconciliation_filtered", o.with_ctes(["fx_messages", "fx_payments", "fx_review_items"], _REV + [
    ("ps", f"""SELECT coalesce(sum(amount), 0) AS s FROM parsed WHERE message_type = 'payment' AND amount IS NOT NULL AND is_from_me
AND source = '{SOURCE}' AND strftime(timestamp_wa, '%Y-%m') = '{PERIOD}'"""),
    ("ls", f"SELECT coalesce(sum(amount), 0) AS s FROM pr WHERE NOT is_reversal AND accounting_period = '{PERIOD}'"),
    ("us", f"""SELECT coalesce(sum(r.detected_amount), 0) AS s FROM fx_review_items r JOIN fx_messages m ON m.id = r.message_id
WHERE r.review_status = 'pending' AND r.detected_amount IS NOT NULL AND m.source = '{SOURCE}' AND strftime(m.timestamp_wa, '%Y-%m') = '{PERIOD}'""")],
    """SELECT CAST(ps.s AS DOUBLE) AS parser_detected_sum, CAST(ls.s AS DOUBLE) AS ledger_sum, CAST(us.s AS DOUBLE) AS unmatched_review_sum,
  abs(ps.s - ls.s - us.s) <= 0.01 AS ok FROM ps, ls, us""", parse=True))
def reconciliation_filtered(spark, sf):
    """The reconciliation of one month and source."""
    r = reports.reconciliation(_parsed(spark, sf), fx.messages(spark, sf), _payments_rev(spark, sf), fx.review_items(spark, sf), fx.message_state(spark, sf),
                               period_=PERIOD, source=SOURCE)
    return r.select(*[_dbl(c).alias(c) for c in ("parser_detected_sum", "ledger_sum", "unmatched_review_sum")], "ok")
