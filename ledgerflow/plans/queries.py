"""Registered queries: one Spark job and, where SQL can say it, one DuckDB
statement per operator of the inventory.

Every query starts from the driver tables through the fixture views, so its
work grows with them. Outputs use comparable types in both engines: money as
double, dates as ``yyyy-MM-dd`` text.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions import text as tx
from ledgerflow.operators import edits, identity, posting, reports, similarity
from ledgerflow.operators.parse import METHOD_TAG, parse_results
from ledgerflow.operators.topk import top_k_per_group
from ledgerflow.plans import oracle as o
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources.scratch import stored
from ledgerflow.sources.tables import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PAGE_SIZE = 20
LIST_PAGE_SIZE = 50
HISTORY_FROM, HISTORY_TO = "1995-01-01", "1997-12-31"
CHECKPOINT_SPLIT = "1996-01-01"


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _dbl(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("double")


def _day(c) -> Column:
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd")


def _parsed(spark: SparkSession, sf: str) -> DataFrame:
    return parse_results(fx.messages(spark, sf),
                         keep=["source", "is_from_me", "sender_phone", "raw_content", "timestamp_wa"])


def _payments_rev(spark: SparkSession, sf: str) -> DataFrame:
    return reports.with_reversals(fx.payments(spark, sf))


PAYMENTS_REV_SQL = """SELECT id, employee_id, amount, payout_method, txn_date, txn_category, accounting_period,
  false AS is_reversal, NULL::BIGINT AS reversed_txn_id, was_reversed FROM fx_payments
UNION ALL
SELECT id + (SELECT max(id) FROM fx_payments), employee_id, CAST(-amount AS DECIMAL(12,2)), payout_method, txn_date,
  txn_category, accounting_period, true, id, false FROM fx_payments WHERE was_reversed"""

def sql_with_parse(names, extra, body):
    """CTEs: fixtures, then the parse (``parsed``), then ``extra``."""
    parts = [f"{n} AS ({o.FIXTURE_CTES[n]})" for n in names]
    parts.append(o.parse_sql())
    parts += [f"{n} AS ({q})" for n, q in extra]
    return "WITH " + ",\n".join(parts) + "\n" + body


# ---------------------------------------------------------------------------
# Scalar functions over the messages
# ---------------------------------------------------------------------------

@query("phone_norm", o.with_ctes(["fx_messages"], [], f"""SELECT id AS message_id,
  CASE WHEN contains(chat_jid, '@s.whatsapp.net') THEN {o.norm_phone("split_part(chat_jid, '@', 1)")} END AS jid_phone,
  {o.norm_phone("concat('+88', sender_phone)")} AS intl_phone,
  {o.norm_phone("substr(sender_phone, 2)")} AS short_phone,
  {o.norm_phone("translate(sender_phone, '0123456789', '০১২৩৪৫৬৭৮৯')")} AS bengali_phone,
  {o.norm_phone("substr(sender_phone, 3)")} AS cut_phone
FROM fx_messages"""))
def phone_norm(spark, sf):
    m = fx.messages(spark, sf)
    return m.select(F.col("id").alias("message_id"),
                    tx.jid_phone("chat_jid").alias("jid_phone"),
                    tx.norm_phone(F.concat(F.lit("+88"), "sender_phone")).alias("intl_phone"),
                    tx.norm_phone(F.substring("sender_phone", 2, 100)).alias("short_phone"),
                    tx.norm_phone(F.translate("sender_phone", tx.ASCII_DIGITS, tx.BENGALI_DIGITS)).alias("bengali_phone"),
                    tx.norm_phone(F.substring("sender_phone", 3, 100)).alias("cut_phone"))


@query("method_norm", o.with_ctes(["fx_messages"], [("c", f"SELECT regexp_extract(raw_content, '{o.METHOD_TAG}', 1) AS code FROM fx_messages")],
                                  f"SELECT code, {o.norm_method('code')} AS payout_method, count(*) AS n FROM c WHERE code <> '' GROUP BY ALL"))
def method_norm(spark, sf):
    m = fx.messages(spark, sf).select(F.regexp_extract("raw_content", METHOD_TAG, 1).alias("code"))
    return (m.where(F.col("code") != "").groupBy("code", tx.norm_method("code").alias("payout_method"))
            .agg(F.count(F.lit(1)).alias("n")))


_AMT_TXT = "([০-৯0-9][০-৯0-9,.]*)/-"


@query("amount_norm", o.with_ctes(["fx_messages"], [("a", f"SELECT id, regexp_extract(raw_content, '{_AMT_TXT}', 1) AS amount_text FROM fx_messages")],
                                  f"""SELECT id AS message_id, amount_text,
  CASE WHEN regexp_full_match({o.strip(o.ascii_digits("replace(amount_text, ',', '')"))}, '[+-]?([0-9]+\\.?[0-9]*|\\.[0-9]+)')
       THEN try_cast({o.strip(o.ascii_digits("replace(amount_text, ',', '')"))} AS DOUBLE) END AS amount
FROM a WHERE amount_text <> ''"""))
def amount_norm(spark, sf):
    m = fx.messages(spark, sf).select("id", F.regexp_extract("raw_content", _AMT_TXT, 1).alias("amount_text"))
    return m.where(F.col("amount_text") != "").select(F.col("id").alias("message_id"), "amount_text",
                                                       tx.norm_amount("amount_text").alias("amount"))


# ---------------------------------------------------------------------------
# Parsing (P1-P13)
# ---------------------------------------------------------------------------

@query("messages_by_type", sql_with_parse(["fx_messages"], [],
       "SELECT message_type, count(*) AS n, round(sum(confidence), 4) AS confidence_sum FROM parsed GROUP BY message_type"))
def messages_by_type(spark, sf):
    return _parsed(spark, sf).groupBy("message_type").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("confidence"), 4).alias("confidence_sum"))


@query("parse_payments", sql_with_parse(["fx_messages"], [], """SELECT message_id, id_phone, name_raw, payout_phone,
  payout_method, CAST(amount AS DOUBLE) AS amount, strftime(txn_date, '%Y-%m-%d') AS txn_date, confidence
FROM parsed WHERE message_type = 'payment'"""))
def parse_payments(spark, sf):
    p = _parsed(spark, sf).where(F.col("message_type") == "payment")
    return p.select("message_id", "payment.id_phone", "payment.name_raw", "payment.payout_phone",
                    "payment.payout_method", _dbl("payment.amount").alias("amount"),
                    _day("payment.txn_date").alias("txn_date"), "confidence")


@query("confidence_mix", sql_with_parse(["fx_messages"], [],
       "SELECT message_type, confidence, count(*) AS n FROM parsed GROUP BY ALL"))
def confidence_mix(spark, sf):
    return _parsed(spark, sf).groupBy("message_type", "confidence").agg(F.count(F.lit(1)).alias("n"))


@query("parse_commands", sql_with_parse(["fx_messages"], [], """SELECT message_id, message_type, payout_phone, id_phone,
  name_raw, payout_method, CAST(amount AS DOUBLE) AS amount FROM parsed
WHERE message_type IN ('cash_command', 'income_command')"""))
def parse_commands(spark, sf):
    p = _parsed(spark, sf).where(F.col("message_type").isin("cash_command", "income_command"))
    return p.select("message_id", "message_type", "payment.payout_phone", "payment.id_phone", "payment.name_raw",
                    "payment.payout_method", _dbl("payment.amount").alias("amount"))


@query("parse_balance", sql_with_parse(["fx_messages"], [], """SELECT message_id, strftime(summary_date, '%Y-%m-%d') AS summary_date,
  CAST(total_due AS DOUBLE) AS total_due, CAST(total_collected AS DOUBLE) AS total_collected
FROM parsed WHERE message_type = 'balance_summary'"""))
def parse_balance(spark, sf):
    p = _parsed(spark, sf).where(F.col("message_type") == "balance_summary")
    return p.select("message_id", _day("summary.summary_date").alias("summary_date"),
                    _dbl("summary.total_due").alias("total_due"), _dbl("summary.total_collected").alias("total_collected"))


# ---------------------------------------------------------------------------
# Ingest, gap scan, checkpoints
# ---------------------------------------------------------------------------

def _archive(spark, sf):
    m = fx.messages(spark, sf)
    return m.where((F.col("id") - 1) % 9 != 0)


def _incoming(spark, sf):
    s = fx.store_rows(spark, sf).where(tx.py_strip("content") != "")
    first = s.select("wa_message_id", "source", "content", F.lit(0).alias("arrival"))
    again = s.where("redelivered").select("wa_message_id", "source", "content", F.lit(1).alias("arrival"))
    return first.unionByName(again)


_INGEST_CTES = [
    ("inc", f"""SELECT wa_message_id, source, content, 0 AS arrival FROM fx_store_rows WHERE {o.strip('content')} <> ''
UNION ALL SELECT wa_message_id, source, content, 1 FROM fx_store_rows WHERE {o.strip('content')} <> '' AND redelivered"""),
    ("firsts", "SELECT wa_message_id, source, count(*) AS copies, min(arrival) AS arrival FROM inc GROUP BY ALL"),
    ("arch", "SELECT id, wa_message_id, source FROM fx_messages WHERE (id - 1) % 9 <> 0"),
    ("j", "SELECT f.*, a.id AS archived_id FROM firsts f LEFT JOIN arch a USING (wa_message_id, source)"),
]


@query("ingest_dedup", o.with_ctes(["fx_messages", "fx_store_rows"], _INGEST_CTES, """
SELECT wa_message_id, source, 'inserted' AS outcome,
  (SELECT max(id) FROM arch) + row_number() OVER (ORDER BY arrival, wa_message_id, source) AS id, copies FROM j WHERE archived_id IS NULL
UNION ALL SELECT wa_message_id, source, 'duplicate', archived_id, copies FROM j WHERE archived_id IS NOT NULL
UNION ALL SELECT wa_message_id, source, 'duplicate', NULL, copies - 1 FROM j WHERE archived_id IS NULL AND copies > 1"""))
def ingest_dedup(spark, sf):
    from ledgerflow.sources import ingest as ing
    inc = _incoming(spark, sf)
    copies = inc.groupBy("wa_message_id", "source").agg(F.count(F.lit(1)).alias("copies"))
    inserted, dups = ing.ingest(_archive(spark, sf), inc)
    ins = inserted.join(copies, ["wa_message_id", "source"]).select(
        "wa_message_id", "source", F.lit("inserted").alias("outcome"), "id", "copies")
    return ins.unionByName(dups.select("wa_message_id", "source", F.lit("duplicate").alias("outcome"), "id", "copies"))


_GAP_CTES = [
    ("arch", "SELECT id, wa_message_id, source, chat_jid FROM fx_messages WHERE (id - 1) % 9 <> 0"),
    ("marked", f"""SELECT r.*, a.id IS NOT NULL AS in_arch,
  {o.strip("coalesce(nullif(content, ''), processed_text, '')")} = '' AS blank
FROM fx_store_rows r LEFT JOIN (SELECT DISTINCT source, wa_message_id, id FROM arch) a USING (source, wa_message_id)"""),
]


@query("gap_scan", o.with_ctes(["fx_messages", "fx_store_rows"], _GAP_CTES, """SELECT wa_message_id, source, chat_jid,
  CASE WHEN blank THEN 'skipped_no_content' ELSE 'backfill' END AS action FROM marked WHERE NOT in_arch"""))
def gap_scan_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    g = ing.gap_scan(fx.store_rows(spark, sf), _archive(spark, sf))
    return g.select("wa_message_id", "source", "chat_jid", "action")


@query("gap_run_log", o.with_ctes(["fx_messages", "fx_store_rows"], _GAP_CTES, """SELECT m.source, m.chat_jid,
  count(*) AS store_count, count(*) FILTER (WHERE in_arch) AS archive_count,
  count(*) FILTER (WHERE NOT in_arch) AS missing_count,
  count(*) FILTER (WHERE NOT in_arch AND NOT blank) AS backfilled,
  count(*) FILTER (WHERE NOT in_arch AND blank) AS skipped_no_content
FROM marked m GROUP BY m.source, m.chat_jid"""))
def gap_run_log_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    return ing.gap_run_log(fx.store_rows(spark, sf), _archive(spark, sf)).select(
        "source", "chat_jid", "store_count", "archive_count", "missing_count", "backfilled", "skipped_no_content")


_CP_CTES = [
    ("b1", f"SELECT * FROM fx_store_rows WHERE timestamp_wa < TIMESTAMP '{CHECKPOINT_SPLIT}'"),
    ("b2", f"SELECT * FROM fx_store_rows WHERE timestamp_wa >= TIMESTAMP '{CHECKPOINT_SPLIT}' AND chat_jid NOT LIKE '%5@s.whatsapp.net'"),
    ("s1", """SELECT source, source_number, chat_jid, arg_max(wa_message_id, struct_pack(a := timestamp_wa, b := wa_message_id)) AS last_message_id,
  max(timestamp_wa) AS last_timestamp, count(*) AS total_ingested FROM b1 GROUP BY ALL"""),
    ("s2", """SELECT source, source_number, chat_jid, arg_max(wa_message_id, struct_pack(a := timestamp_wa, b := wa_message_id)) AS last_message_id,
  max(timestamp_wa) AS last_timestamp, count(*) AS batch_count FROM b2 GROUP BY ALL"""),
]


@query("checkpoint_upsert", o.with_ctes(["fx_store_rows"], _CP_CTES, """SELECT
  coalesce(s1.source, s2.source) AS source, coalesce(s1.source_number, s2.source_number) AS source_number,
  coalesce(s1.chat_jid, s2.chat_jid) AS chat_jid,
  CASE WHEN s2.batch_count IS NOT NULL THEN s2.last_message_id ELSE s1.last_message_id END AS last_message_id,
  strftime(CASE WHEN s2.batch_count IS NOT NULL THEN s2.last_timestamp ELSE s1.last_timestamp END, '%Y-%m-%d %H:%M:%S') AS last_timestamp,
  coalesce(s1.total_ingested, 0) + coalesce(s2.batch_count, 0) AS total_ingested,
  s2.batch_count IS NOT NULL AS synced
FROM s1 FULL OUTER JOIN s2 ON s1.source = s2.source AND s1.source_number = s2.source_number AND s1.chat_jid = s2.chat_jid"""))
def checkpoint_upsert_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    s = fx.store_rows(spark, sf)
    split = F.lit(CHECKPOINT_SPLIT).cast("timestamp_ntz")
    b1 = s.where(F.col("timestamp_wa") < split)
    b2 = s.where((F.col("timestamp_wa") >= split) & ~F.col("chat_jid").like("%5@s.whatsapp.net"))
    state1 = ing.checkpoint_batch(b1).withColumnRenamed("batch_count", "total_ingested") \
        .withColumn("last_sync_at", F.lit(None).cast("timestamp"))
    out = ing.checkpoint_upsert(state1, b2)
    return out.select("source", "source_number", "chat_jid", "last_message_id",
                      F.date_format("last_timestamp", "yyyy-MM-dd HH:mm:ss").alias("last_timestamp"),
                      "total_ingested", F.col("last_sync_at").isNotNull().alias("synced"))


# ---------------------------------------------------------------------------
# Flagship and identity
# ---------------------------------------------------------------------------

def _flagship(spark, sf, persist=True):
    from ledgerflow.plans.flagship import process_fixtures
    return process_fixtures(spark, sf, persist=persist)


_FLAG = ["fx_messages", "fx_employees", "fx_aliases", "fx_authorized"]
_FLAG_CTES = o.MASTER_CTES + o.ROUTE_CTES + o.match_ctes("req") + o.create_ctes() + o.CASH_CTES + [
    ("pay", """SELECT employee_id, amount, txn_date, 'salary' AS txn_category FROM assigned WHERE action = 'match'
UNION ALL SELECT employee_id, amount, txn_date, 'salary' FROM cashout WHERE employee_id IS NOT NULL"""),
]


@query("flagship_ledger", o.with_ctes(_FLAG, _FLAG_CTES, """SELECT employee_id, strftime(txn_date, '%Y-%m') AS accounting_period,
  CAST(sum(CASE WHEN txn_category <> 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_paid,
  CAST(sum(CASE WHEN txn_category = 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_advance,
  count(*) AS txn_count, CAST(-sum(amount) AS DOUBLE) AS closing_balance
FROM pay GROUP BY ALL""", parse=True, recursive=True))
def flagship_ledger(spark, sf):
    led = _flagship(spark, sf).ledger
    return led.select("employee_id", "accounting_period", _dbl("total_paid").alias("total_paid"),
                      _dbl("total_advance").alias("total_advance"), F.col("txn_count").cast("long").alias("txn_count"),
                      _dbl("closing_balance").alias("closing_balance"))


@query("match_batch", o.with_ctes(_FLAG, _FLAG_CTES, """SELECT message_id, action, match_tier, employee_id FROM assigned""",
                                  parse=True, recursive=True))
def match_batch(spark, sf):
    a = _flagship(spark, sf).assigned
    return a.select("message_id", "action", "match_tier", "employee_id")


@query("match_exact_tiers", o.with_ctes(_FLAG, _FLAG_CTES[:-1], """SELECT kp AS payout_key, ki AS id_key, kn AS name_key,
  match_tier, matched_id, c.canonical_id AS employee_id FROM mkeys LEFT JOIN best USING (kp, ki, kn)
LEFT JOIN canon c ON c.id = matched_id""", parse=True, recursive=True))
def match_exact_tiers(spark, sf):
    from ledgerflow.operators.posting import match_requests, route
    routed = route(parse_results(fx.messages(spark, sf), keep=["is_from_me", "sender_phone", "raw_content"]),
                   fx.authorized_senders(spark, sf))
    req = match_requests(routed)
    m = identity.match_exact(req, fx.employees(spark, sf), fx.aliases(spark, sf))
    return m.select(F.coalesce("payout_phone", F.lit("")).alias("payout_key"), F.coalesce("id_phone", F.lit("")).alias("id_key"),
                    F.coalesce("name_norm", F.lit("")).alias("name_key"), "match_tier", "matched_id", "employee_id").distinct()


@query("canonical_resolve", o.with_ctes(["fx_employees"], o.MASTER_CTES[:3], """SELECT c.id, c.canonical_id,
  e.canonical_employee_id IS NULL OR e.canonical_employee_id = e.id
  OR NOT EXISTS (SELECT 1 FROM emp t WHERE t.id = e.canonical_employee_id) AS resolved
FROM canon c JOIN emp e ON e.id = c.canonical_id""", recursive=True))
def canonical_resolve(spark, sf):
    return identity.resolve_canonical(fx.employees(spark, sf))


@query("income_posting", o.with_ctes(_FLAG, _FLAG_CTES[:-1], """SELECT 'inc-' || sha256(concat_ws('|', CAST(message_id AS VARCHAR),
  CAST(employee_id AS VARCHAR), CAST(amount AS VARCHAR), strftime(txn_date, '%Y-%m')))[1:16] AS txn_ref,
  message_id, employee_id, CAST(amount AS DOUBLE) AS amount, strftime(txn_date, '%Y-%m') AS accounting_period,
  {rb} AS reported_by_phone
FROM assigned WHERE action = 'income'""".replace("{rb}", o.norm_phone("sender_norm")), parse=True, recursive=True))
def income_posting(spark, sf):
    inc = _flagship(spark, sf).income
    return inc.select("txn_ref", "message_id", "employee_id", _dbl("amount").alias("amount"),
                      "accounting_period", "reported_by_phone")


@query("cash_commands", o.with_ctes(_FLAG, o.MASTER_CTES + o.ROUTE_CTES + o.CASH_CTES, """SELECT message_id,
  CASE WHEN employee_id IS NULL THEN 'cash_command_no_employee' ELSE 'posted' END AS outcome,
  employee_id, emp_phone, CAST(amount AS DOUBLE) AS amount,
  CASE WHEN employee_id IS NOT NULL THEN 'fpe-' || sha256(concat_ws('|', CAST(message_id AS VARCHAR), CAST(employee_id AS VARCHAR),
    CAST(amount AS VARCHAR), strftime(txn_date, '%Y-%m'), 'cash'))[1:16] END AS txn_ref
FROM cashout""", parse=True, recursive=True))
def cash_commands_q(spark, sf):
    from ledgerflow.operators.posting import cash_commands, route
    routed = route(parse_results(fx.messages(spark, sf), keep=["is_from_me", "sender_phone", "raw_content"]),
                   fx.authorized_senders(spark, sf))
    found, missing = cash_commands(routed, fx.employees(spark, sf))
    per = tx.period("txn_date")
    posted = found.select("message_id", F.lit("posted").alias("outcome"), "employee_id",
                          F.col("payout_phone").alias("emp_phone"), _dbl("amount").alias("amount"),
                          tx.payment_ref("message_id", "employee_id", "amount", per, "payout_method").alias("txn_ref"))
    nothing = missing.select("message_id", F.col("reason").alias("outcome"), F.lit(None).cast("long").alias("employee_id"),
                             F.col("detected_payout_phone").alias("emp_phone"), _dbl("detected_amount").alias("amount"),
                             F.lit(None).cast("string").alias("txn_ref"))
    return posted.unionByName(nothing)


# ---------------------------------------------------------------------------
# Payments, ledger, reversals, keys
# ---------------------------------------------------------------------------

_REV = [("pr", PAYMENTS_REV_SQL)]
_CANON = o.MASTER_CTES[:3]


@query("ledger", o.with_ctes(["fx_payments"], _REV, """SELECT employee_id, accounting_period,
  CAST(sum(CASE WHEN txn_category <> 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_paid,
  CAST(sum(CASE WHEN txn_category = 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_advance,
  count(*) AS txn_count, CAST(-sum(amount) AS DOUBLE) AS closing_balance,
  CAST(CASE WHEN count(*) = 1 THEN 0 ELSE -sum(amount) END AS DOUBLE) AS closing_parity
FROM pr WHERE employee_id IS NOT NULL GROUP BY ALL"""))
def ledger_q(spark, sf):
    p = _payments_rev(spark, sf)
    fixed = posting.ledger(p)
    par = posting.ledger(p, parity=True).select("employee_id", "accounting_period",
                                                F.col("closing_balance").alias("closing_parity"))
    j = fixed.join(par, ["employee_id", "accounting_period"])
    return j.select("employee_id", "accounting_period", _dbl("total_paid").alias("total_paid"),
                    _dbl("total_advance").alias("total_advance"), F.col("txn_count").cast("long").alias("txn_count"),
                    _dbl("closing_balance").alias("closing_balance"), _dbl("closing_parity").alias("closing_parity"))


@query("ledger_running", o.with_ctes(["fx_payments"], _REV, """SELECT id, employee_id, accounting_period,
  CAST(-sum(amount) OVER w AS DOUBLE) AS closing_after, row_number() OVER w AS seq
FROM pr WHERE employee_id IS NOT NULL
WINDOW w AS (PARTITION BY employee_id, accounting_period ORDER BY id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""))
def ledger_running_q(spark, sf):
    r = posting.ledger_running(_payments_rev(spark, sf))
    return r.select("id", "employee_id", "accounting_period", _dbl("closing_after").alias("closing_after"), "seq")


def _posted(spark, sf):
    p = fx.payments(spark, sf)
    return p.select("id", tx.payment_ref("id", "employee_id", "amount", "accounting_period", "payout_method").alias("txn_ref"),
                    F.col("id").alias("message_id"), "employee_id", F.lit(None).cast("string").alias("employee_name_raw"),
                    "amount", F.lit(None).cast("string").alias("payout_phone"), "payout_method", "txn_date",
                    "txn_category", F.lit(False).alias("is_reversal"), "accounting_period", "was_reversed")


@query("reversal_net", o.with_ctes(["fx_payments"], [
    ("reqs", """SELECT id AS request_id, id AS txn_id FROM fx_payments WHERE was_reversed
UNION ALL SELECT id + 1000000000, id FROM fx_payments WHERE was_reversed AND id % 2 = 0
UNION ALL SELECT id + 2000000000, id + 1000000000 FROM fx_payments WHERE id % 1000 = 1"""),
    ("j", """SELECT r.*, p.id AS pid, p.amount, row_number() OVER (PARTITION BY r.txn_id ORDER BY r.request_id) AS n
FROM reqs r LEFT JOIN fx_payments p ON p.id = r.txn_id""")],
    """SELECT request_id, txn_id,
  CASE WHEN pid IS NULL THEN 'not_found' WHEN n > 1 THEN 'already_reversed' ELSE 'reversed' END AS outcome,
  CASE WHEN pid IS NOT NULL AND n = 1 THEN CAST(-amount AS DOUBLE) END AS amount
FROM j"""))
def reversal_net(spark, sf):
    posted = _posted(spark, sf)
    reqs = (posted.where("was_reversed").select(F.col("id").alias("request_id"), F.col("id").alias("txn_id"))
            .unionByName(posted.where(F.col("was_reversed") & (F.col("id") % 2 == 0))
                         .select((F.col("id") + 1000000000).alias("request_id"), F.col("id").alias("txn_id")))
            .unionByName(posted.where(F.col("id") % 1000 == 1)
                         .select((F.col("id") + 2000000000).alias("request_id"), (F.col("id") + 1000000000).alias("txn_id")))
            .withColumn("reason", F.lit("requested")).withColumn("actor", F.lit("admin")))
    rows, rejected = posting.reverse_payments(posted.drop("was_reversed"), reqs)
    done = rows.select(F.col("reversed_txn_id").alias("txn_id"), _dbl("amount").alias("amount"))
    ok = reqs.join(done, "txn_id").join(rejected.select("request_id"), "request_id", "left_anti") \
             .select("request_id", "txn_id", F.lit("reversed").alias("outcome"), "amount")
    bad = rejected.select("request_id", "txn_id", F.col("reject_reason").alias("outcome"),
                          F.lit(None).cast("double").alias("amount"))
    return ok.unionByName(bad)


@query("payment_refs", o.with_ctes(["fx_payments"], [], """SELECT id,
  'fpe-' || sha256(concat_ws('|', CAST(id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(amount AS VARCHAR),
     accounting_period, payout_method))[1:16] AS txn_ref,
  'fpe-' || sha256(concat_ws('|', CAST(id AS VARCHAR), CAST(employee_id AS VARCHAR),
     regexp_replace(regexp_replace(CAST(amount AS VARCHAR), '0$', ''), '\\.$', '.0'),
     accounting_period, payout_method))[1:16] AS txn_ref_parity,
  'REV-fpe-' || sha256(concat_ws('|', CAST(id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(amount AS VARCHAR),
     accounting_period, payout_method))[1:16] AS reversal_ref,
  'inc-' || sha256(concat_ws('|', CAST(id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(amount AS VARCHAR),
     accounting_period))[1:16] AS income_ref,
  printf('EMP-%05d', employee_id) AS employee_code
FROM fx_payments"""))
def payment_refs(spark, sf):
    p = fx.payments(spark, sf)
    ref = tx.payment_ref("id", "employee_id", "amount", "accounting_period", "payout_method")
    return p.select("id", ref.alias("txn_ref"),
                    tx.payment_ref("id", "employee_id", "amount", "accounting_period", "payout_method",
                                   parity=True).alias("txn_ref_parity"),
                    tx.reversal_ref(ref).alias("reversal_ref"),
                    tx.income_ref("id", "employee_id", "amount", "accounting_period").alias("income_ref"),
                    tx.employee_code("employee_id").alias("employee_code"))


@query("payments_summary", o.with_ctes(["fx_payments"], _REV, """SELECT count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total,
  strftime(min(txn_date), '%Y-%m-%d') AS first_date, strftime(max(txn_date), '%Y-%m-%d') AS last_date
FROM pr WHERE NOT is_reversal AND payout_method = 'bkash' AND txn_date BETWEEN DATE '1995-01-01' AND DATE '1996-12-31'"""))
def payments_summary(spark, sf):
    p = reports.filter_payments(_payments_rev(spark, sf), method="bkash", date_from="1995-01-01", date_to="1996-12-31")
    s = reports.payments_summary(p)
    return s.select("n", _dbl("total").alias("total"), _day("first_date").alias("first_date"),
                    _day("last_date").alias("last_date"))


@query("payments_by_method", o.with_ctes(["fx_payments"], _REV, """SELECT payout_method, count(*) AS n,
  CAST(sum(amount) AS DOUBLE) AS total FROM pr WHERE NOT is_reversal GROUP BY ALL"""))
def payments_by_method_q(spark, sf):
    r = reports.payments_by_method(_payments_rev(spark, sf))
    return r.select("payout_method", "n", _dbl("total").alias("total"))


@query("state_counts", o.with_ctes(["fx_message_state"], [], "SELECT status, count(*) AS n FROM fx_message_state GROUP BY ALL"))
def state_counts_q(spark, sf):
    return reports.state_counts(fx.message_state(spark, sf))


_PAGE_RAW = "CASE WHEN id % 3 = 0 THEN 'raw ' || CAST(id AS VARCHAR) END"
_PAGE_PAYOUT = "'01' || lpad(CAST(900000000 + id AS VARCHAR), 9, '0')"
_PAGE_EMPLOYEE = "CASE WHEN id % 4 <> 0 THEN employee_id END"


@query("payments_page", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON + [
    ("pg", f"""SELECT id, {_PAGE_EMPLOYEE} AS employee_id, {_PAGE_RAW} AS employee_name_raw, {_PAGE_PAYOUT} AS payout_phone,
  amount, payout_method, txn_date FROM pr WHERE NOT is_reversal ORDER BY txn_date DESC, id DESC LIMIT {PAGE_SIZE}""")],
    """SELECT pg.id, pg.employee_id, coalesce(c.canonical_id, pg.employee_id) AS canonical_employee_id,
  coalesce(pg.employee_name_raw, ce.full_name, e.full_name, '(unknown)') AS display_name,
  coalesce(ce.employee_id_phone, e.employee_id_phone, ce.primary_phone, e.primary_phone, pg.payout_phone) AS display_id_phone,
  coalesce(ce.primary_phone, e.primary_phone, pg.payout_phone) AS display_phone,
  CAST(pg.amount AS DOUBLE) AS amount, pg.payout_method, strftime(pg.txn_date, '%Y-%m-%d') AS txn_date
FROM pg LEFT JOIN emp e ON e.id = pg.employee_id LEFT JOIN canon c ON c.id = pg.employee_id
LEFT JOIN emp ce ON ce.id = c.canonical_id""", recursive=True))
def payments_page_q(spark, sf):
    i = F.col("id")
    p = (reports.filter_payments(_payments_rev(spark, sf))
         .withColumn("employee_name_raw", F.when(i % 3 == 0, F.concat(F.lit("raw "), i.cast("string"))))
         .withColumn("payout_phone", F.concat(F.lit("01"), F.lpad((i + 900000000).cast("string"), 9, "0")))
         .withColumn("employee_id", F.when(i % 4 != 0, F.col("employee_id"))))
    emp = identity.prepare_master(fx.employees(spark, sf))
    r = reports.payments_page(p, emp, identity.resolve_canonical(emp), page=1, size=PAGE_SIZE)
    return r.select("id", "employee_id", "canonical_employee_id", "display_name", "display_id_phone", "display_phone",
                    _dbl("amount").alias("amount"), "payout_method", _day("txn_date").alias("txn_date"))


@query("employee_totals", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON, """SELECT c.canonical_id,
  count(*) FILTER (WHERE NOT is_reversal) AS txn_count,
  CAST(sum(amount) FILTER (WHERE NOT is_reversal) AS DOUBLE) AS gross_amount,
  CAST(sum(amount) AS DOUBLE) AS net_amount,
  strftime(max(txn_date) FILTER (WHERE NOT is_reversal), '%Y-%m-%d') AS last_date
FROM pr JOIN canon c ON c.id = pr.employee_id GROUP BY c.canonical_id""", recursive=True))
def employee_totals_q(spark, sf):
    emp = fx.employees(spark, sf)
    t = reports.employee_totals(_payments_rev(spark, sf), identity.members(emp))
    return t.select("canonical_id", "txn_count", _dbl("gross_amount").alias("gross_amount"),
                    _dbl("net_amount").alias("net_amount"), _day("last_date").alias("last_date"))


@query("employee_history", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON, f"""SELECT c.canonical_id,
  count(*) AS n, CAST(sum(amount) AS DOUBLE) AS total,
  strftime(min(txn_date), '%Y-%m-%d') AS first_date, strftime(max(txn_date), '%Y-%m-%d') AS last_date
FROM pr JOIN canon c ON c.id = pr.employee_id
WHERE NOT is_reversal AND txn_date BETWEEN DATE '{HISTORY_FROM}' AND DATE '{HISTORY_TO}' GROUP BY c.canonical_id""",
    recursive=True))
def employee_history_q(spark, sf):
    emp = fx.employees(spark, sf)
    h = reports.employee_history(_payments_rev(spark, sf), identity.members(emp), HISTORY_FROM, HISTORY_TO)
    return h.select("canonical_id", "n", _dbl("total").alias("total"), _day("first_date").alias("first_date"),
                    _day("last_date").alias("last_date"))


@query("employee_list_page", o.with_ctes(["fx_payments", "fx_employees", "fx_aliases"], _REV + _CANON + [
    ("page", f"""SELECT * FROM emp WHERE status = 'active' AND canonical_employee_id IS NULL
ORDER BY CASE WHEN regexp_matches(coalesce(full_name, ''), '[A-Za-z\\x{{0980}}-\\x{{09FF}}]') THEN 0 ELSE 1 END,
  lower(coalesce(full_name, primary_phone)) ASC NULLS LAST, id LIMIT {LIST_PAGE_SIZE}"""),
    ("mem", "SELECT p.id AS canonical_id, c.id AS member_id FROM page p JOIN canon c ON c.canonical_id = p.id"),
    ("tot", """SELECT m.canonical_id, count(*) FILTER (WHERE NOT is_reversal) AS txn_count,
  sum(amount) FILTER (WHERE NOT is_reversal) AS total, max(txn_date) FILTER (WHERE NOT is_reversal) AS last_date
FROM mem m JOIN pr ON pr.employee_id = m.member_id GROUP BY m.canonical_id"""),
    ("al", """SELECT m.canonical_id, array_to_string(list_sort(list_distinct(list(a.alias_value))), ',') AS name_aliases
FROM mem m JOIN fx_aliases a ON a.employee_id = m.member_id AND a.alias_type = 'name' GROUP BY m.canonical_id""")],
    """SELECT p.id, p.employee_code, p.full_name, coalesce(t.txn_count, 0) AS txn_count, CAST(t.total AS DOUBLE) AS total,
  strftime(t.last_date, '%Y-%m-%d') AS last_date, al.name_aliases
FROM page p LEFT JOIN tot t ON t.canonical_id = p.id LEFT JOIN al ON al.canonical_id = p.id""", recursive=True))
def employee_list_page(spark, sf):
    emp = fx.employees(spark, sf)
    has_letter = F.coalesce(F.col("full_name"), F.lit("")).rlike(tx.NAME_LETTER)
    page = (emp.where((F.col("status") == "active") & F.col("canonical_employee_id").isNull())
            .orderBy(F.when(has_letter, 0).otherwise(1), F.lower(F.coalesce("full_name", "primary_phone")).asc_nulls_last(),
                     "id").limit(LIST_PAGE_SIZE))
    mem = identity.members(emp).join(page.select(F.col("id").alias("canonical_id")), "canonical_id")
    p = _payments_rev(spark, sf)
    tot = (mem.join(p, p.employee_id == mem.member_id).groupBy("canonical_id").agg(
        F.count_if(~F.col("is_reversal")).alias("txn_count"),
        F.sum(F.when(~F.col("is_reversal"), F.col("amount"))).alias("total"),
        F.max(F.when(~F.col("is_reversal"), F.col("txn_date"))).alias("last_date")))
    a = fx.aliases(spark, sf).where(F.col("alias_type") == "name")
    al = (mem.join(a, a.employee_id == mem.member_id).groupBy("canonical_id")
          .agg(F.array_join(F.array_sort(F.collect_set("alias_value")), ",").alias("name_aliases")))
    j = page.join(tot, page.id == tot.canonical_id, "left").drop("canonical_id") \
            .join(al, page.id == al.canonical_id, "left")
    return j.select("id", "employee_code", "full_name", F.coalesce("txn_count", F.lit(0)).alias("txn_count"),
                    _dbl("total").alias("total"), _day("last_date").alias("last_date"), "name_aliases")


@query("alias_first_wins", o.with_ctes(["fx_aliases"], [], """SELECT alias_type, alias_value, min(employee_id) AS employee_id,
  count(*) - 1 AS rejected FROM fx_aliases WHERE alias_value <> '' GROUP BY ALL"""))
def alias_first_wins(spark, sf):
    a = fx.aliases(spark, sf).where(F.col("alias_value") != "")
    return a.groupBy("alias_type", "alias_value").agg(F.min("employee_id").alias("employee_id"),
                                                      (F.count(F.lit(1)) - 1).alias("rejected"))


# ---------------------------------------------------------------------------
# Reconciliation, review and identity dashboards, audit
# ---------------------------------------------------------------------------

_RECON_CTES = _REV + [
    ("ps", """SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(22,2)) AS parser_detected_sum FROM parsed
WHERE message_type = 'payment' AND amount IS NOT NULL AND is_from_me"""),
    ("ls", "SELECT CAST(coalesce(sum(amount), 0) AS DECIMAL(22,2)) AS ledger_sum FROM pr WHERE NOT is_reversal"),
    ("us", """SELECT CAST(coalesce(sum(r.detected_amount), 0) AS DECIMAL(22,2)) AS unmatched_review_sum
FROM fx_review_items r JOIN fx_messages m ON m.id = r.message_id
WHERE r.review_status = 'pending' AND r.detected_amount IS NOT NULL"""),
]


@query("reconciliation", o.with_ctes(["fx_messages", "fx_payments", "fx_review_items", "fx_message_state"], _RECON_CTES,
    """SELECT CAST(parser_detected_sum AS DOUBLE) AS parser_detected_sum, CAST(ledger_sum AS DOUBLE) AS ledger_sum,
  CAST(unmatched_review_sum AS DOUBLE) AS unmatched_review_sum,
  CAST(ledger_sum + unmatched_review_sum AS DOUBLE) AS accounted_sum,
  CAST(parser_detected_sum - (ledger_sum + unmatched_review_sum) AS DOUBLE) AS delta,
  abs(parser_detected_sum - (ledger_sum + unmatched_review_sum)) <= 0.01 AS ok,
  (SELECT count(*) FROM fx_review_items WHERE review_status = 'pending') AS pending_review_count,
  (SELECT count(*) FROM fx_message_state WHERE status = 'failed' AND attempts >= 5) AS dlq_count
FROM ps, ls, us""", parse=True))
def reconciliation_q(spark, sf):
    r = reports.reconciliation(_parsed(spark, sf), fx.messages(spark, sf), _payments_rev(spark, sf),
                               fx.review_items(spark, sf), fx.message_state(spark, sf))
    return r.select(*[_dbl(c).alias(c) for c in ["parser_detected_sum", "ledger_sum", "unmatched_review_sum",
                                                   "accounted_sum", "delta"]], "ok", "pending_review_count", "dlq_count")


@query("reconciliation_by_period_source", o.with_ctes(["fx_messages", "fx_payments", "fx_review_items"], _REV + [
    ("ps", """SELECT strftime(timestamp_wa, '%Y-%m') AS period, source, sum(amount) AS parser_detected_sum FROM parsed
WHERE message_type = 'payment' AND amount IS NOT NULL AND is_from_me GROUP BY ALL"""),
    ("us", """SELECT strftime(m.timestamp_wa, '%Y-%m') AS period, m.source, sum(r.detected_amount) AS unmatched_review_sum
FROM fx_review_items r JOIN fx_messages m ON m.id = r.message_id
WHERE r.review_status = 'pending' AND r.detected_amount IS NOT NULL GROUP BY ALL"""),
    ("ls", "SELECT accounting_period AS period, sum(amount) AS ledger_sum FROM pr WHERE NOT is_reversal GROUP BY ALL")],
    """SELECT coalesce(ps.period, us.period) AS period, coalesce(ps.source, us.source) AS source,
  CAST(coalesce(ps.parser_detected_sum, 0) AS DOUBLE) AS parser_detected_sum,
  CAST(coalesce(us.unmatched_review_sum, 0) AS DOUBLE) AS unmatched_review_sum,
  CAST(coalesce(ls.ledger_sum, 0) AS DOUBLE) AS period_ledger_sum
FROM ps FULL OUTER JOIN us ON ps.period = us.period AND ps.source = us.source
LEFT JOIN ls ON ls.period = coalesce(ps.period, us.period)""", parse=True))
def reconciliation_by_period_source(spark, sf):
    r = reports.reconciliation_by_period_source(_parsed(spark, sf), fx.messages(spark, sf), _payments_rev(spark, sf),
                                                fx.review_items(spark, sf))
    return r.select("period", "source", *[_dbl(c).alias(c) for c in
                                          ["parser_detected_sum", "unmatched_review_sum", "period_ledger_sum"]])


@query("review_summary", o.with_ctes(["fx_review_items", "fx_message_state"], [], """SELECT
  count(*) FILTER (WHERE review_status = 'pending') AS pending,
  count(*) FILTER (WHERE review_status = 'pending' AND parser_confidence < 0.5) AS low_confidence,
  CAST(coalesce(sum(detected_amount) FILTER (WHERE review_status = 'pending'), 0) AS DOUBLE) AS pending_amount,
  count(*) FILTER (WHERE review_status IN ('dismissed', 'duplicate')) AS rejected,
  count(*) FILTER (WHERE review_status = 'promoted' AND reviewed_at = (SELECT max(reviewed_at) FROM fx_review_items)) AS promoted_today,
  (SELECT count(*) FROM fx_message_state WHERE status = 'failed' AND attempts >= 5) AS dead_letters
FROM fx_review_items"""))
def review_summary_q(spark, sf):
    items = fx.review_items(spark, sf)
    today = items.agg(F.max("reviewed_at")).scalar()  # the fixture's last day of work
    r = reports.review_summary(items, fx.message_state(spark, sf), today=today)
    return r.select("pending", "low_confidence", _dbl("pending_amount").alias("pending_amount"), "rejected",
                    "promoted_today", "dead_letters")


@query("needs_review", o.with_ctes(["fx_review_items", "fx_messages"], [
    ("pg", f"SELECT * FROM fx_review_items WHERE review_status = 'pending' ORDER BY id DESC LIMIT {LIST_PAGE_SIZE}")],
    """SELECT pg.id, pg.message_id, pg.reason, CAST(pg.detected_amount AS DOUBLE) AS detected_amount, pg.parser_confidence,
  m.source, m.chat_jid, left(coalesce(m.raw_content, ''), 240) AS preview
FROM pg JOIN fx_messages m ON m.id = pg.message_id"""))
def needs_review_q(spark, sf):
    r = reports.needs_review(fx.review_items(spark, sf), fx.messages(spark, sf), size=LIST_PAGE_SIZE)
    return r.select("id", "message_id", "reason", _dbl("detected_amount").alias("detected_amount"),
                    "parser_confidence", "source", "chat_jid", "preview")


@query("dead_letters", o.with_ctes(["fx_message_state", "fx_messages"], [], """SELECT s.message_id, s.attempts, m.source,
  left(coalesce(m.raw_content, ''), 240) AS preview
FROM fx_message_state s JOIN fx_messages m ON m.id = s.message_id WHERE s.status = 'failed' AND s.attempts >= 5"""))
def dead_letters_q(spark, sf):
    return reports.dead_letters(fx.message_state(spark, sf), fx.messages(spark, sf))


@query("identity_summary", o.with_ctes(["fx_employees", "fx_aliases", "fx_identity_reviews"], [
    ("res", """SELECT *, CASE WHEN canonical_employee_id IS NOT NULL THEN 'duplicate'
  WHEN id IN (SELECT canonical_employee_id FROM fx_employees WHERE canonical_employee_id IS NOT NULL) THEN 'canonical'
  ELSE 'unresolved' END AS resolution_status FROM fx_employees""")], """
SELECT 'employees_total' AS metric, count(*) AS value FROM res
UNION ALL SELECT 'employees_canonical', count(*) FROM res WHERE resolution_status = 'canonical'
UNION ALL SELECT 'employees_duplicate', count(*) FROM res WHERE resolution_status = 'duplicate'
UNION ALL SELECT 'employees_unresolved', count(*) FROM res WHERE resolution_status = 'unresolved'
UNION ALL SELECT 'employees_inactive', count(*) FROM res WHERE status = 'inactive'
UNION ALL SELECT 'aliases_total', count(*) FROM fx_aliases
UNION ALL SELECT 'resolution_links', count(*) FROM res WHERE canonical_employee_id IS NOT NULL
UNION ALL SELECT 'review_pending', count(*) FROM fx_identity_reviews WHERE review_status = 'pending'
UNION ALL SELECT 'review_resolved', count(*) FROM fx_identity_reviews WHERE review_status <> 'pending'
UNION ALL SELECT 'audit_entries', count(*) FROM res WHERE canonical_employee_id IS NOT NULL OR status = 'inactive'"""))
def identity_summary_q(spark, sf):
    emp = fx.resolution(spark, sf)
    links = emp.where(F.col("canonical_employee_id").isNotNull())
    audit = emp.where(F.col("canonical_employee_id").isNotNull() | (F.col("status") == "inactive"))
    return reports.identity_summary(emp, fx.aliases(spark, sf), links, fx.identity_reviews(spark, sf), audit)


@query("identity_reviews", o.with_ctes(["fx_employees", "fx_identity_reviews"], [], """SELECT r.id, r.candidate_employee_id,
  r.suspected_match_id, r.match_reason, CAST(r.confidence_score AS DOUBLE) AS confidence_score,
  c.full_name AS candidate_name, c.primary_phone AS candidate_phone, s.full_name AS suspected_name, s.primary_phone AS suspected_phone
FROM fx_identity_reviews r LEFT JOIN fx_employees c ON c.id = r.candidate_employee_id
LEFT JOIN fx_employees s ON s.id = r.suspected_match_id WHERE r.review_status = 'pending'"""))
def identity_reviews_q(spark, sf):
    r = reports.pending_reviews(fx.identity_reviews(spark, sf), fx.employees(spark, sf))
    return r.withColumn("confidence_score", _dbl("confidence_score"))


def _employees_after(emp: DataFrame) -> DataFrame:
    """An edited copy of the employees: every 7th marked inactive (I9), every
    13th renamed to upper case (I13)."""
    i = F.col("id")
    return emp.select("id", F.when(i % 13 == 0, F.upper("full_name")).otherwise(F.col("full_name")).alias("full_name"),
                      F.when(i % 7 == 0, F.lit("inactive")).otherwise(F.col("status")).alias("status"))


@query("audit_rows", o.with_ctes(["fx_employees"], [
    ("aft", """SELECT id, CASE WHEN id % 13 = 0 THEN upper(full_name) ELSE full_name END AS full_name,
  CASE WHEN id % 7 = 0 THEN 'inactive' ELSE status END AS status FROM fx_employees""")],
    """SELECT 'identity' AS family, 'employee' AS entity_type, b.id AS entity_id, 'update' AS action,
  to_json(struct_pack(full_name := b.full_name, status := b.status)) AS before_state,
  to_json(struct_pack(full_name := a.full_name, status := a.status)) AS after_state, 'admin' AS actor, 'edit' AS reason
FROM fx_employees b JOIN aft a ON a.id = b.id WHERE a.full_name <> b.full_name OR a.status <> b.status"""))
def audit_rows_q(spark, sf):
    from ledgerflow.operators.review import audit_rows
    emp = fx.employees(spark, sf)
    return audit_rows(emp, _employees_after(emp), "id", ["full_name", "status"], "identity", "employee",
                      actor="admin", reason="edit")


# ---------------------------------------------------------------------------
# Trigram join and name suggest (F18, J13, A15-A17, I15 exact/prefix tiers)
# ---------------------------------------------------------------------------

@query("trigram_match", o.with_ctes(["fx_messages", "fx_employees"], [
    ("q", "SELECT DISTINCT " + o.norm_name("name_raw") + " AS query FROM parsed WHERE message_type = 'payment' AND name_raw IS NOT NULL"),
    ("qg", "SELECT query, " + o.trigrams("query") + " AS g FROM q"),
    ("eg", "SELECT id, " + o.trigrams("lower(coalesce(full_name, ''))") + " AS g FROM fx_employees WHERE status = 'active'"),
    ("pairs", """SELECT qg.query, eg.id AS employee_id,
  len(list_intersect(qg.g, eg.g)) / (len(qg.g) + len(eg.g) - len(list_intersect(qg.g, eg.g))) AS similarity
FROM qg, eg WHERE len(qg.g) > 0 AND len(eg.g) > 0""")],
    """SELECT query, arg_max(employee_id, struct_pack(s := similarity, n := -employee_id)) AS employee_id,
  round(max(similarity), 6) AS similarity FROM pairs WHERE similarity >= 0.3 GROUP BY query""", parse=True))
def trigram_match(spark, sf):
    p = _parsed(spark, sf).where((F.col("message_type") == "payment") & F.col("payment.name_raw").isNotNull())
    q = p.select(tx.norm_name("payment.name_raw").alias("query")).distinct()
    e = fx.employees(spark, sf).where(F.col("status") == "active")
    pairs = similarity.similarity_join(q, "query", F.col("query"), e, "id", F.lower(F.coalesce("full_name", F.lit(""))))
    best = similarity.best_match(pairs.withColumnRenamed("id", "employee_id"), "query", "employee_id")
    return best.select("query", "employee_id", F.round("similarity", 6).alias("similarity"))


def _suggest_queries(emp: DataFrame) -> DataFrame:
    """Search texts typed against the employee list: every whole name and
    every name missing its last letter."""
    whole = emp.select(F.col("full_name").alias("query"))
    part = emp.select(F.expr("substring(full_name, 1, length(full_name) - 1)").alias("query"))
    return whole.unionByName(part).distinct()


# (score, employee-side form, query-side form, prefix?)
_SUGGEST_TIERS = [
    (0.92, "name", "norm", False), (0.91, "cname", "coll", False),
    (0.88, "alias", "norm", False), (0.87, "calias", "coll", False),
    (0.80, "name", "norm", True), (0.79, "cname", "coll", True),
    (0.78, "alias", "norm", True), (0.77, "calias", "coll", True),
]


@query("suggest_exact_prefix", o.with_ctes(["fx_employees", "fx_aliases"], _CANON + [
    ("qs", """SELECT DISTINCT query FROM (SELECT full_name AS query FROM fx_employees
  UNION ALL SELECT substr(full_name, 1, length(full_name) - 1) FROM fx_employees) x"""),
    ("qf", f"SELECT query, lower({o.strip('query')}) AS qn, regexp_replace(lower({o.strip('query')}), '[^a-z0-9]+', '', 'g') AS qc FROM qs"),
    ("forms", """SELECT id, 'name' AS form, lower(name_normalized) AS v FROM emp
UNION SELECT id, 'name', lower(full_name) FROM emp
UNION SELECT id, 'cname', regexp_replace(lower(coalesce(full_name, '')), '[^a-z0-9]+', '', 'g') FROM emp
UNION SELECT a.employee_id, 'alias', lower(a.alias_value) FROM fx_aliases a JOIN emp e ON e.id = a.employee_id WHERE a.alias_type = 'name'
UNION SELECT a.employee_id, 'calias', regexp_replace(lower(coalesce(a.alias_value, '')), '[^a-z0-9]+', '', 'g') FROM fx_aliases a JOIN emp e ON e.id = a.employee_id WHERE a.alias_type = 'name'"""),
    ("hits", "\nUNION ALL ".join(
        f"""SELECT query, id, {s} AS score FROM qf JOIN forms f ON f.form = '{form}' AND """
        + (f"starts_with(f.v, {'qn' if qf == 'norm' else 'qc'})" if pre else f"f.v = {'qn' if qf == 'norm' else 'qc'}")
        + (" AND length(qc) >= 2" if qf == "coll" else " AND qn <> ''")
        for s, form, qf, pre in _SUGGEST_TIERS))],
    """SELECT query, c.canonical_id AS employee_id, max(score) AS score FROM hits JOIN canon c ON c.id = hits.id
GROUP BY query, c.canonical_id""", recursive=True))
def suggest_exact_prefix(spark, sf):
    emp = fx.employees(spark, sf)
    return _exact_prefix_hits(_suggest_queries(emp), emp, fx.aliases(spark, sf))


def _exact_prefix_hits(queries: DataFrame, employees: DataFrame, aliases: DataFrame,
                       canonical: DataFrame | None = None) -> DataFrame:
    """I15 exact and prefix tiers: ``(query, employee_id, score)``."""
    emp = identity.prepare_master(employees)
    a = aliases.where(F.col("alias_type") == "name").join(emp.select(F.col("id").alias("employee_id")), "employee_id")
    coll = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]+", "")
    form = lambda df, eid, name, v: df.select(F.col(eid).alias("id"), F.lit(name).alias("form"), v.alias("v"))
    forms = (form(emp.select("id", F.explode(F.array_distinct(F.array(F.lower("name_normalized"), F.lower("full_name")))).alias("n")),
                  "id", "name", F.col("n"))
             .unionByName(form(emp, "id", "cname", coll(F.coalesce("full_name", F.lit("")))))
             .unionByName(form(a, "employee_id", "alias", F.lower("alias_value")))
             .unionByName(form(a, "employee_id", "calias", coll(F.coalesce("alias_value", F.lit("")))))
             .where(F.col("v").isNotNull()))
    # every prefix of every form, so a prefix search is an equi-join (bounded by name length)
    prefixes = forms.select("id", "form", F.explode(F.sequence(F.lit(1), F.greatest(F.length("v"), F.lit(1)))).alias("_n"), "v") \
                    .select("id", "form", F.expr("substring(v, 1, _n)").alias("v"), F.lit(True).alias("prefix"))
    keys = forms.withColumn("prefix", F.lit(False)).unionByName(prefixes)
    q = queries.select("query").distinct().select("query", F.lower(tx.py_strip("query")).alias("qn"),
                                                  coll(tx.py_strip("query")).alias("qc"))
    probes = q.select("query", "qn", "qc", F.explode(F.array(*[
        F.struct(F.lit(s).alias("score"), F.lit(form).alias("form"), F.col("qn" if qf == "norm" else "qc").alias("v"),
                 F.lit(pre).alias("prefix"),
                 ((F.length("qc") >= 2) if qf == "coll" else (F.col("qn") != "")).alias("ok"))
        for s, form, qf, pre in _SUGGEST_TIERS])).alias("_p")).where("_p.ok")
    hits = probes.join(keys, (probes["_p.form"] == keys.form) & (probes["_p.v"] == keys.v)
                       & (probes["_p.prefix"] == keys.prefix))
    canon = (canonical if canonical is not None else identity.resolve_canonical(emp)) \
        .select(F.col("id").alias("_cid"), "canonical_id")
    out = hits.join(canon, hits.id == canon._cid).groupBy("query", F.col("canonical_id").alias("employee_id")) \
              .agg(F.max("_p.score").alias("score"))
    return out.select("query", "employee_id", F.col("score").cast("double").alias("score"))


# ---------------------------------------------------------------------------
# Streaming
# ---------------------------------------------------------------------------

@query("stream_event_totals", """SELECT user_id, count(*) AS events, round(sum(value), 6) AS total_value,
  sum(try_cast(json_extract_string(props, '$.k') AS BIGINT)) AS k_sum,
  strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_ts
FROM (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts) = 1) e GROUP BY user_id""")
def stream_event_totals(spark, sf):
    from ledgerflow.streaming import jobs
    out = jobs.event_totals(spark, jobs.event_stream(spark, sf), jobs.scratch_root(spark, "event-totals"))
    return out.select("user_id", "events", F.round("total_value", 6).alias("total_value"), "k_sum",
                      F.date_format("last_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("last_ts"))


@query("stream_pipeline_ledger", ORACLE["flagship_ledger"])
def stream_pipeline_ledger(spark, sf):
    """The flagship's messages as a stream of three files, each a third of the messages in their order."""
    from ledgerflow.streaming import jobs, pipeline
    root = jobs.scratch_root(spark, "pipeline")
    m = fx.messages(spark, sf)
    third = m.agg(F.max("id")).first()[0] // 3 + 1
    for k in range(3):
        m.where(F.floor((F.col("id") - 1) / third) == k).write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema(m.schema).option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    pipeline.run_pipeline(stream.withColumnRenamed("id", "seq"), f"{root}/out", fx.employees(spark, sf), fx.aliases(spark, sf),
                          fx.authorized_senders(spark, sf), arrival_col="seq", fuzzy_names=False)
    led = pipeline.ledger(spark, f"{root}/out")
    return led.select("employee_id", "accounting_period", _dbl("total_paid").alias("total_paid"), _dbl("total_advance").alias("total_advance"),
                      F.col("txn_count").cast("long").alias("txn_count"), _dbl("closing_balance").alias("closing_balance"))


# ---------------------------------------------------------------------------
# Search, profiles, manual payments, review decisions, state, health (I14, I16,
# U4, T3, T8-T12, T15, T17, A13)
# ---------------------------------------------------------------------------

def _search_queries(spark, sf):
    emp = fx.employees(spark, sf)
    i = F.col("id")
    # for every employee: its phone, the phone with +88, a phone nobody has, the
    # name in upper case, and its segment's shared alias
    return (emp.select(F.col("primary_phone").alias("query"))
            .unionByName(emp.select(F.concat(F.lit("+88"), F.col("primary_phone")).alias("query")))
            .unionByName(emp.select(F.concat(F.lit("01"), F.lpad((F.lit(800000000) + i - 1).cast("string"), 9, "0")).alias("query")))
            .unionByName(emp.select(F.upper("full_name").alias("query")))
            .unionByName(emp.select(F.concat(F.lit("al-"), F.split("full_name", " ")[0]).alias("query"))))


@query("employee_search", o.with_ctes(["fx_employees", "fx_aliases"], _CANON + [
    ("qs", """SELECT primary_phone AS query FROM fx_employees
UNION ALL SELECT '+88' || primary_phone FROM fx_employees
UNION ALL SELECT concat('01', lpad(CAST(800000000 + id - 1 AS VARCHAR), 9, '0')) FROM fx_employees
UNION ALL SELECT upper(full_name) FROM fx_employees
UNION ALL SELECT 'al-' || split_part(full_name, ' ', 1) FROM fx_employees"""),
    ("qf", f"""SELECT DISTINCT query,
  CASE WHEN length(regexp_replace({o.strip('query')}, '\\P{{Nd}}', '', 'g')) >= 6 THEN {o.norm_phone(o.strip('query'))} END AS ph,
  {o.norm_name('query')} AS nm FROM qs WHERE {o.strip('query')} <> ''"""),
    # in this fixture names score 90 or more if they share the segment and their codes of six letters are an
    # insertion and a deletion apart: then both are the same without some letter
    ("fz", """SELECT DISTINCT x.query, y.id
FROM (SELECT query, split_part(nm, ' ', 1) AS seg, split_part(nm, ' ', 2) AS code, unnest(range(1, 7)) AS i FROM qf) x
JOIN (SELECT id, split_part(name_normalized, ' ', 1) AS seg, split_part(name_normalized, ' ', 2) AS code, unnest(range(1, 7)) AS i
      FROM emp WHERE status = 'active') y
  ON x.seg = y.seg AND substr(x.code, 1, x.i - 1) || substr(x.code, x.i + 1) = substr(y.code, 1, y.i - 1) || substr(y.code, y.i + 1)
WHERE length(x.code) = 6 AND x.code <> y.code"""),
    ("hits", """SELECT query, e.id, 1 AS priority, 'id_phone' AS match_type FROM qf JOIN emp e ON e.employee_id_phone = qf.ph
UNION ALL SELECT query, e.id, 2, 'primary_phone' FROM qf JOIN emp e ON e.primary_phone = qf.ph
UNION ALL SELECT query, a.employee_id, 3, 'alias_phone' FROM qf JOIN fx_aliases a ON a.alias_type = 'phone' AND a.alias_value = qf.ph
UNION ALL SELECT query, e.id, 4, 'exact_name' FROM qf JOIN emp e ON e.name_normalized = qf.nm AND qf.nm <> ''
UNION ALL SELECT query, a.employee_id, 5, 'alias_name' FROM qf JOIN fx_aliases a ON a.alias_type = 'name' AND a.alias_value = qf.nm AND qf.nm <> ''
UNION ALL SELECT query, id, 6, 'fuzzy_name' FROM fz""")],
    """SELECT query, c.canonical_id AS employee_id, arg_min(match_type, priority) AS match_type, min(priority) AS priority
FROM hits JOIN canon c ON c.id = hits.id GROUP BY query, c.canonical_id""", recursive=True))
def employee_search(spark, sf):
    return identity.search(_search_queries(spark, sf), fx.employees(spark, sf), fx.aliases(spark, sf)) \
        .select("query", "employee_id", "match_type", "priority")


@query("canonical_profile", o.with_ctes(["fx_employees", "fx_aliases"], _CANON + [
    ("mem", "SELECT canonical_id, list_sort(list(id)) AS member_ids FROM canon GROUP BY canonical_id"),
    ("al", """SELECT c.canonical_id, list_sort(list(DISTINCT {'t': a.alias_type, 'v': a.alias_value})) AS al
FROM canon c JOIN fx_aliases a ON a.employee_id = c.id GROUP BY c.canonical_id""")],
    """SELECT e.id AS canonical_id, e.employee_code, e.full_name, array_to_string(m.member_ids, ',') AS member_ids,
  array_to_string(list_transform(al.al, lambda x: x.t || ':' || x.v), ',') AS aliases,
  array_to_string(list_filter(list_distinct_ordered, lambda p: p IS NOT NULL), ',') AS payout_phones
FROM (SELECT e.*, list_concat([e.primary_phone, e.employee_id_phone],
        list_transform(list_filter(coalesce(al.al, []), lambda x: x.t = 'phone'), lambda x: x.v)) AS phones FROM emp e
      LEFT JOIN al ON al.canonical_id = e.id) e
JOIN canon c ON c.id = e.id AND c.canonical_id = e.id
LEFT JOIN mem m ON m.canonical_id = e.id LEFT JOIN al ON al.canonical_id = e.id,
LATERAL (SELECT list(p ORDER BY i) AS list_distinct_ordered FROM (
  SELECT p, min(i) AS i FROM (SELECT unnest(e.phones) AS p, generate_subscripts(e.phones, 1) AS i) GROUP BY p)) d""",
    recursive=True))
def canonical_profile(spark, sf):
    p = identity.canonical_profiles(fx.employees(spark, sf), fx.aliases(spark, sf))
    return p.select("canonical_id", "employee_code", "full_name",
                    F.array_join(F.transform("member_ids", lambda x: x.cast("string")), ",").alias("member_ids"),
                    F.array_join("aliases", ",").alias("aliases"), F.array_join("payout_phones", ",").alias("payout_phones"))


def _manual_requests(spark, sf):
    p = fx.payments(spark, sf)
    first = p.select(F.col("id").alias("request_id"), "employee_id", "amount", "payout_method", "txn_date",
                     "txn_category", F.lit("adjust").alias("note"), F.lit("admin").alias("actor"))
    again = p.where(F.col("id") % 2 == 0).select((F.col("id") + 1000000000).alias("request_id"), "employee_id", "amount",
                                                  "payout_method", "txn_date", "txn_category",
                                                  F.lit("adjust again").alias("note"), F.lit("admin").alias("actor"))
    return first.unionByName(again)


@query("manual_payments", o.with_ctes(["fx_payments"], [
    ("reqs", """SELECT id AS request_id, employee_id, amount, payout_method, txn_date FROM fx_payments
UNION ALL SELECT id + 1000000000, employee_id, amount, payout_method, txn_date FROM fx_payments WHERE id % 2 = 0"""),
    ("keyed", """SELECT request_id,
  'fpe-' || sha256(concat_ws('|', 'manual-' || CAST(request_id AS VARCHAR), CAST(employee_id AS VARCHAR), CAST(amount AS VARCHAR),
     strftime(txn_date, '%Y-%m'), payout_method))[1:16] AS txn_ref,
  'fpe-' || sha256(concat_ws('|', '', CAST(employee_id AS VARCHAR),
     regexp_replace(regexp_replace(CAST(amount AS VARCHAR), '0$', ''), '\\.$', '.0'), strftime(txn_date, '%Y-%m'), payout_method))[1:16] AS parity_ref
FROM reqs""")],
    """SELECT request_id, txn_ref, row_number() OVER (ORDER BY request_id) AS id,
  request_id = min(request_id) OVER (PARTITION BY parity_ref) AS kept_under_parity FROM keyed"""))
def manual_payments_q(spark, sf):
    reqs = _manual_requests(spark, sf)
    fixed = posting.manual_payments(reqs)
    par = posting.manual_payments(reqs, parity=True).select("request_id", F.lit(True).alias("kept_under_parity"))
    return fixed.join(par, "request_id", "left").select(
        "request_id", "txn_ref", "id", F.coalesce("kept_under_parity", F.lit(False)).alias("kept_under_parity"))


@query("review_promote", o.with_ctes(["fx_review_items"], [
    ("d", "SELECT id AS item_id, (message_id % 100) + 1 AS employee_id FROM fx_review_items")],
    """SELECT d.item_id,
  CASE WHEN r.review_status = 'promoted' THEN 'already_promoted'
       WHEN r.detected_amount IS NULL OR r.detected_amount <= 0 THEN 'no_positive_amount' ELSE 'promoted' END AS outcome,
  CASE WHEN r.review_status <> 'promoted' AND r.detected_amount > 0 THEN CAST(r.detected_amount AS DOUBLE) END AS amount,
  CASE WHEN r.review_status <> 'promoted' AND r.detected_amount > 0 THEN
    'fpe-' || sha256(concat_ws('|', CAST(r.message_id AS VARCHAR), CAST(d.employee_id AS VARCHAR), CAST(r.detected_amount AS VARCHAR),
      '2026-01', 'unknown'))[1:16] END AS txn_ref
FROM d JOIN fx_review_items r ON r.id = d.item_id"""))
def review_promote(spark, sf):
    from ledgerflow.operators.review import promote
    r = fx.review_items(spark, sf).withColumn("detected_payout_method", F.lit(None).cast("string")) \
        .withColumn("detected_txn_date", F.lit(None).cast("date")).withColumn("raw_content", F.lit(None).cast("string"))
    d = r.select(
        F.col("id").alias("item_id"), ((F.col("message_id") % 100) + 1).alias("employee_id"),
        F.lit(None).cast("double").alias("amount"), F.lit(None).cast("string").alias("payout_method"),
        F.lit("2026-01-15").cast("date").alias("txn_date"), F.lit("salary").alias("txn_category"),
        F.lit("admin").alias("reviewer"))
    ok, bad = promote(r, d)
    posted = ok.select("item_id", F.lit("promoted").alias("outcome"), _dbl("amount").alias("amount"),
                       tx.payment_ref("message_id", "employee_id", "amount", tx.period("txn_date"), "payout_method")
                       .alias("txn_ref"))
    return posted.unionByName(bad.select("item_id", F.col("reject_reason").alias("outcome"),
                                         F.lit(None).cast("double").alias("amount"), F.lit(None).cast("string").alias("txn_ref")))


@query("review_dismiss", o.with_ctes(["fx_review_items"], [], """SELECT id,
  CASE WHEN id % 11 = 0 AND review_status <> 'promoted' THEN 'dismissed' ELSE review_status END AS review_status,
  CASE WHEN id % 11 = 0 AND review_status <> 'promoted' THEN 'admin' END AS reviewer
FROM fx_review_items"""))
def review_dismiss(spark, sf):
    from ledgerflow.operators.review import close_items
    r = fx.review_items(spark, sf).withColumn("reviewer", F.lit(None).cast("string")) \
        .withColumn("review_note", F.lit(None).cast("string"))
    d = r.where(F.col("id") % 11 == 0).select(F.col("id").alias("item_id"), F.lit("admin").alias("reviewer"),
                                                F.lit("not a payment").alias("note"))
    return close_items(r, d, "dismissed").select("id", "review_status", "reviewer")


@query("unmatched_list", o.with_ctes(["fx_review_items", "fx_messages"], [], """SELECT r.id, r.message_id, r.reason,
  left(coalesce(m.raw_content, ''), 240) AS preview
FROM fx_review_items r JOIN fx_messages m ON m.id = r.message_id WHERE r.id % 5 <> 0"""))
def unmatched_list(spark, sf):
    from ledgerflow.operators.review import mark_reviewed
    r = fx.review_items(spark, sf).withColumn("reviewed", F.lit(False)).withColumn("reviewed_at", F.lit(None).cast("timestamp"))
    r = mark_reviewed(r, r.where(F.col("id") % 5 == 0).select(F.col("id").alias("item_id")))
    m = fx.messages(spark, sf).select(F.col("id").alias("_mid"), "raw_content")
    u = r.where(~F.col("reviewed"))
    return u.join(m, u.message_id == m._mid).select("id", "message_id", "reason", tx.preview("raw_content").alias("preview"))


_TRANS_SQL = """SELECT message_id, 1 AS seq, CASE WHEN status = 'pending' THEN 'parsing' ELSE 'accounting' END AS status,
  NULL AS error, queued_at + INTERVAL 1 MINUTE AS "at" FROM fx_message_state WHERE status IN ('pending', 'parsed')
UNION ALL SELECT message_id, 2, CASE WHEN status = 'pending' THEN 'parsed' ELSE 'done' END, NULL, queued_at + INTERVAL 2 MINUTE
  FROM fx_message_state WHERE status IN ('pending', 'parsed')
UNION ALL SELECT message_id, 3, 'failed', 'boom', queued_at + INTERVAL 3 MINUTE
  FROM fx_message_state WHERE status = 'pending' AND message_id % 3 = 0"""


@query("state_transitions", o.with_ctes(["fx_message_state"], [("t", _TRANS_SQL),
    ("g", """SELECT message_id, arg_max(status, seq) AS last_status, arg_max(error, seq) AS last_error, count(*) AS n,
  count(*) FILTER (WHERE status = 'failed') AS fails,
  max("at") FILTER (WHERE status IN ('done', 'skipped', 'failed')) AS done_at FROM t GROUP BY message_id""")],
    """SELECT s.message_id, coalesce(g.last_status, s.status) AS status, g.last_error AS last_error,
  s.attempts + coalesce(g.n, 0) AS attempts_parity, s.attempts + coalesce(g.fails, 0) AS attempts_fixed,
  strftime(g.done_at, '%Y-%m-%d %H:%M:%S') AS processed_at
FROM fx_message_state s LEFT JOIN g USING (message_id)"""))
def state_transitions(spark, sf):
    from ledgerflow.operators.review import apply_transitions
    s = fx.message_state(spark, sf).withColumn("last_error", F.lit(None).cast("string")) \
        .withColumn("processed_at", F.lit(None).cast("timestamp_ntz"))
    src = s.where(F.col("status").isin("pending", "parsed"))
    pend = F.col("status") == "pending"
    t = (src.select("message_id", F.lit(1).alias("seq"), F.when(pend, "parsing").otherwise("accounting").alias("status"),
                    F.lit(None).cast("string").alias("error"), (F.col("queued_at") + F.expr("INTERVAL 1 MINUTE")).alias("at"))
         .unionByName(src.select("message_id", F.lit(2).alias("seq"), F.when(pend, "parsed").otherwise("done").alias("status"),
                                 F.lit(None).cast("string").alias("error"),
                                 (F.col("queued_at") + F.expr("INTERVAL 2 MINUTE")).alias("at")))
         .unionByName(src.where(pend & (F.col("message_id") % 3 == 0)).select(
             "message_id", F.lit(3).alias("seq"), F.lit("failed").alias("status"), F.lit("boom").alias("error"),
             (F.col("queued_at") + F.expr("INTERVAL 3 MINUTE")).alias("at"))))
    par = apply_transitions(s, t, parity=True)
    fix = apply_transitions(s, t, parity=False).select("message_id", F.col("attempts").alias("attempts_fixed"))
    return par.join(fix, "message_id").select(
        "message_id", "status", "last_error", F.col("attempts").cast("long").alias("attempts_parity"),
        F.col("attempts_fixed").cast("long").alias("attempts_fixed"),
        F.date_format("processed_at", "yyyy-MM-dd HH:mm:ss").alias("processed_at"))


@query("requeue_dead_letters", o.with_ctes(["fx_message_state"], [], """SELECT
  CASE WHEN status = 'failed' AND attempts >= 5 THEN 'pending' ELSE status END AS status, count(*) AS n,
  sum(CASE WHEN status = 'failed' AND attempts >= 5 THEN 0 ELSE attempts END) AS attempts_sum
FROM fx_message_state GROUP BY 1"""))
def requeue_dead_letters(spark, sf):
    from ledgerflow.operators.review import requeue
    s = fx.message_state(spark, sf).withColumn("last_error", F.lit(None).cast("string"))
    dead = s.where((F.col("status") == "failed") & (F.col("attempts") >= 5)).select("message_id")
    r = requeue(s, dead)
    return r.groupBy("status").agg(F.count(F.lit(1)).alias("n"), F.sum("attempts").cast("long").alias("attempts_sum"))


@query("employee_ledger", o.with_ctes(["fx_payments"], _REV + [
    ("l", """SELECT employee_id, accounting_period, CAST(sum(CASE WHEN txn_category <> 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_paid,
  count(*) AS txn_count FROM pr WHERE employee_id IS NOT NULL GROUP BY ALL""")],
    """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY employee_id ORDER BY accounting_period DESC) AS rank FROM l)
WHERE rank <= 36"""))
def employee_ledger(spark, sf):
    led = posting.ledger(_payments_rev(spark, sf))
    top = top_k_per_group(led, ["employee_id"], [F.col("accounting_period").desc()], 36,
                          salt_of=F.col("accounting_period"), rank_col="rank")
    return top.select("employee_id", "accounting_period", _dbl("total_paid").alias("total_paid"),
                      F.col("txn_count").cast("long").alias("txn_count"), F.col("rank").cast("long").alias("rank"))


@query("health_counts", o.with_ctes(["fx_messages", "fx_message_state", "fx_payments", "fx_employees", "fx_review_items"], _REV, """
SELECT 'messages' AS metric, count(*) AS value FROM fx_messages
UNION ALL SELECT 'pending', count(*) FILTER (WHERE status = 'pending') FROM fx_message_state
UNION ALL SELECT 'parsed', count(*) FILTER (WHERE status = 'parsed') FROM fx_message_state
UNION ALL SELECT 'failed', count(*) FILTER (WHERE status = 'failed') FROM fx_message_state
UNION ALL SELECT 'payments', count(*) FROM pr WHERE NOT is_reversal
UNION ALL SELECT 'employees', count(*) FROM fx_employees
UNION ALL SELECT 'pending_review', count(*) FILTER (WHERE review_status = 'pending') FROM fx_review_items"""))
def health_counts(spark, sf):
    return reports.health(fx.messages(spark, sf), fx.message_state(spark, sf), _payments_rev(spark, sf),
                          fx.employees(spark, sf), fx.review_items(spark, sf))


# ---------------------------------------------------------------------------
# Sender lookup, incremental read, sync and gap totals, text search,
# duplicate links, review resolution
# ---------------------------------------------------------------------------

_LID_OFFSET = 5000000


def _raw_senders(spark, sf):
    o = read_table(spark, sf, "orders", ["o_orderkey", "o_custkey"])
    k = F.col("o_orderkey")
    ph = F.concat(F.lit("01"), F.lpad((F.lit(700000000) + F.col("o_custkey")).cast("string"), 9, "0"))
    sender = (F.when(k % 3 == 0, F.concat((F.col("o_custkey") + _LID_OFFSET).cast("string"), F.lit("@lid")))
              .when(k % 3 == 1, F.concat(F.lit("88"), ph, F.lit("@s.whatsapp.net")))
              .otherwise(F.concat(F.lit("+88"), ph)))
    return o.select(F.concat(F.lit("M"), k.cast("string")).alias("wa_message_id"), sender.alias("sender"))


def _lid_map(spark, sf):
    c = read_table(spark, sf, "customer", ["c_custkey"]).where(F.col("c_custkey") % 4 != 0)
    return c.select((F.col("c_custkey") + _LID_OFFSET).cast("string").alias("lid"),
                    F.concat(F.lit("01"), F.lpad((F.lit(700000000) + F.col("c_custkey")).cast("string"), 9, "0")).alias("phone"))


@query("sender_resolve", f"""WITH raw AS (SELECT concat('M', CAST(o_orderkey AS VARCHAR)) AS wa_message_id,
  CASE o_orderkey % 3 WHEN 0 THEN CAST(o_custkey + {_LID_OFFSET} AS VARCHAR) || '@lid'
    WHEN 1 THEN concat('88', concat('01', lpad(CAST(700000000 + o_custkey AS VARCHAR), 9, '0')), '@s.whatsapp.net')
    ELSE '+88' || concat('01', lpad(CAST(700000000 + o_custkey AS VARCHAR), 9, '0')) END AS sender FROM orders),
lid AS (SELECT CAST(c_custkey + {_LID_OFFSET} AS VARCHAR) AS lid, concat('01', lpad(CAST(700000000 + c_custkey AS VARCHAR), 9, '0')) AS phone
  FROM customer WHERE c_custkey % 4 <> 0),
r AS (SELECT raw.wa_message_id, raw.sender,
  CASE WHEN contains(raw.sender, '@s.whatsapp.net') THEN {o.norm_phone("split_part(raw.sender, '@', 1)")}
       WHEN ends_with(raw.sender, '@lid') THEN lid.phone ELSE split_part(raw.sender, '@', 1) END AS v
  FROM raw LEFT JOIN lid ON ends_with(raw.sender, '@lid') AND split_part(raw.sender, '@', 1) = lid.lid)
SELECT wa_message_id, sender, {o.norm_phone('v')} AS sender_phone FROM r""")
def sender_resolve(spark, sf):
    from ledgerflow.sources import ingest as ing
    return ing.resolve_sender(_raw_senders(spark, sf), _lid_map(spark, sf)).select("wa_message_id", "sender", "sender_phone")


@query("read_increment", o.with_ctes(["fx_store_rows"], _CP_CTES[:1] + [
    ("cp", "SELECT source, chat_jid, max(timestamp_wa) AS since FROM b1 GROUP BY ALL")],
    """SELECT s.source, s.chat_jid, count(*) AS n, strftime(min(s.timestamp_wa), '%Y-%m-%d %H:%M:%S') AS first_ts
FROM fx_store_rows s LEFT JOIN cp ON cp.source = s.source AND cp.chat_jid = s.chat_jid
WHERE cp.since IS NULL OR s.timestamp_wa >= cp.since GROUP BY ALL"""))
def read_increment_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    s = fx.store_rows(spark, sf)
    b1 = s.where(F.col("timestamp_wa") < F.lit(CHECKPOINT_SPLIT).cast("timestamp_ntz"))
    cp = ing.checkpoint_batch(b1)
    inc = ing.read_increment(s, cp)
    return inc.groupBy("source", "chat_jid").agg(
        F.count(F.lit(1)).alias("n"), F.date_format(F.min("timestamp_wa"), "yyyy-MM-dd HH:mm:ss").alias("first_ts"))


@query("sync_counts", o.with_ctes(["fx_messages", "fx_store_rows"], _INGEST_CTES,
                                  "SELECT source, count(*) AS ingested FROM j WHERE archived_id IS NULL GROUP BY source"))
def sync_counts_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    inserted, _ = ing.ingest(_archive(spark, sf), _incoming(spark, sf))
    return ing.sync_counts(inserted)


@query("gap_totals", o.with_ctes(["fx_messages", "fx_store_rows"], _GAP_CTES, """SELECT
  count(*) FILTER (WHERE NOT in_arch) AS missing, count(*) FILTER (WHERE NOT in_arch AND NOT blank) AS backfilled,
  count(*) FILTER (WHERE NOT in_arch AND blank) AS skipped_no_content FROM marked"""))
def gap_totals_q(spark, sf):
    from ledgerflow.sources import ingest as ing
    t = ing.gap_totals(ing.gap_run_log(fx.store_rows(spark, sf), _archive(spark, sf)))
    return t.select(*[F.col(c).cast("long").alias(c) for c in ["missing", "backfilled", "skipped_no_content"]])


SEARCH_TEXT = "aab"


@query("employee_text_search", o.with_ctes(["fx_employees", "fx_aliases"], [], f"""SELECT id, employee_code, full_name
FROM fx_employees e WHERE status = 'active' AND canonical_employee_id IS NULL AND (
  full_name ILIKE '%{SEARCH_TEXT}%' OR primary_phone ILIKE '%{SEARCH_TEXT}%' OR employee_code ILIKE '%{SEARCH_TEXT}%'
  OR EXISTS (SELECT 1 FROM fx_aliases a WHERE a.employee_id = e.id AND a.alias_value ILIKE '%{SEARCH_TEXT}%'))"""))
def employee_text_search(spark, sf):
    emp = identity.prepare_master(fx.employees(spark, sf))
    return identity.text_search(emp, fx.aliases(spark, sf), SEARCH_TEXT).select("id", "employee_code", "full_name")


def _link_decisions(spark, sf):
    e = fx.employees(spark, sf).select("id")
    i = F.col("id")
    d = lambda cond, req, dup, can: e.where(cond).select(req.alias("request_id"), dup.alias("duplicate_id"),
                                                         can.alias("canonical_id"))
    return (d(i % 10 == 5, i, i, i - 4)
            .unionByName(d(i % 100 == 15, i + 1000000, i, i))
            .unionByName(d(i % 50 == 25, i + 3000000, i + 10000000, i))
            .unionByName(d(i % 10 == 1, i, i, i + 7))
            .unionByName(d(i % 30 == 5, i + 2000000, i, i - 3))
            .unionByName(d(i % 20 == 1, i + 4000000, i, i + 4))
            .unionByName(d(i % 100 == 35, -i, i, i))
            .withColumn("score", F.lit(0.9)).withColumn("actor", F.lit("admin")))


@query("link_duplicates", o.with_ctes(["fx_employees"], [
    ("d", """SELECT id AS request_id, id AS duplicate_id, id - 4 AS canonical_id FROM fx_employees WHERE id % 10 = 5
UNION ALL SELECT id + 1000000, id, id FROM fx_employees WHERE id % 100 = 15
UNION ALL SELECT id + 3000000, id + 10000000, id FROM fx_employees WHERE id % 50 = 25
UNION ALL SELECT id, id, id + 7 FROM fx_employees WHERE id % 10 = 1
UNION ALL SELECT id + 2000000, id, id - 3 FROM fx_employees WHERE id % 30 = 5
UNION ALL SELECT id + 4000000, id, id + 4 FROM fx_employees WHERE id % 20 = 1
UNION ALL SELECT -id, id, id FROM fx_employees WHERE id % 100 = 35"""),
    ("j", """SELECT d.*, CASE WHEN dd.id IS NULL THEN 'duplicate_missing' WHEN duplicate_id = d.canonical_id THEN 'self_link'
       WHEN t.id IS NULL THEN 'canonical_missing' WHEN t.canonical_employee_id IS NOT NULL THEN 'target_is_duplicate' END AS bad
FROM d LEFT JOIN fx_employees dd ON dd.id = d.duplicate_id LEFT JOIN fx_employees t ON t.id = d.canonical_id"""),
    # in this fixture a row that is a target is linked by requests whose own targets stay unlinked before them,
    # so the first valid request of a row is its accepted one
    ("firsts", "SELECT duplicate_id AS fd, min(request_id) AS fr FROM j WHERE bad IS NULL GROUP BY ALL")],
    """SELECT request_id, duplicate_id, canonical_id,
  CASE WHEN bad IS NOT NULL THEN bad WHEN t.fr < request_id THEN 'target_is_duplicate' ELSE 'linked' END AS outcome
FROM j LEFT JOIN firsts t ON t.fd = j.canonical_id"""))
def link_duplicates_q(spark, sf):
    emp = fx.employees(spark, sf).withColumn("resolution_status", F.lit("unresolved"))
    out = edits.link_duplicates(emp, _link_decisions(spark, sf))
    ok = out.audit.select("request_id", F.col("entity_id").alias("duplicate_id"),
                          F.get_json_object("after_state", "$.canonical_employee_id").cast("long").alias("canonical_id"), F.lit("linked").alias("outcome"))
    return ok.unionByName(out.rejected.select("request_id", "duplicate_id", "canonical_id", F.col("reject_reason").alias("outcome")))


# merges in id order: a review's target, the row before its candidate, is a duplicate if that row's own review
# was merged before, or if it is linked in the master
@query("resolve_reviews", o.with_ctes(["fx_identity_reviews", "fx_employees"], [], """SELECT r.id,
  CASE WHEN r.review_status = 'pending' AND r.id % 4 = 2 AND e.canonical_employee_id IS NULL THEN 'approved_merge'
       WHEN r.review_status = 'pending' AND r.id % 4 = 0 THEN 'rejected' ELSE r.review_status END AS review_status,
  r.review_status = 'pending' AND r.id % 4 = 2 AND e.canonical_employee_id IS NULL AS merged,
  CASE WHEN r.review_status <> 'pending' AND r.id % 2 = 0 THEN 'not_pending'
       WHEN r.id % 4 = 2 AND e.canonical_employee_id IS NOT NULL THEN 'target_is_duplicate' END AS refused
FROM fx_identity_reviews r JOIN fx_employees e ON e.id = r.suspected_match_id"""))
def resolve_reviews_q(spark, sf):
    r = fx.identity_reviews(spark, sf)
    dec = r.where(F.col("id") % 2 == 0).select(
        F.col("id").alias("request_id"), F.col("id").alias("review_id"), F.when(F.col("id") % 4 == 2, "approved_merge").otherwise("rejected").alias("decision"),
        F.lit("admin").alias("reviewer"), F.lit(None).cast("string").alias("note"))
    out = edits.resolve_reviews(r, dec, fx.employees(spark, sf))
    m = out.links.added.select("request_id", F.lit(True).alias("merged"))
    no = out.rejected.select(F.col("review_id").alias("_v"), F.col("reject_reason").alias("refused"))
    j = out.reviews.join(m, F.col("id") == F.col("request_id"), "left").join(no, F.col("id") == F.col("_v"), "left")
    return j.select("id", "review_status", F.coalesce("merged", F.lit(False)).alias("merged"), "refused")


@query("mark_inactive", o.with_ctes(["fx_employees"], [], """SELECT id, CASE WHEN id % 50 = 7 THEN 'inactive' ELSE status END AS status,
  CASE WHEN id % 50 = 7 THEN 'inactive' ELSE 'unresolved' END AS resolution_status, CASE WHEN id % 50 = 7 THEN status END AS audited
FROM fx_employees
UNION ALL SELECT id + 10000000, 'not_found', NULL, NULL FROM fx_employees WHERE id % 100 = 9"""))
def mark_inactive_q(spark, sf):
    e = fx.employees(spark, sf)
    ask = e.where(F.col("id") % 50 == 7).select("id").unionByName(e.where(F.col("id") % 100 == 9).select((F.col("id") + 10000000).alias("id")))
    req = ask.select(F.col("id").alias("request_id"), F.col("id").alias("employee_id"), F.lit("admin").alias("actor"), F.lit("left").alias("reason"))
    out = edits.mark_inactive(e, req)
    was = out.audit.select(F.col("entity_id").alias("_e"), F.get_json_object("before_state", "$.status").alias("audited"))
    none = F.lit(None).cast("string")
    return out.table.join(was, F.col("id") == F.col("_e"), "left").select("id", "status", "resolution_status", "audited").unionByName(
        out.rejected.select(F.col("employee_id").alias("id"), F.col("reject_reason").alias("status"), none.alias("resolution_status"), none.alias("audited")))


@query("add_aliases", o.with_ctes(["fx_employees", "fx_aliases"], [
    ("req", """SELECT id AS request_id, id AS employee_id, 'phone' AS alias_type, concat('01', lpad(CAST(800000000 + id AS VARCHAR), 9, '0')) AS alias_value FROM fx_employees
UNION ALL SELECT 1000000 + id, id, 'name', concat('shared ', CAST(id % 100 AS VARCHAR)) FROM fx_employees
UNION ALL SELECT 2000000 + id, id, 'email', 'x' FROM fx_employees WHERE id % 9 = 0
UNION ALL SELECT 3000000 + id, id, 'employee_id', '' FROM fx_employees WHERE id % 11 = 0"""),
    ("w", """SELECT alias_type, alias_value, min(request_id) AS first FROM req WHERE alias_type IN ('phone', 'name', 'employee_id') AND alias_value <> '' GROUP BY ALL""")],
    """SELECT r.request_id, r.employee_id, CASE WHEN r.alias_type NOT IN ('phone', 'name', 'employee_id') THEN 'invalid_alias_type'
  WHEN r.alias_value = '' THEN 'empty_value' WHEN w.first = r.request_id AND a.alias_value IS NULL THEN 'added' ELSE 'taken' END AS outcome
FROM req r LEFT JOIN w USING (alias_type, alias_value)
LEFT JOIN (SELECT DISTINCT alias_type, alias_value FROM fx_aliases) a USING (alias_type, alias_value)"""))
def add_aliases_q(spark, sf):
    e, i = fx.employees(spark, sf), F.col("id")
    row = lambda at, kind, value, where: e.where(where).select((i + at).alias("request_id"), i.alias("employee_id"), F.lit(kind).alias("alias_type"),
                                                               value.alias("alias_value"), F.lit("admin").alias("actor"))
    req = (row(0, "phone", F.concat(F.lit("01"), F.lpad((F.lit(800000000) + i).cast("string"), 9, "0")), F.lit(True))
           .unionByName(row(1000000, "name", F.concat(F.lit("shared "), (i % 100).cast("string")), F.lit(True)))
           .unionByName(row(2000000, "email", F.lit("x"), i % 9 == 0)).unionByName(row(3000000, "employee_id", F.lit(""), i % 11 == 0)))
    out = edits.add_aliases(fx.aliases(spark, sf), req)
    return out.audit.select("request_id", F.col("entity_id").alias("employee_id"), F.lit("added").alias("outcome")).unionByName(
        out.rejected.select("request_id", "employee_id", F.col("reject_reason").alias("outcome")))


# ---------------------------------------------------------------------------
# Work queues and gauges (W6, W7, J1, J2, A14), name enrichment
# ---------------------------------------------------------------------------

@query("parse_queue", o.with_ctes(["fx_message_state", "fx_messages"], [], """SELECT s.message_id, s.status, s.attempts,
  strftime(s.queued_at, '%Y-%m-%d') AS queued_at, m.source, m.chat_jid, m.is_from_me, m.raw_content
FROM fx_message_state s JOIN fx_messages m ON m.id = s.message_id WHERE s.status = 'pending' AND s.attempts < 5"""))
def parse_queue_q(spark, sf):
    q = reports.parse_queue(fx.message_state(spark, sf), fx.messages(spark, sf))
    return q.select("message_id", "status", "attempts", _day("queued_at").alias("queued_at"), "source", "chat_jid",
                    "is_from_me", "raw_content")


@query("posting_queue", sql_with_parse(["fx_message_state", "fx_messages"], [], """SELECT s.message_id, p.message_type,
  s.attempts, strftime(s.queued_at, '%Y-%m-%d') AS queued_at, m.source, p.payout_phone, CAST(p.amount AS DOUBLE) AS amount,
  p.confidence
FROM fx_message_state s JOIN parsed p ON p.message_id = s.message_id JOIN fx_messages m ON m.id = s.message_id
WHERE s.status = 'parsed' AND s.attempts < 5 AND p.message_type IN ('payment', 'cash_command', 'income_command')"""))
def posting_queue_q(spark, sf):
    msgs = fx.messages(spark, sf)
    q = reports.posting_queue(fx.message_state(spark, sf), parse_results(msgs), msgs)
    return q.select("message_id", "message_type", "attempts", _day("queued_at").alias("queued_at"), "source",
                    "payment.payout_phone", _dbl("payment.amount").alias("amount"), "confidence")


@query("queue_gauges", o.with_ctes(["fx_review_items", "fx_message_state"], [], """
SELECT 'pending_review' AS metric, count(*) FILTER (WHERE review_status = 'pending') AS value FROM fx_review_items
UNION ALL SELECT 'dead_letters', count(*) FILTER (WHERE status = 'failed' AND attempts >= 5) FROM fx_message_state"""))
def queue_gauges_q(spark, sf):
    return reports.queue_gauges(fx.review_items(spark, sf), fx.message_state(spark, sf))


def _employees_unnamed(emp: DataFrame) -> DataFrame:
    """Employees whose stored name is a placeholder: every 11th is 'Unknown'
    (as rows created from a phone alone are)."""
    return emp.withColumn("full_name", F.when(F.col("id") % 11 == 0, F.lit("Unknown")).otherwise(F.col("full_name")))


_UNNAMED_MASTER = [(o.MASTER_CTES[0][0], o.MASTER_CTES[0][1].replace(
    "FROM fx_employees",
    "FROM (SELECT * REPLACE (CASE WHEN id % 11 = 0 THEN 'Unknown' ELSE full_name END AS full_name) FROM fx_employees) fe"))] \
    + o.MASTER_CTES[1:]


@query("name_enrichment", o.with_ctes(["fx_messages", "fx_employees", "fx_aliases", "fx_authorized"],
    _UNNAMED_MASTER + o.ROUTE_CTES + o.match_ctes("req") + [
    ("cand", f"""SELECT employee_id, arg_min(name_raw, message_id) AS nm, min(message_id) AS first_message_id FROM matched
WHERE match_tier IN ('exact_phone', 'exact_id_phone', 'alias_phone') AND employee_id IS NOT NULL
  AND {o.valid_name('name_raw')} GROUP BY employee_id"""),
    ("upd", f"""SELECT e.id, e.full_name AS old_name, {o.strip('c.nm')} AS full_name, {o.norm_name('c.nm')} AS name_normalized,
  c.first_message_id FROM cand c JOIN emp e ON e.id = c.employee_id WHERE NOT {o.valid_name('e.full_name')}"""),
    ("win", """SELECT name_normalized, arg_min(id, first_message_id) AS winner FROM upd
WHERE name_normalized <> '' AND name_normalized NOT IN (SELECT alias_value FROM fx_aliases WHERE alias_type = 'name')
GROUP BY name_normalized""")],
    """SELECT u.id, u.old_name, u.full_name, u.name_normalized, u.first_message_id, coalesce(w.winner = u.id, false) AS alias_added
FROM upd u LEFT JOIN win w USING (name_normalized)""", parse=True, recursive=True))
def name_enrichment_q(spark, sf):
    from ledgerflow.operators.posting import match_requests, route
    emp = _employees_unnamed(fx.employees(spark, sf))
    routed = route(parse_results(fx.messages(spark, sf), keep=["is_from_me", "sender_phone", "raw_content"]),
                   fx.authorized_senders(spark, sf))
    als = fx.aliases(spark, sf)
    m = identity.match_exact(match_requests(routed), emp, als)
    return identity.enrich_names(m, emp, als).select("id", "old_name", "full_name", "name_normalized",
                                                     "first_message_id", "alias_added")


@query("employee_detail", o.with_ctes(["fx_payments", "fx_employees", "fx_aliases"], _REV + _CANON + [
    ("nal", """SELECT c.canonical_id, list_sort(list(DISTINCT a.alias_value)) AS names
FROM canon c JOIN fx_aliases a ON a.employee_id = c.id WHERE a.alias_type = 'name' GROUP BY c.canonical_id"""),
    ("roots", """SELECT e.*, list_concat([e.full_name], coalesce(nal.names, [])) AS cands FROM emp e
JOIN canon c ON c.id = e.id AND c.canonical_id = e.id LEFT JOIN nal ON nal.canonical_id = e.id"""),
    ("cand", "SELECT r.id, unnest(r.cands) AS nm, generate_subscripts(r.cands, 1) AS i FROM roots r"),
    ("best", f"""SELECT id, arg_max({o.strip('nm')}, struct_pack(w := len(string_split_regex({o.strip('nm')}, '\\s+')),
  l := length({o.strip('nm')}), ni := -i)) AS best FROM cand WHERE {o.display_name_ok('nm')} GROUP BY id"""),
    ("tot", """SELECT c.canonical_id, count(*) AS n, sum(amount) AS total, min(txn_date) AS first_d, max(txn_date) AS last_d
FROM pr JOIN canon c ON c.id = pr.employee_id WHERE NOT is_reversal GROUP BY c.canonical_id"""),
    ("mc", "SELECT canonical_id, count(*) AS member_count FROM canon GROUP BY canonical_id")],
    """SELECT r.id AS canonical_id, r.employee_code,
  coalesce(b.best, r.employee_id_phone, r.primary_phone, '(unnamed)') AS display_name,
  coalesce(r.primary_phone, r.employee_id_phone) AS mobile_number, mc.member_count,
  coalesce(t.n, 0) AS total_transactions, CAST(coalesce(t.total, 0) AS DOUBLE) AS total_paid,
  strftime(t.first_d, '%Y-%m-%d') AS first_payment_date, strftime(t.last_d, '%Y-%m-%d') AS last_payment_date
FROM roots r LEFT JOIN best b ON b.id = r.id LEFT JOIN tot t ON t.canonical_id = r.id LEFT JOIN mc ON mc.canonical_id = r.id""",
    recursive=True))
def employee_detail_q(spark, sf):
    d = reports.employee_details(fx.employees(spark, sf), fx.aliases(spark, sf), _payments_rev(spark, sf))
    return d.select("canonical_id", "employee_code", "display_name", "mobile_number", "member_count",
                    "total_transactions", _dbl("total_paid").alias("total_paid"),
                    _day("first_payment_date").alias("first_payment_date"),
                    _day("last_payment_date").alias("last_payment_date"))


def _payments_payout(p: DataFrame) -> DataFrame:
    """Payments with a payout phone: each was paid to the next customer's
    number (a relative's wallet), so a phone finds its owner and the
    employee paid through it."""
    return p.withColumn("payout_phone", F.concat(F.lit("01"), F.lpad((F.lit(700000000) + F.col("employee_id")).cast("string"), 9, "0")))


def _phone_queries(emp: DataFrame) -> DataFrame:
    """Phone searches: every employee's whole phone and its last six digits."""
    return emp.select(F.col("primary_phone").alias("query")).unionByName(
        emp.select(F.expr("right(primary_phone, 6)").alias("query")))


@query("suggest_phone", o.with_ctes(["fx_employees", "fx_aliases", "fx_payments"], _CANON + [
    ("qs", "SELECT primary_phone AS query FROM fx_employees UNION ALL SELECT right(primary_phone, 6) FROM fx_employees"),
    ("qd", f"""SELECT DISTINCT query, {o.strip('query')} AS raw, regexp_replace({o.strip('query')}, '\\P{{Nd}}', '', 'g') AS d FROM qs"""),
    ("qp", f"""SELECT query,
  CASE WHEN length(d) >= 4 AND length(d) >= length(raw) - 3 AND length(d) >= 6 THEN {o.norm_phone('raw')} END AS ph,
  CASE WHEN length(d) >= 4 THEN right(d, 10) END AS tail FROM qd"""),
    ("pay", "SELECT employee_id, concat('01', lpad(CAST(700000000 + employee_id AS VARCHAR), 9, '0')) AS payout_phone FROM fx_payments"),
    ("hits", """SELECT query, e.id, 1.00 AS score FROM qp JOIN emp e ON e.employee_id_phone = qp.ph
UNION ALL SELECT query, e.id, 0.95 FROM qp JOIN emp e ON e.primary_phone = qp.ph
UNION ALL SELECT query, a.employee_id, 0.93 FROM qp JOIN fx_aliases a ON a.alias_type = 'phone' AND a.alias_value = qp.ph
UNION ALL SELECT query, p.employee_id, 0.90 FROM qp JOIN pay p ON p.payout_phone = qp.ph WHERE p.employee_id IS NOT NULL
UNION ALL SELECT query, e.id, 0.78 FROM qp JOIN emp e ON qp.tail IS NOT NULL
  AND (contains(e.employee_id_phone, qp.tail) OR contains(e.primary_phone, qp.tail))""")],
    """SELECT query, c.canonical_id AS employee_id, CAST(max(score) AS DOUBLE) AS score
FROM hits JOIN canon c ON c.id = hits.id GROUP BY query, c.canonical_id""", recursive=True))
def suggest_phone_q(spark, sf):
    emp = fx.employees(spark, sf)
    s = identity.suggest_phone(_phone_queries(emp), emp, fx.aliases(spark, sf), _payments_payout(fx.payments(spark, sf)))
    return s.select("query", "employee_id", F.col("score").cast("double").alias("score"))


PROFILE_LEDGER_ROWS = 12


@query("profile_ledger", o.with_ctes(["fx_payments", "fx_employees"], _REV + _CANON + [
    ("l", """SELECT employee_id, accounting_period,
  CAST(sum(CASE WHEN txn_category <> 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_paid,
  CAST(sum(CASE WHEN txn_category = 'advance' THEN amount ELSE 0 END) AS DOUBLE) AS total_advance,
  CAST(-sum(amount) AS DOUBLE) AS closing_balance, count(*) AS txn_count
FROM pr WHERE employee_id IS NOT NULL GROUP BY ALL""")],
    f"""SELECT * FROM (SELECT c.canonical_id, l.employee_id, l.accounting_period, l.total_paid, l.total_advance,
  l.closing_balance, l.txn_count,
  row_number() OVER (PARTITION BY c.canonical_id ORDER BY l.accounting_period DESC, l.employee_id) AS rank
FROM l JOIN canon c ON c.id = l.employee_id) WHERE rank <= {PROFILE_LEDGER_ROWS}""", recursive=True))
def profile_ledger(spark, sf):
    """O4 (I17's ledger part): the newest 12 ledger rows over all members of
    each canonical employee, one row per (member, period), not merged. Ties
    on a period go to the lower member id."""
    emp = fx.employees(spark, sf)
    led = posting.ledger(_payments_rev(spark, sf)).join(identity.members(emp), F.col("employee_id") == F.col("member_id"))
    top = top_k_per_group(led, ["canonical_id"], [F.col("accounting_period").desc(), F.col("employee_id")],
                          PROFILE_LEDGER_ROWS, salt_of=F.col("employee_id"), rank_col="rank")
    return top.select("canonical_id", "employee_id", "accounting_period", _dbl("total_paid").alias("total_paid"),
                      _dbl("total_advance").alias("total_advance"), _dbl("closing_balance").alias("closing_balance"),
                      F.col("txn_count").cast("long").alias("txn_count"), F.col("rank").cast("long").alias("rank"))


def _payments_named(p: DataFrame) -> DataFrame:
    """Payments with the raw name typed in their message ('emp' and the
    customer's letter code, as in fx_messages)."""
    code = F.translate(F.lpad((F.col("employee_id") - 1).cast("string"), 6, "0"), "0123456789", "abcdefghij")
    return p.withColumn("employee_name_raw", F.concat(F.lit("emp "), code))


def _name_queries(emp: DataFrame) -> DataFrame:
    """Name searches: every employee's letter code and its segment word."""
    parts = F.split("full_name", " ")
    return emp.select(parts[1].alias("query")).unionByName(emp.select(parts[0].alias("query")))


@query("suggest_substring", o.with_ctes(["fx_employees", "fx_aliases", "fx_payments"], _CANON + [
    ("qs", "SELECT split_part(full_name, ' ', 2) AS query FROM fx_employees UNION ALL SELECT split_part(full_name, ' ', 1) FROM fx_employees"),
    ("qd", f"""SELECT DISTINCT query, {o.strip('query')} AS raw, length(regexp_replace({o.strip('query')}, '\\P{{Nd}}', '', 'g')) AS nd FROM qs"""),
    ("qf", """SELECT query, lower(raw) AS qlow, regexp_replace(lower(raw), '[^a-z0-9]+', '', 'g') AS qc FROM qd
WHERE raw <> '' AND NOT (nd >= 4 AND nd >= length(raw) - 3)"""),
    ("praw", """SELECT DISTINCT employee_id, regexp_replace(lower('emp ' || translate(lpad(CAST(employee_id - 1 AS VARCHAR), 6, '0'),
  '0123456789', 'abcdefghij')), '[^a-z0-9]+', '', 'g') AS c FROM fx_payments WHERE employee_id IS NOT NULL"""),
    ("hits", """SELECT query, e.id, 0.70 AS score FROM qf JOIN emp e ON contains(lower(coalesce(e.full_name, '')), qf.qlow)
UNION ALL SELECT query, e.id, 0.72 FROM qf JOIN emp e ON length(qf.qc) >= 3
  AND contains(regexp_replace(lower(coalesce(e.full_name, '')), '[^a-z0-9]+', '', 'g'), qf.qc)
UNION ALL SELECT query, a.employee_id, 0.71 FROM qf JOIN fx_aliases a ON a.alias_type = 'name' AND length(qf.qc) >= 3
  AND contains(regexp_replace(lower(coalesce(a.alias_value, '')), '[^a-z0-9]+', '', 'g'), qf.qc)
UNION ALL SELECT query, p.employee_id, 0.74 FROM qf JOIN praw p ON length(qf.qc) >= 3 AND contains(p.c, qf.qc)""")],
    """SELECT query, c.canonical_id AS employee_id, CAST(max(score) AS DOUBLE) AS score
FROM hits JOIN canon c ON c.id = hits.id GROUP BY query, c.canonical_id""", recursive=True))
def suggest_substring_q(spark, sf):
    emp = fx.employees(spark, sf)
    s = identity.suggest_substring(_name_queries(emp), emp, fx.aliases(spark, sf), _payments_named(fx.payments(spark, sf)))
    return s.select("query", "employee_id", F.col("score").cast("double").alias("score"))


_COLL = "regexp_replace(lower(coalesce({}, '')), '[^a-z0-9]+', '', 'g')"


@query("suggest_trigram", o.with_ctes(["fx_employees", "fx_aliases", "fx_payments"], _CANON + [
    ("qs", "SELECT split_part(full_name, ' ', 2) AS query FROM fx_employees UNION ALL SELECT split_part(full_name, ' ', 1) FROM fx_employees"),
    ("qd", f"""SELECT DISTINCT query, {o.strip('query')} AS raw, length(regexp_replace({o.strip('query')}, '\\P{{Nd}}', '', 'g')) AS nd FROM qs"""),
    ("qf", """SELECT query, lower(raw) AS qlow, regexp_replace(lower(raw), '[^a-z0-9]+', '', 'g') AS qc FROM qd
WHERE NOT (nd >= 4 AND nd >= length(raw) - 3)"""),
    ("qt", """SELECT query, 'L' AS ns, qlow AS t FROM qf WHERE length(qlow) >= 3 OR length(qc) >= 3
UNION ALL SELECT query, 'C', CASE WHEN qc <> '' THEN qc ELSE qlow END FROM qf WHERE length(qlow) >= 3 OR length(qc) >= 3"""),
    ("praw", """SELECT employee_id AS id, 'emp ' || translate(lpad(CAST(employee_id - 1 AS VARCHAR), 6, '0'), '0123456789', 'abcdefghij') AS r
FROM fx_payments WHERE employee_id IS NOT NULL"""),
    ("vals", f"""SELECT DISTINCT * FROM (
  SELECT 'name' AS tier, 'L' AS ns, lower(coalesce(full_name, '')) AS t, id FROM emp
  UNION ALL SELECT 'name', 'L', coalesce(name_normalized, ''), id FROM emp
  UNION ALL SELECT 'name', 'C', {_COLL.format('full_name')}, id FROM emp
  UNION ALL SELECT 'alias', 'L', lower(coalesce(alias_value, '')), employee_id FROM fx_aliases WHERE alias_type = 'name'
  UNION ALL SELECT 'alias', 'C', {_COLL.format('alias_value')}, employee_id FROM fx_aliases WHERE alias_type = 'name'
  UNION ALL SELECT 'raw', 'L', lower(r), id FROM praw
  UNION ALL SELECT 'raw', 'C', {_COLL.format('r')}, id FROM praw) x WHERE t <> ''"""),
    ("qg", f"SELECT query, ns, {o.trigrams('t')} AS g FROM qt"),
    ("vg", f"SELECT ns, t, {o.trigrams('t')} AS g FROM (SELECT DISTINCT ns, t FROM vals)"),
    ("sims", """SELECT qg.query, qg.ns, vg.t,
  len(list_intersect(qg.g, vg.g)) / (len(qg.g) + len(vg.g) - len(list_intersect(qg.g, vg.g))) AS s
FROM qg JOIN vg ON qg.ns = vg.ns WHERE len(qg.g) > 0 AND len(vg.g) > 0"""),
    ("hits", """SELECT s.query, v.tier, v.id, max(s.s) AS s FROM sims s JOIN vals v ON v.ns = s.ns AND v.t = s.t
WHERE s.s >= 0.3 GROUP BY ALL"""),
    ("scored", """SELECT query, id, CASE tier WHEN 'name' THEN least(0.85, 0.40 + 0.45 * s)
  WHEN 'alias' THEN least(0.83, 0.38 + 0.45 * s) ELSE CASE WHEN s >= 0.40 THEN least(0.78, 0.35 + 0.40 * s) END END AS score
FROM hits""")],
    """SELECT query, c.canonical_id AS employee_id, round(CAST(max(score) AS DOUBLE), 6) AS score
FROM scored JOIN canon c ON c.id = scored.id WHERE score IS NOT NULL GROUP BY query, c.canonical_id""", recursive=True))
def suggest_trigram_q(spark, sf):
    emp = fx.employees(spark, sf)
    s = identity.suggest_trigram(_name_queries(emp), emp, fx.aliases(spark, sf), _payments_named(fx.payments(spark, sf)))
    return s.select("query", "employee_id", F.round(F.col("score").cast("double"), 6).alias("score"))


# One workload for the whole suggest: letter codes, segment words, phones and
# their last six digits (the tier families' own workloads, together).
_QS_NAME = "SELECT split_part(full_name, ' ', 2) AS query FROM fx_employees UNION ALL SELECT split_part(full_name, ' ', 1) FROM fx_employees"
_QS_PHONE = "SELECT primary_phone AS query FROM fx_employees UNION ALL SELECT right(primary_phone, 6) FROM fx_employees"
_QS_EXACT = """SELECT DISTINCT query FROM (SELECT full_name AS query FROM fx_employees
  UNION ALL SELECT substr(full_name, 1, length(full_name) - 1) FROM fx_employees) x"""
_QS_ALL = f"{_QS_NAME} UNION ALL {_QS_PHONE}"


def _family(name: str, qs: str) -> str:
    sql = ORACLE[name]
    assert qs in sql, name
    return "(" + sql.replace(qs, _QS_ALL, 1) + ")"


_SUGGEST_SQL = o.with_ctes(["fx_employees", "fx_aliases", "fx_payments"], _CANON + [
    ("qall", _QS_ALL),
    ("qflag", f"""SELECT DISTINCT query, (nd >= 4 AND nd >= length(raw) - 3) AS pl FROM (SELECT query, {o.strip('query')} AS raw,
  length(regexp_replace({o.strip('query')}, '\\P{{Nd}}', '', 'g')) AS nd FROM qall)"""),
    ("ph", f"SELECT * FROM {_family('suggest_phone', _QS_PHONE)}"),
    ("nm", f"""SELECT * FROM {_family('suggest_exact_prefix', _QS_EXACT)} UNION ALL SELECT * FROM {_family('suggest_substring', _QS_NAME)}
UNION ALL SELECT * FROM {_family('suggest_trigram', _QS_NAME)}"""),
    ("hits", """SELECT query, employee_id, score FROM ph UNION ALL
SELECT n.query, n.employee_id, n.score FROM nm n JOIN qflag f USING (query) WHERE NOT f.pl OR n.query NOT IN (SELECT query FROM ph)"""),
    ("best", "SELECT query, employee_id, max(score) AS score FROM hits GROUP BY ALL"),
    ("nal", """SELECT c.canonical_id, list_sort(list(DISTINCT a.alias_value)) AS names FROM canon c JOIN fx_aliases a ON a.employee_id = c.id
WHERE a.alias_type = 'name' AND a.alias_value IS NOT NULL GROUP BY c.canonical_id"""),
    ("tot", """SELECT c.canonical_id, sum(p.amount) AS total_paid, max(p.txn_date) AS last_activity, count(*) AS n
FROM fx_payments p JOIN canon c ON c.id = p.employee_id GROUP BY c.canonical_id"""),
    ("cands", """SELECT e.id, list_concat([e.full_name], coalesce(nal.names, [])) AS cl FROM emp e LEFT JOIN nal ON nal.canonical_id = e.id
WHERE e.id IN (SELECT employee_id FROM best)"""),
    ("cu", "SELECT id, unnest(cl) AS nm, generate_subscripts(cl, 1) AS i FROM cands"),
    ("bn", f"""SELECT id, arg_max({o.strip('nm')}, struct_pack(w := len(string_split_regex({o.strip('nm')}, '\\s+')),
  l := length({o.strip('nm')}), ni := -i)) AS bname FROM cu WHERE {o.display_name_ok('nm')} GROUP BY id"""),
    ("ranked", """SELECT b.query, b.employee_id, coalesce(bn.bname, e.employee_id_phone, '#' || CAST(b.employee_id AS VARCHAR)) AS display_name,
  coalesce(e.employee_id_phone, e.primary_phone) AS mobile_number, e.status, round(CAST(b.score AS DOUBLE), 3) AS similarity,
  CAST(coalesce(t.total_paid, 0) AS DOUBLE) AS total_paid, coalesce(t.n, 0) AS total_transactions, t.last_activity, nal.names,
  row_number() OVER (PARTITION BY b.query ORDER BY round(CAST(b.score AS DOUBLE), 3) DESC, coalesce(t.total_paid, 0) DESC,
    t.last_activity ASC NULLS FIRST, b.employee_id) AS rank
FROM best b JOIN emp e ON e.id = b.employee_id LEFT JOIN bn ON bn.id = b.employee_id
LEFT JOIN tot t ON t.canonical_id = b.employee_id LEFT JOIN nal ON nal.canonical_id = b.employee_id"""),
    ("top", "SELECT *, regexp_replace(lower(" + o.strip("query") + "), '[^a-z0-9]+', '', 'g') AS qc FROM ranked WHERE rank <= 8"),
    ("praw", """SELECT DISTINCT c.canonical_id, 'emp ' || translate(lpad(CAST(p.employee_id - 1 AS VARCHAR), 6, '0'), '0123456789', 'abcdefghij') AS r
FROM fx_payments p JOIN canon c ON c.id = p.employee_id"""),
    ("ra", """SELECT t.query, t.employee_id, list(DISTINCT pr.r) AS raws FROM top t JOIN praw pr ON pr.canonical_id = t.employee_id
WHERE length(t.qc) >= 2 AND contains(regexp_replace(lower(pr.r), '[^a-z0-9]+', '', 'g'), t.qc) GROUP BY ALL"""),
    ("mg", """SELECT t.*, list_sort(list_distinct(list_concat(coalesce(t.names, []), coalesce(ra.raws, [])))) AS merged
FROM top t LEFT JOIN ra ON ra.query = t.query AND ra.employee_id = t.employee_id""")],
    """SELECT query, rank, employee_id, display_name, mobile_number, status,
  array_to_string(list_filter(merged, lambda x: x <> display_name)[1:6], '|') AS aliases, len(merged) AS alias_count,
  similarity, total_paid, total_transactions, strftime(last_activity, '%Y-%m-%d') AS last_activity FROM mg""", recursive=True)


@query("suggest", _SUGGEST_SQL)
def suggest_q(spark, sf):
    """I15 whole: phone path, then the name path for queries that are not
    phone-like or found nothing by phone; ranked and cut per query."""
    # what several families read is written once, and so are their hits: the plan of all together
    # would compute each of them many times, and hold more stages than a small driver can
    emp = stored(identity.prepare_master(fx.employees(spark, sf)), "master")
    canon = stored(identity.resolve_canonical(emp), "canon")  # one canonical map for every family
    als = fx.aliases(spark, sf)
    pay = _payments_named(_payments_payout(fx.payments(spark, sf))).withColumn("is_reversal", F.lit(False))
    qs = _name_queries(emp).unionByName(_phone_queries(emp))
    qs = stored(qs, "searches")
    phone = stored(identity.suggest_phone(qs, emp, als, pay, canonical=canon), "phone-hits")
    name = [stored(df, "name-hits") for df in (
        _exact_prefix_hits(qs, emp, als, canonical=canon),
        identity.suggest_substring(qs, emp, als, pay, canonical=canon, include_phone_like=True),
        identity.suggest_trigram(qs, emp, als, pay, canonical=canon, include_phone_like=True))]
    name = name[0].unionByName(name[1]).unionByName(name[2])
    flags = qs.select("query").distinct().withColumn("_pl", identity.phone_like("query"))
    path = (flags.where(~F.col("_pl")).select("query")
            .unionByName(flags.join(phone.select("query").distinct(), "query", "left_anti").select("query"))).distinct()
    hits = phone.unionByName(name.join(path, "query", "left_semi"))
    r = identity.suggest_rank(hits, qs, emp, als, pay, canonical=canon)
    return r.select("query", F.col("rank").cast("long").alias("rank"), "employee_id", "display_name", "mobile_number",
                    "status", F.array_join("aliases", "|").alias("aliases"), F.col("alias_count").cast("long").alias("alias_count"),
                    F.col("similarity").cast("double").alias("similarity"), _dbl("total_paid").alias("total_paid"),
                    F.col("total_transactions").cast("long").alias("total_transactions"),
                    _day("last_activity").alias("last_activity"))


@query("audit_list", o.with_ctes(["fx_employees"], [
    ("aft", """SELECT id, CASE WHEN id % 13 = 0 THEN upper(full_name) ELSE full_name END AS full_name,
  CASE WHEN id % 7 = 0 THEN 'inactive' ELSE status END AS status FROM fx_employees""")],
    """SELECT 'employee' AS entity_type, b.id AS entity_id, 'update' AS action, 'admin' AS actor,
  to_json(struct_pack(full_name := a.full_name, status := a.status)) AS after_state
FROM fx_employees b JOIN aft a ON a.id = b.id WHERE a.full_name <> b.full_name OR a.status <> b.status
ORDER BY entity_id DESC LIMIT 100"""))
def audit_list_q(spark, sf):
    """T20/W9 over the identity audit rows of an edit batch: updates by the
    admin, newest page."""
    from ledgerflow.operators.review import audit_list, audit_rows
    emp = fx.employees(spark, sf)
    a = audit_rows(emp, _employees_after(emp), "id", ["full_name", "status"], "identity", "employee",
                   actor="admin", reason="edit")
    return audit_list(a, action="update", actor="admin").select("entity_type", "entity_id", "action", "actor", "after_state")


@query("employee_search_page", o.with_ctes(["fx_employees"], [("s", "SELECT * FROM (" + ORACLE["employee_search"] + ")")],
    """SELECT * FROM (SELECT s.query, s.employee_id, s.match_type, s.priority,
  row_number() OVER (PARTITION BY s.query ORDER BY s.priority, lower(coalesce(e.full_name, '')), s.employee_id) AS rank
FROM s JOIN fx_employees e ON e.id = s.employee_id) WHERE rank <= 20"""))
def employee_search_page(spark, sf):
    emp = fx.employees(spark, sf)
    best = identity.search(_search_queries(spark, sf), emp, fx.aliases(spark, sf))
    return identity.search_page(best, emp).select("query", "employee_id", "match_type", "priority",
                                                   F.col("rank").cast("long").alias("rank"))


_WS_IN = o.WS[1:-1]


@query("name_forms", sql_with_parse(["fx_messages", "fx_employees", "fx_aliases"], [
    ("n", """SELECT DISTINCT name FROM (SELECT name_raw AS name FROM parsed WHERE message_type = 'payment' AND name_raw IS NOT NULL
  UNION ALL SELECT full_name FROM fx_employees WHERE full_name IS NOT NULL
  UNION ALL SELECT alias_value FROM fx_aliases WHERE alias_type = 'name' AND alias_value IS NOT NULL) x""")],
    f"""SELECT name, {o.norm_name('name')} AS name_normalized,
  coalesce({o.strip(f"regexp_replace(regexp_replace(lower(name), '[^a-z0-9{_WS_IN}]+', ' ', 'g'), '{o.WS}+', ' ', 'g')")}, '') AS search_text,
  coalesce(regexp_replace(lower(name), '[^a-z0-9]+', '', 'g'), '') AS collapsed,
  {o.valid_name('name')} AS valid, {o.display_name_ok('name')} AS display_ok FROM n"""))
def name_forms(spark, sf):
    """F2, F3, F4, F8, F9 (and NFKC, the one Arrow UDF) over every distinct
    name in the data: parsed payment names, employee names, name aliases."""
    p = _parsed(spark, sf).where((F.col("message_type") == "payment") & F.col("payment.name_raw").isNotNull()) \
        .select(F.col("payment.name_raw").alias("name"))
    e = fx.employees(spark, sf).where(F.col("full_name").isNotNull()).select(F.col("full_name").alias("name"))
    a = fx.aliases(spark, sf).where((F.col("alias_type") == "name") & F.col("alias_value").isNotNull()) \
        .select(F.col("alias_value").alias("name"))
    n = p.unionByName(e).unionByName(a).distinct()
    return n.select("name", tx.norm_name("name").alias("name_normalized"), tx.search_text("name").alias("search_text"),
                    tx.collapse_text("name").alias("collapsed"), F.coalesce(tx.valid_name("name"), F.lit(False)).alias("valid"),
                    F.coalesce(tx.display_name_ok("name"), F.lit(False)).alias("display_ok"))


# more queries, registered here so that all are in one table
from ledgerflow.plans import decisions, intake, people  # noqa: E402, F401
