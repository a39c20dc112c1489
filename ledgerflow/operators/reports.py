"""Read models: payment lists and summaries, employee totals, history,
state and method counts, reconciliation, review and identity dashboards.

All are aggregates or joins over the tables; counts that the source system
reads one by one are computed in one pass with ``count_if`` / ``sum(when)``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import period, preview

MAX_ATTEMPTS = 5
RECONCILE_TOLERANCE = 0.01
LOW_CONFIDENCE = 0.5


def with_reversals(payments: DataFrame) -> DataFrame:
    """The fixture payments with a negative reversal row for every
    ``was_reversed`` one (T2), as the payments table holds them."""
    base = payments.select(
        "id", "employee_id", "amount", "payout_method", "txn_date", "txn_category",
        "accounting_period", F.lit(False).alias("is_reversal"), F.lit(None).cast("long").alias("reversed_txn_id"),
        "was_reversed")
    mx = payments.agg(F.max("id")).scalar()
    rev = payments.where("was_reversed").select(
        (F.col("id") + mx).alias("id"), "employee_id", (-F.col("amount")).cast("decimal(12,2)").alias("amount"),
        "payout_method", "txn_date", "txn_category", "accounting_period",
        F.lit(True).alias("is_reversal"), F.col("id").cast("long").alias("reversed_txn_id"),
        F.lit(False).alias("was_reversed"))
    return base.unionByName(rev)


def filter_payments(p: DataFrame, employee_id=None, period_=None, method=None,
                    date_from=None, date_to=None) -> DataFrame:
    """Not a reversal, then the optional filters (exact employee id)."""
    cond = ~F.col("is_reversal")
    if employee_id is not None:
        cond = cond & (F.col("employee_id") == employee_id)
    if period_ is not None:
        cond = cond & (F.col("accounting_period") == period_)
    if method is not None:
        cond = cond & (F.col("payout_method") == method)
    if date_from is not None:
        cond = cond & (F.col("txn_date") >= F.lit(date_from).cast("date"))
    if date_to is not None:
        cond = cond & (F.col("txn_date") <= F.lit(date_to).cast("date"))
    return p.where(cond)


def payments_summary(p: DataFrame) -> DataFrame:
    """A1: count, total, first and last date."""
    return p.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"),
                 F.min("txn_date").alias("first_date"), F.max("txn_date").alias("last_date"))


def payments_by_method(p: DataFrame) -> DataFrame:
    """A3: count and total per method, reversals excluded, total desc nulls last."""
    return (p.where(~F.col("is_reversal")).groupBy("payout_method")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("total"))
            .orderBy(F.col("total").desc_nulls_last(), "payout_method"))


def state_counts(state: DataFrame) -> DataFrame:
    """A2."""
    return state.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def payments_page(p: DataFrame, employees: DataFrame, canonical: DataFrame,
                  page: int = 1, size: int = 20) -> DataFrame:
    """Newest payments first (date desc, id desc), one page, with
    the payee's canonical identity and display fallbacks (F23): name as parsed,
    of the canonical row, of the row itself; id phone, then phone, of the
    canonical row before the row itself, last the payout phone."""
    rows = p.orderBy(F.col("txn_date").desc(), F.col("id").desc()).offset((page - 1) * size).limit(size)
    e = employees.select(F.col("id").alias("_eid"), F.col("full_name").alias("_rec_name"),
                         F.col("employee_id_phone").alias("_rec_id_phone"), F.col("primary_phone").alias("_rec_phone"))
    c = canonical.select(F.col("id").alias("_cid"), F.col("canonical_id"))
    ce = employees.select(F.col("id").alias("_ceid"), F.col("full_name").alias("_can_name"),
                          F.col("employee_id_phone").alias("_can_id_phone"), F.col("primary_phone").alias("_can_phone"))
    j = (rows.join(e, rows.employee_id == e._eid, "left")
         .join(c, rows.employee_id == c._cid, "left")
         .join(ce, F.col("canonical_id") == ce._ceid, "left"))
    name = F.coalesce("employee_name_raw", "_can_name", "_rec_name", F.lit("(unknown)"))
    return j.select("id", "employee_id", F.coalesce("canonical_id", "employee_id").alias("canonical_employee_id"),
                    name.alias("display_name"),
                    F.coalesce("_can_id_phone", "_rec_id_phone", "_can_phone", "_rec_phone", "payout_phone")
                    .alias("display_id_phone"),
                    F.coalesce("_can_phone", "_rec_phone", "payout_phone").alias("display_phone"),
                    "amount", "payout_method", "txn_date")


def employee_totals(p: DataFrame, members: DataFrame) -> DataFrame:
    """A4 with Q4: per canonical employee over all its members: gross
    (reversal rows left out, as the source lists do) and net amounts, count
    and last date."""
    # by employee first, so that members meet one row each, not every payment
    live = ~F.col("is_reversal")
    own = p.groupBy("employee_id").agg(
        F.count_if(live).alias("_n"), F.sum(F.when(live, F.col("amount"))).alias("_gross"), F.sum("amount").alias("_net"),
        F.max(F.when(live, F.col("txn_date"))).alias("_last"))
    j = own.join(members, own.employee_id == members.member_id)
    return j.groupBy("canonical_id").agg(
        F.sum("_n").alias("txn_count"), F.sum("_gross").alias("gross_amount"), F.sum("_net").alias("net_amount"), F.max("_last").alias("last_date"))


def employee_history(p: DataFrame, members: DataFrame, date_from: str, date_to: str) -> DataFrame:
    """T14/A8 for every canonical employee: payments of all members in the
    date range (W10): count, total, first, last."""
    q = p.where(~F.col("is_reversal") & F.col("txn_date").between(F.lit(date_from).cast("date"),
                                                                    F.lit(date_to).cast("date")))
    own = q.groupBy("employee_id").agg(F.count(F.lit(1)).alias("_n"), F.sum("amount").alias("_sum"),
                                       F.min("txn_date").alias("_first"), F.max("txn_date").alias("_last"))
    j = own.join(members, own.employee_id == members.member_id)
    return j.groupBy("canonical_id").agg(
        F.sum("_n").alias("n"), F.sum("_sum").alias("total"), F.min("_first").alias("first_date"), F.max("_last").alias("last_date"))


def _with_message(parsed: DataFrame, messages: DataFrame) -> DataFrame:
    """Parsed rows with their message's source, sender flag and month; a parse that kept these columns needs no join."""
    keep = ["source", "is_from_me", "timestamp_wa"]
    if not set(keep) <= set(parsed.columns):
        m = messages.select(F.col("id").alias("_mid"), *keep)
        parsed = parsed.drop(*keep).join(m, F.col("message_id") == F.col("_mid"))
    return parsed.select("message_id", "message_type", "payment", "source", "is_from_me", period("timestamp_wa").alias("period"))


def reconciliation(parsed: DataFrame, messages: DataFrame, payments: DataFrame, review: DataFrame,
                   state: DataFrame, period_: str | None = None, source: str | None = None) -> DataFrame:
    """A10: parser-detected payments = posted payments + open review amounts,
    within 0.01; plus pending-review and dead-letter counts. One row.

    The three sums are independent aggregates; each is one row, so the final
    combination joins three single-row frames on a constant key.
    """
    m = messages.select(F.col("id").alias("_mid"), "source", "is_from_me",
                        period("timestamp_wa").alias("_mper"))
    msg_cond = F.lit(True)
    if period_ is not None:
        msg_cond = msg_cond & (F.col("_mper") == period_)
    if source is not None:
        msg_cond = msg_cond & (F.col("source") == source)
    pr = _with_message(parsed, messages).withColumnRenamed("period", "_mper")
    parser_sum = pr.where((F.col("message_type") == "payment") & F.col("payment.amount").isNotNull()
                          & F.col("is_from_me") & msg_cond) \
        .agg(F.coalesce(F.sum("payment.amount"), F.lit(0)).cast("decimal(22,2)").alias("parser_detected_sum"))
    pay = payments.where(~F.col("is_reversal"))
    if period_ is not None:
        pay = pay.where(F.col("accounting_period") == period_)
    ledger_sum = pay.agg(F.coalesce(F.sum("amount"), F.lit(0)).cast("decimal(22,2)").alias("ledger_sum"))
    rv = review.join(m, review.message_id == m._mid)
    unmatched = rv.where((F.col("review_status") == "pending") & F.col("detected_amount").isNotNull() & msg_cond) \
        .agg(F.coalesce(F.sum("detected_amount"), F.lit(0)).cast("decimal(22,2)").alias("unmatched_review_sum"))
    counts = review.agg(F.count_if(F.col("review_status") == "pending").alias("pending_review_count"))
    dlq = state.agg(F.count_if((F.col("status") == "failed") & (F.col("attempts") >= MAX_ATTEMPTS))
                    .alias("dlq_count"))
    one = F.lit(1)
    out = (parser_sum.withColumn("_k", one)
           .join(ledger_sum.withColumn("_k", one), "_k")
           .join(unmatched.withColumn("_k", one), "_k")
           .join(counts.withColumn("_k", one), "_k")
           .join(dlq.withColumn("_k", one), "_k").drop("_k"))
    accounted = (F.col("ledger_sum") + F.col("unmatched_review_sum")).cast("decimal(22,2)")
    delta = (F.col("parser_detected_sum") - accounted).cast("decimal(22,2)")
    return out.select("parser_detected_sum", "ledger_sum", "unmatched_review_sum",
                      accounted.alias("accounted_sum"), delta.alias("delta"),
                      (F.abs(delta) <= RECONCILE_TOLERANCE).alias("ok"),
                      "pending_review_count", "dlq_count")


def reconciliation_by_period_source(parsed: DataFrame, messages: DataFrame, payments: DataFrame,
                                    review: DataFrame) -> DataFrame:
    """A10 grouped: parser and open-review sums per (message month, source);
    the ledger side per accounting period (it has no source, Q10)."""
    m = messages.select(F.col("id").alias("_mid"), "source", "is_from_me",
                        period("timestamp_wa").alias("period"))
    pr = _with_message(parsed, messages).where(
        (F.col("message_type") == "payment") & F.col("payment.amount").isNotNull() & F.col("is_from_me"))
    ps = pr.groupBy("period", "source").agg(F.sum("payment.amount").alias("parser_detected_sum"))
    rv = review.join(m, review.message_id == m._mid).where(
        (F.col("review_status") == "pending") & F.col("detected_amount").isNotNull())
    us = rv.groupBy("period", "source").agg(F.sum("detected_amount").alias("unmatched_review_sum"))
    ls = (payments.where(~F.col("is_reversal")).groupBy(F.col("accounting_period").alias("period"))
          .agg(F.sum("amount").alias("ledger_sum")))
    j = ps.join(us, ["period", "source"], "full_outer").join(ls, "period", "left")
    z = F.lit(0).cast("decimal(22,2)")
    return j.select("period", "source",
                    F.coalesce("parser_detected_sum", z).cast("decimal(22,2)").alias("parser_detected_sum"),
                    F.coalesce("unmatched_review_sum", z).cast("decimal(22,2)").alias("unmatched_review_sum"),
                    F.coalesce("ledger_sum", z).cast("decimal(22,2)").alias("period_ledger_sum"))


def review_summary(review: DataFrame, state: DataFrame, today: Column | None = None) -> DataFrame:
    """Pending, low confidence pending, pending amount, rejected (dismissed
    or duplicate), promoted on ``today`` (default: the current date), dead
    letters; one pass per table."""
    today = today if today is not None else F.current_date()
    r = review.agg(
        F.count_if(F.col("review_status") == "pending").alias("pending"),
        F.count_if((F.col("review_status") == "pending") & (F.col("parser_confidence") < LOW_CONFIDENCE))
        .alias("low_confidence"),
        F.coalesce(F.sum(F.when(F.col("review_status") == "pending", F.col("detected_amount"))),
                   F.lit(0)).cast("decimal(22,2)").alias("pending_amount"),
        F.count_if(F.col("review_status").isin("dismissed", "duplicate")).alias("rejected"),
        F.count_if((F.col("review_status") == "promoted") & (F.to_date("reviewed_at") == today)).alias("promoted_today"))
    s = state.agg(F.count_if((F.col("status") == "failed") & (F.col("attempts") >= MAX_ATTEMPTS))
                  .alias("dead_letters"))
    return r.withColumn("_k", F.lit(1)).join(s.withColumn("_k", F.lit(1)), "_k").drop("_k")


def needs_review(review: DataFrame, messages: DataFrame, page: int = 1, size: int = 50,
                 status: str = "pending", reason: str | None = None) -> DataFrame:
    """Review items by status (and reason) with their message, newest
    first, one page."""
    r = review.where(F.col("review_status") == status)
    if reason is not None:
        r = r.where(F.col("reason") == reason)
    r = r.orderBy(F.col("id").desc()).offset((page - 1) * size).limit(size)
    m = messages.select(F.col("id").alias("_mid"), "source", "chat_jid", "raw_content")
    return r.join(m, r.message_id == m._mid).select(
        "id", "message_id", "reason", "detected_amount", "parser_confidence", "source", "chat_jid",
        preview("raw_content").alias("preview"))


def dead_letters(state: DataFrame, messages: DataFrame, include_below_limit: bool = False) -> DataFrame:
    """Failed messages at the retry limit with a preview. With
    ``include_below_limit`` (Q7 fix) failed ones below the limit too."""
    cond = F.col("status") == "failed"
    if not include_below_limit:
        cond = cond & (F.col("attempts") >= MAX_ATTEMPTS)
    s = state.where(cond)
    m = messages.select(F.col("id").alias("_mid"), "source", "raw_content")
    return s.join(m, s.message_id == m._mid).select(
        "message_id", "attempts", "source", preview("raw_content").alias("preview"))


def identity_summary(employees: DataFrame, aliases: DataFrame, links: DataFrame, reviews: DataFrame,
                     audit: DataFrame) -> DataFrame:
    """The ten identity counts as (metric, value) rows; one aggregate per
    table, each unpivoted, so no join is needed."""
    resolution = F.col("resolution_status")
    n = F.count(F.lit(1))
    parts = [
        employees.agg(n.alias("employees_total"),
                      F.count_if(resolution == "canonical").alias("employees_canonical"),
                      F.count_if(resolution == "duplicate").alias("employees_duplicate"),
                      F.count_if(resolution == "unresolved").alias("employees_unresolved"),
                      F.count_if(F.col("status") == "inactive").alias("employees_inactive")),
        aliases.agg(n.alias("aliases_total")),
        links.agg(n.alias("resolution_links")),
        reviews.agg(F.count_if(F.col("review_status") == "pending").alias("review_pending"),
                    F.count_if(F.col("review_status") != "pending").alias("review_resolved")),
        audit.agg(n.alias("audit_entries")),
    ]
    return unpivot_counts(parts)


def health(messages: DataFrame, state: DataFrame, payments: DataFrame, employees: DataFrame,
           review: DataFrame) -> DataFrame:
    """Table counts as (metric, value) rows; reversals are not payments."""
    n = F.count(F.lit(1))
    status = F.col("status")
    return unpivot_counts([
        messages.agg(n.alias("messages")),
        state.agg(*[F.count_if(status == s).alias(s) for s in ("pending", "parsed", "failed")]),
        payments.agg(F.count_if(~F.col("is_reversal")).alias("payments")),
        employees.agg(n.alias("employees")),
        review.agg(F.count_if(F.col("review_status") == "pending").alias("pending_review"))])


def unpivot_counts(parts: list[DataFrame]) -> DataFrame:
    """One-row frames of counts as (metric, value) rows."""
    out = None
    for p in parts:
        rows = p.unpivot([], p.columns, "metric", "value")
        out = rows if out is None else out.unionByName(rows)
    return out


def pending_reviews(reviews: DataFrame, employees: DataFrame) -> DataFrame:
    """Pending identity reviews, oldest first, with both sides'
    names and phones."""
    c = employees.select(F.col("id").alias("_c"), F.col("full_name").alias("candidate_name"),
                         F.col("primary_phone").alias("candidate_phone"))
    s = employees.select(F.col("id").alias("_s"), F.col("full_name").alias("suspected_name"),
                         F.col("primary_phone").alias("suspected_phone"))
    r = reviews.where(F.col("review_status") == "pending")
    return (r.join(c, r.candidate_employee_id == c._c, "left")
            .join(s, r.suspected_match_id == s._s, "left")
            .select("id", "candidate_employee_id", "suspected_match_id", "match_reason", "confidence_score",
                    "candidate_name", "candidate_phone", "suspected_name", "suspected_phone")
            .orderBy("id"))


def parse_queue(state: DataFrame, messages: DataFrame) -> DataFrame:
    """Messages waiting for the parser (pending, below the retry
    limit) with their text. The whole queue, not one poll's worth: a batch
    run takes every waiting message."""
    s = state.where((F.col("status") == "pending") & (F.col("attempts") < MAX_ATTEMPTS))
    m = messages.select(F.col("id").alias("_mid"), "source", "chat_jid", "sender_phone", "is_from_me",
                        "timestamp_wa", "raw_content")
    return s.join(m, s.message_id == m._mid).drop("_mid")


POSTABLE_TYPES = ["payment", "cash_command", "income_command"]


def posting_queue(state: DataFrame, parsed: DataFrame, messages: DataFrame) -> DataFrame:
    """Parsed payments and commands below the retry limit, with their
    parse result and text. ``parsed`` holds one result per message (the
    latest, Q8), so the joins do not multiply."""
    s = state.where((F.col("status") == "parsed") & (F.col("attempts") < MAX_ATTEMPTS))
    p = parsed.where(F.col("message_type").isin(POSTABLE_TYPES)).select(
        F.col("message_id").alias("_pid"), "message_type", "payment", "confidence")
    m = messages.select(F.col("id").alias("_mid"), "source", "chat_jid", "sender_phone", "is_from_me", "raw_content")
    return (s.join(p, s.message_id == p._pid).join(m, s.message_id == m._mid).drop("_pid", "_mid"))


def queue_gauges(review_items: DataFrame, state: DataFrame) -> DataFrame:
    """Review-queue and dead-letter depth as (metric, value) rows."""
    r = review_items.agg(F.count_if(F.col("review_status") == "pending").alias("value"))
    d = state.agg(F.count_if((F.col("status") == "failed") & (F.col("attempts") >= MAX_ATTEMPTS)).alias("value"))
    return (r.select(F.lit("pending_review").alias("metric"), "value")
            .unionByName(d.select(F.lit("dead_letters").alias("metric"), "value")))


def employee_details(employees: DataFrame, aliases: DataFrame, payments: DataFrame,
                     canonical: DataFrame | None = None) -> DataFrame:
    """I17 for every canonical employee: display name (F10 over the full name
    and the members' name aliases in value order, then id phone, primary
    phone, ``(unnamed)``), mobile number, member count and the payment
    totals over all members (A6: count, sum, first and last date; reversal
    rows left out, Q4).

    The name list is collected per canonical employee: it is the feature's
    input and grows with one employee's aliases, not with the data.
    """
    from ledgerflow.functions.text import best_name
    from ledgerflow.operators.identity import prepare_master, resolve_canonical
    master = prepare_master(employees)
    canon = canonical if canonical is not None else resolve_canonical(master)
    mem = canon.select(F.col("id").alias("member_id"), "canonical_id")
    names = (aliases.where(F.col("alias_type") == "name")
             .join(mem, F.col("employee_id") == F.col("member_id"))
             .groupBy("canonical_id").agg(F.array_sort(F.collect_set("alias_value")).alias("_names")))
    pay = payments.where(~F.col("is_reversal"))
    tot = (pay.join(mem, pay.employee_id == mem.member_id).groupBy("canonical_id")
           .agg(F.count(F.lit(1)).alias("total_transactions"), F.sum("amount").alias("total_paid"),
                F.min("txn_date").alias("first_payment_date"), F.max("txn_date").alias("last_payment_date")))
    size = mem.groupBy("canonical_id").agg(F.count(F.lit(1)).alias("member_count"))
    roots = master.join(canon.where(F.col("id") == F.col("canonical_id")).select("id"), "id")
    out = (roots.join(names, roots.id == names.canonical_id, "left").drop("canonical_id")
           .join(size, roots.id == size.canonical_id, "left").drop("canonical_id")
           .join(tot, roots.id == tot.canonical_id, "left").drop("canonical_id"))
    return out.select(
        F.col("id").alias("canonical_id"), "employee_code",
        F.coalesce(best_name("full_name", "_names"), "employee_id_phone", "primary_phone",
                   F.lit("(unnamed)")).alias("display_name"),
        F.coalesce("primary_phone", "employee_id_phone").alias("mobile_number"),
        "member_count", F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"),
        F.coalesce("total_paid", F.lit(0)).alias("total_paid"), "first_payment_date", "last_payment_date")
