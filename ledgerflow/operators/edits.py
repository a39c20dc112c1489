"""Aliases, links, deactivation, review decisions and edits, as batches in request order.


Every operator takes a table of requests with unique, ordered request ids and returns the new
state, what it refused with the reason, and one audit row for each change (S14).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators import identity
from ledgerflow.operators.ids import dense_ids
from ledgerflow.sources.scratch import stored

ALIAS_TYPES = ["phone", "name", "employee_id"]
SNAPSHOT = ["id", "full_name", "primary_phone", "employee_id_phone", "status", "canonical_employee_id", "resolution_status"]
_KEEP_NULLS = {"ignoreNullFields": "false"}


@dataclass
class Edited:
    """The new table, the rows added beside it (links, aliases), what was refused, and the audit rows."""

    table: DataFrame
    added: DataFrame
    rejected: DataFrame
    audit: DataFrame


def audit_row(action: str, entity: str, entity_id: Column, before: Column, after: Column, actor: Column, reason: Column) -> list[Column]:
    """The columns of one audit row; states are JSON or null."""
    return [F.lit(action).alias("action"), F.lit(entity).alias("entity_type"), entity_id.cast("long").alias("entity_id"),
            before.alias("before_state"), after.alias("after_state"), actor.alias("actor"), reason.cast("string").alias("reason")]


def _state(df: DataFrame, **new) -> Column:
    """A row's snapshot as JSON, with some fields replaced."""
    return F.to_json(F.struct(*[(new[c] if c in new else F.col(c)).alias(c) for c in SNAPSHOT if c in df.columns or c in new]), _KEEP_NULLS)


def accepted_links(requests: DataFrame) -> DataFrame:
    """``requests`` with ``linked``: whether each link is accepted when they are applied one by one.

    A request is refused if its target has been linked away, that is, if an earlier accepted
    request has the target as its duplicate. So a request is accepted if no earlier one on its target
    is. Rounds settle what is sure; where exactly one open request stands before another, the one is
    accepted if the other is not, and such chains are followed by pointer doubling, so a chain
    of n requests takes log2(n) steps, not n. A step joins aggregates with one row an employee.
    """
    st = stored(requests.withColumn("linked", F.lit(None).cast("boolean")), "links")
    rid = F.col("request_id")
    while not st.where(F.col("linked").isNull()).limit(1).isEmpty():
        open_ = st.where(F.col("linked").isNull()).select("duplicate_id", "request_id")
        first = open_.groupBy("duplicate_id").agg(F.min("request_id").alias("u1"))
        second = open_.join(first, "duplicate_id").where(rid > F.col("u1")).groupBy("duplicate_id").agg(F.min("request_id").alias("u2"))
        done = st.where("linked").groupBy("duplicate_id").agg(F.min("request_id").alias("done"))
        per = first.join(second, "duplicate_id", "left").join(done, "duplicate_id", "full").withColumnRenamed("duplicate_id", "_t")
        look = st.join(per, st.canonical_id == per._t, "left")
        refused = F.coalesce(F.col("done") < rid, F.lit(False))
        free = F.coalesce(F.col("u1") >= rid, F.lit(True))
        one = F.coalesce(F.col("u2") >= rid, F.lit(True))
        look = stored(look.select(*requests.columns, F.when(F.col("linked").isNotNull(), F.col("linked")).when(refused, F.lit(False)).when(free, F.lit(True)).alias("linked"),
                                  F.when(F.col("linked").isNull() & ~refused & ~free & one, F.col("u1")).alias("ptr"), F.lit(True).alias("flip")), "links")
        chain = look.where(F.col("ptr").isNotNull()).select("request_id", "ptr", "flip")
        moved = not chain.isEmpty()
        while moved:
            nxt = chain.select(F.col("request_id").alias("_p"), F.col("ptr").alias("_pp"), F.col("flip").alias("_pf"))
            step = chain.join(nxt, chain.ptr == nxt._p, "left")
            chain = stored(step.select("request_id", F.coalesce("_pp", "ptr").alias("ptr"),
                                       F.when(F.col("_pp").isNotNull(), F.col("flip") != F.col("_pf")).otherwise(F.col("flip")).alias("flip"),
                                       F.col("_pp").isNotNull().alias("_moved")), "chains")
            moved = not chain.where("_moved").limit(1).isEmpty()
            chain = chain.drop("_moved")
        ends = look.where(F.col("linked").isNotNull()).select(F.col("request_id").alias("_e"), F.col("linked").alias("_l"))
        told = chain.join(ends, chain.ptr == ends._e).select(F.col("request_id").alias("_q"), (F.col("_l") != F.col("flip")).alias("_told"))
        st = stored(look.join(told, rid == F.col("_q"), "left").select(*requests.columns, F.coalesce("linked", "_told").alias("linked")), "links")
    return st


def link_duplicates(employees: DataFrame, decisions: DataFrame) -> Edited:
    """I8 for ``decisions(request_id, duplicate_id, canonical_id, score, actor, reason)`` in the order of
    their ids. Refused: a link of a row to itself, a missing row, a target that is itself a
    duplicate, in the master or through an earlier request. A row that has a link may be linked
    anew: every pair is one link row, the last accepted target is the row's link. Payments stay.
    """
    if "reason" not in decisions.columns:
        decisions = decisions.withColumn("reason", F.lit(None).cast("string"))
    e = employees.select("id", "canonical_employee_id")
    dup, tgt = e.select(F.col("id").alias("_d")), e.select(F.col("id").alias("_t"), F.col("canonical_employee_id").alias("_t_link"))
    j = decisions.join(dup, decisions.duplicate_id == dup._d, "left").join(tgt, decisions.canonical_id == tgt._t, "left")
    bad = (F.when(F.col("_d").isNull(), "duplicate_missing").when(F.col("duplicate_id") == F.col("canonical_id"), "self_link")
           .when(F.col("_t").isNull(), "canonical_missing").when(F.col("_t_link").isNotNull(), "target_is_duplicate"))
    j = j.withColumn("reject_reason", bad).drop("_d", "_t", "_t_link")
    settled = accepted_links(j.where(F.col("reject_reason").isNull()).drop("reject_reason"))
    cols = ["request_id", "duplicate_id", "canonical_id", "reject_reason"]
    rejected = j.where(F.col("reject_reason").isNotNull()).select(*cols).unionByName(
        settled.where(~F.col("linked")).withColumn("reject_reason", F.lit("target_is_duplicate")).select(*cols))
    ok = settled.where("linked").withColumn("actor", F.coalesce("actor", F.lit("admin")))
    links = ok.groupBy("duplicate_id", "canonical_id").agg(F.min_by(F.struct("request_id", "score", "actor", "reason"), "request_id").alias("f")).select(
        F.col("duplicate_id").alias("employee_id"), F.col("canonical_id").alias("canonical_employee_id"), F.lit("manual_merge").alias("resolution_type"),
        F.col("f.score").cast("decimal(4,3)").alias("confidence_score"), F.col("f.reason").alias("reason"), F.col("f.actor").alias("created_by"),
        F.col("f.request_id").alias("request_id"))
    last = ok.groupBy(F.col("duplicate_id").alias("_u")).agg(F.max_by(F.struct("canonical_id", "score"), "request_id").alias("_new"))
    targets = ok.select(F.col("canonical_id").alias("_c")).distinct()
    status = F.col("resolution_status") if "resolution_status" in employees.columns else F.lit("unresolved")
    score = F.col("confidence_score") if "confidence_score" in employees.columns else F.lit(None).cast("decimal(4,3)")
    rest = [c for c in employees.columns if c not in ("canonical_employee_id", "resolution_status", "confidence_score")]
    new = (employees.join(last, employees.id == last._u, "left").join(targets, employees.id == targets._c, "left").select(
        *rest, F.coalesce("_new.canonical_id", "canonical_employee_id").alias("canonical_employee_id"),
        F.when(F.col("_u").isNotNull(), "duplicate").when(F.col("_c").isNotNull(), "canonical").otherwise(status).alias("resolution_status"),
        F.coalesce(F.col("_new.score").cast("decimal(4,3)"), score).alias("confidence_score")))
    # one audit row an accepted request: before it the row had the link of the request before, or the master's
    before = ok.join(employees.select(F.col("id").alias("_i"), *[F.col(c).alias(f"_{c}") for c in SNAPSHOT if c in employees.columns and c != "id"]), F.col("duplicate_id") == F.col("_i"))
    own = ok.select("duplicate_id", F.col("request_id").alias("_r"), F.col("canonical_id").alias("_l"))
    prior = before.join(own, "duplicate_id").where(F.col("_r") < F.col("request_id")).groupBy("request_id").agg(F.max_by("_l", "_r").alias("_prior"))
    before = before.join(prior, "request_id", "left")
    old_link = F.coalesce("_prior", "_canonical_employee_id")
    old_state = F.when(F.col("_prior").isNotNull(), "duplicate").otherwise(F.col("_resolution_status") if "resolution_status" in employees.columns else F.lit("unresolved"))
    fields = lambda link, state: F.to_json(F.struct(F.col("duplicate_id").alias("id"), *[F.col(f"_{c}").alias(c) for c in SNAPSHOT if c in employees.columns
                                                    and c not in ("id", "canonical_employee_id", "resolution_status")],
                                                    link.alias("canonical_employee_id"), state.alias("resolution_status")), _KEEP_NULLS)
    audit = before.select("request_id", *audit_row("link_duplicate", "employee", F.col("duplicate_id"), fields(old_link, old_state),
                                                   fields(F.col("canonical_id"), F.lit("duplicate")), F.col("actor"), F.col("reason")))
    return Edited(new, links, rejected, audit)


def mark_inactive(employees: DataFrame, requests: DataFrame) -> Edited:
    """I9 for ``requests(request_id, employee_id, actor, reason)``: status and state become inactive; every
    request on a row that is there is audited, the second one with the first one's result before it."""
    there = requests.join(employees.withColumn("_f", F.lit(True)), requests.employee_id == employees.id, "left")
    rejected = there.where(F.col("_f").isNull()).select("request_id", "employee_id", F.lit("not_found").alias("reject_reason"))
    first = requests.groupBy("employee_id").agg(F.min("request_id").alias("_first"))
    hits = there.where("_f").join(first, "employee_id")
    off = F.lit("inactive")
    after = _state(employees, status=off, resolution_status=off)
    plain = _state(employees) if "resolution_status" in employees.columns else _state(employees, resolution_status=F.lit("unresolved"))
    audit = hits.select("request_id", *audit_row("mark_inactive", "employee", F.col("employee_id"), F.when(F.col("request_id") == F.col("_first"), plain).otherwise(after),
                                                 after, F.coalesce("actor", F.lit("admin")), F.col("reason")))
    marked = first.select(F.col("employee_id").alias("_m"))
    hit = F.col("_m").isNotNull()
    old = F.col("resolution_status") if "resolution_status" in employees.columns else F.lit("unresolved")
    new = employees.join(marked, employees.id == marked._m, "left").withColumns(
        {"status": F.when(hit, off).otherwise(F.col("status")), "resolution_status": F.when(hit, off).otherwise(old)}).drop("_m")
    return Edited(new, requests.limit(0), rejected, audit)


def add_aliases(aliases: DataFrame, requests: DataFrame) -> Edited:
    """I7 for ``requests(request_id, employee_id, alias_type, alias_value, actor)``: a value belongs to
    the first writer; taken values are ignored, an unknown type or an empty value is refused."""
    bad = F.when(~F.coalesce(F.col("alias_type").isin(ALIAS_TYPES), F.lit(False)), "invalid_alias_type") \
           .when(F.coalesce("alias_value", F.lit("")) == "", "empty_value")
    r = requests.withColumn("_bad", bad)
    key = ["alias_type", "alias_value"]
    won = (r.where(F.col("_bad").isNull()).groupBy(*key).agg(F.min_by(F.struct("request_id", "employee_id", "actor"), "request_id").alias("f"))
           .join(aliases.select(*key).distinct(), key, "left_anti").select("f.request_id", "f.employee_id", *key, F.coalesce("f.actor", F.lit("system")).alias("actor")))
    won = stored(won, "aliases")
    taken = r.where(F.col("_bad").isNull()).join(won.select("request_id"), "request_id", "left_anti").withColumn("_bad", F.lit("taken"))
    rejected = r.where(F.col("_bad").isNotNull()).unionByName(taken).select("request_id", "employee_id", *key, F.col("_bad").alias("reject_reason"))
    added = won.select("employee_id", *key)
    audit = won.select("request_id", *audit_row("add_alias", "employee", F.col("employee_id"), F.lit(None).cast("string"), F.to_json(F.struct(*key)), F.col("actor"), F.lit(None)))
    return Edited(aliases.select("employee_id", *key).unionByName(added), added, rejected, audit)


@dataclass
class Resolved:
    """Reviews after the decisions, the merges' links, refused decisions, audit rows."""

    reviews: DataFrame
    links: Edited
    rejected: DataFrame
    audit: DataFrame


def resolve_reviews(reviews: DataFrame, decisions: DataFrame, employees: DataFrame) -> Resolved:
    """I11 for ``decisions(request_id, review_id, decision, reviewer, note)`` in request order.

    ``rejected`` and ``kept_separate`` close a pending review. ``approved_merge`` links the candidate to
    the suspected row with the stored score and closes the review if the link is accepted; if not,
    the review stays pending, for later decisions too. A merge that was refused once is refused
    again (its target stays a duplicate), so only the first merge decision of a review counts.
    """
    names = ["approved_merge", "rejected", "kept_separate"]
    d = decisions.select("request_id", "review_id", "decision", "reviewer", "note")
    known = reviews.select(F.col("id").alias("review_id"), F.col("review_status").alias("_st"), F.col("candidate_employee_id").alias("_c"),
                           F.col("suspected_match_id").alias("_s"), F.col("confidence_score").alias("_score"))
    j = d.join(known, "review_id", "left")
    merge = F.col("decision") == "approved_merge"
    bad = (F.when(~F.coalesce(F.col("decision").isin(names), F.lit(False)), "invalid_decision").when(F.col("_st").isNull(), "not_found")
           .when(F.col("_st") != "pending", "not_pending").when(merge & (F.col("_c").isNull() | F.col("_s").isNull()), "missing_employee"))
    j = stored(j.withColumn("reject_reason", bad), "decisions")
    fine = j.where(F.col("reject_reason").isNull())
    per = fine.groupBy("review_id").agg(F.min(F.when(~merge, F.col("request_id"))).alias("_close"), F.min(F.when(merge, F.col("request_id"))).alias("_merge"))
    fine = fine.join(per, "review_id")
    tried = fine.where(merge & (F.col("request_id") == F.col("_merge")) & (F.coalesce(F.col("_close") > F.col("_merge"), F.lit(True))))
    links = link_duplicates(employees, tried.select("request_id", F.col("_c").alias("duplicate_id"), F.col("_s").alias("canonical_id"), F.col("_score").alias("score"),
                                                    F.col("reviewer").alias("actor"), F.coalesce("note", F.concat(F.lit("approved_merge via review "), "review_id")).alias("reason")))
    refused = stored(links.rejected.select("request_id", F.col("reject_reason").alias("_no")), "refused")
    merged = tried.select("review_id", "request_id").join(refused, "request_id", "left_anti").select("review_id", F.col("request_id").alias("_done"))
    fine = fine.join(merged, "review_id", "left").withColumn("_end", F.coalesce("_done", "_close"))
    closing = stored(fine.where(F.col("request_id") == F.col("_end")), "closing")
    late = fine.where(F.coalesce(F.col("request_id") != F.col("_end"), F.lit(True))).join(refused, "request_id", "left").select(
        "request_id", "review_id", F.coalesce("_no", F.when(F.coalesce(F.col("request_id") > F.col("_end"), F.lit(False)), "not_pending"), F.lit("target_is_duplicate")).alias("reject_reason"))
    rejected = j.where(F.col("reject_reason").isNotNull()).select("request_id", "review_id", "reject_reason").unionByName(late)
    c = closing.select(F.col("review_id").alias("_r"), "decision", F.col("reviewer").alias("_rv"), F.col("note").alias("_nt"), F.col("request_id").alias("_q"))
    kept = [x for x in reviews.columns if x not in ("review_status", "reviewer", "review_note")]
    new = reviews.join(c, reviews.id == c._r, "left").select(
        *kept, F.coalesce("decision", "review_status").alias("review_status"), F.col("_rv").alias("reviewer"), F.col("_nt").alias("review_note"), F.col("_q").alias("closed_by"))
    audit = closing.select("request_id", *audit_row("resolve_review", "review_queue", F.col("review_id"), F.lit('{"review_status":"pending"}'),
                                                    F.to_json(F.struct(F.col("decision").alias("review_status"), "note"), _KEEP_NULLS), F.col("reviewer"), F.col("decision")))
    return Resolved(new, links, rejected, audit.unionByName(links.audit))


def numbered_audit(existing: DataFrame | None, rows: list[DataFrame]) -> DataFrame:
    """Audit rows of several operators with ids in request order, after those there."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    start = 0 if existing is None else existing.agg(F.coalesce(F.max("id"), F.lit(0))).scalar()
    return dense_ids(out, ["request_id", "action", "entity_id"], start=start)


@dataclass
class EmployeeEdits:
    """Employees after the edits, aliases added, and each edit's outcome: ``status``, ``merged_into``, ``final_id``."""

    employees: DataFrame
    aliases: DataFrame
    outcomes: DataFrame


def _settle_id_phones(edits: DataFrame, employees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Edits that give an id phone, one after the other: a phone that another active row holds makes a
    soft merge into that row's canonical row, any other becomes the row's.

    ``edits(request_id, employee_id, x)``; returns each edit with ``held`` (the row's phone before it) and
    ``merged_into``, and (id, id phone, link) of all rows after them. An edit touches its row, the
    phone it gives and the one the row has, and the canonical families of the row and of the phone's
    holder; a round settles every edit that shares none of these with an earlier open one. What an
    open edit may come to touch, it touches by way of an earlier one that shares it now. So the rounds
    are as many as the longest chain of edits that touch the same.
    """
    st = stored(employees.select("id", F.col("employee_id_phone").alias("idp"), (F.col("status") == "active").alias("active"),
                                 F.col("canonical_employee_id").alias("link")), "id-phones")
    open_, done = stored(edits, "edits"), None
    while not open_.limit(1).isEmpty():
        family = stored(identity.resolve_canonical(st.withColumnRenamed("link", "canonical_employee_id")).select(F.col("id").alias("_i"), F.col("canonical_id").alias("_c")), "families")
        held = st.select(F.col("id").alias("_e"), F.col("idp").alias("held")).join(family, F.col("_e") == F.col("_i")).select("_e", "held", F.col("_c").alias("own"))
        o = open_.join(held, F.col("employee_id") == F.col("_e")).drop("_e")
        keepers = st.where("active").select(F.col("id").alias("_h"), F.col("idp").alias("x")).join(o.select("x").distinct(), "x")
        keeper = (o.join(keepers, "x").where(F.col("_h") != F.col("employee_id")).groupBy("request_id").agg(F.min("_h").alias("holder"))
                  .join(family, F.col("holder") == F.col("_i")).select("request_id", F.col("_c").alias("target")))
        o = stored(o.join(keeper, "request_id", "left"), "looked-up")
        key = lambda kind, c: F.concat(F.lit(kind), F.col(c).cast("string"))
        bears = o.select("request_id", F.explode(F.array_distinct(F.array_compact(F.array(
            key("E", "employee_id"), key("X", "x"), key("X", "held"), key("F", "own"), key("F", "target"))))).alias("key"))
        first = bears.groupBy("key").agg(F.min("request_id").alias("_first"))
        waits = bears.join(first, "key").where(F.col("_first") < F.col("request_id")).select("request_id").distinct()
        ready = o.join(waits, "request_id", "left_anti")
        merge = F.col("target").isNotNull() & (F.col("target") != F.col("employee_id")) & ~F.col("x").eqNullSafe(F.col("held"))
        now = stored(ready.select("request_id", "employee_id", "x", "held", F.when(merge, F.col("target")).alias("merged_into")), "settled")
        change = now.select(F.col("employee_id").alias("_e"), F.col("x").alias("_x"), F.col("merged_into").alias("_m"))
        st = stored(st.join(change, st.id == change._e, "left").select(
            "id", F.when(F.col("_e").isNotNull() & F.col("_m").isNull(), F.col("_x")).otherwise(F.col("idp")).alias("idp"), "active", F.coalesce("_m", "link").alias("link")), "id-phones")
        done = now if done is None else done.unionByName(now)
        open_ = stored(open_.join(now.select("request_id"), "request_id", "left_anti"), "edits")
    if done is None:
        done = edits.select("request_id", "employee_id", "x", F.lit(None).cast("string").alias("held"), F.lit(None).cast("long").alias("merged_into"))
    return done, st


def edit_employees(employees: DataFrame, aliases: DataFrame, edits: DataFrame) -> EmployeeEdits:
    """I13 for ``edits(request_id, employee_id, full_name, primary_phone, employee_id_phone, aliases)`` in request order.

    A null field stays as it is; an empty name clears name and normal name; phones that are no phones
    change nothing. Aliases (array of alias_type, alias_value) are only added, to the row merged into if
    the edit merges: then the row's phones and normal name from before the edit become aliases of it
    too. A merge sets the link alone: no state, no link row, no audit, payments untouched.
    """
    from ledgerflow.functions.text import norm_name, norm_phone, py_strip

    master = identity.prepare_master(employees)
    ids = master.select(F.col("id").alias("_id"))
    e = edits.join(ids, edits.employee_id == ids._id, "left").withColumn("found", F.col("_id").isNotNull()).drop("_id")
    name = F.when(F.col("full_name") != "", py_strip("full_name"))
    e = stored(e.withColumns({
        "_named": F.col("full_name").isNotNull(), "_name": name, "_norm": F.when(F.col("full_name") != "", norm_name("full_name")),
        "_primary": norm_phone("primary_phone"), "_x": norm_phone("employee_id_phone")}), "employee-edits")
    fine = e.where("found")
    settled, st = _settle_id_phones(fine.where(F.col("_x").isNotNull()).select("request_id", "employee_id", F.col("_x").alias("x")), master)
    settled = stored(settled.select("request_id", "held", "merged_into"), "merges")
    # names and primary phones: the last one given
    last = fine.groupBy("employee_id").agg(
        F.max_by(F.struct("_name", "_norm"), F.when(F.col("_named"), F.col("request_id"))).alias("_n"), F.max(F.when(F.col("_named"), F.col("request_id"))).alias("_nr"),
        F.max_by("_primary", F.when(F.col("_primary").isNotNull(), F.col("request_id"))).alias("_p")).withColumnRenamed("employee_id", "_e")
    now = st.select(F.col("id").alias("_s"), F.col("idp").alias("_idp"), F.col("link").alias("_link"))
    named = F.col("_nr").isNotNull()
    over = {"full_name": F.when(named, F.col("_n._name")).otherwise(F.col("full_name")), "name_normalized": F.when(named, F.col("_n._norm")).otherwise(F.col("name_normalized")),
            "primary_phone": F.coalesce("_p", "primary_phone"), "employee_id_phone": F.col("_idp"), "canonical_employee_id": F.col("_link")}
    new = master.join(last, master.id == last._e, "left").join(now, master.id == now._s, "left").select(*[over[c].alias(c) if c in over else F.col(c) for c in master.columns])
    # aliases in request order: those asked for, then, on a merge, the row's own from before the edit
    out = fine.join(settled, "request_id", "left").withColumn("final_id", F.coalesce("merged_into", "employee_id"))
    asked = out.select("request_id", "final_id", F.posexplode("aliases").alias("pos", "a")).select("request_id", "final_id", "pos", F.col("a.alias_type").alias("alias_type"), F.col("a.alias_value").alias("_v"))
    value = F.when(F.col("alias_type") == "phone", F.coalesce(norm_phone("_v"), "_v")).when(F.col("alias_type") == "name", F.coalesce(F.when(norm_name("_v") != "", norm_name("_v")), F.col("_v"))) \
             .otherwise(F.col("_v"))
    asked = asked.where(F.col("alias_type").isin(ALIAS_TYPES) & (F.coalesce("_v", F.lit("")) != "")).select("request_id", "final_id", "pos", "alias_type", value.alias("alias_value"))
    merged = out.where(F.col("merged_into").isNotNull()).select("request_id", "employee_id", "merged_into", "held")
    earlier = fine.select(F.col("employee_id").alias("_e"), F.col("request_id").alias("_r"), "_named", "_norm", "_primary")
    prior = merged.join(earlier, (merged.employee_id == earlier._e) & (F.col("_r") < merged.request_id)).groupBy("request_id").agg(
        F.max_by(F.struct("_norm"), F.when(F.col("_named"), F.col("_r"))).alias("_n"), F.max_by("_primary", F.when(F.col("_primary").isNotNull(), F.col("_r"))).alias("_p"))
    was = merged.join(prior, "request_id", "left").join(master.select(F.col("id").alias("_m"), "name_normalized", "primary_phone"), F.col("employee_id") == F.col("_m"))
    old = F.array(F.struct(F.lit("phone").alias("t"), F.coalesce("_p", "primary_phone").alias("v")), F.struct(F.lit("phone").alias("t"), F.col("held").alias("v")),
                  F.struct(F.lit("name").alias("t"), F.when(F.col("_n").isNotNull(), F.col("_n._norm")).otherwise(F.col("name_normalized")).alias("v")))
    folded = was.select("request_id", F.col("merged_into").alias("final_id"), F.posexplode(old).alias("pos", "a")).where(F.coalesce("a.v", F.lit("")) != "").select(
        "request_id", "final_id", (F.col("pos") + 1_000_000).alias("pos"), F.col("a.t").alias("alias_type"), F.col("a.v").alias("alias_value"))
    key = ["alias_type", "alias_value"]
    added = (asked.unionByName(folded).groupBy(*key).agg(F.min_by("final_id", F.struct("request_id", "pos")).alias("employee_id"))
             .join(aliases.select(*key).distinct(), key, "left_anti").select("employee_id", *key))
    outcomes = out.select("request_id", "employee_id", F.lit("ok").alias("status"), "merged_into", "final_id").unionByName(
        e.where(~F.col("found")).select("request_id", "employee_id", F.lit("not_found").alias("status"), F.lit(None).cast("long").alias("merged_into"), F.lit(None).cast("long").alias("final_id")))
    return EmployeeEdits(new, added, outcomes)
