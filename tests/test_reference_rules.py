"""Cases where the rules are easy to get wrong: long link chains, late messages, senders, blank texts."""
import json

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import edits, identity
from ledgerflow.sources import ingest as ing
from ledgerflow.streaming.jobs import ingest_stream


def test_long_chains_resolve(spark):
    rows = [(i, i - 1 if i > 1 else None) for i in range(1, 41)] + [(100, 101), (101, 102), (102, 100), (200, 999)]
    emp = spark.createDataFrame(rows, "id long, canonical_employee_id long")
    got = {r.id: (r.canonical_id, r.resolved) for r in identity.resolve_canonical(emp).collect()}
    assert all(got[i] == (1, True) for i in range(1, 41))
    assert got[200] == (200, True)
    assert not any(got[i][1] for i in (100, 101, 102))


def test_cycles_are_not_resolved(spark):
    rows = [(10 * n + k, 10 * n + (k + 1) % n) for n in (2, 3, 4) for k in range(n)]
    rows += [(90, 20), (91, 90), (92, 40), (1, None), (2, 1), (3, 3), (4, 3)]
    emp = spark.createDataFrame(rows, "id long, canonical_employee_id long")
    got = {r.id: (r.canonical_id, r.resolved) for r in identity.resolve_canonical(emp).collect()}
    assert len(got) == len(rows)
    assert {i for i, (_, resolved) in got.items() if resolved} == {1, 2, 3, 4}
    assert [got[i][0] for i in (1, 2, 3, 4)] == [1, 1, 3, 3]


def test_unnormalisable_sender_is_null(spark):
    rows = spark.createDataFrame([("abc",), ("12@lid",), ("+8801712345678",), ("8801712345678@s.whatsapp.net",)], "sender string")
    lids = spark.createDataFrame([("12", "not a phone")], "lid string, phone string")
    got = {r.sender: r.sender_phone for r in ing.resolve_sender(rows, lids).collect()}
    assert got == {"abc": None, "12@lid": None, "+8801712345678": "01712345678", "8801712345678@s.whatsapp.net": "01712345678"}


def test_blank_content_drops_the_row(spark):
    rows = [(1, "text", None), (2, "  ", "other"), (3, "", "other"), (4, None, "other"), (5, None, " ")]
    raw = spark.createDataFrame(rows, "id long, content string, processed_text string").select(
        "*", F.lit("c").alias("chat_jid"), F.lit("s").alias("sender"), F.lit("2024-01-02 03:04:05").alias("timestamp"),
        F.lit(0).alias("is_from_me"), F.lit(None).cast("string").alias("media_type"))
    assert {r.wa_message_id: r.raw_content for r in ing.conform_message(raw).collect()} == {"1": "text", "3": "other", "4": "other"}


def test_late_and_repeated_messages(spark, tmp_path):
    """A message far behind the newest one is archived, repeats are not, and a second run goes on."""
    schema = "wa_message_id string, source string, timestamp_wa timestamp"
    src, archive = str(tmp_path / "in"), str(tmp_path / "archive")
    days = ["2024-05-01", "2024-05-20", "2024-01-01", "2024-05-20"]
    for i, day in enumerate(days[:3]):
        spark.createDataFrame([(f"m{i}", "s", day)], "a string, b string, c string").selectExpr(
            "a AS wa_message_id", "b AS source", "CAST(c AS timestamp) AS timestamp_wa").write.mode("append").parquet(src)
    stream = lambda: spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    assert {r.wa_message_id for r in ingest_stream(spark, stream(), archive).collect()} == {"m0", "m1", "m2"}
    spark.createDataFrame([("m1",), ("m9",), ("m9",)], "wa_message_id string").selectExpr(
        "wa_message_id", "'s' AS source", "CAST('2023-01-01' AS timestamp) AS timestamp_wa").write.mode("append").parquet(src)
    assert sorted(r.wa_message_id for r in ingest_stream(spark, stream(), archive).collect()) == ["m0", "m1", "m2", "m9"]


def _master(spark, ids, links=None):
    rows = [(i, (links or {}).get(i)) for i in ids]
    return spark.createDataFrame(rows, "id long, canonical_employee_id long")


def _link(spark, emp, reqs):
    """``reqs``: (request, duplicate, target) -> outcome per refused request, link rows, links of the rows."""
    d = spark.createDataFrame([(*r, 0.9, "admin") for r in reqs],
                              "request_id long, duplicate_id long, canonical_id long, score double, actor string")
    res = edits.link_duplicates(emp, d)
    out = {r.request_id: r.reject_reason for r in res.rejected.collect()}
    audit = [(r.request_id, r.entity_id, json.loads(r.before_state)["canonical_employee_id"], json.loads(r.after_state)["canonical_employee_id"]) for r in res.audit.collect()]
    assert {q for q, *_ in audit} | set(out) == {r[0] for r in reqs} and len(audit) + len(out) == len(reqs)
    return out, {(r.employee_id, r.canonical_employee_id) for r in res.added.collect()}, {r.id: r.canonical_employee_id for r in res.table.collect()}, sorted(audit)


def test_links_in_one_batch_make_no_cycle(spark):
    out, linked, now, _ = _link(spark, _master(spark, [1, 2, 3]), [(1, 1, 2), (2, 2, 1), (3, 2, 3)])
    assert out == {2: "target_is_duplicate"} and linked == {(1, 2), (2, 3)}
    assert now == {1: 2, 2: 3, 3: None}


def test_a_second_link_of_a_row_is_the_one_that_holds(spark):
    out, linked, now, audit = _link(spark, _master(spark, [1, 2, 3, 4], {3: 2}), [(1, 1, 1), (2, 1, 3), (3, 1, 2), (4, 1, 4), (5, 9, 1), (6, 1, 2), (7, 3, 4)])
    assert out == {1: "self_link", 2: "target_is_duplicate", 5: "duplicate_missing"}
    assert linked == {(1, 2), (1, 4), (3, 4)} and now == {1: 2, 2: None, 3: 4, 4: None}
    assert audit == [(3, 1, None, 2), (4, 1, 2, 4), (6, 1, 4, 2), (7, 3, 2, 4)]


def fold_links(link, reqs):
    link, want, rows = dict(link), {}, set()
    for n, dup, target in reqs:
        if dup == target:
            want[n] = "self_link"
        elif target in link:
            want[n] = "target_is_duplicate"
        else:
            link[dup] = target
            rows.add((dup, target))
    return link, want, rows


@pytest.mark.parametrize("seed", [5, 6])
def test_links_equal_a_fold_over_the_requests(spark, seed):
    import random
    rng = random.Random(seed)
    ids = list(range(1, 25))
    reqs = [(n, rng.choice(ids), rng.choice(ids)) for n in range(40)]
    link, want, rows = fold_links({}, reqs)
    out, linked, now, _ = _link(spark, _master(spark, ids), reqs)
    assert out == want and linked == rows and now == {i: link.get(i) for i in ids}


def test_a_long_chain_of_links_settles_in_few_steps(spark, monkeypatch):
    """Every request waits for the next row's, which comes before it."""
    n = 1500
    ids = list(range(n + 1))
    reqs = [(n - k, k, k + 1) for k in range(n)]
    link, want, rows = fold_links({}, sorted(reqs))
    steps, real = [], edits.stored
    monkeypatch.setattr(edits, "stored", lambda df, name: steps.append(name) or real(df, name))
    out, linked, now, _ = _link(spark, _master(spark, ids), reqs)
    assert out == want and linked == rows and now == {i: link.get(i) for i in ids}
    assert len(steps) < 25


def test_review_decisions(spark):
    emp = _master(spark, [1, 2, 3, 4, 5], {5: 4}).withColumn("status", F.lit("active"))
    rev = spark.createDataFrame([(1, 2, 1, "pending", 0.8), (2, 3, 5, "pending", 0.9), (3, 4, 2, "pending", 0.9), (4, 1, 3, "rejected", 0.9), (5, None, 3, "pending", 0.7)],
                                "id long, candidate_employee_id long, suspected_match_id long, review_status string, confidence_score double")
    dec = spark.createDataFrame([(1, 1, "approved_merge", "a", None), (2, 1, "rejected", "a", None), (3, 2, "approved_merge", "a", "n"), (4, 2, "kept_separate", "b", "m"),
                                 (5, 3, "approved_merge", "a", None), (6, 4, "rejected", "a", None), (7, 9, "rejected", "a", None), (8, 5, "approved_merge", "a", None),
                                 (9, 3, "approved_merge", "a", None), (10, 5, "maybe", "a", None)],
                                "request_id long, review_id long, decision string, reviewer string, note string")
    out = edits.resolve_reviews(rev, dec, emp)
    assert {r.id: (r.review_status, r.reviewer, r.review_note) for r in out.reviews.collect()} == {
        1: ("approved_merge", "a", None), 2: ("kept_separate", "b", "m"), 3: ("pending", None, None), 4: ("rejected", None, None), 5: ("pending", None, None)}
    assert {r.id: r.canonical_employee_id for r in out.links.table.collect()} == {1: None, 2: 1, 3: None, 4: None, 5: 4}
    assert {r.request_id: r.reject_reason for r in out.rejected.collect()} == {
        2: "not_pending", 3: "target_is_duplicate", 5: "target_is_duplicate", 6: "not_pending", 7: "not_found", 8: "missing_employee", 9: "target_is_duplicate", 10: "invalid_decision"}
    rows = edits.numbered_audit(None, [out.audit]).orderBy("id").collect()
    assert [(r.id, r.request_id, r.action) for r in rows] == [(1, 1, "link_duplicate"), (2, 1, "resolve_review"), (3, 4, "resolve_review")]
    assert json.loads(rows[0].before_state)["canonical_employee_id"] is None and rows[0].reason == "approved_merge via review 1"


def test_inactive_and_aliases(spark):
    emp = _master(spark, [1, 2]).withColumns({"status": F.lit("active"), "full_name": F.lit("A"), "primary_phone": F.lit("x"), "employee_id_phone": F.lit(None).cast("string")})
    out = edits.mark_inactive(emp, spark.createDataFrame([(1, 1, "a", "r"), (2, 7, "a", "r"), (3, 1, None, None)], "request_id long, employee_id long, actor string, reason string"))
    assert {r.id: (r.status, r.resolution_status) for r in out.table.collect()} == {1: ("inactive", "inactive"), 2: ("active", "unresolved")}
    assert [(r.request_id, r.reject_reason) for r in out.rejected.collect()] == [(2, "not_found")]
    audit = {r.request_id: (json.loads(r.before_state)["status"], json.loads(r.after_state)["status"], r.actor) for r in out.audit.collect()}
    assert audit == {1: ("active", "inactive", "a"), 3: ("inactive", "inactive", "admin")}
    als = spark.createDataFrame([(1, "phone", "p1")], "employee_id long, alias_type string, alias_value string")
    req = spark.createDataFrame([(1, 2, "phone", "p1", "a"), (3, 2, "name", "n", "a"), (2, 1, "name", "n", None), (4, 1, "mail", "n", "a"), (5, 1, "phone", None, "a")],
                                "request_id long, employee_id long, alias_type string, alias_value string, actor string")
    out = edits.add_aliases(als, req)
    assert {tuple(r) for r in out.table.collect()} == {(1, "phone", "p1"), (1, "name", "n")}
    assert {r.request_id: r.reject_reason for r in out.rejected.collect()} == {1: "taken", 3: "taken", 4: "invalid_alias_type", 5: "empty_value"}
    assert [(r.request_id, r.entity_id, r.actor) for r in out.audit.collect()] == [(2, 1, "system")]


def test_equal_candidates_post_once(spark):
    import datetime as dt
    from ledgerflow.operators import posting
    row = (7, 3, "a", 100.0, "01712345678", "cash", dt.date(2024, 1, 2), "salary", "text")
    cands = spark.createDataFrame([row, row, (8, *row[1:])], "message_id long, employee_id long, name_raw string, amount double, "
                                  "payout_phone string, payout_method string, txn_date date, txn_category string, raw_content string") \
        .withColumn("amount", F.col("amount").cast("decimal(12,2)"))
    first = posting.post_payments(cands, None)
    assert sorted((r.message_id, r.id) for r in first.collect()) == [(7, 1), (8, 2)]
    assert posting.post_payments(cands, first).count() == 0
    assert [r.txn_count for r in posting.ledger(posting.keyed_payments(cands, None)).collect()] == [2]


def test_gap_scan_reads_the_whole_store_and_processed_text(spark):
    store = spark.range(6000).select(
        F.concat(F.lit("m"), F.col("id").cast("string")).alias("wa_message_id"), F.lit("s").alias("source"),
        F.when(F.col("id") % 2 == 0, "c").otherwise("d").alias("chat_jid"), F.timestamp_seconds("id").alias("timestamp_wa"),
        F.when(F.col("id") > 2, "text").when(F.col("id") == 2, " ").otherwise("").alias("content"),
        F.when(F.col("id").isin(1, 2), "voice").alias("processed_text"))
    archive = store.where("timestamp_wa > timestamp_seconds(3)").withColumn("chat_jid", F.lit("c"))
    got = {r.wa_message_id: r.action for r in ing.gap_scan(store, archive).collect()}
    assert got == {"m0": "skipped_no_content", "m1": "backfill", "m2": "skipped_no_content", "m3": "backfill"}
    log = {r.chat_jid: r for r in ing.gap_run_log(store, archive).collect()}
    assert (log["c"].store_count, log["c"].archive_count, log["d"].archive_count) == (3000, 2998, 2998)


def test_rows_in_a_link_cycle_go_to_review(spark):
    emp = spark.createDataFrame([(1, 2), (2, 1), (3, 1), (4, None), (5, 4)], "id long, canonical_employee_id long")
    got = {(r.candidate_employee_id, r.suspected_match_id, r.match_reason) for r in identity.cycle_reviews(emp).collect()}
    assert got == {(1, 2, "link_cycle"), (2, 1, "link_cycle"), (3, 1, "link_cycle")}
