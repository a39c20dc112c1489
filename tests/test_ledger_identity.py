"""Ledger cases (FIXTURES.md §3), reversal, canonical links, ingest, top-k."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerflow.operators import identity, posting
from ledgerflow.operators.topk import top_k_per_group
from ledgerflow.sources import fixtures as fx
from ledgerflow.sources import ingest as ing

from paths import SF_SMALL

SCHEMA = "id long, employee_id long, accounting_period string, amount decimal(12,2), txn_category string"


def ledger_row(spark, rows, parity):
    df = spark.createDataFrame(rows, SCHEMA)
    r = posting.ledger(df, parity=parity).first()
    return r.total_paid, r.total_advance, r.closing_balance, r.txn_count


def test_ledger_cases(spark):
    D = Decimal
    cases = [
        ([(1, 1, "2026-01", D("100"), "salary")], (100, 0, 0, -100, 1)),
        ([(1, 1, "2026-01", D("100"), "salary"), (2, 1, "2026-01", D("50"), "advance")], (100, 50, -150, -150, 2)),
        ([(1, 1, "2026-01", D("100"), "salary"), (2, 1, "2026-01", D("-100"), "salary")], (0, 0, 0, 0, 2)),
        ([(1, 1, "2026-01", D("100"), "salary"), (2, 1, "2026-01", D("30"), "deduction")], (130, 0, -130, -130, 2)),
    ]
    for rows, (paid, adv, par, fixed, n) in cases:
        p = ledger_row(spark, rows, True)
        f = ledger_row(spark, rows, False)
        assert (p[0], p[1], p[2], p[3]) == (paid, adv, par, n)
        assert f[2] == fixed


def test_running_equals_totals(spark):
    from ledgerflow.operators.reports import with_reversals
    p = with_reversals(fx.payments(spark, SF_SMALL))
    run = posting.ledger_running(p, chunk=7)  # tiny chunks exercise the offsets
    last = run.groupBy("employee_id", "accounting_period").agg(F.min("closing_after").alias("c"),
                                                              F.max("seq").alias("n"))
    led = posting.ledger(p)
    j = last.join(led, ["employee_id", "accounting_period"])
    bad = j.where((F.col("n") != F.col("txn_count")))
    assert bad.count() == 0
    w = F.col("closing_balance") - F.col("c")
    assert j.where(F.col("n") == 1).where(w != 0).count() == 0


def test_canonical_is_idempotent(spark):
    emp = fx.employees(spark, SF_SMALL)
    c = identity.resolve_canonical(emp)
    assert c.where(~F.col("resolved")).count() == 0
    roots = c.select(F.col("canonical_id").alias("id")).distinct()
    again = c.join(roots, "id").where(F.col("canonical_id") != F.col("id"))
    assert again.count() == 0
    r = {x.id: x.canonical_id for x in c.collect()}
    assert r[10] == 7 and r[9] == 7 and r[8] == 7 and r[7] == 7


def test_ingest_twice_is_once(spark):
    store = fx.store_rows(spark, SF_SMALL).where(F.col("content") != " ")
    inc = store.select("wa_message_id", "source", "content", F.lit(0).alias("arrival"))
    empty = spark.createDataFrame([], "id long, wa_message_id string, source string")
    first, _ = ing.ingest(empty, inc)
    n1 = first.count()
    second, dups = ing.ingest(first, inc)
    assert second.count() == 0 and dups.count() == n1


def test_top_k_matches_window(spark):
    from pyspark.sql import Window
    df = spark.range(0, 5000).select((F.col("id") % 3).alias("g"), "id")
    k = 17
    a = top_k_per_group(df, ["g"], [F.col("id").desc()], k, salt_of=F.col("id"), salt_buckets=5)
    w = Window.partitionBy("g").orderBy(F.col("id").desc())
    b = df.withColumn("r", F.row_number().over(w)).where(F.col("r") <= k).drop("r")
    assert sorted(a.collect()) == sorted(b.collect())


def test_reversal_rules(spark):
    pay = spark.createDataFrame(
        [(1, "fpe-a", 1, 5, None, Decimal("100.00"), None, "cash", dt.date(2026, 1, 2), "salary", False, "2026-01")],
        "id long, txn_ref string, message_id long, employee_id long, employee_name_raw string, amount decimal(12,2), "
        "payout_phone string, payout_method string, txn_date date, txn_category string, is_reversal boolean, "
        "accounting_period string")
    req = spark.createDataFrame([(1, 1, "r", "a"), (2, 1, "r", "a"), (3, 9, "r", "a")],
                                "request_id long, txn_id long, reason string, actor string")
    rows, rejected = posting.reverse_payments(pay, req)
    rr = rows.collect()
    assert len(rr) == 1 and rr[0].amount == Decimal("-100.00") and rr[0].txn_ref == "REV-fpe-a"
    assert {(x.request_id, x.reject_reason) for x in rejected.collect()} == {(2, "already_reversed"), (3, "not_found")}


def test_name_enrichment(spark):
    """A phone match renames a placeholder name once (first valid name in
    message order), never a valid one, never on a name match; the alias goes
    to the first writer."""
    emp = spark.createDataFrame(
        [(1, "Unknown", "01700000001", "active", None), (2, "Rahim", "01700000002", "active", None),
         (3, "", "01700000003", "active", None)],
        "id long, full_name string, primary_phone string, status string, canonical_employee_id long")
    als = spark.createDataFrame([(9, "name", "karim")], "employee_id long, alias_type string, alias_value string")
    matched = spark.createDataFrame(
        [(10, "exact_phone", 1, None), (11, "exact_phone", 1, "  Anis "), (12, "alias_phone", 1, "Babu"),
         (13, "exact_phone", 2, "Anis"), (14, "exact_name", 3, "Selim"), (15, "exact_id_phone", 3, "Karim")],
        "message_id long, match_tier string, employee_id long, name_raw string")
    rows = {r.id: r for r in identity.enrich_names(matched, emp, als).collect()}
    assert set(rows) == {1, 3}
    assert (rows[1].full_name, rows[1].name_normalized, rows[1].first_message_id, rows[1].alias_added) == \
        ("Anis", "anis", 11, True)
    assert (rows[3].full_name, rows[3].alias_added) == ("Karim", False)


def test_suggest_phone(spark):
    """I15 phone path: id phone 1.00, primary 0.95, alias 0.93, payout 0.90,
    digits inside a phone 0.78; best score per canonical employee."""
    emp = spark.createDataFrame(
        [(1, "A", "01711111111", "01799999999", "active", None), (2, "B", "01722222222", None, "inactive", None),
         (3, "C", "01733333333", None, "active", 2)],
        "id long, full_name string, primary_phone string, employee_id_phone string, status string, "
        "canonical_employee_id long")
    als = spark.createDataFrame([(3, "phone", "01744444444")], "employee_id long, alias_type string, alias_value string")
    pay = spark.createDataFrame([(1, "01744444444")], "employee_id long, payout_phone string")
    qs = spark.createDataFrame([("01799999999",), ("+8801722222222",), ("01744444444",), ("333333",),
                                ("rahim",), ("ab 12",)], "query string")
    got = {(r.query, r.employee_id): r.score
           for r in identity.suggest_phone(qs, emp, als, pay).collect()}
    assert got == {("01799999999", 1): 1.00, ("+8801722222222", 2): 0.95, ("01744444444", 2): 0.93,
                   ("01744444444", 1): 0.90, ("333333", 2): 0.78}


def test_suggest_substring(spark):
    """I15 substring tiers: short queries use the 1-2 character index, longer
    ones the rarest 3-gram; collapsed forms need 3 characters; phone-like
    queries skip the name path."""
    emp = spark.createDataFrame(
        [(1, "Rahim Uddin", "01711111111", "active", None), (2, "Karim", "01722222222", "inactive", None),
         (3, "Al-Momin", "01733333333", "active", 2)],
        "id long, full_name string, primary_phone string, status string, canonical_employee_id long")
    als = spark.createDataFrame([(1, "name", "Babu Bhai")], "employee_id long, alias_type string, alias_value string")
    pay = spark.createDataFrame([(1, "Rahim-Ud"), (None, "nobody")], "employee_id long, employee_name_raw string")
    qs = spark.createDataFrame([("ri",), ("im u",), ("mom",), ("ubh",), ("himud",), ("0171 1111",)], "query string")
    got = {(r.query, r.employee_id): r.score for r in identity.suggest_substring(qs, emp, als, pay).collect()}
    assert got == {("ri", 2): 0.70, ("im u", 1): 0.74, ("mom", 2): 0.72, ("ubh", 1): 0.71, ("himud", 1): 0.74}


def test_suggest_rank(spark):
    """I15 stages 2-4: order by rounded score, total paid desc, last activity
    with none first, id; display name from the name and aliases; alias list
    sorted, display name removed, raw names holding the query merged in."""
    emp = spark.createDataFrame(
        [(1, "Anis", "01711111111", None, "active", None), (2, "Rahim", "01722222222", None, "active", None),
         (3, "Karim", "01733333333", None, "active", None), (4, None, "01744444444", "01799999999", "active", None)],
        "id long, full_name string, primary_phone string, employee_id_phone string, status string, "
        "canonical_employee_id long")
    als = spark.createDataFrame([(1, "name", "md anis"), (1, "name", "anis"), (3, "name", "k")],
                                "employee_id long, alias_type string, alias_value string")
    pay = spark.createDataFrame(
        [(1, 100.0, dt.date(2024, 1, 1), "Anis-Bhai", False), (2, 100.0, dt.date(2024, 2, 1), "rahim", False),
         (3, 500.0, None, None, True)],
        "employee_id long, amount double, txn_date date, employee_name_raw string, is_reversal boolean")
    hits = spark.createDataFrame([("anis", 1, 0.9), ("anis", 2, 0.9004), ("anis", 3, 0.9), ("anis", 4, 0.95)],
                                 "query string, employee_id long, score double")
    qs = spark.createDataFrame([("anis",)], "query string")
    rows = identity.suggest_rank(hits, qs, emp, als, pay, k=3).orderBy("rank").collect()
    assert [(r.employee_id, r.rank) for r in rows] == [(4, 1), (1, 2), (2, 3)]
    assert rows[0].display_name == "01799999999" and rows[0].mobile_number == "01799999999"
    assert rows[1].display_name == "md anis" and rows[1].aliases == ["Anis-Bhai", "anis"] and rows[1].alias_count == 3


def test_search_hits_are_few_and_narrow(spark):
    """Hits, which are far more than rows, are led to their canonical row before the queries meet them and picked by a hash
    aggregate of numbers: no sort, and no join after the union."""
    from ledgerflow.operators import identity
    emp = spark.createDataFrame([(1, "Karim Uddin", "01700000001", None, "active"), (2, "Karim Uddin", "01700000002", 1, "active"), (3, "Rahim Mia", "01700000003", None, "inactive")],
                                "id long, full_name string, primary_phone string, canonical_employee_id long, status string").selectExpr(
        "id", "concat('E', id) employee_code", "full_name", "primary_phone", "canonical_employee_id", "status")
    als = spark.createDataFrame([(2, "name", "karim uddin"), (3, "phone", "01700000002"), (9, "name", "nobody")], "employee_id long, alias_type string, alias_value string")
    out = identity.search(spark.createDataFrame([(x,) for x in ("01700000002", "KARIM UDDIN", "karim uddi", "rahim mia", "nobody", " ", None)], "query string"), emp, als)
    assert {(r.query, r.employee_id, r.match_type, r.priority) for r in out.collect()} == {
        ("01700000002", 1, "primary_phone", 2), ("01700000002", 3, "alias_phone", 3), ("KARIM UDDIN", 1, "exact_name", 4),
        ("karim uddi", 1, "fuzzy_name", 6), ("rahim mia", 3, "exact_name", 4)}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "SortAggregate" not in plan and plan.find("Union") < plan.find("Join")
