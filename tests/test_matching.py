"""Matching in message order against a fold over the messages."""
import random

import pytest

from fold import Fold, norm
from ledgerflow.operators import matching

EMP = ("id long, full_name string, name_normalized string, primary_phone string, employee_id_phone string, status string, "
       "canonical_employee_id long")
ALIAS = "employee_id long, alias_type string, alias_value string"
REQ = "message_id long, name_raw string, payout_phone string, id_phone string, amount int"


def run(spark, employees, aliases, requests, fuzzy=False):
    emp = spark.createDataFrame([(e["id"], e["name"], e["norm"], e["primary"], e["idphone"], e["status"], e["link"]) for e in employees], EMP)
    als = spark.createDataFrame([(a["employee_id"], a["alias_type"], a["alias_value"]) for a in aliases], ALIAS)
    req = spark.createDataFrame([(*r, 1) for r in requests], REQ).repartition(3)
    return matching.match_in_order(req, emp, als, fuzzy_names=fuzzy)


def check(spark, employees, aliases, requests, fuzzy=False):
    fold = Fold(employees, aliases, fuzzy)
    start = dict(fold.aliases)
    top = max(fold.rows, default=0)
    want = {rid: fold.match(rid, name, p, i) for rid, name, p, i in sorted(requests, key=lambda r: r[0])}
    out = run(spark, employees, aliases, requests, fuzzy)
    got = {r.message_id: (r.matched_id, r.employee_id, r.match_tier) for r in out.assigned.collect()}
    assert got == want
    rows = {r.id: (r.full_name, r.name_normalized, r.primary_phone, r.employee_id_phone) for r in out.new_employees.collect()}
    assert rows == {i: tuple(fold.rows[i][k] for k in ("name", "norm", "primary", "idphone")) for i in fold.made}
    assert sorted((r.employee_id, r.full_name, r.first_message_id) for r in out.renamed.collect()) == sorted(x for x in fold.renamed if x[0] <= top)
    assert {((r.alias_type, r.alias_value), r.employee_id) for r in out.aliases.collect()} == set(fold.aliases.items()) - set(start.items())
    assert sorted((r.message_id, r.candidate_employee_id, r.suspected_match_id, r.match_reason, float(r.confidence_score)) for r in out.reviews.collect()) == sorted(fold.reviews)
    return got


def emp(i, name, primary=None, idphone=None, status="active", link=None):
    return {"id": i, "name": name, "norm": norm(name), "primary": primary, "idphone": idphone, "status": status, "link": link}


def test_one_name_one_employee(spark):
    """A name with one phone, none and another phone is one person; an id phone of the master is found as a payout phone."""
    master = [emp(1, "Rahim", "01700000001", "01700000009")]
    got = check(spark, master, [], [(1, "karim mia", "01711111111", None), (2, "Karim  Mia.", None, None), (3, "karim mia", "01722222222", None),
                                    (4, None, "01700000009", None), (5, "Selim", "01700000009", None)])
    assert [got[k][1] for k in (1, 2, 3, 4, 5)] == [2, 2, 2, 1, 1]


def test_every_tier(spark):
    master = [emp(1, "Rahim", "01700000001"), emp(2, "Babu", "01700000002", "01700000003"), emp(3, "Anis", "01700000004", None, "inactive"),
              emp(4, "01700000005", "01700000005"), emp(5, "Dup", "01700000006", None, "active", 1)]
    als = [{"employee_id": 1, "alias_type": "phone", "alias_value": "01700000011"}, {"employee_id": 3, "alias_type": "phone", "alias_value": "01700000012"}]
    reqs = [(10, None, "01700000001", None), (11, None, "01799999999", "01700000003"), (12, None, "01700000011", None), (13, "BABU", None, None),
            (14, None, "01700000003", None), (15, "Anis", None, None), (16, "Nasir", "01700000005", None), (17, "nasir", None, None),
            (18, None, None, None), (19, "unknown", None, None), (20, None, "01700000012", None), (21, "Kabir", "01700000012", None),
            (22, None, "01700000006", None), (23, "01700000005", None, None)]
    got = check(spark, master, als, reqs)
    assert {t for _, _, t in got.values()} == {"exact_phone", "exact_id_phone", "alias_phone", "exact_name", "auto_created"}


@pytest.mark.parametrize("folds", [0, 4000])
def test_a_chain_of_requests_that_wait(spark, folds, monkeypatch):
    """Each shares a name with the one before and a phone with the one after."""
    monkeypatch.setattr(matching, "FOLD_REQUESTS", folds)
    reqs = []
    for k in range(4 if folds == 0 else 300):
        reqs.append((2 * k, f"name {k}x", f"01700000{k:03d}", None))
        reqs.append((2 * k + 1, f"name {k}x", f"01700000{k + 1:03d}", None))
    check(spark, [], [], reqs)


@pytest.mark.parametrize("folds", [0, 8, 4000])
@pytest.mark.parametrize("seed", range(4))
def test_random_batches(spark, seed, folds, monkeypatch):
    """By rounds alone, by rounds and a fold of the last few, and by the fold alone."""
    if folds == 0 and seed > 1:
        pytest.skip("rounds alone take long")
    monkeypatch.setattr(matching, "FOLD_REQUESTS", folds)
    rng = random.Random(seed)
    phones = [f"0170000000{k}" for k in range(7)]
    names = ["Abdul Karim", "karim", "Rahim Uddin", "rahim", "Unknown", "12", "n/a", "Babu", "Abdul Kareem", "01700000003", None]
    some = lambda p: rng.choice(phones) if rng.random() < p else None
    master = []
    for k in range(1, rng.randrange(1, 7)):
        name = rng.choice(names[:10])
        master.append(emp(k, name, some(0.6), some(0.4), rng.choice(["active", "active", "inactive"]), rng.randrange(1, k) if k > 1 and rng.random() < 0.3 else None))
    als = {("phone", rng.choice(phones)): rng.choice(master)["id"] for _ in range(2)} if master else {}
    als = [{"employee_id": v, "alias_type": t, "alias_value": x} for (t, x), v in als.items()]
    reqs = [(3 * k + rng.randrange(3), rng.choice(names), some(0.6), some(0.3)) for k in range(25)]
    check(spark, master, als, reqs, fuzzy=seed % 2 == 1)


def test_the_whole_fixture(spark):
    """The queries' own input, whole, against the fold, doubts and all."""
    from ledgerflow.functions.text import norm_name
    from ledgerflow.plans.queries import QUERIES
    from ledgerflow.sources import fixtures as fx
    from paths import SF_SMALL
    master = [{"id": r.id, "name": r.full_name, "norm": r.n, "primary": r.primary_phone, "idphone": r.employee_id_phone, "status": r.status,
               "link": r.canonical_employee_id} for r in fx.people(spark, SF_SMALL).withColumn("n", norm_name("full_name")).collect()]
    reqs = [tuple(r) for r in fx.people_requests(spark, SF_SMALL).collect()]
    fold = Fold(master, [r.asDict() for r in fx.people_aliases(spark, SF_SMALL).collect()], fuzzy=True)
    want = {rid: fold.match(rid, name, p, i) for rid, name, p, i in sorted(reqs)}
    got = {r.message_id: (r.matched_id, r.employee_id, r.match_tier) for r in QUERIES["match_in_order"](spark, SF_SMALL).collect()}
    assert got == want
    assert {t for *_, t in want.values()} >= {"exact_phone", "exact_id_phone", "alias_phone", "exact_name", "auto_created"}
    assert any(x[3] == "fuzzy_name_below_threshold" for x in fold.reviews)
    writes = QUERIES["match_writes"](spark, SF_SMALL).collect()
    assert {r.employee_id: r.full_name for r in writes if r.kind == "employee"} == {i: fold.rows[i]["name"] for i in fold.made}
    there = {(r.candidate_employee_id, r.suspected_match_id, r.match_reason) for r in fx.identity_reviews(spark, SF_SMALL).collect() if r.review_status == "pending"}
    queue = QUERIES["identity_review_queue"](spark, SF_SMALL).collect()
    assert len({r.id for r in queue}) == len(queue)
    assert {(r.candidate_employee_id, r.suspected_match_id, r.match_reason) for r in queue if r.review_status == "pending"} == there | {x[1:4] for x in fold.reviews}


def test_queued_once(spark):
    cols = "id long, candidate_employee_id long, suspected_match_id long, match_reason string, review_status string"
    there = spark.createDataFrame([(7, 1, 2, "a", "pending"), (8, 1, 3, "a", "rejected"), (9, None, 4, "a", "pending")], cols)
    new = spark.createDataFrame([(1, 1, 2, "a", 0.8), (2, 1, 3, "a", 0.8), (3, None, 4, "a", 0.8), (4, 5, 5, "a", 0.8), (6, 1, 2, "b", 0.9), (5, 1, 2, "b", 0.7)],
                                "message_id long, candidate_employee_id long, suspected_match_id long, match_reason string, confidence_score double")
    out = matching.enqueue_reviews(there, new)
    assert [(r.id, r.message_id, r.confidence_score) for r in out.orderBy("id").collect()] == [(10, 2, 0.8), (11, 5, 0.7)]
    again = there.unionByName(out.select(*there.columns))
    assert matching.enqueue_reviews(again, new).count() == 0


def test_long_chains_take_few_rounds(spark, monkeypatch):
    """Each request waits for the one before: the earliest are folded before each round, so a chain three times as long as a fold takes few rounds."""
    rounds, stored = [], matching.stored
    monkeypatch.setattr(matching, "FOLD_REQUESTS", 40)
    monkeypatch.setattr(matching, "stored", lambda df, name: rounds.append(name) or stored(df, name))
    reqs = []
    for k in range(60):
        reqs.append((2 * k, f"name {k}x", f"01700000{k:03d}", None))
        reqs.append((2 * k + 1, f"name {k}x", f"01700000{k + 1:03d}", None))
    check(spark, [], [], reqs)
    assert rounds.count("claims") <= 3


def test_lowest_two_of_a_key(spark):
    """Against every entry of the key, with many entries there from the start, later ones, short ones and doubts."""
    rng = random.Random(3)
    always = matching._ALWAYS
    entries = [(rng.choice("ab"), k, -1, rng.choice([always, always, rng.randrange(40)]), k) for k in range(40)]
    entries += [("a", 100 + k, k, rng.choice([always, always, k + rng.randrange(20)]), 100 + k) for k in rng.sample(range(40), 12)] + [("a", 7, 20, always, 7)]
    entries = [(*e, rng.randrange(40) if e[3] == always and rng.random() < 0.8 else None) for e in entries]
    creators = [("a", 5, True), ("b", 30, True), ("c", 9, True), ("c", 4, False), ("a", 33, False)]
    renamers = [("b", 25)]
    probes = [(rid, key) for rid in range(45) for key in "abc"]
    out = matching._lowest_two(spark.createDataFrame(probes, "rid long, key string"), spark.createDataFrame(entries, matching._ENTRY),
                               spark.createDataFrame(creators, "key string, u long, checks boolean"), spark.createDataFrame(renamers, "key string, u long"))
    got = {(r.rid, r.key): (r.low and r.low.row, r.next and r.next.row, r.maker, r.wait) for r in out.collect()}
    assert len(got) == len(probes)

    def there(key, at):
        return sorted({row for k, row, since, until, _, soft in entries if k == key and since < at <= until and (soft is None or soft >= at)})

    for rid, key in probes:
        low = (*there(key, rid), None, None)[:2]
        maker = min((u for k, u, checks in creators if k == key and u < rid and not (checks and there(key, u))), default=None)
        wait = any(k == key and u < rid for k, u in renamers) or any(k == key and soft is not None and max(soft, since) < rid for k, _, since, _, _, soft in entries)
        assert got[rid, key] == (*low, maker, wait)
