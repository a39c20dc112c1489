"""Employee edits with soft merges against a fold over the edits."""
import random

import pytest

from fold import norm
from ledgerflow.operators import edits

EMP = "id long, full_name string, name_normalized string, primary_phone string, employee_id_phone string, status string, canonical_employee_id long"
EDIT = "request_id long, employee_id long, full_name string, primary_phone string, employee_id_phone string, aliases array<struct<alias_type:string,alias_value:string>>"


def phone(s):
    return s if s and len(s) == 11 and s.isdigit() else None


def fold(rows, aliases, reqs):
    rows, aliases, out = {r[0]: list(r) for r in rows}, dict(aliases), {}

    def canon(i):
        seen = set()
        while rows[i][6] is not None and i not in seen:
            seen.add(i)
            i = rows[i][6]
        return i

    for q, emp, name, primary, idp, more in reqs:
        if emp not in rows:
            out[q] = ("not_found", None, None)
            continue
        r, before, merge = rows[emp], list(rows[emp]), None
        primary, x = phone(primary), phone(idp)
        if x and x != r[4]:
            holder = min((i for i, o in rows.items() if i != emp and o[4] == x and o[5] == "active"), default=None)
            if holder is not None and canon(holder) != emp:
                merge = canon(holder)
        if name is not None:
            r[1], r[2] = (name.strip(), norm(name)) if name else (None, None)
        if primary:
            r[3] = primary
        if x and merge is None:
            r[4] = x
        if merge is not None:
            r[6] = merge
        final = merge or emp
        for kind, value in more or []:
            if kind in ("phone", "name", "employee_id") and value:
                aliases.setdefault((kind, phone(value) or value if kind == "phone" else norm(value) or value if kind == "name" else value), final)
        if merge is not None:
            for kind, value in (("phone", before[3]), ("phone", before[4]), ("name", before[2])):
                if value:
                    aliases.setdefault((kind, value), final)
        out[q] = ("ok", merge, final)
    return {i: tuple(r) for i, r in rows.items()}, aliases, out


def check(spark, rows, aliases, reqs):
    want_rows, want_aliases, want = fold(rows, aliases, reqs)
    als = spark.createDataFrame([(e, t, v) for (t, v), e in aliases.items()], "employee_id long, alias_type string, alias_value string")
    res = edits.edit_employees(spark.createDataFrame(rows, EMP), als, spark.createDataFrame(reqs, EDIT).repartition(3))
    assert {r.request_id: (r.status, r.merged_into, r.final_id) for r in res.outcomes.collect()} == want
    assert {r.id: tuple(r) for r in res.employees.select(*[c.split()[0] for c in EMP.split(", ")]).collect()} == want_rows
    assert {((r.alias_type, r.alias_value), r.employee_id) for r in res.aliases.collect()} == set(want_aliases.items()) - set(aliases.items())


def test_merge_folds_the_old_values_in(spark):
    rows = [(1, "Rahim", "rahim", "01700000001", "01700000009", "active", None), (2, "Rahim U", "rahim u", "01700000002", "01700000008", "active", None),
            (3, "Old", "old", None, "01700000007", "inactive", None), (4, "Dup", "dup", None, "01700000006", "active", 1)]
    reqs = [(1, 2, "New name", "01700000022", None, [("phone", "01711111111"), ("mail", "x"), ("name", " Bhai  R. ")]),
            (2, 2, None, "bad", "01700000006", [("employee_id", "E-1")]),                    # held by 4, whose canonical row is 1
            (3, 1, "", None, "01700000007", None), (4, 9, "x", None, None, None), (5, 3, None, None, "01700000009", None)]
    check(spark, rows, {("name", "taken"): 1}, reqs)


@pytest.mark.parametrize("seed", range(3))
def test_random_edits(spark, seed):
    rng = random.Random(seed)
    phones = [f"0170000000{k}" for k in range(6)]
    some = lambda p: rng.choice(phones) if rng.random() < p else None
    rows = [(i, f"Name {i}", f"name {i}", some(0.5), some(0.5), rng.choice(["active", "active", "inactive"]), rng.randrange(1, i) if i > 1 and rng.random() < 0.2 else None)
            for i in range(1, 9)]
    reqs = [(q, rng.randrange(1, 10), rng.choice([None, None, "", "Other One", " Md K. "]), some(0.3), some(0.6) if rng.random() < 0.9 else "12",
             [(rng.choice(["phone", "name", "mail"]), rng.choice(phones + ["Ann", ""])) for _ in range(rng.randrange(0, 3))]) for q in range(1, 15)]
    check(spark, rows, {("phone", phones[0]): 1}, reqs)
