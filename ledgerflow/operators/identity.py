"""Identity resolution: canonical links, exact match tiers, creation.

Matching works on the *distinct* request keys (payout phone, id phone,
normal name), not on messages: a hot sender collapses in the map-side partial
aggregate before any shuffle, and each tier is an equi-join against a lookup
that has at most one row per key. The result is joined back to the requests
on the key, where AQE's skew-join split handles a key that holds a large
share of the rows.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import (collapse_text, employee_code, norm_name, norm_phone, py_strip,
                                       valid_name)
from ledgerflow.operators import fuzzy

TIER_ORDER = ["exact_phone", "exact_id_phone", "alias_phone", "exact_name"]


def resolve_canonical(employees: DataFrame) -> DataFrame:
    """``(id, canonical_id, resolved)`` for every employee.

    A link to a missing row stops at the last row that exists. Pointer
    doubling goes on until no pointer moves, so a chain of n hops takes
    log2(n) rounds, and a cycle's pointers log2(rows) rounds at most. A row is
    ``resolved`` if the row it ends at has no existing link of its own; in a
    cycle and on the way into one none ends so, whatever its length.
    """
    e = employees.select("id", "canonical_employee_id")
    targets = employees.select(F.col("id").alias("_t"))
    ptr = (e.join(targets, e.canonical_employee_id == targets._t, "left")
           .select("id", F.coalesce("_t", "id").alias("p")))
    # each round reads the previous one twice: persist it, or the plan doubles per round
    ptr = ptr.persist(StorageLevel.MEMORY_AND_DISK)
    ends = ptr.select(F.col("id").alias("_k"), (F.col("p") == F.col("id")).alias("_end"))
    rounds = max(1, ptr.count()).bit_length() + 1
    for _ in range(rounds):
        nxt = ptr.select(F.col("id").alias("_k"), F.col("p").alias("_pp"))
        step = ptr.join(nxt, ptr.p == nxt._k, "left").select("id", F.coalesce("_pp", "p").alias("p"), (F.col("_pp") != F.col("p")).alias("_moved")) \
                  .persist(StorageLevel.MEMORY_AND_DISK)
        moved = step.where("_moved").limit(1).count()
        ptr = step.select("id", "p")
        if not moved:
            break
    return (ptr.join(ends, ptr.p == ends._k, "left")
            .select("id", F.col("p").alias("canonical_id"), F.coalesce("_end", F.lit(True)).alias("resolved")))


def cycle_reviews(employees: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """Rows whose links lead into a cycle have no canonical row; they go to review beside the row they link to."""
    if canonical is None:
        canonical = resolve_canonical(employees)
    lost = canonical.where(~F.col("resolved")).select("id")
    return employees.join(lost, "id").select(
        F.lit(None).cast("long").alias("message_id"), F.col("id").alias("candidate_employee_id"), F.col("canonical_employee_id").alias("suspected_match_id"),
        F.lit("link_cycle").alias("match_reason"), F.lit(None).cast("decimal(4,3)").alias("confidence_score"),
        F.lit(None).cast("string").alias("raw_name"), F.lit(None).cast("string").alias("raw_phone"))


def prepare_master(employees: DataFrame) -> DataFrame:
    """Fill the derived columns a master table may lack (persisted: the
    master feeds the lookups, the canonical map and creation)."""
    if getattr(employees, "_lf_master", False):
        return employees
    cols = set(employees.columns)
    out = employees
    if "name_normalized" not in cols:
        out = out.withColumn("name_normalized", norm_name("full_name"))
    if "employee_id_phone" not in cols:
        out = out.withColumn("employee_id_phone", F.lit(None).cast("string"))
    if "canonical_employee_id" not in cols:
        out = out.withColumn("canonical_employee_id", F.lit(None).cast("long"))
    out = out.persist(StorageLevel.MEMORY_AND_DISK)
    out._lf_master = True
    return out


def _tier_lookup(active: DataFrame, aliases: DataFrame) -> DataFrame:
    """One table for tiers 1-4: ``(_kind, _key, _hit)`` with the lowest id
    per key (Q16). Kinds: primary phone, id phone, phone alias, normal name."""
    alias_rows = (aliases.where(F.col("alias_type") == "phone")
                  .join(active.select(F.col("id").alias("employee_id")), "employee_id")
                  .select(F.lit("alias").alias("_kind"), F.col("alias_value").alias("_key"),
                          F.col("employee_id").alias("id")))
    rows = (active.select(F.lit("primary").alias("_kind"), F.col("primary_phone").alias("_key"), "id")
            .unionByName(active.select(F.lit("idphone").alias("_kind"), F.col("employee_id_phone").alias("_key"), "id"))
            .unionByName(active.select(F.lit("name").alias("_kind"), F.col("name_normalized").alias("_key"), "id"))
            .unionByName(alias_rows))
    return (rows.where(F.col("_key").isNotNull() & (F.col("_key") != ""))
            .groupBy("_kind", "_key").agg(F.min("id").alias("_hit")))


# (tier rank, lookup kind, request key column, tier name)
_PROBES = [
    (1, "primary", "_kp", "exact_phone"),
    (2, "idphone", "_ki", "exact_id_phone"),
    (3, "alias", "_kp", "alias_phone"),
    (4, "alias", "_ki", "alias_phone"),
    (5, "name", "_kn", "exact_name"),
]


def match_exact(requests: DataFrame, employees: DataFrame, aliases: DataFrame,
                canonical: DataFrame | None = None) -> DataFrame:
    """I1 tiers 1-4 against an existing master.

    ``requests`` needs ``payout_phone``, ``id_phone`` and ``name_raw``. Adds
    ``name_norm``, ``match_tier`` (null when no tier hits), ``matched_id`` (the
    row hit) and ``employee_id`` (its canonical row, I6).

    Each distinct request key is probed once per tier against a single lookup
    table (one join), and the best tier wins per key (one aggregate).
    """
    master = prepare_master(employees)
    active = master.where(F.col("status") == "active")
    lookup = _tier_lookup(active, aliases)

    req = requests.withColumn("name_norm", F.when(F.col("name_raw").isNotNull(), norm_name("name_raw")))
    keys = req.select(F.coalesce("payout_phone", F.lit("")).alias("_kp"),
                      F.coalesce("id_phone", F.lit("")).alias("_ki"),
                      F.coalesce("name_norm", F.lit("")).alias("_kn")).distinct()
    probes = F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(k).alias("kind"), F.col(c).alias("key"),
                                F.lit(t).alias("tier")) for r, k, c, t in _PROBES])
    exploded = (keys.select("_kp", "_ki", "_kn", F.explode(probes).alias("_p"))
                .where(F.col("_p.key") != ""))
    hits = exploded.join(lookup, (exploded["_p.kind"] == lookup._kind) & (exploded["_p.key"] == lookup._key))
    best = hits.groupBy("_kp", "_ki", "_kn").agg(
        F.min_by(F.struct(F.col("_p.tier").alias("t"), F.col("_hit").alias("h")), F.col("_p.rank")).alias("_b"))
    k = best.select("_kp", "_ki", "_kn", F.col("_b.t").alias("match_tier"), F.col("_b.h").alias("matched_id"))
    if canonical is None:
        canonical = resolve_canonical(master)
    canon = canonical.select(F.col("id").alias("_cid"), F.col("canonical_id").alias("employee_id"))
    k = k.join(canon, k.matched_id == canon._cid, "left").drop("_cid")
    out = (req.join(k, (F.coalesce(req.payout_phone, F.lit("")) == k._kp)
                    & (F.coalesce(req.id_phone, F.lit("")) == k._ki)
                    & (F.coalesce(req.name_norm, F.lit("")) == k._kn), "left")
           .drop("_kp", "_ki", "_kn"))
    return out


def members(employees: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """``(canonical_id, member_id)``; every row is a member of its own
    canonical row, so a canonical row lists itself."""
    if canonical is None:
        canonical = resolve_canonical(employees)
    return canonical.select("canonical_id", F.col("id").alias("member_id"))


# Search tiers (I14): (priority, employee column or alias type, query form)
SEARCH_TIERS = [
    (1, "employee_id_phone", "phone", "id_phone"),
    (2, "primary_phone", "phone", "primary_phone"),
    (3, "alias:phone", "phone", "alias_phone"),
    (4, "name_normalized", "name", "exact_name"),
    (5, "alias:name", "name", "alias_name"),
]


def search(queries: DataFrame, employees: DataFrame, aliases: DataFrame,
           canonical: DataFrame | None = None) -> DataFrame:
    """I14 for a batch of ``queries(query)``: phone-like queries (six or more
    digits) probe id phone, primary phone and phone aliases; every query
    probes exact normal name and name aliases, and, from three characters of
    normal name on, active rows whose name scores 90 or more. Hits resolve to their canonical
    row (I6) and each canonical keeps its best (lowest) priority (A18).
    Any status matches, as in the source system."""
    master = prepare_master(employees)
    q = queries.select("query").distinct()
    raw = F.regexp_replace("query", r"(?U)^\s+|\s+$", "")
    digits = F.regexp_replace(raw, r"(?U)\D", "")
    from ledgerflow.functions.text import norm_phone
    q = q.select("query", F.when(F.length(digits) >= 6, norm_phone(raw)).alias("_phone"),
                 norm_name(raw).alias("_name")).where(raw != "")
    if canonical is None:
        canonical = resolve_canonical(master)
    # rows are led to their canonical row before the queries meet them, and a hit carries its tier's number alone:
    # hits are far more than rows, so they are shuffled narrow and no more often than the joins and the pick need
    c = canonical.select(F.col("id").alias("_cid"), F.col("canonical_id").alias("employee_id"))
    resolved = lambda side, value: side.join(c, side.id == c._cid).select("employee_id", value).distinct()
    rows = None
    for prio, col, form, _ in SEARCH_TIERS:
        if col.startswith("alias:"):
            kind = col.split(":")[1]
            side = aliases.where(F.col("alias_type") == kind).select(F.col("employee_id").alias("id"),
                                                                     F.col("alias_value").alias("_v"))
        else:
            side = master.select("id", F.col(col).alias("_v"))
        side = resolved(side.where(F.col("_v").isNotNull() & (F.col("_v") != "")), "_v")
        key = "_phone" if form == "phone" else "_name"
        hits = q.where(F.col(key).isNotNull() & (F.col(key) != "")).join(side, F.col(key) == side._v) \
                .select("query", "employee_id", F.lit(prio).alias("priority"))
        rows = hits if rows is None else rows.unionByName(hits)
    named = master.where((F.col("status") == "active") & (F.col("name_normalized") != "")).select("id", F.col("name_normalized").alias("other"))
    alike = fuzzy.similar_names(q.where(F.length("_name") >= 3).select(F.col("_name").alias("name")), named.select("other"), fuzzy.ACCEPT)
    rows = rows.unionByName(alike.select("name", "other").join(resolved(named, "other"), "other").join(q, F.col("_name") == F.col("name"))
                            .select("query", "employee_id", F.lit(6).alias("priority")))
    best = rows.groupBy("query", "employee_id").agg(F.min("priority").alias("priority"))
    tiers = [(prio, tier) for prio, *_, tier in SEARCH_TIERS] + [(6, "fuzzy_name")]
    match_type = F.create_map(*[F.lit(x) for tier in tiers for x in tier])[F.col("priority")]
    return best.select("query", "employee_id", match_type.alias("match_type"), "priority")


def canonical_profiles(employees: DataFrame, aliases: DataFrame, canonical: DataFrame | None = None) -> DataFrame:
    """I16 for every canonical row: member ids, distinct aliases ordered by
    (type, value), and payout phones (U4): primary, id phone, then phone
    aliases, first occurrence kept."""
    master = prepare_master(employees)
    if canonical is None:
        canonical = resolve_canonical(master)
    mem = canonical.select("canonical_id", F.col("id").alias("member_id"))
    roots = master.join(canonical.where(F.col("id") == F.col("canonical_id")).select("id"), "id")
    ids = mem.groupBy("canonical_id").agg(F.array_sort(F.collect_list("member_id")).alias("member_ids"))
    al = (mem.join(aliases, mem.member_id == aliases.employee_id)
          .groupBy("canonical_id").agg(F.array_sort(F.collect_set(F.struct("alias_type", "alias_value"))).alias("_al")))
    j = roots.join(ids, roots.id == ids.canonical_id, "left").drop("canonical_id") \
             .join(al, roots.id == al.canonical_id, "left")
    phone_aliases = F.transform(F.filter(F.coalesce("_al", F.array()), lambda a: a["alias_type"] == "phone"),
                                lambda a: a["alias_value"])
    payout = F.filter(F.array_distinct(F.concat(F.array("primary_phone", "employee_id_phone"), phone_aliases)),
                      lambda p: p.isNotNull())
    return j.select(F.col("id").alias("canonical_id"), "employee_code", "full_name", "member_ids",
                    F.transform(F.coalesce("_al", F.array()), lambda a: F.concat_ws(":", a["alias_type"], a["alias_value"]))
                    .alias("aliases"), payout.alias("payout_phones"))


def text_search(employees: DataFrame, aliases: DataFrame, text: str, status: str = "active",
                canonical_only: bool = True) -> DataFrame:
    """Employees by status (canonical rows only) whose name, id phone,
    phone or code contains ``text`` case-insensitively, or that have an alias
    containing it (EXISTS -> left semi join). Wild cards in the text are not
    escaped, as in the source system. One scan of each table."""
    pat = f"%{text}%"
    e = employees.where(F.col("status") == status)
    if canonical_only:
        e = e.where(F.col("canonical_employee_id").isNull())
    direct = (F.col("full_name").ilike(pat) | F.col("employee_id_phone").ilike(pat)
              | F.col("primary_phone").ilike(pat) | F.col("employee_code").ilike(pat))
    hit_alias = aliases.where(F.col("alias_value").ilike(pat)).select(F.col("employee_id").alias("id")).distinct()
    by_alias = e.join(hit_alias, "id", "left_semi")
    return e.where(F.coalesce(direct, F.lit(False))).unionByName(by_alias).distinct()


PHONE_TIERS = ["exact_phone", "exact_id_phone", "alias_phone"]


def enrich_names(matched: DataFrame, employees: DataFrame, aliases: DataFrame) -> DataFrame:
    """I2 over a batch of matched requests.

    A phone-tier match renames the resolved employee when its stored name is
    not a valid name (F8) and the request's name is: in message order the
    first valid name wins, since after it the stored name is valid. The
    normal name also becomes a name alias unless that value is taken (an
    existing alias, or an earlier rename in the batch: first writer wins).

    One row per renamed employee: ``id``, ``old_name``, ``full_name``,
    ``name_normalized``, ``first_message_id``, ``alias_added``. The per-
    employee pick is a ``min_by`` aggregate, so a hot employee collapses in
    the map-side partial aggregate.
    """
    cand = matched.where(F.col("match_tier").isin(PHONE_TIERS) & F.col("employee_id").isNotNull()
                         & valid_name("name_raw"))
    first = cand.groupBy("employee_id").agg(
        F.min_by("name_raw", "message_id").alias("_name"), F.min("message_id").alias("first_message_id"))
    master = prepare_master(employees)
    emp = master.select(F.col("id"), F.col("full_name").alias("old_name"))
    upd = (first.join(emp, first.employee_id == emp.id)
           .where(~F.coalesce(valid_name("old_name"), F.lit(False)))
           .select("id", "old_name", py_strip("_name").alias("full_name"),
                   norm_name("_name").alias("name_normalized"), "first_message_id"))
    taken = aliases.where(F.col("alias_type") == "name").select(F.col("alias_value").alias("name_normalized")).distinct()
    winners = (upd.where(F.col("name_normalized") != "").join(taken, "name_normalized", "left_anti")
               .groupBy("name_normalized").agg(F.min_by("id", "first_message_id").alias("_winner")))
    return (upd.join(winners, "name_normalized", "left")
            .withColumn("alias_added", F.coalesce(F.col("_winner") == F.col("id"), F.lit(False)))
            .drop("_winner"))


# Suggest, phone path (I15): (kind, score); the partial tier reads any 4-10
# digit run inside an id phone or primary phone.
SUGGEST_PHONE_TIERS = [("idphone", 1.00), ("primary", 0.95), ("alias", 0.93), ("payout", 0.90), ("partial", 0.78)]
PARTIAL_MIN, PARTIAL_MAX = 4, 10


def _substrings(col: str, lo: int, hi: int):
    """Every substring of ``col`` with length in [lo, hi] (bounded by the
    phone's length: at most 35 for an 11-digit phone)."""
    n = F.length(col)
    starts = F.sequence(F.lit(1), F.greatest(n - lo + 1, F.lit(1)))
    return F.flatten(F.transform(starts, lambda i: F.transform(
        F.sequence(F.lit(lo), F.greatest(F.least(F.lit(hi), n - i + 1), F.lit(lo))),
        lambda ln: F.substring(col, i, ln))))


def suggest_phone(queries: DataFrame, employees: DataFrame, aliases: DataFrame, payments: DataFrame,
                  canonical: DataFrame | None = None) -> DataFrame:
    """I15 phone path: ``(query, employee_id, score)`` per canonical employee
    with the best score over the tiers (no status filter, as the source).

    A query's digits are its Unicode decimal digits; it is phone-like with at
    least 4 digits and at most 3 other characters; the exact tiers use its
    normalised phone (F1, phone-like with at least 6 digits), the partial tier
    its last 10 digits (any query with at least 4). Every tier is one equi-join
    against a single lookup of ``(kind, key, id)``; the partial tier's keys
    are the phones' substrings, so "contains" needs no scan of all phones per
    query. A frequent key only multiplies rows for a query that asks for it,
    and those rows are that query's answer.
    """
    master = prepare_master(employees)
    raw = py_strip("query")
    digits = F.regexp_replace(raw, r"\P{Nd}", "")
    nd = F.length(digits)
    phone_like = (nd >= 4) & (nd >= F.length(raw) - 3)
    q = (queries.select("query").distinct()
         .select("query", F.when(phone_like & (nd >= 6), norm_phone(raw)).alias("_ph"),
                 F.when(nd >= 4, digits.substr(F.greatest(nd - (PARTIAL_MAX - 1), F.lit(1)), F.lit(PARTIAL_MAX)))
                 .alias("_tail")))
    probes = q.select("query", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col("_tail" if k == "partial" else "_ph").alias("key"),
                 F.lit(s).alias("score")) for k, s in SUGGEST_PHONE_TIERS])).alias("_p")) \
        .where(F.col("_p.key").isNotNull()).select("query", "_p.kind", "_p.key", "_p.score")
    phones = master.select("id", F.array("employee_id_phone", "primary_phone").alias("_phs"))
    lookup = (master.select(F.lit("idphone").alias("kind"), F.col("employee_id_phone").alias("key"), "id")
              .unionByName(master.select(F.lit("primary").alias("kind"), F.col("primary_phone").alias("key"), "id"))
              .unionByName(aliases.where(F.col("alias_type") == "phone")
                           .select(F.lit("alias").alias("kind"), F.col("alias_value").alias("key"),
                                   F.col("employee_id").alias("id")))
              .unionByName(payments.where(F.col("employee_id").isNotNull())
                           .select(F.lit("payout").alias("kind"), F.col("payout_phone").alias("key"),
                                   F.col("employee_id").alias("id")))
              .unionByName(phones.select("id", F.explode("_phs").alias("_v")).where(F.col("_v").isNotNull())
                           .select(F.lit("partial").alias("kind"),
                                   F.explode(_substrings("_v", PARTIAL_MIN, PARTIAL_MAX)).alias("key"), "id"))
              .where(F.col("key").isNotNull()).distinct())
    hits = probes.join(lookup, ["kind", "key"])
    canon = (canonical if canonical is not None else resolve_canonical(master)) \
        .select(F.col("id").alias("_cid"), F.col("canonical_id").alias("employee_id"))
    return (hits.join(canon, hits.id == canon._cid).groupBy("query", "employee_id")
            .agg(F.max("score").alias("score")))


# Suggest, substring tiers of the name path (I15): (form, score, query form,
# shortest query). "name" is the lower-cased full name; the c-forms keep only
# a-z0-9 (full name, name alias, raw name on a payment).
SUGGEST_SUBSTRING_TIERS = [("name", 0.70, "low", 1), ("cname", 0.72, "coll", 3),
                           ("calias", 0.71, "coll", 3), ("craw", 0.74, "coll", 3)]


def _collapsed_sql(c: Column) -> Column:
    return F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", "")


def _grams(col: str, n: int) -> Column:
    """All substrings of length ``n`` of ``col`` (empty when shorter)."""
    return F.transform(F.sequence(F.lit(1), F.greatest(F.length(col) - n + 1, F.lit(0))),
                       lambda i: F.substring(col, i, n))


def suggest_substring(queries: DataFrame, employees: DataFrame, aliases: DataFrame, payments: DataFrame,
                      canonical: DataFrame | None = None, include_phone_like: bool = False) -> DataFrame:
    """I15 substring tiers: ``(query, employee_id, score)`` per canonical
    employee, for queries that are not phone-like (all queries with
    ``include_phone_like``, for the fall-through of a phone-like query with no
    phone hit); no status filter.

    "Value contains query" without a scan of all values per query: a query of
    three or more characters is joined on its rarest 3-gram (fewest values of
    that form hold it) to the values holding that gram, and the candidates are
    verified with ``contains``; shorter queries join an index of the values'
    one- and two-character substrings. A query's fan-out is then at most the
    number of values holding its rarest gram, which for a short query is its
    answer.
    """
    master = prepare_master(employees)
    full = F.col("full_name")
    values = (master.select(F.lit("name").alias("form"), F.lower(F.coalesce(full, F.lit(""))).alias("v"), "id")
              .unionByName(master.select(F.lit("cname").alias("form"), _collapsed_sql(full).alias("v"), "id"))
              .unionByName(aliases.where(F.col("alias_type") == "name")
                           .select(F.lit("calias").alias("form"), _collapsed_sql(F.col("alias_value")).alias("v"),
                                   F.col("employee_id").alias("id")))
              .unionByName(payments.where(F.col("employee_id").isNotNull())
                           .select(F.lit("craw").alias("form"), _collapsed_sql(F.col("employee_name_raw")).alias("v"),
                                   F.col("employee_id").alias("id")))
              .where(F.col("v") != "").distinct())
    distinct_v = values.select("form", "v").distinct()
    vgrams = distinct_v.select("form", "v", F.explode(F.array_distinct(_grams("v", 3))).alias("g"))
    df_g = vgrams.groupBy("form", "g").agg(F.count(F.lit(1)).alias("_df"))
    short = distinct_v.select("form", "v", F.explode(F.array_distinct(
        F.concat(_grams("v", 1), _grams("v", 2)))).alias("g"))

    raw = py_strip("query")
    nd = F.length(F.regexp_replace(raw, r"\P{Nd}", ""))
    phone_like = (nd >= 4) & (nd >= F.length(raw) - 3)
    q = (queries.select("query").distinct()
         .select("query", F.lower(raw).alias("_low"), collapse_text(raw).alias("_coll"), phone_like.alias("_pl"))
         .where((F.col("_low") != "") & (F.lit(include_phone_like) | ~F.col("_pl"))))
    probes = q.select("query", F.explode(F.array(*[
        F.struct(F.lit(form).alias("form"), F.lit(score).alias("score"),
                 F.col("_low" if qf == "low" else "_coll").alias("qv"), F.lit(m).alias("m"))
        for form, score, qf, m in SUGGEST_SUBSTRING_TIERS])).alias("_p")) \
        .select("query", "_p.form", "_p.score", "_p.qv", "_p.m").where(F.length("qv") >= F.col("m"))
    long_p = probes.where(F.length("qv") >= 3)
    pg = long_p.select("query", "form", "qv", F.explode(F.array_distinct(_grams("qv", 3))).alias("g")) \
        .join(df_g, ["form", "g"])
    rarest = pg.groupBy("query", "form", "qv").agg(F.min_by("g", F.struct("_df", "g")).alias("g"))
    long_hits = (rarest.join(vgrams, ["form", "g"]).where(F.col("v").contains(F.col("qv")))
                 .join(long_p, ["query", "form", "qv"]).select("query", "form", "v", "score"))
    short_hits = (probes.where(F.length("qv") < 3).join(short, (probes.form == short.form) & (probes.qv == short.g))
                  .select("query", probes.form, "v", "score"))
    hits = long_hits.unionByName(short_hits).join(values, ["form", "v"])
    canon = (canonical if canonical is not None else resolve_canonical(master)) \
        .select(F.col("id").alias("_cid"), F.col("canonical_id").alias("employee_id"))
    return (hits.join(canon, hits.id == canon._cid).groupBy("query", "employee_id")
            .agg(F.max("score").alias("score")))


# Suggest, trigram-scored tiers (I15): tier -> (minimum similarity, base,
# slope, cap); score = min(cap, base + slope * s).
SUGGEST_TRIGRAM_TIERS = {"name": (0.30, 0.40, 0.45, 0.85), "alias": (0.30, 0.38, 0.45, 0.83),
                         "raw": (0.40, 0.35, 0.40, 0.78)}


def suggest_trigram(queries: DataFrame, employees: DataFrame, aliases: DataFrame, payments: DataFrame,
                    canonical: DataFrame | None = None, include_phone_like: bool = False) -> DataFrame:
    """I15 trigram tiers: ``(query, employee_id, score)`` per canonical
    employee, for queries that are not phone-like with 3 or more characters
    (lower-cased or collapsed).

    s per (query, tier, employee) is the best pg_trgm similarity (F18) over
    the tier's forms: lower-cased text against the lower-cased query and
    collapsed text against the collapsed query (the lower-cased one when the
    collapse is empty); the name tier also reads the normal name. All the
    pairings run as one exact similarity join at t = 0.3 on distinct texts:
    each set's grams carry a namespace (L or C), so only like forms pair.
    """
    from ledgerflow.operators.similarity import similarity_join
    from ledgerflow.sources.scratch import stored
    master = prepare_master(employees)
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    vals = (master.select(F.lit("name").alias("tier"), F.lit("L").alias("ns"), low(F.col("full_name")).alias("t"), "id")
            .unionByName(master.select(F.lit("name").alias("tier"), F.lit("L").alias("ns"),
                                       F.coalesce("name_normalized", F.lit("")).alias("t"), "id"))
            .unionByName(master.select(F.lit("name").alias("tier"), F.lit("C").alias("ns"),
                                       _collapsed_sql(F.col("full_name")).alias("t"), "id")))
    al = aliases.where(F.col("alias_type") == "name").select(F.col("employee_id").alias("id"), "alias_value")
    vals = (vals.unionByName(al.select(F.lit("alias").alias("tier"), F.lit("L").alias("ns"), low(F.col("alias_value")).alias("t"), "id"))
            .unionByName(al.select(F.lit("alias").alias("tier"), F.lit("C").alias("ns"),
                                   _collapsed_sql(F.col("alias_value")).alias("t"), "id")))
    pr = payments.where(F.col("employee_id").isNotNull()).select(F.col("employee_id").alias("id"), "employee_name_raw").distinct()
    vals = (vals.unionByName(pr.select(F.lit("raw").alias("tier"), F.lit("L").alias("ns"), low(F.col("employee_name_raw")).alias("t"), "id"))
            .unionByName(pr.select(F.lit("raw").alias("tier"), F.lit("C").alias("ns"),
                                   _collapsed_sql(F.col("employee_name_raw")).alias("t"), "id"))
            .where(F.col("t") != "").distinct())
    vals = stored(vals, "name-texts")
    texts = vals.select(F.concat("ns", F.lit("|"), "t").alias("_rk"), "ns", "t").distinct()

    raw = py_strip("query")
    nd = F.length(F.regexp_replace(raw, r"\P{Nd}", ""))
    phone_like = (nd >= 4) & (nd >= F.length(raw) - 3)
    q = (queries.select("query").distinct()
         .select("query", F.lower(raw).alias("_low"), collapse_text(raw).alias("_coll"), phone_like.alias("_pl"))
         .where((F.lit(include_phone_like) | ~F.col("_pl")) & ((F.length("_low") >= 3) | (F.length("_coll") >= 3))))
    qt = (q.select("query", F.lit("L").alias("ns"), F.col("_low").alias("t"))
          .unionByName(q.select("query", F.lit("C").alias("ns"),
                                F.when(F.col("_coll") != "", F.col("_coll")).otherwise(F.col("_low")).alias("t")))
          .withColumn("_lk", F.concat("ns", F.lit("|"), "query")))
    pairs = similarity_join(qt, "_lk", F.col("t"), texts, "_rk", F.col("t"), threshold=0.3,
                            left_ns=F.col("ns"), right_ns=F.col("ns"))
    hits = (pairs.join(qt.select("_lk", "query"), "_lk")
            .join(vals.select(F.concat("ns", F.lit("|"), "t").alias("_rk"), "tier", "id"), "_rk")
            .groupBy("query", "tier", "id").agg(F.max("similarity").alias("s")))
    score = None
    for tier, (lo, base, slope, cap) in SUGGEST_TRIGRAM_TIERS.items():
        rule = F.when((F.col("tier") == tier) & (F.col("s") >= lo), F.least(F.lit(cap), F.lit(base) + F.lit(slope) * F.col("s")))
        score = rule if score is None else F.coalesce(score, rule)
    scored = hits.select("query", "id", score.alias("score")).where(F.col("score").isNotNull())
    canon = (canonical if canonical is not None else resolve_canonical(master)) \
        .select(F.col("id").alias("_cid"), F.col("canonical_id").alias("employee_id"))
    return (scored.join(canon, scored.id == canon._cid).groupBy("query", "employee_id")
            .agg(F.max("score").alias("score")))


SUGGEST_LIMIT = 8
SHOWN_ALIASES = 6


def phone_like(col: str = "query") -> Column:
    """A search text is phone-like with at least 4 digits and at most 3 other
    characters (after Python strip)."""
    raw = py_strip(col)
    nd = F.length(F.regexp_replace(raw, r"\P{Nd}", ""))
    return (nd >= 4) & (nd >= F.length(raw) - 3)


def suggest_rank(hits: DataFrame, queries: DataFrame, employees: DataFrame, aliases: DataFrame,
                 payments: DataFrame, k: int = SUGGEST_LIMIT, canonical: DataFrame | None = None) -> DataFrame:
    """I15 stages 2-4 over the tier hits ``(query, employee_id, score)``
    (employee_id canonical): best score per canonical employee (A17), display
    name (F10 over the full name and the members' sorted name aliases, then id
    phone, then ``#id``), totals over members (A7), the order of O6 (score
    rounded to 3 places desc, total paid desc, last activity asc with none
    first, then id) and the first ``k`` per query (N6).

    The cut is a salted two-phase top-k, so a query that matches a large
    share of all employees is ranked in many tasks. The alias list (U3) is
    built for the kept rows only: name aliases plus the members' raw payment
    names whose collapsed form holds the collapsed query, sorted, the display
    name removed, the first 6 shown; ``alias_count`` counts them all.
    ``payments`` needs ``is_reversal`` and ``employee_name_raw``.
    """
    from ledgerflow.functions.text import best_name
    from ledgerflow.operators.topk import top_k_per_group
    master = prepare_master(employees)
    canon = canonical if canonical is not None else resolve_canonical(master)
    mem = canon.select(F.col("id").alias("member_id"), "canonical_id")
    best = hits.groupBy("query", "employee_id").agg(F.max("score").alias("score"))
    pay = payments.where(~F.col("is_reversal"))
    tot = (pay.join(mem, pay.employee_id == mem.member_id).groupBy("canonical_id")
           .agg(F.sum("amount").alias("total_paid"), F.max("txn_date").alias("last_activity"),
                F.count(F.lit(1)).alias("total_transactions")))
    names = (aliases.where((F.col("alias_type") == "name") & F.col("alias_value").isNotNull())
             .join(mem, F.col("employee_id") == F.col("member_id"))
             .groupBy("canonical_id").agg(F.array_sort(F.collect_set("alias_value")).alias("_names")))
    root = master.select(F.col("id").alias("_rid"), "full_name", "employee_id_phone", "primary_phone", "status")
    c = (best.join(root, best.employee_id == root._rid)
         .join(names, best.employee_id == names.canonical_id, "left").drop("canonical_id")
         .join(tot, best.employee_id == tot.canonical_id, "left").drop("canonical_id"))
    c = c.select("query", "employee_id", "_names",
                 F.coalesce(best_name("full_name", "_names"), "employee_id_phone",
                            F.concat(F.lit("#"), F.col("employee_id").cast("string"))).alias("display_name"),
                 F.coalesce("employee_id_phone", "primary_phone").alias("mobile_number"), "status",
                 F.round("score", 3).alias("similarity"),
                 F.coalesce("total_paid", F.lit(0)).alias("total_paid"),
                 F.coalesce("total_transactions", F.lit(0)).alias("total_transactions"), "last_activity")
    top = top_k_per_group(c, ["query"], [F.col("similarity").desc(), F.col("total_paid").desc(),
                                         F.col("last_activity").asc_nulls_first(), F.col("employee_id")],
                          k, salt_of=F.col("employee_id"), rank_col="rank")
    qc = queries.select("query").distinct().select("query", collapse_text(py_strip("query")).alias("_qc"))
    raws = (payments.where(F.col("employee_name_raw").isNotNull())
            .join(mem, F.col("employee_id") == F.col("member_id"))
            .select(F.col("canonical_id").alias("_cid"), "employee_name_raw").distinct())
    kept = top.select("query", F.col("employee_id").alias("_cid")).join(qc, "query").where(F.length("_qc") >= 2)
    ra = (kept.join(raws, "_cid").where(_collapsed_sql(F.col("employee_name_raw")).contains(F.col("_qc")))
          .groupBy(F.col("query").alias("_q"), "_cid").agg(F.collect_set("employee_name_raw").alias("_raws")))
    out = top.join(ra, (F.col("query") == F.col("_q")) & (F.col("employee_id") == F.col("_cid")), "left").drop("_q", "_cid")
    empty = F.array().cast("array<string>")
    merged = F.array_sort(F.array_distinct(F.concat(F.coalesce("_names", empty), F.coalesce("_raws", empty))))
    out = out.withColumn("_merged", merged)
    shown = F.slice(F.filter("_merged", lambda x: x != F.col("display_name")), 1, SHOWN_ALIASES)
    return out.select("query", "rank", "employee_id", "display_name", "mobile_number", "status",
                      shown.alias("aliases"), F.size("_merged").alias("alias_count"), "similarity",
                      "total_paid", "total_transactions", "last_activity")


SEARCH_LIMIT = 20


def search_page(best: DataFrame, employees: DataFrame, k: int = SEARCH_LIMIT) -> DataFrame:
    """O5 over ``search`` results: per query, priority, then the canonical
    row's lower-cased full name (then id), first ``k``. A salted two-phase
    top-k, so a query hitting a large share of the employees (a shared alias)
    is ranked in many tasks."""
    from ledgerflow.operators.topk import top_k_per_group
    names = prepare_master(employees).select(F.col("id").alias("_eid"), F.lower(F.coalesce("full_name", F.lit(""))).alias("_lname"))
    j = best.join(names, best.employee_id == names._eid).drop("_eid")
    top = top_k_per_group(j, ["query"], [F.col("priority"), F.col("_lname"), F.col("employee_id")], k,
                          salt_of=F.col("employee_id"), rank_col="rank")
    return top.drop("_lname")
