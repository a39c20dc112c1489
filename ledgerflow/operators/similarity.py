"""Trigram similarity (F18) and its join (J13) without an all-pairs product.

``trigrams`` follows pg_trgm: words are runs of letters and digits, each
padded with two blanks in front and one behind, and the set of 3-grams is
kept. Similarity is shared / union.

``similarity_join`` is exact for a Jaccard threshold t by prefix filtering.
Grams that one side lacks can't be shared and are left out of the keys. The
others are ordered by the pairs that they would bring together (rows of the left
times rows of the right, then text). A set of n grams that shares at least a of
its u usable grams with another has its first shared gram among the first
u - a + 1, the second among one more, and so on; a follows from t, n and the
smallest set of the other side. Grams that bring few pairs together are keys of
their own. Those that bring together more than the input allows for are keys
only in threes (fewer where so few need be shared, or where threes were too many), so a gram that half of the
rows have joins no half with a half. Candidates are verified on the full sets.
"""
from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.operators.ids import dense_ids
from ledgerflow.sources.scratch import stored


MATCH_THRESHOLD = 0.3
PAIRS_A_ROW = 20
KEYS_A_SET = 100


def trigrams(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    words = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))

    def grams(w):
        pad = F.concat(F.lit("  "), w, F.lit(" "))
        return F.transform(F.sequence(F.lit(1), F.length(pad) - 2), lambda i: F.substr(pad, i, F.lit(3)))

    return F.array_distinct(F.flatten(F.transform(words, grams)))


def similarity(a: Column, b: Column) -> Column:
    """F18 on two gram arrays."""
    shared = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - shared
    return F.when(union > 0, shared / union).otherwise(F.lit(0.0))


def _least_shared(n: Column, smallest: int, t: float) -> Column:
    """Grams that a set of ``n`` shares at least with any set of ``smallest`` grams or more that is similar enough."""
    other = F.greatest(F.lit(smallest), F.ceil(F.lit(t) * n - F.lit(1e-9)))
    return F.ceil(F.lit(t) * (n + other) / F.lit(1 + t) - F.lit(1e-9)).cast("int")


def _ordered(sets: DataFrame, key: str, ranks: DataFrame, rare: int, smallest: int, t: float) -> DataFrame:
    """Per set with enough usable grams to be similar to any other: their ranks, ascending (``_all``), how many grams it has (``_n``),
    how many it shares at least (``_a``), and how many of its ranks are rare (``rare`` or less)."""
    ex = sets.select(key, F.size("_grams").alias("_n"), F.explode("_grams").alias("_g")).join(ranks, "_g")
    per = ex.groupBy(key).agg(F.array_sort(F.collect_list("_rank")).alias("_all"), F.max("_n").alias("_n"),
                              F.count(F.when(F.col("_rank") <= rare, True)).cast("int").alias("_rares"))
    per = per.withColumn("_a", _least_shared(F.col("_n"), smallest, t))
    return per.where(F.size("_all") >= F.col("_a"))


def _keys(per: DataFrame, depth: int) -> DataFrame:
    """The keys of each set as ``_k1`` to ``_k3`` (0: none), with the ranks from the key's first on that a set
    can share if it shares the key first (``_reach``): its rare ranks by themselves, and ordered combinations of the
    others in each length from what the set must share, up to ``depth``: two sets meet in the length that both must share."""
    u, a = F.size("_all"), F.col("_a")
    at = lambda first, last: F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))  # noqa: E731  (positions from 1)
    rank = lambda i: F.element_at("_all", i)
    key = lambda *at: F.struct(*[(rank(at[c]) if c < len(at) else F.lit(0)).alias(f"_k{c + 1}") for c in range(3)],
                               (u - at[-1] + len(at)).alias("_reach"))
    first = u - a + 1
    frequent = lambda a: at(F.col("_rares") + 1, u - a + 1)
    a2, a3 = F.greatest(a, F.lit(2)), F.greatest(a, F.lit(3))
    singles = F.transform(at(F.lit(1), F.when((a < 2) | F.lit(depth == 1), first).otherwise(F.least(first, F.col("_rares")))), lambda i: key(i))
    twos = F.flatten(F.transform(frequent(a2), lambda i: F.transform(at(i + 1, u - a2 + 2), lambda j: key(i, j))))
    threes = F.flatten(F.transform(frequent(a3), lambda i: F.flatten(F.transform(
        at(i + 1, u - a3 + 2), lambda j: F.transform(at(j + 1, u - a3 + 3), lambda k: key(i, j, k))))))
    parts = [singles, F.when((a < 3) | F.lit(depth == 2), twos), threes][:depth]
    return per.select("*", F.explode(F.concat(*[F.coalesce(x, F.array().cast("array<struct<_k1:int,_k2:int,_k3:int,_reach:int>>")) for x in parts])).alias("_k")) \
        .select(*per.columns, "_k._k1", "_k._k2", "_k._k3", "_k._reach")


def _depth(*sides: DataFrame) -> int:
    """How many frequent grams make a key: three, unless the sets would then have more than ``KEYS_A_SET`` such keys on average."""
    run = lambda d: F.greatest(F.size("_all") - F.greatest(F.col("_a"), F.lit(d)) + 1 - F.col("_rares"), F.lit(0)).cast("double")
    two, three = run(2), run(3)
    means = [s.agg(F.avg(two * (two + 1) / 2), F.avg(three * (three + 1) * (three + 2) / 6)).first() for s in sides]
    fits = [max(m[d] or 0 for m in means) <= KEYS_A_SET for d in (0, 1)]
    return 3 if fits[1] else 2 if fits[0] else 1


def _rare_below(freq: DataFrame, rows: int) -> int:
    """The pairs a gram may bring together to be rare: all rare grams together bring at most ``PAIRS_A_ROW`` a row.
    By powers of two, so the driver sees at most some 60 rows."""
    by = freq.groupBy(F.floor(F.log2("_f")).cast("int").alias("b")).agg(F.sum(F.col("_f").cast("double")).alias("pairs")).collect()
    total, below = 0.0, 0
    for r in sorted(by, key=lambda r: r["b"]):
        total += r["pairs"]
        if total > PAIRS_A_ROW * rows:
            break
        below = 2 ** (r["b"] + 1)
    return below


def _spaced(grams: Column, ns: Column | None) -> Column:
    """Grams prefixed with a namespace: sets of different namespaces share no
    gram, so one join scores several (form, form) pairings at once."""
    return grams if ns is None else F.transform(grams, lambda g: F.concat(ns, F.lit("|"), g))


def similarity_join(left: DataFrame, left_key: str, left_text: Column,
                    right: DataFrame, right_key: str, right_text: Column,
                    threshold: float = MATCH_THRESHOLD,
                    left_ns: Column | None = None, right_ns: Column | None = None) -> DataFrame:
    """All (left_key, right_key, similarity) with similarity >= threshold.

    Grams become integer ranks in the global order (dense ids over the gram
    vocabulary), so each set is a sorted int array. A candidate pair is kept at
    the first key that its sets share, so there is no distinct over the
    candidates and no re-join.
    """
    assert 0 < threshold <= 1
    lg = left.select(F.col(left_key).alias("_lk"), _spaced(trigrams(left_text), left_ns).alias("_grams")) \
             .where(F.size("_grams") > 0).dropDuplicates(["_lk"])
    rg = right.select(F.col(right_key).alias("_rk"), _spaced(trigrams(right_text), right_ns).alias("_grams")) \
              .where(F.size("_grams") > 0).dropDuplicates(["_rk"])
    # the gram sets feed the vocabulary and the keys, the ranks both sides:
    # each is computed once (a lost block is recomputed from lineage)
    lg, rg = lg.persist(StorageLevel.MEMORY_AND_DISK), rg.persist(StorageLevel.MEMORY_AND_DISK)
    count = lambda sets, f: sets.select(F.explode("_grams").alias("_g")).groupBy("_g").agg(F.count(F.lit(1)).alias(f))
    freq = count(lg, "_fl").join(count(rg, "_fr"), "_g").select("_g", (F.col("_fl") * F.col("_fr")).alias("_f"))
    # integer ranks in the global order (pairs, then gram). Both sides must
    # see the same ranks and the ids come from partition positions, so the
    # vocabulary is written once to the checkpoint directory (bounded by the
    # number of distinct grams) and read back by both sides.
    ranks = dense_ids(freq, [F.col("_f"), F.col("_g")], name="_rank").select("_g", F.col("_rank").cast("int").alias("_rank"), "_f").checkpoint()
    (n_left, least_left), (n_right, least_right) = (x.agg(F.count(F.lit(1)), F.coalesce(F.min(F.size("_grams")), F.lit(1))).first() for x in (lg, rg))
    rare = ranks.where(F.col("_f") < _rare_below(ranks, n_left + n_right)).count()      # their ranks are the first ones
    ranks = ranks.select("_g", "_rank")
    lo, ro = (stored(x, "gram-sets") for x in (_ordered(lg, "_lk", ranks, rare, least_right, threshold), _ordered(rg, "_rk", ranks, rare, least_left, threshold)))
    depth = _depth(lo, ro)
    side = lambda df, x: _keys(df, depth).select(f"_{x}k", *[F.col(f"_{c}").alias(f"_{x}{c}") for c in ("all", "n", "a", "reach")], "_k1", "_k2", "_k3")
    # The key rows are small, but the join emits every candidate pair: AQE would
    # coalesce the small input to a task or two and verify all pairs there. An
    # explicit key partitioning at the session's shuffle width is kept as is.
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lp, rp = (side(df, x).repartition(width, "_k1", "_k2", "_k3") for df, x in ((lo, "l"), (ro, "r")))
    nl, nr = F.col("_ln"), F.col("_rn")
    ratio = F.least(nl, nr) / F.greatest(nl, nr)
    need = F.lit(threshold) * (nl + nr) / F.lit(1 + threshold) - F.lit(1e-9)
    pairs = lp.join(rp, ["_k1", "_k2", "_k3"]).where((ratio >= threshold) & (F.least("_lreach", "_rreach") >= need))

    def verified(both):
        """The similarity at the first key that both have: the first shared rank if it is rare, else the first of the length that both must share."""
        shared = lambda i: F.coalesce(F.get(both, F.lit(i - 1)), F.lit(0))
        must = F.when(shared(1) <= rare, F.lit(1)).otherwise(F.least(F.greatest("_la", "_ra"), F.lit(depth)))
        first = (F.col("_k1") == shared(1)) & (F.col("_k2") == F.when(must >= 2, shared(2)).otherwise(0)) & (F.col("_k3") == F.when(must >= 3, shared(3)).otherwise(0))
        sim = F.size(both) / (nl + nr - F.size(both))
        return F.when(first & (sim >= threshold), sim)

    # in a lambda, as a filter moved below a projection would intersect the sets once for each time that they are named
    sim = F.get(F.transform(F.array(F.array_intersect("_lall", "_rall")), verified), F.lit(0))
    return (pairs.select(F.col("_lk").alias(left_key), F.col("_rk").alias(right_key), sim.alias("similarity"))
            .where(F.col("similarity").isNotNull()))


def best_match(pairs: DataFrame, key: str, other: str, score: str = "similarity") -> DataFrame:
    """The best ``other`` per ``key``: highest score, lowest id on ties."""
    return pairs.groupBy(key).agg(
        F.max_by(F.struct(F.col(score).alias("s"), (-F.col(other)).alias("neg")),
                 F.struct(F.col(score), -F.col(other))).alias("_b")
    ).select(key, (-F.col("_b.neg")).alias(other), F.col("_b.s").alias(score))
