"""Operators 3, 5, 6, 7 and 10."""
import collections
import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm_helpers import DOCS, sha
from pyspark.sql import functions as F

from ledgerflow.llm import chat_tree, decontaminate, divergence, hmm, toxicity
from ledgerflow.llm.common import read_table


@pytest.mark.parametrize("text", ["", "\\", "###", "####\\#", "</turn>", "<</turn></turn>", "\\### Assistant: </turn> ok", "a\\\n### user\n", "<\\/turn>", "#\\##"])
def test_escape_round_trip(text):
    assert chat_tree.unescape(chat_tree.escape(text)) == text
    assert "###" not in chat_tree.escape(text) and "</turn>" not in chat_tree.escape(text)
    for role in (text, "user"):
        assert chat_tree.parse_turn("".join(chat_tree.format_turn(role, text))) == (role, text)


def plain_conversations(rows):
    convs = {}
    for c, k, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(c, []).append((role or "", text or ""))
    out = []
    for c, turns in convs.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        out.append((c, len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss),
                    sum(len("".join(chat_tree.format_turn(r, t))) for r, t in turns)))
    return sorted(out, key=str)


def test_chat_tree(spark, tokenizers):
    rng = random.Random(4)
    rows = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"), (None, 0, "user", "x"),
            (90, None, None, None), (90, 3, "assistant", "<|endoftext|> é"), (91, 5, "user", "dup"), (91, 5, "user", "dup")]
    for c in range(40):
        for k in range(rng.randrange(1, 6)):
            rows.append((c, k, "assistant" if k % 2 else "user", rng.choice(["hello", "###", "same", "other"])))
    rows += [(95, k, "user", f"turn {k}") for k in range(600)] + [(96, k, "user", f"turn {k}") for k in range(601)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, k int").repartition(3)
    path = tokenizers.path("byte_bpe_50k.json")
    tree = chat_tree.write_tree(df, path)
    assert sorted((tuple(r) for r in chat_tree.read_conversations(spark, tree, path).collect()), key=str) == plain_conversations(rows)
    nodes = sorted(spark.read.parquet(tree.nodes).collect(), key=lambda r: r.start)
    paths = {}
    for r in spark.read.parquet(tree.paths).collect():
        paths.setdefault(r.conv_id, []).append((r.k, r.start))
    at = 0
    for n in nodes:                                  # one stream without gaps
        assert n.start == at
        at += n.length
    by_start = {n.start: n for n in nodes}
    table = chat_tree.byte_table(path)
    prefixes = set()
    for c, own in paths.items():
        before, text = [], b""
        for k, s in sorted(own):
            n = by_start[s]
            covered = [x for lo, hi in n.attend for x in range(lo, hi)]
            assert n.position == len(covered) and n.depth == k
            assert covered == [x for a in before for x in range(a.start, a.start + a.length)]
            before.append(n)
            text += b"".join(table[i] for i in n.ids)
            prefixes.add(text)
    assert len(prefixes) == len(nodes)               # shared turns are emitted once
    seen = []
    for n in nodes:                                  # depth first: a node follows its parent's subtree so far
        seen = seen[:n.depth - 1] + [n]
        assert [x for lo, hi in n.attend for x in range(lo, hi)] == [x for a in seen[:-1] for x in range(a.start, a.start + a.length)]


def test_chat_tree_empty(spark, tokenizers):
    path = tokenizers.path("byte_bpe_50k.json")
    tree = chat_tree.write_tree(spark.createDataFrame([], "conv_id long, turn long, role string, text string"), path)
    assert chat_tree.read_conversations(spark, tree, path).count() == 0


ENGLISH = ["the", "of", "and", "to", "in", "is", "that", "for", "it", "with"]


def plain_base(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    where = {}
    for i in range(len(words) - 4):
        where.setdefault(tuple(words[i:i + 5]), []).append(i)
    repeat = {j for v in where.values() if len(v) > 1 for i in v for j in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(repeat) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(repeat), failed)


def test_divergence(spark, small_docs):
    prose = [t for _, t in small_docs[1]]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate(prose)]
    rows += [(900, None, None, None, None), (901, "", "en", "", 0), (902, "a b c d e " * 40, "en", "", 0), (None, "é ß\x0bx y z", "xx", "", 0),
             (903, " ".join(f"w{i}###" for i in range(200)), "en", "", 0), (904, " ".join(f"$$%%{i}" for i in range(200)), None, "", 0)]
    rows += [rows[3], rows[3]]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOCS + ", _chars int").repartition(3)
    got = divergence.quality(df).collect()
    names = divergence.BASE + ["base_failed"]
    assert sorted(((r.doc_id, *(r[c] for c in names)) for r in got), key=str) == sorted(((d, *plain_base(t)) for d, t, *_ in rows), key=str)
    kept = {r.doc_id for r in got if r.kept}
    assert kept.isdisjoint({900, 901, 902, 903, 904})
    assert all(r.kept == (not r.base_failed) for r in got if (r.char_distance or 0) < 0.2 and (r.word_distance or 0) < 0.4)
    stay = divergence.keep_natural(df)
    assert stay.columns == df.columns
    assert Counter(r.doc_id for r in stay.collect()) == Counter(r.doc_id for r in got if r.kept)
    assert divergence.quality(spark.createDataFrame([], DOCS)).count() == 0


def test_divergence_without_common_words(spark):
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(4, 9)))
    text = lambda common: " ".join(rng.choice(ENGLISH) if rng.random() < common else word() for _ in range(300))
    rows = [(i, text(0.21), "en", "s", 1) for i in range(40)]
    rows += [(100, text(0), "en", "s", 1), (101, text(0.02), None, "s", 1), (102, text(0.12), "en", "s", 1), (103, " ".join(word() for _ in range(50)), "en", "s", 1)]
    got = {r.doc_id: r for r in divergence.quality(spark.createDataFrame(rows, DOCS)).collect()}
    assert all(not r.base_failed and (r.char_distance or 0) < 0.1 for r in got.values())
    assert {d for d, r in got.items() if not r.kept} == {100, 101}
    assert got[100].word_distance == 1 and got[103].word_distance is None
    # a reference without common words asks for none
    plain = spark.createDataFrame([(i, text(0), "en", "s", 1) for i in range(5)], DOCS)
    assert divergence.keep_natural(plain).count() == 5


def test_common_words_are_counted_over_all_documents(spark, monkeypatch):
    """Two hundred words in nearly as many documents each: the ten in most of them, also with few open buckets; copies count once."""
    rng = random.Random(5)
    pool = [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnprstv"]
    rows = [(k, " ".join(w for w in pool if rng.random() < 0.1) + (" Extra" if k % 3 else "")) for k in range(4_300)]
    df = spark.createDataFrame([(k, "xx", t) for k, t in rows + rows[:1] * 300], "doc_id long, _lang string, _t string")
    counts = collections.Counter(w for t in {t for _, t in rows} for w in set(t.lower().split()))
    want = sorted(sorted(counts, key=lambda w: (-counts[w], w))[:divergence.COMMON_WORDS])
    assert divergence.common_words(df, "_t") == {"xx": want}
    monkeypatch.setattr(divergence, "OPEN_BUCKETS", 3)
    assert divergence.common_words(df, "_t") == {"xx": want}


def test_common_words_do_not_hang_on_the_guess(spark, monkeypatch):
    """Few texts to guess from, many and none: the same words, counted over all texts, which are split into words once if the guess holds."""
    rng = random.Random(6)
    pool = [a + b + c for a in "bdfgk" for b in "aeiou" for c in "lmnprstv"]
    rows = [(k, " ".join([w for i, w in enumerate(pool) if rng.random() < (0.9 - 0.02 * i if i < 20 else 0.03)])) for k in range(600)]
    df = spark.createDataFrame([(k, "xx", t) for k, t in rows], "doc_id long, _lang string, _t string")
    counts = collections.Counter(w for t in {t for _, t in rows} for w in set(t.split()))
    want = sorted(sorted(counts, key=lambda w: (-counts[w], w))[:divergence.COMMON_WORDS])
    calls = []
    real = divergence._words
    monkeypatch.setattr(divergence, "_words", lambda c: calls.append(1) or real(c))
    assert divergence.common_words(df, "_t") == {"xx": want}
    assert len(calls) == 2          # the texts of the guess, then all
    for some in (1, 3, 20, 100):
        monkeypatch.setattr(divergence, "GUESS_TEXTS", some)
        assert divergence.common_words(df, "_t") == {"xx": want}


def test_repeats_sort_without_a_comparator_in_lambda_form(spark, small_docs):
    src = small_docs[0].selectExpr("doc_id", "lang AS _lang", "text AS _t")
    plan = divergence.with_features(src, "_t", ["the", "und"])._jdf.queryExecution().executedPlan().toString()
    assert "array_sort(" not in plan and "sort_array(" in plan


def test_divergence_languages_of_the_table(spark):
    """Any language with enough text is a reference; one without has no verdict; none named: compared with all."""
    rng = random.Random(12)
    words = {"en": (ENGLISH, "etaoinshrdlu"), "it": (["il", "che", "di", "e", "la", "per", "un", "non", "sono", "con"], "aeionlrtscdm"),
             "pl": (["się", "na", "że", "nie", "jest", "do", "to", "z", "w", "i"], "aioeznrwsłżę"), "eo": (["la", "kaj", "de", "estas"], "ĉĝĵŝŭaeion")}

    def text(lang, common, n=250):
        own, letters = words[lang]
        return " ".join(rng.choice(own) if rng.random() < common else "".join(rng.choice(letters) for _ in range(rng.randrange(4, 9))) for _ in range(n))

    rows = [(1000 * k + i, text(lang, 0.25), lang, "s", 1) for k, lang in enumerate(("en", "it", "pl")) for i in range(50)]
    rows += [(5000 + i, text("eo", 0.25), "eo", "s", 1) for i in range(5)]
    junk = [(6000, text("it", 0), "it", "s", 1), (6001, text("pl", 0), "pl", "s", 1), (6002, text("en", 0), None, "s", 1)]
    rows += [(6003, text("pl", 0.25), "it", "s", 1), (6004, text("it", 0.25), None, "s", 1), (6005, text("eo", 0), "eo", "s", 1)]
    df = spark.createDataFrame(rows + junk, DOCS).repartition(4)
    found = divergence.common_words(df.selectExpr("lang AS _lang", "text AS _t"), "_t")
    assert set(found) == {"en", "it", "pl"} and all(set(found[k]) == set(words[k][0]) for k in found)
    got = {r.doc_id: r for r in divergence.quality(df).collect()}
    assert {d for d, r in got.items() if not r.kept} == {r[0] for r in junk}
    assert got[5000].word_distance is None and got[6004].word_distance < 0.3


def test_divergence_is_native(spark, small_docs):
    src = small_docs[0].selectExpr("doc_id", "lang AS _lang", "text AS _t")
    assert divergence.common_words(src, "_t")
    plan = divergence.with_features(src, "_t", ["the", "und"])._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_recursions_by_enumeration(monkeypatch):
    monkeypatch.setattr(hmm, "BUCKETS", 5)
    rng, k = np.random.default_rng(0), 3
    m = hmm.Model(rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k)), rng.dirichlet(np.ones(k), k), rng.dirichlet(np.ones(5), k))
    sizes = np.array([3, 5, 1, 4])
    obs = rng.integers(0, 5, sizes.sum())
    starts, ordered, begins = hmm._stretches(sizes, None)
    loglik, _ = hmm.forward(m, obs, starts, ordered, begins, keep=False)
    first, moves, emits = np.zeros(k), np.zeros((k, k)), np.zeros((k, 5))
    for i, (s, n) in enumerate(zip(starts, ordered)):
        o, total, f, mv, e = obs[s:s + n], 0.0, np.zeros(k), np.zeros((k, k)), np.zeros((k, 5))
        for path in itertools.product(range(k), repeat=int(n)):
            p = m.start[path[0]] * m.emit[path[0], o[0]]
            for t in range(1, n):
                p *= m.move[path[t - 1], path[t]] * m.emit[path[t], o[t]]
            total += p
            f[path[0]] += p
            for t in range(n):
                e[path[t], o[t]] += p
            for t in range(1, n):
                mv[path[t - 1], path[t]] += p
        assert loglik[i] == pytest.approx(math.log(total))
        first, moves, emits = first + f / total, moves + mv / total, emits + e / total
    got = hmm.expected_counts(m, obs, starts, ordered, begins)
    for a, b in zip(got, (first, moves, emits)):
        assert np.allclose(a, b)


def test_hmm_base_and_score(spark, small_docs, monkeypatch):
    rows = small_docs[1] + [(None, "Null ID"), (7001, None), (7002, ""), (7003, "unseen-word-xyz The"), (7003, "unseen-word-xyz The")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, rid int").repartition(3)
    monkeypatch.setattr(hmm, "MAX_FREQUENT", 50)     # so that most words go through the join
    got = hmm.score(df, iterations=2).collect()
    toks = lambda t: [w.lower() for w in (t or "").encode().split()] + [b""]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2
    c = Counter(w for d, t in rows if not out(d) for w in toks(t))
    n, v = sum(c.values()), len(c)
    want = sorted((str(d), out(d), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 1) / (n + v + 1)) for w in ws), 6)) for d, t in rows for ws in [toks(t)])
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert sum(r.score for r in got) > sum(r.base_score for r in got)      # states know languages apart
    assert hmm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def edit_to_part(item, text):
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


def test_decontaminate(spark):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    items = [(i, " ".join(word() for _ in range(rng.randrange(8, 40)))) for i in range(12)] + [(50, None), (51, "short"), (52, "")]
    docs = [(0, None), (1, "")]
    for i in range(80):
        text = " ".join(word() for _ in range(60))
        if i % 2:
            part = list(rng.choice(items[:12])[1])
            for _ in range(rng.randrange(0, 20)):
                at = rng.randrange(len(part))
                part[at:at + rng.randrange(0, 2)] = rng.choice(["", "x", "yz"])
            text = text[:100] + " " + "".join(part).upper() + "\n " + text[100:]
        docs.append((10 + i, text))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int").repartition(3)
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.contaminated(df, bench).collect()}
    want = {}
    for d, t in docs:
        for i, x in items:
            own = decontaminate.normal(x)
            if len(own) >= decontaminate.MIN_CHARS and (e := edit_to_part(own, decontaminate.normal(t))) <= int(decontaminate.ERROR_RATE * len(own)):
                want[d, i] = e
    assert got == want and 0 < len(want) < 45
    kept = decontaminate.without_contaminated(df, bench)
    assert kept.columns == df.columns and {r.doc_id for r in kept.collect()} == {d for d, _ in docs} - {d for d, _ in want}
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.contaminated(df, empty).count() == 0 and decontaminate.without_contaminated(df, empty).count() == len(docs)


def test_decontaminate_short_items(spark):
    items = [(1, "Who wrote  Hamlet?"), (2, "pi is 3.14"), (3, " \n"), (4, None), (5, "x" * 30)]
    docs = [(1, "Quiz: who wrote\nHAMLET? Nobody knows."), (2, "who wrote hamlets?"), (3, "pi is 3.141"), (4, "so pi is 3.14, is it"), (5, "api is 3.14"),
            (6, "api is 3.14 but pi is 3.14"), (7, None), (8, " "), (9, "who wrote hamle?")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r.doc_id, r.item_id, r.distance) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == {(1, 1, 0), (4, 2, 0), (6, 2, 0)}
    assert {r.doc_id for r in decontaminate.without_contaminated(df, bench).collect()} == {2, 3, 5, 7, 8, 9}


def test_toxicity(spark):
    docs, labels = (read_table(spark, "/root/testdata/sf0.1", t) for t in ("documents", "labels"))
    got = {r.doc_id: r for r in toxicity.toxicity(docs, labels).collect()}
    assert len(got) == docs.count()
    held = [(r.toxic, got[r.doc_id]) for r in labels.collect() if got[r.doc_id].held_out]
    assert all(g.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= g.score <= 1 and g.predicted == (g.score >= 0.5) for d, g in got.items())
    right = sum(y == g.predicted for y, g in held) / len(held)
    hits = sum(y and g.predicted for y, g in held) / max(1, sum(y for y, _ in held))
    false = sum((not y) and g.predicted for y, g in held) / max(1, sum(not y for y, _ in held))
    assert right > 0.95 and hits > 0.75 and false < 0.02, (right, hits, false)


def test_toxicity_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (4, "idiot idiot"), (4, "idiot idiot")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in toxicity.toxicity(docs, none).collect()] == [0.5] * 5
    some = spark.createDataFrame([(1, 0), (2, None), (4, 1), (4, 0), (9, 1)], "doc_id long, toxic int")
    assert toxicity.toxicity(docs, some).count() == 5
    assert toxicity.toxicity(docs.limit(0), some).count() == 0


def test_ftrl_against_a_plain_one(spark):
    """The updates, and the query's scores, against FTRL written out coordinate by coordinate."""

    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(rng.choice(vocab) for _ in range(rng.randrange(0, 25)))) for i in range(120)] + [(500, None), (501, "")]
    toxic = {i: int("w7" in (t or "").split() or "w9 w3" in (t or "")) for i, t in rows}
    fold = lambda i: zlib.crc32(str(i).encode()) % toxicity.FOLDS
    at, doc = toxicity.features([t for _, t in rows])
    own = {i: sorted(set(at[doc == k].tolist())) + [1 << toxicity.BITS] for k, (i, _) in enumerate(rows)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(i, y) for i, y in toxic.items()], "doc_id long, toxic int")
    order = [r.doc_id for r in docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.xxhash64("doc_id").alias("o")).orderBy("o", "doc_id").collect() if fold(r.doc_id) != toxicity.HELD_OUT]
    z, n = {}, {}

    def weight(f):
        if abs(z.get(f, 0.0)) <= toxicity.L1:
            return 0.0
        return -(z[f] - math.copysign(toxicity.L1, z[f])) / ((toxicity.BETA + math.sqrt(n.get(f, 0.0))) / toxicity.ALPHA + toxicity.L2)

    for _ in range(toxicity.PASSES):
        for i in order:
            w = {f: weight(f) for f in own[i]}
            g = 1 / (1 + math.exp(-max(-35.0, min(35.0, sum(w.values()))))) - toxic[i]
            for f in own[i]:
                had = n.get(f, 0.0)
                z[f] = z.get(f, 0.0) + g - (math.sqrt(had + g * g) - math.sqrt(had)) / toxicity.ALPHA * w[f]
                n[f] = had + g * g
    want = {f: weight(f) for f in z if weight(f)}
    got = dict(toxicity.train(docs, labels))
    assert got.keys() == want.keys() and len(want) > 3 and all(abs(got[f] - want[f]) < 1e-9 for f in want)
    clash = docs.withColumnRenamed("text", "TEXT").withColumn("score", F.lit(1)).withColumn("toxic", F.lit("x"))
    for r in toxicity.toxicity(clash, labels).collect():
        total = sum(want.get(f, 0.0) for f in own[r.doc_id])
        assert abs(r.score - 1 / (1 + math.exp(-total))) < 1e-9 and r.held_out == (fold(r.doc_id) == 0) and r.predicted == int(r.score >= 0.5)
