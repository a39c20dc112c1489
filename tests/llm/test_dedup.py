"""Operators 2, 8 and 9 against brute force."""
import random
from collections import Counter, defaultdict

import numpy as np
import xxhash
from llm_helpers import sha

from ledgerflow.llm import line_dedup, seen_filter, simhash, suffix_dedup


def random_rows(n=200, seed=1):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice("abcdefgh \n") for _ in range(k))
    base = word(3000)
    return [(i, word(rng.randrange(0, 500)) + base[(x := rng.randrange(2000)):x + rng.randrange(100, 900)]) for i in range(n)]


EDGE = [(1, None), (2, ""), (3, "a" * 500), (4, "ab" * 300), (None, "xy" * 150), (6, "é" * 150), (7, "é" * 150), (7, "é" * 150)]


def brute_suffix(rows, length):
    seen = Counter(b[i:i + length] for _, t in rows for b in [(t or "").encode()] for i in range(len(b) - length + 1))
    out = defaultdict(list)
    for d, t in rows:
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = True
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[d].append((len(b), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), sha(kept)))
    return {k: sorted(v) for k, v in out.items()}


def run_suffix(df, **kw):
    out = defaultdict(list)
    for r in suffix_dedup.drop_repeats(df, **kw).collect():
        out[r.doc_id].append((r.n_bytes, r.n_removed, r.n_spans, sha(bytes(r.kept))))
    return {k: sorted(v) for k, v in out.items()}


def test_suffix_dedup(spark, small_docs):
    for rows in (EDGE, random_rows()):
        df = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, text string, seg int, gram int").repartition(3)
        assert run_suffix(df) == brute_suffix(rows, 200)
        assert run_suffix(df, hot=3) == brute_suffix(rows, 200)
    assert run_suffix(small_docs[0]) == brute_suffix(small_docs[1], 200)
    assert run_suffix(spark.createDataFrame([], "doc_id long, text string")) == {}


def test_suffix_dedup_counts_windows_of_large_parts(spark, monkeypatch):
    rng = random.Random(8)
    word = lambda k: "".join(rng.choice("abcdefgh ") for _ in range(k))
    shared = word(260)
    rows = [(i, word(rng.randrange(0, 300)) + shared + word(rng.randrange(0, 300))) for i in range(60)] + [(60, shared), (60, shared), (61, word(2000))]
    counted, real = [], suffix_dedup._counted_windows
    monkeypatch.setattr(suffix_dedup, "_counted_windows", lambda *a: counted.append(real(*a)) or counted[-1])
    assert run_suffix(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), hot=3) == brute_suffix(rows, 200)
    assert counted[0].count() > 0


def test_seen_filter(spark):
    keys = [random.Random(i).getrandbits(63) - (1 << 62) for i in range(3000)]
    twice, once = keys[:1000], keys[1000:2000]
    df = spark.createDataFrame([(k,) for k in twice + once + twice], "k long").repartition(5)
    draw = lambda batches: (b.column(0).to_numpy(zero_copy_only=False) for b in batches)
    bits = seen_filter.bits_for(3000)
    two, one = (seen_filter.seen(df, draw, bits, times) for times in (2, 1))
    assert seen_filter.passes(two, np.array(twice)).all() and seen_filter.passes(one, np.array(twice + once)).all()
    assert seen_filter.passes(two, np.array(keys[1000:])).mean() < 0.05 and seen_filter.passes(one, np.array(keys[2000:])).mean() < 0.05
    maybe = seen_filter.seen_rows(df, df.k)
    got = {r.k for r in spark.createDataFrame([(k,) for k in keys], "k long").where(maybe("k")).collect()}
    assert set(twice + once) <= got and len(got) < 2100


def test_blind_trie_orders():
    rng = random.Random(3)
    keys = ["".join(rng.choice("ab") for _ in range(12)).encode() for _ in range(300)]
    trie = suffix_dedup.BlindTrie()
    for i, k in enumerate(keys):
        trie.add(k).append(i)
    leaves = list(trie.ordered())
    assert [k for k, _ in leaves] == sorted(set(keys))
    assert all(keys[i] == k for k, ids in leaves for i in ids)


def brute_lines(rows, least):
    df = Counter(k for _, t in rows for k in set(line_dedup.line_keys((t or "").encode())) if k)
    out = []
    for d, t in rows:
        lines = (t or "").encode().split(b"\n")
        stay = [x for x in lines if df[x.strip(line_dedup.EDGES).lower()] < least]
        out.append((d, len(lines), len(lines) - len(stay), sha(b"\n".join(stay))))
    return sorted(out, key=str)


def test_line_dedup(spark, small_docs):
    rng = random.Random(5)
    lines = [f"line {i} é" for i in range(40)] + ["", "  ", "\t LINE 1 É", " Line 2 é\x0b"]
    rows = [(i if i % 17 else None, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 12)))) for i in range(150)] + [(1, None), (2, ""), (3, "x"), (3, "x")]
    for own, df in ((rows, spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id long, text string, line string, n_lines long").repartition(4)), small_docs[::-1]):
        for least in (2, 10, 40):
            out = line_dedup.drop_repeated_lines(df, least)
            n, gone = out.columns[-2:]
            got = sorted(((r.doc_id, r[n], r[gone], sha(r.text or "")) for r in out.collect()), key=str)
            assert got == brute_lines(own, least)


def test_line_dedup_keep_first(spark):
    rows = [(i, f"same\nown {i}\nsame") for i in range(5)]
    got = {r.doc_id: r.text for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), 2, keep_first=True).collect()}
    assert got == {0: "same\nown 0", **{i: f"own {i}" for i in range(1, 5)}}


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    h = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), seed=42) for i in range(max(1, len(words) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(rows, fps, distance):
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= distance:
                root[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        least[find(i)].append(d)
    return [(d, f, min((x for x in least[find(i)] if x is not None), default=None)) for i, ((d, _), f) in enumerate(zip(rows, fps))]


def test_simhash(spark, small_docs):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(50)]
    base = [rng.choice(words) for _ in range(150)]
    rows = [(None, "solo text of four"), (50, None), (51, ""), (52, "a b"), (53, "a b")]
    for i in range(120):
        own = list(base) if i % 2 else [rng.choice(words) for _ in range(80)]
        own[rng.randrange(len(own))] = "changed"
        rows.append((100 + i, " ".join(own)))
    for own, df in ((rows, spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, fp int").repartition(3)), small_docs[::-1]):
        fps = [plain_fingerprint(t) for _, t in own]
        for distance in (3, 5):
            got = [(r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in simhash.near_duplicates(df, distance=distance).collect()]
            assert sorted(got, key=str) == sorted(brute_components(own, fps, distance), key=str)
    kept = simhash.keep_first(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = {c for _, _, c in brute_components(rows, [plain_fingerprint(t) for _, t in rows], 3)}
    assert {r.doc_id for r in kept} == want and len(kept) == len(want)


def test_simhash_chunks(spark):
    """Files larger than a chunk are compared chunk by chunk."""
    rng = np.random.default_rng(2)
    fps = sorted({int(x) for x in (rng.integers(0, 1 << 62) ^ (1 << rng.integers(0, 60, 300)) ^ (1 << rng.integers(0, 60, 300)))})
    df = spark.createDataFrame([(x,) for x in fps], "fp long")
    groups = [(list(range(i, i + 16)), 0) for i in range(0, 64, 16)]
    edges = simhash.links(df, groups, 3, chunk=16)
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    rows = [(x, None) for x in fps]
    want = brute_components(rows, fps, 3)
    assert [(x, roots.get(x, x)) for x in fps] == [(d, c) for d, _, c in want]


def test_thresholds_cover():
    """Thresholds add up to distance - m + 1 whatever the costs are."""
    for m in simhash.PARTITIONS:
        _, ts = simhash.allocate([10.0 * (i + 1) for i in range(m)], [64 // m] * m, [[0.5] * (64 // m)] * m, 1000, 3)
        assert sum(ts) == 3 - m + 1 and min(ts) >= -1
