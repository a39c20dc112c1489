"""The pipeline's stages keep documents' columns and act on what the stage before kept."""
import math
import random
import re
from collections import Counter, defaultdict
from string import ascii_lowercase

from llm_helpers import DOCS
from test_dedup import brute_components, plain_fingerprint
from test_models import ENGLISH, edit_to_part, plain_base
from tokenizers import Tokenizer

from ledgerflow.llm import decontaminate, divergence, line_dedup, simhash
from ledgerflow.llm.common import read_table, written

import corpus_pipeline

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = read_table(spark, SF, "documents")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = written(stage(spark, docs, SF), "stage")
        assert after.columns == columns, name
        assert after.dtypes == docs.dtypes, name
        assert 0 < after.count() <= docs.count()
        docs = after
    assert docs.count() == docs.select("doc_id").distinct().count()
    packed = corpus_pipeline.run(spark, SF).collect()
    tokens = defaultdict(int)
    for r in packed:
        tokens[r.doc_id] += r.length
    assert set(tokens) == {r.doc_id for r in docs.collect()}
    assert all(tokens[r.doc_id] == r.doc_tokens for r in packed)


def test_extra_columns(spark):
    docs = read_table(spark, SF, "documents").selectExpr("*", "1 AS _row", "2 AS _did", "3 AS _drops", "4 AS n_lines", "5 AS fp")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = written(stage(spark, docs, SF), "stage")
        assert docs.columns == columns, name


def test_one_of_ten_copies_keeps_its_text(spark):
    rows = [(i, "first line\nsecond line", "en", "s", 22) for i in range(5, 17)] + [(1, "own", "en", "s", 3)]
    got = {r.doc_id: (r.text, r.n_chars) for r in corpus_pipeline.drop_lines(spark, spark.createDataFrame(rows, DOCS), SF).collect()}
    assert got == {1: ("own", 3), 5: ("first line\nsecond line", 22), **{i: ("", 0) for i in range(6, 17)}}


def distance(p, q):
    """Jensen-Shannon distance of two lists of counts."""
    p, q = ([x / sum(c) for x in c] for c in (p, q))
    return math.sqrt(max(0.0, sum(x * math.log2(x / ((a + b) / 2)) for a, b in zip(p, q) for x in (a, b) if x > 0) / 2))


def plain_quality(docs):
    def chars(t):
        kinds = [sum(c in ascii_lowercase for c in t), sum(c.islower() and c not in ascii_lowercase for c in t), sum(c.isupper() for c in t),
                 sum(c in " \t\n\x0b\x0c\r" for c in t), sum(c in "0123456789" for c in t), sum(c in ".,;:!?'\"()-" for c in t)]
        return [*kinds, len(t) - sum(kinds)]

    def tokens(t):
        return re.findall(r"[^\W\d_]+", (t or "").lower())

    having = Counter(w for t in docs.values() for w in set(tokens(t)))
    common = sorted(sorted(having, key=lambda w: (-having[w], w))[:divergence.COMMON_WORDS])

    def words(t):
        known = [tokens(t).count(w) for w in common]
        return [*known, len(tokens(t)) - sum(known)]
    seen = {d: (chars(t or ""), words(t or "")) for d, t in docs.items()}
    ref = [[sum(x) for x in zip(*(v[k] for v in seen.values()))] for k in (0, 1)]
    bare = [0] * len(common) + [1]
    out = {}
    for d, t in docs.items():
        c, w = seen[d]
        far = sum(c) >= divergence.MIN_CHARS and distance(c, ref[0]) > divergence.MAX_CHAR_DISTANCE
        if sum(w) >= divergence.MIN_WORDS:
            far |= max(distance(w, ref[1]), 1 - distance(w, bare) / distance(ref[1], bare)) > divergence.MAX_WORD_DISTANCE
        if not far and not plain_base(t)[-1]:
            out[d] = t
    return out


def plain_lines(docs):
    key = lambda line: line.encode().strip(line_dedup.EDGES).lower()
    having = defaultdict(set)
    for d, t in docs.items():
        for line in t.split("\n"):
            having[key(line)].add(d)
    out = {}
    for d, t in docs.items():
        stay, used = [], set()
        for line in t.split("\n"):
            k = key(line)
            if not k or len(having[k]) < line_dedup.MIN_DOCS or (d == min(having[k]) and k not in used):
                stay.append(line)
            used.add(k)
        out[d] = "\n".join(stay)
    return out


def plain_simhash(docs):
    rows = sorted(docs.items())
    first = {c for _, _, c in brute_components(rows, [plain_fingerprint(t) for _, t in rows], simhash.DISTANCE)}
    return {d: t for d, t in rows if d in first}


def test_stages_against_brute_force(spark, tokenizers, tmp_path):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(4, 9)))
    line = lambda n, common=0.25: " ".join(rng.choice(ENGLISH) if rng.random() < common else word() for _ in range(n))
    text = lambda n=8, common=0.25: "\n".join(line(12, common) for _ in range(n))
    docs = {i: text() for i in range(25)}
    copied = [text(), text(12)]
    docs |= {100 + i: copied[0] for i in range(12)} | {200 + i: copied[1] for i in range(11)}
    docs |= {300 + i: text(4) + "\n  All rights Reserved by us \n" + text(4) for i in range(12)}
    docs |= {400 + i: copied[1] + "\n" + line(12) for i in range(3)}
    long = text(40)
    docs |= {500: long, 501: long + " again", 502: text(40)}
    items = [(i, line(20)) for i in range(3)] + [(7, "Who wrote it?")]
    docs |= {600: text() + "\n" + items[0][1].upper() + " more", 601: items[1][1].replace("e", "i", 2) + "\n" + text(), 602: text() + "\nwho wrote it?"}
    docs |= {700: text(8, 0), 701: None, 702: "", 703: " ".join(f"$$%%{i}" for i in range(200)), 704: "again and again " * 40}
    rows = [(d, t, "en", "s", len(t or "")) for d, t in docs.items()]
    rng.shuffle(rows)
    spark.createDataFrame(rows, DOCS).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))

    def plain_clean(docs):
        def holds(text, item):
            own = decontaminate.normal(item)
            if len(own) < decontaminate.MIN_CHARS:
                return re.search(rf"(?<!\w){re.escape(own)}", text)
            return edit_to_part(own, text) <= int(decontaminate.ERROR_RATE * len(own))
        return {d: t for d, t in docs.items() if not any(holds(decontaminate.normal(t), x) for _, x in items)}

    got, want = read_table(spark, str(tmp_path), "documents"), docs
    for (name, stage), plain in zip(corpus_pipeline.STAGES[:-1], (plain_quality, plain_lines, plain_simhash, plain_clean)):
        got, before, want = written(stage(spark, got, str(tmp_path)), "stage"), want, plain(want)
        assert sorted((r.doc_id, r.text, r.n_chars) for r in got.collect()) == sorted((d, t, len(t)) for d, t in want.items()), name
        assert want != before, name
    assert [d for d, t in want.items() if t == copied[0]] == [100] and [d for d, t in want.items() if t == copied[1]] == [200]
    tok = Tokenizer.from_file(tokenizers.path("byte_bpe_50k.json"))
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.doc_tokens for r in packed} == {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in want.items()}
