"""Quality rules: distribution divergence from language references (operator 5, DataFrame functions only).

Each document has two histograms: characters by class (lower-case ASCII, other
lower-case letters, upper case, white space, digits, common punctuation,
anything else) and words by common word (those of all reference languages, and
all others). The table names its languages itself: every value of lang that has
at least ``REFERENCE_DOCS`` documents and ``REFERENCE_SHARE`` of all, hence at
most 1 / REFERENCE_SHARE of them, is a reference language. Its common words are
the ``COMMON_WORDS`` words found in most of the distinct texts that name it, and
its reference is the sum of the histograms of all documents that name it.

A document's verdict: the Jensen-Shannon distance (square root of the
divergence in bits) of its character histogram to the nearest reference is at
most ``MAX_CHAR_DISTANCE``, and its word distance to the nearest at most
``MAX_WORD_DISTANCE``. The word distance is the larger of two numbers: the
Jensen-Shannon distance of the word histograms, and the lack of common words,
1 - d(text) / d(reference), where d is the distance to the histogram of a text
without any common word. That histogram lies at only 0.34 from a reference
with a fifth of common words, less than natural text of a language that the
reference mixes with others, so the first number alone cannot tell it; its
lack is 1 for every reference. A document that names a language without a
reference has no verdict of either kind, as nothing tells what its characters
and words should be; one that names none is compared with all. Guards: texts with fewer than ``MIN_CHARS`` characters
have no character verdict and texts with fewer than ``MIN_WORDS`` words no
word verdict, since short samples diverge by chance. The nearest of all
references counts, as the language column may be null or wrong.

Base counts (words are runs of characters other than space and U+0009-U+000D):
see ``with_features``. Every step is a projection: nothing is shuffled but counts by
language and word bucket, by word of a few buckets, and the reference sums (one row per language and task).

Defined cases: null text: no words, zero counts, rejected by the base rule;
without any reference every document passes the divergence rule; repeated rows
are judged each; texts of any length are read whole; an empty table gives no
rows; columns other than doc_id, lang and text are not read, and clash with
none of the operator's own.
"""
from __future__ import annotations

from functools import reduce
from math import log2, sqrt
from string import ascii_lowercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import written
from ledgerflow.operators.topk import top_k_per_group

SPACE = r"[\x20\x09-\x0D]+"
SPACES = [" ", "\t", "\n", "\x0b", "\x0c", "\r"]
SYMBOLS = list("#*$%&|<>")
WINDOW = 5
MIN_BASE_WORDS = 10
MAX_REPEAT_PERCENT = 20
MIN_CHARS = 200
MIN_WORDS = 60
MAX_CHAR_DISTANCE = 0.25
MAX_WORD_DISTANCE = 0.45
COMMON_WORDS = 10
WORD_BUCKETS = 16_384
OPEN_BUCKETS = 48
GUESS_TEXTS = 8_192
REFERENCE_DOCS = 20
REFERENCE_SHARE = 0.005
NO_LETTERS = r"[^\p{L}]+"


def _count(text: Column, needle: str) -> Column:
    """Occurrences of one ASCII character."""
    return F.octet_length(text) - F.octet_length(F.replace(text, F.lit(needle), F.lit("")))


def _total(columns: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


CLASSES = ["lower_ascii", "lower_other", "upper", "space", "digit", "punctuation", "other"]
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _added(column: Column) -> Column:
    return F.aggregate(column, F.lit(0).cast("long"), lambda acc, x: acc + x)


def _words(text: Column) -> Column:
    """The distinct words of a text."""
    return F.array_distinct(F.array_remove(F.split(F.lower(text), NO_LETTERS), ""))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(WORD_BUCKETS)).cast("int")


def common_words(docs: DataFrame, text: str) -> dict[str, list[str]]:
    """The reference languages of a table with _lang, and for each the ``COMMON_WORDS`` words in most
    of its distinct texts, ties to the first in order; counted over all of them.

    No table of all words of the corpus is built and all texts are split into words once. Which words get a
    bucket of their own is guessed first (the ``OPEN_BUCKETS`` commonest in about ``GUESS_TEXTS`` texts); the
    guess decides no result. Then all texts are read: the guessed words are counted, a text once, and
    all other words by word bucket (``WORD_BUCKETS`` a language), whose count bounds that of each of its words.
    Where the last common word among the guessed is in no more texts than a bucket counts, the words of
    all buckets that reach it are counted too.
    """
    n_docs = docs.count()
    least = F.greatest(F.lit(REFERENCE_DOCS), F.lit(REFERENCE_SHARE) * n_docs)
    sizes = docs.where(F.col("_lang").isNotNull()).groupBy("_lang").agg(F.count(F.lit(1)).alias("_docs")).where(F.col("_docs") >= least)
    found = sorted(r["_lang"] for r in sizes.collect())         # at most 1 / REFERENCE_SHARE rows
    if not found:
        return {}
    own = docs.where(F.col("_lang").isin(found)).select("_lang", F.col(text).alias("_s"), F.xxhash64(text).alias("_h"))

    def words_of(texts: DataFrame) -> DataFrame:
        return texts.select("_lang", "_h", F.explode(_words(F.col("_s"))).alias("_w"))

    def top(words: DataFrame, k: int) -> dict[str, list]:
        counts = words.select("_lang", "_h", "_w").distinct().groupBy("_lang", "_w").agg(F.count(F.lit(1)).alias("_n"))
        best = top_k_per_group(counts, ["_lang"], [F.desc("_n"), F.asc("_w")], k, salt_of=F.col("_w"))
        out: dict[str, list] = {lang: [] for lang in found}
        for r in best.select("_lang", "_w", "_n").collect():
            out[r["_lang"]].append((r["_w"], r["_n"]))
        return out

    some = top(words_of(own.where(F.pmod("_h", F.lit(max(1, n_docs // GUESS_TEXTS))) == 0)), OPEN_BUCKETS)
    own_guess = [(F.col("_lang") == lang) & F.col("_w").isin([w for w, _ in some[lang]]) for lang in found if some[lang]]
    guessed = reduce(lambda a, b: a | b, own_guess, F.lit(False))
    # a row for each text of a guessed word, else for each bucket
    rows = words_of(own).select("_lang", F.when(guessed, F.col("_w")).alias("_g"), F.when(guessed, F.col("_h")).alias("_h"),
                                F.when(~guessed, _bucket(F.col("_w"))).alias("_b"))
    rows = rows.groupBy("_lang", "_g", "_h", "_b").agg(F.count(F.lit(1)).alias("_n"))
    counts = written(rows.groupBy("_lang", "_g", "_b").agg(F.sum(F.when(F.col("_g").isNotNull(), 1).otherwise(F.col("_n"))).alias("_n")), "word-counts")
    out: dict[str, list] = {lang: [] for lang in found}
    for r in counts.where(F.col("_g").isNotNull()).collect():     # at most OPEN_BUCKETS a language
        out[r["_lang"]].append((r["_g"], r["_n"]))
    first = lambda pairs: sorted(pairs, key=lambda x: (-x[1], x[0]))[:COMMON_WORDS]
    out = {lang: first(pairs) for lang, pairs in out.items()}
    # of these languages a bucket may hold a word that is as common as the last
    last = {lang: min(n for _, n in out[lang]) if len(out[lang]) == COMMON_WORDS else 0 for lang in found}
    buckets = counts.where(F.col("_g").isNull())
    fullest = {r["_lang"]: r["_n"] for r in buckets.groupBy("_lang").agg(F.max("_n").alias("_n")).collect()}
    short = [lang for lang in found if lang in fullest and fullest[lang] >= last[lang]]
    if short:
        reach = F.try_element_at(F.create_map(*[F.lit(x) for lang in short for x in (lang, last[lang])]), F.col("_lang"))
        more = buckets.where(F.col("_lang").isin(short) & (F.col("_n") >= reach)).select("_lang", "_b")
        others = words_of(own.where(F.col("_lang").isin(short))).where(~guessed).withColumn("_b", _bucket(F.col("_w")))
        for lang, pairs in top(others.join(F.broadcast(more), ["_lang", "_b"], "left_semi"), COMMON_WORDS).items():
            out[lang] = first(out[lang] + pairs)
    return {lang: sorted(w for w, _ in out[lang]) for lang in found}


def with_features(docs: DataFrame, text: str, common: list[str]) -> DataFrame:
    """Adds the base counts (``BASE``, with an underscore), _chars (characters by class) with their
    sum _n_chars, and _common (the words ``common``, then all other words) with their sum _n_tokens.

    Classes are counted by taking them out of the text one after the other,
    whole runs at a time, so each step reads only what the steps before left.

    _n_repeat_words: the hashes of all windows of five words (three hashed pairs each) go through a hash
    set; only where one repeats are (hash, place) pairs sorted, neighbours of
    equal hash marked and the words that their windows cover added up.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    blank = "".join(SPACES)
    taken_out = [lambda c: F.translate(c, ascii_lowercase, ""), lambda c: F.translate(c, blank, ""),
                 *[lambda c, x=x: F.regexp_replace(c, x, "") for x in (r"\p{Ll}+", r"\p{Lu}+", "[0-9]+", r"[.,;:!?'\"()\-]+")]]
    out, before, counts = docs, t, []
    for k, step in enumerate(taken_out):
        out = out.withColumn(f"_r{k}", step(before))
        counts.append((F.length(before) - F.length(F.col(f"_r{k}"))).cast("long"))
        before = F.col(f"_r{k}")
    lower, space, other_lower, upper, digit, punctuation = counts
    out = out.withColumns({
        "_chars": F.array(lower, other_lower, upper, space, digit, punctuation, F.length(before).cast("long")),
        "_word_chars": F.length(t) - space,
        "_n_symbols": _total([_count(F.col("_r5"), c) for c in SYMBOLS]).cast("long"),
        "_words": F.array_remove(F.split(t, SPACE), ""),
        "_lines": F.filter(F.split(t, "\n"), lambda x: F.length(F.btrim(x, F.lit(blank))) > 0),
        "_tokens": F.split(F.lower(t), NO_LETTERS),
    })
    out = out.withColumns({
        "_n_words": F.size("_words").cast("long"),
        "_n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        # each word with the next: a window is three pairs
        "_h": F.transform("_words", lambda w, i: F.xxhash64(w, F.get("_words", i + 1))),
        # two spaces between words, so that each has its own at both sides
        "_hits": F.concat(F.lit(" "), F.array_join(F.filter("_tokens", lambda w: w.isin(common)), "  "), F.lit(" ")),
        "_n_tokens": F.size(F.array_remove("_tokens", "")).cast("long"),
    })
    known = [(F.octet_length("_hits") - F.octet_length(F.replace(F.col("_hits"), F.lit(f" {w} "), F.lit("")))) / F.lit(len(w.encode("utf-8")) + 2) for w in common]
    out = out.withColumn("_known", F.array(*[c.cast("long") for c in known]) if known else F.array().cast("array<bigint>"))
    out = out.withColumn("_common", F.concat("_known", F.array(F.col("_n_tokens") - _added(F.col("_known")))))
    h = F.col("_h")
    out = out.withColumn("_wins", F.transform(
        F.slice(h, 1, F.greatest(F.size(h) - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(2, WINDOW - 1)])))
    repeats = F.size(F.array_distinct("_wins")) < F.size("_wins")
    out = out.withColumn("_pairs", F.when(repeats, F.sort_array(F.transform("_wins", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))))
    marked = F.zip_with("_pairs", F.slice("_pairs", 2, F.size("_pairs")),
                        lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    out = out.withColumn("_places", F.sort_array(F.array_distinct(F.flatten(F.filter(marked, lambda x: x.isNotNull())))))
    steps = F.zip_with("_places", F.slice("_places", 2, F.size("_places")), lambda a, b: F.least(b - a, F.lit(WINDOW)))
    out = out.withColumn("_n_repeat_words", F.when(F.col("_places").isNull(), F.lit(0).cast("long")).otherwise(_added(steps)))
    out = out.withColumn("_n_chars", F.length(t).cast("long"))
    return out.drop("_words", "_lines", "_tokens", "_hits", "_known", "_h", "_wins", "_pairs", "_places", *[f"_r{k}" for k in range(6)])


def references(features: DataFrame, languages: list[str], n_common: int) -> dict[str, tuple[list[float], list[float]]]:
    """For each of the languages: its character and word distributions.

    ``features`` has _lang, _chars and _common; one row for each language comes back.
    """
    if not languages:
        return {}
    sums = features.where(F.col("_lang").isin(languages)).groupBy("_lang").agg(
        F.array(*[F.sum(F.get("_chars", F.lit(k))) for k in range(len(CLASSES))]).alias("chars"),
        F.array(*[F.sum(F.get("_common", F.lit(k))) for k in range(n_common + 1)]).alias("words"))
    shares = lambda counts: [c / total for c in counts] if (total := sum(counts)) else None
    found = {r["_lang"]: (shares(r["chars"]), shares(r["words"])) for r in sums.collect()}
    return {k: v for k, v in found.items() if v[0] and v[1]}


def _distance(counts: Column, total: Column, reference: list[float]) -> Column:
    """Jensen-Shannon distance of a histogram to a reference distribution."""
    def part(c: Column, q: Column) -> Column:
        p = c / total
        m = (p + q) / 2
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    terms = F.zip_with(counts, F.array(*[F.lit(float(q)) for q in reference]), part)
    return F.sqrt(F.greatest(F.aggregate(terms, F.lit(0.0), lambda a, x: a + x) / 2, F.lit(0.0)))


def _common_distance(share: float) -> float:
    """Jensen-Shannon distance of a word histogram with this share of common words to one without any."""
    rest = 1 - share / 2
    return sqrt(max(0.0, share + (1 - share) * log2((1 - share) / rest) - log2(rest)) / 2) if share < 1 else 1.0


def _word_distance(reference: list[float], bare: Column) -> Column:
    """The larger of the distance to the reference and the lack of common words; ``bare`` is the
    text's distance to the histogram without common words. A reference without them asks for none."""
    near = _distance(F.col("_common"), F.col("_n_tokens"), reference)
    own = _common_distance(sum(reference[:-1]))
    return F.greatest(near, 1 - bare / F.lit(own)) if own > 0 else near


def with_verdict(features: DataFrame, refs: dict[str, tuple[list[float], list[float]]],
                 max_char: float = MAX_CHAR_DISTANCE, max_word: float = MAX_WORD_DISTANCE,
                 min_chars: int = MIN_CHARS, min_words: int = MIN_WORDS) -> DataFrame:
    """Adds _char_distance and _word_distance (null under the length guards, and where the
    document names a language without a reference) and _natural."""
    def nearest(to: list[Column], n: str, least: int) -> Column:
        if not to:
            return F.lit(None).cast("double")
        judged = F.col("_lang").isNull() | F.col("_lang").isin(list(refs))
        return F.when(judged & (F.col(n) >= max(1, least)), F.least(*to) if len(to) > 1 else to[0])

    known = [refs[lang] for lang in sorted(refs)]
    bare = F.when(F.col("_n_tokens") > 0, _distance(F.col("_common"), F.col("_n_tokens"), [0.0] * (len(known[0][1]) - 1) + [1.0])) if known else F.lit(None)
    out = features.withColumn("_bare", bare)
    out = out.withColumns({
        "_char_distance": nearest([_distance(F.col("_chars"), F.col("_n_chars"), chars) for chars, _ in known], "_n_chars", min_chars),
        "_word_distance": nearest([_word_distance(words, F.col("_bare")) for _, words in known], "_n_tokens", min_words)}).drop("_bare")
    fine = (F.coalesce(F.col("_char_distance") <= max_char, F.lit(True))
            & F.coalesce(F.col("_word_distance") <= max_word, F.lit(True)))
    return out.withColumn("_natural", fine)


def base_failed() -> Column:
    return (F.col("_n_words") < MIN_BASE_WORDS) | (F.col("_n_repeat_words") * 100 > F.col("_n_words") * MAX_REPEAT_PERCENT)


def _judged(src: DataFrame, limits: dict) -> DataFrame:
    """Features and verdicts of rows with _t and _lang. The features, some hundred numbers a document,
    are written to the shared folder once; references and verdicts read them, not the texts."""
    # texts may be long: fewer rows in a batch of the reader bound its vectors
    src.sparkSession.conf.set("spark.sql.parquet.columnarReaderBatchSize", "512")
    words = common_words(src, "_t")
    common = sorted({w for own in words.values() for w in own})
    features = written(with_features(src, "_t", common).drop("_t"), "quality")
    return with_verdict(features, references(features, list(words), len(common)), **limits)


def quality(docs: DataFrame, **limits) -> DataFrame:
    """doc_id, the base counts, base_failed, kept and both distances, a row for each document."""
    out = _judged(docs.select("doc_id", F.col("lang").cast("string").alias("_lang"), F.col("text").cast("string").alias("_t")), limits)
    return out.select("doc_id", *[F.col(f"_{c}").alias(c) for c in BASE], base_failed().alias("base_failed"),
                      (~base_failed() & F.col("_natural")).alias("kept"),
                      F.col("_char_distance").alias("char_distance"), F.col("_word_distance").alias("word_distance"))


def keep_natural(docs: DataFrame, **limits) -> DataFrame:
    """The documents that pass, all columns; no text is shuffled.

    Rows and features are written to the shared folder once, so the features
    are not computed again for the references and for the filter. The row
    travels as one struct, so no column of it can clash with the operator's own.
    """
    src = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    src = src.withColumns({"_t": F.col("_row.text").cast("string"), "_lang": F.col("_row.lang").cast("string")})
    return _judged(src, limits).where(~base_failed() & F.col("_natural")).select("_row.*")
