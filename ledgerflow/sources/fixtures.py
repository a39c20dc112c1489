"""Domain tables derived from the driver tables (FIXTURES.md §1).

The driver ships TPC-H-like ``customer`` and ``orders``; these builders turn
them into the engine's own inputs (employees, messages, payments, aliases,
message state, review items, the message store) with Spark expressions. The
same derivations, written as SQL, are the starting CTEs of the DuckDB oracle
(``ledgerflow.plans.oracle``), so both engines start from equal rows.

Each builder reads only the columns it needs, so the scans are pruned.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.functions.text import employee_code
from ledgerflow.sources.tables import read_table

LETTERS = "abcdefghij"
DIGITS = "0123456789"
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"

# The 13 message shapes of FIXTURES.md §1 (shape = o_orderkey % 13).
SHAPES = [
    "ID: %1$s %2$s %1$s(N) %3$s/-",
    "%2$s - +88%1$s ( B) = %3$s /-",
    "%2$s %1$s(cash) %3$s/-",
    "ID: %1$s\n%2$s- %1$s(B) %3$s/-",
    "%2$s %1$s %3$s/-",
    "%1$s %3$s/-",
    "%3$s/-",
    "Cash %1$s %2$s %3$s/-",
    "Income %1$s %2$s %3$s",
    "31/3/26=টোটাল বাকি =%3$s/-",
    "ok noted",
    "%2$s %1$s(N) %4$s/-",
    "%2$s (B) %3$s/-",
]


def _phone(key: Column, base: int) -> Column:
    return F.concat(F.lit("01"), F.lpad((F.lit(base) + key).cast("string"), 9, "0"))


def _word(key: Column) -> Column:
    return F.translate(F.lpad(key.cast("string"), 6, "0"), DIGITS, LETTERS)


def _source(key: Column) -> Column:
    m = key % 3
    return F.when(m == 0, "bridge1").when(m == 1, "bridge2").otherwise("meta")


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_employees: one employee per customer; keys ending 7, 8, 9 form a
    soft-link chain (9 -> 8 -> 7 -> 6); every 25th is inactive."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    k = F.col("c_custkey")
    return c.select(
        (k + 1).alias("id"),
        employee_code(k + 1).alias("employee_code"),
        F.concat(F.lower("c_mktsegment"), F.lit(" "), _word(k)).alias("full_name"),
        _phone(k, 700000000).alias("primary_phone"),
        F.when((k % 10).isin(7, 8, 9), k).cast("long").alias("canonical_employee_id"),
        F.when(k % 25 == 3, "inactive").otherwise("active").alias("status"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_messages: one chat message per order in 13 shapes (``o_orderkey % 13``).

    ``sender_phone`` is the chat's phone (what S4 resolves a phone JID to).
    """
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    k = F.col("o_orderkey")
    amt = F.floor("o_totalprice").cast("long").cast("string")
    ph = _phone(F.col("o_custkey"), 700000000)
    nm = F.concat(F.lit("emp "), _word(F.col("o_custkey")))
    # %1$s phone, %2$s name, %3$s amount, %4$s amount in Bengali digits
    templates = F.array(*[F.lit(x) for x in SHAPES])
    text = F.printf(F.try_element_at(templates, (k % 13 + 1).cast("int")),
                    ph, nm, amt, F.translate(amt, DIGITS, BENGALI_DIGITS))
    return o.select(
        (k + 1).alias("id"),
        F.concat(F.lit("M"), k.cast("string")).alias("wa_message_id"),
        _source(k).alias("source"),
        F.concat(F.lit("88"), ph, F.lit("@s.whatsapp.net")).alias("chat_jid"),
        ph.alias("sender_phone"),
        (k % 5 != 0).alias("is_from_me"),
        F.col("o_orderdate").alias("timestamp_wa"),
        text.alias("raw_content"),
    )


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_payments: posted payments for the report and ledger queries."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"])
    k = F.col("o_orderkey")
    m = k % 5
    d = F.to_date("o_orderdate")
    return o.select(
        (k + 1).alias("id"),
        (F.col("o_custkey") + 1).alias("employee_id"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
        F.when(m == 0, "bkash").when(m == 1, "nagad").when(m == 2, "cash")
         .when(m == 3, "rocket").otherwise("unknown").alias("payout_method"),
        d.alias("txn_date"),
        F.when(k % 7 == 0, "advance").otherwise("salary").alias("txn_category"),
        F.substring(d.cast("string"), 1, 7).alias("accounting_period"),
        (k % 17 == 0).alias("was_reversed"),
    )


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_aliases: a phone alias per employee and a name alias per segment."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey", "c_mktsegment"])
    k = F.col("c_custkey")
    phones = c.select((k + 1).alias("employee_id"), F.lit("phone").alias("alias_type"),
                      _phone(k, 800000000).alias("alias_value"))
    names = c.select((k + 1).alias("employee_id"), F.lit("name").alias("alias_type"),
                     F.concat(F.lit("al-"), F.lower("c_mktsegment")).alias("alias_value"))
    return phones.unionByName(names)


def message_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    k = F.col("o_orderkey")
    m = k % 8
    return o.select(
        (k + 1).alias("message_id"),
        F.when(m == 0, "pending").when(m == 1, "parsed").when(m == 2, "failed")
         .when(m == 3, "skipped").otherwise("done").alias("status"),
        (k % 7).cast("int").alias("attempts"),
        F.col("o_orderdate").alias("queued_at"),
    )


def review_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_totalprice", "o_orderdate"])
    k = F.col("o_orderkey")
    m3 = k % 3
    m4 = k % 4
    return o.select(
        (k + 1).alias("id"),
        (k + 1).alias("message_id"),
        F.when(m3 == 0, "accountant_other").when(m3 == 1, "cash_command_no_employee")
         .otherwise("accounting_failed").alias("reason"),
        F.when(m3 != 0, F.col("o_totalprice").cast("decimal(12,2)")).alias("detected_amount"),
        F.when(m3 != 0, (k % 11).cast("double") / 10).alias("parser_confidence"),
        F.when(m4 == 0, "promoted").when(m4 == 1, "dismissed").when(m4 == 2, "duplicate")
         .otherwise("pending").alias("review_status"),
        F.when(m4 != 3, F.to_date("o_orderdate")).alias("reviewed_at"),
    )


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_store: the message store a gap scan compares to the archive."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey"])
    k = F.col("o_orderkey")
    return o.select(
        F.concat(F.lit("M"), k.cast("string")).alias("wa_message_id"),
        _source(k).alias("source"),
        F.when(k % 27 == 0, " ").otherwise("text").alias("content"),
        (k % 9 != 0).alias("in_archive"),
    )


def authorized_senders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Senders allowed to issue commands (W8), derived from ``customer``:
    even keys may send cash commands, keys divisible by three income ones."""
    c = read_table(spark, sf_dir, "customer", ["c_custkey"])
    k = F.col("c_custkey")
    ph = _phone(k, 700000000)
    cash = c.where(k % 2 == 0).select(F.lit("cash_command").alias("command"), ph.alias("phone"))
    income = c.where(k % 3 == 0).select(F.lit("income_command").alias("command"), ph.alias("phone"))
    return cash.unionByName(income)


def store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fx_store with each row's chat and time (from the same order), as a
    message store row for the gap scan; ``source_number`` is the bridge's own
    number per source."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    k = F.col("o_orderkey")
    src = _source(k)
    return o.select(
        F.concat(F.lit("M"), k.cast("string")).alias("wa_message_id"),
        src.alias("source"),
        F.concat(F.lit("019000000"), F.lpad((k % 3 + 1).cast("string"), 2, "0")).alias("source_number"),
        F.concat(F.lit("88"), _phone(F.col("o_custkey"), 700000000), F.lit("@s.whatsapp.net")).alias("chat_jid"),
        F.col("o_orderdate").alias("timestamp_wa"),
        F.when(k % 54 == 0, " ").when(k % 54 == 27, "").otherwise("text").alias("content"),
        F.when((k % 108).isin(54, 81), "voice note").alias("processed_text"),
        (k % 9 != 0).alias("in_archive"),
        (k % 5 == 0).alias("redelivered"),
    )


def resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Employees with their resolution status: a linked row is a duplicate, the
    row a chain ends in is canonical, any other is unresolved."""
    e = employees(spark, sf_dir)
    ends = e.select(F.col("canonical_employee_id").alias("id")).where("id is not null").distinct()
    j = e.join(ends.withColumn("_target", F.lit(True)), "id", "left")
    return j.withColumn("resolution_status", F.when(F.col("canonical_employee_id").isNotNull(), "duplicate")
                        .when(F.col("_target"), "canonical").otherwise("unresolved")).drop("_target")


def identity_reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity reviews for the dashboards: every employee but the first is a
    candidate suspected to be the row before it."""
    e = employees(spark, sf_dir).select("id")
    i = F.col("id")
    return e.where(i > 1).select(
        i.alias("id"), i.alias("candidate_employee_id"), (i - 1).alias("suspected_match_id"),
        F.when(i % 2 == 0, "name_collision").otherwise("fuzzy_name_below_threshold").alias("match_reason"),
        F.when(i % 2 == 0, 0.95).otherwise(0.75).cast("decimal(4,3)").alias("confidence_score"),
        F.when(i % 3 == 0, "rejected").otherwise("pending").alias("review_status"))


SYLLABLES = ["ra", "ka", "mi", "bu", "sha", "jo", "li", "na", "he", "to"]


def _syllables(key: Column, digits: int) -> Column:
    """A word of one syllable a digit."""
    d = F.lpad(key.cast("string"), digits, "0")
    table = F.array(*[F.lit(s) for s in SYLLABLES])
    return F.concat(*[F.get(table, F.substring(d, i + 1, 1).cast("int")) for i in range(digits)])


def _person(key: Column) -> Column:
    """A name of two or three words; titles and family names are shared by many."""
    title = F.get(F.array(*[F.lit(t) for t in ("md", "abdul", None, "mst", "sheikh")]), (key % 5).cast("int"))
    return F.concat_ws(" ", title, _syllables(F.floor(key / 3) * 37 % 1000, 3), _syllables(key * 13 % 100, 2))


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A master for matching and search: every other customer, some without a name, some with
    an id phone, every 25th inactive, every 15th linked to the row before."""
    k = F.col("c_custkey")
    c = read_table(spark, sf_dir, "customer", ["c_custkey"]).where(k % 2 == 0)
    return c.select(
        (k + 1).alias("id"), employee_code(k + 1).alias("employee_code"),
        F.when(k % 12 == 4, _phone(k, 700000000)).when(k % 48 == 6, "Unknown").otherwise(F.initcap(_person(k))).alias("full_name"),
        _phone(k, 700000000).alias("primary_phone"),
        F.when(k % 4 == 0, _phone(k, 710000000)).alias("employee_id_phone"),
        F.when(k % 30 == 14, k - 1).cast("long").alias("canonical_employee_id"),
        F.when(k % 25 == 3, "inactive").otherwise("active").alias("status"))


def people_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone aliases of the master, those of inactive rows among them, and a name alias each."""
    k = F.col("c_custkey")
    c = read_table(spark, sf_dir, "customer", ["c_custkey"]).where(k % 2 == 0)
    return c.select((k + 1).alias("employee_id"), F.lit("phone").alias("alias_type"), _phone(k, 720000000).alias("alias_value")) \
        .unionByName(c.select((k + 1).alias("employee_id"), F.lit("name").alias("alias_type"), F.concat(F.lit("bhai "), _person(k)).alias("alias_value")))


def people_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match requests, one an order: phones, id phones, aliases and names of the master, of people
    it lacks, and of several people at once."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    m = k % 12
    name = F.when(m.isin(3, 4, 6, 7, 8), _person(c)).when(m.isin(9, 10), F.concat(F.lit("new "), _syllables(c % 100, 2))).when(m == 11, "n/a")
    payout = (F.when(m.isin(0, 7), _phone(c, 700000000)).when(m.isin(1, 4), _phone(c, 730000000)).when(m == 2, _phone(c, 720000000))
              .when(m == 5, _phone(c, 710000000)).when(m.isin(8, 9), _phone(c % 50, 740000000)))
    id_phone = F.when(m == 1, _phone(c, 710000000)).when(m == 8, _phone(c, 730000000))
    return o.select((k + 1).alias("message_id"), name.alias("name_raw"), payout.alias("payout_phone"), id_phone.alias("id_phone"))


def people_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names as messages give them, one an order: in another order, without the title, with a letter
    less or a word more, of people the master lacks, and the first word alone."""
    o = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    n, m = _person(F.col("o_custkey")), F.col("o_orderkey") % 7
    words = F.split(n, " ")
    return o.select(
        (F.col("o_orderkey") + 1).alias("message_id"),
        F.when(m == 0, n).when(m == 1, F.array_join(F.reverse(words), " ")).when(m == 2, F.array_join(F.slice(words, -2, 2), " "))
        .when(m == 3, F.substring(n, F.lit(1), F.length(n) - 1)).when(m == 4, F.concat(n, F.lit(" mia")))
        .when(m == 5, F.concat(F.lit("x"), n)).otherwise(F.get(words, F.lit(0))).alias("name"))
