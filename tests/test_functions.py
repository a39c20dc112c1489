"""Golden rows per function (FIXTURES.md §3)."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.functions import text as tx


def one_col(spark, values, fn, typ="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {typ}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_norm_phone(spark):
    good = ["01700000001", "+8801700000001", "8801700000001", "1700000001", "০১৭০০০০০০০১", "017-0000 0001"]
    assert one_col(spark, good, tx.norm_phone) == ["01700000001"] * 6
    bad = [None, "", "abc", "0170000000", "02700000001", "017000000012"]
    assert one_col(spark, bad, tx.norm_phone) == [None] * 6


def test_names(spark):
    assert one_col(spark, ["  Md.  Nasir - ", "ANIS-", None], tx.norm_name) == ["md. nasir", "anis", ""]
    assert one_col(spark, ["Al-Momin", "  Al  Momin ", "Debashish, S.G."], tx.search_text) == \
        ["al momin", "al momin", "debashish s g"]
    assert one_col(spark, ["Al-Momin", "Al Momin", "আনিস"], tx.collapse_text) == ["almomin", "almomin", ""]


def test_nfkc(spark):
    # full-width letters fold to ASCII under NFKC
    assert one_col(spark, ["ＡＮＩＳ"], tx.norm_name) == ["anis"]


def test_amount_method_jid(spark):
    assert one_col(spark, ["2,200", "১,৫৩০", "1500.", "1.2.3", ""], tx.norm_amount) == [2200.0, 1530.0, 1500.0, None, None]
    assert one_col(spark, ["B", "bk", " Nagad ", "r", "bank", None], tx.norm_method) == \
        ["bkash", "bkash", "nagad", "rocket", "unknown", "unknown"]
    assert one_col(spark, ["8801700000001@s.whatsapp.net", "1234@lid"], tx.jid_phone) == ["01700000001", None]


def test_valid_names(spark):
    assert one_col(spark, ["Jo", "J", "N/A", "0170-000", "(unknown)"], tx.valid_name) == [True, False, False, False, True]
    assert one_col(spark, ["(unknown)"], tx.display_name_ok) == [False]


def test_best_name(spark):
    df = spark.createDataFrame([("Anis", ["md anis", "anis"]), ("Anis", ["anis"])], "f string, a array<string>")
    assert [r[0] for r in df.select(tx.best_name("f", "a")).collect()] == ["md anis", "Anis"]


def test_parse_ts(spark):
    out = one_col(spark, ["2024-01-01 10:00:00", "2024-01-01T10:00:00+0600", "2024-01-01 10:00:00.5",
                          "2024-01-01T10:00:00Z"], tx.parse_ts)
    assert out[0] == dt.datetime(2024, 1, 1, 10, 0)
    assert out[1] == dt.datetime(2024, 1, 1, 4, 0)
    assert out[2] is None
    assert out[3] == dt.datetime(2024, 1, 1, 10, 0)


def test_refs(spark):
    df = spark.createDataFrame([(1, 2, "2200.00", "2026-01", "bkash")], "m long, e long, a string, p string, k string")
    ref = df.select(tx.payment_ref("m", "e", F.col("a").cast("decimal(12,2)"), "p", "k", parity=True)).first()[0]
    assert ref == "fpe-cb23508aa899d44d"
    assert df.select(tx.employee_code(F.lit(1234567))).first()[0] == "EMP-1234567"
    assert df.select(tx.employee_code(F.lit(7))).first()[0] == "EMP-00007"
