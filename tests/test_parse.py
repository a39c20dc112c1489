"""The 13 message shapes (FIXTURES.md §2) and golden parse rows."""
import datetime as dt

from pyspark.sql import functions as F

from ledgerflow.operators.parse import parse_messages
from ledgerflow.sources import fixtures as fx

from paths import SF_SMALL

EXPECTED = {  # shape: (type, has id phone, has payout, method, has name, confidence)
    0: ("payment", True, True, "nagad", True, 1.0),
    1: ("payment", False, True, "bkash", True, 1.0),
    2: ("payment", False, True, "cash", True, 1.0),
    3: ("payment", True, True, "bkash", True, 1.0),
    4: ("payment", False, True, "unknown", True, 0.85),
    5: ("payment", False, True, "unknown", False, 0.75),
    6: ("payment", False, False, "unknown", False, 0.6),
    7: ("cash_command", True, True, "cash", True, 1.0),
    8: ("income_command", True, True, "cash", True, 1.0),
    9: ("balance_summary", None, None, None, None, 1.0),
    10: ("other", None, None, None, None, 1.0),
    11: ("payment", False, True, "nagad", True, 1.0),
    12: ("payment", False, False, "bkash", True, 0.75),
}


def test_shapes(spark):
    p = parse_messages(fx.messages(spark, SF_SMALL), keep=["raw_content"])
    rows = p.withColumn("shape", (F.col("message_id") - 1) % 13).collect()
    seen = set()
    for r in rows:
        typ, idp, pay, method, name, conf = EXPECTED[r.shape]
        assert r.message_type == typ, r
        assert r.confidence == conf, r
        if typ in ("payment", "cash_command", "income_command"):
            assert (r.payment.id_phone is not None) == idp
            assert (r.payment.payout_phone is not None) == pay
            assert r.payment.payout_method == method
            assert (r.payment.name_raw is not None) == name
            assert r.payment.amount > 0
        if typ == "balance_summary":
            assert r.summary.summary_date == dt.date(2026, 3, 31)
            assert r.summary.total_due > 0
        seen.add(r.shape)
    assert seen == set(range(13))


def test_golden_texts(spark):
    texts = ["Cash to N 500/-", "Nasir 01700000001(NAGAD) 500/-", "Nasir বাকি 500/-", "", "  ",
             "Anis 01700000001(B) 1.500/-", "Anis 01700000001(B) 1.2.3/-"]
    df = spark.createDataFrame([(i + 1, t, dt.datetime(2026, 1, 5)) for i, t in enumerate(texts)],
                               "id long, raw_content string, timestamp_wa timestamp")
    r = {x.message_id: x for x in parse_messages(df).collect()}
    assert r[1].message_type == "other"
    assert r[2].message_type == "payment" and r[2].payment.payout_method == "unknown" and r[2].confidence == 0.85
    assert r[3].message_type == "balance_summary"
    assert r[4].message_type == "other" and r[5].message_type == "other"
    assert float(r[6].payment.amount) == 1.5
    assert r[7].message_type == "other"


def test_conversations_are_other(spark):
    conv = spark.read.parquet(f"{SF_SMALL}/conversations.parquet")
    msgs = conv.select(F.monotonically_increasing_id().alias("id"), F.col("text").alias("raw_content"),
                       F.lit(dt.datetime(2024, 1, 1)).alias("timestamp_wa"))
    types = {r[0] for r in parse_messages(msgs).select("message_type").distinct().collect()}
    assert types == {"other"}
