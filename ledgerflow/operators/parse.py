"""Message parsing (P1-P14) as one projection over ``messages``.

No Python runs per row: the parser is a chain of ``regexp_extract``,
``regexp_extract_all``, ``split`` and higher-order functions, so it is one
narrow, codegen'd stage that scales with the input partitions and never
shuffles. Branch order is the contract: blank, cash command, income command,
balance summary, payment, other.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.functions.text import (ascii_digits, norm_method, norm_phone, py_strip,
                                       valid_name)
from ledgerflow.operators.layout import dealt

PARSER_VERSION = "v1"

# ---------------------------------------------------------------------------
# Message patterns (Java regex). (?U) gives Unicode \d and \s,
# (?d) makes only "\n" end a line, as in Python.
# ---------------------------------------------------------------------------
CASH_START = r"(?U)^[Cc]ash\s"
INCOME_START = r"(?U)^[Ii]ncome\s"
LINE_BREAK = r"\R|[\x1c-\x1e]"
COMMAND_AMOUNT = r"([0-9][0-9,.]*)[-/]{0,2}$"
SUMMARY_WORDS = "টোটাল|বাকি|জমা"
AMOUNT_MARK = r"(?U)([০-৯\d][০-৯\d,.]*)\s*/[-–]"
SUMMARY_DATE = r"(?U)(\d{1,2})/(\d{1,2})/(\d{2,4})"
SUMMARY_DUE = r"(?U)বাকি\s*[=:\s]+([০-৯\d][০-৯\d,]*)\s*/[-–]"
SUMMARY_COLLECTED = r"(?U)জমা\s*[=:\s]+([০-৯\d][০-৯\d,]*)\s*/[-–]"
ID_PREFIX = r"(?md)(?U)^[Ii][Dd]\s*[:：]\s*(\+?8{0,2}01\d+)"
PHONE_RUN = r"(?:\+?880)?0[1-9]\d{9}"
METHOD_TAG = r"(?U)\(\s*([BbNnCcRr]|[Bb][Kk]|[Cc]ash|[Nn]agad|[Bb][Kk]ash|[Rr]ocket)\s*\)"
NAME_BEFORE_PHONE = r"(?U)^([A-Za-zঀ-৿][A-Za-zঀ-৿\s.\-]{1,50}?)(?=\s*[\-–]?\s*(?:\+?8{0,2}01|\())"
TEXT_BEFORE_PHONE = r"(?sU)^(.*?)\+?8{0,2}01\d{9}"
ID_PREFIX_LEFTOVER = r"(?U)^[Ii][Dd]\s*[:：]\s*\S+\s*"
NAME_TAIL = "[-– ]+$"
# Confidence of a payment by (phone, method, name) found.
CONF_ALL = 1.0
CONF_PHONE_METHOD = 0.9
CONF_PHONE_NAME = 0.85
CONF_ONE_FIELD = 0.75
CONF_AMOUNT_ONLY = 0.6
# Below this a supplied extraction may replace the parse.
FILL_IN_THRESHOLD = 0.7
# ---------------------------------------------------------------------------

PAYMENT_TYPE = ("struct<id_phone:string,name_raw:string,payout_phone:string,"
                "payout_method:string,amount:decimal(12,2),txn_date:date>")
SUMMARY_TYPE = "struct<summary_date:date,total_due:decimal(12,2),total_collected:decimal(12,2)>"


def _rx(col: Column, pattern: str, idx: int = 1) -> Column:
    return F.regexp_extract(col, pattern, idx)


def _money(text: Column) -> Column:
    """Digits/commas/dots text -> double, null when it does not parse."""
    return F.when(text != "", F.regexp_replace(text, ",", "").try_cast("double"))


def _to_dec(x: Column) -> Column:
    return x.try_cast("decimal(12,2)")


def _name_candidates(line: Column, id_span: Column) -> Column:
    """The two name candidates of one line, in the order they are tried."""
    pos = F.instr(line, id_span)
    line = F.when((id_span != "") & (pos > 0),
                  F.concat(F.substring(line, 1, pos - 1),
                           F.substring(line, pos + F.length(id_span), 1 << 24))).otherwise(line)
    ls = py_strip(line)
    usable = F.length(ls) >= 3
    g1 = _rx(ls, NAME_BEFORE_PHONE)
    c1 = F.when(usable & (g1 != ""), F.regexp_replace(py_strip(g1), NAME_TAIL, ""))
    before = _rx(ls, TEXT_BEFORE_PHONE)
    c2 = F.regexp_replace(py_strip(before), NAME_TAIL, "")
    c2 = py_strip(F.regexp_replace(c2, ID_PREFIX_LEFTOVER, ""))
    c2 = F.when(usable & ls.rlike(r"(?U)\+?8{0,2}01\d{9}"), c2)
    return F.array(c1, c2)


def _stage(df: DataFrame, **cols: Column) -> DataFrame:
    return df.withColumns(cols)


def parse_frame(df: DataFrame, text_col: str, ts_col: str) -> DataFrame:
    """Adds ``message_type``, ``payment``, ``summary``, ``confidence``.

    Built in stages: each intermediate (stripped text, tokens, lines, the
    extracted groups) is a column computed once, so the generated code stays
    small and no regex runs twice on a row.
    """
    c = F.col
    df = _stage(df, _t=py_strip(c(text_col)), _date=F.to_date(c(ts_col)))
    df = _stage(df, _blank=c(text_col).isNull() | (c("_t") == ""), _ta=ascii_digits(c("_t")))
    df = _stage(
        df,
        _tok=F.split(py_strip(F.try_element_at(F.split(c("_t"), LINE_BREAK), F.lit(1))), r"(?U)\s+"),
        _is_cash=c("_t").rlike(CASH_START),
        _is_income=c("_t").rlike(INCOME_START),
        _is_sum=c("_t").rlike(SUMMARY_WORDS) & c("_t").rlike(AMOUNT_MARK),
        _id_span=_rx(c("_t"), ID_PREFIX, 0),
        _id_raw=_rx(c("_t"), ID_PREFIX, 1),
        _mcode=_rx(c("_t"), METHOD_TAG),
        _pay_txt=_rx(c("_ta"), AMOUNT_MARK),
        _phones=F.regexp_extract_all(c("_ta"), F.lit(PHONE_RUN), F.lit(0)),
        _sd=_rx(c("_t"), SUMMARY_DATE, 1), _sm=_rx(c("_t"), SUMMARY_DATE, 2), _sy=_rx(c("_t"), SUMMARY_DATE, 3),
        _due=_rx(c("_t"), SUMMARY_DUE), _coll=_rx(c("_t"), SUMMARY_COLLECTED),
    )
    df = _stage(df, _command=c("_is_cash") | c("_is_income"))
    df = _stage(
        df,
        _cmd_phone=norm_phone(F.try_element_at(c("_tok"), F.lit(2))),
        _cmd_amount=_money(_rx(F.try_element_at(c("_tok"), F.lit(-1)), COMMAND_AMOUNT)),
        _cmd_name=py_strip(F.array_join(F.slice(c("_tok"), 3, F.greatest(F.size(c("_tok")) - 3, F.lit(0))), " ")),
        _pay_amount=_money(c("_pay_txt")),
        _id_phone=F.when(c("_id_span") != "", norm_phone(c("_id_raw"))),
        _payout=F.try_element_at(F.filter(F.transform(c("_phones"), lambda p: norm_phone(p)),
                                          lambda p: p.isNotNull()), F.lit(-1)),
        _cands=F.when(~c("_blank") & ~c("_command") & ~c("_is_sum"),
                      F.flatten(F.transform(F.split(c("_t"), LINE_BREAK),
                                            lambda ln: _name_candidates(ln, c("_id_span"))))),
    )
    df = _stage(
        df,
        _name=F.try_element_at(F.filter(c("_cands"), lambda x: valid_name(x)), F.lit(1)),
        _cmd_name_ok=F.when((c("_cmd_name") != "") & valid_name(c("_cmd_name")), c("_cmd_name")),
        _cmd_ok=(F.size(c("_tok")) >= 3) & c("_cmd_phone").isNotNull() & c("_cmd_amount").isNotNull()
                & (c("_cmd_amount") > 0),
        _pay_ok=c("_pay_amount").isNotNull() & (c("_pay_amount") > 0),
        _has_method=c("_mcode") != "",
    )
    has_phone = c("_payout").isNotNull()
    has_name = c("_name").isNotNull()
    has_method = c("_has_method")
    confidence = (
        F.when(has_phone & has_method & has_name, CONF_ALL)
        .when(has_phone & has_method, CONF_PHONE_METHOD)
        .when(has_phone & has_name, CONF_PHONE_NAME)
        .when(has_phone | has_method | has_name, CONF_ONE_FIELD)
        .otherwise(CONF_AMOUNT_ONLY)
    )
    is_payment = ~c("_blank") & ~c("_command") & ~c("_is_sum") & c("_pay_ok")
    message_type = (
        F.when(c("_blank"), "other")
        .when(c("_is_cash"), F.when(c("_cmd_ok"), "cash_command").otherwise("other"))
        .when(c("_is_income"), F.when(c("_cmd_ok"), "income_command").otherwise("other"))
        .when(c("_is_sum"), "balance_summary")
        .when(c("_pay_ok"), "payment")
        .otherwise("other")
    )
    payment = F.when(
        ~c("_blank") & c("_command") & c("_cmd_ok"),
        F.struct(c("_cmd_phone").alias("id_phone"), c("_cmd_name_ok").alias("name_raw"),
                 c("_cmd_phone").alias("payout_phone"), F.lit("cash").alias("payout_method"),
                 _to_dec(c("_cmd_amount")).alias("amount"), c("_date").alias("txn_date")),
    ).when(
        is_payment,
        F.struct(c("_id_phone").alias("id_phone"), c("_name").alias("name_raw"),
                 c("_payout").alias("payout_phone"),
                 F.when(has_method, norm_method(c("_mcode"))).otherwise(F.lit("unknown")).alias("payout_method"),
                 _to_dec(c("_pay_amount")).alias("amount"), c("_date").alias("txn_date")),
    )
    year = ascii_digits(c("_sy")).try_cast("int")
    year = F.when(year < 100, year + 2000).otherwise(year)
    sdate = F.try_to_date(F.format_string("%04d-%02d-%02d", year, ascii_digits(c("_sm")).try_cast("int"),
                                          ascii_digits(c("_sd")).try_cast("int")), "yyyy-MM-dd")
    due = _money(ascii_digits(c("_due")))
    coll = _money(ascii_digits(c("_coll")))
    summary = F.when(~c("_blank") & ~c("_command") & c("_is_sum"), F.struct(
        sdate.alias("summary_date"),
        _to_dec(F.when(due != 0, due)).alias("total_due"),
        _to_dec(F.when(coll != 0, coll)).alias("total_collected")))
    df = _stage(
        df,
        message_type=message_type,
        payment=payment.cast(PAYMENT_TYPE),
        summary=summary.cast(SUMMARY_TYPE),
        confidence=F.when(is_payment, confidence).otherwise(F.lit(1.0)).cast("double"),
    )
    return df.drop(*[x for x in df.columns if x.startswith("_")])


def parse_messages(messages: DataFrame, text_col: str = "raw_content",
                   ts_col: str = "timestamp_wa", keep: list[str] | None = None) -> DataFrame:
    """``messages`` -> one parse result per message.

    Output: ``message_id``, ``message_type``, ``payment`` struct, ``summary``
    struct, ``confidence``, ``parser_version``, ``ai_enhanced``, plus the
    columns named in ``keep``.
    """
    base = messages.select(F.col("id").alias("message_id"), *[F.col(x) for x in (keep or [])],
                           F.col(text_col).alias("_text"), F.col(ts_col).alias("_ts"))
    base = dealt(base)
    out = parse_frame(base, "_text", "_ts")
    return out.select("message_id", *(keep or []), "message_type", "payment", "summary", "confidence",
                      F.lit(PARSER_VERSION).alias("parser_version"), F.lit(False).alias("ai_enhanced"))


def parse_results(messages: DataFrame, keep: list[str] | None = None, **kw) -> DataFrame:
    """``parse_messages`` persisted (memory, then disk) as the run's
    parse_results table (S12).

    Downstream filters (payments only, commands only) then sit above the
    stored rows; without it Catalyst pushes them into the regex projection and
    every row is parsed twice, once for the filter and once for the output.
    A lost block is recomputed from lineage.
    """
    from pyspark import StorageLevel
    return parse_messages(messages, keep=keep, **kw).persist(StorageLevel.MEMORY_AND_DISK)


def apply_extractions(parsed: DataFrame, extractions: DataFrame, raw: DataFrame) -> DataFrame:
    """P14 re-aimed: where confidence < 0.7 and the text is not blank, take a
    supplied extraction (``extractions``: message_id, is_payment, employee_name,
    payout_phone, payout_method, amount, confidence, notes) when it says payment.
    The id phone is dropped; no amount makes it *other*."""
    ex = extractions.select(
        F.col("message_id").alias("_x_id"), F.col("is_payment").alias("_x_pay"),
        F.col("employee_name").alias("_x_name"), F.col("payout_phone").alias("_x_phone"),
        F.col("payout_method").alias("_x_method"), F.col("amount").alias("_x_amount"),
        F.col("confidence").alias("_x_conf"), F.col("notes").alias("_x_notes"))
    txt = raw.select(F.col("id").alias("_t_id"), F.col("raw_content").alias("_t_text"),
                     F.to_date("timestamp_wa").alias("_t_date"))
    j = (parsed.join(ex, parsed.message_id == ex._x_id, "left")
         .join(txt, parsed.message_id == txt._t_id, "left"))
    use = (F.col("confidence") < FILL_IN_THRESHOLD) & (py_strip("_t_text") != "") & F.coalesce("_x_pay", F.lit(False))
    conf = F.coalesce(F.col("_x_conf"), F.lit(0.7))
    has_amt = F.col("_x_amount").isNotNull() & (F.col("_x_amount") != 0)
    new_payment = F.when(has_amt, F.struct(
        F.lit(None).cast("string").alias("id_phone"), F.col("_x_name").alias("name_raw"),
        norm_phone(F.col("_x_phone").cast("string")).alias("payout_phone"),
        norm_method(F.coalesce(F.col("_x_method"), F.lit("unknown"))).alias("payout_method"),
        _to_dec(F.col("_x_amount")).alias("amount"), F.col("_t_date").alias("txn_date"))).cast(PAYMENT_TYPE)
    return j.select(
        *[F.col(c) for c in parsed.columns if c not in ("message_type", "payment", "confidence", "ai_enhanced")],
        F.when(use, F.when(has_amt, "payment").otherwise("other")).otherwise(F.col("message_type")).alias("message_type"),
        F.when(use, new_payment).otherwise(F.col("payment")).alias("payment"),
        F.when(use, conf).otherwise(F.col("confidence")).alias("confidence"),
        use.alias("ai_enhanced"),
        F.when(use, F.col("_x_notes")).alias("ai_notes"),
    )
