"""DuckDB SQL for the correctness check.

The fixture views are the SQL of FIXTURES.md §1; the parser and the text
rules are re-stated in RE2 syntax (DuckDB's regex engine): no look-ahead, so
the name rule consumes the following text in a second group; Unicode digit
and space classes are spelled out.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# Fixed values (as in ledgerflow.functions.text / operators.parse), RE2 form.
# ---------------------------------------------------------------------------
WS = r"[\t\n\x{0B}\f\r\x{85}\p{Z}]"
NWS = r"[^\t\n\x{0B}\f\r\x{85}\p{Z}]"
D = r"\p{Nd}"
LB = r"\r\n|[\n\x{0B}\f\r\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
BENGALI = "০১২৩৪৫৬৭৮৯"
# ---------------------------------------------------------------------------

FIXTURE_CTES = {
    "fx_employees": """SELECT c_custkey + 1 AS id,
 printf('EMP-%05d', c_custkey + 1) AS employee_code,
 concat(lower(c_mktsegment), ' ', translate(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), '0123456789', 'abcdefghij')) AS full_name,
 concat('01', lpad(CAST(700000000 + c_custkey AS VARCHAR), 9, '0')) AS primary_phone,
 CASE WHEN c_custkey % 10 IN (7, 8, 9) THEN c_custkey ELSE NULL END AS canonical_employee_id,
 CASE WHEN c_custkey % 25 = 3 THEN 'inactive' ELSE 'active' END AS status
FROM customer""",
    "fx_messages": """SELECT o_orderkey + 1 AS id, concat('M', CAST(o_orderkey AS VARCHAR)) AS wa_message_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'bridge1' WHEN 1 THEN 'bridge2' ELSE 'meta' END AS source,
 concat('88', ph, '@s.whatsapp.net') AS chat_jid, ph AS sender_phone,
 o_orderkey % 5 <> 0 AS is_from_me, o_orderdate AS timestamp_wa,
 CASE o_orderkey % 13
  WHEN 0 THEN concat('ID: ', ph, ' ', nm, ' ', ph, '(N) ', amt, '/-')
  WHEN 1 THEN concat(nm, ' - +88', ph, ' ( B) = ', amt, ' /-')
  WHEN 2 THEN concat(nm, ' ', ph, '(cash) ', amt, '/-')
  WHEN 3 THEN concat('ID: ', ph, chr(10), nm, '- ', ph, '(B) ', amt, '/-')
  WHEN 4 THEN concat(nm, ' ', ph, ' ', amt, '/-')
  WHEN 5 THEN concat(ph, ' ', amt, '/-')
  WHEN 6 THEN concat(amt, '/-')
  WHEN 7 THEN concat('Cash ', ph, ' ', nm, ' ', amt, '/-')
  WHEN 8 THEN concat('Income ', ph, ' ', nm, ' ', amt)
  WHEN 9 THEN concat('31/3/26=টোটাল বাকি =', amt, '/-')
  WHEN 10 THEN 'ok noted'
  WHEN 11 THEN concat(nm, ' ', ph, '(N) ', translate(amt, '0123456789', '০১২৩৪৫৬৭৮৯'), '/-')
  ELSE concat(nm, ' (B) ', amt, '/-') END AS raw_content
FROM (SELECT o_orderkey, o_orderdate,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) AS amt,
  concat('01', lpad(CAST(700000000 + o_custkey AS VARCHAR), 9, '0')) AS ph,
  concat('emp ', translate(lpad(CAST(o_custkey AS VARCHAR), 6, '0'), '0123456789', 'abcdefghij')) AS nm
  FROM orders) o""",
    "fx_payments": """SELECT o_orderkey + 1 AS id, o_custkey + 1 AS employee_id,
 CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
 CASE o_orderkey % 5 WHEN 0 THEN 'bkash' WHEN 1 THEN 'nagad' WHEN 2 THEN 'cash' WHEN 3 THEN 'rocket' ELSE 'unknown' END AS payout_method,
 CAST(o_orderdate AS DATE) AS txn_date,
 CASE WHEN o_orderkey % 7 = 0 THEN 'advance' ELSE 'salary' END AS txn_category,
 substr(CAST(CAST(o_orderdate AS DATE) AS VARCHAR), 1, 7) AS accounting_period,
 o_orderkey % 17 = 0 AS was_reversed
FROM orders""",
    "fx_aliases": """SELECT c_custkey + 1 AS employee_id, 'phone' AS alias_type,
 concat('01', lpad(CAST(800000000 + c_custkey AS VARCHAR), 9, '0')) AS alias_value
FROM customer
UNION ALL
SELECT c_custkey + 1, 'name', concat('al-', lower(c_mktsegment)) FROM customer""",
    "fx_message_state": """SELECT o_orderkey + 1 AS message_id,
 CASE o_orderkey % 8 WHEN 0 THEN 'pending' WHEN 1 THEN 'parsed' WHEN 2 THEN 'failed' WHEN 3 THEN 'skipped' ELSE 'done' END AS status,
 CAST(o_orderkey % 7 AS INT) AS attempts, o_orderdate AS queued_at
FROM orders""",
    "fx_review_items": """SELECT o_orderkey + 1 AS id, o_orderkey + 1 AS message_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'accountant_other' WHEN 1 THEN 'cash_command_no_employee' ELSE 'accounting_failed' END AS reason,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_totalprice AS DECIMAL(12,2)) END AS detected_amount,
 CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(o_orderkey % 11 AS DOUBLE) / 10 END AS parser_confidence,
 CASE o_orderkey % 4 WHEN 0 THEN 'promoted' WHEN 1 THEN 'dismissed' WHEN 2 THEN 'duplicate' ELSE 'pending' END AS review_status,
 CASE WHEN o_orderkey % 4 <> 3 THEN CAST(o_orderdate AS DATE) END AS reviewed_at
FROM orders""",
    "fx_store": """SELECT concat('M', CAST(o_orderkey AS VARCHAR)) AS wa_message_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'bridge1' WHEN 1 THEN 'bridge2' ELSE 'meta' END AS source,
 CASE WHEN o_orderkey % 27 = 0 THEN ' ' ELSE 'text' END AS content,
 o_orderkey % 9 <> 0 AS in_archive
FROM orders""",
    "fx_store_rows": """SELECT concat('M', CAST(o_orderkey AS VARCHAR)) AS wa_message_id,
 CASE o_orderkey % 3 WHEN 0 THEN 'bridge1' WHEN 1 THEN 'bridge2' ELSE 'meta' END AS source,
 concat('019000000', lpad(CAST(o_orderkey % 3 + 1 AS VARCHAR), 2, '0')) AS source_number,
 concat('88', concat('01', lpad(CAST(700000000 + o_custkey AS VARCHAR), 9, '0')), '@s.whatsapp.net') AS chat_jid,
 o_orderdate AS timestamp_wa,
 CASE WHEN o_orderkey % 54 = 0 THEN ' ' WHEN o_orderkey % 54 = 27 THEN '' ELSE 'text' END AS content,
 CASE WHEN o_orderkey % 108 IN (54, 81) THEN 'voice note' END AS processed_text,
 o_orderkey % 9 <> 0 AS in_archive, o_orderkey % 5 = 0 AS redelivered
FROM orders""",
    "fx_identity_reviews": """SELECT id, id AS candidate_employee_id, id - 1 AS suspected_match_id,
 CASE WHEN id % 2 = 0 THEN 'name_collision' ELSE 'fuzzy_name_below_threshold' END AS match_reason,
 CAST(CASE WHEN id % 2 = 0 THEN 0.95 ELSE 0.75 END AS DECIMAL(4,3)) AS confidence_score,
 CASE WHEN id % 3 = 0 THEN 'rejected' ELSE 'pending' END AS review_status
FROM (SELECT c_custkey + 1 AS id FROM customer) e WHERE id > 1""",
    "fx_authorized": """SELECT 'cash_command' AS command, concat('01', lpad(CAST(700000000 + c_custkey AS VARCHAR), 9, '0')) AS phone
FROM customer WHERE c_custkey % 2 = 0
UNION ALL
SELECT 'income_command', concat('01', lpad(CAST(700000000 + c_custkey AS VARCHAR), 9, '0'))
FROM customer WHERE c_custkey % 3 = 0""",
}


def with_ctes(names: list[str], extra: list[tuple[str, str]], body: str, parse: bool = False,
              recursive: bool = False) -> str:
    """CTEs: the named fixture views, then the parse (``parsed``) if asked,
    then ``extra`` in order, then ``body``."""
    parts = [f"{n} AS ({FIXTURE_CTES[n]})" for n in names]
    if parse:
        parts.append(parse_sql())
    parts += [f"{n} AS ({sql})" for n, sql in extra]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


# --- text rules as SQL expressions ----------------------------------------

PY_SPACES_SQL = "(" + " || ".join(f"chr({c})" for c in [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680,
                                                           *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]) + ")"


def strip(x: str) -> str:
    return f"trim({x}, {PY_SPACES_SQL})"


def ascii_digits(x: str) -> str:
    return f"translate({x}, '{BENGALI}', '0123456789')"


def norm_phone(x: str) -> str:
    d = f"regexp_replace({ascii_digits(x)}, '\\P{{Nd}}+', '', 'g')"
    r = f"regexp_replace({d}, '^(?:880|88)?0?(1{D}{{9}})$', '0\\1')"
    return f"(CASE WHEN regexp_full_match({r}, '01{D}{{9}}') THEN {r} END)"


def valid_name(x: str, extra: tuple[str, ...] = ()) -> str:
    s = strip(x)
    words = ", ".join(f"'{w}'" for w in ("unknown", "unnamed", "none", "n/a", "na") + extra)
    digits_only = f"regexp_replace({s}, '{WS[:-1]}\\-+().]', '', 'g')"
    return (f"coalesce(({s} IS NOT NULL AND length({s}) >= 2 "
            f"AND lower({s}) NOT IN ({words}) "
            f"AND NOT regexp_full_match({digits_only}, '{D}+') "
            f"AND regexp_matches({s}, '[A-Za-z\\x{{0980}}-\\x{{09FF}}]')), false)")


def norm_name(x: str) -> str:
    """F2 for the oracle (NFKC is the identity on the ASCII fixture names)."""
    s = f"regexp_replace(lower({strip(x)}), '{WS}+', ' ', 'g')"
    return f"coalesce(regexp_replace({s}, '[-. ]+$', ''), '')"


def norm_method(x: str) -> str:
    k = f"lower({strip(x)})"
    return (f"(CASE {k} WHEN 'b' THEN 'bkash' WHEN 'bkash' THEN 'bkash' WHEN 'bk' THEN 'bkash' "
            f"WHEN 'n' THEN 'nagad' WHEN 'nagad' THEN 'nagad' WHEN 'c' THEN 'cash' WHEN 'cash' THEN 'cash' "
            f"WHEN 'r' THEN 'rocket' WHEN 'rocket' THEN 'rocket' ELSE 'unknown' END)")


def money(txt: str) -> str:
    return f"(CASE WHEN {txt} <> '' THEN try_cast(replace({txt}, ',', '') AS DOUBLE) END)"


AMOUNT_MARK = f"([০-৯{D}][০-৯{D},.]*){WS}*/[-–]"
METHOD_TAG = (f"\\({WS}*([BbNnCcRr]|[Bb][Kk]|[Cc]ash|[Nn]agad|[Bb][Kk]ash|[Rr]ocket){WS}*\\)")
ID_PREFIX = f"(?m)^[Ii][Dd]{WS}*[:：]{WS}*(\\+?8{{0,2}}01{D}+)"
NAME_BEFORE_PHONE = (f"^([A-Za-z\\x{{0980}}-\\x{{09FF}}][A-Za-z\\x{{0980}}-\\x{{09FF}}\\t\\n\\x{{0B}}\\f\\r\\x{{85}}\\p{{Z}}.\\-]{{1,50}}?)"
                     f"{WS}*[\\-–]?{WS}*(?:\\+?8{{0,2}}01|\\()")


def _cands(ls: str) -> str:
    g1 = f"regexp_extract({ls}, '{NAME_BEFORE_PHONE}', 1)"
    c1 = f"CASE WHEN length({ls}) >= 3 AND {g1} <> '' THEN regexp_replace({strip(g1)}, '[-– ]+$', '') END"
    before = f"regexp_extract({ls}, '(?s)^(.*?)\\+?8{{0,2}}01{D}{{9}}', 1)"
    c2 = f"regexp_replace({strip(before)}, '[-– ]+$', '')"
    c2 = strip(f"regexp_replace({c2}, '^[Ii][Dd]{WS}*[:：]{WS}*{NWS}+{WS}*', '')")
    c2 = f"CASE WHEN length({ls}) >= 3 AND regexp_matches({ls}, '\\+?8{{0,2}}01{D}{{9}}') THEN {c2} END"
    return f"[{c1}, {c2}]"


def parse_sql(source: str = "fx_messages") -> str:
    """CTE bodies that parse ``source`` into ``parsed``."""
    return f"""p1 AS (SELECT m.*, {strip('raw_content')} AS t, CAST(timestamp_wa AS DATE) AS d FROM {source} m),
p2 AS (SELECT *, raw_content IS NULL OR t = '' AS blank, {ascii_digits('t')} AS ta,
  string_split_regex({strip("string_split_regex(t, '" + LB + "')[1]")}, '{WS}+') AS tok,
  regexp_matches(t, '^[Cc]ash{WS}') AS is_cash, regexp_matches(t, '^[Ii]ncome{WS}') AS is_income,
  regexp_matches(t, 'টোটাল|বাকি|জমা') AND regexp_matches(t, '{AMOUNT_MARK}') AS is_sum,
  regexp_extract(t, '{ID_PREFIX}', 0) AS id_span, regexp_extract(t, '{ID_PREFIX}', 1) AS id_raw,
  regexp_extract(t, '{METHOD_TAG}', 1) AS mcode
  FROM p1),
p3 AS (SELECT *, is_cash OR is_income AS command,
  {norm_phone('tok[2]')} AS cmd_phone,
  {money("regexp_extract(tok[-1], '([0-9][0-9,.]*)[-/]{0,2}$', 1)")} AS cmd_amount,
  {strip("array_to_string(tok[3:len(tok) - 1], ' ')")} AS cmd_name,
  {money(f"regexp_extract(ta, '{AMOUNT_MARK}', 1)")} AS pay_amount,
  CASE WHEN id_span <> '' THEN {norm_phone('id_raw')} END AS id_phone,
  list_filter(list_transform(regexp_extract_all(ta, '(?:\\+?880)?0[1-9][0-9]{{9}}', 0), lambda p: {norm_phone('p')}),
              lambda p: p IS NOT NULL)[-1] AS payout,
  list_filter(flatten(list_transform(list_transform(string_split_regex(t, '{LB}'),
      lambda l: {strip("CASE WHEN id_span <> '' AND instr(l, id_span) > 0 THEN substr(l, 1, instr(l, id_span) - 1) || substr(l, instr(l, id_span) + length(id_span)) ELSE l END")}),
      lambda ls: {_cands('ls')})), lambda c: {valid_name('c')})[1] AS name
  FROM p2),
p4 AS (SELECT *,
  len(tok) >= 3 AND cmd_phone IS NOT NULL AND cmd_amount IS NOT NULL AND cmd_amount > 0 AS cmd_ok,
  pay_amount IS NOT NULL AND pay_amount > 0 AS pay_ok, mcode <> '' AS has_method,
  CASE WHEN cmd_name <> '' AND {valid_name('cmd_name')} THEN cmd_name END AS cmd_name_ok
  FROM p3),
parsed AS (SELECT id AS message_id, source, is_from_me, sender_phone, raw_content, timestamp_wa,
  CASE WHEN blank THEN 'other'
       WHEN is_cash THEN CASE WHEN cmd_ok THEN 'cash_command' ELSE 'other' END
       WHEN is_income THEN CASE WHEN cmd_ok THEN 'income_command' ELSE 'other' END
       WHEN is_sum THEN 'balance_summary' WHEN pay_ok THEN 'payment' ELSE 'other' END AS message_type,
  CASE WHEN NOT blank AND command AND cmd_ok THEN cmd_phone
       WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN id_phone END AS id_phone,
  CASE WHEN NOT blank AND command AND cmd_ok THEN cmd_name_ok
       WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN name END AS name_raw,
  CASE WHEN NOT blank AND command AND cmd_ok THEN cmd_phone
       WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN payout END AS payout_phone,
  CASE WHEN NOT blank AND command AND cmd_ok THEN 'cash'
       WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN
         CASE WHEN has_method THEN {norm_method('mcode')} ELSE 'unknown' END END AS payout_method,
  CASE WHEN NOT blank AND command AND cmd_ok THEN try_cast(cmd_amount AS DECIMAL(12,2))
       WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN try_cast(pay_amount AS DECIMAL(12,2)) END AS amount,
  CASE WHEN NOT blank AND ((command AND cmd_ok) OR (NOT command AND NOT is_sum AND pay_ok)) THEN d END AS txn_date,
  CASE WHEN NOT blank AND NOT command AND NOT is_sum AND pay_ok THEN
    CASE WHEN payout IS NOT NULL AND has_method AND name IS NOT NULL THEN 1.0
         WHEN payout IS NOT NULL AND has_method THEN 0.9
         WHEN payout IS NOT NULL AND name IS NOT NULL THEN 0.85
         WHEN payout IS NOT NULL OR has_method OR name IS NOT NULL THEN 0.75
         ELSE 0.6 END
  ELSE 1.0 END AS confidence,
  CASE WHEN NOT blank AND NOT command AND is_sum THEN
    try_strptime(printf('%04d-%02d-%02d',
      CASE WHEN try_cast({ascii_digits(f"regexp_extract(t, '({D}{{1,2}})/({D}{{1,2}})/({D}{{2,4}})', 3)")} AS INT) < 100
           THEN try_cast({ascii_digits(f"regexp_extract(t, '({D}{{1,2}})/({D}{{1,2}})/({D}{{2,4}})', 3)")} AS INT) + 2000
           ELSE try_cast({ascii_digits(f"regexp_extract(t, '({D}{{1,2}})/({D}{{1,2}})/({D}{{2,4}})', 3)")} AS INT) END,
      try_cast({ascii_digits(f"regexp_extract(t, '({D}{{1,2}})/({D}{{1,2}})/({D}{{2,4}})', 2)")} AS INT),
      try_cast({ascii_digits(f"regexp_extract(t, '({D}{{1,2}})/({D}{{1,2}})/({D}{{2,4}})', 1)")} AS INT)), '%Y-%m-%d')::DATE
  END AS summary_date,
  CASE WHEN NOT blank AND NOT command AND is_sum THEN
    try_cast(nullif({money(ascii_digits(f"regexp_extract(t, 'বাকি{WS}*[=:\\t\\n\\x{{0B}}\\f\\r\\x{{85}}\\p{{Z}}]+([০-৯{D}][০-৯{D},]*){WS}*/[-–]', 1)"))}, 0) AS DECIMAL(12,2)) END AS total_due,
  CASE WHEN NOT blank AND NOT command AND is_sum THEN
    try_cast(nullif({money(ascii_digits(f"regexp_extract(t, 'জমা{WS}*[=:\\t\\n\\x{{0B}}\\f\\r\\x{{85}}\\p{{Z}}]+([০-৯{D}][০-৯{D},]*){WS}*/[-–]', 1)"))}, 0) AS DECIMAL(12,2)) END AS total_collected
FROM p4)"""


# --- identity ---------------------------------------------------------------

MASTER_CTES = [
    ("emp", f"SELECT *, {norm_name('full_name')} AS name_normalized, NULL::VARCHAR AS employee_id_phone FROM fx_employees"),
    ("walk", """SELECT id, id AS cur, 0 AS hops FROM emp
UNION ALL
SELECT w.id, e2.id, w.hops + 1 FROM walk w JOIN emp e1 ON e1.id = w.cur JOIN emp e2 ON e2.id = e1.canonical_employee_id
WHERE w.hops < 8 AND e2.id <> e1.id"""),
    ("canon", """SELECT w.id, arg_max(w.cur, w.hops) AS canonical_id FROM walk w GROUP BY w.id"""),
    ("lookup", """SELECT kind, key, min(id) AS hit FROM (
  SELECT 'primary' AS kind, primary_phone AS key, id FROM emp WHERE status = 'active'
  UNION ALL SELECT 'idphone', employee_id_phone, id FROM emp WHERE status = 'active'
  UNION ALL SELECT 'name', name_normalized, id FROM emp WHERE status = 'active'
  UNION ALL SELECT 'alias', a.alias_value, a.employee_id FROM fx_aliases a JOIN emp e ON e.id = a.employee_id
    WHERE a.alias_type = 'phone' AND e.status = 'active') x
WHERE key IS NOT NULL AND key <> '' GROUP BY ALL"""),
]


def match_ctes(req: str) -> list[tuple[str, str]]:
    """Exact tiers for the requests CTE ``req`` (payout_phone, id_phone, name_raw)."""
    return [
        ("mkeys", f"""SELECT DISTINCT coalesce(payout_phone, '') AS kp, coalesce(id_phone, '') AS ki,
  coalesce(CASE WHEN name_raw IS NOT NULL THEN {norm_name('name_raw')} END, '') AS kn FROM {req}"""),
        ("probes", """SELECT kp, ki, kn, 1 AS rank, 'primary' AS kind, kp AS key, 'exact_phone' AS tier FROM mkeys
UNION ALL SELECT kp, ki, kn, 2, 'idphone', ki, 'exact_id_phone' FROM mkeys
UNION ALL SELECT kp, ki, kn, 3, 'alias', kp, 'alias_phone' FROM mkeys
UNION ALL SELECT kp, ki, kn, 4, 'alias', ki, 'alias_phone' FROM mkeys
UNION ALL SELECT kp, ki, kn, 5, 'name', kn, 'exact_name' FROM mkeys"""),
        ("best", """SELECT kp, ki, kn, arg_min(tier, rank) AS match_tier, arg_min(hit, rank) AS matched_id
FROM probes p JOIN lookup l ON l.kind = p.kind AND l.key = p.key WHERE p.key <> '' GROUP BY ALL"""),
        ("matched", f"""SELECT r.*, b.match_tier, b.matched_id, c.canonical_id AS employee_id
FROM {req} r LEFT JOIN best b ON b.kp = coalesce(r.payout_phone, '') AND b.ki = coalesce(r.id_phone, '')
  AND b.kn = coalesce(CASE WHEN r.name_raw IS NOT NULL THEN {norm_name('r.name_raw')} END, '')
LEFT JOIN canon c ON c.id = b.matched_id"""),
    ]


def create_ctes() -> list[tuple[str, str]]:
    """I1, I2 and I5 in message order for the requests that no row of the master matches.

    In the message fixture a customer's requests have the customer's phone and
    name (kind A), the phone (B), the name (C) or neither (U). The first request
    of a customer creates a row. A row made by A has both keys. One made by B
    gets its name at the first A; a C before that finds no name and creates a
    second row, which later Cs find until the first row, with the lower id, has
    the name. One made by C has no phone: an A finds it by name until a B creates
    a second row with the phone.
    """
    return [
        ("m", """SELECT *, CASE WHEN payout_phone IS NOT NULL THEN CASE WHEN name_raw IS NOT NULL THEN 'A' ELSE 'B' END
  WHEN name_raw IS NOT NULL THEN 'C' ELSE 'U' END AS kind,
  CASE WHEN payout_phone IS NOT NULL THEN CAST(payout_phone[3:] AS BIGINT) - 700000000
       WHEN name_raw IS NOT NULL THEN CAST(translate(name_raw[5:], 'abcdefghij', '0123456789') AS BIGINT) ELSE -1 END AS cust
FROM matched WHERE employee_id IS NULL"""),
        ("g", """SELECT cust, min(message_id) AS t0, arg_min(kind, message_id) AS k0, min(message_id) FILTER (kind = 'A') AS ta,
  min(message_id) FILTER (kind = 'B') AS tb, min(message_id) FILTER (kind = 'C') AS tc FROM m GROUP BY cust"""),
        ("made", """SELECT m.*, k0, t0, CASE
  WHEN k0 IN ('U', 'A') THEN t0
  WHEN k0 = 'B' THEN CASE WHEN kind <> 'C' OR coalesce(message_id > ta, false) THEN t0 ELSE tc END
  WHEN kind = 'C' OR (kind = 'A' AND coalesce(message_id < tb, true)) THEN t0 ELSE tb END AS maker
FROM m JOIN g USING (cust)"""),
        ("newemp", """SELECT maker, (SELECT max(id) FROM emp) + row_number() OVER (ORDER BY maker) AS id
FROM (SELECT DISTINCT maker FROM made) d"""),
        ("assigned", """SELECT * FROM matched WHERE employee_id IS NOT NULL
UNION ALL SELECT made.* EXCLUDE (kind, cust, k0, t0, maker, employee_id, match_tier, matched_id),
  CASE WHEN message_id = maker THEN 'auto_created' WHEN kind IN ('U', 'C') OR (k0 = 'C' AND maker = t0) THEN 'exact_name'
    ELSE 'exact_phone' END, id, id
FROM made JOIN newemp USING (maker)"""),
    ]


ROUTE_CTES = [
    ("routed", f"""SELECT p.*, coalesce({norm_phone('p.sender_phone')}, p.sender_phone, '') AS sender_norm,
  a.phone IS NOT NULL AS authorized
FROM parsed p LEFT JOIN (SELECT DISTINCT command, phone FROM fx_authorized) a
  ON a.command = p.message_type AND a.phone = coalesce({norm_phone('p.sender_phone')}, p.sender_phone, '')"""),
    ("req", """SELECT message_id, CASE WHEN message_type = 'income_command' THEN 'income' ELSE 'match' END AS action,
  name_raw,
  CASE WHEN message_type = 'income_command' THEN coalesce(payout_phone, id_phone) ELSE payout_phone END AS payout_phone,
  CASE WHEN message_type = 'income_command' THEN coalesce(payout_phone, id_phone) ELSE id_phone END AS id_phone,
  payout_method, amount, txn_date, raw_content, sender_norm
FROM routed WHERE amount IS NOT NULL AND amount > 0 AND (
  (message_type = 'payment' AND coalesce(is_from_me, false)) OR (message_type = 'income_command' AND authorized))"""),
]

CASH_CTES = [
    ("cashreq", """SELECT message_id, coalesce(payout_phone, id_phone) AS emp_phone, name_raw, amount, txn_date, sender_norm
FROM routed WHERE message_type = 'cash_command' AND authorized AND amount IS NOT NULL AND amount > 0"""),
    ("byphone", """SELECT ph, min(id) AS emp FROM (SELECT id, primary_phone AS ph FROM emp
  UNION ALL SELECT id, employee_id_phone FROM emp) x WHERE ph IS NOT NULL GROUP BY ph"""),
    ("cashout", """SELECT c.*, b.emp AS employee_id FROM cashreq c LEFT JOIN byphone b ON b.ph = c.emp_phone"""),
]


def display_name_ok(x: str) -> str:
    return valid_name(x, ("(unknown)", "(unnamed)"))


def trigrams(x: str) -> str:
    pad = "('  ' || w || ' ')"
    return (f"list_distinct(flatten(list_transform(regexp_extract_all(lower(coalesce({x}, '')), '[\\p{{L}}\\p{{N}}]+', 0), "
            f"lambda w: list_transform(range(1, length{pad} - 1), lambda i: substr({pad}, i, 3)))))")
