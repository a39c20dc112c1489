"""Column functions for phones, names, amounts, methods and keys.

Every function takes and returns a ``Column`` built from Spark built-ins, so
it stays inside whole-stage codegen. The only Python step is NFKC
(``ledgerflow.functions.unicode``), which has no Spark built-in.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow.functions.unicode import nfkc

# ---------------------------------------------------------------------------
# These must equal the source system's for equal results.
# ---------------------------------------------------------------------------
BENGALI_DIGITS = "০১২৩৪৫৬৭৮৯"
ASCII_DIGITS = "0123456789"
# Placeholder names that never count as a person's name.
PLACEHOLDER_NAMES = ["unknown", "unnamed", "none", "n/a", "na"]
# Extra placeholders rejected for display.
DISPLAY_PLACEHOLDERS = ["(unknown)", "(unnamed)"]
# Payout method codes and the method each one means; anything else is unknown.
METHOD_CODES = {
    "b": "bkash", "bkash": "bkash", "bk": "bkash",
    "n": "nagad", "nagad": "nagad",
    "c": "cash", "cash": "cash",
    "r": "rocket", "rocket": "rocket",
}
PAYOUT_METHODS = ["bkash", "nagad", "cash", "rocket", "bank", "unknown"]
# Characters dropped before the all-digits test of a name.
NAME_DIGIT_NOISE = r"(?U)[\s\-+().]"
# A Latin or Bengali letter must appear in a name.
NAME_LETTER = "[A-Za-zঀ-৿]"
PREVIEW_CHARS = 240
# The characters Python's str.strip() removes (str.isspace), as code points.
PY_SPACE_CODES = [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
                  *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
PY_SPACES = "".join(chr(c) for c in PY_SPACE_CODES)
# Digits of a Bangladesh mobile number, with optional country code.
PHONE_SHAPE = r"(?U)^(?:880|88)?0?(1\d{9})$"
PHONE_VALID = r"(?U)^01\d{9}$"
# ---------------------------------------------------------------------------


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def py_strip(col) -> Column:
    """Python ``str.strip()``: drop Unicode white space at both ends
    (``btrim`` over the exact set; no regex)."""
    return F.btrim(_c(col), F.lit(PY_SPACES))


def ascii_digits(col) -> Column:
    return F.translate(_c(col), BENGALI_DIGITS, ASCII_DIGITS)


def norm_phone(col) -> Column:
    """any Bangladesh phone form -> ``01XXXXXXXXX`` or null.

    Digits only (Bengali digits first made ASCII); a leading ``880`` (13+
    digits) or ``88`` (12+) is dropped and a 10-digit ``1...`` gets its ``0``.
    As one anchored pattern: optional ``880``/``88``, optional ``0``, then
    ``1`` and nine digits; anything else is null.
    """
    d = F.regexp_replace(ascii_digits(col), r"(?U)\D+", "")
    r = F.regexp_replace(d, PHONE_SHAPE, "0$1")
    return F.when(r.rlike(PHONE_VALID), r)


def norm_name(col) -> Column:
    """trim, lower, NFKC, one space per run, no trailing ``- .``; null -> ''."""
    s = nfkc(F.lower(py_strip(col)))
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    s = F.regexp_replace(s, r"[-. ]+$", "")
    return F.coalesce(s, F.lit(""))


def search_text(col) -> Column:
    """NFKC, lower, non-alphanumerics to space, collapsed and trimmed."""
    s = F.lower(nfkc(_c(col)))
    s = F.regexp_replace(s, r"(?U)[^a-z0-9\s]+", " ")
    s = F.regexp_replace(s, r"(?U)\s+", " ")
    return F.coalesce(py_strip(s), F.lit(""))


def collapse_text(col) -> Column:
    """NFKC, lower, only a-z and 0-9 kept."""
    s = F.lower(nfkc(_c(col)))
    return F.coalesce(F.regexp_replace(s, "[^a-z0-9]+", ""), F.lit(""))


def norm_amount(col) -> Column:
    """Bengali digits to ASCII, commas dropped, parsed as a double."""
    s = py_strip(F.regexp_replace(ascii_digits(col), ",", ""))
    ok = s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$")
    return F.when(ok, s.try_cast("double"))


def norm_method(col) -> Column:
    """method code -> payout method; unknown otherwise."""
    key = F.lower(py_strip(col))
    mapping = F.create_map(*[x for k, v in METHOD_CODES.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.try_element_at(mapping, key), F.lit("unknown"))


def jid_phone(col) -> Column:
    """the phone of a ``...@s.whatsapp.net`` JID, else null."""
    c = _c(col)
    return F.when(c.contains("@s.whatsapp.net"), norm_phone(F.substring_index(c, "@", 1)))


def valid_name(col, extra_placeholders: list[str] | None = None) -> Column:
    """F8: a plausible human name (not placeholder, not digits, has a letter)."""
    s = py_strip(col)
    words = PLACEHOLDER_NAMES + (extra_placeholders or [])
    digits_only = F.regexp_replace(s, NAME_DIGIT_NOISE, "")
    ok = (
        s.isNotNull()
        & (F.length(s) >= 2)
        & ~F.lower(s).isin(words)
        & ~digits_only.rlike(r"(?U)^\d+$")
        & s.rlike(NAME_LETTER)
    )
    return F.coalesce(ok, F.lit(False))


def display_name_ok(col) -> Column:
    """F8 plus the two bracketed placeholders."""
    return valid_name(col, DISPLAY_PLACEHOLDERS)


def best_name(full_name, aliases) -> Column:
    """of the display-valid trimmed names, most words, then longest;
    ties keep the first given (full name first, then aliases in order)."""
    cands = F.concat(F.array(_c(full_name)), F.coalesce(_c(aliases), F.array().cast("array<string>")))
    indexed = F.transform(cands, lambda x, i: F.struct(
        display_name_ok(x).alias("ok"),
        F.size(F.split(py_strip(x), r"(?U)\s+")).alias("words"),
        F.length(py_strip(x)).alias("len"),
        (-i).alias("neg_pos"),
        py_strip(x).alias("name"),
    ))
    kept = F.filter(indexed, lambda s: s["ok"])
    best = F.array_max(F.transform(kept, lambda s: F.struct(s["words"], s["len"], s["neg_pos"], s["name"])))
    return best["name"]


def parse_ts(col) -> Column:
    """first 25 chars; ``T`` or space; optional offset (``Z`` = UTC);
    no fraction. No offset means UTC. Anything else is null."""
    s = F.substring(_c(col), 1, 25)
    s = F.regexp_replace(s, "Z$", "+00:00")
    fmts = ["yyyy-MM-dd'T'HH:mm:ssXXX", "yyyy-MM-dd HH:mm:ssXXX",
            "yyyy-MM-dd'T'HH:mm:ssXX", "yyyy-MM-dd HH:mm:ssXX",
            "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss"]
    shape = s.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}:\d{2}([+-]\d{2}:?\d{2})?$")
    return F.when(shape, F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in fmts]))


def period(col) -> Column:
    """``yyyy-MM`` of a date or (UTC) timestamp."""
    return F.date_format(_c(col), "yyyy-MM")


def amount_text(amount, parity: bool = False) -> Column:
    """Text of an amount inside a key (Q5).

    fixed: the decimal(12,2) text (``2200.00``). parity: the source system's
    float text, i.e. trailing zeros stripped but one decimal kept (``2200.0``).
    """
    s = _c(amount).cast("decimal(12,2)").cast("string")
    if not parity:
        return s
    return F.regexp_replace(F.regexp_replace(s, "0$", ""), r"\.$", ".0")


def _ref(prefix: str, parts: list[Column]) -> Column:
    key = F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.concat(F.lit(prefix), F.substring(F.sha2(key, 256), 1, 16))


def payment_ref(message_id, employee_id, amount, period_col, method, parity: bool = False) -> Column:
    """``fpe-`` + 16 hex of sha-256 over message|employee|amount|period|method."""
    return _ref("fpe-", [_c(message_id), _c(employee_id), amount_text(amount, parity),
                         _c(period_col), _c(method)])


def income_ref(message_id, employee_id, amount, period_col, parity: bool = False) -> Column:
    """``inc-`` + 16 hex of sha-256 over message|employee|amount|period."""
    return _ref("inc-", [_c(message_id), _c(employee_id), amount_text(amount, parity), _c(period_col)])


def reversal_ref(col) -> Column:
    """F15."""
    return F.concat(F.lit("REV-"), _c(col))


def employee_code(col) -> Column:
    """F16: ``EMP-`` + id padded to at least five digits (never truncated)."""
    return F.format_string("EMP-%05d", _c(col).cast("long"))


def preview(col) -> Column:
    """first 240 characters, null -> ''."""
    return F.left(F.coalesce(_c(col), F.lit("")), F.lit(PREVIEW_CHARS))


def page_count(total, size, zero_is_one: bool = True) -> Column:
    """pages for a total; lists report one page for an empty result."""
    pages = F.ceil(_c(total) / F.lit(size)).cast("long")
    return F.when(_c(total) == 0, F.lit(1 if zero_is_one else 0)).otherwise(pages)
