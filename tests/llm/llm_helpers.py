"""Helpers of the tests in this folder (not in conftest: the folder above has one of that name too)."""
import hashlib

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode("utf-8")).hexdigest()
