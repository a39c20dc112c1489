"""NFKC normalisation: the one text step Spark has no built-in for.

An Arrow-batched pandas UDF. ASCII values are returned as they are (NFKC is
the identity on ASCII), so only non-ASCII names pay for ``unicodedata``.
"""
from __future__ import annotations

import sys
import unicodedata

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType


# Ship this module's code with the UDF (pickle by value), so executors need
# no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _nfkc_one(v):
    if v is None or v.isascii():
        return v
    return unicodedata.normalize("NFKC", v)


@pandas_udf(StringType())
def _nfkc_batch(s: pd.Series) -> pd.Series:
    return s.map(_nfkc_one, na_action="ignore")


def nfkc(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return _nfkc_batch(c)
