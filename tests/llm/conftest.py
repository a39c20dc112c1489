import os

import pytest

from ledgerflow.llm import common

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
# Spark's Python workers import the operators too
os.environ["PYTHONPATH"] = REPO + os.pathsep + os.environ.get("PYTHONPATH", "")


@pytest.fixture(scope="session")
def tokenizers():
    return pytest.importorskip("public_tokenizers")


@pytest.fixture(scope="session")
def small_docs(spark):
    """The documents of sf0.001, as a DataFrame and as rows."""
    df = common.read_table(spark, "/root/testdata/sf0.001", "documents")
    return df, [(r.doc_id, r.text) for r in df.collect()]
