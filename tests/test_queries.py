"""Every registered query of the profile metrics against its SQL in a second engine."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as contract
from testbed import queries as own
from tests.compare import connect, differences
from tests.conftest import SF_TINY

QUERIES, SQL = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF_TINY)


def test_every_query_is_registered_with_sql():
    assert set(own.all_queries()) <= set(QUERIES) and set(own.all_queries()) == set(own.all_oracles())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", own.all_queries())
def test_query(spark, duck, name):
    assert differences(QUERIES[name](spark, SF_TINY), duck, SQL[name]) == []


def test_entry(spark):
    profiles = contract.entry(spark)
    assert profiles.columns[:2] == ["id", "user_id"] and profiles.count() > 0


@pytest.mark.parametrize("missing", ["wayprint.llm", "public_tokenizers", "regex", "corpus_pipeline"])
def test_metrics_do_not_need_the_text_operators(missing):
    """Without their folder or one of their libraries, the metric queries are registered all the same."""
    code = (f"import sys; sys.modules[{missing!r}] = None\n"
            "import __spark_entry__ as c; from testbed import queries as own\n"
            "assert set(c.queries()) == set(own.all_queries()) and set(c.oracle_sql()) == set(own.all_oracles())")
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    assert subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=60).stderr == ""
