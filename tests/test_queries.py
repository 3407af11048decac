"""Every registered query against its SQL, and properties of the plans."""

from __future__ import annotations

import subprocess
import sys
from pathlib import Path

import oracle
import pytest

import __spark_entry__ as driver
from starmart.driver.marts import mart
from starmart.driver.oracles import ORACLES
from starmart.driver.queries import REGISTRY
from starmart.plans import reports
from starmart.plans.fact import fact_lines

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return oracle.connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(REGISTRY) == set(ORACLES)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query_matches_sql(spark, connection, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert oracle.differences(result, connection, driver.oracle_sql()[name]) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_no_plan_pairs_everything_with_everything(spark):
    for name, build in REGISTRY.items():
        text = plan(build(spark, SF_DIR))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_reports_read_only_their_columns(spark):
    built = mart(spark, SF_DIR)
    text = plan(reports.top_customers(built.fact, built.dims.customer))
    assert "TakeOrderedAndProject" in text
    assert "ReadSchema: struct<customer_key:bigint,order_id:bigint,total_amount:decimal(12,2)>" in text


def test_fact_join_keeps_python_out_and_merges(spark):
    built = mart(spark, SF_DIR)
    text = plan(fact_lines(built.tables["order_details"], built.tables["orders"], built.dims))
    assert "SortMergeJoin [order_id" in text
    assert "Python" not in text


def test_queries_without_a_package_of_the_corpus_operators():
    code = (
        "import sys; sys.modules['regex'] = sys.modules['public_tokenizers'] = None; import __spark_entry__ as e;"
        "assert 'fact_orders' in e.queries() and set(e.queries()) == set(e.oracle_sql()), e.queries().keys()"
    )
    done = subprocess.run([sys.executable, "-c", code], cwd=Path(__file__).parent.parent, capture_output=True, text=True)
    assert done.returncode == 0, done.stderr
