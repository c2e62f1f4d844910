"""Every registered query against its SQL on the smallest given tables."""

import ast
from pathlib import Path

import pytest

import __spark_entry__ as contract
from checks.compare import difference, duck_connection
from checks.registry import CHECKS

DATA = "/root/testdata/sf0.001"
ROOT = Path(__file__).resolve().parents[1]

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="given tables are not here")


@pytest.fixture(scope="module")
def duck():
    return duck_connection(DATA)


@pytest.mark.parametrize("name", sorted(CHECKS))
def test_query_equals_its_sql(spark, duck, name):
    assert difference(spark, duck, DATA, name) is None


def test_every_query_has_sql():
    assert set(CHECKS) <= set(contract.queries())
    assert set(CHECKS) <= set(contract.oracle_sql())


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["record_id", "processing_file_id", "column_name", "error_code"]
    assert df.count() > 0


FORBIDDEN = {
    "collect", "toPandas", "localCheckpoint", "crossJoin", "rdd", "udf", "pandas_udf", "sample",
    "limit",
}


# The optional subpackage fits models on bounded samples and is held to its own tests.
SOURCES = sorted(p for p in (ROOT / "rowproof").rglob("*.py") if p.parent.name != "llm")


@pytest.mark.parametrize("path", SOURCES, ids=lambda p: p.stem)
def test_package_keeps_rows_on_the_executors(path):
    tree = ast.parse(path.read_text())
    used = {node.attr for node in ast.walk(tree) if isinstance(node, ast.Attribute)}
    assert not used & FORBIDDEN
