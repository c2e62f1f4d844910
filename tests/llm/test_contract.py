"""Every query on the smallest given tables, and those with SQL against their SQL."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
import corpus_pipeline
from checks.compare import difference, duck_connection
from rowproof.llm.queries import ORACLE_SQL, QUERIES

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="given tables are not here")


def test_all_operators_and_the_pipeline_are_registered():
    assert [name.split("_")[0] for name in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{n}" for n in range(1, 14)]
    assert set(QUERIES) | {"pipeline"} <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    assert difference(spark, duck_connection(DATA), DATA, name) is None


def test_pipeline(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    names = docs.columns
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.settle(stage(spark, docs, DATA), name)
        assert docs.columns == names
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and 0 < counts[-1] < counts[0]
    found = corpus_pipeline.run(spark, DATA).collect()
    assert sorted(r.doc_id for r in found) == sorted(r.doc_id for r in docs.select("doc_id").collect())
    assert all(r.round_trip for r in found)


def test_pipeline_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, DATA).collect() == []
