"""Every registered query against its SQL on the smallest tables."""

import pytest

import __spark_entry__ as contract
import oracle_queries
from compare import connect, difference
from conftest import SF_DIR


@pytest.fixture(scope="module")
def oracle():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    """But those of the training-data operators, which their own tests hold against brute force."""
    own = contract.queries().keys() - contract._training_data()[0].keys()
    assert own == oracle_queries.oracle_sql().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


@pytest.mark.parametrize("name", contract.oracle_sql())
def test_query_equals_oracle(spark, oracle, name):
    result = contract.queries()[name](spark, SF_DIR)
    assert difference(result, oracle.sql(contract.oracle_sql()[name])) is None


def test_flagship(spark):
    assert contract.entry(spark).count() > 0


def test_scratch_is_the_shared_folder_the_session_names(spark):
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert contract._scratch(spark).startswith(f"{named}/kerbstone-")


def test_entry_works_without_the_training_data_part(monkeypatch):
    import sys

    monkeypatch.setitem(sys.modules, "kerbstone.llm", None)  # importing it raises ImportError
    monkeypatch.delitem(sys.modules, "corpus_pipeline", raising=False)
    assert contract._training_data() == ({}, {})
    assert contract.queries().keys() == oracle_queries.oracle_sql().keys()


def test_queries_leave_the_session_as_it_was(spark):
    before = dict(spark.conf.getAll)
    databases = {d.name for d in spark.catalog.listDatabases()}
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = contract.queries()["register_tables"](spark, SF_DIR)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        assert rows.count() == 9
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert dict(spark.conf.getAll) == before
    assert {d.name for d in spark.catalog.listDatabases()} == databases
