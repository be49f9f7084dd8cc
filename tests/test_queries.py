"""Every registered query against its SQL check on the smallest data set."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from tools.verify import TABLES, compare

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="driver data not present")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return connection


def test_every_query_has_a_check():
    from workload.registry import ORACLE, QUERIES

    assert set(QUERIES) == set(ORACLE)
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query(spark, con, name):
    result = compare(spark, con, name, SF_DIR)
    assert result.startswith("ok") and "types" not in result, result


def test_entry(spark):
    got = contract.entry(spark)
    assert got.columns == ["tenant_id", "nm_ano_mes", "ds_status", "qtd_itens", "qtd_vendida", "vlr_total"]
    assert got.count() > 0
