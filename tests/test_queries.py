"""Every registered query: against DuckDB where it has SQL, else for rows and a stable schema."""

import pytest

import __spark_entry__ as contract
from tests.compare import connect, differences

SF_DIR = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_names_agree():
    assert set(SQL) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, con, name):
    assert differences(contract.queries()[name](spark, SF_DIR), SQL[name], con) == []


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(SQL)))
def test_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = contract.entry(spark)
    assert df.columns == ["home_team", "away_team", "season_year", "home_form", "away_form"]
    assert df.count() == 630
