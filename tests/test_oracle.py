import pytest

from __spark_entry__ import entry, queries
from catalog import ORACLE, QUERIES
from check_oracle import connect, difference, type_difference

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    got = QUERIES[name](spark, SF_DIR)
    want = con.sql(ORACLE[name])
    assert type_difference(got, want) is None
    assert len(want) > 0
    assert difference(got.toPandas(), want.df()) is None


def test_entry(spark):
    assert entry(spark).count() > 0


def test_answers_come_in_order(spark):
    rows = queries()["search_top10"](spark, SF_DIR).collect()
    keys = [(r["qid"], r["rank"], r["part"]) for r in rows]
    assert keys == sorted(keys)
