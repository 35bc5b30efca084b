"""Every query against its DuckDB oracle, over the whole small tables."""

import pytest

from __spark_entry__ import entry
from compare import differences, duck
from dwellmap.checks.oracles import ORACLES
from dwellmap.checks.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(all_queries()) == set(ORACLES)


@pytest.mark.parametrize("name", list(all_queries()))
def test_query_matches_oracle(spark, con, name):
    got = all_queries()[name](spark, SF_DIR).toPandas()
    want = con.execute(ORACLES[name]).df()
    assert differences(got, want) is None


def test_border_stops_exercise_splitting_and_repair(con):
    """Groups are split at the border, and ends are cut: the oracles differ from what they start from."""
    merged, repaired = (
        con.execute(ORACLES[name]).df()
        for name in ("merge_border_stops", "repair_border_stops")
    )
    plain = con.execute(ORACLES["repair_border_stops"].replace("FROM repaired_border", "FROM merged_border")).df()
    assert len(merged) > len(plain) == len(repaired)
    assert (repaired.sort_values(["userId", "begin"])["end"].values != plain.sort_values(["userId", "begin"])["end"].values).mean() > 0.1


def test_entry(spark):
    assert entry(spark).count() > 0
