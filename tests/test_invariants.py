"""Invariants from the reports' own sanity checks."""

import pytest
from pyspark.sql import functions as F

from pipewright.plans.movement import V3, V4, Movement
from pipewright.registry import PARAMS

from .conftest import SF001, SF01


@pytest.mark.parametrize("preset", [V3, V4])
def test_sets_disjoint_and_total_explained(spark, preset):
    m = Movement(spark, SF01, PARAMS, preset)
    ids = {k: {r.Id for r in getattr(m, k).select("Id").collect()}
           for k in ["starting", "pulled_in", "new_pipe", "ghost", "total", "pushed"]}
    for a in ["starting", "pulled_in", "new_pipe", "ghost"]:
        for b in ["starting", "pulled_in", "new_pipe", "ghost"]:
            if a < b:
                assert not (ids[a] & ids[b]), (a, b)
    assert ids["total"] <= ids["starting"] | ids["pulled_in"] | ids["new_pipe"] | ids["ghost"]
    assert ids["pushed"] <= ids["starting"]


@pytest.mark.parametrize("sf", [SF001, SF01])
def test_total_won_reconciles(spark, sf):
    m = Movement(spark, sf, PARAMS, V3)
    a = m.outcome().agg(F.sum("Total_Won")).collect()[0][0]
    b = m.won_by_category().agg(F.sum("won")).collect()[0][0]
    assert a == pytest.approx(b, abs=1e-6)


def test_seed_counts_match_multiplicity(spark):
    m = Movement(spark, SF001, PARAMS, V3)
    assert m.seed().count() == m.id_multiplicity().agg(F.sum("n_rows")).collect()[0][0]
