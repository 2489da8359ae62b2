"""Boundary rows of the movement rules on hand-made tables (v3 and v4 presets)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pipewright.functions.periods import ReportParams
from pipewright.plans.movement import V3, V4, Movement

D = dt.date
P = ReportParams(rpt_date=D(1998, 8, 15), anchor=D(1998, 7, 10))   # quarter [07-01, 10-01)

CUR = ("Id string, Category string, Type string, Region string, Segment string, Product string, QB_USD double, "
       "StageName string, CloseDate date, CreatedDate date, LeadSource string, SAO_Date date, User_Role string, "
       "CAM_or_SAM string, Expansion_Category string")
SNAP = ("Id string, snapshot_date date, StageName string, Type string, CloseDate date, SAO_Date date, "
        "Category string, Software_USD double, Expansion_USD double, qb_usd double")
CHG = "OpportunityId string, field string, OldValue string, NewValue string, CreatedDate timestamp_ntz"


def cur(i, stage, close, sao=D(1998, 6, 1), created=D(1998, 5, 1), typ="New Business", cat="New", qb=100.0):
    return (i, cat, typ, "UK", "S", "P", qb, stage, close, created, "L", sao, "Account Executive", "AE", None)


def snap(i, close, sao=D(1998, 6, 1), stage="Proposal", typ="New Business", qb=100.0):
    return (i, P.anchor, stage, typ, close, sao, "New", qb, None, qb)


def chg(i, old, new, created):
    return (i, "CloseDate", old, new, dt.datetime.combine(created, dt.time(12)))


@pytest.fixture(scope="module")
def tables(spark):
    current = spark.createDataFrame([
        cur("A", "Closed Won", D(1998, 8, 1)),                 # starting, won in quarter
        cur("B", "Proposal", D(1998, 8, 1), sao=P.anchor),     # snapshot SAO == anchor -> starting
        cur("C", "Proposal", D(1998, 8, 1), sao=D(1998, 7, 11)),  # accepted after anchor -> new, not starting
        cur("D", "Proposal", D(1998, 10, 1)),                  # starting, now closing on q_end: not pushed
        cur("E", "Proposal", D(1998, 10, 2)),                  # starting, pushed
        cur("F", "Closed Won", D(1998, 9, 30), sao=D(1998, 6, 1)),  # pulled in twice
        cur("G", "Closed Won", D(1998, 9, 30), sao=D(1998, 2, 1)),  # ghost: in total only
        cur("H", "Proposal", D(1998, 8, 1), cat=None),          # snapshot close == q_end -> not starting
        cur("T", "Temporary", D(1998, 8, 1)),                   # housekeeping stage: nowhere
    ], CUR)
    snaps = spark.createDataFrame([
        snap("A", D(1998, 8, 1)), snap("B", D(1998, 8, 1), sao=P.anchor), snap("C", D(1998, 8, 1), sao=D(1998, 7, 11)),
        snap("D", D(1998, 9, 1)), snap("E", D(1998, 9, 1)), snap("H", D(1998, 10, 1)),
    ], SNAP)
    changes = spark.createDataFrame([
        chg("F", "1998-11-01", "1998-09-30", D(1998, 8, 1)), chg("F", "1998-12-01", "1998-09-30", D(1998, 8, 20)),
        chg("G", "1998-09-30", "1998-09-29", D(1998, 8, 1)),   # old value inside the quarter: not a pull-in
    ], CHG)
    return current, snaps, changes


def sets_of(m):
    out = {}
    for name in ["starting", "pulled_in", "new_pipe", "pushed", "total", "ghost"]:
        out[name] = sorted(r.Id for r in getattr(m, name).select("Id").collect())
    return out


def test_v3_sets(spark, tables):
    current, snaps, changes = tables
    m = Movement(spark, "", P, V3, snapshots=snaps, changes=changes, current=current)
    s = sets_of(m)
    assert s["starting"] == ["A", "B", "D", "E"]
    assert s["pulled_in"] == ["F"]
    assert s["new_pipe"] == ["C"]
    assert s["pushed"] == ["E"]          # close exactly on q_end is not pushed (strict >)
    assert s["total"] == ["A", "B", "C", "F", "G", "H"]      # D, E close on/after q_end; T housekeeping
    assert s["ghost"] == ["G", "H"]
    ghost_label = m.ghost.select("Movement_Type").distinct().collect()
    assert [r.Movement_Type for r in ghost_label] == ["New Pipe"]
    # pulled in twice -> one row; moved after the anchor and not a closed-lost clean-up -> 'Pulled In'
    assert [r.Movement_Type for r in m.pulled_in.collect()] == ["Pulled In"]


def test_v3_outcome_measures(spark, tables):
    current, snaps, changes = tables
    m = Movement(spark, "", P, V3, snapshots=snaps, changes=changes, current=current)
    o = m.outcome().agg(*[F.sum(c).alias(c) for c in
                          ["Starting_Pipeline", "New_Pipe", "Pulled_In", "Pushed", "Total_Won",
                           "Starting_Pipeline_Won", "Won_From_Pulled_In", "Won_From_New_Pipe"]]).collect()[0]
    assert o.Starting_Pipeline == 400.0                    # A B D E
    assert o.Pushed == 100.0                               # E
    assert o.Total_Won == 300.0                            # A F G
    assert o.Starting_Pipeline_Won == 200.0                # A, and ghost G counts as starting
    assert o.Won_From_Pulled_In == 100.0                   # F
    assert o.New_Pipe == 300.0                             # C, plus ghosts G and H labelled New Pipe


def test_v4_ghost_label_and_created_rule(spark, tables):
    current, snaps, changes = tables
    m = Movement(spark, "", P, V4, snapshots=snaps, changes=changes, current=current)
    labels = {r.Movement_Type for r in m.ghost.collect()}
    assert labels <= {"Starting Pipe"}
    # v4 starting needs created <= anchor (all created 05-01) and ignores the SAO date
    assert "C" in {r.Id for r in m.starting.collect()}


def test_null_category_is_its_own_group(spark, tables):
    current, snaps, changes = tables
    m = Movement(spark, "", P, V3, snapshots=snaps, changes=changes, current=current)
    cats = {r.Category for r in m.outcome().select("Category").collect()}
    assert None in cats


def test_v3_starting_keeps_missing_snapshot_values(spark):
    """A starting row takes category and amount from the snapshot, even when they are missing there."""
    current = spark.createDataFrame([cur("S", "Proposal", D(1998, 8, 1), cat="New", qb=70.0)], CUR)
    snaps = spark.createDataFrame([("S", P.anchor, "Proposal", "New Business", D(1998, 8, 1), D(1998, 6, 1),
                                    None, None, None, None)], SNAP)
    changes = spark.createDataFrame([], CHG)
    m = Movement(spark, "", P, V3, snapshots=snaps, changes=changes, current=current)
    r = m.starting.collect()
    assert len(r) == 1 and r[0].Category is None and r[0].QB_USD is None
    v4 = Movement(spark, "", P, V4, snapshots=snaps, changes=changes, current=current).starting.collect()
    assert v4[0].Category == "New" and v4[0].QB_USD == 70.0       # v4 reads today's values
