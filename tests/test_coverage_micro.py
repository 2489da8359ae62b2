"""Rule set v2 on hand-made deals: found folded into pipe, unforecast pull-ins, exclusions, absent measures."""

import datetime as dt

from pipewright.functions.periods import ReportParams
from pipewright.plans import coverage

from .conftest import SF001

D = dt.date
P = ReportParams(rpt_date=D(1998, 8, 15), anchor=D(1998, 7, 10))   # quarter [07-01, 10-01)
OPP = ("Id string, Name string, Type string, StageName string, CloseDate date, SAO_Date date, Cohort_Close_Date date, "
       "OwnerId long, CurrencyIsoCode string, Test_Account boolean, Region string, ACV_Bookings double")
SNAP = ("Id string, snapshot_date date, Name string, AccountId long, Type string, StageName string, CloseDate date, "
        "SAO_Date date, Test_Account boolean, Renewal_Type string, OwnerId long, CurrencyIsoCode string, "
        "ACV_Bookings double, Managers_Forecast double")
CHG = "OpportunityId string, field string, OldValue string, NewValue string, CreatedDate timestamp_ntz"


def opp(i, stage, close, sao, owner=1, amt=100.0):
    return (i, i, "New Business", stage, close, sao, close, owner, "USD", False, "North America", amt)


def snap(i, day, close, stage="Proposal", amt=100.0):
    return (i, day, i, 1, "New Business", stage, close, D(1998, 6, 1), False, None, 1, "USD", amt, amt)


def chg(i):
    return (i, "CloseDate", "1998-11-01", "1998-09-15", dt.datetime(1998, 8, 1, 12))


def test_v2_coverage_rules(spark):
    opps = spark.createDataFrame([
        opp("S1", "Closed Won", D(1998, 8, 15), D(1998, 6, 1), amt=100.0),   # starting, won in quarter
        opp("S2", "Proposal", D(1998, 10, 5), D(1998, 6, 1), amt=200.0),     # starting, pushed
        opp("P1", "Closed Won", D(1998, 9, 15), D(1998, 6, 1), amt=300.0),   # pulled in and forecast
        opp("P2", "Closed Won", D(1998, 9, 15), D(1998, 6, 1), amt=400.0),   # pulled in, never forecast
        opp("N1", "Proposal", D(1998, 8, 20), D(1998, 7, 20), amt=500.0),    # new pipe, not won
        opp("F1", "Closed Won", D(1998, 9, 1), D(1998, 2, 1), amt=600.0),    # found
        opp("X1", "Closed Won", D(1998, 9, 1), D(1998, 2, 1), owner=6, amt=700.0),  # excluded owner
    ], OPP)
    snaps = spark.createDataFrame([
        snap("S1", P.anchor, D(1998, 8, 1)), snap("S2", P.anchor, D(1998, 9, 1)),
        snap("P1", D(1998, 7, 17), D(1998, 9, 15)),                          # forecast in the quarter later on
    ], SNAP)
    changes = spark.createDataFrame([chg("P1"), chg("P2")], CHG)
    rows = coverage.coverage_by_region(spark, SF001, P, opportunity=opps, snapshots=snaps, changes=changes).collect()
    assert len(rows) == 1
    r = rows[0].asDict()
    assert (r["Type"], r["Merged_Account_Region_bucket"]) == ("New Business", "NA")
    assert r["pipe"] == 900.0               # S1 + S2 + found F1
    assert r["Pipeline_Won"] == 700.0       # S1 + won found F1
    assert r["pushed"] == 200.0
    assert r["lost"] == 0.0
    assert r["Pulled_In"] == 300.0          # P2 was never forecast: left out, but still "known"
    assert r["Won_From_Pulled_In"] == 300.0
    assert r["New_Pipe"] == 500.0
    assert r["Won_From_New_Pipe"] is None   # no won new deal: the measure's table has no row
    assert r["Total_Won"] == 1400.0         # S1 + P1 + P2 + F1 (X1's owner is excluded)

    tabs = coverage.v2_tabs(spark, SF001, P)
    assert set(tabs) == {"starting_pipeline", "pulled_in", "new_pipe", "total_won"}


def test_two_anchor_rows_of_a_deal_count_its_win_once(spark):
    opps = spark.createDataFrame([opp("S1", "Closed Won", D(1998, 8, 15), D(1998, 6, 1), amt=100.0),
                                  opp("F1", "Closed Won", D(1998, 9, 1), D(1998, 2, 1), amt=600.0)], OPP)
    snaps = spark.createDataFrame([snap("S1", P.anchor, D(1998, 8, 1)), snap("S1", P.anchor, D(1998, 8, 2)),
                                   snap("S1", P.anchor, D(1998, 8, 2))], SNAP)
    changes = spark.createDataFrame([chg("none")], CHG)
    r = coverage.coverage_by_region(spark, SF001, P, opportunity=opps, snapshots=snaps, changes=changes).first()
    assert r["Total_Won"] == 700.0          # S1 and F1 once each
    assert r["pipe"] == 900.0               # the starting rows themselves repeat: three times S1, and found F1
