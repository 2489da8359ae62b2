"""Hot keys (one key holding a third of all rows) give whole, correct results."""

import datetime as dt
import random

from pyspark.sql import functions as F

from pipewright.functions.periods import ReportParams
from pipewright.operators import merge
from pipewright.operators.topn import top_n
from pipewright.plans.coverage import forecasted_opps


def test_top_n_with_hot_owner_matches_brute_force(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        owner = "hot" if i % 3 == 0 else f"o{i % 50}"
        rows.append((owner, f"id{i:05d}", float(rnd.randint(1, 200))))
    df = spark.createDataFrame(rows, "owner string, Id string, qb double").repartition(16)
    got = {}
    for r in top_n(df, ["owner"], [F.desc("qb"), F.desc("Id")], 10).collect():
        got.setdefault(r.owner, []).append((r.rank, r.Id))
    expect = {}
    for owner in {r[0] for r in rows}:
        mine = sorted([r for r in rows if r[0] == owner], key=lambda r: (-r[2], [-ord(c) for c in r[1]]))[:10]
        expect[owner] = [(i + 1, r[1]) for i, r in enumerate(mine)]
    assert {k: sorted(v) for k, v in got.items()} == expect


def test_merge_with_hot_duplicate_key(spark):
    target = spark.createDataFrame([(1, 0.0), (2, 0.0)], "Id long, Balance double")
    changes = spark.createDataFrame([(1, float(s), s) for s in range(1, 2001)] + [(2, 5.0, 1)],
                                    "Id long, Balance double, seq int").repartition(8)
    out = merge.merge_outcomes(target, changes, "Id", "seq").groupBy("outcome").count().collect()
    assert {r.outcome: r["count"] for r in out} == {"superseded": 1999, "updated": 2}
    merged = {r.Id: r.Balance for r in merge.merged_table(target, changes, "Id", "seq").collect()}
    assert merged == {1: 2000.0, 2: 5.0}


def test_forecast_max_over_snapshots_null_when_all_missing(spark):
    p = ReportParams(rpt_date=dt.date(1998, 8, 15), anchor=dt.date(1998, 7, 10))
    schema = ("Id string, snapshot_date date, StageName string, Test_Account boolean, Type string, "
              "CloseDate date, ACV_Bookings double, Managers_Forecast double, CurrencyIsoCode string")
    d1, d2 = dt.date(1998, 7, 10), dt.date(1998, 7, 17)
    snaps = spark.createDataFrame([
        ("a", d1, "Proposal", False, "New Business", dt.date(1998, 8, 1), 100.0, None, "USD"),
        ("a", d2, "Proposal", False, "New Business", dt.date(1998, 8, 1), 150.0, None, "USD"),
        ("b", d1, "Closed Lost", False, "New Business", dt.date(1998, 8, 1), 100.0, 90.0, "USD"),   # stage excluded
        ("c", d2, "Proposal", False, "New Business", dt.date(1998, 11, 1), 10.0, 9.0, "USD"),       # next quarter
        ("d", dt.date(1998, 7, 3), "Proposal", False, "New Business", dt.date(1998, 8, 1), 1.0, 1.0, "USD"),  # before anchor
    ], schema)
    out = {(r.Id, r.quarter): (r.qb_usd, r.forecast_usd)
           for r in forecasted_opps(spark, "/root/testdata/sf0.001", p, snapshots=snaps).collect()}
    assert out == {("a", 19983): (150.0, None), ("c", 19984): (10.0, 9.0)}


def test_merge_hot_key_is_salted(spark):
    target = spark.createDataFrame([(i, float(i)) for i in range(50)], "Id long, Balance double")
    rows = [(1, float(s), s) for s in range(1, 3001)] + [(i, 1.0, 1) for i in range(2, 50)] + [(99, 9.0, 1)]
    changes = spark.createDataFrame(rows, "Id long, Balance double, seq int").repartition(4)
    out = merge.merge_outcomes(target, changes, "Id", "seq")
    got = {r.outcome: r["count"] for r in out.groupBy("outcome").count().collect()}
    assert got == {"superseded": 2999, "updated": 49, "inserted": 1}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "__salt" in plan and "ResolvedHint" not in plan


def test_merge_row_repeated_beyond_a_chunk(spark, monkeypatch):
    """One identical row in many chunks: it wins once, in its first chunk, and every copy has an outcome."""
    monkeypatch.setattr(merge, "CHUNK", 7)
    target = spark.createDataFrame([(1, 0.0), (2, 0.0), (2, 0.0)], "Id long, Balance double")
    rows = [(1, 5.0, 1)] * 100 + [(2, 1.0, 1)] * 20 + [(None, 1.0, 1)] * 15 + [(3, 2.0, 2)] * 8 + [(3, 1.0, 1)] * 8
    changes = spark.createDataFrame(rows, "Id long, Balance double, seq int").repartition(3)
    got = {(r.Id, r.outcome): r["count"] for r in
           merge.merge_outcomes(target, changes, "Id", "seq").groupBy("Id", "outcome").count().collect()}
    assert got == {(1, "updated"): 1, (1, "superseded"): 99, (2, "ambiguous key"): 20, (None, "no key"): 15,
                   (3, "inserted"): 1, (3, "superseded"): 15}


def test_revert_with_hot_keys_and_edits(spark):
    target = spark.createDataFrame([(i, float(i), "x") for i in range(20)] + [(3, 3.0, "x")], "Id long, Balance double, other string")
    changes = spark.createDataFrame([(1, float(s), s) for s in range(1, 500)] + [(i, i + 0.5, 1) for i in (2, 3, 4, 5, 30, 31)] + [(None, 1.0, 1)],
                                    "Id long, Balance double, seq int").repartition(5)
    now, before = merge.merged_table(target, changes, "Id", "seq"), merge.before_image(target, changes, "Id")
    back = merge.revert_table(now, before, changes, "Id", "seq")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, target.collect()))
    edited = now.where("Id <> 30").withColumn("Balance", F.when(F.col("Id") == 4, 99.0).otherwise(F.col("Balance")))
    edited = edited.unionByName(edited.where("Id = 5"))
    got = {r.Id: r.outcome for r in merge.revert_outcomes(edited, before, changes, "Id", "seq").collect()}
    assert got == {1: "restored", 2: "restored", 4: "changed since", 5: "changed since", 30: "gone", 31: "deleted"}
    kept = merge.revert_table(edited, before, changes, "Id", "seq")
    assert sorted(r.Balance for r in kept.where("Id in (4, 5, 31, 1)").collect()) == [1.0, 5.5, 5.5, 99.0]
