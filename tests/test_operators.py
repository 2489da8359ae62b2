"""Operators on micro tables: audited merge, top-N ties, complete groups, classification."""

import datetime as dt

import pytest

from pyspark.sql import functions as F

from pipewright.operators import merge
from pipewright.operators.complete import complete_levels
from pipewright.operators.topn import top_n
from pipewright.plans.enrich import classify, flatten_nested

T = "Id long, Name string, Balance double"
C = "Id long, Name string, Balance double, seq int"


def test_audited_merge_outcomes_and_table(spark):
    target = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (3, "c", None)], T)
    changes = spark.createDataFrame([
        (1, "a", 5.0, 1), (1, "a", 6.0, 2),      # duplicate key: last wins, first superseded
        (2, "b", 2.0, 1),                        # no actual change
        (3, "c", None, 1),                       # no change, NULL compared null-safely
        (9, "z", 9.0, 1),                        # key not in target
    ], C)
    up = {(r.Id, r.seq): r.outcome for r in merge.merge_outcomes(target, changes, "Id", "seq", "upsert").collect()}
    assert up == {(1, 1): "superseded", (1, 2): "updated", (2, 1): "unchanged", (3, 1): "unchanged",
                  (9, 1): "inserted"}
    upd = {(r.Id, r.seq): r.outcome for r in merge.merge_outcomes(target, changes, "Id", "seq", "update").collect()}
    assert upd[(9, 1)] == "missing key"
    merged = {r.Id: r.Balance for r in merge.merged_table(target, changes, "Id", "seq", "upsert").collect()}
    assert merged == {1: 6.0, 2: 2.0, 3: None, 9: 9.0}
    merged_u = {r.Id for r in merge.merged_table(target, changes, "Id", "seq", "update").collect()}
    assert merged_u == {1, 2, 3}
    assert {r.Id for r in merge.before_image(target, changes, "Id").collect()} == {1, 2, 3}


def test_audited_merge_odd_keys(spark):
    target = spark.createDataFrame([(None, "n", 1.0), (1, "a", 1.0), (2, "b", 2.0), (2, "b", 2.5)], T)
    changes = spark.createDataFrame([
        (None, "x", 5.0, 1), (None, "x", 6.0, 2),              # no key
        (1, "a", 7.0, 3), (1, "a", 8.0, 3), (1, "a", 8.0, 3),  # tie, and the winner twice
        (2, "c", 9.0, 1),                                      # two target rows
        (4, None, None, 1),                                    # new, values missing
    ], C)
    out = sorted((r.Id or 0, r.outcome) for r in merge.merge_outcomes(target, changes, "Id", "seq").collect())
    assert out == [(0, "no key"), (0, "no key"), (1, "superseded"), (1, "superseded"), (1, "updated"),
                   (2, "ambiguous key"), (4, "inserted")]
    merged = sorted(((r.Id or 0, r.Name, r.Balance) for r in merge.merged_table(target, changes, "Id", "seq").collect()),
                    key=str)
    assert merged == [(0, "n", 1.0), (1, "a", 8.0), (2, "b", 2.0), (2, "b", 2.5), (4, None, None)]
    assert len(merged) == target.count() + sum(o == "inserted" for _, o in out)
    with pytest.raises(ValueError, match="no column Extra"):
        merge.merged_table(target, changes.withColumn("Extra", F.lit(1)), "Id", "seq")


def test_notes_table(spark):
    assert merge.notes_table(spark, None) is None
    assert len(merge.notes_table(spark, "n" * 60_000).collect()[0].notes) == 49_999


def test_top_n_ties_broken_by_id(spark):
    rows = [("o", f"id{i:02d}", 10.0 if i < 12 else float(i)) for i in range(15)]
    df = spark.createDataFrame(rows, "owner string, Id string, qb double")
    got = [r.Id for r in top_n(df, ["owner"], [F.desc("qb"), F.desc("Id")], 10).orderBy("rank").collect()]
    # 3 largest distinct amounts, then the 7 largest ids among the 12 tied at 10.0
    assert got == ["id14", "id13", "id12", "id11", "id10", "id09", "id08", "id07", "id06", "id05"]


def test_complete_levels_null_key(spark):
    stats = spark.createDataFrame([(None, "b", 1.0), ("m", "a", 2.0)], "k string, lvl string, v double")
    full = complete_levels(stats, stats, ["k"], "lvl", ["a", "b", "c"])
    got = {(r.k, r.lvl): r.v for r in full.collect()}
    assert len(got) == 6 and got[(None, "b")] == 1.0 and got[("m", "a")] == 2.0 and got[("m", "c")] is None


def test_classify_multi_select(spark):
    df = spark.createDataFrame([("1", "PROMO;SMALL", "Term Flip", "UK", "Closed Won"),
                                ("2", "UNKNOWN", "New Logo", None, "Nurture"),
                                ("3", None, None, "LATAM", None)],
                               "Id string, Product string, Type string, Region string, StageName string")
    r = {x.Id: x for x in classify(df).collect()}
    assert r["1"].product_family == "Core;Services" and r["1"].flip_kind == "Term Flip"
    assert r["1"].region_group == "EMEA" and r["1"].is_closed
    assert r["2"].product_family is None and r["2"].type_group == "New Business" and r["2"].is_junk_stage
    assert r["3"].region_group == "North America" and r["3"].is_closed is False


def test_flatten_nested_moves_lead_columns(spark):
    df = spark.createDataFrame([(1, [1, 2], {"a": 1}, "x", "nm")], "id int, arr array<int>, m map<string,int>, label string, name string")
    out = flatten_nested(df)
    assert out.columns == ["name", "label", "id", "_arr", "_m"]
    r = out.collect()[0]
    assert r._arr == "[1,2]" and r._m == '{"a":1}'


def test_classify_with_dimension_table(spark):
    df = spark.createDataFrame([("1", "A;B", "New Logo", "UK", "Closed Won"), ("2", "C", None, None, None)],
                               "Id string, Product string, Type string, Region string, StageName string")
    dim = spark.createDataFrame([("A", "fx"), ("B", "fy"), ("C", "fx")], "product string, family string")
    r = {x.Id: x.product_family for x in classify(df, dim).collect()}
    assert r == {"1": "fx;fy", "2": "fx"}
    p = classify(df, dim)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p


def test_extract_object_generic(spark):
    from pipewright.plans.enrich import extract_object
    obj = spark.createDataFrame([("x", 10.0, "EUR", 3), ("y", None, "USD", 4)],
                                "`Line Name` string, Price double, CurrencyIsoCode string, Qty int")
    obj = obj.select(F.col("`Line Name`"), F.col("Price").alias("Price", metadata={"type": "currency"}),
                     "CurrencyIsoCode", "Qty")
    cur = spark.createDataFrame([("EUR", 0.8), ("USD", 1.0)], "IsoCode string, ConversionRate double")
    out = extract_object(obj, cur)
    assert out.columns == ["Line_Name", "Price", "CurrencyIsoCode", "Qty", "Price_Converted"]
    assert {r.Line_Name: r.Price_Converted for r in out.collect()} == {"x": 12.5, "y": None}


def test_labels_from_overlapping_lists(spark):
    from pipewright.operators import families
    lists = {"A": ["x", "y", "x;y"], "B": ["y", None], "C": families.rest(["x", "y", "z", None], ["y"], ["q"])}
    assert lists["C"] == ["x", "z", None] and families.index(lists)["y"] == ["A", "B"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(["x", "y", "z", "x;y", "y;z;w", "w", "", None])], "id long, v string")
    got = {r.id: (r.a, r.p, r.t) for r in families.label_by_table(
        df.withColumn("a", families.labels(F.col("v"), lists)).withColumn("p", families.part_labels(F.col("v"), lists)), "v",
        spark.createDataFrame([(k, v) for k, vs in lists.items() for v in vs], "label string, value string"), F.col("id"), "t").collect()}
    want = [["A", "C"], ["A", "B"], ["C"], ["A"], [], [], [], ["B", "C"]]
    assert [got[i][0] for i in range(8)] == want == [got[i][2] for i in range(8)]
    assert [got[i][1] for i in range(8)] == [["A", "C"], ["A", "B"], ["C"], ["A", "B", "C"], ["A", "B", "C"], [], [], ["B", "C"]]
    rest = families.rest_table(spark.createDataFrame([("x",), (None,), ("z",)], "value string"),
                               spark.createDataFrame([("z",), (None,)], "value string"))
    assert [r.value for r in rest.collect()] == ["x"]


def test_level_stats_has_every_level_and_exact_medians(spark):
    import statistics

    from pipewright.operators.complete import level_stats
    rows = [(None, "s", 1), (None, "s", 4), ("m", "t", None), ("m", "s", 7), ("m", "s", 8), ("m", "s", 100)]
    df = spark.createDataFrame(rows, "k string, stage string, days int")
    values = {x: F.when(F.col("stage") == x, F.col("days")) for x in ("s", "t", "u")}
    got = {(r.k, r.level): (r.rank, r["mean"], r["median"]) for r in level_stats(df, ["k"], values, "level", "rank").collect()}
    assert len(got) == 6 and got[("m", "t")] == (2, None, None) and got[(None, "u")] == (3, None, None)
    assert got[("m", "s")] == (1, 115 / 3, float(statistics.median([7, 8, 100]))) and got[(None, "s")] == (1, 2.5, 2.5)


def test_stage_days_pieces_make_the_string(spark):
    from pipewright.plans import scorecard
    from pipewright.registry import PARAMS

    from .conftest import SF001
    base = scorecard.opps_enriched(spark, SF001, PARAMS, with_account=False).checkpoint()
    # one owner and stage with many deals
    many = base.unionByName(base.limit(1).withColumns({"Owner_Name": F.lit("Rep-x"), "Stage": F.lit("Proposal"), "QB": F.lit(5.0),
        "Category": F.lit("New"), "rpt_qtr": F.lit(19983)}).drop("OppId", "Days_Stale").crossJoin(
        spark.range(500).select(F.format_string("x%05d", "id").alias("OppId"), F.col("id").cast("int").alias("Days_Stale"))))
    pieces = scorecard.stage_days(spark, SF001, PARAMS, base=many, piece=7).collect()
    assert max(len(r.days.split(", ")) for r in pieces) == 7
    by = {}
    for r in sorted(pieces, key=lambda r: r.piece):
        place, text = by.get((r.Owner_Name, r.Stage_Name), (0, []))
        assert r.first_place == place + 1 and r.entries == len(r.days.split(", ")) and r.entries_so_far == place + r.entries
        by[r.Owner_Name, r.Stage_Name] = r.entries_so_far, [*text, r.days]
    mix = {(r.Owner_Name, r.Stage_Name): (r.Count, r.Days_In_Stage) for r in scorecard.stage_mix(spark, SF001, PARAMS, base=many).collect()}
    assert {k: (n, ", ".join(t)) for k, (n, t) in by.items()} == mix and mix["Rep-x", "Proposal"][0] == 500
