"""NULL / zero / rounding / period rules on hand-made micro tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pipewright.functions import nulls, periods
from pipewright.functions.money import money, scrub_currency, scrub_usd, usd
from pipewright.functions.text import clean_name, truncate_notes
from pipewright.operators import joins


def one(df):
    return df.collect()[0]


def test_in_set_null_is_false_and_negation_keeps_null(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "x string")
    got = {r.x: r.keep for r in df.select("x", nulls.not_in_set(F.col("x"), ["a"]).alias("keep")).collect()}
    assert got == {"a": False, None: True, "b": True}
    assert df.where(nulls.sql_not_in(F.col("x"), ["a"])).count() == 1          # NULL dropped
    assert df.where(nulls.not_in_or_null(F.col("x"), ["a"])).count() == 2      # NULL kept


def test_cond_sum_over_nothing_is_zero_and_ratio_of_zero_is_null(spark):
    df = spark.createDataFrame([(1.5, False), (2.0, False)], "x double, p boolean")
    r = one(df.agg(nulls.cond_sum(F.col("p"), money(F.col("x"))).alias("s"),
                   nulls.safe_ratio(F.lit(1.0), F.lit(0.0)).alias("inf"),
                   nulls.safe_ratio(F.lit(0.0), F.lit(0.0)).alias("nan")))
    assert float(r.s) == 0 and r.inf is None and r.nan is None


@pytest.mark.parametrize("x,expect", [(2.5, 2.0), (3.5, 4.0), (-2.5, -2.0), (0.125, 0.12)])
def test_round_half_even(spark, x, expect):
    digits = 2 if x == 0.125 else 0
    r = one(spark.range(1).select(nulls.round_half_even(F.lit(x), digits).alias("r")))
    assert r.r == expect


def test_round_half_up_at_cent(spark):
    r = one(spark.range(1).select(nulls.round_half_up(F.lit(1.005), 2).alias("a"),
                                  nulls.round_half_up(F.lit(2.675), 2).alias("b")))
    # computed as round(x * 100) / 100: the product decides, identically in every engine
    assert (r.a, r.b) == (round(1.005 * 100) / 100, 2.68 if round(2.675 * 100) == 268 else 2.67)


def test_least_skips_null_all_null_is_null(spark):
    df = spark.createDataFrame([(1.0, None, 3.0), (None, None, None)], "a double, b double, c double")
    assert [r.m for r in df.select(F.least("a", "b", "c").alias("m")).collect()] == [1.0, None]


def test_fill_bads_and_na_subtract(spark):
    df = spark.createDataFrame([(-3.0, None), (float("nan"), 2.0), (4.0, 1.0)], "a double, b double")
    r = df.select(nulls.fill_bads(F.col("a")).alias("f"), nulls.na_subtract(F.col("a"), F.col("b")).alias("d")).collect()
    assert [x.f for x in r] == [0.0, None, 4.0]
    assert r[0].d == -3.0 and r[2].d == 3.0


def test_money_units_are_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (0.3,)], "x double")
    assert one(df.agg(usd(F.sum(money(F.col("x")))).alias("s"))).s == 0.6


def test_periods_ceiling_on_boundary_goes_to_next():
    assert periods.ceil_quarter(dt.date(2024, 1, 1)) == dt.date(2024, 4, 1)
    assert periods.ceil_quarter(dt.date(2024, 2, 15)) == dt.date(2024, 4, 1)
    assert periods.ceil_quarter(dt.date(2024, 12, 31)) == dt.date(2025, 1, 1)
    p = periods.ReportParams(rpt_date=dt.date(1998, 8, 15), anchor=dt.date(1998, 7, 10))
    assert (p.q_start, p.q_end, p.q_key, p.q_label) == (dt.date(1998, 7, 1), dt.date(1998, 10, 1), 19983, "Q3-1998")
    assert (p.rpt_start, p.rpt_end) == (dt.date(1997, 1, 1), dt.date(1999, 1, 1))
    assert (p.past_q_start, p.past_q_end) == (dt.date(1998, 4, 1), dt.date(1998, 7, 1))
    assert p.unit == (dt.date(1997, 1, 1), dt.date(1998, 1, 1))


def test_period_columns_match_driver_side(spark):
    r = one(spark.range(1).select(periods.col_ceil_quarter(F.lit(dt.date(2024, 1, 1))).alias("c"),
                                  periods.col_quarter_key(F.lit(dt.date(1998, 8, 15))).alias("k"),
                                  periods.col_quarter_label(F.lit(dt.date(1998, 8, 15))).alias("l")))
    assert (r.c, r.k, r.l) == (dt.date(2024, 4, 1), 19983, "Q3-1998")


def test_currency_scrub(spark):
    df = spark.createDataFrame([("USD 2,000.00",), ("EUR 1,234.50",), ("USD -5.00",), ("",), ("XXX 12",), (None,)],
                               "t string")
    cur = spark.createDataFrame([("USD", 1.0), ("EUR", 0.9)], "IsoCode string, ConversionRate double")
    from pipewright.functions.money import currency_codes_pattern
    r = df.select(scrub_usd(F.col("t")).alias("u"),
                  scrub_currency(F.col("t"), currency_codes_pattern(cur)).alias("c"),
                  scrub_usd(F.col("t"), allow_negative=True).alias("n")).collect()
    assert [x.u for x in r] == [2000.0, None, None, None, None, None]
    assert [x.c for x in r] == [2000.0, 1234.5, None, None, None, None]
    assert r[2].n == -5.0


def test_null_aware_not_in_vs_anti(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "k int")
    ids = spark.createDataFrame([(1,)], "k int")
    empty = spark.createDataFrame([], "k int")
    assert sorted(r.k for r in joins.sql_not_in(df, ids, "k").collect()) == [3]
    assert sorted((r.k is None, r.k) for r in joins.anti(df, ids, "k").collect()) == [(False, 3), (True, None)]
    assert joins.anti(df, empty, "k").count() == 3           # empty list excludes nothing
    assert joins.sql_not_in(df, empty, "k").count() == 3
    with_null = spark.createDataFrame([(1,), (None,)], "k int")
    assert joins.sql_not_in(df, with_null, "k").count() == 0   # NULL in the list: nothing qualifies
    p = joins.sql_not_in(df, ids, "k")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in p


def test_clean_names_and_notes():
    assert clean_name("Owner's Name") == "Owners_Name"
    assert clean_name("Account.Name") == "Account_Name"
    assert clean_name("Amount (USD)%") == "Amount_USD"
    assert truncate_notes("x" * 49_999, 50_000) == "x" * 49_999
    assert len(truncate_notes("x" * 50_000, 50_000)) == 49_999
    assert truncate_notes(None, 50_000) is None


def test_shard_suffix_and_zone(spark):
    import datetime as dt2
    r = one(spark.range(1).select(periods.col_shard_suffix(F.lit(dt.date(1998, 7, 10))).alias("s"),
                                  periods.col_in_zone(F.lit(dt2.datetime(2024, 1, 1, 12, 0)).cast("timestamp"),
                                                      "America/New_York").alias("z")))
    assert r.s == "19980710" and r.z.hour == 7


def test_reshape_helpers(spark):
    from pipewright.operators.reshape import check_columns, keep_common_columns, union_all_by_name
    a = spark.createDataFrame([(1, "x", 2.0)], "id int, Name string, v double")
    b = spark.createDataFrame([(2, "y")], "id int, name string")
    assert keep_common_columns(a, b).columns == ["id"]           # names are case-sensitive
    u = union_all_by_name([a, b.withColumnRenamed("name", "Name")])
    assert u.count() == 2 and u.where("v IS NULL").count() == 1
    with pytest.raises(ValueError):
        check_columns(a, ["id", "Name"])


def test_parameter_validation(spark):
    with pytest.raises(ValueError):
        periods.ReportParams(rpt_date=dt.date(1998, 8, 15), anchor=dt.date(1998, 7, 10), compare="Month")
    with pytest.raises(TypeError):
        periods.ReportParams(rpt_date="1998-08-15", anchor=dt.date(1998, 7, 10))
    q = periods.ReportParams(rpt_date=dt.date(1998, 8, 15), anchor=dt.date(1998, 7, 10), compare="Q")
    assert q.unit == (dt.date(1998, 4, 1), dt.date(1998, 7, 1))
    from pipewright.plans.movement import movement
    with pytest.raises(ValueError):
        movement(spark, "", q, "v9")
