"""Whole outputs: an aborted run leaves the last one, counts are checked, order survives the write."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pipewright.functions import dims
from pipewright.plans import report
from pipewright.registry import PARAMS
from pipewright.sources import dated
from pipewright.sources.publish import Folder, NotWhole, Table, current, publish, read_in_order, read_published

from .conftest import SF001


def test_aborted_run_leaves_the_old_report(spark, tmp_path):
    out = str(tmp_path)
    publish(spark, out, {"a": spark.range(10), "b": spark.range(3)})
    before = current(spark, out)
    bad = spark.range(1000).select(F.when(F.col("id") == 700, F.raise_error(F.lit("half way"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="half way"):
        publish(spark, out, {"a": spark.range(99), "b": bad})
    assert current(spark, out) == before
    assert (read_published(spark, out, "a").count(), read_published(spark, out, "b").count()) == (10, 3)
    # the next whole run replaces it, and the half-written one is not kept beside the last two
    assert publish(spark, out, {"a": spark.range(5)}) == {"a": 5}
    assert read_published(spark, out, "a").count() == 5 and current(spark, out)[2] == ["a"]
    assert len(Folder(spark, out).names("runs")) == 2


def test_rows_lost_on_the_way_are_found(spark, tmp_path, monkeypatch):
    from pipewright.sources import publish as module
    read = module._read
    monkeypatch.setattr(module, "_read", lambda *a: read(*a).limit(4))
    with pytest.raises(NotWhole, match="10 rows written, 4 read back"):
        publish(spark, str(tmp_path), {"a": spark.range(10)})
    monkeypatch.undo()
    with pytest.raises(FileNotFoundError):
        current(spark, str(tmp_path))


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_formats_and_empty_tables(spark, tmp_path, fmt):
    empty = spark.range(0).withColumn("t", F.lit("x"))
    assert publish(spark, str(tmp_path), {"e": empty, "f": empty.union(spark.range(2).withColumn("t", F.lit("y")))}, fmt) == {"e": 0, "f": 2}
    assert read_published(spark, str(tmp_path), "f").columns == ["id", "t"]


def test_order_survives_the_write(spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("n"), F.when(F.col("id") % 9 > 0, F.col("id") % 13).alias("g"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps several files
    try:
        publish(spark, str(tmp_path), {"t": Table(rows.repartition(6), [F.asc_nulls_last("g"), F.desc("n")])})
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    path = current(spark, str(tmp_path))[0]
    assert len([f for f in Folder(spark, path).names("t") if f.endswith(".parquet")]) > 1
    got = [tuple(r) for r in read_in_order(spark, str(tmp_path), "t").collect()]
    assert got == sorted(got, key=lambda r: (r[1] is None, r[1] or 0, -r[0])) and len(got) == 5000


def test_outcome_reads_back_by_category_geo_product(spark, tmp_path):
    report.run_quarter_report(spark, SF001, PARAMS, str(tmp_path))
    rows = [(r.Category, r.Geo, r.Product) for r in read_in_order(spark, str(tmp_path), "pivot_data").collect()]
    assert rows == sorted(rows, key=lambda r: [(x is None, x or "") for x in r])
    assert any(r[0] is None for r in rows) and rows[-1][0] is None
    regions = [r[0] for r in read_in_order(spark, str(tmp_path), "new_business").select("Merged_Account_Region_bucket").collect()]
    assert regions == sorted(regions, reverse=True) and set(regions) <= {dims.BUCKET_NORTH_AMERICA, dims.BUCKET_REST}


def test_dated_tables_are_found_by_name_and_window(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS daily")
    for name, cols in (("snap_20240130", "1 a, 'x' b"), ("snap_20240131", "2 a"), ("snap_20240201", "cast(3 as bigint) a, 'z' b"),
                       ("snap_20240299", "4 a"), ("snap_latest", "5 a"), ("other_20240131", "6 a")):
        spark.sql(f"DROP TABLE IF EXISTS daily.{name}")
        spark.sql(f"SELECT {cols}").write.option("path", f"{tmp_path}/{name}").saveAsTable(f"daily.{name}")
    found = dated.find_dated(spark, "snap_", dt.date(2024, 1, 30), dt.date(2024, 2, 2), "daily")
    assert found == [(dt.date(2024, 1, 30), "daily.snap_20240130"), (dt.date(2024, 1, 31), "daily.snap_20240131"),
                     (dt.date(2024, 2, 1), "daily.snap_20240201")]
    assert len(dated.find_dated(spark, "snap_", dt.date(2024, 1, 31), dt.date(2024, 2, 1), "daily")) == 1
    both = dated.bind_dated(spark, found)
    assert sorted(map(tuple, both.select("a", "b", "snapshot_date").collect())) == [
        (1, "x", dt.date(2024, 1, 30)), (2, None, dt.date(2024, 1, 31)), (3, "z", dt.date(2024, 2, 1))]
    with pytest.raises(ValueError):
        dated.bind_dated(spark, [])


def test_partition_days_come_from_folder_names(spark, tmp_path):
    df = spark.createDataFrame([(i, dt.date(2024, 1, i)) for i in (1, 5, 9)], "Id long, snapshot_date date")
    df.write.partitionBy("snapshot_date").parquet(f"{tmp_path}/h")
    assert dated.partition_days(spark, f"{tmp_path}/h", dt.date(2024, 1, 2), dt.date(2024, 1, 9)) == [dt.date(2024, 1, 5)]
