"""Landing CRM objects as tables bucketed by deal id, at a shared path.

The movement report joins the current deals, the anchor snapshot and the
change log on the deal id. With the deals and the snapshot table landed in the
same number of buckets on that key (the snapshot table also partitioned by
day), their join and per-id aggregation read co-located buckets and need no
shuffle; only the change log's small per-id aggregate and the final outcome
aggregation exchange data.

The tables outlive the process that lands them. They are external tables under
a folder that is given, and a small description of them (columns, buckets,
partitions, place) is published beside the data with one pointer switch, so
another process attaches them by that folder alone: ``attach`` declares them
in its own session's catalog, whether or not that catalog is persistent.

Rows are dealt to one task per bucket before the write, so a table has at most
one file per bucket (and day).
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession

from pipewright.sources import crm
from pipewright.sources.publish import Folder

DESCRIPTION = "TABLES"


@dataclass
class Landed:
    """What ``attach`` needs to declare a table."""

    name: str
    path: str
    columns: str
    buckets: int = 0
    bucket_by: str = ""
    partition_by: str = ""


def land(df: DataFrame, path: str, name: str, bucket_by: str = "", buckets: int = 0, partition_by: str = "") -> Landed:
    """Write ``df`` as an external table's files at ``path`` (a new folder)."""
    spark = df.sparkSession
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    table = f"landing_{uuid.uuid4().hex}"
    w = (df.repartition(buckets, bucket_by) if buckets else df).write.format("parquet").option("path", path)
    if buckets:
        w = w.bucketBy(buckets, bucket_by).sortBy(bucket_by)
    (w.partitionBy(partition_by) if partition_by else w).saveAsTable(table)
    spark.sql(f"DROP TABLE {table}")  # an external table: only its name goes
    return Landed(name, path, columns, buckets, bucket_by, partition_by)


def land_crm(spark: SparkSession, sf_dir: str, buckets: int, snapshot_dates: Sequence[dt.date], out: str) -> list[Landed]:
    """Land opportunity and history (per day), bucketed by id, the change log and the lookup tables under ``out``.

    Ids are unique in the opportunity table and once per day in the snapshot
    table, so their buckets are even. The change log is landed unbucketed:
    one deal may hold a large share of its rows, and a bucket cannot be split
    across tasks, whereas its per-id maximum is combined map-side before a
    small shuffle. The new tables are seen only when all are written.
    """
    run = f"{out.rstrip('/')}/landed/{uuid.uuid4().hex}"
    tables = [
        land(crm.opportunity(spark, sf_dir, with_product=True), f"{run}/opportunity", "opportunity", "Id", buckets),
        land(crm.history(spark, sf_dir, snapshot_dates), f"{run}/history", "history", "Id", buckets, "snapshot_date"),
        *(land(df, f"{run}/{name}", name) for name, df in (
            ("field_history", crm.field_history(spark, sf_dir)), ("account", crm.account(spark, sf_dir)),
            ("users", crm.user(spark, sf_dir)), ("user_role", crm.user_role(spark, sf_dir)), ("currency", crm.currency(spark, sf_dir)),
            ("activity", crm.activity(spark, sf_dir)), ("rep_group", crm.rep_group(spark, sf_dir)),
            ("excluded_owner", crm.excluded_owner(spark, sf_dir))))]
    folder = Folder(spark, out)
    folder.replace(DESCRIPTION, json.dumps([asdict(t) for t in tables], indent=1))
    for old in folder.names("landed"):
        if not run.endswith(old):
            folder.remove(f"landed/{old}")
    return tables


def attach(spark: SparkSession, out: str, database: str = "crm") -> dict[str, DataFrame]:
    """Declare the tables landed under ``out`` in this session's catalog, as ``<database>.<table>``."""
    text = Folder(spark, out).read(DESCRIPTION)
    if text is None:
        raise FileNotFoundError(f"nothing is landed in {out}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{out.rstrip('/')}/catalog'")  # holds no data
    found = {}
    for t in (Landed(**x) for x in json.loads(text)):
        name = f"{database}.{t.name}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        parts = f" PARTITIONED BY (`{t.partition_by}`)" if t.partition_by else ""
        spread = f" CLUSTERED BY (`{t.bucket_by}`) SORTED BY (`{t.bucket_by}`) INTO {t.buckets} BUCKETS" if t.buckets else ""
        spark.sql(f"CREATE TABLE {name} ({t.columns}) USING parquet{parts}{spread} LOCATION '{t.path}'")
        if t.partition_by:
            spark.sql(f"MSCK REPAIR TABLE {name}")
        found[t.name] = spark.table(name)
    return found
