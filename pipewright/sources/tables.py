"""Raw table scans.

Every read goes through :func:`read` with the columns the caller needs, so the
Parquet scan's ReadSchema holds only those columns and filters on them are
pushed to the scan.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def read(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path(sf_dir, name))
    return df.select(*columns) if columns else df


def register_views(spark: SparkSession, sf_dir: str, names: list[str] | None = None) -> list[str]:
    """Register raw tables as temp views (for ``spark.sql`` users)."""
    done = []
    for n in names or TABLES:
        if os.path.exists(path(sf_dir, n)):
            read(spark, sf_dir, n).createOrReplaceTempView(n)
            done.append(n)
    return done


def list_objects(spark: SparkSession) -> DataFrame:
    """Available tables and views of the session catalog, one row each.

    Catalog metadata is small (one row per table), so building it on the
    driver is bounded by the number of tables, not by data.
    """
    rows = [(t.name, t.tableType, bool(t.isTemporary)) for t in spark.catalog.listTables()]
    schema = T.StructType([T.StructField("name", T.StringType()),
                           T.StructField("table_type", T.StringType()),
                           T.StructField("is_temporary", T.BooleanType())])
    return spark.createDataFrame(sorted(rows), schema)


def currency_fields(df: DataFrame) -> list[str]:
    """Fields whose metadata marks them as currency amounts."""
    return [f.name for f in df.schema.fields if (f.metadata or {}).get("type") == "currency"]


def describe_fields(df: DataFrame) -> DataFrame:
    """(name, type, metadata json) per field: the schema as a small table."""
    import json
    spark = df.sparkSession
    rows = [(f.name, f.dataType.simpleString(), f.nullable, json.dumps(f.metadata or {}, sort_keys=True))
            for f in df.schema.fields]
    return spark.createDataFrame(rows, "name string, type string, nullable boolean, metadata string")
