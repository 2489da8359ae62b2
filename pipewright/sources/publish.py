"""Whole outputs: write beside, check, switch.

A folder of published tables holds one folder per run and a pointer file:

    <out>/runs/<run>/<table>/...   the tables of a run
    <out>/CURRENT                  the run that readers see

``publish`` writes every table of a run to its own new folder, counting the
rows as they are written, reads the files back and compares the counts, and
only then replaces the pointer, by one rename of a file. Whatever fails before
leaves the last whole run as it is; its half-written folder is removed by the
next publication. Readers name the folder, not the run.

A table can be given an order. It is then range-partitioned and sorted before
the write, so the numbered part files are in that order and so are the rows in
each; ``read_in_order`` gives them back in it. (A plain read deals files to
tasks by size.)

All file work goes through the file system of the path (local, HDFS or an
object store), never through the driver's own disk.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"
KEEP_RUNS = 2


class NotWhole(RuntimeError):
    """A table read back with another number of rows than was written."""


@dataclass
class Table:
    """A table to publish; ``order``: columns it is sorted by, ``partition_by``: folders."""

    df: DataFrame
    order: list[Column | str] = field(default_factory=list)
    partition_by: list[str] = field(default_factory=list)


class Folder:
    """Small file operations on the file system that holds ``path``."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark._jvm
        self.path = path.rstrip("/")
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.fs = self._at("").getFileSystem(self.conf)

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def names(self, name: str = "") -> list[str]:
        at = self._at(name)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def age(self, name: str) -> int:
        return self.fs.getFileStatus(self._at(name)).getModificationTime()

    def read(self, name: str) -> str | None:
        at = self._at(name)
        if not self.fs.exists(at):
            return None
        stream = self.fs.open(at)
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def replace(self, name: str, text: str) -> None:
        """Write ``text`` beside ``name`` and put it in its place by one rename."""
        new = self._at(f"{name}.{uuid.uuid4().hex}")
        stream = self.fs.create(new, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        options = self.jvm.org.apache.hadoop.fs.Options.Rename
        over = self.jvm.java.lang.reflect.Array.newInstance(options.OVERWRITE.getClass(), 1)
        over[0] = options.OVERWRITE
        self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf).rename(new, self._at(name), over)

    def remove(self, name: str) -> None:
        self.fs.delete(self._at(name), True)


def _ordered(t: Table) -> DataFrame:
    """Range-partitioned and sorted (a global sort writes numbered files in order); else as it is."""
    return t.df.orderBy(*t.order) if t.order else t.df


def _read(spark: SparkSession, path: str, fmt: str, df: DataFrame | None = None) -> DataFrame:
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", "true")
    return (r.schema(df.schema) if df is not None else r).load(path)


def publish(spark: SparkSession, out: str, tables: dict[str, DataFrame | Table], fmt: str = "parquet") -> dict[str, int]:
    """Write all ``tables`` as one run under ``out`` and make it the current one. Rows per table, as read back."""
    folder, run = Folder(spark, out), uuid.uuid4().hex
    rows: dict[str, int] = {}
    for name, t in tables.items():
        t = t if isinstance(t, Table) else Table(t)
        seen = Observation(f"{name}-{run}")
        w = _ordered(t).observe(seen, F.count(F.lit(1)).alias("rows")).write.format(fmt)
        if fmt == "csv":
            w = w.option("header", "true")
        (w.partitionBy(*t.partition_by) if t.partition_by else w).save(f"{out}/runs/{run}/{name}")
        rows[name] = _read(spark, f"{out}/runs/{run}/{name}", fmt, t.df).count()
        if rows[name] != seen.get["rows"]:
            raise NotWhole(f"{name}: {seen.get['rows']} rows written, {rows[name]} read back")
    folder.replace(POINTER, f"{run}\n{fmt}\n{' '.join(tables)}\n")
    _clear(folder, run)
    return rows


def _clear(folder: Folder, run: str) -> None:
    """Remove all but the newest runs; the current one stays in any case."""
    others = sorted((r for r in folder.names("runs") if r != run), key=lambda r: folder.age(f"runs/{r}"), reverse=True)
    for r in others[KEEP_RUNS - 1:]:
        folder.remove(f"runs/{r}")


def current(spark: SparkSession, out: str) -> tuple[str, str, list[str]]:
    """(folder of the published run, its format, its tables)."""
    text = Folder(spark, out).read(POINTER)
    if text is None:
        raise FileNotFoundError(f"nothing is published in {out}")
    run, fmt, names = text.split("\n")[:3]
    return f"{out}/runs/{run}", fmt, names.split()


def read_published(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table of the current run."""
    path, fmt, _ = current(spark, out)
    return _read(spark, f"{path}/{table}", fmt)


def read_in_order(spark: SparkSession, out: str, table: str) -> DataFrame:
    """A table of the current run, its rows in the order they were written in."""
    path, fmt, _ = current(spark, out)
    if fmt != "parquet":
        raise ValueError("rows have a place of their own in parquet files only")
    return _read(spark, f"{path}/{table}", fmt).orderBy("_metadata.file_name", "_metadata.row_index")
