"""Labels from overlapping lists of values.

Reports name groups of values by lists ("these products are family A"). Lists
overlap, so a value can have several labels; a list can be the rest of another
("all but these"); and NULL can be listed like any value. An inverted index,
value -> its labels, answers for all lists at once: one lookup per row, not a
test per list.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pipewright.operators import joins

Lists = Mapping[str, Sequence[str | None]]


def rest(every: Sequence[str | None], *taken: Sequence[str | None]) -> list[str | None]:
    """The values of ``every`` that are in none of the ``taken`` lists, in order."""
    gone = set(chain(*taken))
    return [v for v in every if v not in gone]


def index(lists: Lists) -> dict[str | None, list[str]]:
    """value -> sorted labels of the lists that hold it."""
    found: dict[str | None, set[str]] = {}
    for label, values in lists.items():
        for v in values:
            found.setdefault(v, set()).add(label)
    return {v: sorted(labels) for v, labels in found.items()}


def labels(value: Column, lists: Lists) -> Column:
    """Sorted array of the labels of ``value`` (empty: in no list), for lists that stand in the program."""
    found = index(lists)
    none = F.array().cast("array<string>")
    entries = [(F.lit(v), F.array(*map(F.lit, ls))) for v, ls in found.items() if v is not None]
    known = F.coalesce(F.try_element_at(F.create_map(*chain(*entries)), value), none) if entries else none
    missing = F.array(*map(F.lit, found[None])) if None in found else none
    return F.when(value.isNull(), missing).otherwise(known)


def part_labels(value: Column, lists: Lists, separator: str = ";") -> Column:
    """Sorted array of the labels of the parts of a multi-select ``value``."""
    each = F.transform(F.split(value, separator), lambda part: labels(part, lists))
    return F.when(value.isNull(), labels(value, lists)).otherwise(F.array_sort(F.array_distinct(F.flatten(each))))


def index_table(members: DataFrame) -> DataFrame:
    """(label, value) rows -> (value, labels), for lists that are data; their number bounds a value's labels."""
    return members.groupBy("value").agg(F.array_sort(F.collect_set("label")).alias("labels"))


def rest_table(every: DataFrame, taken: DataFrame) -> DataFrame:
    """Rows of ``every`` (value) that are not in ``taken`` (value), NULL being a value."""
    t = taken.select(F.col("value").alias("__v")).distinct()
    return every.join(t, F.col("value").eqNullSafe(F.col("__v")), "left_anti")


def label_by_table(df: DataFrame, column: str, members: DataFrame, spread: Column, name: str = "labels") -> DataFrame:
    """``df`` with the array of labels of ``column`` from a table of (label, value) rows; empty: in no list.

    The index is joined like a lookup table: broadcast when counted small, else salted by ``spread``."""
    found = index_table(members).select(F.col("value").alias("__value"), F.col("labels").alias("__labels"))
    out = joins.lookup(df, found.where("__value is not null"), column, "__value", spread)
    none = F.coalesce(found.where("__value is null").select("__labels").scalar(), F.array().cast("array<string>"))
    return out.withColumn(name, F.when(F.col(column).isNull(), none).otherwise(F.coalesce("__labels", F.array().cast("array<string>")))
                          ).drop("__value", "__labels")
