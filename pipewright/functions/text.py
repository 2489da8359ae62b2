"""Names, links and other text helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from pipewright.functions.dims import LINK_FORMULA, RECORD_PATH


def clean_name(name: str) -> str:
    """Column name safe for a warehouse table.

    '.' and ' ' become '_', apostrophes go, and any other character that is
    not a letter, digit or '_' is dropped.
    """
    name = name.replace(".", "_").replace(" ", "_").replace("'", "")
    return re.sub(r"[^0-9A-Za-z_]", "", name)


def clean_names(names: list[str]) -> list[str]:
    return [clean_name(n) for n in names]


def record_link(record_id: Column, kind: str, base_url: str) -> Column:
    """URL of a CRM record page; ``base_url`` is the instance host (a parameter)."""
    pre, post = RECORD_PATH.split("{id}")
    pre = pre.replace("{kind}", kind)
    return F.concat(F.lit(base_url.rstrip("/") + pre), record_id.cast("string"), F.lit(post))


def link_formula(url: Column, name: Column) -> Column:
    """Spreadsheet formula text that shows ``name`` and links to ``url``."""
    head, rest = LINK_FORMULA.split("{url}")
    mid, tail = rest.split("{name}")
    return F.concat(F.lit(head), url, F.lit(mid), F.coalesce(name.cast("string"), F.lit("NA")), F.lit(tail))


def truncate_notes(notes: str | None, limit: int) -> str | None:
    """Notes of ``limit`` characters or more are cut to ``limit - 1``."""
    if notes is None:
        return None
    return notes[: limit - 1] if len(notes) >= limit else notes
