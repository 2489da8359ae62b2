"""Conversation structure repair: the cheapest edits that give a conversation its form.

The form is ``(s?(ua)+)?`` over the initials of the roles: an optional system turn, then
user and assistant in turns. Keep costs 0, Rerole (to user or assistant) 1, Delete 2,
Insert (an empty user or assistant turn) 5; a truncated row that is not deleted costs 5
more; blank and duplicate rows have to be deleted. Of the cheapest edits those with the
least string of initials (D, I, K, R; "audit") win.

Both orders are one integer: its high digits are the cost, its low digits (a fixed
number, base 8) the audit's letters from the left, zeros at the end, so the smaller
integer is the cheaper edit and at equal cost the lesser audit. A plain minimum over the
edges (row, place in the form) of an acyclic graph decides everything.

Rows are put in order by a range partition of (conversation, turn, role, text), which
cuts conversations of any size. Inside a task a conversation of at most ``SEGMENT`` rows is done at
once. Longer ones, and those at a task's ends, are summed up by segments of ``SEGMENT`` rows:
for each two places in the form the least integer that leads from one to the other. A
conversation's segments are put together in order; of two ways to one place neither
audit begins the other (the same letters cost the same), so the lesser one stays the
lesser whatever follows. Letters that all ways share are final, and their rows are
hashed and forgotten, so a task streams. Only the audit is held whole, as it is a result.

Rows equal in all columns are one row with a count. Earlier rows of the same role and
text are found by an aggregate, of which only texts that occur twice come back.

Edge cases: null role and text are one space; a null turn comes first and counts for no
gap; null ids are a conversation; rows of one turn are ordered by role, then text;
a conversation whose rows are all dropped has zeros, an empty audit and the hash of
nothing; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import os
from collections import deque
from collections.abc import Iterator
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pipewright.llm.common import store

SEGMENT = 64
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
LETTER = {"D": 1, "I": 2, "K": 3, "R": 4}  # in ASCII order; 0 ends an audit
START, SYSTEM, USER, ASSISTANT = range(4)  # places in the form: what stood last
KEEPS = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
NEXT = [USER, USER, ASSISTANT, USER]  # what an inserted or reroled turn becomes
NAMES = {USER: "user", ASSISTANT: "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\x0b\x0c\r"

Row = tuple[str, str, str]  # initial, fault ("" or the first letter of blank, duplicate, truncated), role:text


def least(rows: list[Row], ends: list[int]) -> list[int | None]:
    """For each place to begin at, the least integer that leads over all rows to one of ``ends`` (None: no way)."""
    width = 3 * (len(rows) + (DELETE * len(rows) + 2 * INSERT) // INSERT)  # no cheapest way inserts more
    mask = (1 << width) - 1

    def step(letter: str, cost: int, rest: int | None) -> int | None:
        if rest is None:
            return None
        return (((rest >> width) + cost) << width) | (LETTER[letter] << (width - 3)) | ((rest & mask) >> 3)

    def insert(way: list[int | None]) -> list[int | None]:
        """A turn may be put in front of each way; two at most, since a third comes to a place passed before."""
        once = [_min(way[s], step("I", INSERT, way[NEXT[s]])) for s in range(4)]
        return [_min(once[s], step("I", INSERT, once[NEXT[s]])) for s in (START, SYSTEM)] + once[USER:]

    way = insert([0 if s in ends else None for s in range(4)])
    for initial, fault, _ in reversed(rows):
        new = []
        for s in range(4):
            best = step("D", DELETE, way[s])
            if fault not in ("b", "d"):
                more = TRUNCATED if fault == "t" else 0
                best = _min(best, step("R", REROLE + more, way[NEXT[s]]))
                if (s, initial) in KEEPS:
                    best = _min(best, step("K", KEEP + more, way[KEEPS[s, initial]]))
            new.append(best)
        way = insert(new)
    return [None if w is None else _read(w, width) for w in way]


def _min(a: int | None, b: int | None) -> int | None:
    return b if a is None else a if b is None else min(a, b)


def _read(value: int, width: int) -> tuple[int, str]:
    """Cost and audit."""
    letters = value & ((1 << width) - 1)
    return value >> width, f"{letters:0{width // 3}o}".translate({48: None, 49: "D", 50: "I", 51: "K", 52: "R"}) if width else ""


class _Repair:
    """Applies decided letters to rows in order, and hashes what comes out."""

    def __init__(self, texts: bool):
        self.rows: deque[Row] = deque()
        self.place, self.first, self.hash, self.out = START, True, hashlib.sha256(), [] if texts else None

    def apply(self, letters: str) -> None:
        for x in letters:
            row = None if x == "I" else self.rows.popleft()
            if x == "D":
                continue
            self.place = KEEPS[self.place, row[0]] if x == "K" else NEXT[self.place]
            line = row[2] if x == "K" else f"{NAMES[self.place]}:{'' if row is None else row[2].split(':', 1)[1]}"
            self.hash.update(line.encode() if self.first else b"\n" + line.encode())
            self.first = False
            if self.out is not None:
                self.out.append(line)


def _facts(rows: list[Row], turns: list[int | None]) -> dict:
    faults = [r[1] for r in rows]
    known = [t for t in turns if t is not None]
    return {"blank": faults.count("b"), "duplicate": faults.count("d"), "truncated": faults.count("t"),
            "illegal": sum(a[0] + b[0] not in LEGAL for a, b in pairwise(rows)),
            "low": known[0] if known else None, "high": known[-1] if known else None,
            "turns": sum(a != b for a, b in pairwise(known)) + bool(known)}


def _gaps(f: dict) -> int:
    return 0 if f["low"] is None else f["high"] - f["low"] + 1 - f["turns"]


COUNTS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
DONE = f"conv_id long, {COUNTS}, audit string, repaired_sha256 string, repaired string"
PARTIAL = (f"{DONE}, part int, seq long, low long, high long, turns long, costs array<long>, audits array<string>, "
           "initials array<string>, faults array<string>, lines array<string>")
ROWS = "conv_id long, turn long, role string, text string, n long, later boolean"


def _batch(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(c, kinds[k]) for c, k in (x.split() for x in ddl.split(", "))])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, int | None, Row]]:
    for batch in batches:
        for conv, turn, role, text, n, later in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "n", "later"))):
            bare = text.rstrip(SPACE)
            own = "b" if not bare else "d" if later else "" if bare[-1] in ".!?" else "t"
            line = f"{role}:{text}"
            yield conv, turn, (role[:1], own, line)
            for _ in range(n - 1):
                yield conv, turn, (role[:1], "b" if not bare else "d", line)


def _segments(size: int, texts: bool):
    """Sorted rows -> conversations that lie inside the task, and segments of the others."""
    schema = _arrow(PARTIAL)

    def segment(conv, part, seq, rows, turns):
        ways = [least(rows, [t]) for t in range(4)]  # to, from
        flat = [ways[t][s] for s in range(4) for t in range(4)]
        return _facts(rows, turns) | {"conv_id": conv, "part": part, "seq": seq, "costs": [-1 if w is None else w[0] for w in flat],
                                      "audits": ["" if w is None else w[1] for w in flat],
                                      "initials": [r[0] for r in rows], "faults": [r[1] for r in rows], "lines": [r[2] for r in rows]}

    def whole(conv, rows, turns):
        cost, audit = least(rows, [START, ASSISTANT])[START]
        facts, repair = _facts(rows, turns), _Repair(texts)
        repair.rows.extend(rows)
        repair.apply(audit)
        return facts | {"conv_id": conv, "gaps": _gaps(facts), "cost": cost, "audit": audit, "repaired_sha256": repair.hash.hexdigest(),
                        "repaired": "\n".join(repair.out) if texts else None}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()
        out, rows, turns, now, seq, edge = [], [], [], None, 0, True
        for conv, turn, row in _rows(batches):
            if rows and conv != now:  # a conversation is full, and it began in this task unless it is the first
                out.append(segment(now, part, seq, rows, turns) if edge or seq else whole(now, rows, turns))
                rows, turns, seq, edge = [], [], 0, False
            elif len(rows) == size:
                out.append(segment(now, part, seq, rows, turns))
                rows, turns, seq = [], [], seq + 1
            now = conv
            rows.append(row)
            turns.append(turn)
            if len(out) >= 256:
                yield _batch(out, schema)
                out = []
        if rows:
            out.append(segment(now, part, seq, rows, turns))
        if out:
            yield _batch(out, schema)
    return run


class _Joined:
    """One conversation from its segments, in order."""

    def __init__(self, conv, texts: bool):
        self.conv, self.repair, self.facts, self.initial = conv, _Repair(texts), None, None
        self.ways: list[tuple[int, str] | None] = [(0, ""), None, None, None]
        self.audit: list[str] = []

    def _settle(self) -> None:
        shared = os.path.commonprefix([w[1] for w in self.ways if w])
        if shared:
            self.audit.append(shared)
            self.repair.apply(shared)
            self.ways = [w and (w[0], w[1][len(shared):]) for w in self.ways]

    def add(self, s: dict) -> None:
        rows = list(zip(s["initials"], s["faults"], s["lines"]))
        self.repair.rows.extend(rows)
        new: list[tuple[int, str] | None] = []
        for t in range(4):
            found = [(self.ways[x][0] + s["costs"][4 * x + t], self.ways[x][1] + s["audits"][4 * x + t])
                     for x in range(4) if self.ways[x] and s["costs"][4 * x + t] >= 0]
            new.append(min(found, default=None))
        self.ways = new
        self._settle()
        if self.facts is None:
            self.facts = {k: s[k] for k in ("blank", "duplicate", "truncated", "illegal", "low", "high", "turns")}
        else:
            f = self.facts
            for k in ("blank", "duplicate", "truncated", "illegal"):
                f[k] += s[k]
            f["illegal"] += self.initial + rows[0][0] not in LEGAL
            if s["low"] is not None:
                f["turns"] += s["turns"] - (f["high"] == s["low"])
                f["low"] = s["low"] if f["low"] is None else f["low"]
                f["high"] = s["high"]
        self.initial = rows[-1][0]

    def done(self) -> dict:
        final = least([], [START, ASSISTANT])
        cost, audit = min((w[0] + f[0], w[1] + f[1]) for w, f in zip(self.ways, final) if w and f)
        self.repair.apply(audit)
        facts = {k: v for k, v in self.facts.items() if k in ("blank", "duplicate", "truncated", "illegal")}
        return facts | {"conv_id": self.conv, "gaps": _gaps(self.facts), "cost": cost, "audit": "".join(self.audit) + audit,
                        "repaired_sha256": self.repair.hash.hexdigest(),
                        "repaired": None if self.repair.out is None else "\n".join(self.repair.out)}


def _join(texts: bool):
    schema = _arrow(DONE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                s = batch.slice(i, 1).to_pylist()[0]
                if held is None or held.conv != s["conv_id"]:
                    if held is not None:
                        out.append(held.done())
                    held = _Joined(s["conv_id"], texts)
                held.add(s)
            if len(out) >= 256:
                yield _batch(out, schema)
                out = []
        if held is not None:
            out.append(held.done())
        if out:
            yield _batch(out, schema)
    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with known faults: by crc32 of ``conv_id:turn`` modulo 20, a row is 0 dropped, 1 emptied,
    2 without its ``[.!?]``, 3 twice (``n``), 4 of role user."""
    one = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), one), F.lit(":"), F.coalesce(F.col("turn").cast("string"), one))
    h = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", one), F.coalesce("role", one)
    return conversations.where(h != 0).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.when(h == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(h == 1, F.lit("")).when(h == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(h == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("n"))


def repair(rows: DataFrame, conversations: DataFrame, segment: int = SEGMENT, texts: bool = False) -> DataFrame:
    """One row per ``conv_id`` of ``conversations``: gaps, faults, cost, audit and hash of the repaired text
    (``texts``: and the text, ``repaired``). ``rows``: conv_id, turn, role, text, n (how often)."""
    one = F.lit(" ")
    rows = rows.select("conv_id", "turn", F.coalesce("role", one).alias("role"), F.coalesce("text", one).alias("text"), "n")
    rows = store(rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")))
    place = F.struct(F.col("turn").isNotNull().alias("known"), "turn")
    print_ = F.md5(F.col("text").cast("binary"))
    again = rows.groupBy(F.col("conv_id").alias("__c"), F.col("role").alias("__r"), print_.alias("__t")).agg(
        F.count("*").alias("k"), F.min(place).alias("__first"))
    again = store(again.where("k > 1").drop("k"))
    marked = rows.join(again, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("role") == F.col("__r")) & (print_ == F.col("__t")), "left")
    marked = marked.select("conv_id", "turn", "role", "text", "n", F.coalesce(place > F.col("__first"), F.lit(False)).alias("later"))
    order = ["conv_id", "turn", "role", "text"]
    parts = store(marked.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_segments(segment, texts), PARTIAL))
    names = [c.split()[0] for c in DONE.split(", ")]
    cut = parts.where("part is not null").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    done = parts.where("part is null").select(*names).unionByName(cut.mapInArrow(_join(texts), DONE))
    done = done.select(F.col("conv_id").alias("__conv"), *names[1:])
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).groupBy("conv_id").agg(F.lit(1).alias("__one"))
    out = every.join(done, F.col("conv_id").eqNullSafe(F.col("__conv")), "left")
    zero = F.lit(0).cast("long")
    return out.select("conv_id", *[F.coalesce(c, zero).alias(c) for c in names[1:7]], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
                      *([F.coalesce("repaired", F.lit("")).alias("repaired")] if texts else []))
