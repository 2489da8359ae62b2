"""Conversation repair, spelling variants and suffix-array dedup against brute force, on odd rows and on empty tables."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pipewright.llm import conversation_repair as cr
from pipewright.llm import spelling_variants as sv
from pipewright.llm import suffix_dedup as sd
from pipewright.llm.suffix_array import common_suffix, intervals, repeats

# ------------------------------------------------------------------ conversations
FORM = re.compile("(s?(ua)+)?")


def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        bare = text.rstrip(cr.SPACE)
        out.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
        seen.add((role, text))
    return out


def _cheapest(rows, faults):
    """Least (cost, audit, lines) over all edit sequences with at most two inserts, by enumeration."""
    found = []

    def go(i, cost, audit, lines, inserts):
        if i == len(rows):
            if FORM.fullmatch("".join(x[:1] for x in lines)):
                found.append((cost, audit, lines))
        else:
            role, text = rows[i]
            go(i + 1, cost + 2, audit + "D", lines, inserts)
            if faults[i] not in ("b", "d"):
                more = 5 if faults[i] == "t" else 0
                go(i + 1, cost + more, audit + "K", [*lines, f"{role}:{text}"], inserts)
                for to in ("user", "assistant"):
                    go(i + 1, cost + more + 1, audit + "R", [*lines, f"{to}:{text}"], inserts)
        if inserts:
            for new in ("user", "assistant"):
                go(i, cost + 5, audit + "I", [*lines, f"{new}:"], inserts - 1)

    go(0, 0, "", [], 2)
    return min(found)


_row = st.tuples(st.sampled_from(["user", "assistant", "system", "tool", " "]), st.sampled_from(["Hi.", "Yes!", "No", "so ", "", "\t"]))


@settings(max_examples=150, deadline=None)
@given(st.lists(_row, max_size=5))
def test_least_integer_is_the_cheapest_edit(rows):
    faults = _faults(rows)
    cost, audit, lines = _cheapest(rows, faults)
    packed = [(r[0][:1], f, f"{r[0]}:{r[1]}") for r, f in zip(rows, faults)]
    assert cr.least(packed, [cr.START, cr.ASSISTANT])[cr.START] == (cost, audit)
    repair = cr._Repair(texts=True)
    repair.rows.extend(packed)
    repair.apply(audit)
    assert repair.out == lines and repair.hash.hexdigest() == hashlib.sha256("\n".join(lines).encode()).hexdigest()


@settings(max_examples=100, deadline=None)
@given(st.lists(_row, max_size=14), st.integers(1, 5))
def test_segments_join_to_the_whole(rows, size):
    packed = [(r[0][:1], f, f"{r[0]}:{r[1]}") for r, f in zip(rows, _faults(rows))]
    ways = [(0, ""), None, None, None]
    for i in range(0, len(packed), size):
        to = [cr.least(packed[i:i + size], [t]) for t in range(4)]
        ways = [min(((w[0] + to[t][s][0], w[1] + to[t][s][1]) for s, w in enumerate(ways) if w and to[t][s]), default=None) for t in range(4)]
    last = cr.least([], [cr.START, cr.ASSISTANT])
    assert min((w[0] + e[0], w[1] + e[1]) for w, e in zip(ways, last) if w and e) == cr.least(packed, [cr.START, cr.ASSISTANT])[cr.START]


def _expected(data):
    out = {}
    for conv in {d[0] for d in data}:
        rows = []
        for c, turn, role, text in (d for d in data if d[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            h = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
            if h:
                text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
                rows += [(turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults = _faults([r[1:] for r in rows])
        packed = [(r[1][:1], f, f"{r[1]}:{r[2]}") for r, f in zip(rows, faults)]
        cost, audit = cr.least(packed, [cr.START, cr.ASSISTANT])[cr.START]
        repair = cr._Repair(texts=True)
        repair.rows.extend(packed)
        repair.apply(audit)
        turns = [r[0] for r in rows if r[0] is not None]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
                     sum(a[1][:1] + b[1][:1] not in cr.LEGAL for a, b in zip(rows, rows[1:])), cost, audit,
                     hashlib.sha256("\n".join(repair.out).encode()).hexdigest())
    return out


@pytest.fixture(scope="module")
def chats():
    r = random.Random(5)
    data = [(c or None, r.choice([t, t, t, t + 3, None]), r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None]),
             r.choice(["Hi.", "Yes!", "No", "x y?", "", None, "é."]))
            for c in range(80) for t in range(r.choice([0, 1, 2, 4, 9]))]
    data += [(500, t, "user" if t % 3 else "assistant", f"m{t % 90}.") for t in range(700)]  # a conversation over many segments and tasks
    data += [(501, 1, "user", "Same.")] * 300  # one row, many times
    data += [(502, None, "user", f"n{t}") for t in range(200)]
    return data


CHAT = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("segment", [64, 5, 1])
def test_conversations(spark, chats, segment):
    df = spark.createDataFrame(chats, CHAT).repartition(7).withColumns({c: F.lit(3) for c in ("n", "cost", "audit", "later", "part", "__one")})
    got = {r[0]: tuple(r)[1:] for r in cr.repair(cr.damaged(df), df, segment=segment).collect()}
    want = _expected(chats)
    assert got == want and got[500][5] > 0 and len(got[502][6]) >= 150


def test_conversation_texts_and_empty_tables(spark, chats):
    df = spark.createDataFrame(chats, CHAT)
    for r in cr.repair(cr.damaged(df), df, texts=True).collect():
        assert hashlib.sha256(r.repaired.encode()).hexdigest() == r.repaired_sha256
        assert FORM.fullmatch("".join(x[:1] for x in r.repaired.split("\n")))
    none = df.limit(0)
    assert cr.repair(cr.damaged(none), none).collect() == []
    gone = cr.repair(cr.damaged(none), df.where("conv_id = 500")).collect()
    assert [tuple(r) for r in gone] == [(500, 0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())]


# ------------------------------------------------------------------ spelling
def _near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def _words(docs):
    n = Counter()
    for doc, text in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", (text or "").translate({i: i + 32 for i in range(65, 91)})):
            h = zlib.crc32(f"{'' if doc is None else doc}:{w}".encode())
            w = w[:h % len(w)] + w[h % len(w) + 1:] if h % 97 == 0 else w
            n[w] += len(w) >= 5
    return {w: c for w, c in n.items() if c >= 3}


def _variants(n):
    form, out = {}, {}
    for w in n:
        near = [v for v in n if _near(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
        out[w] = len(near)
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out[w] = (form[w], root, n[w], out[w], n.get(form[w]))
    return out


@pytest.fixture(scope="module")
def prose():
    r = random.Random(9)
    docs = [(i, " ".join("".join(r.choice("abÀé") for _ in range(r.choice([4, 5, 5, 6]))) for _ in range(60)).title()) for i in range(120)]
    long = "ab" * 3000
    docs += [(None, None), (None, "Élan!éLAN"), (7000, ""), (7001, "x1y2z3 -- \x00"), (7002, f"{long} {long}a {long} {long}a {long} {long}a {long}"),
             (7003, "naïve naïve naïve naïv naïv naïv naïve naïve naïve"),
             (7004, "lampion " * 3 + "lampios " * 6 + "lampis " * 12)]
    return [*docs, *docs[:3]]


@pytest.mark.parametrize("symbols, bits", [(8, 26), (2, 15), (3, 20)])
def test_variants(spark, prose, symbols, bits):
    df = spark.createDataFrame(prose, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("word", "n", "id", "near")})
    got = {r[0]: tuple(r)[1:] for r in sv.variants(sv.misspelt_words(df), symbols=symbols, bits=bits).collect()}
    want = _variants(_words(prose))
    assert got == want and any(v[0] for v in want.values()) and any(v[1] != w and v[1] != v[0] for w, v in want.items())
    assert len([w for w in got if len(w) >= 6000]) == 2


def test_variants_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert sv.variants(sv.misspelt_words(df)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.text("abcÿ", min_size=1, max_size=9), st.integers(1, 8))
def test_neighbourhood_holds_every_edit(word, symbols):
    reduced = sv._Reduced([word], symbols)
    h = {int(x) for _, hs in reduced.neighbours() for x in hs}
    others = [word[:i] + c + word[i + k:] for i in range(len(word) + 1) for c in ["", *"abcÿz"] for k in (0, 1) if i + k <= len(word)]
    others = [o for o in others if o]
    assert {int(x) for x in sv._Reduced(others, symbols).own()} <= h


# ------------------------------------------------------------------ suffix array
def _covered(texts, size):
    starts = Counter(t[p:p + size] for t in texts for p in range(len(t) - size + 1))
    for t in texts:
        out = [False] * len(t)
        for p in range(len(t) - size + 1):
            if starts[t[p:p + size]] > 1:
                out[p:p + size] = [True] * size
        yield out


@pytest.fixture(scope="module")
def strings():
    r = random.Random(4)
    texts = [(i, "".join(r.choice("ab" if i % 2 else "abcé") for _ in range(r.choice([0, 3, 12, 40, 300])))) for i in range(40)]
    passage = "".join(r.choice("abcdefgh") for _ in range(25))
    texts += [(100 + i, "".join(r.choice("xyz") for _ in range(15)) + passage + "".join(r.choice("xyz") for _ in range(15))) for i in range(30)]
    return [*texts, (200, "a" * 100), (201, "ab" * 60), (None, None), (None, "no id"), (None, passage), (7, texts[7][1]), (202, None)]


@pytest.mark.parametrize("bucket, parts", [(4096, 8), (3, 2), (3, 1)])
def test_suffix_dedup(spark, strings, bucket, parts):
    df = spark.createDataFrame(strings, "doc_id long, text string").repartition(5).withColumns(
        {c: F.lit(1) for c in ("row", "key", "context", "left", "bucket", "covers", "id0", "low")})
    got = sorted((r.row.doc_id or -1, bytes(r.kept), r.n_bytes, r.n_removed, r.n_spans) for r in sd.suffix_dedup(df, 12, 4, bucket, parts).collect())
    raw = [(i, (t or "").encode()) for i, t in strings]
    want = []
    for (i, t), out in zip(raw, _covered([t for _, t in raw], 12)):
        want.append((i or -1, bytes(b for b, gone in zip(t, out) if not gone), len(t), sum(out),
                     sum(gone and (p == 0 or not out[p - 1]) for p, gone in enumerate(out))))
    assert got == sorted(want) and sum(w[3] for w in want) > 500


def test_suffix_dedup_of_nothing(spark):
    assert sd.suffix_dedup(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_long_texts_are_cut_into_blocks_without_a_seam():
    import numpy as np
    r = random.Random(8)
    data = np.array([r.choice(b"abc") for _ in range(5000)], np.uint8)
    ends = np.array([0, 1200, 1200, 1230, 4000, 5000])

    def run(block):
        return [tuple(int(x) for x in row) for part in sd.suffixes(data, ends, 40, 8, block) for row in zip(*part)]
    whole = run(1 << 16)
    assert whole == run(64) == run(701) and len(whole) > 100 and {w[0] for w in whole} == {0, 3, 4}


def test_maximal_repeats_name_all_occurrences(spark, strings):
    df = spark.createDataFrame([s for s in strings if s[0] is not None and s[0] != 7], "doc_id long, text string")
    texts = {i: (t or "").encode() for i, t in strings if i is not None and i != 7}
    groups = defaultdict(set)
    for r in sd.maximal_repeats(df, 12, 4).collect():
        groups[bytes(r.repeat), r.n_bytes].add((r.doc_id, r.start))
    assert groups
    everywhere = defaultdict(set)
    for (_, n), places in groups.items():
        held = {texts[d][s:s + n] for d, s in places}
        assert len(held) == 1 and n >= 12
        string = held.pop()
        if not everywhere[string]:
            everywhere[string] = {(d, p) for d, t in texts.items() for p in range(len(t) - n + 1) if t[p:p + n] == string}
        assert len(places) > 1 and places == everywhere[string]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=12))
def test_interval_tree(common):
    got = sorted(intervals(common, 2))
    want = set()
    for i in range(len(common)):
        for j in range(i, len(common)):
            depth = min(common[i:j + 1])
            if depth >= 2 and (i == 0 or common[i - 1] < depth) and (j + 1 == len(common) or common[j + 1] < depth):
                want.add((depth, i, j + 1))
    assert got == sorted(want)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text("ab", max_size=4), st.text("ab", max_size=4)), min_size=2, max_size=9, unique=True), st.integers(3, 6))
def test_maximal_repeats_of_a_bucket(pairs, size):
    """Every set of members that share a string of ``size`` is within a group of them, extendable on neither side."""
    members = sorted((("x" + b).encode(), a.encode()) for a, b in pairs)
    right, left = [m[0] for m in members], [m[1] for m in members]

    def prefix(a, b):
        return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    common = [prefix(a, b) for a, b in zip(right, right[1:])]
    got = {(lead, tail, tuple(sorted(g))) for lead, tail, g in repeats(left, common, size, 1)}
    want = set()
    for i in range(len(members)):
        for j in range(i + 1, len(members)):
            lead, tail = common_suffix(left[i], left[j]), prefix(right[i], right[j])
            if lead + tail >= size:
                same = tuple(k for k in range(len(members)) if common_suffix(left[i], left[k]) >= lead and prefix(right[i], right[k]) >= tail)
                want.add((lead, tail, same))
    assert got == want
