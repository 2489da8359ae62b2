"""The operators against brute force, exact round trips and held-out accuracy."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pipewright.llm import lm_trie, minhash_join, packing, queries, substring_dedup
from pipewright.llm.elias_fano import EliasFano
from pipewright.llm.mphf import Mphf
from pipewright.llm.suffix_automaton import Automaton
from pipewright.oracle.compare import compare

from ..conftest import SF001, SF01

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_sql(spark, duck001, name):
    r = compare(queries.queries()[name](spark, SF001), duck001, queries.oracle_sql()[name])
    assert r["ok"], r


def test_sql_near_dedup_sf001(spark, duck01):
    r = compare(queries.queries()["op10_minhash_near_dedup"](spark, SF01), duck01, queries.oracle_sql()["op10_minhash_near_dedup"])
    assert r["ok"], r


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(0, 2**64 - 1), max_size=2000))
def test_mphf(keys):
    lo = np.array(sorted(keys), np.uint64)
    f = Mphf.load(Mphf.build(lo).dump())
    assert sorted(f.slots(lo).tolist()) == list(range(len(lo)))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 10**6), max_size=300), st.lists(st.integers(0, 10**6), max_size=30))
def test_elias_fano(values, asked):
    v = np.array(sorted(values), np.int64)
    e = EliasFano.encode(v, 10**6 + 1)
    head, data = e.dump()
    e = EliasFano.load(head, np.concatenate([*data, np.zeros(1, np.uint8)]))
    assert e.get(np.arange(len(v))).tolist() == v.tolist()
    x = np.array(asked, np.int64)
    got = e.successor(x, np.zeros(len(x), np.int64), np.full(len(x), len(v)))
    assert got.tolist() == np.searchsorted(v, x).tolist()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3), min_size=1, max_size=12), min_size=1, max_size=5), st.lists(st.integers(0, 3), max_size=30))
def test_automaton(items, text):
    a = Automaton.build(items, 4)
    parts = {tuple(s[i:j]) for s in items for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
    state = matched = 0
    for j, w in enumerate(text):
        state, matched = a.step(state, matched, w)
        assert matched == max((n for n in range(j + 2) if n == 0 or tuple(text[j + 1 - n:j + 1]) in parts))


def _rows(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long")


def _brute_near(texts, width, percent):
    sets = {}
    for i, t in texts:
        w = t.encode().translate(LOWER).split()
        sets[i] = {tuple(w[j:j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[k + 1:]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("split", [200_000, 3])
def test_near_duplicates(spark, monkeypatch, split):
    """Near-copy groups, chains, a common passage in short texts, exact copies; large lists split at 3 pairs too."""
    monkeypatch.setattr(minhash_join, "SPLIT", split)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = [word() for _ in range(30)]
    texts = []
    for g in range(12):
        base = [word() for _ in range(rng.choice((3, 20, 60, 150)))]
        for _ in range(8):
            base = list(base)
            if rng.random() < 0.7:
                base[rng.randrange(len(base))] = word()  # a chain: later ones drift away from the first
            texts.append(" ".join(base))
    texts += [" ".join(common + [word() for _ in range(n)]) for n in (0, 1, 2, 4, 6, 8, 10, 15, 20, 30) for _ in range(3)]
    texts += ["", "  ", "one", "one two", "ONE two"]
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    for width, percent in ((3, 85), (5, 80)):
        got = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(_rows(spark, texts), width, percent).collect()}
        assert got == _brute_near(texts, width, percent)


def test_near_duplicates_common_passage(spark, monkeypatch):
    """Half-similar texts that share a passage: lists are split or cut into blocks, none stays large, no link is lost."""
    monkeypatch.setattr(minhash_join, "SPLIT", 50)
    monkeypatch.setattr(minhash_join, "LIST_ROWS", 10)
    sizes, work = [], minhash_join._work

    def seen(*args):
        rows = work(*args)
        sizes.extend(r["count"] for r in rows.groupBy("key", "key2").count().collect())
        return rows
    monkeypatch.setattr(minhash_join, "_work", seen)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    common = [word() for _ in range(80)]
    own = [[word() for _ in range(36)] for _ in range(90)]
    texts = [" ".join(common + o) for o in own] + [" ".join(common + o[:-2] + [word(), word()]) for o in own[:30]]
    texts += [" ".join(word() for _ in range(50)) for _ in range(20)]
    rng.shuffle(texts)
    texts = list(enumerate(texts))
    got = {r.doc_id: r.component_id for r in minhash_join.near_duplicates(_rows(spark, texts), 3, 85).collect()}
    assert got == _brute_near(texts, 3, 85)
    assert sizes and max(sizes) <= 50


def test_substring_dedup(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    sentence = lambda n: " ".join(word() for _ in range(n)).capitalize() + "."
    passages = [" ".join(sentence(n) for n in ns) for ns in ((20, 20, 15), (5, 4, 3, 9, 12, 20, 3), (60,), (2, 2))]
    texts = []
    for i in range(40):
        parts = [sentence(rng.randint(1, 30)) for _ in range(6)]
        for _ in range(rng.randint(0, 2)):
            parts.insert(rng.randrange(len(parts)), rng.choice(passages))
        texts.append((i, rng.choice((" ", "\n")).join(parts)))
    got = {r.row.doc_id: r for r in substring_dedup.substring_dedup(_rows(spark, texts)).collect()}
    first, places = {}, defaultdict(int)
    for i, t in texts:
        for h, a, _ in substring_dedup.spans(substring_dedup.sentences(t)):
            first.setdefault(h, (i, a))
            places[h] += 1
    some = 0
    for i, t in texts:
        pieces = substring_dedup.sentences(t)
        assert "".join(pieces) == t
        gone = set()
        for h, a, n in substring_dedup.spans(pieces):
            if first[h] != (i, a):
                gone |= set(range(a, a + n))
        assert got[i].text == "".join(p for k, p in enumerate(pieces) if k not in gone)
        assert got[i].n_removed == len(gone)
        some += len(gone)
    assert some
    left = " ".join(r.text for r in got.values()).replace("\n", " ")
    for p in passages[:3]:
        assert left.count(p[: p.index(".") + 1]) <= 1 or places and left.count(p) <= 1


@pytest.mark.parametrize("mean", [8, 15, 40, 10**9])
def test_substring_dedup_any_offset(spark, mean):
    """Passages of 50 to 60 words at any word offset of any sentence: more than half of a repeat goes, and nothing else."""
    rng = random.Random(mean)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(7)) + "." * (rng.random() < 1 / mean)
    words = lambda n: [word() for _ in range(n)]
    texts, sizes = [], []
    for i in range(40):
        passage = words(rng.randint(50, 60))
        sizes.append(len(passage))
        for d in (2 * i, 2 * i + 1):
            texts.append((d, words(rng.randint(0, 70)), passage, words(rng.randint(0, 70))))
    got = {r.row.doc_id: r for r in substring_dedup.substring_dedup(
        _rows(spark, [(i, " ".join(a + p + b)) for i, a, p, b in texts])).collect()}
    for i, a, p, b in texts:
        left = got[i].text.split()
        if i % 2 == 0:
            assert left == a + p + b
            continue
        assert left[:len(a)] == a and left[len(left) - len(b):] == b
        assert 2 * (len(left) - len(a) - len(b)) < len(p)


def test_substring_dedup_pieces(spark):
    """Pieces are bounded, also of one repeated word; a first empty line and one short sentence are no repeats."""
    for text in ("word " * 3000, "a b " * 3000, "x. " * 500, " \n\n a\n", " ", "", "é ü " * 99):
        pieces = substring_dedup.sentences(text)
        assert "".join(pieces) == text and all(len(p.split()) <= substring_dedup.WINDOW for p in pieces)
    assert len(substring_dedup.sentences("word " * 3000)) < 600
    short = " ".join(f"w{i}" for i in range(24)) + "."
    own = "\n" + " ".join(f"u{i}" for i in range(12)) + ".\n" + " ".join(f"v{i}" for i in range(12)) + "."
    got = substring_dedup.substring_dedup(_rows(spark, [(1, "A b. " + short), (2, "C d. " + short), (3, own)])).collect()
    assert {r.row.doc_id: r.text for r in got} == {1: "A b. " + short, 2: "C d. " + short, 3: own}


def test_language_id_rare_language(spark):
    """A language with a few of thousands of rows is among the classes, however small the common sample."""
    from pipewright.llm import language_id
    rows = [(i, "the cat sat on the mat", "en", "s", 0) for i in range(3000)] + [(5000 + i, "le chat noir dort", "fr", "s", 0) for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert list(language_id.train(docs, train_rows=20).classes) == ["en", "fr"]


def test_lm_scores(spark, monkeypatch):
    monkeypatch.setattr(lm_trie, "BUCKET_TOKENS", 5_000)  # many shards and hot contexts
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    tok = {r.doc_id: r.text.encode().translate(LOWER).split() + [b"\n"] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in tok}
    one, two, ctx = Counter(), Counter(), Counter()
    for d, w in tok.items():
        if not held[d]:
            one.update(w)
            for a, b in zip([b""] + w, w):
                two[a, b] += 1
                ctx[a] += 1
    n, v = sum(one.values()), len(one)
    step = math.log10(n + lm_trie.MU + 1) / (lm_trie.LEVELS - 1)
    rows = lm_trie.lm_scores(docs).collect()
    assert len(rows) == len(tok)
    for r in rows:
        w = tok[r.doc_id]
        assert (r.held_out, r.n_tokens, r.train_tokens, r.n_known) == (held[r.doc_id], len(w), n, sum(one[t] > 0 for t in w))
        assert r.base_score == pytest.approx(sum(math.log10((one[t] + 1) / (n + v + 1)) for t in w))
        p = sum(math.log10((two[a, b] + lm_trie.MU * (one[b] + 1) / (n + v + 1)) / (ctx[a] + lm_trie.MU)) for a, b in zip([b""] + w, w))
        assert abs(r.score - p) <= step / 2 * len(w)


def test_packing(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    rows = packing.pack(docs, capacity=2048, per_source=3).collect()
    info = {r.doc_id: r for r in docs.collect()}
    bins = defaultdict(list)
    size = Counter()
    for r in rows:
        bins[r.bin_id].append(r)
        size[r.doc_id] += r.n_tokens
    assert size == {d: len(r.text.encode().split()) + 1 for d, r in info.items()}
    for inside in bins.values():
        inside.sort(key=lambda r: r.bin_start)
        at = 0
        for r in inside:
            assert r.bin_start == at
            at += r.n_tokens
        assert at <= 2048
        assert max(Counter(info[r.doc_id].source for r in inside).values()) <= 3
        flat = Counter(b" ".join(info[r.doc_id].text.lower().encode().split()) for r in inside)
        assert max(flat.values()) == 1
    assert sum(size.values()) > 0.9 * 2048 * len(bins)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.integers(0, 2), st.integers(-1, 2)), max_size=60))
def test_best_fit(items):
    """Each item takes the tightest bin that may take it."""
    items = sorted(items, key=lambda t: -t[0])
    got = packing.best_fit(items, 20, 2)
    left, inside = {}, defaultdict(list)
    for (n, s, c), (b, start) in zip(items, got):
        fits = [r for k, r in left.items() if r >= n and sum(x[1] == s for x in inside[k]) < 2
                and not (c >= 0 and any(x[2] == c for x in inside[k]))]
        assert (left[b] == min(fits) if fits else b not in left), (n, s, c)
        assert start == 20 - left.get(b, 20)
        left[b] = left.get(b, 20) - n
        inside[b].append((n, s, c))


def _held(rows, mod, rest):
    return [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % mod == rest]


def test_quality_accuracy(spark):
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    rows = [r for r in queries.op3_quality_cnn(spark, SF01).collect() if r.doc_id in y]
    held = _held(rows, 5, 0)
    assert all(r.held_out for r in held) and all(r.predicted == (r.score >= 0.3) for r in rows)
    pos, neg = ([r.score for r in held if y[r.doc_id] == k] for k in (1, 0))
    assert np.mean([p > q for p in pos for q in neg]) > 0.9


def test_language_accuracy(spark):
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    held = _held(queries.op8_language_id(spark, SF01).collect(), 4, 2)
    assert all(r.held_out for r in held)
    assert np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.95


def test_toxicity_accuracy(spark):
    y = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    held = [r for r in _held(queries.op2_toxicity(spark, "/root/testdata/sf0.1").collect(), 5, 0) if r.doc_id in y]
    assert np.mean([r.toxic for r in held if y[r.doc_id]]) > 0.8
    assert np.mean([r.toxic for r in held if not y[r.doc_id]]) < 0.02


def test_pipeline_brute_force(spark):
    """The stages on sf0.01 against plain Python: line dedup, near-dedup and decontamination of what came before."""
    import re

    import corpus_pipeline as cp
    docs = {}
    df = cp.documents(spark, SF01)
    for name, stage in cp.STAGES[:4]:
        from pipewright.llm.common import store
        df = store(stage(spark, df, SF01))
        docs[name] = {r.doc_id: r.text for r in df.collect()}
    before = docs["quality_rules"]
    ws = " \t\n\x0b\x0c\r"
    key = lambda x: x.strip(ws).encode().translate(LOWER).decode()
    held = defaultdict(set)
    for d, t in before.items():
        for x in t.split("\n"):
            if len(key(x)) >= 40:
                held[key(x)].add(d)
    want = {d: "\n".join(x for x in t.split("\n") if len(held[key(x)]) < 5 or max(held[key(x)]) == d) for d, t in before.items()}
    assert docs["line_dedup"] == want
    comp = _brute_near(list(want.items()), 5, 80)
    assert set(docs["near_dedup"]) == {d for d in want if comp[d] == d}
    words = lambda t: re.findall(rb"[0-9a-z\x80-\xff]+", t.encode().translate(LOWER))
    wins = set()
    for r in spark.read.parquet(f"{SF01}/benchmark.parquet").collect():
        w = words(r.text)
        n = min(10, len(w))
        wins |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set()
    for d, t in docs["near_dedup"].items():
        w = words(t)
        hit = {k for n in {len(x) for x in wins} for i in range(len(w) - n + 1) if tuple(w[i:i + n]) in wins for k in range(i, i + n)}
        assert (d in docs["decontamination"]) == (2 * len(hit) <= len(w))
        if d in docs["decontamination"]:
            assert words(docs["decontamination"][d]) == [x for k, x in enumerate(w) if k not in hit]
    placed = {r.doc_id for r in cp.STAGES[4][1](spark, df, SF01).collect()}
    assert placed == set(docs["decontamination"])


def test_line_dedup_hash(spark):
    r = queries.op4_line_dedup(spark, SF001).where("n_dropped = 0").first()
    t = spark.read.parquet(f"{SF001}/documents.parquet").where(f"doc_id = {r.doc_id}").first().text
    assert r.kept_sha256 == hashlib.sha256(t.encode()).hexdigest()
