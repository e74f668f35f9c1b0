"""Operators 2, 3, 5 and 9 against brute force, and on awkward rows."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest

from gleanspark.llm import line_dedup as L
from gleanspark.llm import near_dedup as N
from gleanspark.llm import suffix_dedup as S
from gleanspark.llm.components import components
from gleanspark.llm.exact_dedup import exact_dedup
from gleanspark.llm.shingles import shingle_sets


# ---- exact -----------------------------------------------------------------

def brute_exact(rows):
    norm = [(i, re.sub(r"[\x20\x09-\x0D]+", " ", t or "")) for i, t in rows]
    groups = collections.defaultdict(list)
    for i, n in norm:
        groups[n].append(i)
    out = []
    for i, n in norm:
        known = [x for x in groups[n] if x is not None]
        keep = min(known) if known else None
        out.append((i, keep, len(groups[n]), i == keep, hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


def test_exact_matches_brute_force(docs, pdocs):
    got = exact_dedup(docs, digest_all=True).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(list(zip(pdocs.doc_id, pdocs.text)))


def test_exact_edge_rows(spark, edge, empty):
    rows = [(r.doc_id, r.text) for r in edge.collect()] + [(20, "a\t b"), (21, "a b"), (22, "a  b "), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(map(tuple, exact_dedup(df, digest_all=True).collect()), key=str) == brute_exact(rows)
    lazy = exact_dedup(edge).collect()
    assert {r.doc_id for r in lazy if r.text_sha256 is None} == {5, 6, 9, None}
    assert exact_dedup(empty).count() == 0


def test_exact_plan_runs_no_python(docs):
    plan = exact_dedup(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan


# ---- lines -----------------------------------------------------------------

def brute_lines(rows):
    seen, out = set(), {}
    for i, t in sorted(rows):
        stay = []
        for s, e, n in L.chunks(t):
            if n > 1 and t[s:e] in seen:
                continue
            if n > 1:
                seen.add(t[s:e])
            stay.append(t[s:e])
        out[i] = "\n".join(stay)
    return out


def test_chunks_cover_the_text():
    rnd = random.Random(3)
    for _ in range(500):
        t = "\n".join(rnd.choice(["a", "bb", "", "c c"]) for _ in range(rnd.randint(0, 12)))
        spans = L.chunks(t)
        assert "\n".join(t[s:e] for s, e, _ in spans) == t
        assert sum(n for *_, n in spans) == t.count("\n") + 1


def test_chunk_borders_survive_a_shift():
    lines = [f"line number {k * k}" for k in range(60)]
    before = {"\n".join(lines)[s:e] for s, e, _ in L.chunks("\n".join(lines))}
    shifted = "\n".join(["a new first line", *lines])
    after = {shifted[s:e] for s, e, _ in L.chunks(shifted)}
    assert len(before & after) >= len(before) - 2


def test_line_dedup_matches_brute_force(docs, pdocs):
    got = {r.doc_id: r.text for r in L.line_dedup(docs).collect()}
    assert got == brute_lines(list(zip(pdocs.doc_id, pdocs.text)))


def test_line_dedup_keeps_columns(docs):
    out = L.line_dedup(docs, keep=True)
    assert out.columns[:len(docs.columns)] == docs.columns
    same = out.filter("n_removed_chunks = 0").select(docs.columns)
    assert same.exceptAll(docs).count() == 0


def test_line_dedup_edge_rows(spark, edge, empty):
    got = {(r.doc_id, r.n_lines): r for r in L.line_dedup(edge).collect()}
    assert got[(3, 0)].text is None and got[(4, 1)].text == ""
    assert got[(7, 3001)].n_removed_lines < 3001
    assert got[(8, 3001)].n_removed_chunks == sum(n > 1 for *_, n in L.chunks(got[(7, 3001)].text)) or \
        got[(8, 3001)].n_removed_chunks > 0
    assert L.line_dedup(empty).count() == 0 and L.line_dedup(edge).count() == edge.count()
    twice = spark.createDataFrame([(5, "p\nq\nr\ns\nt"), (5, "p\nq\nr\ns\nt")], "doc_id long, text string")
    assert {r.text for r in L.line_dedup(twice).collect()} == {"p\nq\nr\ns\nt"}


# ---- suffix ----------------------------------------------------------------

def brute_suffix(rows, length=100):
    seen, out = set(), {}
    for i, t in sorted(rows):
        d = (t or "").encode()
        gone = np.zeros(len(d), bool)
        for p in range(len(d) - length + 1):
            s = d[p:p + length]
            if s in seen:
                gone[p:p + length] = True
            else:
                seen.add(s)
        kept = np.frombuffer(d, "uint8")[~gone].tobytes()
        runs = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        out[i] = (len(d), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest())
    return out


def crafted():
    rnd = random.Random(5)
    x = "".join(rnd.choice("ab cdefgh") for _ in range(400))
    y = "".join(rnd.choice("xyz qrs") for _ in range(300))
    rows = [(1, x + y), (2, y[50:] + x[:130] + "Q" + x[100:]), (3, "a" * 350), (4, "b" * 99), (5, None), (6, ""),
            (7, "ab" * 200), (8, x[:99]), (9, x[:100]), (10, "é" * 120), (11, x[20:240] + "!" + x[20:240]), (12, y)]
    for k in range(40):
        rows.append((100 + k, y[rnd.randint(0, 100):rnd.randint(120, 300)] + rnd.choice("uvw")
                     + x[rnd.randint(0, 200):rnd.randint(220, 400)]))
    return rows


@pytest.mark.parametrize("parts, small", [(1, 2048), (7, 2048), (5, 3)])
def test_suffix_matches_brute_force(spark, monkeypatch, parts, small):
    monkeypatch.setattr(S, "SMALL", small)               # also the way of very common anchors
    rows = crafted()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)
    assert {r[0]: tuple(r[1:5]) for r in S.suffix_dedup(df).collect()} == brute_suffix(rows)


@pytest.mark.parametrize("small, length", [(1, 100), (8, 100), (1, 41)])
def test_suffix_common_anchors_are_ranked_anew(spark, monkeypatch, small, length):
    """Strings that many texts share, shorter and longer than ``length``, in surroundings that repeat or not."""
    monkeypatch.setattr(S, "SMALL", small)
    rnd = random.Random(7)
    word = lambda n: "".join(rnd.choice("abcdefgh ") for _ in range(n))
    shared, around = [word(30), word(90), word(130)], [word(60) for _ in range(5)]
    rows = [(k, "".join(rnd.choice([rnd.choice(around), word(rnd.randint(1, 90))]) + rnd.choice(shared) for _ in range(4)))
            for k in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r[0]: tuple(r[1:5]) for r in S.suffix_dedup(df, length=length).collect()} == brute_suffix(rows, length)


def test_suffix_longer_anchors_are_few_and_unique():
    """A string of 24 bytes in all texts, different text around it: cut anew, its windows make
    under a fifth of the rows they would by themselves, and no anchor is left to compare."""
    rnd = random.Random(8)
    texts = ["".join(rnd.choice("abcdefgh ") for _ in range(90)) + "the string of many texts"
             + "".join(rnd.choice("abcdefgh ") for _ in range(90)) for _ in range(400)]
    out = S._found(np.arange(400), [t.encode() for t in texts], np.zeros(400, "int64"), 100, 80)
    windows = sum(len(t) - 99 for t in texts)
    n = (out["at"].to_numpy() >> 1) & S._COUNT
    assert n.sum() == windows
    assert out["anchor"].is_unique and len(out) * 5 < windows
    assert all(len(b) == m + 99 for m, b in zip(n, out["body"]))


def test_suffix_matches_brute_force_on_documents(docs, pdocs):
    got = {r[0]: tuple(r[1:5]) for r in S.suffix_dedup(docs.repartition(6)).collect()}
    assert got == brute_suffix(list(zip(pdocs.doc_id.tolist(), pdocs.text)))


def test_suffix_edge_rows(edge, empty):
    rows = S.suffix_dedup(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edge.count() and S.suffix_dedup(empty).count() == 0
    assert by[3].n_bytes == 0 and by[None].n_removed == 0
    assert by[8].n_removed == by[8].n_bytes and by[8].n_spans == 1
    assert by[2].n_removed == 0                    # under 100 bytes


def test_ranks_are_content_hashes():
    data = np.frombuffer(b"abcabcabcabd" * 5, "uint8")
    for n in (1, 3, 20, 25, 50):
        r = S.ranks(data, n, 1)
        assert len(r) == len(data) - n + 1
        words = {}
        for p in range(len(r)):
            assert words.setdefault(bytes(data[p:p + n]), r[p]) == r[p]
        assert len(set(words.values())) == len(words)


# ---- near ------------------------------------------------------------------

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(t):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])


def brute_near(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    comp = {i: i for i in sets}
    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and comp[a] != comp[b]:
                n = len(sets[a] & sets[b])
                if n and 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
                    lo, hi = sorted((comp[a], comp[b]))
                    comp = {k: lo if v == hi else v for k, v in comp.items()}
    return {i: (len(sets[i]), comp[i], comp[i] == i) for i in ids}


def test_shingle_sets_agree_with_words():
    texts = ["A b c d e f", "a B c d e f", "a b c d", "a  b\nc d", "", None, " \n", "é É x y z w", "a b c d e"]
    got = list(shingle_sets(texts))
    assert [len(g) for g in got] == [len(shingles(t)) for t in texts]
    same = [[bool(shingles(a) and shingles(a) == shingles(b)) for b in texts] for a in texts]
    assert same == [[bool(len(a) and np.array_equal(a, b)) for b in got] for a in got]


@pytest.mark.parametrize("percent", [80, 85])
def test_near_matches_brute_force(spark, pdocs, percent):
    rnd = random.Random(percent)
    base = [f"w{k}" for k in range(120)]
    rows = list(zip(pdocs.doc_id.tolist(), pdocs.text))[:250]
    for k in range(60):                               # a family whose members differ from each other
        w = list(base)
        for _ in range(rnd.randint(0, 4)):
            w[rnd.randrange(len(w))] = f"v{k}"
        rows.append((5000 + k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r[0]: tuple(r[1:]) for r in N.near_dedup(df, percent=percent).collect()}
    assert got == brute_near(rows, percent)


def test_near_tiles_do_not_change_the_result(spark, monkeypatch):
    rnd = random.Random(9)
    base = [f"w{k}" for k in range(60)]
    rows = []
    for k in range(50):
        w = list(base)
        for _ in range(rnd.randint(0, 3)):
            w[rnd.randrange(len(w))] = f"v{k}"
        rows.append((k, " ".join(w)))
    monkeypatch.setattr(N, "TILE", 7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r[0]: tuple(r[1:]) for r in N.near_dedup(df).collect()} == brute_near(rows, 80)


def test_rare_pairs_miss_no_similar_pair():
    rnd = np.random.default_rng(2)
    for percent in (60, 80, 85):
        sets = [np.unique(rnd.choice(40, rnd.integers(1, 30))).astype("uint64") for _ in range(60)]
        sets += [np.unique(np.append(s[1:], 99)).astype("uint64") for s in sets[:20]]
        got = N._rare_pairs(sets, percent)
        for i in range(len(sets)):
            for j in range(i):
                n = len(np.intersect1d(sets[i], sets[j]))
                if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                    assert (j, i) in got


def test_every_pair_within_the_distance_shares_a_key():
    rnd = np.random.default_rng(1)
    a = rnd.integers(0, 1 << 16, (200, 60)).astype("<u2")
    b = a.copy()
    for row in b:
        row[rnd.choice(60, 23, replace=False)] += 1   # T = 12 * 2 - 1
    ka, kb = N.chunk_keys(a, 12, 1), N.chunk_keys(b, 12, 1)
    assert all(set(x) & set(y) for x, y in zip(ka.tolist(), kb.tolist()))


def test_near_edge_rows(edge, empty):
    rows = N.near_dedup(edge).collect()
    by = {r.doc_id: r for r in rows}
    assert len(rows) == edge.count() and N.near_dedup(empty).count() == 0
    assert by[2].component_id == 1 and not by[2].kept and by[1].kept
    assert by[3].n_shingles == by[4].n_shingles == by[5].n_shingles == 0 and by[4].component_id == 4
    assert by[8].component_id == 7 and by[None].component_id is None and by[None].kept


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101), (102, 101), (7, 7)], "a long, b long")
    got = {r.id: r.component for r in components(links).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100, 102: 100}
