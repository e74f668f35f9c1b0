"""Operator 12 against brute force."""

import random
import re
import zlib
from collections import Counter, defaultdict

import pyarrow.dataset as ds

from gleanspark.llm import queries, spelling
from tests.llm.conftest import SF

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def brute_counts(rows):
    n = Counter()
    for i, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 6 and c >= 5}


def brute_variants(counts):
    """Neighbours by shared deletions: two words are near if one is the other with a code
    point out, or both are the same with one out at the same place."""
    out, replaced = defaultdict(set), defaultdict(set)
    for w in counts:
        for i in range(len(w)):
            less = w[:i] + w[i + 1:]
            if less in counts:
                out[w].add(less)
                out[less].add(w)
            replaced[i, less].add(w)
    for group in replaced.values():
        for w in group:
            out[w] |= group - {w}
    form = {}
    for w, n in counts.items():
        best = min(out[w], key=lambda u: (-counts[u], u), default=None)
        form[w] = best if best is not None and counts[best] >= 5 * n else None
    rows = {}
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        rows[w] = (n, len(out[w]), form[w], counts.get(form[w]), root)
    return rows


def _got(df):
    return {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in df.collect()}


def test_query_equals_brute_force(spark):
    t = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pydict()
    got = queries.op12_spelling(spark, SF)
    assert set(got.columns) == {"word", "n", "n_near", "form", "form_n", "root"}
    want = brute_variants(brute_counts(zip(t["doc_id"], t["text"])))
    assert len(want) > 5000 and sum(r[2] is not None for r in want.values()) > 20
    assert _got(got) == want


def test_close_alphabets_against_brute_force(spark):
    """Few letters: long runs of one letter, many neighbours, chains of forms, hot prefixes."""
    rnd = random.Random(4)
    for alphabet, low, high, share in (("ab", 6, 9, 4096), ("a", 6, 40, 3), ("abàÿ", 6, 7, 8)):
        words = {"".join(rnd.choice(alphabet) for _ in range(rnd.randint(low, high))) for _ in range(400)}
        counts = {w: rnd.choice((5, 6, 30, 200, 1500, 9000)) for w in words}
        got = _got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long"), share=share))
        assert got == brute_variants(counts)


def test_advance_and_one_edit():
    assert spelling.advance("abc", "abc", 0) == [(3, 0)] and spelling.advance("abc", "abd", 1) == []
    assert spelling.advance("", "x", 0) == [(0, 1)]
    assert set(spelling.advance("xabc", "abc", 0)) == {(4, 1)}
    rnd = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rnd.choice("ab") for _ in range(rnd.randint(0, 5))) for _ in "xy")
        near = any(b == a[:i] + a[i + 1:] or a == b[:i] + b[i + 1:] for i in range(6) if a != b) or (
            len(a) == len(b) and sum(x != y for x, y in zip(a, b)) == 1)
        assert spelling.one_edit(a, b) == near, (a, b)


def test_very_long_words(spark):
    base = "".join(random.Random(3).choice("abcdefgh") for _ in range(20_000))
    near = base[:15_000] + base[15_001:]
    counts = {base: 100, near: 5, base[:4_000] + "z" + base[4_001:]: 7, base[::-1]: 9, "shorter": 5}
    got = _got(spelling.variants(spark.createDataFrame(list(counts.items()), "word string, n long")))
    assert got == brute_variants(counts)


def test_counts_of_awkward_rows(spark, edge, empty):
    got = {r["word"]: r["n"] for r in spelling.word_counts(edge, min_count=1, noise=None).collect()}
    assert got == {"epsilon": 3} and spelling.word_counts(empty).collect() == []
    rows = [(None, "Größer größer ×÷×÷×÷ ABCDEF abcdef Éléments éléments a1bcdefg"), (1, None), (1, ""), (2, "x" * 200_000)]
    rows += [(k, "letters lettersLETTERS letters_letters") for k in range(600)] + [(7, "letters")] * 2
    frame = spark.createDataFrame([(i, t, "w", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    want = brute_counts(rows)
    assert {r["word"]: r["n"] for r in spelling.word_counts(frame).collect()} == want
    assert any(len(w) == 6 and w != "letters" for w in want) or "letters" in want
    none = spelling.variants(spelling.word_counts(empty))
    assert none.collect() == [] and none.columns == ["word", "n", "n_near", "form", "form_n", "root"]
