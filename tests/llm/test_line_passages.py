"""Operator 2: repeated runs of lines go whole, against brute force that knows no chunks."""

import random

from gleanspark.llm import line_dedup as L


def chunk_lines(rows):
    """Places (id, line) of chunks of two or more lines seen before."""
    seen, gone = set(), set()
    for i, t in sorted(rows):
        at = 0
        for s, e, n in L.chunks(t):
            if n > 1 and t[s:e] in seen:
                gone |= {(i, x) for x in range(at, at + n)}
            if n > 1:
                seen.add(t[s:e])
            at += n
    return gone


def passage_lines(rows, words):
    """Places (id, line) in runs over ``words`` words, begun and ended by lines with words,
    that stood before without overlap: every run of every length is tried."""
    first, gone = {}, set()
    for i, t in sorted(rows):
        lines = t.split("\n")
        n = [len(x.split()) for x in lines]
        for a in range(len(lines)):
            for z in range(a + 1, len(lines) + 1):
                if n[a] and n[z - 1] and sum(n[a:z]) > words:
                    f = first.setdefault(tuple(lines[a:z]), (i, a))
                    if f[0] != i or f[1] + z - a <= a:
                        gone |= {(i, x) for x in range(a, z)}
    return gone


def corpus(words):
    rnd = random.Random(11)

    def line(n):
        return " ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") * rnd.randint(1, 9) for _ in range(n))

    shared = [[line(words + rnd.randint(1, 9))] for _ in range(12)]                   # one long line
    shared += [[line(words // 2 + rnd.randint(1, 5)) for _ in range(k)] for k in (2, 3, 4) for _ in range(8)]
    shared += [[line(words + 1), "", " ", line(words + 2)], [line(3), "", line(words), ""]]
    shared += [[line(2) for _ in range(words)] for _ in range(3)]
    rows = []
    for i in range(120):
        text = []
        for _ in range(rnd.randint(1, 4)):
            text += [line(rnd.randint(0, 6)) for _ in range(rnd.randint(0, 3))]
            text += rnd.choice(shared) * rnd.choice([1, 1, 1, 2])
        rows.append((i, "\n".join(text)))
    return rows + [(200, "again and again\n" * 60)]


def test_repeated_passages_go_whole(spark):
    for words in (50, 9):
        rows = corpus(words)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        passed = passage_lines(rows, words)
        gone = passed | chunk_lines(rows)
        assert passed - chunk_lines(rows)            # what chunks alone leave
        got = {r.doc_id: r for r in L.line_dedup(df, passage_words=words).collect()}
        for i, t in rows:
            stay = [x for k, x in enumerate(t.split("\n")) if (i, k) not in gone]
            assert got[i].text == "\n".join(stay), i
            assert got[i].n_removed_lines == t.count("\n") + 1 - len(stay)


def test_one_line_passage_and_rows_that_repeat_an_id(spark):
    long = " ".join(f"w{k}" for k in range(51))
    rows = [(1, f"a\n{long}\nb"), (2, f"c\nd\n{long}"), (3, long), (4, "x\ny z"), (4, f"q\n{long}"), (4, f"q\n{long}")]
    got = sorted((r.doc_id, r.text) for r in L.line_dedup(
        spark.createDataFrame(rows, "doc_id long, text string"), passage_words=50).collect())
    assert got == [(1, f"a\n{long}\nb"), (2, "c\nd"), (3, ""), (4, "q"), (4, "q"), (4, "x\ny z")]


def test_registered_query_removes_every_passage(spark):
    from gleanspark.llm.queries import op2_line_dedup

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    gone = passage_lines(rows, 50) | chunk_lines(rows)
    got = {r.doc_id: r.n_removed_lines for r in op2_line_dedup(spark, sf).collect()}
    assert got == {i: sum(d == i for d, _ in gone) for i, _ in rows}
