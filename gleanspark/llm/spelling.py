"""Spelling variants by a relational trie frontier (operator 12).

``word_counts`` counts words; ``variants`` finds for every word all words one edit away
(one code point inserted, deleted or replaced), its form and its root.

The words make a trie, kept as a distributed edge table (node, label, child). Only nodes
where words part or end are nodes; what lies between is the label of an edge. A node is the
rolling hash of its prefix: a clash merges two nodes, which adds candidates and loses none,
and every neighbour is compared with its word at the end.

A state (word, position, node, edits) has read ``position`` code points of its word along
the path to ``node``. Each round joins all states with the edges of their nodes: a state
without an edit goes on where the label agrees, and where it does not, spends its edit at
the first difference (replace, insert or delete); a state that has spent it goes on only
where the label agrees. A state with its edit spent that has read its word at a node where
a word ends is a neighbour.

A pair differs first in the first half of the word or not at all there; in the former case
its reversed words agree on the first half. So there are two tries, of the words and of the
reversed words, and every frontier starts at the middle of its word, on its own path: no
state ever stands at the root, and low nodes, where most words meet, have no edges at all.
Nodes with more than ``SHARE`` words below have copies of their edges, and states are dealt
over the copies, so no join key holds more than a share of the words of a hot prefix.
"""

from __future__ import annotations

from collections.abc import Iterator
from os.path import commonprefix

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanspark.llm.common import materialize, text_of

#: Letters of a run, as the contract gives them.
LETTERS = r"A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words below a node that share one copy of its edges.
SHARE = 4096
_MOD, _BASE = (1 << 61) - 1, 1_000_003


def word_counts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = 6,
                min_count: int = 5, noise: int | None = 199) -> DataFrame:
    """``word, n``: runs of letters, A-Z lower-cased, with at least ``min_length`` code points
    and ``min_count`` occurrences.

    With ``noise``, a run loses code point ``h % length`` where ``noise`` divides
    ``h = crc32("<id>:<run>")``: typing errors, the same on every run of the job. A null text
    has no words, a null id is written as nothing, rows that repeat an id count each.
    Counts are taken partially before the shuffle, so a word in every document is one row a task.
    """
    runs = df.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("_id"), F.explode(
        F.regexp_extract_all(text_of(text_col), F.lit(f"[{LETTERS}]{{{min_length},}}"), F.lit(0))).alias("_run"))
    lowered = runs.select("_id", F.when(F.col("_run").rlike("[A-Z]"), F.translate("_run", UPPER, LOWER))
                          .otherwise(F.col("_run")).alias("word"))
    if noise:
        h = F.crc32(F.concat("_id", F.lit(":"), "word").cast("binary"))
        at = (F.col("_h") % F.length("word")).cast("int")
        hit = lowered.withColumn("_h", h)
        lowered = hit.select(F.when(F.col("_h") % noise == 0, F.concat(
            F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word"))))
            .otherwise(F.col("word")).alias("word"))
    return (lowered.filter(F.length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
            .filter(F.col("n") >= min_count))


def one_edit(a: str, b: str) -> bool:
    """Exactly one code point inserted, deleted or replaced."""
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    p = len(commonprefix((a, b)))
    return a[p + (len(a) >= len(b)):] == b[p + (len(b) >= len(a)):]


def advance(rest: str, label: str, edits: int) -> list[tuple[int, int]]:
    """(code points read, edits) after an edge, for a word with ``rest`` left to read."""
    if rest.startswith(label):
        return [(len(label), edits)]
    if edits:
        return []
    p = len(commonprefix((rest, label)))
    out = []
    if label[p + 1:] == rest[p + 1:len(label)] and len(rest) >= len(label):
        out.append((len(label), 1))                          # replaced
    if label[p + 1:] == rest[p:len(label) - 1]:
        out.append((len(label) - 1, 1))                      # the label has one more
    if label[p:] == rest[p + 1:len(label) + 1]:
        out.append((len(label) + 1, 1))                      # the word has one more
    return out


_STEPS = "id long, depth int, node long, letter int"


def _steps(batches: Iterator[pd.DataFrame], rows: int = 50_000) -> Iterator[pd.DataFrame]:
    """(id, back, text) in; the prefixes of every text from length (L - 1) div 2 on out: their
    rolling hash and the code point behind them, -1 where the word ends."""
    names = [c.split()[0] for c in _STEPS.split(", ")]
    out: list[list] = [[], [], [], []]
    for b in batches:
        for key, back, text in zip(b["id"].tolist(), b["back"].tolist(), b["text"].tolist()):
            h, nodes, at = 1 + back, [], (len(text) - 1) // 2
            codes = list(map(ord, text))
            for c in codes:
                nodes.append(h)
                h = (h * _BASE + c + 1) % _MOD
            nodes.append(h)
            n = len(nodes) - at
            out[0] += [key] * n
            out[1] += range(at, at + n)
            out[2] += nodes[at:]
            out[3] += codes[at:]
            out[3].append(-1)
            if len(out[0]) >= rows:
                yield pd.DataFrame(dict(zip(names, out)))
                out = [[], [], [], []]
    if out[0]:
        yield pd.DataFrame(dict(zip(names, out)))


def build_tries(words: DataFrame, share: int = SHARE) -> tuple[DataFrame, DataFrame]:
    """(edges, starts) of both tries of ``words`` (id, word).

    edges: ``node, copy, label, child, copies, ahead, target`` (``target``: the text that ends at
    the child; ``ahead``: a bit for each letter, modulo 64, that goes on from the child).
    starts: ``back, text, pos, node, ends, copies``: a text's first node from its middle on.
    """
    both = words.select((F.col("id") * 2).alias("id"), F.lit(False).alias("back"), F.col("word").alias("text")).union(
        words.select(F.col("id") * 2 + 1, F.lit(True), F.reverse("word")))
    steps = materialize(both.mapInPandas(_steps, _STEPS), "steps")
    nodes = (steps.groupBy("node").agg(
        F.min("letter").alias("_a"), F.max("letter").alias("_b"), F.count("*").alias("_words"),
        F.expr("bit_or(if(letter < 0, 0L, shiftleft(1L, letter % 64)))").alias("ahead"))
        .filter("_a <> _b or _a = -1")
        .select("node", (F.col("_a") == -1).alias("ends"), "ahead",
                F.ceil(F.col("_words") / share).cast("int").alias("copies")))
    paths = steps.select("id", "depth", "node").join(nodes, "node").groupBy("id").agg(
        F.sort_array(F.collect_list(F.struct("depth", "node", "ends", "copies", "ahead"))).alias("path"))
    paths = materialize(paths.join(both, "id").drop("id"), "paths")

    pairs = F.arrays_zip(F.expr("slice(path, 1, size(path) - 1)").alias("a"),
                         F.expr("slice(path, 2, size(path) - 1)").alias("b"))
    edges = paths.filter("size(path) > 1").select("text", F.explode(pairs).alias("p")).select(
        F.col("p.a.node").alias("node"), F.col("p.a.copies").alias("_n"),
        F.substring("text", F.col("p.a.depth") + 1, F.col("p.b.depth") - F.col("p.a.depth")).alias("label"),
        F.col("p.b.node").alias("child"), F.col("p.b.copies").alias("copies"), F.col("p.b.ahead").alias("ahead"),
        F.when(F.col("p.b.depth") == F.length("text"), F.col("text")).alias("target"))
    edges = (edges.groupBy("node", "_n", "label", "child", "copies", "ahead").agg(F.max("target").alias("target"))
             .withColumn("copy", F.explode(F.sequence(F.lit(0), F.col("_n") - 1))).drop("_n"))

    half = F.expr("length(text) div 2")
    middle = F.when(F.col("back"), F.length("text") - half).otherwise(half)
    first = F.filter("path", lambda s: s["depth"] >= middle)[0]
    starts = paths.select("back", "text", first.alias("s")).select(
        "back", "text", F.col("s.depth").alias("pos"), "s.node", "s.ends", "s.copies")
    return edges, starts


def _possible() -> Column:
    """What two letters of the word and of the label leave possible of a (state, edge) row:
    nothing that ``advance`` would take is lost. An edge of one letter also needs a letter
    ahead of its child that can follow, or a word that ends there."""
    def ahead(c: str) -> str:
        return f"(shiftright(ahead, ascii({c}) % 64) & 1) = 1"

    a, b, x, y = ("substring(text, pos + 1, 1)", "substring(text, pos + 2, 1)",
                  "substring(label, 1, 1)", "substring(label, 2, 1)")
    spent = f"{x} = {a} and ({y} = {b} or ({y} = '' and (target is not null or {ahead(b)})))"
    free = (f"{x} = {a} or {x} = {b} or ({y} <> '' and {y} in ({a}, {b})) "
            f"or ({y} = '' and (target is not null or {ahead(a)} or {ahead(b)}))")
    return F.expr(f"if(edits = 0, {free}, {spent})")


_STATE = "back boolean, text string, pos int, node long, edits int, copies int, near string"


def _advance(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Joined (state, edge) rows in; next states, and neighbours (``near`` set), out."""
    names = [c.split()[0] for c in _STATE.split(", ")]
    for b in batches:
        out = []
        for back, text, pos, edits, label, child, copies, ahead, target in zip(
                *(b[c].tolist() for c in ("back", "text", "pos", "edits", "label", "child", "copies", "ahead", "target"))):
            for read, spent in advance(text[pos:], label, edits):
                at = pos + read
                if target is not None and one_edit(text, target):
                    out.append((back, text, 0, 0, 1, 0, target))
                # with the edit spent, the next letter must go on from the child
                if not spent or (at < len(text) and ahead >> (ord(text[at]) & 63) & 1):
                    out.append((back, text, at, child, spent, copies, None))
        yield pd.DataFrame(out, columns=names)


def neighbours(vocabulary: DataFrame, share: int = SHARE) -> DataFrame:
    """``word, near``: every ordered pair of distinct words of ``vocabulary`` that are one
    edit apart.

    Each round is one equi-join of the states with the edges and is written before the next;
    rounds end when no state is left, after as many as there are nodes on the second half of
    a word's path. The states of a word stay few: its own path, and the branches that
    neither the label nor the letters behind it have ruled out.
    """
    words = materialize(vocabulary.select(F.monotonically_increasing_id().alias("id"), "word"), "words")
    edges, starts = build_tries(words, share)
    edges = materialize(edges, "edges")
    # the word that ends at the first node itself, one code point short of this one
    short = F.expr("substring(text, 1, pos)")
    found = [starts.filter(F.col("ends") & (F.col("pos") == F.length("text") - 1))
             .select("back", "text", short.alias("near"))]
    states = starts.select("back", "text", "pos", "node", F.lit(0).alias("edits"), "copies")
    for at in range(2 ** 31):
        dealt = states.withColumn("copy", F.pmod(F.xxhash64("text"), F.col("copies")).cast("int")).drop("copies")
        joined = dealt.join(edges, ["node", "copy"]).filter(_possible())
        out = materialize(joined.select("back", "text", "pos", "edits", "label", "child", "copies", "ahead", "target")
                          .mapInPandas(_advance, _STATE), f"frontier-{at}")
        found.append(out.filter("near is not null").select("back", "text", "near"))
        states = out.filter("near is null").drop("near")
        if states.isEmpty():
            break
    links = found[0]
    for more in found[1:]:
        links = links.union(more)

    def read(c: str) -> Column:
        return F.when(F.col("back"), F.reverse(c)).otherwise(F.col(c))

    # a hash that two prefixes share may name a node where no word ends: only words count
    return (links.select(read("text").alias("word"), read("near").alias("near")).distinct()
            .join(words.select(F.col("word").alias("near")), "near", "left_semi").select("word", "near"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms`` (word, form): pointers are doubled until none moves. Counts
    rise along a chain by a factor, so there are at most log2(log n) rounds."""
    at = forms.select("word", F.col("form").alias("root"))
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        at = materialize(at.join(up, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"), F.col("_next").isNotNull().alias("moved")), "roots")
        if at.filter("moved").isEmpty():
            return at.select("word", "root")
        at = at.drop("moved")


def variants(counts: DataFrame, ratio: int = 5, share: int = SHARE) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of a table of words with counts.

    ``form`` is the neighbour with the largest count (ties: the smallest in code-point
    order), if that is at least ``ratio`` times the word's own; ``root`` follows forms to the
    last. Words without a neighbour have 0, null, null and themselves. An empty table gives
    an empty table. Words have to be distinct and not null.
    """
    vocabulary = materialize(counts.select("word", F.col("n").cast("long").alias("n")), "vocabulary")
    links = neighbours(vocabulary, share)
    best = F.min(F.struct((-F.col("n")).alias("m"), F.col("near")))
    per_word = links.join(vocabulary.withColumnRenamed("word", "near"), "near").groupBy("word").agg(
        F.count("*").alias("n_near"), best.alias("_best"))
    told = vocabulary.join(per_word, "word", "left")
    n_form = -F.col("_best.m")
    good = n_form >= ratio * F.col("n")
    out = materialize(told.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(good, F.col("_best.near")).alias("form"), F.when(good, n_form).alias("form_n")), "forms")
    ends = roots(out.filter("form is not null").select("word", "form"))
    return (out.join(ends, "word", "left")
            .withColumn("root", F.coalesce("root", "word")))
