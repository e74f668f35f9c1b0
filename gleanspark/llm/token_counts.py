"""Token counts by heap-and-linked-list byte-pair merging (operator 7).

The symbols of a word form a linked list; a heap holds the adjacent pairs whose
concatenation is a piece of the vocabulary. The best pair (highest score, then leftmost)
is popped and merged until none is left. The count is the number of initial symbols minus
the merges; no identifier is made. A symbol that is no piece is written in bytes and counts
as its UTF-8 length.

No piece of such a vocabulary has the word mark after another character, nor a newline
(checked when it is loaded), so no merge crosses a word and words are counted on their own.
Counts of short words are kept in a bounded memo per worker process.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"


def load_pieces(model_path: str) -> dict[str, float]:
    """Piece -> score of a sentencepiece BPE model; read on the driver, 32,000 entries."""
    from sentencepiece import SentencePieceProcessor
    sp = SentencePieceProcessor(model_file=model_path)
    normal = [i for i in range(sp.get_piece_size())
              if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
    pieces = {sp.id_to_piece(i): sp.get_score(i) for i in normal}
    crossing = [p for p in pieces if MARK in p.lstrip(MARK) or "\n" in p]
    if crossing:
        raise ValueError(f"pieces cross words, e.g. {crossing[:3]}")
    return pieces


def count_symbols(word: str, pieces: dict[str, float]) -> int:
    """Tokens of one stretch of text (marks included): initial symbols minus merges."""
    text = list(word)                       # text of the symbol that starts here, "" once merged
    n = len(text)
    score = pieces.get
    heap = []
    last = text[0] if n else ""
    for i in range(1, n):
        pair = last + text[i]
        s = score(pair)
        if s is not None:
            heap.append((-s, i - 1, pair))
        last = text[i]
    merges = 0
    if heap:
        after = list(range(1, n + 1))
        before = list(range(-1, n - 1))
        heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i]
        if j >= n or not text[i] or text[i] + text[j] != pair:
            continue                        # one side has been merged since
        merges += 1
        text[i], text[j] = pair, ""
        k = after[i] = after[j]
        if k < n:
            before[k] = i
            right = pair + text[k]
            s = score(right)
            if s is not None:
                heapq.heappush(heap, (-s, i, right))
        h = before[i]
        if h >= 0:
            left = text[h] + pair
            s = score(left)
            if s is not None:
                heapq.heappush(heap, (-s, h, left))
    for t in text:                          # no piece: written in bytes
        if t and t not in pieces:
            merges -= len(t.encode("utf-8")) - 1
    return n - merges


class WordCounts(dict):
    """Memo of word -> tokens. A word is what stands between spaces; one that starts with a
    newline is not preceded by a word mark, every other is.

    A word is counted in stretches: it is cut where two characters stand side by side in no
    piece, for no merge can cross such a place. Stretches have a memo of their own.
    """

    def __init__(self, pieces: dict[str, float], entries: int = 500_000, longest: int = 48):
        super().__init__()
        self.pieces, self.entries, self.longest = pieces, entries, longest
        self.stretches: dict[str, int] = {}
        self.beside = {p[i:i + 2] for p in pieces for i in range(len(p) - 1)}

    def keep(self, memo: dict[str, int], key: str, n: int) -> int:
        if len(key) <= self.longest:
            if len(memo) >= self.entries:
                memo.clear()
            memo[key] = n
        return n

    def stretch(self, text: str) -> int:
        n = self.stretches.get(text)
        return self.keep(self.stretches, text, count_symbols(text, self.pieces)) if n is None else n

    def count(self, text: str) -> int:
        beside, at, total = self.beside, 0, 0
        for i in range(1, len(text)):
            if text[i - 1:i + 1] not in beside:
                total += self.stretch(text[at:i])
                at = i
        return total + self.stretch(text[at:])

    def __missing__(self, word: str) -> int:
        n = 1 + (self.count(word[1:]) if len(word) > 1 else 0) \
            if word[:1] == "\n" else self.count(MARK + word)
        return self.keep(self, word, n)


_RUNS = re.compile(f"{MARK}+[^{MARK}\n]*|[^{MARK}\n]+|\n")


def count_tokens_of(text: str, memo: WordCounts) -> int:
    if not text:
        return 0
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " ":      # runs of marks: words are cut with their marks
        runs = _RUNS.findall(MARK + text.replace(" ", MARK))
        return sum(1 if r == "\n" else memo[r[1:]] if r[0] == MARK and r[1:2] != MARK
                   else memo.count(r) for r in runs)
    return sum(map(memo.__getitem__, text.replace("\n", " \n").split(" ")))


_MEMO: dict[str, WordCounts] = {}           # of this worker process


def count_tokens(df: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 4096) -> DataFrame:
    """``id_col, n_bytes, n_tokens, over_limit`` of every row; no begin, end or special tokens.

    Null text counts as empty: 0 bytes, 0 tokens. Special strings inside a text are plain
    text. Texts are never cut. Rows that repeat an id stay separate rows; other columns are
    ignored; an empty table gives an empty table. ``model_path`` is read on the driver only;
    the vocabulary (half a megabyte) is broadcast.
    """
    vocabulary = df.sparkSession.sparkContext.broadcast(load_pieces(model_path))

    @F.pandas_udf(T.LongType())
    def n_tokens(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        memo = _MEMO.get("words")
        if memo is None or memo.pieces is not vocabulary.value:
            memo = _MEMO["words"] = WordCounts(vocabulary.value)
        for texts in batches:
            yield texts.map(lambda t: count_tokens_of(t, memo)).astype("int64")

    text = F.coalesce(F.col(text_col), F.lit(""))
    return df.select(F.col(id_col), F.octet_length(text).cast("long").alias("n_bytes"),
                     n_tokens(text).alias("n_tokens")
                     ).withColumn("over_limit", F.col("n_tokens") > limit)
