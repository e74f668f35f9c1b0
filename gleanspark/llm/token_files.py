"""Token files: Parquet list columns, readable in part (operator 13).

A data set of token files holds one row a document: ``doc_id``, ``part`` (which range of
ids it lies in), ``part_start`` (ids before it in that range), ``n_tokens`` and the list
``ids``. Files follow one another in ascending document id. The ids are dictionary encoded
(a vocabulary fits one dictionary page); the ascending metadata columns are delta encoded.
Row groups and pages have set sizes and every page is in the page index, so that a reader of
lengths never touches ids, and a reader of some documents takes only their pages.

``write_tokens`` deals the texts by id range in one shuffle; ids are made behind it, inside
the writing tasks. The place of a document among all ids is its part's base, a running sum
over one row a part, plus ``part_start``.
"""

from __future__ import annotations

import gc
import json
import os
import re
import sys
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.llm.common import bounded_batches
from gleanspark.session import checkpoint_dir

#: The characters that ``\\s`` means in a byte-level pre-tokenizer (White_Space).
_SPACE = "".join(map(chr, (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029,
                               0x202F, 0x205F, 0x3000)))
#: White space and the word behind it. No pre-token has white space behind other characters,
#: and none looks further than the next word, so a text's ids are those of its pieces in turn.
_PIECE = re.compile(f"[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+")
_OTHER_SPACE = [c for c in _SPACE if c not in " \n"]
#: Parts whose bases (16 bytes each) are broadcast; with more they are joined by a shuffle.
BASES = 1_000_000

#: One pre-token of letters, and one with ASCII marks behind it: no pre-token goes from a letter
#: to a mark, so the two parts stand for themselves.
_LETTER = "[A-Za-zÀ-ÖØ-öø-ÿ]"
_LETTERS = re.compile(f" ?{_LETTER}+")
_MARKED = re.compile(rf"( ?{_LETTER}+)([!-/:-@\[-`{{-~]+)")
#: A comma or full stop that does not stand right behind a letter or digit. No pre-token goes
#: from these to a mark, so texts without such a place may be cut before every one of the two.
_LOOSE = re.compile(rf"[^{_LETTER[1:-1]}0-9][,.]")

SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("part", T.IntegerType()),
    T.StructField("part_start", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.ArrayType(T.IntegerType(), False))])


class PieceIds(dict):
    """Piece -> its ids as little-endian 32-bit integers, made by the library.

    A bounded memo in two generations: a full one becomes the older one, and what is used of
    the older one is taken over. Unknown pieces of letters go straight to the library's model;
    marks behind letters are looked up on their own; anything else goes through all of it.
    """

    def __init__(self, definition: bytes, entries: int = 500_000):
        super().__init__()
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel
        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("needs little-endian 32-bit integers")
        self.library = Tokenizer.from_buffer(definition)
        self.library.no_truncation()
        self.library.no_padding()
        self.tokenize = self.library.model.tokenize
        self.specials = [a["content"] for a in json.loads(definition).get("added_tokens", [])]
        self.cut_marks = not any(c in s for s in self.specials for c in ",.")
        plain = ByteLevel(add_prefix_space=False, use_regex=False)
        # how the library writes bytes as characters, read from the library itself
        self.written = {ord(c): plain.pre_tokenize_str(c)[0][0] for c in map(chr, range(256))
                        if re.match(_LETTER, c) or c == " "}
        self.space = self.written[ord(" ")]
        self.entries, self.old = entries, {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.old.get(piece)
        if ids is None:
            if piece.isascii() and piece[1:].isalpha() and piece[0] == " ":
                ids = array("I", [t.id for t in self.tokenize(self.space + piece[1:])]).tobytes()
            elif _LETTERS.fullmatch(piece):
                ids = array("I", [t.id for t in self.tokenize(piece.translate(self.written))]).tobytes()
            elif (parts := _MARKED.fullmatch(piece)) and not any(s in piece for s in self.specials):
                ids = self[parts[1]] + self[parts[2]]
            else:
                ids = array("I", self.library.encode(piece, add_special_tokens=False).ids).tobytes()
        if len(self) >= self.entries:
            self.old.clear()
            self.old.update(self)
            self.clear()
        if len(piece) <= 64:
            self[piece] = ids
        return ids

    def of(self, text: str | None) -> bytes:
        return b"".join(map(self.__getitem__, _pieces(text, self.cut_marks))) if text else b""


def _pieces(text: str, marks: bool = False) -> list[str]:
    """White space with the word behind it. Texts whose only white space is single spaces and
    newlines between words are cut without a regex; with ``marks``, commas and full stops
    behind words are pieces of their own there, so a word and its marked forms are one entry."""
    if ("  " in text or " \n" in text or "\n " in text or "\n\n" in text or "\0" in text or text[-1] in " \n"
            or text[0] in " \n" or any(c in text for c in _OTHER_SPACE)):
        return _PIECE.findall(text)
    if marks and text[0] not in ",." and not _LOOSE.search(text):
        text = text.replace(",", "\0,").replace(".", "\0.")
    return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")


_MEMO: dict[int, PieceIds] = {}             # of this worker process


def _piece_ids(definition: bytes) -> PieceIds:
    """The memo of this process for a tokenizer."""
    key = hash(definition)
    if key not in _MEMO:
        _MEMO.clear()
        _MEMO[key] = PieceIds(definition)
    return _MEMO[key]


def _check_pretokens(definition: bytes) -> None:
    """Texts are cut at white space; refuse a tokenizer for which that is not the same."""
    t = json.loads(definition)
    pre = t.get("pre_tokenizer") or {}
    plain = (pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space")
             and t.get("normalizer") is None
             and not any(a["lstrip"] or a["rstrip"] or a["single_word"] or re.search(f"[{_SPACE}]", a["content"])
                         for a in t.get("added_tokens", [])))
    if not plain:
        raise ValueError("needs a byte-level tokenizer without prefix space or normalizer")


def write_tokens(df: DataFrame, path: str, tokenizer_path: str, end_id: int = 2,
                 id_col: str = "doc_id", text_col: str = "text", row_group_bytes: int = 16 << 20,
                 page_bytes: int = 256 << 10, page_rows: int = 2_000, parts: int | None = None) -> None:
    """Write the token files of ``df`` to ``path``; ``end_id`` ends every document.

    Null text counts as empty (one id, the end). Special strings inside texts are taken as
    the library takes them by default; texts are never cut. Documents lie in ascending id, a
    null id first; rows that repeat an id lie side by side, ordered by hash and length of
    the text, and ranges of ids split between such rows too. An empty table gives a data set
    without rows; other columns are ignored. ``tokenizer_path`` is read on the driver and
    its definition (a few megabytes) broadcast.
    """
    with open(tokenizer_path, "rb") as f:
        definition = f.read()
    _check_pretokens(definition)
    bounded_batches(df)
    tokenizer = df.sparkSession.sparkContext.broadcast(definition)
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _piece_ids(tokenizer.value)
        part, start = TaskContext.get().partitionId(), 0
        for batch in batches:
            if not batch.num_rows:
                continue
            gc.disable()                                     # millions of short-lived objects without cycles
            try:
                lists = [memo.of(t) + end for t in batch.column(1).to_pylist()]
            finally:
                gc.enable()
            sizes = np.array([len(b) // 4 for b in lists], dtype=np.int64)
            ends = np.concatenate([[0], np.cumsum(sizes)])
            ids = pa.Array.from_buffers(pa.int32(), int(ends[-1]), [None, pa.py_buffer(b"".join(lists))])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.full(len(sizes), part), pa.int32()),
                 pa.array(start + ends[:-1]), pa.array(sizes),
                 pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], SCHEMA.names)
            start += int(ends[-1])

    texts = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.octet_length("text")]
    dealt = texts.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    writer = dealt.mapInArrow(encode, SCHEMA).write
    for key, value in {
            "parquet.writer.version": "PARQUET_2_0",         # delta encodings
            "parquet.block.size": row_group_bytes, "parquet.page.size": page_bytes,
            "parquet.page.row.count.limit": page_rows,
            "parquet.dictionary.page.size": 1 << 20, "parquet.enable.dictionary": "false",
            "parquet.enable.dictionary#ids.list.element": "true",
            "compression": "snappy"}.items():
        writer = writer.option(key, str(value))
    writer.parquet(path)


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """The documents of a data set: ``doc_id, start, n_tokens`` and, on demand, ``ids``.

    ``start`` is the number of ids of all documents before. A filter on ``doc_id`` reaches
    the scan, where row groups and pages outside it are skipped; without ids their column
    chunks are not read. The bases come from two metadata columns, one row a part.
    """
    rows = spark.read.schema(SCHEMA).parquet(path)
    sums = rows.groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("_n"))
    # one row a part (a writing task), however many documents: small enough for one window
    bases = sums.select(F.col("part").alias("_part"), (F.sum("_n").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_base"))
    # ids are not shuffled for a table of parts that is known to be small
    checkpoint_dir(spark)
    bases = bases.checkpoint()
    if bases.count() <= BASES:
        bases = F.broadcast(bases)
    joined = rows.drop(*([] if with_ids else ["ids"])).join(bases, F.col("part") == F.col("_part"))
    return joined.select("doc_id", (F.col("_base") + F.col("part_start")).alias("start"), "n_tokens",
                         *(["ids"] if with_ids else []))


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of a list of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf(T.LongType())
    def crc(lists: pa.Array) -> pa.Array:
        ids = lists.values.cast(pa.int32()).to_numpy(zero_copy_only=True).view("u1")
        ends = lists.offsets.to_numpy() * 4
        return pa.array([zlib.crc32(ids[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return crc(ids)
