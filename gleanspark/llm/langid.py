"""Language identification by compression (operator 6).

Each language has a zstandard raw-content dictionary cut from its own texts. A text is
encoded once per language; the language whose dictionary gives the fewest bytes wins, and
the answer is rejected when the runner-up is almost as small.

A text is encoded as its lower-cased words of letters, a word that repeats the one before
it written once, in blocks of ``BLOCK`` bytes that each start from the dictionary alone:
every part of a long text counts, and none of it can lean on its own earlier parts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
import zstandard as zstd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanspark.llm.common import bounded_batches

BLOCK = 2048
_WORD = re.compile(r"[^\W\d_]+")


def plain_words(text: str) -> str:
    out, last = [], None
    for w in _WORD.findall(text.lower()):
        if w != last:
            out.append(w)
        last = w
    return " ".join(out)


def fit(df: DataFrame, learn: Column | None = None, id_col: str = "doc_id",
        text_col: str = "text", lang_col: str = "lang", docs_per_lang: int = 400,
        chars_per_doc: int = 2000, dict_bytes: int = 65_536, max_langs: int = 512,
        ) -> list[tuple[str, bytes]]:
    """(language, dictionary) pairs, the language with most rows first.

    A bounded sample: of the rows with a text and a language (and ``learn``, if given), the
    ``docs_per_lang`` smallest by hash of id, ``chars_per_doc`` characters of each, equal
    pieces once, ``dict_bytes`` bytes in all. The rank is limited inside every partition
    before the shuffle, so a language holding most rows is no hot group. At most
    ``max_langs`` languages (more is an error).
    """
    rows = df.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    rows = rows.filter(learn) if learn is not None else rows
    keys = rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"),
                       F.xxhash64(F.col(id_col)).alias("_h"))
    counts = keys.groupBy("_lang").agg(F.count(F.lit(1)).alias("n")).limit(max_langs + 1).collect()
    if len(counts) > max_langs:
        raise ValueError(f"over {max_langs} languages: raise max_langs if the driver can hold them")
    rank = F.row_number().over(Window.partitionBy("_lang").orderBy("_h", "_id"))
    chosen = keys.withColumn("_r", rank).filter(F.col("_r") <= docs_per_lang)
    # broadcast: docs_per_lang * max_langs rows of an id at most
    pieces = (rows.select(F.col(id_col).alias("_id"), F.col(lang_col).alias("_lang"),
                          F.substring(text_col, 1, chars_per_doc).alias("_piece"))
              .join(F.broadcast(chosen.select("_id", "_lang", "_h")), ["_id", "_lang"]).collect())
    texts: dict[str, list[bytes]] = {}
    for r in sorted(pieces, key=lambda r: (r["_h"], str(r["_id"]), r["_piece"])):
        words = plain_words(r["_piece"]).encode()
        have = texts.setdefault(r["_lang"], [])
        if words and words not in have:
            have.append(words)
    order = sorted(counts, key=lambda r: (-r["n"], r["_lang"]))
    return [(r["_lang"], b" ".join(texts[r["_lang"]])[:dict_bytes])
            for r in order if texts.get(r["_lang"])]


class Compressors:
    """One compressor per language, with its dictionary digested once per process."""

    def __init__(self, dictionaries: list[tuple[str, bytes]]):
        self.langs = [lang for lang, _ in dictionaries]
        how = zstd.ZstdCompressionParameters(
            strategy=zstd.STRATEGY_GREEDY, window_log=17, hash_log=16, chain_log=16, search_log=3,
            min_match=5, write_content_size=False, write_dict_id=False)
        self.each = []
        for _, content in dictionaries:
            d = zstd.ZstdCompressionDict(content, dict_type=zstd.DICT_TYPE_RAWCONTENT)
            d.precompute_compress(compression_params=how)
            self.each.append(zstd.ZstdCompressor(dict_data=d, compression_params=how))

    def sizes(self, text: str) -> list[int]:
        data, sizes = plain_words(text).encode(), [0] * len(self.each)
        for at in range(0, len(data), BLOCK):
            block = data[at:at + BLOCK]
            for i, c in enumerate(self.each):
                sizes[i] += len(c.compress(block))
        return sizes

    def answer(self, text: str | None) -> tuple[str, float]:
        """(language, margin): margin is the share by which the runner-up is larger."""
        if not text or not _WORD.search(text) or not self.each:
            return "und", 0.0
        sizes = self.sizes(text)
        best = min(range(len(sizes)), key=sizes.__getitem__)     # ties: the commoner language
        others = [s for i, s in enumerate(sizes) if i != best]
        return self.langs[best], 1 - sizes[best] / min(others) if others else 1.0


def identify(df: DataFrame, dictionaries: list[tuple[str, bytes]], id_col: str = "doc_id",
             text_col: str = "text", min_margin: float = 0.002, keep: bool = False) -> DataFrame:
    """``id_col, lang_pred, score, margin, accepted`` of every row (with ``keep``, all columns
    of ``df`` as well; a column of one of these names is replaced).

    ``lang_pred`` is a learned language, or ``und`` if the text is null, has no letter, or
    nothing was learned. ``score`` rises with the margin from 0 to 1. ``accepted`` is false
    for ``und`` and for margins under ``min_margin``. Whole texts are encoded. Rows that
    repeat an id stay separate rows; other columns are ignored; an empty table gives an
    empty table. The dictionaries are broadcast: 64 KB a language.
    """
    bounded_batches(df)
    shared = df.sparkSession.sparkContext.broadcast(dictionaries)

    @F.pandas_udf("lang string, margin double")
    def ask(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        compressors = Compressors(shared.value)
        for texts in batches:
            yield pd.DataFrame([compressors.answer(t) for t in texts], columns=["lang", "margin"])

    asked = (df if keep else df.select(id_col, text_col)).withColumn("_a", ask(F.col(text_col)))
    margin = F.col("_a.margin")
    named = {"lang_pred": F.col("_a.lang"), "score": margin / (margin + 0.02), "margin": margin,
             "accepted": (F.col("_a.lang") != "und") & (margin >= min_margin)}
    carried = [c for c in df.columns if c not in named] if keep else [id_col]
    return asked.select(*carried, *(v.alias(k) for k, v in named.items()))
