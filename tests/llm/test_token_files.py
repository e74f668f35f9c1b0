"""Operator 13 against the library, and what a reader touches."""

import glob
import random
import zlib

import numpy as np
import pyarrow.dataset as ds
import pyarrow.parquet as pq
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gleanspark.llm import queries, token_files
from gleanspark.llm.common import scratch
from tests.llm.conftest import SF

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def brute(rows, library):
    """Rows (doc_id, text) with distinct ids: doc_id -> (start, n_tokens, crc)."""
    out, start = {}, 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array(library(text) + [2], dtype="<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_query_equals_the_library(spark, library):
    t = ds.dataset(f"{SF}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pydict()
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op13_token_files(spark, SF).collect()}
    assert got == brute(list(zip(t["doc_id"], t["text"])), library)


def test_pieces_equal_whole_texts(library):
    with open(PATH, "rb") as f:
        memo = token_files.PieceIds(f.read(), entries=50)
    rnd = random.Random(2)
    bits = ["a", "Zz", "é", "日本", "𝒳", "'s", "'", "12", "!", "...", "<|endoftext|>", "<|endoftext", "|>"] + list(
        " \t\n\r\x0b\x0c\x1c\x1d\x1f\x85\xa0    ​  　﻿᠎") + [" ", "  ", "\n\n"] * 3
    bits += list("aZéß(),.'-_²Ⅷµ\u0301\0")
    for _ in range(600):
        texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(20)] + [None, "plain words\nand lines"]
        for text, ids in zip(texts, map(memo.of, texts)):
            assert np.frombuffer(ids, dtype="<u4").tolist() == library(text), ascii(text)
    assert len(memo) <= 50 and len(memo.old) <= 50


def test_marked_words_share_one_entry(library):
    """A word and the same word before a comma or full stop; where marks stand elsewhere the ids are the library's too."""
    with open(PATH, "rb") as f:
        memo = token_files.PieceIds(f.read())
    memo.of("a plain, plain. plain\nplain, 3.5, 4")
    assert " plain" in memo and "," in memo and not {" plain,", " plain.", "\nplain,"} & set(memo)
    rnd = random.Random(4)
    bits = ["a", "Zz", "é", "e\u0301", "日本", "'s", "12", "²", "!", ",", ".", "...", "—", "<|endoftext|>", "word"] + [" "] * 5 + ["\n", ",", "."]
    for _ in range(3000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(1, 12)))
        assert np.frombuffer(memo.of(text), dtype="<u4").tolist() == library(text), ascii(text)


def test_files_are_as_set(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    path = scratch(spark, "tokens")
    token_files.write_tokens(docs, path, PATH, row_group_bytes=256 << 10, page_bytes=16 << 10, page_rows=50, parts=3)
    files = sorted(glob.glob(f"{path.removeprefix('file:')}/part-*.parquet"))
    assert len(files) == 3
    last = -1
    for name in files:
        meta = pq.ParquetFile(name).metadata
        assert meta.num_row_groups > 1
        for g in range(meta.num_row_groups):
            columns = {meta.row_group(g).column(c).path_in_schema: meta.row_group(g).column(c)
                       for c in range(meta.num_columns)}
            ids = next(v for k, v in columns.items() if k.startswith("ids"))
            assert any("DICTIONARY" in e for e in ids.encodings)
            for c in ("doc_id", "part_start", "n_tokens"):
                assert "DELTA_BINARY_PACKED" in columns[c].encodings
                assert columns[c].has_offset_index and columns[c].has_column_index
            assert columns["doc_id"].statistics.min > last                       # ascending over files
            last = columns["doc_id"].statistics.max
    lengths = token_files.read_tokens(spark, path, with_ids=False)
    plan = lengths._jdf.queryExecution().executedPlan().toString()
    assert "ids" not in plan
    some = token_files.read_tokens(spark, path).filter("doc_id between 100 and 109")
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,100)" in plan
    whole = {r.doc_id: r for r in token_files.read_tokens(spark, path).collect()}
    assert {r.doc_id: r for r in some.collect()} == {i: whole[i] for i in range(100, 110)}


def test_awkward_rows(spark, edge, empty, library):
    path = scratch(spark, "tokens")
    token_files.write_tokens(edge, path, PATH, parts=4)
    got = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert sorted((str(r.doc_id), list(r.ids)) for r in got) == sorted(
        (str(r.doc_id), library(r.text) + [2]) for r in edge.collect())
    assert [r.start for r in got] == list(np.cumsum([0] + [r.n_tokens for r in got])[:-1])
    assert [r.doc_id for r in got] == sorted((r.doc_id for r in got), key=lambda i: (i is not None, i))
    path = scratch(spark, "tokens")
    token_files.write_tokens(empty, path, PATH)
    assert token_files.read_tokens(spark, path).collect() == []


def test_partitioning_changes_nothing(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    seen = set()
    for frame, parts in ((docs, 1), (docs.repartition(6), 9), (docs.orderBy(F.desc("doc_id")), 4)):
        path = scratch(spark, "tokens")
        token_files.write_tokens(frame, path, PATH, parts=parts)
        r = token_files.read_tokens(spark, path).agg(F.sum(F.xxhash64("doc_id", "start", "n_tokens", "ids").cast("decimal(38,0)"))).first()
        seen.add(r[0])
    assert len(seen) == 1


def test_other_tokenizers_are_refused(spark, edge):
    with pytest.raises(ValueError):
        token_files.write_tokens(edge, scratch(spark, "tokens"), public_tokenizers.path("word_bpe_49k.json"))
