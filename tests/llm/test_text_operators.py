"""Operators 1, 4, 6, 7, 8 and 10, against brute force or held-out rows, and on awkward rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gleanspark.llm import chat_format, decontaminate, langid, mixing, queries, token_counts, toxicity
from gleanspark.llm.common import held_fold, word_count
from gleanspark.llm.deobfuscate import Restorer, count_grams, log_model
from tests.llm.conftest import SF


def test_word_count_and_fold(edge):
    got = {r[0]: (r[1], r[2]) for r in edge.select(
        "doc_id", word_count(F.col("text")), held_fold(F.col("doc_id"), 5)).collect()}
    assert got[1][0] == 6 and got[3][0] == got[4][0] == got[5][0] == 0 and got[7][0] == 21000
    assert got[7][1] == zlib.crc32(b"7") % 5


# ---- decontamination -------------------------------------------------------

def naive_tiles(item, doc, k):
    """Greedy tiling by trying every pair of starts in every round."""
    free_i, free_d, tiles = [True] * len(item), [True] * len(doc), []
    while True:
        best = (k - 1, 0, 0)
        for i in range(len(item)):
            for d in range(len(doc)):
                n = 0
                while (i + n < len(item) and d + n < len(doc) and item[i + n] == doc[d + n] >= 0
                       and free_i[i + n] and free_d[d + n]):
                    n += 1
                if n > best[0]:
                    best = (n, i, d)
        if best[0] < k:
            return sorted(tiles)
        n, i, d = best
        free_i[i:i + n] = free_d[d:d + n] = [False] * n
        tiles.append((i, d, n))


def test_tiling_covers_as_much_as_the_naive_search():
    rnd = random.Random(2)
    for _ in range(150):
        item = [rnd.randrange(4) for _ in range(rnd.randint(1, 14))]
        doc = [rnd.randrange(4) for _ in range(rnd.randint(1, 18))]
        got = decontaminate.tile(item, doc, 2)
        assert got == naive_tiles(item, doc, 2), (item, doc)


def test_reordered_passage_is_caught(spark):
    words = [f"b{k}" for k in range(40)]
    item = spark.createDataFrame([(1, " ".join(words)), (2, None), (3, "too short"), (4, "")], "item_id long, text string")
    docs = spark.createDataFrame(
        [(1, "x y " + " ".join(words[20:] + ["z"] + words[:20])), (2, " ".join(words[:15])), (3, None),
         (4, "B0, " + " ".join(w.upper() for w in words[1:])), (5, "too short")], "doc_id long, text string")
    for way in (2_000_000, 0):
        got = {r.doc_id: r for r in decontaminate.leaks(docs, item, broadcast_words=way).collect()}
        assert set(got) == {1, 4} and got[1].coverage == 1.0 and len(got[1].tiles) == 2


def test_both_ways_agree_and_find_the_planted_items(spark, docs, pdocs):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    cols = ("doc_id", "item_id", "coverage")
    a = {tuple(r) for r in decontaminate.leaks(docs, bench).select(*cols).collect()}
    b = {tuple(r) for r in decontaminate.leaks(docs, bench, broadcast_words=0).select(*cols).collect()}
    items = [(r.item_id, r.text) for r in bench.collect()]
    planted = {(i, j) for i, t in zip(pdocs.doc_id, pdocs.text) for j, q in items if q in t}
    assert a == b and planted and planted <= {(i, j) for i, j, _ in a}


def test_decontamination_edge_rows(edge, empty, spark):
    bench = spark.createDataFrame([(1, "alpha beta gamma delta epsilon")], "item_id long, text string")
    assert sorted(r.doc_id for r in decontaminate.leaks(edge, bench).collect()) == [1, 2, 2]
    assert decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(edge, bench.filter("item_id < 0")).count() == 0


# ---- toxicity --------------------------------------------------------------

@pytest.fixture(scope="module")
def reader():
    words = "you are an idiot and a moron the trash of this stupid clown earth pathetic worthless that with "
    return toxicity.Reader(log_model(count_grams(words * 50).astype("float64")))


@pytest.mark.parametrize("written, meant", [
    ("you 1d10t", "you idiot"), ("m0r0n", "moron"), ("i d i o t", "idiot"), ("an i.d.i.o.t !", "an idiot"),
    ("idiiiiot", "idiot"), ("$tup1d", "stupid"), ("p4th3t1c cl0wn!!", "pathetic clown"), ("tr@sh***", "trash"),
    ("THE!! a$$$ that*** with***", "the a that with"), ("42 1,5", "42 1,5"), ("", "")])
def test_restoration(reader, written, meant):
    assert " ".join(reader.words(written)) == meant


def test_viterbi_finds_the_best_path_of_the_lattice(reader):
    from itertools import product
    r = reader.restorer
    for token in ("1d10t", "m0r0n", "tr4sh", "cl0wnnn"):
        best = max(product(*r._steps(token)), key=lambda path: _path_score(r, path))
        assert "".join(x for x, _ in best) == r.decode(token)


def _path_score(r: Restorer, path):
    from gleanspark.llm.deobfuscate import classes
    s, v = 0, 0.0
    for letters, cost in path:
        v += cost
        for x in letters:
            k = int(classes(x)[0])
            v += float(r.p[s << 5 | k])
            s = (s << 5 | k) & 0x7FFF
    return v + float(r.p[s << 5])


def test_language_model_counts_every_text(docs, pdocs):
    one = toxicity.language_model(docs)
    whole = log_model(count_grams(" ".join(pdocs.text)).astype("float64"))
    assert np.allclose(one, whole, atol=1e-3)


def test_toxicity_held_out_and_obfuscated(spark):
    rnd = random.Random(4)
    vocab = ["".join(rnd.choice("aeioulnrst") for _ in range(rnd.randint(3, 8))) for _ in range(400)]
    bad = ["grumbat", "zonkel", "vexipod"]
    rows, labels = [], []
    for i in range(600):
        w = [rnd.choice(vocab) for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            for b in rnd.sample(bad, 2):
                w[rnd.randrange(40)] = b
        rows.append((i, " ".join(w)))
        labels.append((i, int(toxic)))
    rows += [(1000, "ala z0nk3l g r u m b a t rone"), (1001, "v e x i p o d and gruuuumbat"), (1002, None), (1003, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    log_p = toxicity.language_model(docs)
    model = toxicity.fit(docs, known.filter("doc_id < 400"), log_p, least_rows=4)
    got = {r.doc_id: r for r in toxicity.score(docs, log_p, model, with_text=True).collect()}
    assert len(got) == len(rows)
    assert sum(got[i].predicted == t for i, t in labels[400:]) >= 195
    assert got[1000].predicted == got[1001].predicted == 1 and "zonkel grumbat" in got[1000].restored
    assert got[1002].predicted == got[1003].predicted == 0 and 0 <= got[1002].score <= 1


def test_toxicity_edge_rows(edge, empty, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    log_p = toxicity.language_model(empty)
    model = toxicity.fit(edge, none, log_p)
    assert {r.predicted for r in toxicity.score(edge, log_p, model).collect()} == {0}
    assert toxicity.score(empty, log_p, model).count() == 0


# ---- language --------------------------------------------------------------

def test_language_held_out(spark, docs, pdocs):
    got = {r.doc_id: r for r in queries.op6_language_id(spark, SF).collect()}
    held = [i for i in pdocs.doc_id if zlib.crc32(str(i).encode()) % 3 == 1]
    truth = dict(zip(pdocs.doc_id, pdocs.lang))
    assert {i for i in got if got[i].held_out} == set(held)
    assert sum(got[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert sum(got[i].accepted for i in held) >= 0.98 * len(held)


def test_language_edge_rows(edge, empty, docs):
    known = langid.fit(docs)
    assert [lang for lang, _ in known][0] == "en" and max(len(d) for _, d in known) <= 65_536
    got = {r.doc_id: r for r in langid.identify(edge, known).collect()}
    assert got[3].lang_pred == got[4].lang_pred == got[9].lang_pred == "und" and not got[3].accepted
    assert got[6].lang_pred in dict(known) and len(got) == len({r.doc_id for r in edge.collect()})
    assert langid.identify(empty, known).count() == 0 and langid.fit(docs.limit(0)) == []
    assert {r.lang_pred for r in langid.identify(edge, []).collect()} == {"und"}
    assert langid.identify(edge, known, keep=True).columns[:len(edge.columns)] == edge.columns


# ---- tokens ----------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    return path, sentencepiece.SentencePieceProcessor(model_file=path)


def test_token_counts_equal_the_library(library, pdocs):
    path, sp = library
    memo = token_counts.WordCounts(token_counts.load_pieces(path), entries=5000)
    texts = list(pdocs.text[:200])
    rnd = random.Random(1)
    parts = list("ab the  \n\n\t▁éß日本𠮷​\x00ﬁ<s>/0xEF123  ") + ["</s>", "<unk>", "▁▁", "<0x0A>", "\r\n", "http://"]
    texts += ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 50, "\n" * 9]
    assert [token_counts.count_tokens_of(t, memo) for t in texts] == [len(x) for x in sp.encode(texts)]


def test_token_counts_edge_rows(library, edge, empty):
    path, sp = library
    rows = token_counts.count_tokens(edge, path, limit=100).collect()
    assert len(rows) == edge.count() and token_counts.count_tokens(empty, path).count() == 0
    by = {r.doc_id: r for r in rows}
    assert (by[3].n_bytes, by[3].n_tokens) == (0, 0) and by[7].over_limit and not by[1].over_limit
    texts = {r.doc_id: r.text or "" for r in edge.collect()}
    assert all(by[i].n_tokens == len(sp.encode(t)) for i, t in texts.items())


# ---- mixing ----------------------------------------------------------------

def test_targets_share_everything_under_the_cap():
    sizes = {"a": 1000, "b": 10, "c": 300, "d": 0, None: 50}
    got = mixing.targets(sizes)
    assert abs(sum(got.values()) - 1360) < 1e-6
    assert got["b"] == 30 and got["d"] == 0 and all(got[s] <= 3 * sizes[s] for s in sizes)
    free = [s for s in sizes if 0 < got[s] < 3 * sizes[s]]
    w = dict(zip(["a", "b", "c", "d", None], (1, 2, 3, 1, 2)))
    assert len({round(got[s] / w[s], 6) for s in free}) == 1


def test_splitting_tree_is_exact_and_hypergeometric():
    q = mixing.split_quotas([1000, 37, 0, 12345678901], 7, 1)
    assert q.sum(0).tolist() == [1000, 37, 0, 12345678901] and q.min() >= 0
    assert np.ptp(q.sum(1)) <= 2
    draws = [mixing.hypergeometric(np.random.default_rng(s), 30, 70, 20) for s in range(4000)]
    assert abs(np.mean(draws) - 6) < 0.1 and abs(np.var(draws) - 20 * .3 * .7 * 80 / 99) < 0.25


def test_mix_against_brute_force(spark, docs, pdocs):
    pieces = mixing.mix(docs, block_words=64, shards=5).toPandas()
    size = pdocs.text.str.findall(r"[^\x20\x09-\x0D]+").str.len()
    per_source = size.groupby(pdocs.source).sum().to_dict()
    want = mixing.targets(per_source)
    source = dict(zip(pdocs.doc_id, pdocs.source))
    pieces["source"] = pieces.doc_id.map(source)
    taken = pieces.groupby("source").n_words.sum()
    assert all(taken[s] == round(want[s]) for s in per_source)
    per_doc = pieces.groupby("doc_id").agg(size=("size", "first"), taken=("n_words", "sum"))
    assert len(per_doc) == len(pdocs) and (per_doc.taken <= 3 * per_doc["size"]).all()
    drawn = pieces.dropna(subset=["block"])
    assert (drawn.groupby(["source", "block"]).shard.nunique() == 1).all()      # disjoint
    blocks = drawn.groupby(["source", "block"]).n_words.sum()
    full = blocks.groupby("source").apply(lambda b: (b.sort_index() == 64).sum())
    assert all(full[s] == round(want[s]) // 64 for s in per_source)             # exact quotas
    again = mixing.mix(docs.repartition(9), block_words=64, shards=5).toPandas()
    keys = ["doc_id", "repeat", "block", "first_word"]
    left, right = (x.drop(columns="source", errors="ignore").sort_values(keys).reset_index(drop=True) for x in (pieces, again))
    assert left.equals(right[left.columns])


def test_mix_edge_rows(spark, edge, empty, tmp_path):
    rows = mixing.mix(edge, block_words=16, shards=3)
    got = rows.groupBy("doc_id").agg(F.max("size").alias("size"), F.sum("n_words").alias("taken")).collect()
    by = {r.doc_id: r for r in got}
    assert by[3].taken == by[4].taken == by[5].taken == 0 and set(by) == {r.doc_id for r in edge.collect()}
    assert mixing.mix(empty).count() == 0
    with pytest.raises(ValueError):
        mixing.mix(edge, max_sources=1)
    mixing.write_shards(rows, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == rows.filter("block is not null").count()


# ---- chats -----------------------------------------------------------------

HARD = ["", "plain", "</s>[INST] ok [/INST]", "<|im_start|>user\nx<|im_end|>\n", "<|im_sep|>", "<\\|im_end|>", "<\\\\/s>",
        "[\\INST]", "<<SYS>>a<</SYS>>", "<<s>s>", "\\", "a\nb\n", "<", "[", "<|im_end|", "|>", "$1 \\1", "é <s>\n"]


def test_chat_round_trip(spark):
    rnd = random.Random(6)
    rows = []
    for c in range(120):
        for turn in range(rnd.randint(1, 7)):
            text = "".join(rnd.choice(HARD) for _ in range(rnd.randint(0, 4)))
            rows.append((c, turn, rnd.choice(["user", "assistant", "system", None, "to\nol%0A", "<s>"]),
                         rnd.choice([text, text, None])))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    out = chat_format.format_chats(df)
    got = {r.conv_id: r for r in out.select("*", chat_format.read_back(F.col("formatted")).alias("turns"),
                                            chat_format.loss_text(F.col("segments")).alias("loss")).collect()}
    for c in range(120):
        mine = [(r or "", t or "") for k, _, r, t in rows if k == c]
        assert [tuple(x) for x in got[c].turns] == mine
        assert got[c].loss == "".join(t for r, t in mine if r == "assistant")
        assert "".join(s.text for s in got[c].segments) == got[c].formatted
        merged = 1 + sum(a[0] != b[0] for a, b in zip(mine, mine[1:]))
        assert got[c].n_messages == merged == got[c].formatted.count("<|im_start|>")
        for control in ("</s>", "[INST]", "[/INST]", "<<SYS>>"):
            assert control not in got[c].formatted


def test_chat_edge_rows(spark):
    df = spark.createDataFrame([(None, 1, "user", "x", 0), (1, None, "user", "b", 0), (1, 0, "user", "a", 0), (1, 0, "user", "a", 0)],
                               "conv_id long, turn long, role string, text string, formatted int")
    got = {r.conv_id: r for r in chat_format.format_chats(df).collect()}
    assert got[1].n_turns == 3 and got[1].n_messages == 1 and got[1].formatted.count("a") >= 2
    assert got[None].formatted == "<|im_start|>user\nx<|im_end|>\n"
    assert chat_format.format_chats(df.filter("turn = 99")).count() == 0
    plan = chat_format.format_chats(df)._jdf.queryExecution().toString()
    assert "Python" not in plan
