"""The corpus pipeline: each stage on its own input against brute force, then run()."""

import corpus_pipeline
import pytest

from gleanspark.llm import decontaminate, mixing
from tests.llm.test_dedup_operators import WORD, brute_near
from tests.llm.test_line_passages import chunk_lines, passage_lines

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output of every stage."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        done = stage(spark, docs, SF).cache()
        out[name] = (docs, done)
        docs = done
    return out


def _texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stage_names_and_columns(stages):
    assert list(stages) == ["language_id", "line_dedup", "near_dedup", "decontamination", "mixing"]
    assert all(out.columns == COLUMNS for name, (_, out) in stages.items() if name != "mixing")


def test_language_stage_keeps_clean_documents(stages):
    before, after = (_texts(x) for x in stages["language_id"])
    assert set(after) <= set(before) and len(after) >= 0.97 * len(before)
    assert all(before[i] == t for i, t in after.items())


def test_line_stage(stages):
    before, after = (_texts(x) for x in stages["line_dedup"])
    rows = list(before.items())
    gone = passage_lines(rows, 50) | chunk_lines(rows)
    want = {i: "\n".join(x for k, x in enumerate(t.split("\n")) if (i, k) not in gone) for i, t in rows}
    assert after == {i: t for i, t in want.items() if t or not before[i]}


def test_near_stage_keeps_one_of_each_group(stages):
    before, after = (_texts(x) for x in stages["near_dedup"])
    kept = {i for i, (_, _, k) in brute_near(list(before.items()), 80).items() if k}
    assert set(after) == kept


def test_decontamination_stage(spark, stages):
    before, after = (_texts(x) for x in stages["decontamination"])
    bench = [decontaminate.words(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    grams = [{tuple(q[k:k + 5]) for k in range(len(q) - 4)} for q in bench]

    def leaks(text):
        w = decontaminate.words(text)
        mine = {tuple(w[k:k + 5]) for k in range(len(w) - 4)}
        return any(g and len(g & mine) >= 0.45 * len(g) for g in grams)

    assert set(before) - set(after) == {i for i, t in before.items() if leaks(t)}


def test_mixing_stage_and_run(spark, stages):
    before, pieces = stages["mixing"]
    sizes = {}
    for r in before.collect():
        sizes[r.source] = sizes.get(r.source, 0) + len(WORD.findall(r.text or ""))
    want = mixing.targets(sizes)
    taken = {}
    source = {r.doc_id: r.source for r in before.collect()}
    for r in pieces.collect():
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.n_words
    assert {s: n for s, n in taken.items()} == {s: round(t) for s, t in want.items() if round(t)}
    whole = corpus_pipeline.run(spark, SF)
    assert whole.count() == pieces.count() and whole.exceptAll(pieces).count() == 0


def test_stages_take_awkward_and_empty_tables(spark):
    rows = [(1, "some words of a text that is here\nand more", "en", "a", 1), (1, "some words of a text that is here\nand more", "en", "a", 1),
            (2, None, None, None, None), (3, "", "en", "a", 0), (None, "no id and some words", None, "b", 3), (4, " \n\n ", "en", None, 2)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for docs in (spark.createDataFrame(rows, schema), spark.createDataFrame([], schema)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            out.count()
            assert name == "mixing" or out.columns == COLUMNS
