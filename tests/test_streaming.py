"""Incremental load (K01-K03): drops in order equal one batch run; a second run adds
nothing; a later drop only adds new keys."""

import os
import tempfile

from pyspark.sql import functions as F

from gleanspark.plans import products
from gleanspark.sources.tables import table
from gleanspark.streaming.incremental import incremental_load, read_log, read_rejects, read_sink
from gleanspark.streaming.segments import SegmentStore
from querybook import render
from tests.conftest import SF_SMALL


def _run(spark, src, sink, ckpt, schema):
    incremental_load(spark, src, schema, sink, ckpt, transform=lambda df: products.listing(df),
                     key="url", order=["page", "pos"], skip_key="page")


def test_incremental_equals_batch_and_resumes(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-stream-")
    src, sink, ckpt = (os.path.join(root, d) for d in ("src", "sink", "ckpt"))
    pages = render.listing_pages(table(spark, SF_SMALL, "part"), url_by_name=True, per_page=10)
    pages.filter("page < 10").write.parquet(src, mode="append")
    pages.filter("page >= 10 AND page < 15").write.parquet(src, mode="append")
    _run(spark, src, sink, ckpt, pages.schema)
    first = read_sink(spark, sink).count()
    _run(spark, src, sink, ckpt, pages.schema)          # nothing new: no change
    assert read_sink(spark, sink).count() == first
    pages.filter("page >= 15").write.parquet(src, mode="append")
    _run(spark, src, sink, ckpt, pages.schema)          # a later drop adds only new URLs
    got = read_sink(spark, sink).select("page", "pos", "name", "price", "price_num", "url")
    want = products.listing(pages)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert got.groupBy("url").count().filter(F.col("count") > 1).count() == 0


def test_failed_batch_is_replayed_exactly_once(spark):
    """A micro-batch that fails is replayed from the checkpoint on the next run; the
    sink ends equal to the batch result (no lost and no doubled rows)."""
    import pytest

    root = tempfile.mkdtemp(prefix="gleanspark-replay-")
    src, sink, ckpt, flag = (os.path.join(root, d) for d in ("src", "sink", "ckpt", "failed-once"))
    pages = render.listing_pages(table(spark, SF_SMALL, "part"), url_by_name=True, per_page=10)
    for lo, hi in ((0, 7), (7, 14), (14, 10**9)):
        pages.filter((F.col("page") >= lo) & (F.col("page") < hi)).write.parquet(src, mode="append")

    def flaky(df):
        # the second drop fails the first time it is processed
        if not os.path.exists(flag) and df.filter("page >= 7 AND page < 14").limit(1).count():
            open(flag, "w").close()
            raise RuntimeError("simulated executor loss")
        return products.listing(df)

    with pytest.raises(Exception):
        incremental_load(spark, src, pages.schema, sink, ckpt, transform=flaky, key="url",
                         order=["page", "pos"], skip_key="page")
    incremental_load(spark, src, pages.schema, sink, ckpt, transform=flaky, key="url",
                     order=["page", "pos"], skip_key="page")
    got = read_sink(spark, sink).select("page", "pos", "name", "price", "price_num", "url")
    want = products.listing(pages)
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def _scanned(df):
    """Rows that the Parquet scans of an executed frame gave to the plan."""
    rows, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
        if p.nodeName().endswith("QueryStage"):
            todo.append(p.plan())
        if p.nodeName().startswith("Scan parquet"):
            rows += p.metrics().apply("numOutputRows").value()
        todo += [p.children().apply(i) for i in range(p.children().size())]
    return rows


def _urls(spark, lo, hi):
    return spark.range(lo, hi).select(F.concat(F.lit("https://x/"), F.col("id").cast("string")).alias("url"), "id")


def _store(spark, **kw):
    return SegmentStore(spark, tempfile.mkdtemp(prefix="gleanspark-seg-"), {"rows": ["url"]}, **kw)


def test_lookup_reads_the_pages_of_its_keys_only(spark):
    store, read = _store(spark), []
    for epoch, n in enumerate((40_000, 400_000)):
        store.append({"rows": _urls(spark, epoch * 1_000_000, epoch * 1_000_000 + n)}, "r", epoch)
        batch = _urls(spark, 39_950, 40_050)                 # half stored, half new
        known = store.lookup("rows", batch)
        known.collect()
        read.append(_scanned(known))
        assert sorted(r.id for r in store.unknown("rows", batch).collect()) == list(range(40_000, 40_050))
    assert read[0] <= 100 * 500 and read[1] <= 2 * 100 * 500 < 440_000    # one page a key and segment
    big = _urls(spark, 0, 5_000)                             # more keys than a list takes
    assert store.unknown("rows", big).count() == 0


def test_segments_stay_few_and_readers_see_each_row_once(spark):
    store = _store(spark, fan_in=3)
    held = None
    for epoch in range(14):
        assert store.append({"rows": _urls(spark, epoch * 10, epoch * 10 + 10)}, "r", epoch)
        assert not store.append({"rows": _urls(spark, 0, 5)}, "r", epoch)      # a replay
        if epoch == 7:
            held = store.read("rows")                        # a reader of this version ...
        store.compact()
        assert store.read("rows").select("id").distinct().count() == store.read("rows").count() == 10 * (epoch + 1)
        assert len(store.segments("rows")) <= 2 * 3          # 2 of each level
    assert held.count() == 80                                # ... still sees it, once merged or not
    assert store.unknown("rows", _urls(spark, 135, 145)).count() == 5
    before = len(store.versions())
    assert before > 14 and store.vacuum(keep_versions=1) > 0 and len(store.versions()) == 1
    assert store.read("rows").count() == 140


def test_second_writer_is_refused(spark):
    import pytest

    a = _store(spark)
    b = SegmentStore(spark, a.path, a.keys)
    seen = b.version()
    a.append({"rows": _urls(spark, 0, 3)}, "r", 0)
    with pytest.raises(RuntimeError):
        b._commit(seen, [], {})
    assert a.read("rows").count() == 3


def test_run_log_and_rejects(spark):
    root = tempfile.mkdtemp(prefix="gleanspark-log-")
    src, sink, ckpt = (os.path.join(root, d) for d in ("src", "sink", "ckpt"))
    pages = render.listing_pages(table(spark, SF_SMALL, "part"), url_by_name=True, per_page=10)

    def split(df):
        rows = products.listing(df)
        return rows.filter("pos % 3 <> 0"), rows.filter("pos % 3 = 0").select("page", "url")

    def load(part):
        part.write.parquet(src, mode="append")
        incremental_load(spark, src, pages.schema, sink, ckpt, transform=split, key="url",
                         order=["page", "pos"], skip_key="page")

    load(pages.filter("page < 10"))
    load(pages.filter("page >= 5"))                          # pages 5 to 9 once more
    log = read_log(spark, sink).orderBy("epoch").collect()
    assert [r.epoch for r in log] == [0, 1] and len({r.run for r in log}) == 1
    assert log[0].pages_read == 10 and log[0].pages_skipped == 0
    stored = pages.filter("page < 10").select("page").join(read_sink(spark, sink).select("page").distinct(), "page")
    assert log[1].pages_skipped == stored.filter("page >= 5").count() > 0
    assert sum(r.kept for r in log) == read_sink(spark, sink).count()
    assert sum(r.rejected for r in log) == read_rejects(spark, sink).count() > 0
    assert all(r.cards == r.kept + r.repeated for r in log)
    assert not os.path.exists(os.path.join(sink, "drafts")) or os.listdir(os.path.join(sink, "drafts")) == []


def test_recent_state_is_bounded(spark):
    """Each batch's state holds the keys of the last two days of event time only."""
    from querybook.more import recent_deliveries

    rows, state = recent_deliveries(spark, SF_SMALL)
    e = table(spark, SF_SMALL, "events")
    assert rows.count() == rows.select("event_id").distinct().count() <= e.count()
    assert sum(s["late"] for s in state) > 0 and max(s["held"] for s in state) > 0
    hi = e.filter("event_id % 50 <> 0").agg(F.max("ts")).first()[0]
    import datetime
    recent = e.filter(F.col("ts") >= F.lit(hi - datetime.timedelta(days=4)).cast("timestamp_ntz")).count()
    assert state[-1]["held"] <= recent < e.count() / 2
