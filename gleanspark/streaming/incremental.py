"""Incremental loads on Structured Streaming.

Captured pages arrive as files. ``incremental_load`` reads them with ``readStream`` and,
per micro-batch (``foreachBatch``):

1. skips pages whose key is already stored (E03/E04, no extraction work for them),
2. extracts and cleans (any DataFrame -> DataFrame function, which may give a second frame
   of rejected rows) and writes what it gives once, to a draft,
3. keeps the first row per key inside the batch (K03),
4. anti-joins with the stored keys (stored rows win, I01),
5. commits the rows, the keys of their pages, the rejects and one row of the run log
   together to the ``SegmentStore`` of the sink, and merges segments that have become many.

The run is the streaming query's own id, which Spark keeps in the checkpoint: an epoch that
is committed is not taken again when it is replayed, one that is not leaves nothing behind,
and a load with a new or lost checkpoint starts a new run that sees everything stored before.
State is the sink itself, not a growing in-memory seen-set; what a batch reads of it follows
the batch (see ``segments``).
"""

from __future__ import annotations

import json
import uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gleanspark.operators.dedup import keep_first
from gleanspark.streaming.segments import SegmentStore

_LOG = ("run string, epoch long, pages_read long, pages_skipped long, cards long, repeated long, "
        "kept long, rejected long")


def incremental_load(spark: SparkSession, source_dir: str, schema: T.StructType | str,
                     sink_dir: str, checkpoint: str,
                     transform: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]],
                     key: str | list[str], order: list, skip_key: str | None = None,
                     max_files_per_trigger: int | None = None) -> None:
    """Run the load until every file now in ``source_dir`` is processed
    (``availableNow``), then return. Call again later to pick up new files.

    Inside a micro-batch the ``order`` keys decide which row of a key is kept; across
    micro-batches the earlier batch wins (arrival order). By default all new files
    form one micro-batch; ``max_files_per_trigger`` bounds the batch size, and then
    files arrive in modification-time order. ``transform`` gives the rows, or (rows,
    rejects). An error while the stored keys are read fails the batch."""
    keys = [key] if isinstance(key, str) else list(key)
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(source_dir)

    def run_batch(pages: DataFrame, epoch: int) -> None:
        run = json.loads(spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0])["id"]
        store = SegmentStore(spark, sink_dir, {"rows": keys, "pages": [skip_key] if skip_key else [],
                                               "rejects": [], "log": []})
        if store.holds(run, epoch):                          # a replay of a committed batch
            return
        fresh = store.unknown("pages", pages) if skip_key else pages
        made = transform(fresh)
        cards, rejects = made if isinstance(made, tuple) else (made, None)
        batch = f"{run}-{epoch}-{uuid.uuid4().hex}"
        cards = store.draft(cards, batch)
        rows = store.draft(store.unknown("rows", keep_first(cards, keys, order)), batch)
        tables = {"rows": rows}
        if skip_key:
            tables["pages"] = rows.select(skip_key).distinct()
        if rejects is not None:
            tables["rejects"] = rejects = store.draft(rejects, batch)
        # counts of what is written: footers, and one narrow scan of the page keys
        read, n_fresh, n_cards, kept = pages.count(), fresh.count(), cards.count(), rows.count()
        tables["log"] = spark.createDataFrame(
            [(run, epoch, read, read - n_fresh, n_cards, n_cards - kept, kept,
              0 if rejects is None else rejects.count())], _LOG)
        store.append(tables, run, epoch)
        store.drop_drafts(batch)
        store.compact()

    q = (stream.writeStream.foreachBatch(run_batch)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(f"incremental load failed: {exc}")


def _table(spark: SparkSession, sink_dir: str, name: str) -> DataFrame:
    got = SegmentStore(spark, sink_dir, {name: []}).read(name)
    if got is None:
        raise ValueError(f"{sink_dir} has no table {name!r}")
    return got


def read_sink(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The stored rows."""
    return _table(spark, sink_dir, "rows")


def read_rejects(spark: SparkSession, sink_dir: str) -> DataFrame:
    """The rows that the transform rejected."""
    return _table(spark, sink_dir, "rejects")


def read_log(spark: SparkSession, sink_dir: str) -> DataFrame:
    """J10, one row per run and epoch: pages read and skipped (already stored), cards
    extracted, of these repeated (in the batch or stored) and kept, rows rejected."""
    return _table(spark, sink_dir, "log")
