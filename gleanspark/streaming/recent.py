"""Keep-first on an endless stream (K03): state for recent keys only.

``incremental`` keeps the first row of a key for ever, by looking into its sink. Where the
same capture is delivered again within a known time, Structured Streaming's own state is
enough: ``dropDuplicatesWithinWatermark`` remembers a key for ``delay`` after its row's time.

Order of rows and lateness: the first row of a key to arrive is kept; a row of the same key
that arrives while the key is remembered is dropped; a row whose time is at or before the
watermark (the latest time of earlier batches, less ``delay``) is late and dropped, whether
its key was seen or not. So the state holds the keys of the last ``delay`` of event time,
however long the stream runs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def keep_first_recent(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """The first row to arrive of every key, remembered for ``delay`` (``'2 days'``).
    ``event_time`` is a timestamp column; rows without a time are never late."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(keys)


def load_recent(spark: SparkSession, source_dir: str, schema: T.StructType | str, sink_dir: str, checkpoint: str,
                keys: list[str], event_time: str, delay: str) -> list[dict]:
    """Append to the Parquet folder ``sink_dir`` what ``source_dir`` has that is new since the
    last call with this checkpoint, without rows delivered again; state and watermark live in
    the checkpoint. Gives the state operators of every batch (rows held, late, dropped)."""
    stream = keep_first_recent(spark.readStream.schema(schema).parquet(source_dir), keys, event_time, delay)
    q = (stream.writeStream.format("parquet").option("path", sink_dir).option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    exc = q.exception()
    if exc is not None:
        raise RuntimeError(f"load failed: {exc}")
    return [op for p in q.recentProgress for op in map(_plain, p["stateOperators"])]


def _plain(op) -> dict:
    return {"held": op["numRowsTotal"], "late": op["numRowsDroppedByWatermark"],
            "repeated": op["customMetrics"].get("numDroppedDuplicateRows", 0)}
