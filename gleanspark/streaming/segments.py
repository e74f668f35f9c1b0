"""Tables kept as segments: appended batch by batch, merged as they grow.

A ``SegmentStore`` holds some tables of one load. A batch writes one segment per table, a
folder of Parquet files sorted by the hash of the table's key, and commits them together: a
version file names all segments of all tables, and the next version gets a name of its own.
A reader that has read a version sees each row once, whatever is written meanwhile. When
``fan_in`` segments of one table and level are there, they are merged into one of the next
level, so a table has about ``fan_in * log(batches)`` segments however long it lives.
Segments that no version names any more stay until ``vacuum``.

A lookup of some keys reads few pages of each segment: pages are small, rows lie in hash
order and the page index holds the least and largest hash of each page. What a batch reads
follows its own keys and the number of segments, not the number of stored keys.

One writer at a time (a streaming query is one). A batch is (run, epoch), epochs of a run
rise, and a batch that is committed is not taken again: a replay changes nothing.
"""

from __future__ import annotations

import json
import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HASH = "_hash"

#: Keys of a lookup that are sent to the scan as lists of ``LIST``; with more, all keys are read.
LIST_KEYS, LIST = 2_000, 500


class SegmentStore:
    """``keys``: table name -> its key columns (which may be empty: no lookups)."""

    def __init__(self, spark: SparkSession, path: str, keys: dict[str, list[str]], fan_in: int = 8,
                 page_rows: int = 500):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), keys
        self.fan_in, self.page_rows = fan_in, page_rows
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        # a scan gets a list of up to this length value by value, a longer one as its least
        # and largest value; a session of its own, so the caller's settings stay
        self._reading = spark.newSession()
        self._reading.conf.set("spark.sql.parquet.pushdown.inFilterThreshold", str(LIST))
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # ---- versions ----------------------------------------------------------

    def versions(self) -> list[int]:
        folder = self._path(f"{self.path}/versions")
        if not self._fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json"))

    def version(self, number: int | None = None) -> dict:
        """A version (the newest): its segments, and the last epoch of every run."""
        there = self.versions()
        if number is None and not there:
            return {"number": 0, "segments": [], "runs": {}}
        n = there[-1] if number is None else number
        text = self.spark.read.text(f"{self.path}/versions/{n:010d}.json", wholetext=True).first()[0]
        return {"number": n, **json.loads(text)}

    def _commit(self, after: dict, segments: list[dict], runs: dict) -> None:
        """Write the version behind ``after``; an error if it is there (another writer)."""
        name = f"{after['number'] + 1:010d}.json"
        draft, final = self._path(f"{self.path}/drafts/{uuid.uuid4().hex}"), self._path(f"{self.path}/versions/{name}")
        out = self._fs.create(draft, False)
        out.write(bytearray(json.dumps({"segments": segments, "runs": runs}).encode()))
        out.close()
        self._fs.mkdirs(final.getParent())
        if self._fs.exists(final) or not self._fs.rename(draft, final):
            raise RuntimeError(f"{self.path}: version {name} was written by another writer")

    def holds(self, run: str, epoch: int) -> bool:
        return self.version()["runs"].get(run, -1) >= epoch

    # ---- rows --------------------------------------------------------------

    def _hash(self, table: str) -> Column:
        return F.xxhash64(*self.keys[table]) if self.keys[table] else F.lit(0).cast("long")

    def _write(self, table: str, rows: DataFrame) -> dict:
        name = f"segments/{uuid.uuid4().hex}"
        (rows.withColumn(HASH, self._hash(table)).repartitionByRange(HASH).sortWithinPartitions(HASH)
         .write.option("parquet.page.row.count.limit", str(self.page_rows))
         .option("parquet.writer.version", "PARQUET_2_0")    # delta encoding of the hashes
         .option(f"parquet.enable.dictionary#{HASH}", "false").parquet(f"{self.path}/{name}"))
        return {"table": table, "name": name, "level": 0}

    def _scan(self, segments: list[dict], schema: T.StructType | None = None,
              session: SparkSession | None = None) -> DataFrame | None:
        if not segments:
            return None
        reader = (session or self.spark).read
        if schema is not None:
            reader = reader.schema(T.StructType([*schema.fields, T.StructField(HASH, T.LongType())]))
        return reader.parquet(*(f"{self.path}/{s['name']}" for s in segments))

    def segments(self, table: str, of: dict | None = None) -> list[dict]:
        return [s for s in (of or self.version())["segments"] if s["table"] == table]

    def read(self, table: str, schema: T.StructType | None = None) -> DataFrame | None:
        """All rows of a table in the newest version; None before its first batch."""
        rows = self._scan(self.segments(table), schema)
        return None if rows is None else rows.drop(HASH)

    def append(self, tables: dict[str, DataFrame], run: str, epoch: int) -> bool:
        """Add a batch, one segment per table, in one commit; False if it is there already."""
        now = self.version()
        if now["runs"].get(run, -1) >= epoch:
            return False
        new = [self._write(name, rows) for name, rows in tables.items()]
        self._commit(now, [*now["segments"], *new], {**now["runs"], run: epoch})
        return True

    def lookup(self, table: str, df: DataFrame) -> DataFrame | None:
        """Keys of ``table``, among them all that ``df`` has; None before its first batch.

        Up to ``LIST_KEYS`` distinct keys of ``df`` go to the scan as their hashes and only
        the pages they lie in are read; with more keys than that a batch reads all keys.
        """
        keys = self.keys[table]
        stored = self._scan(self.segments(table), T.StructType([df.schema[k] for k in keys]),
                            self._reading)
        if stored is None:
            return None
        hashes = [r[0] for r in df.select(self._hash(table).alias("h")).distinct().limit(LIST_KEYS + 1).collect()]
        if len(hashes) <= LIST_KEYS:
            lists = [F.col(HASH).isin(hashes[i:i + LIST]) for i in range(0, len(hashes), LIST)]
            stored = stored.filter(reduce(Column.__or__, lists, F.lit(False)))
        return stored.select(*keys)

    def unknown(self, table: str, df: DataFrame) -> DataFrame:
        """Rows of ``df`` whose key ``table`` does not hold."""
        known = self.lookup(table, df)
        return df if known is None else df.join(known, self.keys[table], "left_anti")

    # ---- upkeep ------------------------------------------------------------

    def draft(self, df: DataFrame, batch: str) -> DataFrame:
        """``df`` written to the drafts of ``batch`` and read back: computed once, whatever
        reads it."""
        path = f"{self.path}/drafts/{batch}/{uuid.uuid4().hex}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop_drafts(self, batch: str) -> None:
        self._fs.delete(self._path(f"{self.path}/drafts/{batch}"), True)

    def compact(self) -> int:
        """Merge the segments of every table and level that has ``fan_in`` of them; how many.
        One commit puts the merged segment in the place of the old ones."""
        merged = 0
        while True:
            now = self.version()
            levels: dict[tuple, list[dict]] = {}
            for s in now["segments"]:
                levels.setdefault((s["table"], s["level"]), []).append(s)
            full = next((k for k in sorted(levels) if len(levels[k]) >= self.fan_in), None)
            if full is None:
                return merged
            old = levels[full]
            new = {**self._write(full[0], self._scan(old).drop(HASH)), "level": full[1] + 1}
            self._commit(now, [*(s for s in now["segments"] if s not in old), new], now["runs"])
            merged += len(old)

    def vacuum(self, keep_versions: int = 10) -> int:
        """Delete versions but the last ``keep_versions``, segments that none of these names
        (how many is returned) and drafts of batches that failed. For a time when nothing is
        loaded and readers of older versions are done."""
        self.drop_drafts("")
        there = self.versions()
        named = {s["name"].split("/")[1] for n in there[-keep_versions:] for s in self.version(n)["segments"]}
        folder, gone = self._path(f"{self.path}/segments"), 0
        for s in self._fs.listStatus(folder) if there and self._fs.exists(folder) else []:
            if s.getPath().getName() not in named:
                self._fs.delete(s.getPath(), True)
                gone += 1
        for n in there[:-keep_versions]:
            self._fs.delete(self._path(f"{self.path}/versions/{n:010d}.json"), False)
        return gone
