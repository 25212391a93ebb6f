"""A table of answers by key that runs write to: versions of buckets, swapped by one small file.

A version is a list of folders, one a bucket of keys.  A write reads the buckets that its new rows fall into, merges them (of one key the latest row stays, of one
time the largest answer) and writes those buckets to new folders; then it creates the file of the next version, which names the new
folders and, for the other buckets, the old ones.  Creating that file is the swap: it is there whole or not at all (it is written under another name and
renamed), and a write that is killed before leaves the old version and a few folders that nobody names.  A write with a token that the last version has is
not made again, so a batch of foreachBatch that is repeated changes nothing.  Two writers at once must not be: the second finds its version taken and
raises.  Files that can't be read are left out, so their keys are misses and are made anew.  What the driver reads is the list of buckets."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tables

SCHEMA = "key string, ts timestamp, answer string"


class Store:
    def __init__(self, spark: SparkSession, folder: str, buckets: int = 16) -> None:
        """buckets: of a new store; one that is there keeps its own."""
        self.spark, self.folder, self.new_buckets = spark, folder.rstrip("/"), buckets
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = self.path(self.folder).getFileSystem(spark._jsc.hadoopConfiguration())

    def _manifest(self) -> dict:
        """The last version: number, token, buckets, and the folder of each bucket that has rows."""
        where = self.path(f"{self.folder}/versions")
        found = [s.getPath().getName() for s in self.files.listStatus(where)] if self.files.exists(where) else []
        numbers = [int(x[:-5]) for x in found if x.endswith(".json") and x[:-5].isdigit()]
        if not numbers:
            return {"version": 0, "token": None, "buckets": self.new_buckets, "parts": {}}
        raw = self.spark.read.option("wholetext", True).text(f"{self.folder}/versions/{max(numbers):012d}.json").first()[0]
        return json.loads(raw)

    def _swap(self, manifest: dict) -> None:
        name = f"{self.folder}/versions/{manifest['version']:012d}.json"
        draft = self.path(f"{self.folder}/versions/.{uuid.uuid4().hex}")
        out = self.files.create(draft, False)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self.files.exists(self.path(name)) or not self.files.rename(draft, self.path(name)):
            raise RuntimeError(f"another write has made version {manifest['version']}")

    def _rows(self, parts: list[str]) -> DataFrame:
        if not parts:
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).parquet(*parts)

    def read(self) -> DataFrame:
        """All rows (key, ts, answer) of the last version."""
        return self._rows(list(self._manifest()["parts"].values()))

    def upsert(self, new: DataFrame, token: str | None = None) -> bool:
        """Put in rows (key, ts, answer); false if the last version has the token.  Rows with a null key are left out."""
        last = self._manifest()
        if token is not None and last["token"] == token:
            return False
        n = last["buckets"]
        bucket = F.pmod(F.xxhash64("key"), F.lit(n))
        new = tables.cut(new.select("key", F.col("ts").cast("timestamp").alias("ts"), F.col("answer").cast("string").alias("answer")).where("key IS NOT NULL").withColumn("bucket", bucket))
        touched = [str(r.bucket) for r in new.select("bucket").distinct().collect()]  # at most as many as there are buckets
        old = self._rows([last["parts"][b] for b in touched if b in last["parts"]]).withColumn("bucket", bucket)
        merged = old.unionByName(new).groupBy("bucket", "key").agg(F.max(F.struct("ts", "answer")).alias("x")).select("bucket", "key", "x.ts", "x.answer")
        made = f"{self.folder}/parts/{uuid.uuid4().hex}"
        merged.repartition("bucket").write.partitionBy("bucket").parquet(made)
        self._swap({"version": last["version"] + 1, "token": token, "buckets": n, "parts": last["parts"] | {b: f"{made}/bucket={b}" for b in touched}})
        return True

    def answered(self, wanted: DataFrame, compute: Callable[[DataFrame], DataFrame], now: Column, hours: float = 4.0, token: str | None = None) -> DataFrame:
        """key, answer, hit for the keys of wanted: fresh rows of the store, the rest by compute(rest) -> key, answer, which are then put in."""
        found, new = tables.cached(self.read(), wanted, compute, now, hours)
        found = tables.cut(found)  # what was made is put in, and not made twice
        self.upsert(found.where("NOT hit").select("key", now.cast("timestamp").alias("ts"), "answer"), token)
        return found

    def clear(self) -> None:
        """Forget all versions."""
        self.files.delete(self.path(self.folder), True)
