"""Exact deduplication over an extendible-hash index on shared files (DataFrame operations only).

A document's 64-bit key is the hash of its text.  Buckets are aligned ranges of keys.  The directory doubles from one slot:
a bucket with more than ``capacity`` keys is split by the next bit of the key, until none is overfull.  It is counted
from cells, the slots of the directory doubled often enough: two doublings more than the keys would need if they
were spread evenly, and four more for as long as some cell is overfull, to all 64 bits if need be.

Only keys that more than one row has are looked up.  The way of a row is key, cell, directory, bucket: the rows of a
bucket go to the task that owns it, which chains texts of one key and compares them byte for byte.  Before that, each
text is aggregated within SALTS parts of its rows, so a group that holds a third of all rows reaches its owner
as SALTS rows.  Owners write their chains, in order of bucket and key, to the shared folder: the index.  A document then
finds its chain by bucket, key and digest.  Texts that appear once are read, but never moved.

Defined results: a null text is the empty text; a null id orders before every other id; rows that repeat both
id and text are one group of which one row stays; very long texts are compared whole; an empty table gives an empty result; other columns pass
through ``keep_one`` untouched, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import maybe_broadcast, ordered_id, row_hash, shown_id, written

CAPACITY = 4096
SALTS = 16
_P = "__exact_"


def _keyed(docs: DataFrame, id_col: str, text: Column) -> DataFrame:
    t = F.coalesce(text, F.lit(""))
    return docs.select(ordered_id(F.col(id_col)).alias("id"), t.alias("t"), F.xxhash64(t).alias("key"))


def _cell(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """(the slots in use of the fully doubled directory: cell, local_depth and bucket (the first cell it covers), written; the depth)."""
    depth = max(0, math.ceil(math.log2(max(1, keys.count()) / capacity))) + 2
    while True:
        cells = written(keys.groupBy(_cell(F.col("key"), depth).alias("cell")).agg(F.count(F.lit(1)).alias("n")), "cells")
        if depth == 64 or not cells.where(F.col("n") > capacity).take(1):
            break
        depth = min(64, depth + 4)
    # depth 64 is a cell per key: none is overfull then
    levels = cells.select("cell", "n", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("level"))
    levels = levels.withColumn("slot", F.when(F.col("level") == 0, F.lit(0)).otherwise(F.expr(f"shiftrightunsigned(cell, {depth} - level)")))
    overfull = levels.groupBy("level", "slot").agg(F.sum("n").alias("keys")).where(F.col("keys") > capacity).drop("keys")
    split = levels.join(maybe_broadcast(written(overfull, "overfull")), ["level", "slot"]).groupBy("cell").agg((F.max("level") + 1).alias("split"))
    found = cells.join(split, "cell", "left").select("cell", F.coalesce("split", F.lit(0)).alias("local_depth"))
    bucket = F.when(F.col("local_depth") == 0, F.lit(0)).otherwise(F.expr(f"shiftleft(shiftrightunsigned(cell, {depth} - local_depth), {depth} - local_depth)"))
    return written(found.withColumn("bucket", bucket.cast("long")), "directory"), depth


def chains(docs: DataFrame, id_col: str, text: Column, capacity: int = CAPACITY) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(id, key, sha of every row; a row for each text that several rows have: bucket, key, sha, place in the chain, keep,
    size; key and sha of rows repeated with their id); all written."""
    keyed = _keyed(docs, id_col, text)
    narrow = written(keyed.select("id", "key", F.sha2("t", 256).alias("sha")), "keyed")
    keys = written(narrow.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "keys")
    slots, depth = directory(keys, capacity)
    several = keys.where("n > 1").withColumn("cell", _cell(F.col("key"), depth)).join(maybe_broadcast(slots.select("cell", "bucket")), "cell").select("bucket", "key")
    found = keyed.join(maybe_broadcast(written(several, "several")), "key")
    salted = found.groupBy("bucket", "key", "t", F.pmod(F.xxhash64("id"), F.lit(SALTS)).alias("salt")).agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("size"))
    # from here on in the bucket's own task
    owned = salted.repartition("bucket").groupBy("bucket", "key", "t").agg(F.max("keep").alias("keep"), F.sum("size").alias("size"))
    place = F.row_number().over(Window.partitionBy("bucket", "key").orderBy("t"))
    chain = owned.withColumn("place", place).where("size > 1").select("bucket", "key", F.sha2("t", 256).alias("sha"), "place", "keep", "size")
    chain = written(chain.sortWithinPartitions("bucket", "key", "place"), "index")
    tops = narrow.join(maybe_broadcast(chain.select("key", "sha", "keep")), ["key", "sha"]).where("id = keep")
    again = tops.groupBy("key", "sha").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    return narrow, chain, written(again.select("key", "sha"), "again")


def _marked(rows: DataFrame, chain: DataFrame, again: DataFrame) -> DataFrame:
    """rows with __exact_id, __exact_key and __exact_sha, and now __exact_keep, __exact_size and __exact_kept."""
    side = maybe_broadcast(chain.select(F.col("key").alias(_P + "key"), F.col("sha").alias(_P + "sha"), F.col("keep").alias(_P + "keep"), F.col("size").alias(_P + "size")))
    rows = rows.join(side, [_P + "key", _P + "sha"], "left")
    kept = F.coalesce(F.col(_P + "id") == F.col(_P + "keep"), F.lit(True))
    if again.take(1):  # one of the rows that repeat the kept id stays
        side = maybe_broadcast(again.select(F.col("key").alias(_P + "key"), F.col("sha").alias(_P + "sha"), F.lit(True).alias(_P + "again")))
        rows = rows.join(side, [_P + "key", _P + "sha"], "left").withColumn(_P + "again", F.coalesce(_P + "again", F.lit(False)) & kept)
        one = Window.partitionBy(_P + "key", _P + "sha").orderBy(row_hash(rows))
        rows = rows.where(F.col(_P + "again")).withColumn(_P + "kept", F.row_number().over(one) == 1).unionByName(rows.where(~F.col(_P + "again")).withColumn(_P + "kept", kept)).drop(_P + "again")
    else:
        rows = rows.withColumn(_P + "kept", kept)
    rows = rows.withColumns({_P + "keep": F.coalesce(_P + "keep", _P + "id"), _P + "size": F.coalesce(_P + "size", F.lit(1)).cast("long")})
    return rows.withColumn(_P + "keep", shown_id(F.col(_P + "keep")))


def decisions(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """A row per document, dropped ones too: doc_id, keep_id, group_size, kept, text_sha256."""
    narrow, chain, again = chains(docs.select("doc_id", "text"), "doc_id", F.col("text"), capacity)
    rows = _marked(narrow.toDF(_P + "id", _P + "key", _P + "sha"), chain, again)
    return rows.select(shown_id(F.col(_P + "id")).alias("doc_id"), F.col(_P + "keep").alias("keep_id"), F.col(_P + "size").alias("group_size"), F.col(_P + "kept").alias("kept"), F.col(_P + "sha").alias("text_sha256"))


def keep_one(docs: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The rows that stay, with the columns of docs."""
    _, chain, again = chains(docs, "doc_id", F.col("text"), capacity)
    t = F.coalesce("text", F.lit(""))
    rows = docs.withColumns({_P + "id": ordered_id(F.col("doc_id")), _P + "key": F.xxhash64(t), _P + "sha": F.sha2(t, 256)})
    return _marked(rows, chain, again).where(F.col(_P + "kept")).select(*[F.col(f"`{c}`") for c in docs.columns])
