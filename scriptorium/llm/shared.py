"""What the operators share: input tables, the shared folder, written intermediates, checked broadcasts."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables of at most so many bytes, as measured, are broadcast; larger ones are joined by a shuffle.
BROADCAST_BYTES = 16 << 20
#: Words, as the contracts state them.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null document id where ids are ordered: before all others.
NO_ID = -(1 << 63)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own: list[str] = []
_written: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir.  Only a local session, as in tests, may leave it unset and gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[[^,]*(,\s*\d+)?\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="scriptorium-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        found = _own[0]
    return found.rstrip("/")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Cut the lineage: write the rows to the shared folder and read them back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"
    _written.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what was written so far; only when no result that reads it is still to be used."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def row_size(df: DataFrame) -> Column:
    """About the bytes of a row: 16 a column, and what variable columns hold."""
    size = F.lit(16 * len(df.columns))
    for field in df.schema:
        kind, col = field.dataType.typeName(), F.col(f"`{field.name}`")
        if kind == "array":
            size = size + F.greatest(F.size(col), F.lit(0)) * (24 if field.dataType.elementType.typeName() == "struct" else 8)
        elif kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(col), F.lit(0))
    return size.cast("long")


def maybe_broadcast(df: DataFrame, limit: int | None = None) -> DataFrame:
    """A written table with a broadcast hint if it is measured to be within the bound.  Beyond it the join
    shuffles (the hint forbids a broadcast by wrong guesses), and AQE splits skewed keys."""
    found = df.agg(F.sum(row_size(df)).alias("n")).collect()[0]["n"] or 0
    return F.broadcast(df) if found <= (limit or BROADCAST_BYTES) else df.hint("merge")


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns that can be hashed, by which rows that tie otherwise are ordered alike in every run."""
    return F.xxhash64(F.lit(0), *[F.col(f"`{f.name}`") for f in df.schema if "map<" not in f.dataType.simpleString()])


def ordered_id(col: Column) -> Column:
    return F.coalesce(col.cast("long"), F.lit(NO_ID))


def shown_id(col: Column) -> Column:
    return F.when(col != NO_ID, col)
