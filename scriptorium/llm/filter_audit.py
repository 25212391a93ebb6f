"""How five filters interact: what each removes, alone and after others, in every order.

A row's five failures are a mask of five bits, by built-in expressions.  Whether a text repeats that of a smaller id is the fifth bit: rows
are grouped by a hash of the text first, and only texts whose hash repeats are grouped by themselves, so what decides is the text, byte for
byte, and a hash that stands alone shuffles no text.  A group gives its least id; the row that has it (text's hash and id) is the first, and a
group of copies of any size is one row to join with, by the id, which copies do not share.  Rows are then counted by part and mask: 32
cells a part, whatever the corpus.  Every order's steps are sums over those cells: the filters before a step are bits of the mask.

Defined results: a null text is the empty text, which fails A alone and E if it is not the first (0 words are not under half of 0); a null lang
is the part ''; a null id comes before all others; rows of one id and text are equally first, so they do not repeat each other; a document with
several labels is good or toxic if any of its labels says so, and neither if it has none; very long texts are read whole; an empty table has no
parts; columns beyond doc_id, text and lang are not read."""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import maybe_broadcast, ordered_id, written

FILTERS = "ABCDE"
_SPACE = r"[\x20\x09-\x0D]+"


def _bits(order: Column, step: Column) -> Column:
    """The mask of the filters that an order applies before a step."""
    return sum((F.when(F.instr(order, name) < step, F.lit(1 << k)).otherwise(F.lit(0)) for k, name in enumerate(FILTERS)), F.lit(0))


def text_masks(text: str, least_words: int = 200) -> Column:
    """The bits of A to D for the words in the column w and the text."""
    t, n = F.col(text), F.size("w")
    capitals = F.length(F.regexp_replace(t, "[^A-Z]+", ""))
    fails = [n < least_words, F.lit(100) * F.size(F.array_distinct("w")) < F.lit(50) * n, F.lit(100) * capitals > F.lit(3) * F.length(t), t.rlike("[#$%&*|]")]
    return sum((F.when(x, F.lit(1 << k)).otherwise(F.lit(0)) for k, x in enumerate(fails)), F.lit(0))


def first_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """(id, h): the least id of each text and the text's hash.  docs has id and t; rows has id and h, a hash of t, of the same rows."""
    by_hash = written(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")), "filter-hashes")
    several = by_hash.where("n > 1").select("h")
    alike = docs.withColumn("h", F.xxhash64("t")).join(maybe_broadcast(several), "h", "left_semi")
    return by_hash.where("n = 1").select("id", "h").unionByName(alike.groupBy("h", "t").agg(F.min("id").alias("id")).select("id", "h")).distinct()


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask, and the rows, good rows and toxic rows that have them."""
    docs = docs.select(ordered_id(F.col("doc_id")).alias("id"), F.coalesce("text", F.lit("")).alias("t"), F.coalesce("lang", F.lit("")).alias("part"))
    split = docs.withColumn("w", F.array_remove(F.split("t", _SPACE), ""))
    rows = written(split.select("id", "part", F.xxhash64("t").alias("h"), text_masks("t").alias("m")), "filter-rows")
    first = first_rows(docs.select("id", "t"), rows).withColumn("first", F.lit(True))
    marks = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("id"))
    marks = marks.agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    found = rows.join(first, ["id", "h"], "left").join(marks, "id", "left")
    mask = F.col("m") + F.when(F.col("first"), 0).otherwise(1 << FILTERS.index("E"))
    count = lambda x: F.sum(F.when(x, 1).otherwise(0))
    return found.groupBy("part", mask.alias("mask")).agg(F.count(F.lit(1)).alias("n"), count(F.col("good")).alias("good"), count(F.col("toxic")).alias("toxic"))


def interactions(cells: DataFrame) -> DataFrame:
    """Each part, order and step from at most 32 cells a part."""
    orders = ["".join(p) for p in itertools.permutations(FILTERS)]
    steps = cells.withColumn("filter_order", F.explode(F.array(*map(F.lit, orders)))).withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))))
    name = F.substring("filter_order", F.col("step"), F.lit(1))
    own = sum((F.when(name == x, F.lit(1 << k)).otherwise(F.lit(0)) for k, x in enumerate(FILTERS)), F.lit(0))
    steps = steps.withColumns({"own": own, "before": _bits(F.col("filter_order"), F.col("step"))})
    fails, gone = F.col("mask").bitwiseAND(F.col("own")) > 0, F.col("mask").bitwiseAND(F.col("before")) > 0
    total = lambda c, x: F.sum(F.when(x, F.col(c)).otherwise(0))
    found = steps.groupBy("part", "filter_order", "step", "own").agg(
        total("n", ~gone & ~fails).alias("kept"),
        total("n", ~gone & fails).alias("removed"),
        total("n", gone & fails).alias("redundant"),
        total("n", F.col("mask") == F.col("own")).alias("unique_fails"),
        total("good", ~gone & fails).alias("good_lost"),
        total("toxic", ~gone & fails).alias("toxic_lost"),
    )
    shares = found.groupBy("part", "own").agg(F.sum("removed").alias("shapley"))
    return found.join(shares, ["part", "own"]).drop("own")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    return interactions(written(cells(docs, labels), "filter-cells"))
