"""Ordered operators that windows can express."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text


def filled_forward(df: DataFrame, group: str, order: str, label: Column, out: str = "label") -> DataFrame:
    """The last visible label up to each row."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(out, F.last(label, ignorenulls=True).over(w))


def segments(df: DataFrame, group: str, order: str, starts: Column, body: str) -> DataFrame:
    """Rows from one marker to the next, joined."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cut = df.withColumn("segment", F.sum(starts.cast("int")).over(w)).where("segment > 0")
    lines = F.array_sort(F.collect_list(F.struct(order, body)))
    return cut.groupBy(group, "segment").agg(F.array_join(F.transform(lines, lambda x: x[body]), "\n").alias("segment_text"), F.min(order).alias("first"))


def synced(df: DataFrame, group: str, order: str, usable: Column, field: str) -> DataFrame:
    """The field of the first usable row, for all rows of a group that come after."""
    first = df.where(usable).groupBy(group).agg(F.min_by(field, order).alias("__authority"))
    out = df.join(first, group, "left")
    return out.withColumn(field, F.when(F.col(order) > 0, F.coalesce("__authority", field)).otherwise(F.col(field))).drop("__authority")


def shared_prefix(a: Column, b: Column, steps: int = 31) -> Column:
    """The length of the common prefix of two texts (b may be null), by halving: a few comparisons, whatever their length."""
    b = F.coalesce(b, F.lit(""))
    n = F.least(F.char_length(a), F.char_length(b))

    def step(k: Column, size: Column) -> Column:
        return F.when((k + size <= n) & (F.left(a, k + size) == F.left(b, k + size)), k + size).otherwise(k)

    return F.aggregate(F.array(*[F.lit(1 << s) for s in range(steps - 1, -1, -1)]), F.lit(0), step)


#: When texts are alike, and the least shared preamble and rest.
ALIKE, PREAMBLE, REST = 0.62, 60, 12


def compacted(df: DataFrame, group: str, order: str, body: str, least: int = PREAMBLE, rest: int = REST) -> DataFrame:
    """Texts without the preamble, in whole words, that they share with the original text before them, if both are alike."""
    out = df.withColumn("__before", F.lag(body).over(Window.partitionBy(group).orderBy(order)))
    k = F.when(F.col("__before").isNull(), 0).otherwise(shared_prefix(F.col(body), F.col("__before")))
    whole = F.char_length(F.regexp_extract(F.left(F.col(body), k), r"(?s)^.*\s", 0))
    out = out.withColumn("__k", whole)
    cut = (F.col("__k") >= least) & (F.char_length(F.ltrim(F.substring(F.col(body), F.col("__k") + 1, F.char_length(body)))) >= rest)
    # only pairs that share a preamble are compared in full
    out = out.withColumn("__cut", cut & (F.when(cut, text.similarity(F.coalesce("__before", F.lit("")), F.col(body))).otherwise(0.0) >= ALIKE))
    shorter = F.ltrim(F.substring(F.col(body), F.col("__k") + 1, F.char_length(body)))
    return out.withColumns({body: F.when(F.col("__cut"), shorter).otherwise(F.col(body)), "stripped": F.when(F.col("__cut"), F.col("__k")).otherwise(0)}).drop("__before", "__k", "__cut")


def backward(df: DataFrame, group: str, order: str, root: str) -> DataFrame:
    """A report of rows whose root is under the one before; nothing is changed."""
    return df.withColumn("root_before", F.lag(root).over(Window.partitionBy(group).orderBy(order))).where(F.col(root) < F.col("root_before"))


def first_row(df: DataFrame, group: str, order: str, fields: list[str]) -> DataFrame:
    return df.groupBy(group).agg(*[F.min_by(f, order).alias(f) for f in fields])


def carried(df: DataFrame, group: str, order: str, value: str, out: str) -> DataFrame:
    """A page's own value, else the last one before it."""
    return filled_forward(df, group, order, F.col(value), out)


def slot_gaps(df: DataFrame, group: str, ts: str, *ties: str) -> DataFrame:
    """Seconds since the event before, in each group."""
    w = Window.partitionBy(group).orderBy(ts, *ties)
    return df.withColumn("gap_s", (F.unix_micros(F.col(ts).cast("timestamp")) - F.lag(F.unix_micros(F.col(ts).cast("timestamp"))).over(w)) / 1e6)
