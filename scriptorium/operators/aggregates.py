"""Rollups, reports, merges and clusterings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cost_rollup(ledger: DataFrame, by: list[str], sums: list[str], usage: Column) -> DataFrame:
    """Calls and sums of usage rows by model; null counts as 0."""
    return ledger.where(usage).groupBy(*by).agg(F.count(F.lit(1)).alias("calls"), *[F.round(F.sum(F.coalesce(c, F.lit(0.0))), 4).alias(c) for c in sums])


def failures(ledger: DataFrame, failed: Column, order: str, error: str, keep: int = 8) -> DataFrame:
    """The number of failures and the first few errors."""
    first = ledger.where(failed).orderBy(order).limit(keep)
    n = ledger.agg(F.count_if(failed).alias("failures"))
    return n.crossJoin(F.broadcast(first.agg(F.array_sort(F.collect_list(F.struct(order, error))).alias("first_errors"))))  # one row each


def counts(df: DataFrame, by: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("count"))


def gaps(df: DataFrame, group: str, number: str) -> DataFrame:
    """Groups whose numbers leave some of min..max out: how many, and the first."""
    found = df.groupBy(group).agg(F.min(number).alias("lo"), F.max(number).alias("hi"), F.collect_set(number).alias("have"))
    missing = F.array_except(F.sequence("lo", "hi"), F.col("have"))
    return found.withColumn("missing", missing).where(F.size("missing") > 0).select(group, F.size("missing").alias("n_missing"), F.array_min("missing").alias("first_missing"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def coverage(parity_rows: DataFrame) -> DataFrame:
    """One row: exact, missing and extra ids and the covered share of those expected."""
    one = parity_rows.agg(*[F.count_if(F.col("status") == s).alias(s) for s in ("exact", "missing", "extra")])
    return one.withColumn("ratio", F.round(F.col("exact") / F.greatest(F.lit(1), F.col("exact") + F.col("missing")), 4))


def merged_spans(df: DataFrame, group: list[str], order: str, body: str, marks: str) -> DataFrame:
    """Rows of one label: distinct lines in order, marks summed, the number of rows."""
    rows = F.array_sort(F.collect_list(F.struct(order, body)))
    return df.groupBy(*group).agg(F.array_join(F.array_distinct(F.transform(rows, lambda r: r[body])), "\n").alias("merged"), F.sum(marks).alias("marks"), F.count(F.lit(1)).alias("rows"))


def accumulated(lines: DataFrame, table: str, order: str, label: str, parts: list[str]) -> DataFrame:
    """Lines of a table under the last label shown: each part's non-blank lines in order, one below the other; lines before a first label go."""
    from . import windows

    blank = F.nullif(F.trim(F.coalesce(label, F.lit(""))), F.lit(""))
    held = windows.filled_forward(lines, table, order, blank, "__label").where("__label is not null")
    rows = F.array_sort(F.collect_list(F.struct(order, *parts)))
    texts = lambda p: F.array_join(F.filter(F.transform("__rows", lambda r: r[p]), lambda x: F.trim(x) != ""), "\n")
    return held.groupBy(table, F.col("__label").alias(label)).agg(rows.alias("__rows")).select(table, label, *[texts(p).alias(p) for p in parts])


def clusters(df: DataFrame, group: str, start: str, end: str, gap: float) -> DataFrame:
    """Intervals joined unless they start over gap after all before them have ended."""
    w = Window.partitionBy(group).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    cut = df.withColumn("__new", F.coalesce((F.col(start) > before + F.lit(gap)).cast("int"), F.lit(1)))
    cut = cut.withColumn("cluster", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return cut.groupBy(group, "cluster").agg(F.min(start).alias("lo"), F.max(end).alias("hi"), F.count(F.lit(1)).alias("n"))


def children(ids: DataFrame, prefixes: Column, key: str, pos: str) -> DataFrame:
    """Every ancestor with its descendants in order."""
    long = ids.select(key, pos, F.explode(prefixes).alias("ancestor")).where(F.col("ancestor") != F.col(key))
    return long.groupBy("ancestor").agg(F.transform(F.array_sort(F.collect_list(F.struct(pos, key))), lambda x: x[key]).alias("children"))


def first_by(df: DataFrame, group: str, value: str, order: list[str]) -> DataFrame:
    return df.groupBy(group).agg(F.min_by(value, F.struct(*order)).alias(value))


def envelope(rows: DataFrame, paper: str, number: str, fields: list[str]) -> DataFrame:
    """A response for each paper: its rows in order (a paper has tens), and the report on its distinct root numbers."""
    row = F.struct("seq", *fields)
    found = rows.groupBy(paper).agg(F.array_sort(F.collect_list(row)).alias("__rows"), F.collect_set(number).alias("__have"))
    missing = F.array_sort(F.array_except(F.sequence(F.array_min("__have"), F.array_max("__have")), "__have"))
    gap = F.size("__have") > 0
    gone = F.when(gap, missing).otherwise(F.array().cast(rows.select(F.array(number)).schema[0].dataType))
    report = F.struct(F.when(F.size(gone) > 0, "warning").otherwise("ok").alias("status"), F.when(F.size(gone) > 0, "review").otherwise("proceed").alias("recommendation"), gone.alias("missing"))
    return found.select(paper, F.transform("__rows", lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("questions"), report.alias("report"))


def response_summary(df: DataFrame, urls: str) -> DataFrame:
    full = F.filter(F.col(urls), lambda u: F.trim(u) != "")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(F.size(full)).alias("urls"), F.sum(F.aggregate(full, F.lit(0), lambda a, u: a + F.char_length(u))).alias("url_chars"))


def capped(df: DataFrame, page: str, order: str, per_page: int, pages: int, rows: int) -> DataFrame:
    """At most so many rows a page, pages and rows, in order."""
    some = df.withColumn("__k", F.row_number().over(Window.partitionBy(page).orderBy(order))).where(F.col("__k") <= per_page)
    first = df.groupBy(page).agg(F.min(order).alias("__first")).orderBy("__first").limit(pages).select(page)
    return some.join(F.broadcast(first), page, "left_semi").orderBy(order).limit(rows).drop("__k")
