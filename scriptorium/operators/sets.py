"""Set algebra, ordered distinct, row multiplication, orders, limits and batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def appended(rows: DataFrame, more: DataFrame) -> DataFrame:
    return rows.unionByName(more, allowMissingColumns=True)


def intersection(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.intersect(b)


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    return a.subtract(b)


def ordered_distinct(df: DataFrame, group: str, order: str, value: str) -> DataFrame:
    """Values in the order of their first row."""
    first = df.groupBy(group, value).agg(F.min(order).alias("first"))
    return first.groupBy(group).agg(F.transform(F.array_sort(F.collect_list(F.struct("first", value))), lambda x: x[value]).alias("values"))


def multiplied(df: DataFrame, items: Column, out: str) -> DataFrame:
    """A row for each item, with its place."""
    return df.select("*", F.posexplode(items).alias("place", out))


def reading_order(df: DataFrame, page: list[str], order: list[str]) -> DataFrame:
    """Rows of each page numbered from the top, and from the left where they are as high; later columns of order break ties."""
    return df.withColumn("place", F.row_number().over(Window.partitionBy(*page).orderBy(*order)))


def in_order_of(df: DataFrame, expected: DataFrame, key: str, seq: str) -> DataFrame:
    """By expected position; unknown ids last, by seq."""
    return df.join(expected.select(key, "pos"), key, "left").orderBy(F.col("pos").asc_nulls_last(), seq)


def top(df: DataFrame, group: list[str], score: list[Column], k: int) -> DataFrame:
    w = Window.partitionBy(*group).orderBy(*score)
    return df.withColumn("place", F.row_number().over(w)).where(F.col("place") <= k)


def first_items(items: Column, k: int) -> Column:
    return F.slice(items, 1, k)


def batches(df: DataFrame, group: str, order: list[str], size: int) -> DataFrame:
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("batch", F.floor((F.row_number().over(w) - 1) / size))


def retried(pages: DataFrame, again: DataFrame, page: str) -> DataFrame:
    """Good pages, and the second try of failed ones; a page that failed twice is an error when it is read."""
    good = pages.where("not failed")
    second = again.join(pages.where("failed").select(page), page, "left_semi")
    checked = second.withColumn("failed", F.when(F.col("failed"), F.raise_error(F.lit("a page failed twice")).cast("boolean")).otherwise(F.lit(False)))
    return good.unionByName(checked)


def remapped_pages(rows: DataFrame, index: DataFrame) -> DataFrame:
    """Pages of a subset as pages of the document: index (subset_page, page)."""
    return rows.withColumnRenamed("page", "subset_page").join(index, "subset_page").drop("subset_page")


def two_phase(first: DataFrame, second: DataFrame, order: str) -> DataFrame:
    """Results of both phases in input order, without those that failed."""
    return first.unionByName(second, allowMissingColumns=True).where("result is not null").orderBy(order)
