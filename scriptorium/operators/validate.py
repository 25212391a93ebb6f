"""Validation: parity, gaps, fragmentation, consistency and the decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources import tables


def count_parity(a: DataFrame, b: DataFrame, key: str, tolerance: float = 0.1) -> DataFrame:
    """Distinct keys of both sides; block beyond the tolerance."""
    one = a.agg(F.count_distinct(key).alias("left_ids")).crossJoin(F.broadcast(b.agg(F.count_distinct(key).alias("right_ids"))))  # one row each
    off = F.abs(F.col("left_ids") - F.col("right_ids")) / F.greatest(F.lit(1), "left_ids", "right_ids")
    return one.withColumn("off", F.round(off, 4)).withColumn("decision", F.when(off > tolerance, "block").otherwise("ok"))


def gap_objects(df: DataFrame, group: str, number: str) -> DataFrame:
    """Each missing number with the numbers found before and after it."""
    w = Window.partitionBy(group).orderBy(number)
    pairs = df.select(group, number).distinct().withColumn("found_after", F.lead(number).over(w)).withColumnRenamed(number, "found_before").where("found_after > found_before + 1")
    return pairs.select(group, F.explode(F.sequence(F.col("found_before") + 1, F.col("found_after") - 1)).alias("expected"), "found_before", "found_after")


def fragmentation(gaps: Column, duplicates: Column, orphans: Column, total: Column) -> Column:
    return F.round((gaps + duplicates + orphans) / F.greatest(total, F.lit(1)), 4)


def token_consistency(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """Shared words and numbers of matched texts."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.lower(F.col(c)), F.lit(r"([a-z]{3,}|\d+)"), F.lit(1)))
    both = F.size(F.array_intersect(words(a), words(b)))
    return pairs.withColumn("shared", both).withColumn("share", F.round(both / F.greatest(F.lit(1), F.least(F.size(words(a)), F.size(words(b)))), 4))


#: Under so much a pair's texts are told apart, and between these they are to be looked at.
APART, ALIKE = 0.05, 0.3
#: The most words whose weights are sent to all tasks, and their greatest length.
COMMON, COMMON_LENGTH = 100_000, 40


def semantic_consistency(pairs: DataFrame, key: str, a: str, b: str, most_common: int = COMMON, common_length: int = COMMON_LENGTH) -> DataFrame:
    """key, cosine, terms, numbers, verdict of matched texts: the cosine of their words weighed by rarity over all the texts of pairs (ln((1 + texts) / (1 + texts
    with the word)) + 1), how many words they share, whether each number of the second is in the first, and what to do.

    Texts are shuffled once, by key, so that words are counted where they are.  Weights come from joins on words: those of the common words, which are most
    of what texts hold, are sent to all tasks, and only rarer words are shuffled, if there are any.  Keys are unique; a null text or one without words has the cosine 0."""
    words = lambda c: F.regexp_extract_all(F.lower(F.coalesce(F.col(c), F.lit(""))), F.lit(r"([a-z]{3,}|\d+)"), F.lit(1))
    sided = lambda df: df.select(key, F.explode(F.array(F.struct(F.lit(0).alias("side"), words(a).alias("w")), F.struct(F.lit(1).alias("side"), words(b).alias("w")))).alias("x"))
    texts = pairs.agg((2 * F.count(F.lit(1))).alias("texts"))
    rare = sided(pairs).select(F.explode(F.array_distinct("x.w")).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("df"))
    weight = F.log((1 + F.col("texts")) / (1 + F.col("df"))) + 1
    weights = tables.cut(rare.crossJoin(F.broadcast(texts)).select("word", "df", weight.alias("w")))  # one row
    common = tables.cut(weights.where(F.length("word") <= common_length).orderBy(F.desc("df"), "word").limit(most_common).select("word", "w"))
    rarer = tables.cut(weights.select("word", "w").join(F.broadcast(common), "word", "left_anti"))
    counts = sided(pairs.select(key, a, b).repartition(key)).select(key, "x.side", F.explode("x.w").alias("word")).groupBy(key, "word").agg(*(F.count_if(F.col("side") == k).alias(f"n{k}") for k in (0, 1)))
    met = [counts.join(F.broadcast(common), "word")]  # bounded by most_common and common_length
    if not rarer.isEmpty():
        met.append(counts.join(F.broadcast(common), "word", "left_anti").join(tables.shuffled(rarer), "word"))
    parts = [m.groupBy(key).agg(
        F.sum(F.col("n0") * F.col("n1") * F.col("w") * F.col("w")).alias("dot"), F.sum(F.col("n0") * F.col("n0") * F.col("w") * F.col("w")).alias("aa"), F.sum(F.col("n1") * F.col("n1") * F.col("w") * F.col("w")).alias("bb"),
        F.count_if((F.col("n0") > 0) & (F.col("n1") > 0)).alias("terms"), F.count_if((F.col("n0") == 0) & (F.col("n1") > 0) & F.col("word").rlike(r"^\d")).alias("unmet")) for m in met]
    sums = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1]).groupBy(key).agg(*(F.sum(c).alias(c) for c in ("dot", "aa", "bb", "terms", "unmet")))
    cosine = F.when((F.col("aa") > 0) & (F.col("bb") > 0), F.col("dot") / F.sqrt(F.col("aa") * F.col("bb"))).otherwise(0.0)
    found = pairs.select(key).join(sums, key, "left").select(key, F.round(F.coalesce(cosine, F.lit(0.0)), 6).alias("cosine"), F.coalesce("terms", F.lit(0)).alias("terms"), (F.coalesce("unmet", F.lit(0)) == 0).alias("numbers"))
    verdict = F.when(F.col("cosine") < APART, "block").when((F.col("cosine") < ALIKE) | ~F.col("numbers"), "review").otherwise("ok")
    return found.withColumn("verdict", verdict)


#: Severities.
SEVERITY = {"ok": 0, "review": 1, "block": 2}


def decision(checks: DataFrame, group: str, result: str) -> DataFrame:
    """The worst result of each group."""
    rank = F.element_at(F.create_map(*[F.lit(x) for kv in SEVERITY.items() for x in kv]), F.col(result))
    return checks.groupBy(group).agg(F.max_by(result, rank).alias("decision"))


def with_stems(rows: DataFrame, stems: DataFrame, root: str, body: str) -> DataFrame:
    """Every child under its root's stem."""
    return rows.join(stems.select(root, F.col(body).alias("__stem")), root, "left").withColumn(body, F.concat_ws("\n", "__stem", body)).drop("__stem")
