"""Parity, coverage, inheritance, sibling and matching joins."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import coerce, text


def parity(qp: DataFrame, ms: DataFrame, key: str) -> DataFrame:
    """Distinct ids of either side with status exact, missing (only in ms) or extra (only in qp).  One aggregate of both sides, which can spill:
    no side is sent whole or joined.  Null ids equal no other."""
    side = lambda df, q: df.select(key, F.lit(q).alias("__q"), F.lit(not q).alias("__m"))
    met = side(qp, True).unionByName(side(ms, False)).groupBy(key).agg(F.max("__q").alias("__q"), F.max("__m").alias("__m"))
    alone = F.array_compact(F.array(F.when(F.col("__m"), "missing"), F.when(F.col("__q"), "extra")))
    both = F.col("__q") & F.col("__m") & F.col(key).isNotNull()
    return met.select(key, F.explode(F.when(both, F.array(F.lit("exact"))).otherwise(alone)).alias("status"))


def covered(ids: DataFrame, known: DataFrame, prefixes: Column, key: str, known_key: str) -> DataFrame:
    """Ids of which some prefix is known: prefixes are exploded, so that it is an equi-join."""
    long = ids.select(key, F.explode(prefixes).alias("__prefix"))
    hit = long.join(known.select(F.col(known_key).alias("__prefix")).distinct(), "__prefix", "left_semi").select(key).distinct()
    return ids.join(hit, key, "left_semi")


def inherited(rows: DataFrame, registry: DataFrame, key: str, fields: list[str], order: str) -> DataFrame:
    """rows with fields from the first row of the registry; blanks do not overwrite."""
    w = Window.partitionBy(key).orderBy(order)
    one = registry.withColumn("__n", F.row_number().over(w)).where("__n = 1").select(key, *[F.col(f).alias(f"__r_{f}") for f in fields])
    out = rows.join(one, key, "left")
    return out.withColumns({f: F.coalesce(coerce.nullif_blank(F.col(f"__r_{f}")), F.col(f)) if f in rows.columns else F.col(f"__r_{f}") for f in fields}).drop(*[f"__r_{f}" for f in fields])


def siblings(rows: DataFrame, key: str, parent: str, body: str) -> DataFrame:
    """Each row with its longest sibling text and the number of siblings; no pairs are formed: the two longest texts of a parent do."""
    one = rows.groupBy(parent, key).agg(F.max(F.struct(F.char_length(body).alias("n"), F.col(body).alias("body"))).alias("own"))
    best = F.struct(F.col("own.n").alias("n"), F.col(key).alias("id"), F.col("own.body").alias("body"))
    top = one.groupBy(parent).agg(F.count(F.lit(1)).alias("__keys"), F.max(best).alias("__first"))
    second = one.join(top.select(parent, F.col("__first.id").alias("__id")), parent).where(F.col(key) != F.col("__id")).groupBy(parent).agg(F.max(best).alias("__second"))
    out = rows.join(top, parent, "left").join(second, parent, "left")
    other = F.when(F.col("__first.id") != F.col(key), F.col("__first.body")).otherwise(F.col("__second.body"))
    return out.withColumns({"siblings": F.col("__keys") - 1, "sibling_text": other}).drop("__keys", "__first", "__second")


def neighbours(rows: DataFrame, group: str, order: str, body: str, reach: int = 2) -> DataFrame:
    w = Window.partitionBy(group).orderBy(order)
    return rows.withColumns({f"before_{k}": F.lag(body, k).over(w) for k in range(1, reach + 1)} | {f"after_{k}": F.lead(body, k).over(w) for k in range(1, reach + 1)})


def clones(rows: DataFrame, key: str, parent: str, body: str, least: int = 8) -> DataFrame:
    """Rows whose squeezed text another row under the same parent has too: counted, not paired."""
    sig = text.squeezed(F.col(body))
    w = Window.partitionBy(parent, F.sha2(sig, 256))
    return rows.withColumn("clones", F.count(F.lit(1)).over(w)).withColumn("first_clone", F.min(key).over(w)).where((F.col("clones") > 1) & (F.char_length(sig) >= least))


#: The least length of a task, and from when on a nearly equal one is a copy.
TASK, LONG_TASK, SAME_TASK = 8, 24, 0.96


def copied_tasks(rescued: DataFrame, rows: DataFrame) -> DataFrame:
    """paper, label, sibling, once each: rescued rows (paper, label, body) whose task a sibling among rows has too: equal, or nearly so if both are long.

    Only the different tasks under a parent are compared, however many rows have them; labels come to the tasks that are alike."""
    def tasks(df: DataFrame, label: str, task: str) -> DataFrame:
        p = F.split("label", r"\.")
        # rows that repeat a text go first; n keeps what is asked of the task from being asked of each of them
        texts = df.groupBy("paper", "label", "body").agg(F.count(F.lit(1)).alias("n"))
        out = texts.select("paper", F.col("label").alias(label), F.array_join(F.slice(p, F.lit(1), F.size(p) - 1), ".").alias("parent"), F.when(F.col("n") > 0, text.task(F.col("body"))).alias(task))
        return out.where((F.col("parent") != "") & (F.char_length(task) >= TASK)).distinct()

    one, other, on = tasks(rescued, "label", "task"), tasks(rows, "sibling", "sibling_task"), ["paper", "parent"]
    met = one.select(*on, "task").distinct().join(other.select(*on, "sibling_task").distinct(), on)
    # a ratio of 0.96 needs lengths that close
    near = F.least(F.char_length("task"), F.char_length("sibling_task")) >= F.greatest(F.lit(LONG_TASK), 0.92 * F.greatest(F.char_length("task"), F.char_length("sibling_task")))
    met = met.where((F.col("task") == F.col("sibling_task")) | near)
    met = met.where((F.col("task") == F.col("sibling_task")) | (text.similarity_from("task", "sibling_task", F.lit(SAME_TASK)) >= SAME_TASK))
    return met.join(one, [*on, "task"]).join(other, [*on, "sibling_task"]).where("label <> sibling").select("paper", "label", "sibling").distinct()


def expected_ids(raw: DataFrame) -> DataFrame:
    """raw (paper, pos, value) -> paper, pos, id, root: canonical ids, each at its first place."""
    from ..functions import labels

    p = labels.parts(F.col("value"))
    found = raw.select("paper", "pos", labels.canonical(p).alias("id"), F.get(p, F.lit(0)).alias("root")).where(F.col("id") != labels.UNKNOWN)
    return found.groupBy("paper", "id").agg(F.min(F.struct("pos", "root")).alias("first")).select("paper", "first.pos", "id", "first.root")


def regions_kept(raster: DataFrame, vector: DataFrame, near: float = 3.0) -> DataFrame:
    """Regions (page, y0, y1) of pictures and, from the top, of drawings that lie near no region kept before; kind tells which."""
    r = raster.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("y0", "y1"))).alias("r"))
    v = vector.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("y0", "y1"))).alias("v"))
    none = F.array().cast("array<struct<y0: double, y1: double>>")
    both = r.join(v, "page", "full").select("page", F.coalesce("r", none).alias("r"), F.coalesce("v", none).alias("v"))

    def step(kept: Column, x: Column) -> Column:
        return F.when(F.exists(kept, lambda k: (F.abs(k["y0"] - x["y0"]) < near) & (F.abs(k["y1"] - x["y1"]) < near)), kept).otherwise(F.array_append(kept, x))

    kept = both.withColumn("kept", F.aggregate("v", F.col("r"), step))
    out = kept.select("page", F.size("r").alias("n"), F.posexplode("kept").alias("at", "x"))
    return out.select("page", F.col("x.y0").alias("y0"), F.col("x.y1").alias("y1"), F.when(F.col("at") < F.col("n"), "image").otherwise("drawing").alias("kind"))


def alike(left: DataFrame, right: DataFrame, block: str, least: float) -> DataFrame:
    """Pairs of left (l_id, l_text) and right (r_id, r_text) of a block that are at least so similar (over 0, at most 1), with their ratio.

    Every step drops only pairs that can't reach the ratio: texts meet in buckets of their lengths' logarithm, as wide as a ratio allows; then the letters
    that they can have in common bound it; then their longest common subsequence; the ratio is computed for what is left."""
    step = max(math.log((2 - least) / least) * 1.0001, 0.01)

    def sized(df: DataFrame, side: str) -> DataFrame:
        tidy = df.withColumn(f"__{side}", text.squeezed(F.col(f"{side}_text"))).withColumn(f"__{side}n", F.length(f"__{side}")).where(F.col(f"__{side}n") > 0)
        return tidy.withColumns({f"__{side}c": text.letter_counts(F.col(f"__{side}")), "__size": F.floor(F.log(f"__{side}n") / step)})

    around = sized(left, "l").withColumn("__size", F.explode(F.array(*(F.col("__size") + k for k in (-1, 0, 1)))))
    met = around.join(sized(right, "r"), [block, "__size"])
    enough = F.lit(least) * (F.col("__ln") + F.col("__rn")) - 1e-9
    met = met.where((2 * F.least("__ln", "__rn") >= enough) & (2 * text.counts_in_common(F.col("__lc"), F.col("__rc")) >= enough))
    met = met.withColumn("ratio", text.similarity_from("__l", "__r", F.lit(least))).where(F.col("ratio") >= least)
    return met.drop("__size", *(f"__{side}{c}" for side in "lr" for c in ("", "n", "c")))


def fuzzy_best(left: DataFrame, right: DataFrame, block: str, least: float) -> DataFrame:
    """The most similar right row (r_id, r_text) of each left row (l_id, l_text) in the same block, at least so similar; of equal ones the first."""
    met = alike(left, right, block, least)
    return met.groupBy(block, "l_id").agg(F.max_by(F.struct("r_id", "ratio"), F.struct("ratio", (-F.col("r_id")).alias("first"))).alias("best")).select(block, "l_id", "best.r_id", "best.ratio")


#: How much text a fuzzy match needs, and the least ratios of fuzzy and suffix matches.
SIGNAL, FUZZY, SUFFIX = 10, 0.78, 0.90


def match_cascade(left: DataFrame, right: DataFrame, block: str) -> DataFrame:
    """left (l_id, l_label, l_text) to right (r_id, r_label, r_text) of a block, as kind and score: the same id; else the most alike text; else
    the same id but for the root and an alike text.  A right row that an id took is not taken again, another one once, by its best left row."""
    exact = left.join(right.withColumnRenamed("r_label", "l_label"), [block, "l_label"]).groupBy(block, "l_id").agg(F.min("r_id").alias("r_id"))
    l_rest = left.join(exact, [block, "l_id"], "left_anti")
    r_rest = right.join(exact.select(block, "r_id"), [block, "r_id"], "left_anti")
    signal = lambda c: F.char_length(F.regexp_replace(c, r"\W+", "")) >= SIGNAL
    texts = alike(l_rest.where(signal("l_text")), r_rest.where(signal("r_text")), block, FUZZY).select(block, "l_id", "r_id", F.col("ratio").alias("score"), F.lit(1).alias("tier"))
    tail = lambda c: F.nullif(F.regexp_replace(c, r"^[^.]*\.?", ""), F.lit(""))
    ends = l_rest.withColumn("__end", tail("l_label")).join(r_rest.withColumn("__end", tail("r_label")), [block, "__end"])
    ratio = text.similarity_from(text.squeezed(F.col("l_text")), text.squeezed(F.col("r_text")), F.lit(2 * SUFFIX - 1))
    ends = ends.withColumn("score", 0.5 + 0.5 * ratio).where(F.col("score") >= SUFFIX).select(block, "l_id", "r_id", "score", F.lit(2).alias("tier"))
    once = texts.unionByName(ends)
    # a match stands if it is the best of both its rows
    for key in ("l_id", "r_id"):
        w = Window.partitionBy(block, key).orderBy("tier", F.desc("score"), "l_id", "r_id")
        once = once.withColumn(f"__{key}", F.row_number().over(w))
    once = once.where("__l_id = 1 and __r_id = 1").select(block, "l_id", "r_id", "score", "tier")
    every = exact.select(block, "l_id", "r_id", F.lit(1.0).alias("score"), F.lit(0).alias("tier")).unionByName(once)
    return every.select(block, "l_id", "r_id", F.element_at(F.array(F.lit("exact"), F.lit("fuzzy"), F.lit("suffix")), F.col("tier") + 1).alias("kind"), F.round("score", 4).alias("score"))


def gap_filled(rows: DataFrame, candidates: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Expected ids that rows lack, from the first candidate; all in expected order, marked recovered."""
    have = rows.withColumn("recovered", F.lit(False))
    w = Window.partitionBy(key).orderBy("seq")
    found = candidates.join(expected.select(key), key, "left_semi").join(rows.select(key), key, "left_anti").withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n").withColumn("recovered", F.lit(True))
    out = have.unionByName(found, allowMissingColumns=True)
    return out.join(expected.select(key, "pos"), key, "left")


def kth_to_kth(regions: DataFrame, rows: DataFrame, page: str, region_order: str, row_order: str) -> DataFrame:
    """On each page the k-th region with the k-th row; regions beyond the last row with the last."""
    r = regions.withColumn("__k", F.row_number().over(Window.partitionBy(page).orderBy(region_order)))
    q = rows.withColumn("__k", F.row_number().over(Window.partitionBy(page).orderBy(row_order)))
    n = q.groupBy(page).agg(F.max("__k").alias("__n"))
    return r.join(n, page).withColumn("__k", F.least("__k", "__n")).drop("__n").join(q, [page, "__k"]).drop("__k")


def baseline(lines: DataFrame, tolerance: float = 2.5, margin: float = 90.0, gap: float = 4.0) -> DataFrame:
    """Bare numbers at the margin with lines on the same baseline: buckets of the tolerance and their neighbours, so an equi-join."""
    bucket = F.floor(F.col("y0") / tolerance)
    heads = lines.where(F.col("text").rlike(r"^\s*\d{1,2}\s*$") & (F.col("x0") <= margin)).select("page", F.col("line_no").alias("head"), F.col("x0").alias("hx"), F.col("y0").alias("hy"), F.explode(F.array(bucket - 1, bucket, bucket + 1)).alias("b"))
    rest = lines.withColumn("b", bucket)
    return heads.join(rest, ["page", "b"]).where((F.abs(F.col("y0") - F.col("hy")) <= tolerance) & (F.col("x0") > F.col("hx") + gap)).drop("b")


def consumed_once(wanted: DataFrame, coords: DataFrame, key: str) -> DataFrame:
    """Each coord with the wanted row of the lowest (seq, priority) among its candidate keys; of a key only its lowest row meets the coords."""
    rest = [c for c in wanted.columns if c != key]
    lowest = wanted.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct("seq", "priority")).alias("__row")).select(key, "__row.*")
    w = Window.partitionBy("coord_id").orderBy("seq", "priority")
    return lowest.join(coords, key).withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


#: What hints of a page are worth for a wanted id.
HINTS = {"expected": 8, "root": 5, "exact": 20, "digit": 3}


def page_hints(pages: DataFrame, wanted: DataFrame) -> DataFrame:
    """target, page, score: a page (paper, page, page_text) shows a wanted id (paper, target, shown, root): exactly, or its root at a line's start,
    or the root's number anywhere."""
    met = pages.join(wanted, "paper")
    squeezed = F.regexp_replace("page_text", r"\s+", "")
    digit = F.regexp_like("page_text", F.concat(F.lit(r"(?<!\d)"), F.col("root"), F.lit(r"(?!\d)")))
    head = F.regexp_like("page_text", F.concat(F.lit(r"(?m)^\s*"), F.col("root"), F.lit(r"(?!\d)")))
    score = F.when(F.contains(squeezed, F.col("shown")), HINTS["exact"]).otherwise(0) + F.when(head, HINTS["root"]).otherwise(0) + F.when(digit, HINTS["digit"]).otherwise(0)
    return met.select("target", "page", score.alias("score")).where("score > 0")


def page_scores(hints: DataFrame, keep: int) -> DataFrame:
    """Pages by the sum of their hints' scores: the best so many, in page order; neighbours may be added by the caller."""
    total = hints.groupBy("target", "page").agg(F.sum("score").alias("score"))
    w = Window.partitionBy("target").orderBy(F.desc("score"), "page")
    return total.withColumn("place", F.row_number().over(w)).where(F.col("place") <= keep).drop("place")
