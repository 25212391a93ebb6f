"""Projections, row filters and predicates."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, labels, text
from ..sources import tables


def declared(df: DataFrame, schema: dict[str, str]) -> DataFrame:
    """Only declared fields, missing ones as nulls."""
    return df.select(*[(F.col(c).cast(t) if c in df.columns else F.lit(None).cast(t)).alias(c) for c, t in schema.items()])


def remapped(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Each field from the first of its aliases that holds a value; aliases go."""
    found = {c: coerce.first_of(*[F.col(a) for a in [c, *names] if a in df.columns]) for c, names in aliases.items() if {c, *names} & set(df.columns)}
    gone = {a for names in aliases.values() for a in names} - set(aliases)
    return df.withColumns(found).drop(*gone)


def rescaled_percent(values: list[Column]) -> list[Column]:
    """Percents from values on a scale of 100, 1000 or up to 3000, clamped to 0..100."""
    top = F.greatest(*values)
    scale = F.when((top > 100) & (top <= 1000), F.lit(10.0)).when((top > 1000) & (top <= 3000), top / 100).otherwise(F.lit(1.0))
    return [F.greatest(F.lit(0.0), F.least(F.lit(100.0), v / scale)) for v in values]


def valid_regions(df: DataFrame, y0: str = "y0", y1: str = "y1", page: str = "page_num") -> DataFrame:
    """Regions of 0..100 with a height of 2..70, clamped to 5..95, padded by 10; clipping_risk where clamped."""
    a, b = F.col(y0), F.col(y1)
    ok = df.where((F.col(page) >= 2) & (a >= 0) & (b <= 100) & (a < b) & ((b - a).between(2, 70)))
    ok = ok.withColumns({"c0": F.greatest(a, F.lit(5.0)), "c1": F.least(b, F.lit(95.0)), "clipping_risk": (a < 5) | (b > 95)}).where("c1 - c0 >= 2")
    ok = ok.withColumns({"p0": F.round(F.greatest(F.col("c0") - 10, F.lit(5.0)), 2), "p1": F.round(F.least(F.col("c1") + 10, F.lit(95.0)), 2)})
    return ok.where("p1 - p0 <= 85").drop("c0", "c1")


def crop_allowed(y0: Column, y1: Column) -> Column:
    return (y0 >= 0) & (y1 <= 100) & (y1 > y0) & (y1 - y0 <= 72)


#: Page furniture and formula-sheet phrases.
FURNITURE = r"(?i)turn over|blank page|copyright|ucles|do not write|formula sheet|list of formulas|candidate number|permission to reproduce"
COVER = r"(?i)list of formulas"
VISUAL = r"(?i)\b(?:diagram|graph|grid|figure|sketch|drawn|draw|shown|shows|plot|axes|triangle|circle|scale drawing|net|map)\b"


def is_noise_line(t: Column, y0: Column | None = None, page: Column | None = None) -> Column:
    far = F.char_length(F.regexp_replace(t, "[\\x20-\\xFF]", "")) / F.greatest(F.char_length(t), F.lit(1))
    out = t.rlike(FURNITURE) | t.rlike("[\\x00-\\x08\\x0E-\\x1F]") | ((F.char_length(t) >= 8) & (far > 0.25))
    if y0 is not None:
        out = out | (y0 > 760)
    return out | (F.trim(t) == page.cast("string")) if page is not None else out


def is_cover_page(t: Column) -> Column:
    low = F.lower(t)
    return low.contains("list of formulas") | (low.contains("instructions") & low.contains("answer all questions"))


def is_visual(t: Column) -> Column:
    return F.coalesce(t.rlike(VISUAL), F.lit(False))


def root_allowed(parts: Column) -> Column:
    return F.coalesce(F.get(parts, F.lit(0)).try_cast("int") <= 50, F.lit(True))


def wrong_deep_terminal(parts: Column, t: Column) -> Column:
    """The least other (letter) in the first 420 characters behind the label of a row four or more parts deep that ends in a letter."""
    rest = labels.remainder(t)
    probe = F.substring(F.when(rest != "", rest).otherwise(t), 1, 420)
    found = F.regexp_extract_all(F.lower(probe), F.lit(r"(?<![a-z0-9])\(\s*([a-z])\s*\)"), F.lit(1))
    other = F.array_min(F.filter(found, lambda x: x != F.element_at(parts, -1)))
    return F.when((F.size(parts) >= 4) & labels.is_letter(F.element_at(parts, -1)), other)


#: What a local skeleton writes, and words that speak of a picture or of its labels.
SKELETON = "local qp skeleton created"
PICTURE = "diagram shows|not to scale|graph|grid|table shows|cumulative frequency|histogram|venn diagram|pie chart|triangle|quadrilateral|circle|sector"
PICTURE_LABELS = " scale |not to scale| north |angle |°"
NOISE = 0.42


def repair_candidate(parts: Column, t: Column, review: Column, urls: Column, warnings: Column) -> Column:
    """Rows below a root that a skeleton made, or that are to be reviewed and speak of a picture they lack, or whose text is polluted."""
    low = F.trim(F.regexp_replace(F.lower(t), r"\s+", " "))
    bare = F.size(urls) == 0
    poor = (bare & low.rlike(PICTURE)) | (bare & low.rlike(PICTURE_LABELS) & (F.char_length(t) > 80)) | (text.math_noise(t) >= NOISE) | low.rlike(r"\b\d+\([a-z]\).*\b\d+\([a-z]\)")
    return (F.size(parts) >= 2) & (F.exists(warnings, lambda w: F.lower(w).contains(SKELETON)) | (review & poor))


def valid_repair(t: Column) -> Column:
    """Behind its label a text of at most 1800 characters, no blank page; under 6 it must hold a letter or digit."""
    body = F.trim(F.regexp_replace(labels.remainder(t), r"\s+", " "))
    return (body != "") & ~F.lower(body).contains("blank page") & (F.char_length(body) <= 1800) & ((F.char_length(body) >= 6) | body.rlike("[A-Za-z0-9→⃗]"))


def ms_continuation(marks: Column, t: Column) -> Column:
    """At most one mark, 1..220 characters, accuracy codes only; without codes at most 120 characters."""
    codes = text.mark_codes(t)
    return (marks <= 1) & F.char_length(t).between(1, 220) & F.when(F.size(codes) == 0, F.char_length(t) <= 120).otherwise(F.forall(codes, lambda c: c.rlike("^(?:A|B)\\d+$|^(?:oe|cao|isw|nfww|FT)$")))


def contaminated_tail(t: Column) -> Column:
    return F.substring(t, 1, 260).rlike(r"(?i)\[\d{1,2}\]|\.{6,}|\b(?:find|calculate|show that|write down|work out|solve|explain)\b")


#: The least width, height and variance of a crop, what is white, how many of so many sampled pixels a side are not.
CROP_SIZE, CROP_VARIANCE, WHITE, CROP_GRID, CROP_PIXELS = (60, 40), 18.0, 245, 80, 35


@F.pandas_udf(T.BooleanType())
def crop_has_content(pixels: pd.Series, width: pd.Series, height: pd.Series) -> pd.Series:
    """Whether a crop of grey pixels, a byte each, is large and varied enough; one that can't be read passes."""

    def one(raw: bytes | None, w: int, h: int) -> bool:
        if raw is None or w * h != len(raw) or not raw:
            return True
        grey = np.frombuffer(raw, np.uint8).reshape(int(h), int(w))
        if w < CROP_SIZE[0] or h < CROP_SIZE[1] or grey.var() < CROP_VARIANCE:
            return False
        at = lambda n: np.arange(CROP_GRID) * int(n) // CROP_GRID
        return int((grey[np.ix_(at(h), at(w))] < WHITE).sum()) >= CROP_PIXELS

    return pd.Series([one(p, w, h) for p, w, h in zip(pixels, width, height, strict=True)])


#: Edges of a grid's cells grow by GROWTH a level, up to TOP levels.
GROWTH, TOP = 4, 8


def celled(left: DataFrame, right: DataFrame, grid: float) -> tuple[DataFrame, DataFrame]:
    """Rectangles (x0, y0, x1, y1) of left and right (d_x0, d_y0, d_x1, d_y1) by the cells (__level, __x, __y) in which those that may overlap meet.

    A rectangle has a level for its width and one for its height: that whose cells are half to twice as long, so it touches at most three of them a way.
    Two meet in cells as wide as the wider one's level and as high as the higher one's, so long thin ones meet what is near them only, and a page of many
    rectangles is dealt to many tasks.  Rectangles are dealt to the levels alone that the other side has.  __first_x and __first_y (__d_first_x, __d_first_y)
    tell of a rectangle's first cell either way."""

    def level(low: Column, high: Column) -> Column:
        return F.least(F.lit(TOP), F.greatest(F.lit(0), F.floor(F.log(float(GROWTH), (high - low) / grid) + 0.5))).cast("int")

    def sized(df: DataFrame, name: str) -> DataFrame:
        x0, y0, x1, y1 = (F.col(f"{name}{c}") for c in ("x0", "y0", "x1", "y1"))
        return df.where((x1 > x0) & (y1 > y0)).withColumn("__own", F.struct(level(x0, x1).alias("x"), level(y0, y1).alias("y")))

    def dealt(df: DataFrame, others: DataFrame, name: str) -> DataFrame:
        # Which side is the longer one is part of the level; the left one is where both are alike.
        ours, own = name == "", F.col("__own")
        longer = lambda c, o: own[c] >= o[c] if ours else own[c] > o[c]
        met = lambda o: F.struct(*(F.greatest(own[c], o[c]).alias(c) for c in "xy"), *((longer(c, o) == F.lit(ours)).alias(f"left_{c}") for c in "xy"))
        df = df.withColumn("__theirs", others.agg(F.collect_set("__own")).scalar())
        df = df.withColumn("__at", F.explode(F.array_distinct(F.transform("__theirs", met)))).drop("__own", "__theirs")
        for c in "xy":
            at = lambda e, c=c: F.floor(F.col(f"{name}{c}{e}") / (grid * F.pow(F.lit(float(GROWTH)), F.col("__at")[c])))
            df = df.withColumn(f"__{c}", F.explode(F.sequence(at(0), at(1)))).withColumn(f"__{name}first_{c}", F.col(f"__{c}") == at(0))
        at = F.col("__at")
        code = (at["x"] * (TOP + 1) + at["y"]) * 4 + at["left_x"].cast("int") * 2 + at["left_y"].cast("int")
        return df.withColumn("__level", code).drop("__at")

    one, other = sized(left, ""), sized(right, "d_")
    return dealt(one, other, ""), dealt(other, one, "d_")


def overlaps(left: DataFrame, right: DataFrame, keys: list[str], grid: float = 32.0) -> DataFrame:
    """Pairs of rectangles (x0, y0, x1, y1) of left and right (d_x0, d_y0, d_x1, d_y1) with the same keys that overlap, with their area in common.

    They meet in cells (celled).  Of the cells that two share, the one with the lower corner of what they have in common gives the pair, so each is found once:
    it is the first one of either a way.  Rectangles without an area, or with a null edge, overlap nothing."""
    one, other = celled(left, right, grid)
    met = one.join(tables.shuffled(other), [*keys, "__level", "__x", "__y"])
    for c in "xy":
        met = met.where((F.col(f"{c}0") < F.col(f"d_{c}1")) & (F.col(f"d_{c}0") < F.col(f"{c}1")) & (F.col(f"__first_{c}") | F.col(f"__d_first_{c}")))
    side = lambda c: F.least(f"{c}1", f"d_{c}1") - F.greatest(f"{c}0", f"d_{c}0")
    return met.withColumn("common", side("x") * side("y")).drop("__level", *(f"__{k}{c}" for c in "xy" for k in ("", "first_", "d_first_")))


def covered_area(cells: DataFrame, drawings: DataFrame, least: float = 800.0, thin: float = 6.0) -> DataFrame:
    """Cells (page, cell, x0, y0, x1, y1) with the area of drawings (page, x0, y0, x1, y1) inside them, if over least."""
    d = drawings.where((F.col("x1") - F.col("x0") >= thin) & (F.col("y1") - F.col("y0") >= thin)).toDF(*[c if c == "page" else f"d_{c}" for c in drawings.columns])
    return overlaps(cells, d, ["page"]).groupBy("page", "cell").agg(F.sum("common").alias("area")).where(F.col("area") > least)



def accepted_rescues(rescued: DataFrame, missing: DataFrame, rows: DataFrame, deep: bool = False) -> DataFrame:
    """Rescued rows (paper, label, body, urls, warnings, needs_review) whose id is missing, that copy no sibling's task and are under
    four parts deep (unless deep); pictures are taken off and the row is to be reviewed."""
    from . import joins

    found = rescued.join(missing.select("paper", F.col("id").alias("label")).distinct(), ["paper", "label"], "left_semi")
    if not deep:
        found = found.where(F.size(F.split("label", r"\.")) < 4)
    copied = joins.copied_tasks(found, rows)
    found = found.join(copied.select("paper", "label").distinct(), ["paper", "label"], "left_anti")
    said = coerce.with_warning(F.col("warnings"), F.lit("pictures of a rescue are not copied"))
    return found.withColumns({"urls": F.array().cast("array<string>"), "warnings": said, "needs_review": F.lit(True)})


def repaired_rows(rows: DataFrame, proposals: DataFrame, least: float) -> DataFrame:
    """rows (row_id, parent, label, body) with the first accepted proposal (row_id, page_order, attempt, score, second_score, text) whose text is
    valid, else with the longest sibling's text in front of their own; source tells which: model, sibling or none."""
    from . import joins

    best = accepted_scores(proposals.where(valid_repair(F.col("text"))), least).select("row_id", F.col("text").alias("__text"))
    out = joins.siblings(rows, "row_id", "parent", "body").join(best, "row_id", "left")
    said = F.trim(F.coalesce("sibling_text", F.lit(""))) != ""
    beside = F.concat_ws(" ", labels.remainder(F.col("sibling_text")), F.col("body"))
    source = F.when(F.col("__text").isNotNull(), "model").when(said, "sibling").otherwise("none")
    return out.withColumns({"source": source, "body": F.coalesce("__text", F.when(said, beside), F.col("body"))}).select("row_id", "label", "body", "source")


def accepted_scores(proposals: DataFrame, least: float) -> DataFrame:
    """The first accepted proposal of each row: a second score stands in for a low first one."""
    from pyspark.sql import Window

    score = F.when(F.col("score") >= 0.9, F.col("score")).otherwise(F.coalesce("second_score", "score"))
    w = Window.partitionBy("row_id").orderBy("page_order", "attempt")
    return proposals.withColumn("final_score", score).where(F.col("final_score") >= least).withColumn("turn", F.row_number().over(w)).where("turn = 1").drop("turn")
