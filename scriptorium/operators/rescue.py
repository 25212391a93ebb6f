"""Missing ids found again: rows split from page texts in rounds until no more is found, and grouped scheme entries as a row for each leaf."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import labels
from ..sources import tables

#: How much text a split row needs; the parts from which a label's end alone is looked for behind its ancestors' label.
LEAST_TEXT, DEEP = 8, 4
#: A label, with or without a number before it; what is called like f(x) is none.
_LABEL = r"(?:\b\d{1,2}\s*\(\s*(?:[a-z]|[ivxlcdm]+)\s*\)|(?<![A-Za-z0-9])\(\s*(?:[a-z]|[ivxlcdm]+)\s*\)(?![A-Za-z0-9]))"


def _shown(p: Column) -> Column:
    """A pattern of a label as it is printed, with any spacing."""
    return F.concat(F.lit(r"\b"), F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x: F.concat(F.lit(r"\s*\(\s*"), x, F.lit(r"\s*\)"))), ""))


def _root(c: str) -> Column:
    return F.get(F.split(c, r"\."), F.lit(0)).alias("root")


def page_segments(missing: DataFrame, pages: DataFrame) -> DataFrame:
    """paper, root, id, body: for missing ids (paper, root, ids: of two parts or more, by the number they begin with) what stands between their label and the
    next one on the first page (paper, page, page_text) where that is LEAST_TEXT characters at least.  Pages and ids meet on the numbers that a page has
    before a bracket, not on the paper alone; a page goes there once a number, whatever ids there are."""
    numbers = F.array_distinct(F.regexp_extract_all("page_text", F.lit(r"\b(\d{1,2})\s*\("), F.lit(1)))
    met = missing.join(tables.shuffled(pages.select("paper", "page", "page_text", F.explode(numbers).alias("root"))), ["paper", "root"])
    met = met.withColumn("__squeezed", F.regexp_replace(F.lower("page_text"), r"\s+", "")).withColumn("id", F.explode("ids")).withColumn("p", F.split("id", r"\."))
    # Patterns are tried where a page has the label, or the label above a deep one, whatever is around it.
    printed = lambda p: F.concat(F.get(p, F.lit(0)), F.array_join(F.transform(F.slice(p, F.lit(2), F.size(p)), lambda x: F.concat(F.lit("("), F.lower(x), F.lit(")"))), ""))
    met = met.where(F.contains(F.col("__squeezed"), printed(F.when(F.size("p") >= DEEP, F.slice("p", F.lit(1), F.size("p") - 1)).otherwise(F.col("p")))))
    above = F.slice("p", F.lit(1), F.size("p") - 1)
    end = F.concat(F.lit(r"(?<![A-Za-z0-9])\(\s*"), F.element_at("p", -1), F.lit(r"\s*\)(?![A-Za-z0-9])"))
    behind = rf"\s*(.*?)\s*(?={_LABEL}|\z)"
    met = met.withColumns({"__own": F.concat(F.lit("(?is)"), _shown(F.col("p")), F.lit(behind)), "__end": F.concat(F.lit("(?is)"), _shown(above), F.lit(".*?"), end, F.lit(behind))})
    tidy = lambda pattern: F.regexp_replace(F.expr(f"regexp_extract(page_text, {pattern}, 1)"), r"\s+", " ")
    # Each pattern is tried once: columns that are used twice are not computed again, and no filter on them is put before them.
    met = met.withColumn("own", tidy("__own")).withColumn("deep", F.when((F.size("p") >= DEEP) & (F.length("own") < LEAST_TEXT), tidy("__end")))
    met = met.withColumn("body", F.when(F.length("own") >= LEAST_TEXT, F.col("own")).when(F.length("deep") >= LEAST_TEXT, F.col("deep")))
    first = F.min(F.when(F.col("body").isNotNull(), F.struct(F.col("page").isNull().alias("unnumbered"), "page", "body")))
    return met.groupBy("paper", "root", "id").agg(first.alias("x")).where("x IS NOT NULL").select("paper", "root", "id", "x.body")


def in_rounds(held: list[str], ids: list[str], most_rounds: int) -> list[dict]:
    """For ids that rows with the labels held, in their order, lead to: n (place in ids), the round, what the id was split from, one row from the other, and at
    (place in held) of the first of them.  The row to split is the first sibling in order, else the parent, else the grandparent, of the rows before the round."""
    rows: dict[str, tuple[int, list[str]]] = {}
    first: dict[str, tuple[int, str]] = {}

    def add(label: str, at: int, sources: list[str]) -> None:
        rows[label] = at, sources
        parent = label.rpartition(".")[0]
        first[parent] = min(first.get(parent, (at, label)), (at, label))

    for at, label in enumerate(held):
        if label not in rows:
            add(label, at, [])
    out, left = [], [n for n, x in enumerate(ids) if x not in rows]
    for k in range(1, most_rounds + 1):
        new, rest = [], []
        for n in left:
            up = ids[n].rpartition(".")[0]
            above = up.rpartition(".")[0]
            source = "" if not up else first[up][1] if up in first else up if up in rows else above if above in rows else ""
            (new if source else rest).append((n, source))
        if not new:
            break
        for n, source in new:
            at, before = rows[source]
            out.append({"n": n, "round": k, "at": at, "sources": [*before, source]})
        for made in out[-len(new) :]:
            add(ids[made["n"]], made["at"], made["sources"])
        left = [n for n, _ in rest]
    return out


def split_rows(rows: DataFrame, missing: DataFrame, pages: DataFrame, most_rounds: int = 1) -> DataFrame:
    """New rows (as rows: paper, seq, label, body, urls, warnings, needs_review; and round) for missing ids (paper, id) that a sibling, parent or grandparent row
    may hold and a page shows: with the page's text, without pictures, after their source, to be reviewed.

    A row made in one round can be the source of the next round's.  A source has its id's number, so ids, labels and pages are brought together by paper and
    number once, and all rounds are run there on ids and labels alone; a text is cut from its page before, whatever round it is for."""
    on = ["paper", "root"]
    labelled = rows.where("label IS NOT NULL").select("paper", _root("label"), "seq", "label", "warnings")
    known = labelled.groupBy(on).agg(F.collect_set("label").alias("known"))
    wanted = missing.select("paper", _root("id"), "id").where(F.col("root").rlike(r"^\d{1,2}$") & F.contains("id", F.lit(".")))
    wanted = wanted.groupBy(on).agg(F.collect_set("id").alias("ids")).join(tables.shuffled(known), on).select(*on, F.array_except("ids", "known").alias("ids"))
    texts = page_segments(wanted, pages).groupBy(on).agg(F.collect_list(F.struct("id", "body")).alias("texts"))
    # Of a label the first row counts, of equal places any: the least.
    held = labelled.repartition(*on).groupBy(*on, "label").agg(F.min(F.struct("seq", "warnings")).alias("x"))
    held = held.groupBy(on).agg(F.sort_array(F.collect_list(F.struct("x.seq", "label", "x.warnings"))).alias("held"))
    kind = pa.list_(pa.struct([("n", pa.int32()), ("round", pa.int32()), ("at", pa.int32()), ("sources", pa.list_(pa.string()))]))

    @F.arrow_udf("array<struct<n: int, round: int, at: int, sources: array<string>>>")
    def made(held: pa.Array, ids: pa.Array) -> pa.Array:
        return pa.array([in_rounds(a, b, most_rounds) for a, b in zip(held.to_pylist(), ids.to_pylist(), strict=True)], kind)

    found = texts.join(tables.shuffled(held), on).withColumn("x", F.explode(made(F.col("held.label"), F.col("texts.id"))))
    found = found.select("paper", "x", F.get("held", F.col("x.at")).alias("row"), F.get("texts", F.col("x.n")).alias("text"))
    said = F.transform("x.sources", lambda s: F.concat(F.lit("split from "), s, F.lit(" with page text")))
    return found.select(
        "paper", "row.seq", F.col("text.id").alias("label"), F.concat_ws(" ", labels.shown(F.split("text.id", r"\.")), "text.body").alias("body"), F.array().cast("array<string>").alias("urls"),
        F.array_union(F.coalesce("row.warnings", F.array().cast("array<string>")), said).alias("warnings"), F.lit(True).alias("needs_review"), "x.round")


def rescued(rows: DataFrame, expected: DataFrame, pages: DataFrame, most_rounds: int = 10) -> DataFrame:
    """rows with round (0 for those given): rows for expected ids (paper, id) that are missing, split from pages, in rounds.

    It ends when a round finds no more, or after most_rounds.  Repeated expected ids count once; null ids are none."""
    columns = ["paper", "seq", "label", "body", "urls", "warnings", "needs_review"]
    return rows.select(*columns, F.lit(0).alias("round")).unionByName(split_rows(rows, expected, pages, most_rounds))


#: Fixed value: markers of a group's leaves.
_ROMAN_MARKER = r"\(\s*(x|ix|iv|v?i{1,3}|v)\s*\)"


def group_leaves(rows: DataFrame, label: str, text: str, warnings: str) -> DataFrame:
    """rows with leaf (0 where the row stays as it is): a row of two parts whose text has two roman markers or more becomes a row for each of them, in
    order, with what follows the marker up to the next one that is new; a marker met again is text.  Leaves are warned of.  Nulls stay as they are."""
    pieces = F.split(F.coalesce(F.col(text), F.lit("")), rf"(?i)(?<![A-Za-z0-9])(?={_ROMAN_MARKER})")
    marked = F.transform(pieces, lambda x: F.struct(F.lower(F.regexp_extract(x, rf"(?i)^{_ROMAN_MARKER}", 1)).alias("m"), x.alias("t")))
    none = F.array().cast("array<struct<m: string, t: string>>")
    open_ = lambda x: F.struct(x["m"].alias("m"), F.regexp_replace(x["t"], rf"(?i)^{_ROMAN_MARKER}", "").alias("t"))
    longer = lambda acc, x: F.concat(F.slice(acc, F.lit(1), F.size(acc) - 1), F.array(F.struct(F.element_at(acc, -1)["m"].alias("m"), F.concat(F.element_at(acc, -1)["t"], x["t"]).alias("t"))))
    step = lambda acc, x: F.when(x["m"] == "", F.when(F.size(acc) == 0, acc).otherwise(longer(acc, x))).when(F.exists(acc, lambda y: y["m"] == x["m"]), longer(acc, x)).otherwise(F.array_append(acc, open_(x)))
    found = rows.withColumn("__leaves", F.when(F.size(F.split(label, r"\.")) == 2, F.aggregate(marked, none, step)).otherwise(none))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("m"), F.lit(None).cast("string").alias("t")))
    many = F.size("__leaves") >= 2
    out = found.withColumn("__split", many).select("*", F.posexplode(F.when(many, F.col("__leaves")).otherwise(whole)).alias("__k", "__x"))
    said = F.concat(F.lit("expanded from "), F.col(label))
    part = F.regexp_replace("__x.t", r"^\s+|\s+$", "")
    return out.withColumns({
        "leaf": F.when(F.col("__split"), F.col("__k") + 1).otherwise(0),
        warnings: F.when(F.col("__split"), F.array_union(F.coalesce(warnings, F.array().cast("array<string>")), F.array(said))).otherwise(F.col(warnings)),
        text: F.when(F.col("__split") & (part != ""), part).otherwise(F.col(text)),
        label: F.when(F.col("__split"), F.concat_ws(".", label, "__x.m")).otherwise(F.col(label)),
    }).drop("__leaves", "__split", "__k", "__x")
