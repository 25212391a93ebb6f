"""Question rows brought in line with the ids that the marking scheme expects.

Rows of a paper (tens of rows) are decided in order, as each decision takes an id; papers are hashed to
partitions, and a partition is read as a stream that holds one paper at a time.  Labels are taken off texts, and put
back, by column expressions; the pass itself only moves ids, texts and links."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from ..functions import labels
from ..sources import tables

#: X alone is a letter here; what a guard wrote that the scheme may settle; how much of a text counts.
ROMANS = frozenset(labels.ROMANS) - {"x"}
SETTLED = ("QP embedded subpart guard promoted ", "QP embedded subpart guard corrected ")
MARKER_REACH, STEM_REACH = 900, 80


def _letter(part: str) -> bool:
    return len(part) == 1 and part.isalpha()


class Tree:
    """Expected ids in order; what lies between them and their roots; the letters under each root."""

    def __init__(self, expected: list[str]) -> None:
        self.leaves = [tuple(e.split(".")) for e in dict.fromkeys(expected)]
        self.known = {leaf[:k] for leaf in self.leaves for k in range(2, len(leaf) + 1)} | set(self.leaves)
        self.letters: dict[str, list[str]] = {}
        for leaf in self.leaves:
            if len(leaf) > 1 and _letter(leaf[1]) and leaf[1] not in self.letters.setdefault(leaf[0], []):
                self.letters[leaf[0]].append(leaf[1])
        self.parents = {leaf[0] for leaf in self.leaves if len(leaf) > 1}

    def covers(self, parts: tuple[str, ...]) -> bool:
        """The id or anything above it is known."""
        return any(parts[:k] in self.known for k in range(1, len(parts) + 1))


@dataclass
class Row:
    at: int  # place in the input
    parts: tuple[str, ...]
    rest: str  # the text without its label
    urls: list[str]
    warnings: list[str]
    review: bool
    stem: str = ""  # comes between label and rest
    moved: bool = field(default=False)

    def move(self, parts: tuple[str, ...], tree: Tree) -> None:
        self.parts, self.moved = parts, True
        if tree.covers(parts):
            self.settle(always=True)

    def settle(self, always: bool = False) -> None:
        kept = [w for w in self.warnings if not w.startswith(SETTLED)]
        if always or len(kept) < len(self.warnings):
            self.warnings = kept
            self.review = self.review and bool(kept)


def _squeezed(text: str) -> str:
    return " ".join(text.lower().split())


def _settle_roots(rows: list[Row], tree: Tree) -> list[Row]:
    """A root row that is not expected itself becomes its one visible free child, or lends its text to the first child."""
    ids = {r.parts for r in rows}
    out, stems = [], {}
    for row in rows:
        root = row.parts[0] if len(row.parts) == 1 else ""
        if not root.isdigit() or row.parts in tree.leaves or root not in tree.parents:
            out.append(row)
            continue
        seen = [x for x in tree.letters.get(root, []) if (root, x) not in ids and re.search(rf"\(\s*{x}\s*\)", row.rest[:MARKER_REACH], re.IGNORECASE)]
        if len(seen) == 1:
            row.move((root, seen[0]), tree)
            out.append(row)
        elif any(len(r.parts) > 1 and r.parts[0] == root for r in rows):
            if row.rest.strip():
                stems[root] = row
        else:
            out.append(row)
    for row in out:
        stem = stems.pop(row.parts[0], None) if len(row.parts) > 1 else None
        if stem:
            if _squeezed(stem.rest) and _squeezed(stem.rest)[:STEM_REACH] not in _squeezed(row.rest):
                row.stem = stem.rest
            row.urls = list(dict.fromkeys([*row.urls, *stem.urls])) if stem.urls else row.urls
    return out


def _put_letters_back(rows: list[Row], tree: Tree) -> None:
    """A roman straight under a root gets the letter that it lost: the one that makes it an expected id, else the only letter that
    no row has, else the current one, else the only one; never an id that a row before it has taken."""
    ids, used, current = {r.parts for r in rows}, set(), {}
    for row in rows:
        if len(row.parts) > 1 and _letter(row.parts[1]):
            current[row.parts[0]] = row.parts[1]
        if len(row.parts) > 1 and row.parts[1] in ROMANS and row.parts not in tree.known:
            root, tail = row.parts[0], row.parts[1:]
            letters = tree.letters.get(root, [])
            tiers = (
                [x for x in letters if (root, x, *tail) in tree.leaves],
                [x for x in letters if (root, x) not in ids],
                [x for x in letters if x == current.get(root)],
                letters,
            )
            pick = next((t[0] for t in tiers if len(t) == 1), None)
            if pick and (root, pick, *tail) not in used:
                row.move((root, pick, *tail), tree)
        used.add(row.parts)


def decided(rows: list[Row], expected: list[str]) -> list[Row]:
    tree = Tree([e for e in expected if e])
    if not tree.leaves:
        return rows
    rows = _settle_roots(rows, tree)
    _put_letters_back(rows, tree)
    for row in rows:
        if tree.covers(row.parts):
            row.settle()
    return rows


SENT = 5000  # rows that are sent at once


def by_paper(df: DataFrame, paper: str, order: list[str], run: Callable[[list[dict]], list[dict]], schema: T.StructType) -> DataFrame:
    """run on each paper's rows in order; a null paper is a paper.  One paper is held at a time."""
    kind = to_arrow_schema(schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and held[0][paper] != row[paper]:
                    out += run(held)
                    held = []
                    if len(out) >= SENT:
                        yield pa.RecordBatch.from_pylist(out, schema=kind)
                        out = []
                held.append(row)
        if held:
            out += run(held)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return df.repartition(paper).sortWithinPartitions(paper, *order).mapInArrow(stream, schema)


def reconciled(rows: DataFrame, expected: DataFrame) -> DataFrame:
    """rows (paper, seq, label, body, urls, warnings, needs_review) against expected (paper, pos, id).

    Root rows with one visible letter are promoted, others give text and urls to their first child; lost letters are put
    back; texts of moved rows get the new label; guards' warnings go where the scheme confirms the id."""
    lists = expected.groupBy("paper").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]).alias("expected"))
    held = rows.select("paper", "seq", "label", "body", "urls", "warnings", "needs_review")
    joined = held.join(tables.shuffled(lists), "paper", "left").withColumn("expected", F.coalesce("expected", F.array().cast("array<string>")))
    joined = joined.withColumns({"rest": labels.remainder(F.col("body")), "span": F.trim(labels.span(F.col("body")))})
    schema = T.StructType([*held.schema.fields, T.StructField("rest", T.StringType()), T.StructField("span", T.StringType()), T.StructField("stem", T.StringType()), T.StructField("moved", T.BooleanType())])

    def run(paper: list[dict]) -> list[dict]:
        found = [Row(k, tuple(r["label"].split(".")), r["rest"] or "", r["urls"] or [], r["warnings"] or [], bool(r["needs_review"])) for k, r in enumerate(paper)]
        out = decided(found, paper[0]["expected"])
        return [paper[r.at] | {"label": ".".join(r.parts), "urls": r.urls, "warnings": r.warnings, "needs_review": r.review, "stem": r.stem, "moved": r.moved} for r in out]

    out = by_paper(joined, "paper", ["seq"], run, schema)
    visible = F.when(F.col("moved"), labels.shown(F.split("label", r"\."))).otherwise(F.col("span"))
    body = F.trim(F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in (visible, F.col("stem"), F.col("rest"))]))
    return out.withColumn("body", F.when(F.col("moved") | (F.col("stem") != ""), body).otherwise(F.col("body"))).select(*held.columns)


def split_hints(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """For each missing id (paper, id) the row whose text most likely holds it: its exact label within another
    row of the same parent (tier 1), else the nearest sibling before or after it (tier 2, at most two away)."""
    p = labels.parts(F.col("id"))
    want = missing.select("paper", "id", labels.immediate_parent(p).alias("parent"), labels.terminal_rank(F.element_at(p, -1)).alias("rank"), labels.shown(p).alias("shown"))
    q = labels.parts(F.col("label"))
    have = rows.select("paper", "seq", F.col("label").alias("source_id"), "body", labels.immediate_parent(q).alias("parent"), labels.terminal_rank(F.element_at(q, -1)).alias("source_rank"))
    met = want.join(tables.shuffled(have), ["paper", "parent"]).where("source_id <> id")
    squeezed = lambda c: F.regexp_replace(c, r"\s+", "")
    near = (F.col("rank.kind") == F.col("source_rank.kind")) & (F.abs(F.col("rank.rank") - F.col("source_rank.rank")) <= 2)
    met = met.withColumn("tier", F.when(F.contains(squeezed(F.col("body")), F.col("shown")), 1).when(near, 2)).where("tier is not null")
    w = Window.partitionBy("paper", "id").orderBy("tier", F.abs(F.col("rank.rank") - F.col("source_rank.rank")), "seq")
    return met.withColumn("n", F.row_number().over(w)).where("n = 1").select("paper", F.col("id").alias("missing_id"), "source_id", "tier")


def split_warnings(rows: DataFrame, hints: DataFrame) -> DataFrame:
    """rows with a warning for each id that a hint says they hold; the row is to be reviewed."""
    message = F.concat(F.lit("may also hold "), F.col("missing_id"))
    found = hints.groupBy("paper", F.col("source_id").alias("label")).agg(F.array_sort(F.collect_set(message)).alias("__said"))
    out = rows.join(tables.shuffled(found), ["paper", "label"], "left")
    said = F.coalesce("__said", F.array().cast("array<string>"))
    return out.withColumns({"warnings": F.array_union(F.coalesce("warnings", F.array().cast("array<string>")), said), "needs_review": F.coalesce("needs_review", F.lit(False)) | (F.size(said) > 0)}).drop("__said")


def rescue_sources(rows: DataFrame, missing: DataFrame) -> DataFrame:
    """For each missing id the row to split: its first sibling in order, else its parent, else its grandparent."""
    parts = F.split("id", r"\.")
    up = lambda k: F.array_join(F.slice(parts, F.lit(1), F.greatest(F.size(parts) - k, F.lit(0))), ".")
    tiers = [F.struct(F.lit(k).alias("tier"), up(max(k, 1)).alias("key"), F.lit(k == 0).alias("sibling")) for k in range(3)]
    want = missing.select("paper", "id", F.explode(F.filter(F.array(*tiers), lambda x: x["key"] != "")).alias("x")).select("paper", "id", "x.*")
    own = F.split("label", r"\.")
    above = F.array_join(F.slice(own, F.lit(1), F.greatest(F.size(own) - 1, F.lit(0))), ".")
    have = rows.select("paper", "seq", "label", F.explode(F.array(F.struct(F.lit(True).alias("sibling"), above.alias("key")), F.struct(F.lit(False).alias("sibling"), F.col("label").alias("key")))).alias("x")).select("paper", "seq", "label", "x.*").where("key <> ''")
    met = want.join(tables.shuffled(have), ["paper", "key", "sibling"]).where("label <> id")
    w = Window.partitionBy("paper", "id").orderBy("tier", "seq")
    return met.withColumn("n", F.row_number().over(w)).where("n = 1").select("paper", F.col("id").alias("missing_id"), F.col("label").alias("source_id"), F.element_at(F.array(F.lit("sibling"), F.lit("parent"), F.lit("grandparent")), F.col("tier") + 1).alias("kind"))
