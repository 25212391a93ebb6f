"""Question rows from the lines of a paper's pages, by the ids that its marking scheme expects.

Noise, cover pages and reading order are column expressions and windows; which id a line begins is decided in order, as each decision
takes an id and moves the context; the lines of an id are then put together again as an aggregate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import labels, text
from ..sources import tables
from . import filters, sequence, sets

#: How far from the left a root, a label and an orphan may begin; lines of context that a row takes along.
ROOT_MARGIN, LABEL_MARGIN, ORPHAN_MARGIN, CONTEXT = 80, 140, 155, 8
_ROMANS = frozenset(labels.ROMANS)


def options(tokens: list[str], at: list[str]) -> list[list[str]]:
    """What an orphan's tokens may stand for in a context, the likeliest first."""
    if tokens[0].isalpha() and len(tokens[0]) == 1:
        found = ([at[:-1]] if len(at) >= 4 else []) + ([at] if len(at) >= 3 else []) + [at[:1]]
    elif tokens[0] in _ROMANS and len(at) >= 2:
        found = [at[:-1], at]
    else:
        found = [at]
    return [[*f, *tokens] for f in found]


class Scan:
    """For each line the id it belongs to and its text there; context lines belong to none until a row takes them along.  The ids that are expected come
    with the first line; with later ones only if they change."""

    def __init__(self) -> None:
        self.want: list[str] = []
        self.known: set[str] = set()
        self.used: set[str] = set()
        self.id = ""
        self.at: list[str] = []
        self.root: list[str] = []
        self.context: list[str] = []

    def free(self, label: str, expected: list[str]) -> bool:
        return label in expected and label not in self.used

    def by_token(self, token: str, expected: list[str]) -> str:
        """The token under the context or what is above it, else the first free id of the root that ends so, as deep if there is one."""
        deeper = [".".join([*self.at[:k], token]) for k in range(len(self.at), 0, -1)]
        others = [e for e in expected if e.split(".")[0] == self.at[0] and e.split(".")[-1] == token]
        return next((e for e in [*deeper, *sorted(others, key=lambda e: len(e.split(".")) != len(self.at))] if self.free(e, expected)), "")

    def begin(self, parts: list[str], line: str, is_row: bool) -> tuple[str, bool]:
        self.at, self.id = parts, ".".join(parts) if is_row else ""
        before = [] if len(parts) == 1 else self.context if is_row and ".".join(parts[:-1]) else self.root
        if len(parts) == 1:
            self.root = self.context = [line]
        elif not is_row:
            self.context = [*self.root, line][-CONTEXT:]
        if not is_row:
            return "\x1f", False
        self.used.add(self.id)
        return f"{self.id}\x1f{' '.join([*before, line])}", True

    def __call__(self, line: str, x0: float, own: str, tokens: Iterable[str] | None, tail: str, expected: Iterable[str] | None) -> tuple[str, bool]:
        if expected is not None:
            self.want = list(expected)
            self.known = {".".join(e.split(".")[: k + 1]) for e in self.want for k in range(len(e.split(".")))}
        want, known = self.want, self.known
        if own and own in known and x0 <= (ROOT_MARGIN if "." not in own else LABEL_MARGIN) and (own not in want or own not in self.used):
            return self.begin(own.split("."), line, own in want)
        wrapped = list(tokens) if tokens is not None else []
        if wrapped and self.at and x0 <= ORPHAN_MARGIN:
            found = options(wrapped, self.at)
            pick = next((o for o in found if self.free(".".join(o), want)), None) or next((o for o in found if ".".join(o) in known and ".".join(o) not in want), None)
            if pick is None and (other := self.by_token(wrapped[-1], want)):
                pick = other.split(".")
            if pick is not None:
                shown = pick[0] + "".join(f"({p})" for p in pick[1:])
                return self.begin(pick, f"{shown} {tail}".strip(), ".".join(pick) in want)
        if self.id:
            return f"{self.id}\x1f{line}", False
        if self.at:
            self.context = [*self.context, line][-CONTEXT:]
            if len(self.at) == 1:
                self.root = self.context
        return "\x1f", False


def skeleton(lines: DataFrame, expected: DataFrame) -> DataFrame:
    """lines (paper, page, line_no, x0, y0, line) and expected (paper, pos, id) -> paper, pos, id, body: a row for each id that the lines show."""
    pages = lines.groupBy("paper", "page").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), " ").alias("__text"))
    shown = lines.join(tables.shuffled(pages.where(~filters.is_cover_page(F.col("__text"))).select("paper", "page")), ["paper", "page"], "left_semi")
    line = F.trim(F.regexp_replace("line", r"\s+", " "))
    shown = shown.withColumn("line", line).where(~filters.is_noise_line(F.col("line"), F.col("y0"), F.col("page") + 1) & (F.col("line") != ""))
    ordered = sets.reading_order(shown, ["paper"], ["page", "y0", "x0", "line_no"]).withColumn("parts", labels.parts(F.col("line")))
    tokens = labels.orphan_tokens(F.col("line"))
    tail = F.trim(F.regexp_replace("line", r"^(?:\s*\(\s*[A-Za-z]+\s*\)){1,5}", ""))
    lists = expected.groupBy("paper").agg(F.array_sort(F.collect_list(F.struct("pos", "id"))).alias("listed"))
    ids = F.transform("listed", lambda x: x["id"])
    # A paper's list goes to its first line, not to each, and comes to the rows that were found, not through the scan.
    ready = ordered.join(tables.shuffled(lists), "paper").select("paper", "place", "line", "x0", F.when(labels.is_orphaned(F.col("parts")), "").otherwise(labels.canonical(F.col("parts"))).alias("own"), tokens.alias("tokens"), tail.alias("tail"), F.when(F.col("place") == 1, ids).alias("expected"))
    scanned = sequence.ordered_pass(ready, "paper", ["place"], ["line", "x0", "own", "tokens", "tail", "expected"], Scan, kept=["paper", "place"])
    part = F.split("new_label", "\x1f")
    rows = scanned.select("paper", "place", F.get(part, F.lit(0)).alias("id"), F.get(part, F.lit(1)).alias("line")).where("id <> ''")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("place", "line"))), lambda x: x["line"]), " ")
    found = rows.repartition("paper").groupBy("paper", "id").agg(joined.alias("body")).join(tables.shuffled(lists), "paper")
    pos = F.array_min(F.transform(F.filter("listed", lambda x: x["id"] == F.col("id")), lambda x: x["pos"]))
    return found.select("paper", pos.alias("pos"), "id", text.trimmed_siblings(F.col("body"), F.col("id"), ids).alias("body"))


def page_roots(lines: DataFrame, expected: DataFrame, keep: int = 24) -> DataFrame:
    """paper, page, root, ids: the root that a page's first lines show, else the last one before, and the first expected ids of that root."""
    p = labels.parts(F.col("line"))
    own = F.when((F.col("line_no") < 120) & (F.col("x0") <= ROOT_MARGIN) & ~labels.is_orphaned(p), F.get(p, F.lit(0)))
    roots = expected.select("paper", F.substring_index("id", ".", 1).alias("__root")).distinct()
    heads = lines.withColumn("__root", own).join(tables.shuffled(roots), ["paper", "__root"], "left_semi").groupBy("paper", "page").agg(F.min_by("__root", F.struct("y0", "x0", "line_no")).alias("own"))
    pages = lines.select("paper", "page").distinct().join(tables.shuffled(heads), ["paper", "page"], "left")
    w = Window.partitionBy("paper").orderBy("page").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = pages.withColumn("root", F.last("own", ignorenulls=True).over(w)).where("root is not null").drop("own")
    ids = expected.groupBy("paper", F.substring_index("id", ".", 1).alias("root")).agg(F.slice(F.transform(F.array_sort(F.collect_list(F.struct("pos", "id"))), lambda x: x["id"]), 1, keep).alias("ids"))
    return carried.join(tables.shuffled(ids), ["paper", "root"], "left").select("paper", "page", "root", "ids")
