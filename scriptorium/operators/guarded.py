"""The guarded scan of labels as steps that compose, so that a paper of any size is no single stream.

A row either keeps the root that the scan has reached, or moves it to its own, and what it does to the letters and romans below the root is one of four
things: nothing, a constant, a tail behind what they are without a last roman, or a tail behind the first of them.  Both kinds compose to the same kinds, and
roots are at most MOST_ROOT, so what a run of rows does is a table of MOST_ROOT + 2 entries, whatever the run.  Chunks of rows (a page, or LINES lines
of one) are summed up to such tables side by side; the tables are composed as a tree, which gives each chunk the state that it begins with; then
each chunk is walked, side by side again.  A paper of no more rows than a chunk may have is walked as it is.

Rules for a row with a root, when the scan has one: a root over MOST_ROOT is a total of marks, and the row takes the scan's root; so does a root equal to
the printed page if it is neither the scan's nor the next, or is followed by anything but the letter a; a root that the page's hints expect is
taken, be it lower; a lower one is not, and the row takes the scan's; a bare root that leaps stays as it is, but does not move the scan.  A row
whose root was replaced does not move the scan.  The first root is taken as it is, but one over MOST_ROOT is rejected (the empty label).  A row without a
root joins the scan's: a roman the letters there, a letter the root; i, v and x go below the first letter, if there is one."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.labels import ROMANS
from ..sources.tables import cut

#: Fixed value: the highest number of a question.
MOST_ROOT = 50
#: Lines a chunk; pages are numbered in steps of LINE_BLOCKS chunks; tables of one paper that are composed in one stream; how many are summed up to one.
LINES, LINE_BLOCKS, MANY, FAN = 1000, 1 << 20, 4096, 256
_ROMAN = frozenset(ROMANS)

Effect = tuple[int | None, tuple[str, ...], str, tuple[str, ...]]  # root after, below it if nothing was, what happens to what was, its tail


def step(root: int | None, parts: list[str], printed: int | None, hinted: bool) -> tuple[int | None, str, tuple[str, ...], str]:
    """What a row does at a root: the root after it, what happens below, the tail, and what becomes of its label."""
    if not parts:
        return root, "same", (), "keep"
    if not parts[0].isdigit():
        if root is None:
            return root, "same", (), "keep"
        kind = "first" if parts[0] in ("i", "v", "x") else "behind" if parts[0] in _ROMAN else "new"
        return root, kind, tuple(parts), "join"
    own, tail = int(parts[0]), tuple(parts[1:])
    if own > MOST_ROOT:
        return root, "same", (), "reject" if root is None else "replace"
    if root is None:
        return own, "new", tail, "keep"
    if own == printed and own != root and (own != root + 1 or (tail and tail[0] != "a")):
        return root, "same", (), "replace"
    if hinted or own == root or own == root + 1 or (own > root and tail):
        return own, "new", tail, "keep"
    return root, "same", (), "keep" if own > root else "replace"


def below(kind: str, tail: tuple[str, ...], was: tuple[str, ...]) -> tuple[str, ...]:
    """Letters and romans after a row."""
    if kind == "same":
        return was
    if kind == "first":
        return was[:1] + tail
    if kind == "behind":
        return (was[:-1] if len(was) > 1 and was[-1] in _ROMAN else was) + tail
    return tail


def then(kind: str, tail: tuple[str, ...], after: str, more: tuple[str, ...]) -> tuple[str, tuple[str, ...]]:
    """Two things that happen below a root, one after the other, as one; for what is not empty before."""
    if kind == "new":
        return "new", below(after, more, tail)
    if after == "same" or kind == "same":
        return (kind, tail) if after == "same" else (after, more)
    if after == "behind":
        return kind, (tail[:-1] if tail[-1] in _ROMAN else tail) + more
    return after, more


#: What a run of rows does: the different effects, and which of them holds at each root (none first).  Most runs soon come to do one thing.
Table = tuple[list[Effect], list[int]]


def composed(table: Table, effect: Callable[[int | None], tuple[int | None, str, tuple[str, ...], tuple[str, ...] | None]]) -> Table:
    """A table after one more effect, given by the root: the root after, what happens below, its tail, and (None: by those) what becomes of nothing."""
    kinds, at = table
    new = []
    for root, empty, kind, tail in kinds:
        after, k, t, from_empty = effect(root)
        at_nothing = below(k, t, ()) if from_empty is None else from_empty
        new_empty = below(k, t, empty) if empty else at_nothing
        new.append((after, new_empty, *(("new", at_nothing) if (kind, tail) == ("new", ()) else then(kind, tail, k, t))))
    if len(new) > 1:
        place = {x: k for k, x in enumerate(dict.fromkeys(new))}
        if len(place) < len(new):
            moved = [place[x] for x in new]
            new, at = list(place), [moved[k] for k in at]
    return new, at


def identity() -> Table:
    return [(root, (), "same", ()) for root in (None, *range(MOST_ROOT + 1))], list(range(MOST_ROOT + 2))


def _at(root: int | None) -> int:
    return 0 if root is None else root + 1


def effect_at(table: Table, root: int | None) -> Effect:
    return table[0][table[1][_at(root)]]


def joined(first: Table, second: Table) -> Table:
    """What two runs of rows do, one after the other."""

    def effect(root: int | None) -> tuple[int | None, str, tuple[str, ...], tuple[str, ...]]:
        after, empty, kind, tail = effect_at(second, root)
        return after, kind, tail, empty

    return composed(first, effect)


def _dumped(table: Table) -> str:
    return json.dumps(table if len(table[0]) > 1 else [table[0], []])


def _loaded(raw: str) -> Table:
    kinds, at = json.loads(raw)
    return [(root, tuple(empty), kind, tuple(tail)) for root, empty, kind, tail in kinds], at or [0] * (MOST_ROOT + 2)


def _entered(table: Table, root: int | None, was: tuple[str, ...]) -> tuple[int | None, tuple[str, ...]]:
    after, empty, kind, tail = effect_at(table, root)
    return after, below(kind, tail, was) if was else empty


def _runs(batches: Iterable[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, bool, list]]:
    """Rows of sorted batches: the first `keys` values, whether they are new, and the other values."""
    last: object = None
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            key = row[:keys]
            yield key, key != last, row[keys:]
            last = key


def _streamed(df: DataFrame, keys: list[str], order: list[str], run: Callable, schema: str) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = 10_000) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held), schema)], schema=schema)


_SUMMARY = pa.schema([("paper", pa.string()), ("at", pa.int64()), ("does", pa.string())])
_STATE = pa.schema([("paper", pa.string()), ("at", pa.int64()), ("root", pa.int32()), ("was", pa.list_(pa.string()))])


def _summaries(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            table, last = None, None
            for key, new, (parts, printed, hinted) in _runs(batches, 2):
                if new:
                    if table is not None:
                        yield (*last, _dumped(table))
                    table, last = identity(), key
                table = composed(table, lambda root: (*step(root, parts, printed, hinted)[:3], None))  # noqa: B023
            if table is not None:
                yield (*last, _dumped(table))

        yield from _batches(found(), _SUMMARY)

    wanted = rows.select("paper", "at", "parts", "printed", "hinted", "line")
    return _streamed(wanted, ["paper", "at"], ["line"], lambda b: run(x.select(["paper", "at", "parts", "printed", "hinted"]) for x in b), "paper string, at long, does string")


def _summed(tables: DataFrame) -> DataFrame:
    """Tables of FAN places each, composed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            table, last = None, None
            for key, new, (_, does) in _runs(batches, 2):
                if new:
                    if table is not None:
                        yield (*last, _dumped(table))
                    table, last = _loaded(does), key
                else:
                    table = joined(table, _loaded(does))
            if table is not None:
                yield (*last, _dumped(table))

        yield from _batches(found(), _SUMMARY)

    up = tables.select("paper", F.shiftright("at", 8).alias("up"), "at", "does")
    return _streamed(up, ["paper", "up"], ["at"], run, "paper string, at long, does string")


def _entering(tables: DataFrame, many: int) -> DataFrame:
    """The state in which each place of a paper is entered."""
    tables = cut(tables)
    most = tables.groupBy("paper").count().agg(F.max("count")).first()[0] or 0
    if most <= many:
        begun = tables.select("paper", F.lit(0).cast("long").alias("up"), "at", "does", F.lit(None).cast("int").alias("root"), F.array().cast("array<string>").alias("was"))
    else:
        above = _entering(_summed(tables), many).withColumnRenamed("at", "up")
        begun = tables.withColumn("up", F.shiftright("at", 8)).join(above, ["paper", "up"]).select("paper", "up", "at", "does", "root", "was")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            root, was = None, ()
            for key, new, (at, does, first, under) in _runs(batches, 2):
                if new:
                    root, was = first, tuple(under)
                yield key[0], at, root, list(was)
                root, was = _entered(_loaded(does), root, was)

        yield from _batches(found(), _STATE)

    return _streamed(begun, ["paper", "up"], ["at"], run, "paper string, at long, root int, was array<string>")


def guarded(rows: DataFrame, paper: str, page: str, line: str, parts: str, printed: str, hinted: str, many: int = MANY, lines: int = LINES) -> DataFrame:
    """paper, page, line, label, change of each row: page and line (whole numbers from 0, line unique in its page) order a paper's rows, parts is the
    label's, printed the page's number in print, hinted whether the page's hints expect the root.  change is keep, join, replace or reject.

    A null paper is a paper; null parts are no label (kept); a null printed page is no page; a null hint is none; equal lines of a page are taken in
    any order.  Only keys and labels go through the passes, no texts.  A paper of at most `lines` rows is one chunk, entered with nothing, and needs no tables."""
    block = F.least(F.floor(F.col(line) / lines), F.lit(LINE_BLOCKS - 1))
    key = F.when(F.col(paper).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(paper).cast("string")))
    taken = rows.select(key.alias("paper"), (F.col(page).cast("long") * LINE_BLOCKS + block).alias("at"), F.col(page).cast("long").alias("page"), F.col(line).cast("long").alias("line"),
                        F.coalesce(F.col(parts), F.array().cast("array<string>")).alias("parts"), F.col(printed).cast("int").alias("printed"), F.coalesce(F.col(hinted), F.lit(False)).alias("hinted"))
    schema = pa.schema([("paper", pa.string()), ("page", pa.int64()), ("line", pa.int64()), ("label", pa.string()), ("change", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            root, was = None, ()
            for key, new, (line_, page_, parts_, printed_, hinted_, *entered) in _runs(batches, 2):
                if new:
                    root, was = (entered[0], tuple(entered[1])) if entered else (None, ())
                after, kind, tail, change = step(root, parts_, printed_, hinted_)
                was = below(kind, tail, was)
                label = parts_ if change == "keep" else [str(root), *was] if change == "join" else [str(root), *parts_[1:]] if change == "replace" else []
                root = after
                yield key[0], page_, line_, ".".join(label), change

        yield from _batches(found(), schema)

    columns, walks = ["line", "page", "parts", "printed", "hinted"], "paper string, page long, line long, label string, change string"
    large = cut(taken.groupBy("paper").count().where(F.col("count") > lines).select("paper"))  # one in so many rows at most
    if large.isEmpty():
        whole, rest = taken, None
    else:
        whole, rest = taken.join(large, "paper", "left_anti"), cut(taken.join(large, "paper", "left_semi"))
    out = _streamed(whole.select("paper", F.lit(0).alias("at"), *columns), ["paper"], ["page", "line"], run, walks)
    if rest is not None:
        walked = rest.join(_entering(_summaries(rest), many), ["paper", "at"]).select("paper", "at", *columns, "root", "was")
        out = out.unionByName(_streamed(walked, ["paper", "at"], ["line"], run, walks))
    return out.select(F.when(F.col("paper") != "", F.substring("paper", 2, 1 << 30)).cast(rows.schema[paper].dataType).alias(paper), F.col("page").alias(page), F.col("line").alias(line), "label", "change")
