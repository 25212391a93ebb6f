"""Chat formatting by minimum-cost role repair.

Legal conversations are those of an automaton over the last role: begin -> system | user, system -> user,
user -> assistant, assistant -> user; they end after a user or an assistant.  A turn is kept, relabelled, merged into the turn before it,
or preceded by one empty turn; each has a cost, and dynamic programming takes the cheapest sequence (ties: the
first in ACTIONS' order).  A turn is a 4 x 4 matrix of costs from state to state, and a conversation their
min-plus product, so a conversation is cut into chunks: CHUNK neighbouring turn numbers, and where they hold over FULL rows,
parts of one number by ranges of the hash that orders them.  Chunks are multiplied apart, FAN neighbouring products
again, and so on, as a tree; from its top the states between products are fixed downwards, and chunks are then repaired apart.
A conversation that holds a third of all rows is spread over as many tasks as it has chunks; only its chunks' numbers are counted
by one window, a narrow row for each.

Results are a row for each input turn; its ``rendered`` is that turn's part of the rendered conversation, so
that concatenation in order gives the whole, and no row grows with a conversation.

Defined results: roles are compared without case and outer spaces, through ALIASES; unknown and null roles are
relabelled at a low cost; a null text is empty; null turns come first; turns of one number are ordered by a hash of
role and text; a null conv_id is a conversation; a conversation of system turns alone ends with an empty user turn; repeated rows are turns
of their own, next to each other; very long texts pass through unchanged; an empty table gives an empty result; columns other than
conv_id, turn, role and text are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import maybe_broadcast, written

#: States: the last role, or none yet.
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
NAMES = (None, "system", "user", "assistant")
LEGAL = {(BEGIN, SYSTEM), (BEGIN, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
FINAL = (USER, ASSISTANT)
ALIASES = {"system": SYSTEM, "developer": SYSTEM, "user": USER, "human": USER, "prompter": USER, "assistant": ASSISTANT, "gpt": ASSISTANT, "bot": ASSISTANT, "model": ASSISTANT}
MERGE, INSERT, RELABEL, RELABEL_UNKNOWN = 1, 2, 3, 1
CHUNK = 64  # a power of two
FULL = 4 * CHUNK
FAN = 64
NEVER = 1 << 40
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"


class Step(NamedTuple):
    cost: int
    action: str
    inserted: int | None
    role: int  # the state after it


def _steps(role: int | None) -> list[list[Step | None]]:
    """The cheapest step of a turn with a role from each state to each state."""
    out: list[list[Step | None]] = [[None] * 4 for _ in range(4)]

    def offer(a: int, step: Step) -> None:
        old = out[a][step.role]
        if old is None or step.cost < old.cost:
            out[a][step.role] = step

    for a in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            relabel = 0 if to == role else RELABEL_UNKNOWN if role is None else RELABEL
            prefix = "" if not relabel else "relabel+"
            if (a, to) in LEGAL:
                offer(a, Step(relabel, "keep" if not relabel else "relabel", None, to))
            if a == to:
                offer(a, Step(relabel + MERGE, prefix + "merge", None, to))
            for between in (SYSTEM, USER, ASSISTANT):
                if (a, between) in LEGAL and (between, to) in LEGAL:
                    offer(a, Step(relabel + INSERT, prefix + "insert", between, to))
    return out


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def role_of(name: str | None) -> int | None:
    return ALIASES.get((name or "").strip().lower())


def matrix(roles: list[int | None]) -> list[int]:
    """Costs from each state to each state over some turns, row by row."""
    rows = []
    for a in range(4):
        best = [NEVER] * 4
        best[a] = 0
        for role in roles:
            steps = STEPS[role]
            best = [min([best[x] + steps[x][y].cost for x in range(4) if steps[x][y] and best[x] < NEVER], default=NEVER) for y in range(4)]
        rows += best
    return rows


def product(first: list[int], second: list[int]) -> list[int]:
    """Min-plus product of matrices given row by row."""
    return [min(NEVER, *(first[4 * a + x] + second[4 * x + y] for x in range(4))) for a in range(4) for y in range(4)]


def states(matrices: list[list[int]], enter: int = BEGIN, leave: int | None = None) -> list[int]:
    """The states before, between and after matrices on the cheapest way through all of them, to a state or to any."""
    best, back = [NEVER] * 4, []
    best[enter] = 0
    for m in matrices:
        ways = [[(best[x] + m[4 * x + y], x) for x in range(4)] for y in range(4)]
        back.append([min(w)[1] for w in ways])
        best = [min(NEVER, min(w)[0]) for w in ways]
    if leave is None:
        leave = min((best[s] + (0 if s in FINAL else INSERT), s) for s in range(4) if best[s] < NEVER)[1]
    path = [leave]
    for b in reversed(back):
        path.append(b[path[-1]])
    return path[::-1]


def repair(roles: list[int | None], enter: int, leave: int) -> list[Step]:
    """The cheapest steps from one state to another."""
    best, back = [NEVER] * 4, []
    best[enter] = 0
    for role in roles:
        steps = STEPS[role]
        ways = [[(best[x] + steps[x][y].cost, x) for x in range(4) if steps[x][y] and best[x] < NEVER] for y in range(4)]
        back.append([min(w)[1] if w else 0 for w in ways])
        best = [min(w)[0] if w else NEVER for w in ways]
    out, at = [], leave
    for role, b in zip(reversed(roles), reversed(back), strict=True):
        out.append(STEPS[role][b[at]][at])
        at = b[at]
    return out[::-1]


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Neighbouring rows that agree on some columns."""
    held: list[dict] = []
    for b in batches:
        for row in b.to_pylist():
            if held and any(held[0][c] != row[c] for c in by):
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _sent(rows: Iterator[tuple], names: list[str], types: list[pa.DataType], most: int = 5000) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for row in rows:
        out.append(row)
        if len(out) >= most:
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*out, strict=True), types, strict=True)], names)


_COSTS = pa.list_(pa.int64())


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((c[0]["conv_id"], c[0]["block"], c[0]["sub"], matrix([role_of(r["role"]) for r in c])) for c in _groups(batches, ["conv_id", "block", "sub"]))
    yield from _sent(rows, ["conv_id", "block", "sub", "costs"], [pa.int64()] * 3 + [_COSTS])


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = ((g[0]["conv_id"], g[0]["above"], reduce(product, [r["costs"] for r in g])) for g in _groups(batches, ["conv_id", "above"]))
    yield from _sent(rows, ["conv_id", "at", "costs"], [pa.int64(), pa.int64(), _COSTS])


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv_id, at, above, costs, enter, leave, last) -> states around each; leave is null where it is free."""

    def rows() -> Iterator[tuple]:
        for g in _groups(batches, ["conv_id", "above"]):
            path = states([r["costs"] for r in g], g[0]["enter"], g[0]["leave"])
            for k, r in enumerate(g):
                yield r["conv_id"], r["at"], path[k], path[k + 1], r["last"] and k == len(g) - 1

    yield from _sent(rows(), ["conv_id", "at", "enter", "leave", "last"], [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_()])


OUT = "conv_id long, turn long, role string, action string, new_role string, inserted string, cost int, rendered string"


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple]:
        for c in _groups(batches, ["conv_id", "block", "sub"]):
            before = c[0]["enter"]
            steps = repair([role_of(r["role"]) for r in c], before, c[0]["leave"])
            for k, (row, step) in enumerate(zip(c, steps, strict=True)):
                text = row["text"] or ""
                if step.action.endswith("merge"):
                    shown = "\n" + text
                else:
                    shown = (CLOSE if before != BEGIN else "") + (OPEN.format(NAMES[step.inserted]) + CLOSE if step.inserted else "") + OPEN.format(NAMES[step.role]) + text
                before = step.role
                if row["last"] and k == len(c) - 1:
                    shown += CLOSE if before in FINAL else CLOSE + OPEN.format("user") + CLOSE
                yield row["conv_id"], row["turn"], row["role"], step.action, NAMES[step.role], NAMES[step.inserted] if step.inserted else None, step.cost, shown

    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int32(), pa.string()]
    yield from _sent(rows(), ["conv_id", "turn", "role", "action", "new_role", "inserted", "cost", "rendered"], types)


def _beside(rows: DataFrame, side: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """rows with the columns of a written side; nulls match."""
    side = maybe_broadcast(side).withColumnsRenamed({c: f"__{c}" for c in on})
    return rows.join(side, reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in on]), how).drop(*[f"__{c}" for c in on])


def _chunked(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, place, and the chunk as block and sub, whose order is that of turn and place."""
    t = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    number = F.coalesce("turn", F.lit(-(1 << 62)))
    t = t.withColumn("block", F.shiftright(number, CHUNK.bit_length() - 1)).withColumn("place", F.xxhash64("role", "text"))
    full = written(t.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > FULL), "full")
    if not full.take(1):
        return t.withColumn("sub", F.lit(0).cast("long"))
    t = _beside(t, full, ["conv_id", "block"], "left")
    parts = F.ceil(F.col("n") / CHUNK)
    part = F.least(parts - 1, F.floor((F.col("place").cast("double") / 2.0**64 + 0.5) * parts))
    sub = (number - F.shiftleft("block", CHUNK.bit_length() - 1)) * parts + part
    return t.withColumn("sub", F.coalesce(sub, F.lit(0)).cast("long")).drop("n")


def formatted(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, action, new_role, inserted, cost, rendered: a row for each row of turns."""
    t = _chunked(turns)
    chunk = ["conv_id", "block", "sub"]
    order = [*chunk, F.col("turn").asc_nulls_first(), "place"]
    costs = t.repartition(*chunk).sortWithinPartitions(*order).select(*chunk, "role").mapInArrow(_matrices, "conv_id long, block long, sub long, costs array<long>")
    at = F.row_number().over(Window.partitionBy("conv_id").orderBy("block", "sub")) - 1
    costs = written(written(costs, "costs").withColumn("at", at.cast("long")), "costs")
    above = F.floor(F.col("at") / FAN).alias("above")
    dealt = lambda rows: rows.repartition("conv_id", "above").sortWithinPartitions("conv_id", "above", "at")
    levels = [costs.select("conv_id", "at", "costs")]
    while levels[-1].where(F.col("at") >= FAN).take(1):
        rows = dealt(levels[-1].select("conv_id", above, "at", "costs"))
        levels.append(written(rows.mapInArrow(_products, "conv_id long, at long, costs array<long>"), "products"))
    fixed = levels[-1].select("conv_id", above, "at", "costs", F.lit(BEGIN).alias("enter"), F.lit(None).cast("int").alias("leave"), F.lit(True).alias("last"))
    kind = "conv_id long, at long, enter int, leave int, last boolean"
    paths = written(dealt(fixed).mapInArrow(_paths, kind), "paths")
    for level in reversed(levels[:-1]):
        fixed = _beside(level.select("conv_id", above, "at", "costs"), paths.withColumnRenamed("at", "above"), ["conv_id", "above"])
        paths = written(dealt(fixed.select("conv_id", "above", "at", "costs", "enter", "leave", "last")).mapInArrow(_paths, kind), "paths")
    side = written(_beside(costs.select(*chunk, "at"), paths, ["conv_id", "at"]).select(*chunk, "enter", "leave", "last"), "paths")
    joined = _beside(t, side, chunk).repartition(*chunk).sortWithinPartitions(*order)
    return joined.select(*chunk, "turn", "role", "text", "enter", "leave", "last").mapInArrow(_rendered, OUT)
