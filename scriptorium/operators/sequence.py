"""Passes whose decisions depend on earlier decisions.

Papers are hashed to partitions and sorted; a partition is read as a stream of rows with the state of one paper: the ids it has
used, and the row before.  So memory grows with the ids of one paper, not with its texts, and no group is materialised."""

from __future__ import annotations

import difflib
import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame

from . import guarded

_ROMANS = "i ii iii iv v vi vii viii ix x xi xii xiii xiv xv xvi xvii xviii xix xx".split()
#: Siblings that are tried; when stems are alike; how much of a text is searched and compared.
TRIES, SAME_STEM, MARKER_REACH, STEM_REACH = 20, 0.58, 260, 160


def _following(part: str) -> str | None:
    if part in _ROMANS:
        k = _ROMANS.index(part) + 1
        return _ROMANS[k] if k < len(_ROMANS) else None
    if len(part) == 1 and "a" <= part < "z":
        return chr(ord(part) + 1)
    return str(int(part) + 1) if part.isdigit() else None


def _free_sibling(label: str, used: set[str]) -> str | None:
    parts = label.split(".")
    for _ in range(TRIES):
        step = _following(parts[-1])
        if step is None:
            return None
        parts[-1] = step
        if ".".join(parts) not in used:
            return ".".join(parts)
    return None


def _tidy(text: str | None) -> str:
    return " ".join((text or "").lower().split())


class DuplicateGuard:
    """A nested id that was used moves on to the next free sibling; roots and rows without text keep theirs."""

    def __init__(self) -> None:
        self.used: set[str] = set()
        self.before: str | None = None

    def __call__(self, label: str, text: str | None = "-") -> tuple[str, bool]:
        text, before = _tidy(text), self.before
        self.before = text
        new = label
        if label and "." in label and label in self.used and not text == before == "":
            new = _free_sibling(label, self.used) or label
        if new:
            self.used.add(new)
        return new, new != label


class VisibleLabel:
    """The label that a text shows goes before the stored id, unless an earlier row has it."""

    def __init__(self) -> None:
        self.used: set[str] = set()

    def __call__(self, label: str, visible: str | None) -> tuple[str, bool]:
        new = visible if visible and visible not in self.used else label
        self.used.add(new)
        return new, new != label


class EmbeddedSubpart:
    """A root row whose text holds a (letter) is that child; a row two parts deep whose text holds a (roman) is that grandchild,
    under the letter of the row before it if both have the same stem."""

    def __init__(self) -> None:
        self.before: dict[str, tuple[list[str], str]] = {}

    @staticmethod
    def marker(text: str, allowed: Iterable[str]) -> str:
        found = (m.lower() for m in re.findall(r"\(\s*([a-z]{1,5})\s*\)", text[:MARKER_REACH], re.IGNORECASE))
        return next((m for m in found if m != "x" and m in allowed and set(m) <= set("abcdefghijklmnopqrstuvwxyz")), "")

    @staticmethod
    def stem(text: str) -> str:
        return re.sub(r"\(\s*(?:i|ii|iii|iv|v|vi|vii|viii|ix|x)\s*\)", " ", text, flags=re.IGNORECASE)[:STEM_REACH]

    def __call__(self, label: str, rest: str | None) -> tuple[str, bool]:
        parts, rest = (label or "").split("."), rest or ""
        if not parts[0].isdigit():
            return label, False
        if len(parts) == 1 and (letter := self.marker(rest, "abcdefghijklmnopqrstuvwxyz")):
            parts = [*parts, letter]
        if len(parts) == 2 and parts[1] not in _ROMANS[:9] + _ROMANS[10:] and (roman := self.marker(rest, _ROMANS)):
            letter = parts[1]
            above, text = self.before.get(parts[0], ([], ""))
            if len(above) > 2 and difflib.SequenceMatcher(None, self.stem(text), self.stem(rest)).ratio() >= SAME_STEM:
                letter = above[1]
            parts = [parts[0], letter, roman]
        self.before[parts[0]] = (parts, rest)
        new = ".".join(parts)
        return new, new != label


class ExpectedAnchor:
    """The next unused expected id: the label itself, else the first whose end is the label's, at or after the current root, else the
    first that belongs to the page; a label without one stays."""

    def __init__(self) -> None:
        self.used: set[str] = set()
        self.root = 0

    def __call__(self, label: str, expected: Iterable[str] | None, page: Iterable[str] | None = None) -> tuple[str, bool]:
        left = [e for e in (expected if expected is not None else []) if e not in self.used]
        end = (label or "").split(".")[1:]
        by_end = [e for e in left if end and e.split(".")[-len(end) :] == end and e.split(".")[0].isdigit() and int(e.split(".")[0]) >= self.root]
        by_page = [e for e in left if e in set(page if page is not None else [])]
        new = label if label in left else next(iter([*by_end, *by_page]), label)
        if new in left:
            self.used.add(new)
            if new.split(".")[0].isdigit():
                self.root = int(new.split(".")[0])
        return new, new != label


class OrphanContext:
    """An orphan roman joins the last letter, in place of a roman there; an orphan letter joins the root; what is inferred is the
    context of what follows."""

    def __init__(self) -> None:
        self.context: list[str] = []

    def __call__(self, label: str) -> tuple[str, bool]:
        parts = (label or "").split(".")
        if parts[0].isdigit() or not self.context or not parts[0]:
            if parts[0].isdigit():
                self.context = parts
            return label, False
        base = self.context[:1]
        if parts[0] in _ROMANS and len(self.context) > 1:
            base = self.context[:-1] if self.context[-1] in _ROMANS and len(self.context) > 2 else self.context
        self.context = [*base, *parts]
        return ".".join(self.context), True


class RootTracker:
    """The guarded scan (see guarded) of one paper's rows, one after the other: a row's label, printed page and hint."""

    def __init__(self) -> None:
        self.root: int | None = None
        self.below: tuple[str, ...] = ()

    def __call__(self, label: str, printed: int | None = None, hinted: bool = False) -> tuple[str, bool]:
        parts, root = label.split(".") if label else [], self.root
        self.root, kind, tail, change = guarded.step(root, parts, printed, hinted)
        self.below = guarded.below(kind, tail, self.below)
        new = {"keep": label, "reject": ""}.get(change)
        if new is None:
            new = ".".join([str(root), *(self.below if change == "join" else parts[1:])])
        return new, new != label


def ordered_pass(df: DataFrame, paper: str, order: list[str], values: str | list[str], guard: Callable[[], Callable[..., tuple[str, bool]]], kept: list[str] | None = None) -> DataFrame:
    """df, or its columns kept, with new_label and changed; the guard gets the values of a row (the label first), papers apart; a null paper is a paper."""
    from pyspark.sql import types as T

    columns = [values] if isinstance(values, str) else values
    kept = df.columns if kept is None else kept
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField("new_label", T.StringType()), T.StructField("changed", T.BooleanType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, state = object(), guard()
        for frame in frames:
            new, changed = [], []
            keys = frame[paper].astype(object).where(frame[paper].notna(), None)
            for key, *row in zip(keys, *(frame[c] for c in columns), strict=True):
                if key != current:
                    current, state = key, guard()
                x, c = state(*row)
                new.append(x)
                changed.append(c)
            yield frame[kept].assign(new_label=new, changed=changed)

    return df.repartition(paper).sortWithinPartitions(paper, *order).mapInPandas(run, schema)


def packed(df: DataFrame, group: str, order: list[str], size: str, most: int, rows: int) -> DataFrame:
    """df with bin: greedy bins of at most so much size and so many rows, one too large row allowed."""
    from pyspark.sql import types as T

    schema = T.StructType([*df.schema.fields, T.StructField("bin", T.LongType())])

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, bin_, total, n = object(), 0, 0, 0
        for frame in frames:
            out = []
            keys = frame[group].astype(object).where(frame[group].notna(), None)
            for key, value in zip(keys, frame[size], strict=True):
                if key != current:
                    current, bin_, total, n = key, 0, 0, 0
                elif n and (total + value > most or n >= rows):
                    bin_, total, n = bin_ + 1, 0, 0
                total, n = total + value, n + 1
                out.append(bin_)
            yield frame.assign(bin=out)

    return df.repartition(group).sortWithinPartitions(group, *order).mapInPandas(run, schema)


def shifted_romans(rows: list[dict]) -> list[dict]:
    """Rows of a scheme in order (label, text, marks, method: has a method mark, answer: looks like an answer alone): an answer between two
    consecutive romans of its parent joins the method row before it, and later romans of the parent move down by one."""
    out: list[dict] = []
    moved: dict[tuple[str, ...], int] = {}

    def split(row: dict | None) -> tuple[tuple[str, ...], int | None]:
        parts = (row or {"label": ""})["label"].split(".")
        return tuple(parts[:-1]), _ROMANS.index(parts[-1]) if len(parts) > 1 and parts[-1] in _ROMANS else None

    for k, row in enumerate(rows):
        above, at = split(row)
        if at and at >= moved.get(above, len(_ROMANS)):
            at -= 1
            row = row | {"label": ".".join([*above, _ROMANS[at]])}
        (before_above, before), (next_above, following) = split(out[-1] if out else None), split(rows[k + 1] if k + 1 < len(rows) else None)
        line = above and above == before_above == next_above and None not in (at, before, following) and at == before + 1 and following == at + 1
        if line and out[-1]["method"] and row["answer"]:
            last = out[-1]
            out[-1] = last | {"text": "\n".join(dict.fromkeys([*last["text"].split("\n"), *row["text"].split("\n")])), "marks": last["marks"] + row["marks"]}
            moved[above] = at
        else:
            out.append(row)
    return out
