"""Text cleanup, slicing and scores."""

from __future__ import annotations

import difflib
import functools
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = r"(?:\.{4,}|_{3,}|…{2,})"
MARK_CODE = r"\b(?:M|A|B|SC)\d+\b|\b(?:FT|cao|oe|nfww|isw)\b"


def clean(t: Column) -> Column:
    """Answer rules, page furniture and runs of space removed."""
    t = F.regexp_replace(t, BLANKS, " ")
    t = F.regexp_replace(t, r"(?mi)^\s*(?:\[?turn over\]?|blank page|page \d+ of \d+|\d{1,3})\s*$", "")
    t = F.regexp_replace(t, r"[ \t\x0B\f]+", " ")
    return F.regexp_replace(F.regexp_replace(t, r"\s*\n\s*", "\n"), r"^\s+|\s+$", "")


def squeezed(t: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(t, F.lit(""))), r"\s+", " "))


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Matching-blocks ratio of lower-case, space-collapsed texts; 0 if one is empty."""
    tidy = [[" ".join((x or "").lower().split()) for x in s] for s in (a, b)]
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if x and y else 0.0 for x, y in zip(*tidy, strict=True)])


#: Classes of characters that are counted: as large together as a text.
LETTERS = "abcdefghijklmnopqrstuvwxyz "


def letter_counts(t: Column) -> Column:
    """How often each letter and the space occur, and everything else together."""
    each = [F.length(t) - F.length(F.replace(t, F.lit(c), F.lit(""))) for c in LETTERS]
    return F.array(*each, F.length(F.regexp_replace(t, "[a-z ]+", "")))


def counts_in_common(a: Column, b: Column) -> Column:
    """No two texts with such counts have more characters in common."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda s, x: s + x)


@functools.lru_cache(maxsize=4096)
def _places(t: str) -> dict[str, int]:
    found: dict[str, int] = {}
    for k, c in enumerate(t):
        found[c] = found.get(c, 0) | 1 << k
    return found


def common_subsequence(a: str, b: str) -> int:
    """Length of the longest common subsequence, all of a's places at once: a bit is zero where the subsequence grows."""
    places, every = _places(a), (1 << len(a)) - 1
    rows = every
    for c in b:
        met = rows & places.get(c, 0)
        rows = (rows + met | rows - met) & every
    return len(a) - rows.bit_count()


def reaches(a: str, b: str, least: float) -> bool:
    """Whether two tidy texts may be so alike: matching blocks are a common subsequence, so their ratio is at most its."""
    return bool(a and b) and 2 * common_subsequence(a, b) >= least * (len(a) + len(b)) - 1e-9


@F.pandas_udf(T.DoubleType())
def similarity_from(a: pd.Series, b: pd.Series, least: pd.Series) -> pd.Series:
    """The matching-blocks ratio of tidy texts where it may reach the least, else null."""
    return pd.Series([difflib.SequenceMatcher(None, x, y).ratio() if reaches(x, y, t) else None for x, y, t in zip(a, b, least, strict=True)], dtype="float64")


#: Fixed value: labels within a text, with or without a number before them.
_LABELS = r"(?i)(?:\b\d{1,2}\s*)?(?:\(\s*(?:xviii|xvii|xvi|xiv|xiii|xii|xi|viii|vii|vi|iv|ix|iii|ii|i|xx|xix|xv|x|v|[a-z])\s*\)\s*)+"


def task(t: Column) -> Column:
    """What the last labelled part of a text asks: its letters and digits, in lower case."""
    from .labels import remainder

    rest = F.trim(remainder(t))
    last = F.element_at(F.filter(F.split(F.when(rest != "", rest).otherwise(t), _LABELS), lambda x: F.trim(x) != ""), -1)
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(F.coalesce(last, F.lit("")), r"\\[a-zA-Z]+", " ")), "[^a-z0-9]+", " "))


#: What tells that another question begins, and how many characters of it count.
TAIL = re.compile(r"\[\s*\d+\s*\]|\.{6,}|calculate|work out|find|show that|write down|solve|complete|give your answer|diagram|table|graph|curve|histogram")
TAIL_REACH, TAIL_LEAST, LATER_ROOTS = 260, 8, 4


def _tail(t: str) -> bool:
    probe = " ".join(t.split()).lower()[:TAIL_REACH]
    return len(probe) >= TAIL_LEAST and bool(TAIL.search(probe))


def _trimmed(t: str, own: str, expected: list[str]) -> str:
    t, parts = t.strip(), own.split(".")
    if not t or len(parts) < 2:
        return t
    least = max(len(parts[0]) + sum(len(p) + 2 for p in parts[1:]) + 24, 45)
    others = [e.split(".") for e in expected if e != own]
    patterns = [rf"(?i)\b{re.escape(e[0])}\b" + "".join(rf"\s*\(\s*{re.escape(p)}\s*\)" for p in e[1:]) for e in others if e[0] == parts[0]]
    later = sorted({int(e[0]) for e in others if e[0].isdigit() and parts[0].isdigit() and int(e[0]) > int(parts[0])})
    patterns += [rf"(?<![A-Za-z0-9]){root}\s+(?=[A-Z])" for root in later[:LATER_ROOTS]]
    cuts = [m.start() for p in patterns for m in re.finditer(p, t) if m.start() >= least and _tail(t[m.start() :])]
    cut = t[: min(cuts)].rstrip(" .;,\n\t") if cuts else t
    return cut if len(cut) >= least else t


@F.pandas_udf(T.StringType())
def trimmed_siblings(t: pd.Series, own: pd.Series, expected: pd.Series) -> pd.Series:
    """Texts up to where a sibling's label, or a later root's number, begins another question."""
    return pd.Series([_trimmed(x or "", o or "", [] if e is None else list(e)) for x, o, e in zip(t, own, expected, strict=True)])


def numbered_blocks(t: Column) -> Column:
    """Texts from each line that starts with a number and . or ); a preamble is dropped if there is one such line."""
    found = F.filter(F.split(t, r"(?m)(?=^\s*\d+\s*[.)]\s+)"), lambda x: F.trim(x) != "")
    numbered = F.filter(found, lambda x: x.rlike(r"^\s*\d+\s*[.)]\s+"))
    return F.when(F.size(numbered) > 0, numbered).otherwise(found)


def mark_codes(t: Column) -> Column:
    return F.regexp_extract_all(t, F.lit(f"({MARK_CODE})"), F.lit(1))


def method_steps(marks: Column, partial: Column) -> Column:
    """A step for each mark code, with the text of its line."""
    lines = F.filter(F.split(F.concat_ws("\n", marks, partial), "\n"), lambda x: F.trim(x) != "")
    return F.flatten(F.transform(lines, lambda x: F.transform(mark_codes(x), lambda code: F.struct(code.alias("type"), F.trim(x).alias("description")))))


def inferred_marks(marks: Column, partial: Column) -> Column:
    """The first line of one or two digits, else the sum of the digits in mark codes."""
    alone = F.regexp_extract(F.coalesce(marks, F.lit("")), r"(?m)^\s*(\d{1,2})\s*$", 1)
    digits = F.regexp_extract_all(F.concat_ws("\n", marks, partial), F.lit(r"\b(?:M|A|B|SC)(\d+)\b"), F.lit(1))
    return F.when(alone != "", alone.try_cast("int")).otherwise(F.aggregate(digits, F.lit(0), lambda a, x: a + x.cast("int")))


def demand(marks: Column) -> Column:
    return F.when(marks.isNull(), "MEDIUM").when(marks <= 1, "LOW").when(marks == 2, "MEDIUM").otherwise("HIGH")


def tier(t: Column) -> Column:
    s = F.lower(F.coalesce(t, F.lit("")))
    return F.when(s.contains("higher") | s.rlike(r"\bhl\b"), "HL").when(s.contains("standard") | s.rlike(r"\bsl\b"), "SL").when(s.contains("core"), "Core").when(s.contains("extended"), "Extended").otherwise("N/A")


def math_noise(t: Column) -> Column:
    """(tokens of one character + half of those of signs) / tokens; 0 under 12 tokens."""
    tokens = F.filter(F.split(F.coalesce(t, F.lit("")), r"\s+"), lambda x: x != "")
    one, signs = F.size(F.filter(tokens, lambda x: F.char_length(x) == 1)), F.size(F.filter(tokens, lambda x: x.rlike(r"^[=+\-*/^<>(){}\[\]|\\]+$")))
    return F.when(F.size(tokens) < 12, F.lit(0.0)).otherwise((one + 0.5 * signs) / F.size(tokens))


def between(t: Column, start: Column, end: Column) -> Column:
    """The text from a label's end to the next label (patterns by row)."""
    after = F.substring(t, F.char_length(F.regexp_substr(t, F.concat(F.lit("(?s)^.*?"), start))) + 1, F.char_length(t))
    upto = F.regexp_substr(after, F.concat(F.lit("(?s)^.*?(?="), end, F.lit(")")))
    return F.when(F.regexp_substr(t, start).isNull(), F.lit(None).cast("string")).otherwise(F.trim(F.coalesce(upto, after)))


#: Private-use code points that stand for brackets.
GLYPHS = {"": "(", "": "(", "": "(", "": ")", "": ")", "": ")"}


def glyphs(t: Column) -> Column:
    return F.translate(t, "".join(GLYPHS), "".join(GLYPHS.values()))


def matrix_stack(t: Column) -> Column:
    """Two or more bracketed lines become a matrix."""
    lines = F.filter(F.split(glyphs(t), "\n"), lambda x: F.trim(x) != "")
    inner = F.transform(lines, lambda x: F.trim(F.regexp_replace(x, r"^\s*\(\s*|\s*\)\s*$", "")))
    stacked = (F.size(lines) >= 2) & F.forall(lines, lambda x: x.rlike(r"^\s*\(.*\)\s*$"))
    return F.when(stacked, F.concat(F.lit("\\begin{pmatrix}"), F.array_join(inner, "\\\\"), F.lit("\\end{pmatrix}"))).otherwise(glyphs(t))


def repaired_math(t: Column) -> Column:
    """Spaced powers, fractions and relations put together."""
    t = F.regexp_replace(t, r"(?<=[A-Za-z0-9)])\s*\^\s*(?=[A-Za-z0-9({])", "^")
    t = F.regexp_replace(t, r"(\d)\s*/\s*(\d)", "$1/$2")
    return F.regexp_replace(t, r"\s*(<=|>=|=)\s*", " $1 ")


def risky_math(t: Column) -> Column:
    return t.rlike("[-]|(?:\\b\\w\\b\\s+){6,}|\\^\\s*$")
