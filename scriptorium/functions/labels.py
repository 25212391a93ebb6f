"""Question labels: grammar, canonical ids, hierarchy and ordering, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _roman(n: int) -> str:
    out = ""
    for value, sign in ((10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
        while n >= value:
            out, n = out + sign, n - value
    return out


#: i to xx
ROMANS = [_roman(n) for n in range(1, 21)]
_LONGEST_FIRST = "|".join(sorted(ROMANS, key=len, reverse=True))
_TOKEN = f"(?:{_LONGEST_FIRST}|[a-z])"
_ENDS = r"(?=$|[^a-z])"
_NOT_MATH = r"(?!\s*[(=+\-*/^])"
_WRAPPED_FIRST = rf"\s*[(\[]\s*{_TOKEN}\s*[)\]]"
_WRAPPED_DEEPER = rf"\s*[(\[]\s*(?!x\s*[)\]]){_TOKEN}\s*[)\]]"
_DOTTED = rf"\s*[.\-]\s*{_TOKEN}{_ENDS}"
_BARE_FIRST = rf"\s+(?![ivx])[a-z](?![a-z])(?!\s*[a-z]){_NOT_MATH}"
_BARE_DEEPER = rf"\s+(?!x(?![a-z]))(?:{_LONGEST_FIRST})(?![a-z]){_NOT_MATH}"
_FIRST = f"(?:{_WRAPPED_FIRST}|{_DOTTED}|{_BARE_FIRST})"
_DEEPER = f"(?:{_WRAPPED_DEEPER}|{_DOTTED}|{_BARE_DEEPER})"
ROOTED = rf"(?i)(?U)^\s*q?\s*\d+(?:{_FIRST}(?:{_DEEPER}(?:{_DEEPER}(?:{_DEEPER}(?:{_DEEPER})?)?)?)?)?"
ORPHAN = rf"(?i)(?U)^\s*[(\[]?\s*({_TOKEN})\s*[)\].]"
UNKNOWN = "UNKNOWN"


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def span(raw: Column) -> Column:
    """The text that the label takes up; empty without a label."""
    rooted = F.regexp_extract(_text(raw), ROOTED, 0)
    return F.when(rooted != "", rooted).otherwise(F.regexp_extract(_text(raw), ORPHAN, 0))


def parts(raw: Column) -> Column:
    """Root and subparts in lower case; an orphan has one part; empty without a label."""
    rooted = F.lower(F.regexp_extract(_text(raw), ROOTED, 0))
    orphan = F.lower(F.regexp_extract(_text(raw), ORPHAN, 1))
    tokens = F.regexp_extract_all(F.regexp_replace(rooted, r"^\s*q", ""), F.lit(r"(\d+|[a-z]+)"), F.lit(1))
    return F.when(rooted != "", tokens).when(orphan != "", F.array(orphan)).otherwise(F.array().cast("array<string>"))


def is_orphaned(p: Column) -> Column:
    return ~F.coalesce(F.get(p, F.lit(0)).rlike(r"^\d+$"), F.lit(False))


def canonical(p: Column) -> Column:
    return F.when(F.size(p) == 0, F.lit(UNKNOWN)).otherwise(F.array_join(p, "."))


def root(p: Column) -> Column:
    """The parent in the identity model: the root, not the part above."""
    return F.when(is_orphaned(p), F.lit(None).cast("string")).otherwise(F.get(p, F.lit(0)))


def immediate_parent(p: Column) -> Column:
    """All parts but the last; a root is its own parent."""
    return F.array_join(F.slice(p, F.lit(1), F.greatest(F.size(p) - 1, F.least(F.size(p), F.lit(1)))), ".")


def prefixes(p: Column) -> Column:
    """Canonical ids of a label and all above it, the root first."""
    return F.when(F.size(p) > 0, F.transform(F.sequence(F.lit(1), F.size(p)), lambda k: F.array_join(F.slice(p, F.lit(1), k), "."))).otherwise(F.array().cast("array<string>"))


def shown(p: Column) -> Column:
    """10(a)(ii)"""
    tail = F.transform(F.slice(p, 2, 6), lambda x: F.concat(F.lit("("), x, F.lit(")")))
    return F.when(F.size(p) == 0, F.lit("")).when(is_orphaned(p), F.concat(F.lit("("), F.array_join(p, ")("), F.lit(")"))).otherwise(F.concat(F.get(p, F.lit(0)), F.array_join(tail, "")))


def metadata(p: Column) -> Column:
    """parent, subparts, depth, is_orphaned"""
    orphan = is_orphaned(p)
    return F.struct(
        F.when(~orphan, F.get(p, F.lit(0)).try_cast("int")).alias("parent"),
        F.when(orphan, p).otherwise(F.slice(p, 2, 6)).alias("subparts"),
        F.when(orphan & (F.size(p) > 0), F.size(p) + 1).otherwise(F.greatest(F.size(p), F.lit(1))).alias("depth"),
        orphan.alias("is_orphaned"),
    )


def behind(raw: Column, taken: Column) -> Column:
    """What follows the text that a label takes up."""
    return F.ltrim(F.substring(_text(raw), F.char_length(taken) + 1, F.char_length(_text(raw))))


def remainder(raw: Column) -> Column:
    return behind(raw, span(raw))


def squashed(raw: Column) -> Column:
    """The match key: parts joined, or what is left of other text."""
    p = parts(raw)
    return F.when(F.size(p) > 0, F.array_join(p, "")).otherwise(F.regexp_replace(F.lower(_text(raw)), "[^a-z0-9]", ""))


def _roman_rank(x: Column) -> Column:
    at = F.array_position(F.array(*[F.lit(r) for r in ROMANS]), x)
    return F.when(at > 0, at.cast("int"))


def is_roman(x: Column) -> Column:
    return x.isin(*[r for r in ROMANS if r != "x"])


def is_letter(x: Column) -> Column:
    return x.rlike("^[a-z]$")


def terminal_rank(x: Column) -> Column:
    """(kind, rank): romans, then letters, then digits."""
    return F.when(_roman_rank(x).isNotNull(), F.struct(F.lit(0).alias("kind"), _roman_rank(x).alias("rank"))).when(is_letter(x), F.struct(F.lit(1).alias("kind"), (F.ascii(x) - 96).alias("rank"))).otherwise(F.struct(F.lit(2).alias("kind"), x.try_cast("int").alias("rank")))


def natural_key(p: Column) -> Column:
    """Sorts labels as they are numbered."""
    return F.transform(p, terminal_rank)


#: What follows a letter or a roman; a roman letter is a roman.
_FOLLOWING = {chr(k): chr(k + 1) for k in range(ord("a"), ord("z"))} | dict(zip(ROMANS, ROMANS[1:], strict=False))


def incremented(p: Column) -> Column:
    """The next sibling's parts; null for roots, z and the last roman.  What follows is looked up, and named once, as each mention is computed again."""
    last = F.element_at(p, -1)
    known = F.create_map(*[F.lit(x) for pair in _FOLLOWING.items() for x in pair])
    following = F.coalesce(F.element_at(known, last), F.when(last.rlike(r"^\d+$"), (last.try_cast("int") + 1).cast("string")))
    # a split of null is null, and so is what it is put together to
    return F.when(F.size(p) > 1, F.concat(F.slice(p, F.lit(1), F.size(p) - 1), F.split(following, r"\.")))


def label_pattern(p: Column) -> Column:
    """A pattern that finds the label in text with any spacing and brackets."""
    return F.concat(F.lit(r"(?i)(?<![0-9A-Za-z])"), F.array_join(F.transform(p, lambda x: F.concat(F.lit(r"[(\[]?\s*"), x, F.lit(r"\s*[)\].]?\s*"))), ""))


def with_leading_label(raw: Column, label: Column) -> Column:
    """The text under another label."""
    rest = remainder(raw)
    return F.when(rest == "", label).otherwise(F.concat_ws(" ", label, rest))


def ensure_label(raw: Column, p: Column) -> Column:
    """The text with its full label, unless it already starts with it."""
    return F.when(parts(raw) == p, raw).otherwise(with_leading_label(raw, shown(p)))


def orphan_tokens(raw: Column) -> Column:
    """Up to five wrapped tokens at the start of a text."""
    run = F.regexp_extract(_text(raw), rf"(?i)^\s*((?:[(\[]\s*{_TOKEN}\s*[)\]]\s*){{1,5}})", 1)
    return F.regexp_extract_all(F.lower(run), F.lit(f"({_TOKEN})"), F.lit(1))


def orphan_candidate(tokens: Column, context: Column) -> Column:
    """Parts of an orphan in its context: letters (i, v and x too) join the root, romans the last letter."""
    first = F.get(tokens, F.lit(0))
    by_letter = F.concat(F.slice(context, F.lit(1), F.lit(1)), tokens)
    above = F.when(is_roman(F.element_at(context, -1)) & (F.size(context) > 2), F.slice(context, F.lit(1), F.size(context) - 1)).otherwise(context)
    return F.when(F.size(tokens) == 0, context).when(is_letter(first) & ~first.isin("i", "v", "x"), by_letter).when(F.size(context) >= 2, F.concat(above, tokens)).otherwise(by_letter)
