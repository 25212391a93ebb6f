"""Document fingerprints by SpotSigs (DataFrame operations only).

A spot is a run of common words (anchors); the text's beginning counts as an anchor, so every text has one.  The
content words that follow a spot, up to the next one, are a chain, cut into links of two words; a link that holds one word
takes the next content word as well, across the anchors between them.  A signature is the last anchor of the spot and a link.  A text's last word counts as a content
word.  So an edit changes the signatures from its place to the next spot at most, and texts without common words have
one chain of all their words.  The fingerprint is the set of a text's signatures, as 32-bit hashes in
order.  Likeness is the Jaccard similarity of two sets.

``similar`` finds all pairs of fingerprints at a threshold: sets are dealt to partitions by length, such that a
set can be like only sets of its own and the next partition; within them, sets meet on the rarest signatures of
their prefix, and pairs whose lengths or places already rule them out are pruned before the sets are compared.

The document after each one is found without a global sort.  Ids are cut at up to RANGES quantiles of a sample of at
most about SAMPLE ids, and each range into CELLS equal parts; cells, in order, make chunks of CHUNK_ROWS rows.  A chunk's rows
are ordered in one window, and the first row of a chunk is sent to the chunk before it as well.  So a text is
shuffled once, and however unevenly ids lie, a chunk has few rows or at most those of one range, a small share of all.  Where
the sample cuts changes no result.

Defined results: a null text is the empty text, with an empty fingerprint; two empty fingerprints are alike (1);
rows that repeat an id are ordered by their text's hash (and share a chunk); a null id orders before all others; ids may span
all 64 bits; very long texts are read whole; an empty table gives an empty result; columns other than doc_id and text are not
read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import maybe_broadcast, ordered_id, shown_id, written

#: Common words of English, French, German and Spanish.
ANCHORS = """a an and are as at be but by for from had has have he her his in is it its not of on or she that the their
there they this to was were which will with you au aux avec ce ces dans de des du elle en est et il ils la le les
leur mais ne nous ou par pas pour qui sa se ses son sur un une vous auf aus bei das dem den der die ein eine einem einen
einer er es hat ich im ist mit nach nicht sich sie sind und von vor war wie wir zu zum zur al como con del el ella este
ha las lo los me mi muy no nos para pero por que si sin sobre su sus te todo una y ya""".split()
RANGES = 2048
CELLS = 64
SAMPLE = 64 * RANGES
CHUNK_ROWS = 128


def _any_of(words: list[str]) -> str:
    """A pattern of some words that branches letter by letter, so that no word is tried after its first letters fail."""
    ends, tails = "" in words, {}
    for w in filter(None, words):
        tails.setdefault(w[0], []).append(w[1:])
    branches = [letter + _any_of(sorted(set(rest))) for letter, rest in sorted(tails.items())]
    return "" if not branches else f"(?:{'|'.join(branches)})" + "?" * ends


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _links(chain: Column) -> Column:
    """Hashes of an anchor and two words each, of a chain "anchor word word ... following", whose last word begins no link."""
    s = F.split(chain, " ")
    return _let(s, lambda w: F.filter(F.transform(w, lambda x, i: F.when((i % 2 == 1) & (i < F.size(w) - 1), F.hash(F.get(w, F.lit(0)), x, F.get(w, i + 1)))), lambda h: h.isNotNull()))


def _spots(words: Column, anchors: list[str]) -> Column:
    """Hashes of the signatures of all spots.  No pattern repeats a group, as those recurse in the JVM."""
    marked = F.regexp_replace(words, rf"(?<![^ ])({_any_of(sorted(set(anchors)))})(?= )", "\u0001$1")
    spots = F.regexp_replace(F.concat(F.lit(" "), marked, F.lit(" \u0002")), "\u0001[^ ]+ (?=\u0001)", "")
    # each chain also takes the first word of the next one, and the last chain a mark of the end
    chains = F.regexp_replace(spots, " \u0001([^ ]+) ([^ ]+)", " $2\u0001$1 $2")
    return F.flatten(F.transform(F.split(chains, "\u0001"), _links))


def signatures(text: Column, anchors: list[str] = ANCHORS) -> Column:
    """The sorted set of a text's signatures."""
    none = F.array().cast("array<int>")
    words = F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))
    found = _let(words, lambda w: F.when(w == "", none).otherwise(_spots(w, anchors)))
    return F.array_sort(F.array_distinct(found))


def as_text(signatures_: Column) -> Column:
    """Eight hexadecimal digits for each signature."""
    return F.array_join(F.transform(signatures_, lambda x: F.lpad(F.lower(F.hex(x.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    both = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - both
    return F.when(every == 0, F.lit(1.0)).otherwise(both / every)


def _ranges(ids: DataFrame) -> list[int]:
    """Where ranges of ids begin; the first begins at the least id."""
    n, least = ids.agg(F.count(F.lit(1)), F.min("id")).first()
    if not n:
        return [0]
    some = ids.where(F.pmod(F.xxhash64("id", F.lit(29)), F.lit(1 << 30)) < F.lit(int(min(1.0, SAMPLE / n) * (1 << 30)))).distinct()
    found = sorted(r["id"] for r in some.select("id").limit(4 * SAMPLE).collect())
    return sorted({least, *found[:: max(1, -(-len(found) // RANGES))]})


def _cell(id_: Column, starts: list[int]) -> Column:
    """Order-preserving: equal parts of the range that holds an id, found by binary search."""
    listed = F.expr(f"cast(split('{','.join(map(str, starts))}', ',') as array<bigint>)")
    at = F.aggregate(F.array(*[F.lit(1 << k) for k in range(len(starts).bit_length() - 1, -1, -1)]), F.lit(1), lambda a, step: F.when((a + step <= len(starts)) & (F.get(listed, F.least(a + step, F.lit(len(starts))) - 1) <= id_), a + step).otherwise(a))

    def part(k: Column) -> Column:
        low = F.get(listed, k - 1).cast("double")
        high = F.coalesce(F.get(listed, k).cast("double"), low + 1)
        share = F.floor((id_.cast("double") - low) / F.greatest(high - low, F.lit(1.0)) * CELLS)
        return k * CELLS + F.greatest(F.lit(0), F.least(share, F.lit(CELLS - 1))).cast("int")

    return _let(at, part)


def chunked(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """docs (id, ...) with chunk, rows that start a chunk sent to the chunk before as well (last = true)."""
    ids = docs.select("id")
    cell = _cell(F.col("id"), _ranges(ids))
    filled = ids.groupBy(cell.alias("cell")).agg(F.count(F.lit(1)).alias("rows"), F.min("id").alias("first"))
    upto = F.sum("rows").over(Window.orderBy("cell")) - F.col("rows")
    filled = filled.withColumn("place", F.floor(upto / CHUNK_ROWS)).withColumn("chunk", F.dense_rank().over(Window.orderBy("place")) - 1)
    filled = written(filled.select("cell", "chunk", "first"), "cells")  # at most (RANGES + 1) * CELLS rows
    chunks = filled.agg(F.max("chunk")).first()[0]
    chunks = 0 if chunks is None else chunks + 1
    rows = docs.withColumn("cell", cell).join(maybe_broadcast(filled.select("cell", "chunk")), "cell").drop("cell").withColumn("last", F.lit(False))
    heads = filled.groupBy("chunk").agg(F.min("first").alias("id"))
    heads = heads.select("id", F.pmod(F.col("chunk") - 1, F.lit(max(1, chunks))).alias("chunk"))
    sent = docs.join(maybe_broadcast(heads), "id").withColumn("last", F.lit(True))
    return rows, sent, chunks


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    text = F.coalesce("text", F.lit(""))
    base = docs.select(ordered_id(F.col("doc_id")).alias("id"), text.alias("t"))
    rows, sent, _ = chunked(base)
    # Signatures are computed after the shuffle, which moves texts alone.
    rows = rows.unionByName(sent.select(*rows.columns)).repartition("chunk").withColumn("own", signatures(F.col("t")))
    w = Window.partitionBy("chunk").orderBy("last", "id", F.xxhash64("t"))
    rows = rows.withColumn("following", F.lead(F.struct("t", "own")).over(w)).where(~F.col("last"))
    half = F.floor(F.col("n") / 2).cast("int")
    rows = rows.withColumn("n", F.char_length("t")).withColumn("edited", F.concat(F.substring("t", F.lit(1), F.col("n") - half), F.substring(F.col("following.t"), F.lit(1), half)))
    changed = _let(signatures(F.col("edited")), lambda c: F.struct(as_text(c).alias("text"), likeness(F.col("own"), c).alias("near")))
    rows = rows.select("id", F.col("n").cast("long").alias("n"), F.sha2("edited", 256).alias("sha"), "own", changed.alias("changed"), F.col("following.own").alias("next"))
    return rows.select(shown_id(F.col("id")).alias("doc_id"), F.col("n").alias("n_chars"), F.col("sha").alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"), F.col("changed.text").alias("edited_fingerprint"), F.col("changed.near").alias("near_edited"), likeness(F.col("own"), F.col("next")).alias("near_next"))


def _part(size: Column, threshold: float) -> Column:
    """Lengths s and t can only be alike if s >= threshold * t, so parts grow by 1 / threshold."""
    import math

    return F.floor(F.log(size.cast("double")) / F.lit(math.log(1 / threshold)) + F.lit(1e-9)).cast("int")


def similar(docs: DataFrame, threshold: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """(pairs of sets: a, b, likeness; membership: doc_id, set) of non-empty fingerprints at a threshold.

    Documents of one fingerprint are members of one set, so copies are not expanded."""
    sets = docs.select("doc_id", signatures(F.coalesce("text", F.lit(""))).alias("own")).where(F.size("own") > 0).withColumn("set", F.xxhash64("own"))
    member = sets.select("doc_id", "set")
    sets = written(sets.groupBy("set").agg(F.first("own").alias("own")), "sets")
    one = sets.select("set", F.size("own").alias("n"), F.explode("own").alias("sig"))
    rare = written(one.groupBy("sig").agg(F.count(F.lit(1)).alias("df")), "rare")
    w = Window.partitionBy("set").orderBy("df", "sig")
    prefix = one.join(maybe_broadcast(rare.where("df > 1")), "sig").withColumn("place", F.row_number().over(w))
    # places count from the rarest; signatures of one set alone come first and can't be met on
    prefix = prefix.withColumn("alone", F.col("n") - F.count(F.lit(1)).over(Window.partitionBy("set")))
    prefix = prefix.where(F.col("place") + F.col("alone") <= F.col("n") - F.ceil(F.lit(threshold) * F.col("n") - 1e-9) + 1)
    prefix = prefix.select("set", "n", "sig", _part(F.col("n"), threshold).alias("part"))
    left = prefix.select(F.col("set").alias("a"), F.col("n").alias("an"), "sig", F.explode(F.array("part", F.col("part") + 1)).alias("part"))
    right = prefix.select(F.col("set").alias("b"), F.col("n").alias("bn"), "sig", "part")
    met = left.join(right, ["part", "sig"]).where("(an < bn or (an = bn and a < b))").where(F.col("an") >= F.lit(threshold) * F.col("bn") - 1e-9)
    met = met.select("a", "b").distinct()
    met = met.join(sets.select(F.col("set").alias("a"), F.col("own").alias("x")), "a").join(sets.select(F.col("set").alias("b"), F.col("own").alias("y")), "b")
    return met.withColumn("likeness", likeness(F.col("x"), F.col("y"))).where(F.col("likeness") >= threshold - 1e-9).select("a", "b", "likeness"), member
