"""How far the sources of a language diverge in their terms: all pairs of sources, and the terms that set a source apart.

Terms are runs of ASCII letters and of anything beyond ASCII, with A to Z lower-cased.  Tasks count the terms of the documents they read, by
group (language and source), and give what they hold on whenever it reaches HELD entries; Spark adds the partial counts.  A language keeps
the terms in at least `least` of its documents.  Kept terms are dealt by hash into chunks of about CHUNK terms with a slot each, and a group's
counts in a chunk are packed into one row.  Groups are dealt by hash into blocks of about BLOCK, and for each two blocks of a language and each
SEGMENT successive chunks a task gets the packed rows of both blocks, goes through the chunks one after the other and adds to its submatrix of
pairs; the submatrices of a pair of blocks are summed over the segments.  A task so holds at most 2 * BLOCK * SEGMENT packed rows of
about CHUNK counts, however many sources or terms there are (some 25 MB), and a block's rows are sent once for each block of its language.
Terms of neither group of a pair are not looked at one by one: they all give the same value, which is added by their number.

All arithmetic is of integers of 64 bits and exact for up to 9e13 occurrences a language: the quotient is a division in two steps.

Defined results: null text, lang and source are ''; a group without terms has no `term` rows and its p is that of count 0; a language without
kept terms gives its pairs the value 0; a language with one source has no `pair` rows; repeated rows, ids null or tied count as documents each;
very long texts and terms are read whole; equal values are ranked by the item's UTF-8; an empty table gives an empty result; columns beyond text,
lang and source are not read."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import maybe_broadcast, written

#: Terms that a task holds before it gives on its counts; terms a chunk, groups a block (about), chunks a segment.
HELD, CHUNK, BLOCK, SEGMENT = 500_000, 4096, 32, 8
#: p is 1 and the floor of SCALE * (count + 2) / (N + 2 V); SCALE is the product of the two steps of the division.
STEPS = (100_000, 10_000)
_GROUP = ["lang", "source"]
_TILE = ["lang", "row_block", "col_block", "segment"]
#: Bytes of a term: A to Z lower-cased, letters and all bytes over 127 kept, the rest blank.
_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b > 127 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_BYTES).split()


def _counted(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """lang, source, term, occurrences, documents: partial counts, and a row with the term '' for a group."""
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def given() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in groups.items():
            n[b""] = df[b""] = 0
            columns = [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "df"])
        groups.clear()

    for b in batches:
        for text, lang, source in zip(b.column(0), b.column(1), b.column(2)):
            key = (lang.as_py(), source.as_py())
            if key not in groups:
                groups[key] = (Counter(), Counter())
            n, df = groups[key]
            found, before = terms(text.as_py()), len(n)
            n.update(found)
            df.update(set(found))
            held += len(n) - before
            if held >= most:
                yield from given()
                held = 0
    yield from given()


def counts(docs: DataFrame, held: int = HELD) -> DataFrame:
    """lang, source, term, n, df: occurrences and documents of each term of a group; the term '' stands for the group, with 0."""
    docs = docs.select(*(F.coalesce(c, F.lit("")).alias(c) for c in ("text", *_GROUP)))
    parts = docs.mapInArrow(lambda batches: _counted(batches, held), "lang string, source string, term string, n long, df long")
    return parts.groupBy(*_GROUP, "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _div(a: str, b: str) -> str:
    return f"(({a}) div ({b}))"


def portion(n: str, total: str, v: str) -> Column:
    """1 + floor(10**9 * (n + 2) / (total + 2 v)) of three columns, by two steps so that nothing passes 64 bits."""
    m, a = f"greatest({total} + 2 * {v}, 1L)", f"(({n} + 2L) * {STEPS[0]}L)"
    return F.expr(f"1L + {_div(a, m)} * {STEPS[1]}L + {_div(f'({a} % {m}) * {STEPS[1]}L', m)}")


def distance(p: str, q: str) -> Column:
    return F.expr(_div(f"({p} - {q}) * ({p} - {q})", f"{p} + {q}"))


def vocabulary(found: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """The kept terms with their language's occurrences, chunk and slot; and each language's V and N."""
    kept = written(found.where("term != ''").groupBy("lang", "term").agg(F.sum("n").alias("n_lang"), F.sum("df").alias("df")).where(F.col("df") >= least).select("lang", "term", "n_lang"), "divergence-kept")
    totals = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("n_lang").alias("total_lang"))
    langs = found.where("term = ''").select("lang").distinct().join(totals, "lang", "left").na.fill(0, ["v", "total_lang"])
    langs = written(langs.withColumn("chunks", F.expr(f"(v + {CHUNK - 1}) div {CHUNK}")), "divergence-langs")
    dealt = kept.join(maybe_broadcast(langs), "lang").withColumn("chunk", F.expr("pmod(xxhash64(term), greatest(chunks, 1L))"))
    slot = F.row_number().over(Window.partitionBy("lang", "chunk").orderBy("term"))
    return dealt.select("lang", "term", "n_lang", "chunk", slot.alias("slot")), langs


def groups(found: DataFrame, kept: DataFrame, langs: DataFrame) -> DataFrame:
    """Each group with its total, its language's V and total, and its block."""
    totals = kept.groupBy(*_GROUP).agg(F.sum("n").alias("total"))
    every = found.where("term = ''").select(*_GROUP).join(totals, _GROUP, "left").na.fill(0, ["total"])
    sizes = every.groupBy("lang").agg(F.expr(f"(count(1) + {BLOCK - 1}) div {BLOCK}").alias("blocks"))
    every = every.join(maybe_broadcast(langs), "lang").join(sizes, "lang")
    return every.withColumn("block", F.expr("pmod(xxhash64(source), blocks)"))


def _tile(t: pa.Table) -> pa.Table:
    """The pairs of one tile over the chunks of one segment; a row is one group's counts in one chunk, or, in chunk -1, the group."""
    chunk, side = t.column("chunk").to_numpy(), t.column("side").to_numpy()
    names, totals, vs = t.column("source").to_pylist(), t.column("total").to_pylist(), t.column("v").to_pylist()
    at: list[dict[str, int]] = [{}, {}]
    base: list[list[int]] = [[], []]
    for i in np.flatnonzero(chunk < 0).tolist():
        at[side[i]][names[i]] = len(base[side[i]])
        base[side[i]].append(max(totals[i] + 2 * vs[i], 1))
    one = t.column("row_block")[0].as_py() == t.column("col_block")[0].as_py()
    shape = (len(base[0]), len(base[0]) if one else len(base[1]))
    m = [np.array(b, np.int64) for b in base]
    p = lambda n, m: 1 + (n + 2) * STEPS[0] // m * STEPS[1] + (n + 2) * STEPS[0] % m * STEPS[1] // m
    f = lambda p, q: (p - q) * (p - q) // (p + q)
    low = [p(np.zeros(len(x), np.int64), x) for x in m]
    zero = f(low[0][:, None], low[0 if one else 1][None, :])
    first, v = t.column("segment")[0].as_py() == 0, vs[0]
    out = zero * v if first else np.zeros(shape, np.int64)
    order = np.argsort(chunk, kind="stable")
    slots, ns = t.column("slots"), t.column("ns")
    cuts = np.flatnonzero(np.diff(chunk[order], prepend=-2))
    for a, b in zip(cuts, [*cuts[1:], len(order)]):
        rows = order[a:b].tolist()
        if chunk[rows[0]] < 0:
            continue
        held = [(side[i], at[side[i]][names[i]], slots[i].values.to_numpy(), ns[i].values.to_numpy()) for i in rows]
        used = np.unique(np.concatenate([x[2] for x in held]))
        dense = [np.zeros((len(x), len(used)), np.int64) for x in base]
        for s, k, slot, n in held:
            dense[s][k, np.searchsorted(used, slot)] = n
        left = p(dense[0], m[0][:, None])
        right = left if one else p(dense[1], m[1][:, None])
        for k in range(shape[0]):
            out[k] += f(left[k], right).sum(axis=1)
        out -= zero * len(used)
    left, right = list(at[0]), list(at[0] if one else at[1])
    keep = np.argwhere(~np.eye(shape[0], dtype=bool) if one else np.ones(shape, bool))
    lang = t.column("lang")[0].as_py()
    return pa.table({"lang": pa.array([lang] * len(keep), pa.string()), "source": pa.array([left[i] for i, _ in keep], pa.string()), "item": pa.array([right[j] for _, j in keep], pa.string()), "value": pa.array(out[keep[:, 0], keep[:, 1]], pa.int64()), "both": pa.array([not one] * len(keep), pa.bool_())})


def pairs(kept: DataFrame, every: DataFrame) -> DataFrame:
    """lang, source, item, value for each two sources of a language, both ways."""
    columns = ["lang", "source", "total", "v", "blocks", "block"]
    anchors = every.select(*columns, F.explode(F.expr("sequence(0L, greatest(chunks - 1, 0L) div %d)" % SEGMENT)).alias("segment"), F.lit(-1).cast("long").alias("chunk"))
    anchors = anchors.withColumns({"slots": F.array().cast("array<int>"), "ns": F.array().cast("array<long>")})
    packed = kept.groupBy(*_GROUP, "chunk").agg(F.collect_list(F.struct("slot", "n")).alias("x"))
    packed = packed.select(*_GROUP, "chunk", F.col("x.slot").alias("slots"), F.col("x.n").alias("ns"), F.expr(f"chunk div {SEGMENT}").alias("segment"))
    rows = anchors.unionByName(packed.join(maybe_broadcast(every.select(*columns)), _GROUP))
    # A block's rows go to its tile with each block: first of the two up to itself, second from there on.
    other = F.explode(F.expr("sequence(0L, blocks - 1)")).alias("other")
    dealt = rows.select("*", other).select(
        "lang", F.least("block", "other").alias("row_block"), F.greatest("block", "other").alias("col_block"), "segment", "chunk",
        F.when(F.col("block") <= F.col("other"), 0).otherwise(1).alias("side"), "source", "total", "v", "slots", "ns")
    sums = dealt.groupBy(*_TILE).applyInArrow(_tile, "lang string, source string, item string, value long, both boolean")
    summed = sums.groupBy("lang", "source", "item", "both").agg(F.sum("value").alias("value"))
    ways = F.when(F.col("both"), F.array(F.struct("source", "item"), F.struct(F.col("item").alias("source"), F.col("source").alias("item")))).otherwise(F.array(F.struct("source", "item")))
    return summed.select("lang", "value", F.explode(ways).alias("w")).select("lang", "w.source", "w.item", "value")


def telling(kept: DataFrame, every: DataFrame) -> DataFrame:
    """lang, source, item, value of the terms that a group has more often than its language."""
    known = kept.join(maybe_broadcast(every.select(*_GROUP, "total", "v", "total_lang")), _GROUP)
    known = known.select(*_GROUP, F.col("term").alias("item"), portion("n", "total", "v").alias("p"), portion("n_lang", "total_lang", "v").alias("q"))
    return known.where("p > q").select(*_GROUP, "item", distance("p", "q").alias("value"))


def audit(docs: DataFrame, least: int = 10, ranks: int = 10) -> DataFrame:
    """lang, source, part, item, value, rank: all pairs of sources, and the first terms of each."""
    found = written(counts(docs), "divergence-counts")
    terms_, langs = vocabulary(found, least)
    kept = written(found.where("term != ''").drop("df").join(maybe_broadcast(written(terms_, "divergence-terms")), ["lang", "term"]), "divergence-vectors")
    every = written(groups(found, kept, langs), "divergence-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = telling(kept, every).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= ranks)
    near = pairs(kept, every).withColumn("rank", F.row_number().over(order))
    return near.withColumn("part", F.lit("pair")).unionByName(top.withColumn("part", F.lit("term"))).select("lang", "source", "part", "item", "value", "rank")
