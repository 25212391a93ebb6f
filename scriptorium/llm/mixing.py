"""Mixing sources to target weights by Pareto order sampling.

A source with target t and size S gets the rate r = t / S.  Every document is taken floor(r) times for certain.
The room that is left, t - floor(r) * S words, is shared by weight: a document weighs the binary digits of its size, so
longer ones are likelier, but far from in proportion, and its inclusion probability is p = min(1, c * weight), c such that
the expected words fill the room.  Documents with p = 1 are taken once more for certain.  The rest is a Pareto sample:
documents are ranked by q = (u / (1 - u)) / (p / (1 - p)), u a hash of source, id and text, and taken in this order.  The sample's
size is fixed in words: a document that no longer fits is passed over and later ones are tried, to the end of the
source, so the sum ends short of its target by less than any document after the last one passed over, and small documents that fill this last
gap are taken beyond their odds.

The sample is found without sorting a source, in rounds, over z, the share of the source's documents that is expected to have a
smaller q: it orders a source as q does and is spread evenly from 0 to 1, whatever the odds (sizes have at most 63 classes of digits, so
it is a short sum).  z is dealt into GRID cells, the words of the documents that may still fit are summed by cell, the cell with the cut is
divided into GRID cells again, and documents before it are taken by a bound on z.  From there on those that
fit the gap are tried one by one, over a stretch of z that holds about TRY of them; the next round goes on behind it, and a source
goes into it until nothing fits what is left.  So a round brings about TRY rows of a source to one task, whatever its size,
and no document is left out.  Sources are a dimension: tables with a row for each, or for each and class of sizes, are handled whole.

Defined results: a null text or one without words has size 0 and is never taken, whatever the rate; a null source is the last one;
rows that repeat source, id and text tie, and are taken in the order of a hash of all their columns, the same in every run; an id and text
in two sources are two documents; very long texts count by their words like others; an empty
table gives an empty result; other columns pass through ``repeat`` untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, maybe_broadcast, row_hash, written

MOST = 3.0  # times a source's size that its target may reach, and times its size that a document may be taken
CYCLE = 3  # weights 1, 2, .. CYCLE, repeating
GRID = 4096
TRY = 2048
_M = "__mix_"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(seed: int, *cols: Column) -> Column:
    """A number over 0 and under 1 from a hash of the columns."""
    return (F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 12).cast("double") + 0.5) / float(1 << 52)


def targets(sources: DataFrame) -> DataFrame:
    """source, source_size -> with target.  Water-filling: in the order of MOST * size / weight, a source is full
    if the level that would share the rest by weight is above it."""
    total = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_level = Window.orderBy("level", "place")
    s = sources.withColumn("place", F.row_number().over(by_name)).withColumn("weight", F.pmod(F.col("place") - 1, F.lit(CYCLE)) + 1.0)
    s = s.withColumn("level", MOST * F.col("source_size") / F.col("weight"))
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(total) - MOST * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    s = s.withColumn("share", left / F.sum("weight").over(onward))
    s = s.withColumn("open", F.min(F.when(F.col("share") <= F.col("level"), F.struct("level", "place", "share"))).over(total))
    capped = F.struct("level", "place") < F.struct(F.col("open.level").alias("level"), F.col("open.place").alias("place"))
    full = F.coalesce(capped, F.lit(True))
    return s.withColumn("target", F.when(full, MOST * F.col("source_size")).otherwise(F.col("open.share") * F.col("weight"))).select("source", "source_size", F.col("target").cast("double").alias("target"))


def _cut(cells: DataFrame, room: str) -> DataFrame:
    """source, cell, words -> the cell of each source in which its room ends, and the words before it."""
    w = Window.partitionBy("source").orderBy("cell")
    c = cells.withColumn("upto", F.sum("words").over(w))
    return c.where(F.col("upto") > F.col(room)).groupBy("source").agg(F.min(F.struct("cell", (F.col("upto") - F.col("words")).alias("before"))).alias("c")).select("source", "c.cell", "c.before")


def digits(size: Column) -> Column:
    """A document's weight within its source."""
    return F.when(size > 0, F.length(F.bin(size))).otherwise(F.lit(0)).cast("int")


def inclusion(cells: DataFrame) -> DataFrame:
    """source, room, digits, words, .. -> with p, the inclusion probability of a document of so many digits.  Water-filling: from the
    heaviest class on, a class is certain until the level that shares the rest by weight leaves the next one at 1 or less."""
    heavy = Window.partitionBy("source").orderBy(F.desc("digits"))
    left = F.col("room") - F.coalesce(F.sum("words").over(heavy.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weight = F.sum(F.col("words") * F.col("digits")).over(heavy.rowsBetween(0, Window.unboundedFollowing))
    c = cells.withColumn("level", F.try_divide(left, weight))
    c = c.withColumn("open", F.max(F.when(F.col("level") * F.col("digits") <= 1, F.struct("digits", "level"))).over(Window.partitionBy("source")))
    share = F.when(F.col("digits") <= F.col("open.digits"), F.col("open.level") * F.col("digits")).otherwise(F.lit(1.0))
    return c.withColumn("p", F.when(F.col("digits") > 0, F.greatest(share, F.lit(0.0))).otherwise(F.lit(0.0))).drop("level", "open")


def pareto(u: Column, odds: Column) -> Column:
    """q, by which documents are ranked."""
    return u / (1 - u) / odds


def place(q: Column, blend: Column) -> Column:
    """z: the expected share of documents with a smaller q; blend: array of (part, odds), part the share of documents with such odds."""
    z = F.aggregate(blend, F.lit(0.0), lambda a, x: a + x["part"] * (q * x["odds"] / (1 + q * x["odds"])))
    return F.least(z, F.lit(1 - 2.0**-53))


def plan(sized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """sized: key, id, source, size, digits, u, written.  -> (a row for each source and class of digits, documents taken beyond the plain bounds).

    Rows of a class: source_size, target, whole (certain copies), odds and blend (of the sample; null without), spans (documents of at most
    cap words with lo <= z < hi are taken once more).  Documents beyond: source, id, key, n rows of them, of all that there are."""
    cells = written(sized.groupBy("source", "digits").agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows")), "cells")
    per = written(targets(cells.groupBy("source").agg(F.sum("words").alias("source_size"))), "targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    per = per.withColumn("whole", F.floor(rate + 1e-12))
    per = per.withColumn("room", F.greatest(F.col("target") - F.col("whole") * F.col("source_size"), F.lit(0.0)))

    def joined(rows: DataFrame, side: DataFrame, *also: str) -> DataFrame:
        on = rows["source"].eqNullSafe(side["source"])
        for c in also:
            on = on & (rows[c] == side[c])
        return rows.join(maybe_broadcast(side), on).drop(side["source"], *[side[c] for c in also])

    sure = F.col("p") >= 1
    kinds = inclusion(joined(cells, written(per, "rates"))).withColumn("odds", F.when((F.col("p") > 0) & ~sure, F.col("p") / (1 - F.col("p"))))
    among = Window.partitionBy("source")
    part = F.col("rows") / F.sum(F.when(F.col("odds").isNotNull(), F.col("rows"))).over(among)
    blend = F.collect_list(F.when(F.col("odds").isNotNull(), F.struct(part.alias("part"), "odds"))).over(among.orderBy("digits").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    room = F.greatest(F.col("room") - F.coalesce(F.sum(F.when(sure, F.col("words"))).over(among), F.lit(0)), F.lit(0.0))
    kinds = kinds.select("source", "digits", "source_size", "target", (F.col("whole") + sure.cast("long")).alias("whole"), "odds", blend.alias("blend"), room.alias("room"))
    kinds = written(kinds, "kinds")
    some = joined(sized, kinds.where("odds is not null").select("source", "digits", "odds", "blend"), "digits")
    some = written(some.select("source", "id", "key", "size", place(pareto(F.col("u"), F.col("odds")), F.col("blend")).alias("z")), "ranked")

    start = "named_struct('left', gap, 'taken', cast(array() as array<struct<id: bigint, key: bigint, n: bigint, of: bigint>>))"
    fits = "least(x.n, cast(floor(a.left / x.size) as bigint))"
    step = f"(a, x) -> if(x.size <= a.left, named_struct('left', a.left - {fits} * x.size, 'taken', array_append(a.taken, named_struct('id', x.id, 'key', x.key, 'n', {fits}, 'of', x.n))), a)"
    state = written(kinds.where("room >= 1").select("source", F.col("room").alias("left"), F.lit(0.0).alias("lo")).distinct(), "state")
    spans, edges = [], []
    while True:
        fitting = joined(some, state).where("size <= left and z >= lo")
        coarse = fitting.groupBy("source", "left", "lo", F.floor(F.col("z") * GRID).alias("cell")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        coarse = written(coarse, "coarse")
        if not coarse.take(1):
            break
        # the stretch of z that holds about TRY of the documents that may still fit
        reach = coarse.groupBy("source").agg(F.sum("rows").alias("rows"), F.max("lo").alias("from"))
        reach = written(reach.select("source", (TRY * (1 - F.col("from")) / F.col("rows")).alias("reach")), "reach")
        one = written(_cut(coarse, "left"), "cut").withColumnsRenamed({"cell": "outer", "before": "outer_before"})
        inner = joined(fitting, one).where(F.floor(F.col("z") * GRID) == F.col("outer"))
        inner = inner.groupBy("source", "left", "outer_before", F.floor(F.col("z") * GRID * GRID).alias("cell")).agg(F.sum("size").alias("words"))
        two = _cut(inner.withColumn("room", F.col("left") - F.col("outer_before")), "room").alias("t").join(one.alias("o"), F.col("t.source").eqNullSafe(F.col("o.source")))
        two = two.select("t.source", "t.cell", (F.col("t.before") + F.col("o.outer_before")).alias("before"))
        cut = state.alias("s").join(two.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left").join(reach.alias("r"), F.col("s.source").eqNullSafe(F.col("r.source")), "left")
        # A source without a cut takes all that fits.
        hi = F.coalesce(F.greatest(F.col("t.cell") / float(GRID * GRID), F.col("s.lo")), F.lit(1.0))
        cut = cut.select("s.source", "s.lo", hi.alias("hi"), F.col("s.left").alias("cap"), (F.col("s.left") - F.coalesce(F.col("t.before"), F.lit(0))).alias("gap"), (hi + F.coalesce("r.reach", F.lit(1.0))).alias("upto"))
        cut = written(cut, "spans")
        spans.append(cut.select("source", "lo", "hi", "cap"))
        going = cut.where("gap >= 1 and hi < 1")
        edge = joined(some, going).where("z >= hi and z < upto and size <= gap")
        edge = edge.groupBy("source", "gap", "z", "id", "key", "size").agg(F.count(F.lit(1)).alias("n"))
        lined = edge.groupBy("source", "gap").agg(F.sort_array(F.collect_list(F.struct("z", "id", "key", "size", "n"))).alias("line"))
        tried = written(lined.select("source", F.expr(f"aggregate(line, {start}, {step})").alias("got")), "tried")
        edges.append(tried.select("source", F.explode("got.taken").alias("x")).select("source", "x.*"))
        on = going.alias("s").join(tried.alias("t"), F.col("s.source").eqNullSafe(F.col("t.source")), "left")
        on = on.select("s.source", F.coalesce("t.got.left", "s.gap").alias("left"), F.col("s.upto").alias("lo"))
        state = written(on.where("left >= 1 and lo < 1"), "state")

    none = F.array().cast("array<struct<lo: double, hi: double, cap: double>>")
    found = reduce(DataFrame.unionAll, spans).groupBy("source").agg(F.collect_list(F.struct("lo", "hi", "cap")).alias("spans")) if spans else per.limit(0).select("source", none.alias("spans"))
    kinds = kinds.alias("p").join(found.alias("f"), F.col("p.source").eqNullSafe(F.col("f.source")), "left")
    kinds = written(kinds.select("p.*", F.coalesce("f.spans", none).alias("spans")), "sources")
    edge = reduce(DataFrame.unionAll, edges) if edges else some.limit(0).select("source", "id", "key", *[F.lit(1).cast("long").alias(c) for c in ("n", "of")])
    return kinds, written(edge, "edge")


def with_copies(docs: DataFrame, seed: int = 7) -> DataFrame:
    """docs with __mix_size, __mix_source_size, __mix_target and __mix_copies."""
    key = F.xxhash64(F.lit(seed), F.coalesce(F.col("text"), F.lit("")))
    ident = F.coalesce(F.col("doc_id").cast("long"), F.lit(-1))
    rows = docs.withColumns({_M + "key": key, _M + "id": ident, _M + "size": words(F.col("text"))})
    rows = rows.withColumns({_M + "digits": digits(F.col(_M + "size")), _M + "u": uniform(seed, F.col("source"), F.col(_M + "id"), F.col(_M + "key"))})
    sized = written(rows.select("source", *[F.col(_M + c).alias(c) for c in ("key", "id", "size", "digits", "u")]), "sized")
    per, edge = plan(sized)
    side = maybe_broadcast(per).select(*[F.col(c).alias(_M + c) for c in ("source", "source_size", "target", "whole", "odds", "blend", "spans")], F.col("digits").alias(_M + "kind"))
    rows = rows.join(side, F.col("source").eqNullSafe(F.col(_M + "source")) & (F.col(_M + "digits") == F.col(_M + "kind")), "left")
    partly = edge.where("n < of").take(1)
    edge = maybe_broadcast(edge).select(F.col("source").alias(_M + "at"), F.col("id").alias(_M + "at_id"), F.col("key").alias(_M + "at_key"), F.col("n").alias(_M + "n"), F.col("of").alias(_M + "of"))
    same = F.col("source").eqNullSafe(F.col(_M + "at")) & (F.col(_M + "id") == F.col(_M + "at_id")) & (F.col(_M + "key") == F.col(_M + "at_key"))
    rows = rows.join(edge, same, "left")
    more = F.col(_M + "n").isNotNull()
    if partly:  # of rows that repeat source, id and text some are taken
        few = F.coalesce(F.col(_M + "n") < F.col(_M + "of"), F.lit(False))
        turn = F.row_number().over(Window.partitionBy("source", _M + "id", _M + "key").orderBy(row_hash(docs)))
        rows = rows.where(few).withColumn(_M + "more", turn <= F.col(_M + "n")).unionByName(rows.where(~few).withColumn(_M + "more", more))
    else:
        rows = rows.withColumn(_M + "more", more)
    z = place(pareto(F.col(_M + "u"), F.col(_M + "odds")), F.col(_M + "blend"))
    rows = rows.withColumn(_M + "z", F.when(F.col(_M + "odds").isNotNull(), z))
    plain = F.exists(_M + "spans", lambda s: (F.col(_M + "z") >= s["lo"]) & (F.col(_M + "z") < s["hi"]) & (F.col(_M + "size") <= s["cap"]))
    once = F.coalesce(plain, F.lit(False)) | F.col(_M + "more")
    copies = F.when(F.col(_M + "size") > 0, F.col(_M + "whole") + once.cast("long")).otherwise(F.lit(0))
    rows = rows.withColumn(_M + "copies", F.coalesce(copies, F.lit(0)).cast("long"))
    return rows.drop(*[_M + c for c in ("key", "id", "digits", "u", "source", "whole", "odds", "blend", "spans", "kind", "at", "at_id", "at_key", "n", "of", "more", "z")])


def mix(docs: DataFrame, seed: int = 7) -> DataFrame:
    """A row per document: doc_id, size, source_size, target, taken."""
    rows = with_copies(docs.select("doc_id", "text", "source"), seed)
    return rows.select("doc_id", F.col(_M + "size").alias("size"), F.col(_M + "source_size").alias("source_size"), F.col(_M + "target").alias("target"), (F.col(_M + "copies") * F.col(_M + "size")).alias("taken"), F.col(_M + "copies").alias("copies"))


def repeat(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of docs."""
    rows = with_copies(docs, seed).where(F.col(_M + "copies") > 0)
    rows = rows.withColumn(_M + "copy", F.explode(F.sequence(F.lit(1), F.col(_M + "copies"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
