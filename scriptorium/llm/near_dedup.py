"""Near-duplicates by BagMinHash signatures: banded candidates, verified by multiset overlap.

A document is the multiset of its shingles of SHINGLE words (all its words, if it has fewer).  Weights are
discretised at the integers: a shingle that occurs c times has the levels 1..c.  Levels are grouped into blocks
(0,1], (1,2], (2,4], (4,8], ...; a block has one Poisson process of its size's rate, whose points fall on random
registers at random levels of the block.  A document takes the points of its blocks, without those above c, in
ascending order, and stops a process beyond the largest register.  Two documents agree on a register with the
probability of their weighted Jaccard similarity.

1. Sketch: registers and band keys of each document; documents of equal multisets are one class from here on.
2. Candidates: classes that share a band are compared by registers; a task emits only edges that span what
   it finds alike (at least LOOSE, over four standard deviations under THRESHOLD), never all pairs.
3. Verification: within each cluster of candidates, classes are linked if their multisets' weighted Jaccard
   similarity is THRESHOLD or more, computed from the shingles.  Visited classes are not compared again, as
   only the components matter; again only spanning edges are emitted.
4. A component is a class of near-duplicates, named by its least document id.

A bucket or cluster of at most FEW blocks of BLOCK classes is compared in pairs of blocks.  A larger one is spanned block by block
first; REPS classes of each part found, and all that stand alone, go on to the next level, until they fill one block or no longer
get fewer.  What then still stands outside the largest component is compared with the whole group, in pairs of blocks.  So a family of
any size takes rows in proportion to it, nothing is capped and no task gets a whole large group; only a large group that falls into large
parts takes pairs of blocks.  A pair at the threshold shares no band with probability (1 - 0.8**4)**20 < 0.00003.

Defined results: texts without words are all equal; a null text has no words; rows that repeat an id are each
given their class; of rows that repeat the least id of their class those with the least hash of the text are kept, and of whole
repeated rows one by keep_one; texts with the same shingles are alike however they are ordered or spaced; very long texts are
shingled whole; a null id orders before all others; an empty table gives an empty result; columns other than doc_id and text
pass through keep_one untouched, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .rolling import grouped, joined, mix, word_hashes
from .shared import maybe_broadcast, ordered_id, row_hash, shown_id, written

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 20, 4
REGISTERS = BANDS * ROWS
LOOSE = 0.6
BLOCK, CLUSTER_BLOCK = 384, 128
FEW, REPS = 4, 4
GROUP_BYTES = 1 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(ordered_id(F.col("doc_id")).alias("id"), F.xxhash64("text").alias("key"), F.coalesce("text", F.lit("")).alias("text"))


def shingles(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(document, hash) of every shingle of some documents."""
    words = [t.encode().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    hashes = word_hashes([x for w in words for x in w])
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(owner)) - (np.cumsum(counts) - counts)[owner]
    at = np.flatnonzero(place < np.maximum(counts[owner] - SHINGLE + 1, 1))
    out = hashes[at]
    for k in range(1, SHINGLE):
        on = np.flatnonzero(place[at] + k < counts[owner[at]])
        out[on] = joined(out[on], hashes[at[on] + k])
    return owner[at], out


def counted(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, hash, count) of distinct shingles, in order."""
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    first = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])])) if len(owner) else np.zeros(0, np.int64)
    return owner[first], hashes[first], np.diff(np.concatenate([first, [len(owner)]]))


def signatures(owner: np.ndarray, hashes: np.ndarray, counts: np.ndarray, n: int) -> np.ndarray:
    """Registers (least points) of n documents; infinite where a document has no shingles."""
    registers = np.full(n * REGISTERS, np.inf)
    # the blocks of each shingle: its document, seed, size and how many of its levels are taken
    doc, seed, size, taken = [owner], [mix(hashes ^ _ODD)], [np.ones(len(owner))], [np.ones(len(owner))]
    low = 1
    while len(at := np.flatnonzero(counts > low)):
        doc.append(owner[at])
        seed.append(mix(hashes[at] ^ np.uint64((low + 1) * int(_ODD) & 0xFFFFFFFFFFFFFFFF)))
        size.append(np.full(len(at), float(low)))
        taken.append(np.minimum(counts[at] - low, low).astype(float))
        low *= 2
    doc, seed, size, taken = (np.concatenate(x) for x in (doc, seed, size, taken))
    x, turn = np.zeros(len(doc)), 0
    while len(doc):
        turn += 1
        r = mix(seed + np.uint64(turn * int(_ODD) & 0xFFFFFFFFFFFFFFFF))
        x = x - np.log(((r >> np.uint64(11)).astype(float) + 0.5) * 2.0**-53) / size
        r = mix(r)
        level = (r >> np.uint64(32)).astype(float) * 2.0**-32 * size
        hit = level < taken
        at = doc * REGISTERS + (r % np.uint64(REGISTERS)).astype(np.int64)
        np.minimum.at(registers, at[hit], x[hit])
        on = x <= registers.reshape(n, REGISTERS).max(1)[doc]
        doc, seed, size, taken, x = doc[on], seed[on], size[on], taken[on], x[on]
    return registers.reshape(n, REGISTERS)


_SKETCH = "id long, key long, cls binary, registers binary, bands array<long>"


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = b.column("text").to_pylist()
        cls, regs, bands = [], [], []
        for a, z in grouped([len(t) for t in texts], GROUP_BYTES):
            n = z - a
            owner, hashes, counts = counted(*shingles(texts[a:z]))
            digest = np.zeros((n, 2), np.uint64)
            for k in (0, 1):
                np.add.at(digest[:, k], owner, mix(mix(hashes + np.uint64(k)) + counts.astype(np.uint64) * _ODD))
            bits = mix(signatures(owner, hashes, counts, n).view(np.uint64))
            keys = np.zeros((n, BANDS), np.uint64)
            for k in range(ROWS):
                keys = mix(keys * _ODD + bits[:, k::ROWS])
            keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
            cls += [d.tobytes() for d in digest]
            regs += [x.tobytes() for x in (bits & np.uint64(0xFFFF)).astype(np.uint16)]
            bands.append(keys.view(np.int64).ravel())
        flat = np.concatenate(bands) if bands else np.zeros(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(texts) + 1, dtype=np.int32) * BANDS), pa.array(flat))
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("key"), pa.array(cls, pa.binary()), pa.array(regs, pa.binary()), lists], ["id", "key", "cls", "registers", "bands"])


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows with one slot; they come sorted by it."""
    held: list[pa.Table] = []
    for b in batches:
        t = pa.Table.from_batches([b])
        slots = t.column("slot").to_numpy()
        if not len(slots):
            continue
        ends = [*(np.flatnonzero(np.diff(slots)) + 1).tolist(), len(slots)]
        if held and held[0].column("slot")[0].as_py() != slots[0]:
            yield pa.concat_tables(held)
            held = []
        a = 0
        for z in ends:
            held.append(t.slice(a, z - a))
            if z < len(slots):
                yield pa.concat_tables(held)
                held = []
            a = z
    if held:
        yield pa.concat_tables(held)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), REGISTERS)


_EDGES = "a binary, b binary"


def _parts(alike: Callable[[int, np.ndarray], np.ndarray], n: int) -> np.ndarray:
    """Of each of 0..n-1 the first of its component; alike(i, others) tells which others are like i."""
    first, left = np.arange(n), np.arange(n)
    while len(left):
        head = int(left[0])
        queue, left = [head], left[1:]
        while queue and len(left):
            i = queue.pop()
            hit = alike(i, left)
            if hit.any():
                first[left[hit]] = head
                queue += left[hit].tolist()
                left = left[~hit]
    return first


def _send(edges: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.binary()) for k in (0, 1)], ["a", "b"])


_LEAST = int(np.ceil(LOOSE * REGISTERS))


def _by_registers(t: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
    regs = _matrix(t.column("registers"))
    return lambda i, left: (regs[left] == regs[i]).sum(1) >= _LEAST


def _by_elements(t: pa.Table) -> Callable[[int, np.ndarray], np.ndarray]:
    regs = _matrix(t.column("registers"))
    sets = [np.frombuffer(x, np.uint64) for x in t.column("elements").to_pylist()]
    sizes = np.array([len(s) for s in sets])

    def alike(i: int, left: np.ndarray) -> np.ndarray:
        hit = np.zeros(len(left), bool)
        ratio = np.minimum(sizes[left], sizes[i]) >= THRESHOLD * np.maximum(sizes[left], sizes[i])
        maybe = np.flatnonzero(ratio & ((regs[left] == regs[i]).sum(1) >= _LEAST))
        if len(maybe):
            parts = [sets[left[k]] for k in maybe]
            every = np.concatenate(parts)
            at = np.minimum(np.searchsorted(sets[i], every), len(sets[i]) - 1)
            common = np.add.reduceat(sets[i][at] == every, np.cumsum([0, *map(len, parts[:-1])]), dtype=np.int64)
            hit[maybe] = common >= THRESHOLD * (sizes[left[maybe]] + sizes[i] - common) - 1e-9
        return hit

    return alike


def _edges_of(alike: Callable) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Edges that span the components of each slot."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple[bytes, bytes]] = []
        for t in _groups(batches):
            cls = t.column("cls").to_pylist()
            out += [(cls[i], cls[j]) for i, j in enumerate(_parts(alike(t), len(cls)).tolist()) if i != j]
            if len(out) > 50_000:
                yield _send(out)
                out = []
        if out:
            yield _send(out)

    return run


def _spanned(alike: Callable, data: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """grp, cls and head (the first of its component in the slot) of each row, and data of those that go on to the next level."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _groups(batches):
            part = _parts(alike(t), len(t))
            order = np.argsort(part, kind="stable")
            fresh = np.concatenate([[True], np.diff(part[order]) != 0])
            on = np.zeros(len(part), bool)
            on[order] = np.arange(len(part)) - np.flatnonzero(fresh)[np.cumsum(fresh) - 1] < REPS
            cls = t.column("cls")
            held = [pa.array([v if k else None for v, k in zip(t.column(c).to_pylist(), on.tolist(), strict=True)], pa.binary()) for c in data]
            yield pa.RecordBatch.from_arrays([t.column("grp").combine_chunks(), cls.combine_chunks(), cls.take(pa.array(part)).combine_chunks(), pa.array(on), *held], ["grp", "cls", "head", "goes_on", *data])

    return run


def _elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Multisets as sets: the k-th occurrence of a shingle is an element of its own."""
    for b in batches:
        texts, out = b.column("text").to_pylist(), []
        for a, z in grouped([len(t) for t in texts], GROUP_BYTES):
            owner, hashes, counts = counted(*shingles(texts[a:z]))
            level = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            elements = mix(np.repeat(hashes, counts) + level.astype(np.uint64) * _ODD)
            ends = np.searchsorted(np.repeat(owner, counts), np.arange(z - a + 1))
            out += [np.sort(elements[ends[k] : ends[k + 1]]).tobytes() for k in range(z - a)]
        yield pa.RecordBatch.from_arrays([b.column("root"), b.column("n"), b.column("cls"), b.column("registers"), pa.array(out, pa.binary())], ["grp", "n", "cls", "registers", "elements"])


def _linked(rows: DataFrame, block: int, data: list[str], alike: Callable, tag: str) -> DataFrame:
    """rows: grp, n (the size of the group), cls and data.  -> edges (a, b) whose components are those of the groups' links; written."""
    compare = _edges_of(alike)

    def compared(slots: DataFrame) -> DataFrame:
        return slots.select("slot", "cls", *data).repartition("slot").sortWithinPartitions("slot", "cls").mapInArrow(compare, _EDGES)

    few = rows.where(F.col("n") <= FEW * block).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    few = few.withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
    few = few.where("blocks = 1 or other != block").withColumn("slot", F.xxhash64("grp", F.least("block", "other"), F.greatest("block", "other")))
    edges = written(compared(few).distinct(), tag)
    big = written(rows.where(F.col("n") > FEW * block).select("grp", "cls", *data), f"{tag}_large")
    if not big.take(1):
        return edges
    kind = f"grp {big.schema['grp'].dataType.simpleString()}, cls binary, head binary, goes_on boolean, " + ", ".join(f"{c} binary" for c in data)
    level, depth = big, 0
    while True:
        sizes = written(level.groupBy("grp").agg(F.count(F.lit(1)).alias("n")), "sizes")
        dealt = level.join(maybe_broadcast(sizes), "grp").withColumn("slot", F.xxhash64("grp", F.pmod(F.xxhash64("cls", F.lit(depth)), F.ceil(F.col("n") / block))))
        dealt = dealt.select("slot", "grp", "cls", *data).repartition("slot").sortWithinPartitions("slot", "cls")
        level = written(dealt.mapInArrow(_spanned(alike, data), kind), f"{tag}_level")
        edges = edges.unionAll(level.where("cls != head").select(F.col("cls").alias("a"), F.col("head").alias("b")))
        level, depth = level.where("goes_on").select("grp", "cls", *data), depth + 1
        before, most, now = sizes.agg(F.sum("n"), F.max("n")).first()[0], sizes.agg(F.max("n")).first()[0], level.count()
        if most <= block or now > 0.9 * before:
            break
    edges = written(edges.distinct(), tag)
    found = components(edges).toDF("cls", "comp") if edges.take(1) else edges.toDF("cls", "comp")
    known = written(big.select("grp", "cls").join(maybe_broadcast(found), "cls", "left").withColumn("comp", F.coalesce("comp", "cls")), "known")
    per = known.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("size")).groupBy("grp")
    per = per.agg(F.max(F.struct("size", "comp")).alias("main"), F.sum("size").alias("n")).where(F.col("main.size") < F.col("n"))
    sizes = written(per.select("grp", F.col("main.comp").alias("main"), F.ceil(F.col("n") / block).alias("all"), F.ceil((F.col("n") - F.col("main.size")) / block).alias("rest")), "sizes")
    here = known.join(maybe_broadcast(sizes), "grp")
    spread = lambda c: F.pmod(F.xxhash64("cls"), F.col(c))
    every = here.withColumn("j", spread("all")).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rest") - 1)))
    rest = here.where("comp != main").withColumn("i", spread("rest")).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("all") - 1)))
    slots = every.unionByName(rest).select("grp", "cls", F.xxhash64("grp", "i", "j").alias("slot")).distinct()
    return written(edges.unionAll(compared(slots.join(big, ["grp", "cls"]))).distinct(), tag)


def classes(docs: DataFrame) -> DataFrame:
    """id, key, cls of every row and the least id and the size of its class of near-duplicates: written."""
    rows = _rows(docs)
    sketch = written(rows.mapInArrow(_sketch, _SKETCH), "sketch")
    reps = sketch.groupBy("cls").agg(F.min(F.struct("id", "key")).alias("rep"), F.count(F.lit(1)).alias("size"), F.first("registers").alias("registers"), F.first("bands").alias("bands"))
    reps = written(reps, "reps")
    full = reps.select("cls", "registers", F.explode("bands").alias("band"))
    shared = written(full.groupBy("band").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "bands")
    dealt = full.join(maybe_broadcast(shared), "band").select(F.col("band").alias("grp"), "n", "cls", "registers")
    edges = _linked(dealt, BLOCK, ["registers"], _by_registers, "candidates")
    clusters = components(edges)
    sizes = written(clusters.groupBy("root").agg(F.count(F.lit(1)).alias("n")), "clusters")
    member = clusters.join(maybe_broadcast(sizes), "root").withColumnRenamed("node", "cls")
    member = written(reps.select("cls", "registers", "rep").join(maybe_broadcast(written(member, "members")), "cls").select("root", "n", "cls", "registers", "rep.id", "rep.key"), "members")
    texts = rows.join(maybe_broadcast(member), ["id", "key"]).select("root", "n", "cls", "registers", "text")
    dealt = texts.mapInArrow(_elements, "grp binary, n long, cls binary, registers binary, elements binary")
    links = _linked(dealt, CLUSTER_BLOCK, ["registers", "elements"], _by_elements, "links")
    found = components(links).withColumnRenamed("node", "cls")
    joined = reps.where("size > 1").select("cls", "rep", "size").unionAll(reps.where("size = 1").join(maybe_broadcast(written(found.select("cls"), "linked")), "cls", "left_semi").select("cls", "rep", "size"))
    joined = written(joined.join(maybe_broadcast(found), "cls", "left").withColumn("root", F.coalesce("root", "cls")), "joined")
    named = written(joined.groupBy("root").agg(F.min("rep").alias("least"), F.sum("size").alias("rows")), "named")
    label = written(joined.select("cls", "root").join(maybe_broadcast(named), "root").select("cls", "least", "rows"), "classes")
    out = sketch.select("id", "key", "cls").join(maybe_broadcast(label), "cls", "left")
    least = F.coalesce(F.col("least"), F.struct("id", "key"))
    return written(out.select("id", "key", least.alias("least"), F.coalesce("rows", F.lit(1)).cast("long").alias("rows")), "near")


def decisions(docs: DataFrame) -> DataFrame:
    """doc_id, class_id (the least id of its class), class_size, kept (in a class, the row with that id)."""
    found = classes(docs)
    first = F.struct("id", "key") == F.col("least")
    return found.select(shown_id(F.col("id")).alias("doc_id"), shown_id(F.col("least.id")).alias("class_id"), F.col("rows").alias("class_size"), first.alias("kept"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each class, with the columns of docs."""
    found = classes(docs)
    gone = found.where(F.struct("id", "key") != F.col("least")).select(F.col("id").alias("__near_id"), F.col("key").alias("__near_key"))
    rows = docs.withColumns({"__near_id": ordered_id(F.col("doc_id")), "__near_key": F.xxhash64("text")})
    rows = rows.join(maybe_broadcast(written(gone.distinct(), "gone")), ["__near_id", "__near_key"], "left_anti")
    again = found.where("rows > 1").where(F.struct("id", "key") == F.col("least")).groupBy("id", "key").count().where("count > 1")
    if again.take(1):  # rows that repeat a kept one
        one = F.row_number().over(Window.partitionBy("__near_id", "__near_key").orderBy(row_hash(docs)))
        rows = rows.withColumn("__near_turn", one).where("__near_turn = 1")
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
