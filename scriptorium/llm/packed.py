"""Exchanges of many small values as few packed rows, and documents that meet what is known of their places.

A row is (kind, bucket, meta, data).  meta holds 64-bit columns by byte planes, data byte strings end to end, both
compressed, so that an exchange costs a few bytes a value and the JVM moves and sorts only these rows.  A task packs
what it holds for a bucket whenever it is full; buckets grow in number with the input, so what a reducer holds at once
does not.

Rows are sorted by bucket, kind and a hash of their content before a reducer reads them: its output, and so every
later exchange, is the same when a lost task is run again.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rolling import mix
from .shared import ordered_id

SCHEMA = "kind int, bucket int, meta binary, data binary"
_KIND = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("meta", pa.binary()), ("data", pa.binary())])
#: Kinds of rows in the order in which a reducer reads them.
KEYS, REPLIES, HELD, PLACES, STRINGS, RUNS, TEXTS = range(7)
#: Bytes of text to a bucket, about, until there are MOST buckets (at 4 TB); from there on buckets grow, as a row must hold many
#: values to be worth its overhead.
BUCKET_BYTES, MOST = 8 << 20, 1 << 19
#: Buckets of a small table.
LEAST = 24
#: Bytes of text that a task holds before it packs them.
TEXT_FLUSH = 8 << 20
#: A longer text is looked at in pieces of so many bytes.
PIECE = 8 << 20

Row = tuple[int, int, bytes, bytes | None]


def pack(*columns: np.ndarray) -> bytes:
    n = len(columns[0])
    planes = b"".join(np.ascontiguousarray(c.astype(np.int64, copy=False).view(np.uint8).reshape(n, 8).T).tobytes() for c in columns)
    return struct.pack("<I", n) + zstandard.ZstdCompressor(level=1).compress(planes)


def unpack(raw: bytes, columns: int) -> list[np.ndarray]:
    (n,) = struct.unpack_from("<I", raw)
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[4:]), np.uint8).reshape(columns, 8, n)
    return [np.ascontiguousarray(p.T).view(np.int64).ravel() for p in planes]


def pack_strings(strings: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"".join(strings))


def unpack_strings(raw: bytes, lengths: np.ndarray) -> list[bytes]:
    whole = zstandard.ZstdDecompressor().decompress(raw)
    ends = np.cumsum(lengths).tolist()
    return [whole[a:z] for a, z in zip([0, *ends[:-1]], ends, strict=True)]


def batches_of(rows: Iterator[Row], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    held: list[Row] = []
    size = 0
    for row in rows:
        held.append(row)
        size += len(row[2]) + len(row[3] or b"")
        if size > most:
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), _KIND, strict=True)], schema=_KIND)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*held, strict=True), _KIND, strict=True)], schema=_KIND)


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
    for b in batches:
        kind, bucket, meta, data = b.columns
        for k in range(b.num_rows):
            yield kind[k].as_py(), bucket[k].as_py(), meta[k].as_py(), data[k].as_py()


def grouped_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[Row]]]:
    """(bucket, its rows), in order; a bucket's rows are read as they come."""
    rows = rows_of(batches)
    ahead = next(rows, None)

    def own(bucket: int) -> Iterator[Row]:
        nonlocal ahead
        while ahead is not None and ahead[1] == bucket:
            row = ahead
            ahead = next(rows, None)
            yield row

    while ahead is not None:
        mine = own(ahead[1])
        yield ahead[1], mine
        for _ in mine:
            pass


def split(kind: int, buckets: np.ndarray, columns: list[np.ndarray], order: np.ndarray) -> Iterator[Row]:
    """A row for each bucket, with the columns' values in the given order, by which buckets must be grouped."""
    b = buckets[order]
    cuts = np.flatnonzero(np.diff(b)) + 1
    for a, z in zip([0, *cuts.tolist()], [*cuts.tolist(), len(b)], strict=True):
        if z > a:
            at = order[a:z]
            yield kind, int(b[a]), pack(*(c[at] for c in columns)), None


def of_hash(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets as ranges of 48-bit hashes."""
    return ((hashes.astype(np.uint64) & np.uint64((1 << 48) - 1)) >> np.uint64(16)).astype(np.int64) * buckets >> 32


def of_document(ids: np.ndarray, keys: np.ndarray, buckets: int) -> np.ndarray:
    return of_hash(mix(ids.astype(np.int64).view(np.uint64) ^ mix(keys.astype(np.int64).view(np.uint64))), buckets)


def exchanged(rows: DataFrame) -> DataFrame:
    """Rows of a bucket in one task, in an order that does not depend on which task came first."""
    return rows.withColumn("tie", F.xxhash64("meta")).repartition("bucket").sortWithinPartitions("bucket", "kind", "tie").select("kind", "bucket", "meta", "data")


def documents(docs: DataFrame) -> tuple[DataFrame, int]:
    """(id, key, text of all rows; the number of buckets).  key tells rows that repeat an id apart; where none does, it is 0."""
    text = F.coalesce(F.col("text"), F.lit(""))
    ids = docs.select(ordered_id(F.col("doc_id")).alias("id"), F.octet_length(text).cast("long").alias("size"))
    found = ids.groupBy("id").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size")).agg(F.max("n").alias("n"), F.sum("size").alias("size")).first()
    key: Column = F.xxhash64(text) if (found["n"] or 0) > 1 else F.lit(0).cast("long")
    buckets = max(LEAST, min(MOST, (found["size"] or 0) // BUCKET_BYTES))
    return docs.select(ordered_id(F.col("doc_id")).alias("id"), key.alias("key"), text.alias("text")), buckets


def packed_texts(rows: DataFrame, buckets: int) -> DataFrame:
    """Rows of whole texts by their documents' buckets."""

    def take(ids: list[np.ndarray], keys: list[np.ndarray], texts: list[bytes]) -> Iterator[Row]:
        i, k = np.concatenate(ids), np.concatenate(keys)
        at = of_document(i, k, buckets)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for part in np.split(order, cuts):
            own = [texts[j] for j in part.tolist()]
            yield TEXTS, int(at[part[0]]), pack(i[part], k[part], np.array([len(t) for t in own], np.int64)), pack_strings(own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        ids, keys, texts, size = [], [], [], 0
        for b in batches:
            column = b.column("text")
            for a in range(0, b.num_rows, 256):
                own = [t.as_py().encode() for t in column.slice(a, 256)]
                ids.append(b.column("id").to_numpy()[a : a + 256])
                keys.append(b.column("key").to_numpy()[a : a + 256])
                texts += own
                size += sum(map(len, own))
                if size >= TEXT_FLUSH:
                    yield from take(ids, keys, texts)
                    ids, keys, texts, size = [], [], [], 0
        if texts:
            yield from take(ids, keys, texts)

    return rows.mapInArrow(lambda batches: batches_of(run(batches)), SCHEMA)


class Known:
    """Columns of values by document, as they come for one bucket: id, key and others."""

    def __init__(self, columns: int) -> None:
        self.columns, self.parts = columns, []

    def add(self, meta: bytes) -> None:
        self.parts.append(unpack(meta, self.columns))

    def index(self) -> None:
        """Sort by id, key and the first of the other columns."""
        parts = self.parts or [[np.zeros(0, np.int64)] * self.columns]
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)]
        order = np.lexsort(columns[2::-1])
        self.values = [c[order] for c in columns]
        ids, keys = self.values[:2]
        fresh = np.flatnonzero(np.concatenate([[True], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])])) if len(ids) else np.zeros(0, np.int64)
        self.at = {(i, k): (a, z) for i, k, a, z in zip(ids[fresh].tolist(), keys[fresh].tolist(), fresh.tolist(), np.append(fresh[1:], len(ids)).tolist(), strict=False)}
        self.parts = []

    def of(self, id_: int, key: int) -> list[np.ndarray] | None:
        """A document's other columns."""
        found = self.at.get((id_, key))
        return None if found is None else [c[found[0] : found[1]] for c in self.values[2:]]


def meeting(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[Known, np.ndarray, np.ndarray, list[bytes]]]:
    """For each packed row of texts (what other rows of its bucket say of documents, ids, keys, texts)."""
    for _, rows in grouped_rows(batches):
        known, ready = Known(columns), False
        for kind, _, meta, data in rows:
            if kind != TEXTS:
                known.add(meta)
                continue
            if not ready:
                known.index()
                ready = True
            ids, keys, lengths = unpack(meta, 3)
            yield known, ids, keys, unpack_strings(data, lengths)


def pieces(texts: list, overlap: int) -> tuple[list, np.ndarray, np.ndarray]:
    """Of byte strings or lists: (pieces of at most PIECE items and an overlap, the text each is of, its place in it)."""
    if all(len(t) <= PIECE for t in texts):
        return texts, np.arange(len(texts)), np.zeros(len(texts), np.int64)
    out, owner, base = [], [], []
    for k, t in enumerate(texts):
        for a in range(0, max(1, len(t) - overlap), PIECE):
            out.append(t[a : a + PIECE + overlap])
            owner.append(k)
            base.append(a)
    return out, np.array(owner), np.array(base, np.int64)


class Places:
    """Places of keys in a task's documents: those that the task itself finds shared are known, and one of them goes to tasks elsewhere; of a key
    that it does not find shared all places go, as one document, or rows with one id, may hold it several times.

    A key is 48 bits of a hash: keys that collide are shared by mistake, which costs work and no result, as what is
    shared is compared afterwards."""

    FLUSH = 1_200_000

    def __init__(self, buckets: int, within: bool, gap: int | None = None, ask: bool = False) -> None:
        """within: a key that one document has at two places is shared.  gap: known places so close are sent as one run.
        ask: known places wait until it is known whether their key is common."""
        self.buckets, self.within, self.gap, self.ask = buckets, within, gap, ask
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, hashes: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray) -> None:
        self.parts.append(((hashes & np.uint64((1 << 48) - 1)).view(np.int64), ids, keys, places.astype(np.int64)))
        self.size += len(hashes)

    def full(self) -> bool:
        return self.size >= self.FLUSH

    def take(self) -> Iterator[Row]:
        if not self.size:
            return
        hashes, ids, keys, places = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.parts, self.size = [], 0
        hashes, ids, keys, places, first, size, docs = _by_key(hashes, ids, keys, places)[:7]
        several = _shared(self.within, ids, first, size)
        known = np.repeat(several, size)
        n = np.zeros(len(hashes), np.int64)
        n[first] = np.where(several, np.maximum(np.add.reduceat(docs, first, dtype=np.int64), 2), 1)
        n[~known] = 1  # all places of a key that only documents elsewhere may share
        asked = np.flatnonzero(n > 0)
        yield from split(KEYS, of_hash(hashes, self.buckets), [hashes, ids, keys, places, n], asked)
        mine = np.flatnonzero(known)
        if self.ask and len(mine):
            lead = np.repeat(_lead(hashes[first], ids[first], keys[first], places[first]), size)[mine]
            at = of_hash(lead, self.buckets)
            yield from split(HELD, at, [lead, ids[mine], keys[mine], places[mine]], np.argsort(at, kind="stable"))
            return
        if len(mine):
            yield from known_places(ids[mine], keys[mine], places[mine], places[mine], np.zeros(len(mine), np.int64), self.buckets, self.gap)


def _lead(hashes: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Stands for what a task knows of a key: a hash of the key and of the place that was sent for it."""
    out = np.zeros(len(hashes), np.uint64)
    for c in (hashes, ids, keys, places):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.int64).view(np.uint64))
    return out.view(np.int64)


def _by_key(hashes: np.ndarray, ids: np.ndarray, keys: np.ndarray, places: np.ndarray, *more: np.ndarray) -> tuple:
    """Sorted by all columns, without repeated places; where keys begin, their numbers of places, where documents of a key begin; more."""
    order = np.lexsort((*(-m for m in more), places, keys, ids, hashes))
    hashes, ids, keys, places = hashes[order], ids[order], keys[order], places[order]
    more = tuple(m[order] for m in more)
    fresh, doc = np.ones(len(hashes), bool), np.ones(len(hashes), bool)
    fresh[1:] = hashes[1:] != hashes[:-1]
    doc[1:] = fresh[1:] | (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])
    again = np.zeros(len(hashes), bool)
    again[1:] = ~doc[1:] & (places[1:] == places[:-1])
    if again.any():
        on = ~again
        hashes, ids, keys, places, fresh, doc = hashes[on], ids[on], keys[on], places[on], fresh[on], doc[on]
        more = tuple(m[on] for m in more)
    first = np.flatnonzero(fresh)
    return (hashes, ids, keys, places, first, np.diff(np.concatenate([first, [len(hashes)]])), doc, *more)


def _shared(within: bool, ids: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    return size > 1 if within else ids[first + size - 1] > ids[first]


def known_places(ids: np.ndarray, keys: np.ndarray, places: np.ndarray, upto: np.ndarray, common: np.ndarray, buckets: int, gap: int | None) -> Iterator[Row]:
    """Rows of places (id, key, place, last place of a run, whether its key is common) by document."""
    at = of_document(ids, keys, buckets)
    order = np.lexsort((places, keys, ids, at))
    if gap is not None:
        i, k, p, u = ids[order], keys[order], places[order], upto[order]
        head = np.ones(len(order), bool)
        head[1:] = (i[1:] != i[:-1]) | (k[1:] != k[:-1]) | (p[1:] - u[:-1] > gap)
        ends = np.concatenate([np.flatnonzero(head)[1:], [len(order)]]) - 1
        upto = upto.copy()
        upto[order[head]] = u[ends]
        order = order[head]
    yield from split(PLACES, at, [ids, keys, places, upto, common], order)


def shared_places(rows: DataFrame, buckets: int, within: bool, gap: int | None = None, hot: int | None = None) -> DataFrame:
    """Rows of KEYS become rows of PLACES: the places of keys that occur twice; others pass.

    With hot, a place is common if more than so many documents hold its key; those that a task knew to be shared
    wait for an answer to the place that was sent for them, so that no task gets all places of a key."""

    def one(metas: list[bytes]) -> Iterator[Row]:
        columns = [np.concatenate(x) for x in zip(*(unpack(m, 5) for m in metas), strict=True)]
        hashes, ids, keys, places, first, size, _, n = _by_key(*columns)
        held = np.add.reduceat(n, first)
        told = np.maximum.reduceat(n, first) > 1
        on = np.repeat(told | _shared(within, ids, first, size), size)
        common = np.repeat(held > hot, size) if hot else np.zeros(len(hashes), bool)
        at = np.flatnonzero(on)
        if len(at):
            yield from known_places(ids[at], keys[at], places[at], places[at], common[at].astype(np.int64), buckets, gap)
        at = np.flatnonzero(common & (n > 1))
        if len(at):
            lead = _lead(hashes[at], ids[at], keys[at], places[at])
            b = of_hash(lead, buckets)
            yield from split(REPLIES, b, [lead], np.argsort(b, kind="stable"))

    def answered(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        for _, own in grouped_rows(batches):
            replies, common = [], None
            for row in own:
                if row[0] == REPLIES:
                    replies += unpack(row[2], 1)
                elif row[0] == HELD:
                    if common is None:
                        common = np.unique(np.concatenate(replies)) if replies else np.zeros(0, np.int64)
                    lead, ids, keys, places = unpack(row[2], 4)
                    yield from known_places(ids, keys, places, places, np.isin(lead, common).astype(np.int64), buckets, None)
                else:
                    yield row

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[Row]:
        for _, own in grouped_rows(batches):
            metas = []
            for row in own:
                if row[0] == KEYS:
                    metas.append(row[2])
                else:
                    yield row
            if metas:
                yield from one(metas)

    out = exchanged(rows).mapInArrow(lambda batches: batches_of(run(batches)), SCHEMA)
    return exchanged(out).mapInArrow(lambda batches: batches_of(answered(batches)), SCHEMA) if hot else out


def regions(found: list[np.ndarray] | None, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """(starts, ends) of a document's places, those at most gap apart joined."""
    if found is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at, upto = found[0], np.maximum.accumulate(np.maximum(found[0], found[1]))
    cut = np.flatnonzero(at[1:] - upto[:-1] > gap)
    return at[np.concatenate([[0], cut + 1])], upto[np.concatenate([cut, [len(at) - 1]])]


def inside(places: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which places lie in one of the regions, which are in order."""
    if not len(starts):
        return np.zeros(len(places), bool)
    at = np.searchsorted(starts, places, "right") - 1
    return (at >= 0) & (places <= ends[np.maximum(at, 0)])


def runs_by_document(ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, lengths: np.ndarray, buckets: int) -> Iterator[Row]:
    """Rows of runs of windows (id, key, first start, number)."""
    if len(ids):
        at = of_document(ids, keys, buckets)
        yield from split(RUNS, at, [ids, keys, starts, lengths], np.lexsort((starts, keys, ids, at)))
