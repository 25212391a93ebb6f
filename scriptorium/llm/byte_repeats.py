"""Suffix-array dedup: bytes of strings of WIDTH that also start earlier are removed.

1. Sampling.  Of each window of WIDTH bytes one SEED-byte string is its minimizer: the leftmost of least hash.
   Equal windows have equal minimizers.  About one position in 31 is one; their hashes are exchanged, once a task
   and hash, and those that occur twice anywhere are shared.
2. Sharding.  Windows with a shared minimizer go to its shard, neighbours as one string.  A task sends each
   string once, for its earliest place, and marks the other places itself.  The windows of a minimizer that
   more than HOT documents hold are dealt by the minimizers of their first and last EDGE bytes as well, so that
   strings of one shard differ only in the few bytes that none of the three covers, and no shard grows with one passage.
3. Of equal strings in a shard all but the first are repeats.  A shard's other strings are sorted by induced sorting (suffix_arrays); permuted common prefixes of WIDTH bytes
   or more join neighbours, and all places but a group's first are repeats.

Values travel as packed rows (packed).  A shard's task takes whole minimizers, about CHUNK bytes at a time, and very
long texts are read in pieces, so memory is bounded.  Hashes only bring strings together: what repeats is decided
by comparing bytes.

Defined results: a null text is empty; texts under WIDTH bytes keep everything; matches never cross documents;
rows with the same id do not repeat each other, but each of them may repeat itself; a null id orders before
all others; an empty table gives an empty result; columns other than doc_id and text are not read, whatever their
names.  Cuts may split a character: results are bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .rolling import covered, every, grouped, mix, runs, sliding_min
from .shared import shown_id
from .suffix_arrays import common_prefixes, suffix_array

WIDTH = 100
SEED = 40
EDGE = 56  # bytes at a window's ends that deal the windows of common minimizers
GROUP_BYTES = 1 << 20
CHUNK = 2 << 20
#: Documents whose strings of one minimizer surely fit a chunk.
HOT = CHUNK // 256
HELD = 24 << 20  # bytes of strings that a task holds before it sends them
_PLACE = np.uint64((1 << 28) - 1)


class _Bytes:
    """Texts or pieces of at least WIDTH bytes in one buffer."""

    def __init__(self, texts: list[bytes]) -> None:
        self.raw = b"".join(texts)
        self.buffer = np.frombuffer(self.raw, np.uint8)
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.sizes) - self.sizes
        self.seeds = every(self.buffer, SEED)
        self.packed = (self.seeds & ~_PLACE) | np.arange(len(self.seeds), dtype=np.uint64)
        windows = self.sizes - WIDTH + 1
        self.owner = np.repeat(np.arange(len(texts)), windows)
        self.starts = np.arange(len(self.owner)) + (self.offsets - np.cumsum(windows) + windows)[self.owner]
        self.minimizer = (sliding_min(self.packed, WIDTH - SEED + 1)[self.starts] & _PLACE).astype(np.int64)

    def edges(self, on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in the buffer of the minimizers of the first and of the last EDGE bytes of some windows."""
        least = sliding_min(self.packed, EDGE - SEED + 1) & _PLACE
        return least[self.starts[on]].astype(np.int64), least[self.starts[on] + WIDTH - EDGE].astype(np.int64)


def _groups(texts: list[bytes]) -> Iterator[tuple[_Bytes, np.ndarray, np.ndarray]]:
    """(some pieces of texts, the text of each, its place in the text)."""
    parts, owner, base = packed.pieces(texts, WIDTH - 1)
    for a, z in grouped([len(t) for t in parts], GROUP_BYTES):
        long = [i for i in range(a, z) if len(parts[i]) >= WIDTH]
        if long:
            yield _Bytes([parts[i] for i in long]), owner[long], base[long]


def _minimizers(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    held = packed.Places(buckets, within=True, ask=True)
    for b in batches:
        ids, keys = b.column("id").to_numpy(), b.column("key").to_numpy()
        for i in range(0, b.num_rows, 256):
            for d, rows, base in _groups([t.as_py().encode() for t in b.column("text").slice(i, 256)]):
                first = np.flatnonzero(np.concatenate([[True], (np.diff(d.minimizer) != 0) | (np.diff(d.owner) != 0)]))
                at, owner = d.minimizer[first], d.owner[first]
                held.add(d.seeds[at], ids[i + rows[owner]], keys[i + rows[owner]], at - d.offsets[owner] + base[owner])
                if held.full():
                    yield from held.take()
    yield from held.take()


class _Held:
    """Strings of a task, each once for its earliest place; what repeats them is known here."""

    def __init__(self, buckets: int) -> None:
        self.buckets = buckets
        self.clear()

    def clear(self) -> None:
        self.first: dict[tuple[bytes, int], tuple[int, int, int, int]] = {}
        self.asked: list[tuple] = []
        self.known: list[tuple] = []
        self.bytes = 0

    def add(self, string: bytes, slot: int, id_: int, key: int, start: int, length: int) -> None:
        old = self.first.get((string, slot))
        if old is None:
            self.first[string, slot] = (id_, key, start, length)
            self.bytes += len(string) + 250
        elif id_ == old[0] and key != old[1]:
            self.asked.append((slot, id_, key, start, length, string))
            self.bytes += len(string) + 150
        else:
            later = (id_, key, start)
            if later == old[:3]:  # a repeated row
                return
            if later < old[:3]:
                self.first[string, slot], later = (*later, length), old[:3]
            if later[0] == old[0] == id_ or later[0] > min(old[0], id_):
                self.known.append((*later, length))
                self.bytes += 150

    def rows(self) -> Iterator[packed.Row]:
        out = self.asked + [(slot, *place, string) for (string, slot), place in self.first.items()]
        if out:
            slot, ids, keys, starts, lengths = (np.array(c, np.int64) for c in list(zip(*out, strict=True))[:5])
            at = packed.of_hash(slot, self.buckets)
            order = np.lexsort((starts, ids, slot, at))
            for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
                strings = [out[j][5] for j in part.tolist()]
                meta = packed.pack(slot[part], ids[part], keys[part], starts[part], np.array([len(s) for s in strings], np.int64))
                yield packed.STRINGS, int(at[part[0]]), meta, packed.pack_strings(strings)
        if self.known:
            yield from packed.runs_by_document(*np.array(self.known, np.int64).T, self.buckets)
        self.clear()


def _strings(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    held = _Held(buckets)
    for known, ids, keys, texts in packed.meeting(batches, 5):
        found = [known.of(i, k) for i, k in zip(ids.tolist(), keys.tolist(), strict=True)]
        some = [j for j, f in enumerate(found) if f is not None]
        for d, rows, base in _groups([texts[j] for j in some]):
            rows = np.array(some)[rows]
            place = d.minimizer - d.offsets[d.owner] + base[d.owner]
            on, common = np.zeros(len(place), bool), np.zeros(len(place), bool)
            ends = np.searchsorted(d.owner, np.arange(len(rows) + 1))
            for k, j in enumerate(rows.tolist()):
                part = slice(ends[k], ends[k + 1])
                # minimizers of neighbouring windows are at most WIDTH - SEED + 1 apart; what lies between shared ones goes along
                on[part] = packed.inside(place[part], *packed.regions(found[j], WIDTH - SEED + 1))
                hot = found[j][0][found[j][2] > 0]
                if len(hot):
                    common[part] = np.isin(place[part], hot)
            at = np.flatnonzero(on)
            if not len(at):
                continue
            slot = mix(d.seeds[d.minimizer])
            run = d.minimizer[at]
            if (hot := common[at]).any():
                left, right = d.edges(at)
                slot[at[hot]] = mix(slot[at[hot]] ^ mix(d.seeds[left[hot]] + np.uint64(1)) ^ mix(mix(d.seeds[right[hot]])))
                # neighbours with the same three minimizers are one string
                run = np.cumsum(np.concatenate([[True], (run[1:] != run[:-1]) | (hot[1:] & ((left[1:] != left[:-1]) | (right[1:] != right[:-1])))]))
            first, size = runs(d.starts[at], run)
            owner = d.owner[at[first]]
            start = d.starts[at[first]]
            table = zip(start.tolist(), size.tolist(), slot[at[first]].view(np.int64).tolist(), ids[rows[owner]].tolist(), keys[rows[owner]].tolist(), (start - d.offsets[owner] + base[owner]).tolist(), strict=True)
            for at_, n, slot_, id_, key_, start_ in table:
                held.add(d.raw[at_ : at_ + n + WIDTH - 1], slot_, id_, key_, start_, n)
            if held.bytes >= HELD:
                yield from held.rows()
    yield from held.rows()


def _later(group: np.ndarray, ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Which places of a group have an earlier one: a smaller id, or an earlier start in the same document."""
    order = np.lexsort((starts, keys, ids, group))
    g, i, k, a = group[order], ids[order], keys[order], starts[order]
    fresh = np.concatenate([[True], g[1:] != g[:-1]])
    least = i[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    again = np.concatenate([[False], (g[1:] == g[:-1]) & (i[1:] == i[:-1]) & (k[1:] == k[:-1])])
    head = np.maximum.accumulate(np.where(again, 0, np.arange(len(a))))
    out = np.empty(len(a), bool)
    out[order] = (i > least) | (a > a[head])
    return out


def _sorted_repeats(strings: list[bytes], ids: np.ndarray, keys: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """id, key, start, length: runs of repeated windows among the strings of whole minimizers."""
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.int16) + 1
    sizes = np.array([len(s) + 1 for s in strings], np.int64)
    ends = np.cumsum(sizes)
    text[ends - 1] = 0  # a symbol below every byte
    heads = np.zeros(len(text), bool)
    heads[ends - sizes] = True
    order = suffix_array(text, WIDTH)
    owner = np.repeat(np.arange(len(strings)), sizes)
    shared = common_prefixes(text, order, 2 * WIDTH, heads) >= WIDTH
    whole = order + WIDTH < ends[owner[order]]
    group = np.cumsum(~shared)
    at, group = order[whole], group[whole]
    many = np.bincount(group)[group] > 1
    at, group = at[many], group[many]
    if not len(at):
        return (np.zeros(0, np.int64),) * 4
    o = owner[at]
    place = starts[o] + at - (ends - sizes)[o]
    gone = _later(group, ids[o], keys[o], place)
    at = np.sort(at[gone])
    o = owner[at]
    first, size = runs(at, o)
    o, at = o[first], at[first]
    return ids[o], keys[o], starts[o] + at - (ends - sizes)[o], size


def _shard(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    def sort(slots: np.ndarray, ids: np.ndarray, keys: np.ndarray, starts: np.ndarray, strings: list[bytes]) -> Iterator[packed.Row]:
        number: dict[tuple[int, bytes], int] = {}
        equal = np.array([number.setdefault(x, len(number)) for x in zip(slots.tolist(), strings, strict=True)], np.int64)
        gone = _later(equal, ids, keys, starts)
        size = np.array([len(s) for s in strings], np.int64)
        yield from packed.runs_by_document(ids[gone], keys[gone], starts[gone], size[gone] - WIDTH + 1, buckets)
        # Windows of one minimizer's place differ from each other, so a shard's only string needs no sorting.
        order = np.flatnonzero(~gone)
        order = order[np.argsort(slots[order], kind="stable")]
        fresh = np.concatenate([[True], np.diff(slots[order]) != 0])
        order = order[np.diff(np.concatenate([np.flatnonzero(fresh), [len(order)]]))[np.cumsum(fresh) - 1] > 1]
        upto, slots, a = np.cumsum(size[order]), slots[order], 0
        while a < len(order):  # whole slots, about CHUNK bytes each time
            z = int(np.searchsorted(upto, (upto[a - 1] if a else 0) + CHUNK, "right"))
            z = int(np.searchsorted(slots, slots[min(max(z, a + 1), len(order)) - 1], "right"))
            part = order[a:z]
            yield from packed.runs_by_document(*_sorted_repeats([strings[j] for j in part.tolist()], ids[part], keys[part], starts[part]), buckets)
            a = z

    for _, rows in packed.grouped_rows(batches):
        metas, strings = [], []
        for row in rows:
            if row[0] != packed.STRINGS:
                yield row
                continue
            metas.append(packed.unpack(row[2], 5))
            strings += packed.unpack_strings(row[3], metas[-1][4])
        if metas:
            yield from sort(*(np.concatenate(c) for c in list(zip(*metas, strict=True))[:4]), strings)


def _repeats(docs: DataFrame) -> DataFrame:
    """Packed rows of runs of repeated windows, and of texts, by document."""
    rows, buckets = packed.documents(docs)
    texts = packed.packed_texts(rows, buckets)
    places = rows.mapInArrow(lambda b: packed.batches_of(_minimizers(b, buckets)), packed.SCHEMA)
    places = packed.shared_places(places, buckets, within=True, hot=HOT)
    dealt = packed.exchanged(places.unionAll(texts)).mapInArrow(lambda b: packed.batches_of(_strings(b, buckets)), packed.SCHEMA)
    found = packed.exchanged(dealt).mapInArrow(lambda b: packed.batches_of(_shard(b, buckets)), packed.SCHEMA)
    return packed.exchanged(found.unionAll(texts))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, bytes, np.ndarray]]:
    """A document's id, its bytes, and which of them go."""
    for known, ids, keys, texts in packed.meeting(batches, 4):
        for i, k, raw in zip(ids.tolist(), keys.tolist(), texts, strict=True):
            found = known.of(i, k)
            yield i, raw, np.zeros(len(raw), bool) if found is None else covered(*found, WIDTH, len(raw))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"], [pa.int64()] * 4 + [pa.string()]
    out: list[tuple] = []
    for i, raw, gone in _kept(batches):
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8)) == 1) + (len(gone) and gone[0]))
        out.append((i, len(raw), int(gone.sum()), spans, hashlib.sha256(np.frombuffer(raw, np.uint8)[~gone].tobytes()).hexdigest()))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def _left(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for i, raw, gone in _kept(batches):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([np.frombuffer(raw, np.uint8)[~gone].tobytes()], pa.binary())], ["doc_id", "kept"])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    found = _repeats(docs).mapInArrow(_digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return found.withColumn("doc_id", shown_id(F.col("doc_id")))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, kept: the bytes that stay."""
    return _repeats(docs).mapInArrow(_left, "doc_id long, kept binary").withColumn("doc_id", shown_id(F.col("doc_id")))
