"""Substring deduplication by difference-cover anchors.

A window is WIDTH consecutive words.  COVER is a difference cover modulo PERIOD: for any two positions some
shift under PERIOD brings both to positions in COVER.  So of any two equal windows, both contain an anchor (a
span of WIDTH - PERIOD + 1 words that starts at a position in COVER) at the same distance from their starts.
Only these spans, 6 of 31, are hashed and exchanged.  Anchors that several documents hold are extended: the
windows that contain one are told apart by a cryptographic digest of their words (128 bits of BLAKE2), and a window
whose words also start in a document with a smaller id is a repeat.  A task sends each anchor and each window once, for its
smallest id; what it can decide itself it does.  No pairs are formed.  Values travel as packed rows (packed).

Defined results: a null text has no words; documents of fewer words than WIDTH keep everything; documents with
the same id do not repeat each other; a null id orders before all others; an empty table gives an empty result; very long
texts are looked at in overlapping pieces; columns other than doc_id and text are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import packed
from .rolling import covered, grouped, runs, spans_of, word_hashes
from .shared import shown_id

WIDTH = 50
PERIOD = 31
COVER = (1, 5, 11, 24, 25, 27)
SPAN = WIDTH - PERIOD + 1
GROUP_WORDS = 1 << 18
FLUSH_WINDOWS = 600_000


class _Words:
    """Texts or pieces of at least WIDTH words."""

    def __init__(self, texts: list[list[bytes]], base: np.ndarray) -> None:
        self.texts = texts
        self.counts = np.array([len(t) for t in texts], np.int64)
        self.offsets = np.cumsum(self.counts) - self.counts
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        self.part = np.arange(len(self.owner)) - self.offsets[self.owner]  # of a word in its piece
        self.place = self.part + base[self.owner]  # in its document

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Word indices of the anchors, and their hashes."""
        at = np.flatnonzero(np.isin(self.place % PERIOD, COVER) & (self.part + SPAN <= self.counts[self.owner]))
        return at, spans_of(word_hashes([w for t in self.texts for w in t]), SPAN)[at]

    def digests(self, on: np.ndarray) -> np.ndarray:
        """Two numbers for each of the windows that start at some words."""
        words = [w for t in self.texts for w in t]
        ends = np.cumsum(np.array([len(w) + 1 for w in words], np.int64))
        raw = memoryview(b" ".join(words))
        first, last = (ends[on] - np.array([len(words[k]) + 1 for k in on.tolist()], np.int64)).tolist(), (ends[on + WIDTH - 1] - 1).tolist()
        digest = hashlib.blake2b
        return np.frombuffer(b"".join([digest(raw[a:z], digest_size=16).digest() for a, z in zip(first, last, strict=True)]), np.int64).reshape(-1, 2)


def _groups(texts: list[bytes]) -> Iterator[tuple[_Words, np.ndarray]]:
    """(some texts or pieces, the text of each)."""
    parts, owner, base = packed.pieces([t.split() for t in texts], WIDTH - 1)
    for a, z in grouped([len(t) for t in parts], GROUP_WORDS):
        long = [i for i in range(a, z) if len(parts[i]) >= WIDTH]
        if long:
            yield _Words([parts[i] for i in long], base[long]), owner[long]


def _anchors(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    held = packed.Places(buckets, within=False, gap=PERIOD)
    for b in batches:
        ids, keys = b.column("id").to_numpy(), b.column("key").to_numpy()
        for i in range(0, b.num_rows, 256):
            for w, rows in _groups([t.as_py().encode() for t in b.column("text").slice(i, 256)]):
                at, hashes = w.anchors()
                doc = i + rows[w.owner[at]]
                held.add(hashes, ids[doc], keys[doc], w.place[at])
                if held.full():
                    yield from held.take()
    yield from held.take()


def _later(digests: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows also start in a document with a smaller id; of the others, which come first in id."""
    order = np.lexsort((ids, digests[:, 1], digests[:, 0]))
    d, i = digests[order], ids[order]
    first = np.concatenate([[True], (d[1:] != d[:-1]).any(1)])
    least = i[first][np.cumsum(first) - 1]
    later = np.empty(len(ids), bool)
    later[order] = i > least
    return later, ~later


def _runs(ids: np.ndarray, keys: np.ndarray, start: np.ndarray, buckets: int) -> Iterator[packed.Row]:
    """Rows of windows, neighbours as one run."""
    if len(ids):
        order = np.lexsort((start, keys, ids))
        ids, keys, start = ids[order], keys[order], start[order]
        fresh = np.concatenate([[True], (start[1:] != start[:-1]) | (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])])
        ids, keys, start = ids[fresh], keys[fresh], start[fresh]
        owner = np.cumsum(np.concatenate([[0], (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1])]))
        head, size = runs(start, owner)
        yield from packed.runs_by_document(ids[head], keys[head], start[head], size, buckets)


def _decide(parts: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[packed.Row]:
    """Windows (digests, id, key, start): those of the smallest id once for each id and key; the rest are known repeats."""
    digests, ids, keys, start = (np.concatenate(x) for x in zip(*parts, strict=True))
    later, ask = _later(digests, ids)
    ask = np.flatnonzero(ask)
    at = packed.of_hash(digests[ask, 0], buckets)
    order = np.lexsort((start[ask], keys[ask], ids[ask], digests[ask, 0], at))
    yield from packed.split(packed.STRINGS, at, [digests[ask, 0], digests[ask, 1], ids[ask], keys[ask], start[ask]], order)
    yield from _runs(ids[later], keys[later], start[later], buckets)


def _windows(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    parts, size = [], 0
    for known, ids, keys, texts in packed.meeting(batches, 5):
        found = [known.of(i, k) for i, k in zip(ids.tolist(), keys.tolist(), strict=True)]
        some = [j for j, f in enumerate(found) if f is not None]
        for w, rows in _groups([texts[j] for j in some]):
            rows = np.array(some)[rows]
            # a window contains an anchor if it starts at most PERIOD - 1 words before it
            on = w.part + WIDTH <= w.counts[w.owner]
            for k, j in enumerate(rows.tolist()):
                part = slice(w.offsets[k], w.offsets[k] + w.counts[k])
                starts, ends = packed.regions(found[j], PERIOD)
                on[part] &= packed.inside(w.place[part], starts - PERIOD + 1, ends)
            on = np.flatnonzero(on)
            if not len(on):
                continue
            doc = rows[w.owner[on]]
            parts.append((w.digests(on), ids[doc], keys[doc], w.place[on]))
            size += len(on)
            if size >= FLUSH_WINDOWS:
                yield from _decide(parts, buckets)
                parts, size = [], 0
    if parts:
        yield from _decide(parts, buckets)


def _compared(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[packed.Row]:
    for _, rows in packed.grouped_rows(batches):
        metas = []
        for row in rows:
            if row[0] == packed.STRINGS:
                metas.append(packed.unpack(row[2], 5))
            else:
                yield row
        if metas:
            one, two, ids, keys, start = (np.concatenate(c) for c in zip(*metas, strict=True))
            later = _later(np.stack([one, two], 1), ids)[0]
            yield from _runs(ids[later], keys[later], start[later], buckets)


def _repeats(docs: DataFrame) -> DataFrame:
    """Packed rows of runs of repeated windows, and of texts, by document."""
    rows, buckets = packed.documents(docs)
    texts = packed.packed_texts(rows, buckets)
    places = rows.mapInArrow(lambda b: packed.batches_of(_anchors(b, buckets)), packed.SCHEMA)
    # two anchors at most PERIOD apart may be in one window; what lies between is looked at as well
    places = packed.shared_places(places, buckets, within=False, gap=PERIOD)
    dealt = packed.exchanged(places.unionAll(texts)).mapInArrow(lambda b: packed.batches_of(_windows(b, buckets)), packed.SCHEMA)
    found = packed.exchanged(dealt).mapInArrow(lambda b: packed.batches_of(_compared(b, buckets)), packed.SCHEMA)
    return packed.exchanged(found.unionAll(texts))


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, list[bytes]]]:
    """A document's id, its number of words, and those that stay."""
    for known, ids, keys, texts in packed.meeting(batches, 4):
        for i, k, text in zip(ids.tolist(), keys.tolist(), texts, strict=True):
            words, found = text.split(), known.of(i, k)
            if found is None:
                yield i, len(words), words
            else:
                yield i, len(words), [words[j] for j in np.flatnonzero(~covered(*found, WIDTH, len(words)))]


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names, types = ["doc_id", "n_words", "n_removed", "kept_sha256"], [pa.int64()] * 3 + [pa.string()]
    out: list[tuple] = []
    for i, n, kept in _kept(batches):
        out.append((i, n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        if len(out) >= 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for i, _, kept in _kept(batches):
        yield pa.RecordBatch.from_arrays([pa.array([i], pa.int64()), pa.array([b" ".join(kept).decode()], pa.string())], ["doc_id", "text"])


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256."""
    return _repeats(docs).mapInArrow(_digests, "doc_id long, n_words long, n_removed long, kept_sha256 string").withColumn("doc_id", shown_id(F.col("doc_id")))


def removed(docs: DataFrame) -> DataFrame:
    """doc_id, text: the words that stay, joined by one space."""
    return _repeats(docs).mapInArrow(_texts, "doc_id long, text string").withColumn("doc_id", shown_id(F.col("doc_id")))
