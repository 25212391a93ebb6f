"""Byte-level BPE encoding and decoding with a hierarchical-bitmap rank queue.

Texts are split by a pattern; each piece becomes a linked list of byte tokens.  A bucket for each merge rank
holds the positions whose pair has that rank; a two-level bitmap over the ranks gives the lowest rank by
find-first-set.  A merge pushes the two new pairs; entries whose pair has changed since are stale and skipped.
Every operation costs the same however long the piece is (but for the heap in a bucket, which keeps leftmost
first), so a pre-token of a megabyte costs O(n log n).

Words repeat, so each worker remembers the ids of words and of pieces, up to CACHE_WORDS
and twice CACHE_PIECES short ones (two generations: pieces in use move to the younger; some 200 bytes each; fewer where a
caller says so); memory is bounded by that and by one Arrow batch.  The vocabulary's bytes are read on the driver from a path that is a parameter and
broadcast once (under 1 MB a vocabulary); nothing is read from an executor's disk.

Defined results: a null text is the empty text, which has no ids; every text decodes to its own UTF-8 bytes;
strings that look like special tokens are ordinary text; repeated rows are coded each; very long texts and pre-tokens are coded
whole; an empty table gives an empty result; other columns pass through, whatever their names.  Texts are cut at single spaces before they are
split, which is right for patterns whose pieces may begin with a space but hold none inside, and never look behind one.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import heapq
import re
import struct
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

CACHE_WORDS, CACHE_PIECES = 150_000, 600_000
CACHED_CHARS = 64


_NONE: dict[int, int] = {}


class Coder:
    """Ids of texts by the ranks of one vocabulary, and back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, pieces: int = CACHE_PIECES) -> None:
        """pieces: as many are remembered, in each of two generations, and at most as many words."""
        import regex

        self.ranks, self.split = ranks, regex.compile(pattern)
        #: Where a text may be cut before it is split: a space after anything but white space starts a new piece.
        self.loose, self.cut = re.compile(r"\s "), re.compile(r"(?<=\S) ")
        self.names: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for name, rank in ranks.items():
            self.names[rank] = name
        #: By left token: right token to the rank of both.
        self.right: list[dict[int, int]] = [_NONE] * len(self.names)
        for name, rank in ranks.items():
            for i in range(1, len(name)):
                a, b = ranks.get(name[:i]), ranks.get(name[i:])
                if a is not None and b is not None:
                    if self.right[a] is _NONE:
                        self.right[a] = {}
                    self.right[a][b] = rank
        self.byte = [ranks[bytes([b])] for b in range(256)]
        #: The rank queue: positions by rank, a bit for each rank in use, a bit for each word of those bits.
        n_words = (len(self.names) >> 8) + 1
        self.buckets: dict[int, list[int]] = {}
        self.words, self.bits = [0] * n_words, [1 << i for i in range(max(256, n_words))]
        self.packed = _Packed(self, pieces)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece; push and pop of the queue are written out, as calls would take most of the time."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        right, buckets, words, bits, top, n = self.right, self.buckets, self.words, self.bits, 0, len(piece)
        token, after, before = list(map(self.byte.__getitem__, piece)), list(range(1, n + 1)), list(range(-1, n - 1))
        left = token[0]
        for i in range(1, n):
            rank = right[left].get(left := token[i])
            if rank is not None:
                if rank in buckets:
                    buckets[rank].append(i - 1)  # in order, so a heap
                else:
                    buckets[rank] = [i - 1]
                    w = rank >> 8
                    words[w] |= bits[rank & 255]
                    top |= bits[w]
        while top:
            w = (top & -top).bit_length() - 1
            word = words[w]
            low = word & -word
            rank = w << 8 | low.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                i = heapq.heappop(bucket)
            else:
                i = bucket[0]
                del buckets[rank]
                words[w] = word = word ^ low
                if not word:
                    top ^= bits[w]
            j = after[i]
            if token[i] < 0 or j >= n or right[token[i]].get(token[j]) != rank:
                continue  # stale
            k = after[i] = after[j]
            token[i], token[j] = rank, -1
            if k < n:
                before[k] = i
                new = right[rank].get(token[k])
                if new is not None:
                    if new in buckets:
                        heapq.heappush(buckets[new], i)
                    else:
                        buckets[new] = [i]
                        w = new >> 8
                        words[w] |= bits[new & 255]
                        top |= bits[w]
            h = before[i]
            if h >= 0:
                new = right[token[h]].get(rank)
                if new is not None:
                    if new in buckets:
                        heapq.heappush(buckets[new], h)
                    else:
                        buckets[new] = [h]
                        w = new >> 8
                        words[w] |= bits[new & 255]
                        top |= bits[w]
        return [t for t in token if t >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        parts = self.cut.split(text) if self.loose.search(text) else text.split(" ")
        return self.packed.ids(parts[0]) + b"".join(map(self.packed.__getitem__, parts[1:]))

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.names.__getitem__, ids))


class _Packed(dict):
    """Packed ids by what follows a space at which a text was cut."""

    def __init__(self, coder: Coder, most: int) -> None:
        super().__init__()
        self.coder, self.most, self.pieces, self.older = coder, most, {}, {}
        self.most_words = min(CACHE_WORDS, most)

    def ids(self, text: str) -> bytes:
        """Of any text, by its pieces."""
        out, coder, known = [], self.coder, self.pieces
        for piece in coder.split.findall(text):
            packed = known.get(piece)
            if packed is None:
                packed = self.older.get(piece)
                if packed is None:
                    ids = coder.merge(piece.encode())
                    packed = struct.pack(f"<{len(ids)}I", *ids)
                if len(piece) <= CACHED_CHARS:
                    if len(known) >= self.most:
                        self.older, self.pieces = known, {}
                        known = self.pieces
                    known[piece] = packed
            out.append(packed)
        return b"".join(out)

    def __missing__(self, part: str) -> bytes:
        packed = self.ids(" " + part)
        if len(part) <= CACHED_CHARS:
            if len(self) >= self.most_words:
                self.clear()
            self[part] = packed
        return packed


def read_ranks(raw: bytes) -> dict[bytes, int]:
    """A rank file: base64 of a token's bytes, then its rank, on each line."""
    return {base64.b64decode(name): int(rank) for name, rank in map(bytes.split, raw.splitlines()) if name}


@functools.lru_cache(maxsize=1)
def _coder(raw: bytes, pattern: str, pieces: int) -> Coder:
    return Coder(read_ranks(raw), pattern, pieces)


def _shipped(df: DataFrame, vocabulary: str, pattern: str, pieces: int = CACHE_PIECES) -> Callable[[], Coder]:
    """What gives a worker its coder, one for all its tasks."""
    with open(vocabulary, "rb") as f:  # the driver's; executors get the bytes
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    return lambda: _coder(sent.value, pattern, pieces)


def _texts(column: pa.Array) -> Iterator[str]:
    return (x.as_py() or "" for x in column)


def encode(df: DataFrame, vocabulary: str, pattern: str, text_col: str = "text", ids_col: str = "ids", pieces: int = CACHE_PIECES, decoded_col: str | None = None) -> DataFrame:
    """df with its ids as array<int> in place of text_col; decoded_col gets the SHA-256 of the bytes that the ids decode to."""
    coder = _shipped(df, vocabulary, pattern, pieces)
    others = [c for c in df.columns if c != text_col]
    more = [decoded_col] if decoded_col else []
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))] + [T.StructField(c, T.StringType()) for c in more])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder()
        for b in batches:
            packed = [c.encode(t) for t in _texts(b.column(text_col))]
            ends = np.cumsum([0, *(len(p) // 4 for p in packed)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), "<i4")))
            sha = [pa.array([hashlib.sha256(c.decode(np.frombuffer(p, "<u4").tolist())).hexdigest() for p in packed], pa.string())] if more else []
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in others), ids, *sha], [*others, ids_col, *more])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: str, pattern: str, ids_col: str = "ids", bytes_col: str = "bytes") -> DataFrame:
    """df with the bytes of its ids as binary in place of ids_col; null ids give no bytes."""
    coder = _shipped(df, vocabulary, pattern)
    others = [c for c in df.columns if c != ids_col]
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(bytes_col, T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder()
        for b in batches:
            out = pa.array([c.decode(x.as_py() or ()) for x in b.column(ids_col)], pa.binary())
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in others), out], [*others, bytes_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, vocabulary: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text encoded, its ids decoded, both hashed in one pass."""
    coder = _shipped(docs, vocabulary, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder()
        for b in batches:
            n, ids_sha, text_sha = [], [], []
            for t in _texts(b.column(1)):
                packed = c.encode(t)
                n.append(len(packed) // 4)
                ids_sha.append(hashlib.sha256(packed).hexdigest())
                text_sha.append(hashlib.sha256(c.decode(np.frombuffer(packed, "<u4").tolist())).hexdigest())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
