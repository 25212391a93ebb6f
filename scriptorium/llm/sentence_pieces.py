"""SentencePiece encoding that keeps offsets, and decoding, from a model file of the BPE kind.

A text is normalised by the longest prefix in the model's compiled character map; each character of the result knows at which source byte it
begins.  Spaces become U+2581, and one is put before the text if the model says so.  Pieces come from merging the best scored, then leftmost,
neighbours; what the vocabulary lacks falls back to byte pieces.  Every piece is projected to the source's bytes: piece i covers the bytes from where its first
character begins to where the next piece's does, so the spans of a text follow one another (a character's byte pieces are empty but for the last).

No piece of a vocabulary that allows it has a space after another character, so what lies before and after such a place merges apart; the same holds
beside characters that no longer piece has.  Texts are cut there, and a worker remembers what a cut part becomes, up to CACHED parts of at most
CACHED_CHARS in each of two generations.  A vocabulary that has such pieces is merged in whole texts; a model that has a map, strips spaces or has no byte pieces, and a
text with U+2581 in it, takes each text as one.  Short parts that are new are merged side by side, a row of an array each; a heap of pairs
makes a part of any length cost O(n log n).  The model's bytes are read on the driver from a path that is a parameter and broadcast (under 1 MB).

Defined results: a null text is the empty text, which has the begin and end ids alone; strings that look like control pieces are ordinary text;
repeated rows are coded each; very long texts are coded whole; an empty table gives an empty result; other columns pass through, whatever their names.
Models of another kind, or with unused or user-defined pieces or a map for decoding, raise ValueError."""

from __future__ import annotations

import codecs
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

CACHED, CACHED_CHARS = 400_000, 64
#: Characters of text whose parts are looked up together; parts that are merged in one block.
AT_ONCE, ROWS = 1_000_000, 8192
SPACE = "▁"
#: Fixed values of the model format: kinds of pieces, and the kind of model that merges pairs.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Numbers and values of a message's fields."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            b = raw[at]
            at += 1
            value |= (b & 127) << shift
            if b < 128:
                return value
            shift += 7

    while at < len(raw):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
        else:
            size = varint() if kind == 2 else 8 if kind == 1 else 4
            yield key >> 3, raw[at : at + size]
            at += size


class CharacterMap:
    """A compiled map: a trie of 32-bit units (its size first), then the replacements, each ended by a zero byte.  The low byte of a unit and its
    top bit must be the label that led to it, bit 8 tells that a key ends there, and the rest is where its children lie, by exclusive or; the
    replacement's place is at a key's child of label 0."""

    def __init__(self, blob: bytes) -> None:
        size = int.from_bytes(blob[:4], "little")
        units = np.frombuffer(blob[4 : 4 + size], "<u4").astype(np.int64)
        self.label = (units & (1 << 31 | 255)).tolist()
        self.below = ((units >> 10) << ((units & 1 << 9) >> 6)).tolist()
        self.leaf = (units >> 8 & 1).tolist()
        self.place = (units & (1 << 31) - 1).tolist()
        self.texts = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[str, int] | None:
        """The replacement of the longest key that begins at a byte, and the key's length; None if there is no key."""
        node, found, n = self.below[0], None, 0
        for k in range(at, len(raw)):
            child = node ^ raw[k]
            if child >= len(self.label) or self.label[child] != raw[k]:
                break
            node = child ^ self.below[child]
            if self.leaf[child]:
                found, n = self.place[node], k + 1 - at
        return (self.texts[found : self.texts.index(b"\0", found)].decode(), n) if n else None


class Model:
    """Encodes texts and decodes ids by one model file."""

    def __init__(self, raw: bytes, cached: int = CACHED) -> None:
        pieces, trainer, normal = [], {}, {}
        for n, value in _fields(raw):
            if n == 1:
                p = {1: b"", 2: b"\0" * 4, 3: NORMAL} | dict(_fields(value))
                pieces.append((p[1].decode(), struct.unpack("<f", p[2])[0], p[3]))
            elif n in (2, 3, 5):
                spec = dict(_fields(value))
                trainer, normal = (spec, normal) if n == 2 else (trainer, spec) if n == 3 else (trainer, normal)
                if n == 5 and spec.get(2):
                    raise ValueError("maps for decoding are not supported")
        kinds = {kind for _, _, kind in pieces}
        if trainer.get(3, 1) != BPE or kinds & {USER_DEFINED, UNUSED}:
            raise ValueError("only models of the BPE kind without user-defined or unused pieces are supported")
        self.names = [name for name, _, _ in pieces]
        self.kinds = [kind for _, _, kind in pieces]
        self.ids = {name: i for i, (name, _, kind) in enumerate(pieces) if kind == NORMAL}
        self.controls = {i for i, kind in enumerate(self.kinds) if kind == CONTROL}
        self.unknown = self.kinds.index(UNKNOWN)
        self.begin, self.end = trainer.get(41, 1), trainer.get(42, 2)
        self.surface = trainer.get(44, " ⁇ ".encode()).decode()
        fallback = {int(name[3:5], 16): i for i, (name, _, kind) in enumerate(pieces) if kind == BYTE}
        self.fallback = [fallback[b] for b in range(256)] if trainer.get(35, 0) else None
        order = {score: k for k, score in enumerate(sorted({score for _, score, _ in pieces}, reverse=True))}
        self.rank = {name: order[score] for name, score, kind in pieces if kind == NORMAL}
        self.dummy, self.strip, self.suffix = bool(normal.get(3, 1)), bool(normal.get(4, 1)), bool(trainer.get(24, 0))
        self.escape = SPACE if normal.get(5, 1) else " "
        self.map = CharacterMap(normal[2]) if normal.get(2) else None
        #: Parts that merge apart.  inner: characters of pieces longer than one; others always stay alone.
        inner = {c for name in self.ids if len(name) > 1 for c in name}
        alone = "".join(re.escape(chr(c)) for c in range(128) if chr(c) not in inner and c != 32)
        mixed = any(re.search(f"[^{self.escape}]{self.escape}", name) for name in self.ids)
        spaces = f" {SPACE}" if self.escape == SPACE else " "
        self.parts = re.compile("(?s).+" if mixed else f"[{spaces}]*[^{spaces}{alone}]+|[{spaces}]+" + (f"|[{alone}]" if alone else ""))
        self.apart = not (self.map or self.strip or self.suffix or mixed) and self.fallback is not None
        self.known = _Parts(self, cached)
        #: Every two pieces that make one: their ids as one number, in order, and the id that they make; the rank of ids.
        made = sorted((a << 32 | b, i) for name, i in self.ids.items() for k in range(1, len(name)) if (a := self.ids.get(name[:k])) is not None and (b := self.ids.get(name[k:])) is not None)
        self.pairs, self.makes = np.array([x for x, _ in made] or [-1], np.int64), np.array([i for _, i in made] or [0], np.int64)
        self.rank_of = np.array([order[score] for _, score, _ in pieces], np.int64)
        #: Source bytes of a piece; of byte pieces, as leads, how many make their character.
        self.width = np.array([len(name.replace(SPACE, " ").encode()) if kind == NORMAL else 0 for name, kind in zip(self.names, self.kinds)], np.int64)
        self.lead = np.zeros(len(pieces), np.int64)
        for b, i in fallback.items():
            self.lead[i] = 1 if b < 128 else 0 if b < 192 else 2 if b < 224 else 3 if b < 240 else 4
        self.bytes_ = [bytes([int(n[3:5], 16)]) if k == BYTE else b"" if k == CONTROL else self.surface.encode() if k == UNKNOWN else n.replace(SPACE, " ").encode() for n, k in zip(self.names, self.kinds)]

    def normalised(self, text: str) -> tuple[str, list[int]]:
        """The text as it is merged, and the source byte at which each of its characters begins, with the end last."""
        out: list[str] = []
        at: list[int] = []
        consumed = 0
        gap = self.strip  # spaces that follow a space go, and those at the start
        pieces = self._replaced(text)
        if not text:
            return "", [0]
        first = True
        for new, old in pieces:
            if first and self.strip and new == " ":
                consumed += old
                continue
            if first:
                if self.dummy and not self.suffix:
                    out.append(self.escape)
                    at.append(consumed)
                first = False
            if gap:
                new = new.lstrip(" ")
            if new:
                out.append(new.replace(" ", self.escape))
                at.extend([consumed] * len(new))
                gap = self.strip and new.endswith(" ")
            consumed += old
        if first:
            return "", [consumed]
        done = "".join(out)
        if self.strip:
            kept = len(done.rstrip(self.escape))
            if kept < len(done):
                consumed = at[kept]
                done, at = done[:kept], at[:kept]
        if self.dummy and self.suffix:
            done += self.escape
            at.append(consumed)
        return done, [*at, consumed]

    def _replaced(self, text: str) -> Iterator[tuple[str, int]]:
        """Replacements by the longest prefix, and how many source bytes each stands for; a character without one stands for itself."""
        raw, at, past = text.encode(), 0, 0
        for c in text:
            size = len(c.encode())
            if at >= past:
                found = self.map.longest(raw, at) if self.map else None
                new, n = found or (c, size)
                yield new, n
                past = at + n
            at += size

    def merged(self, text: str) -> list[str]:
        """The symbols that are left of a normalised text when no two neighbours make a piece: best score first, then leftmost."""
        rank, n, token = self.rank.get, len(text), list(text)
        after, before, heap = list(range(1, n + 1)), list(range(-1, n - 1)), []
        bits = n.bit_length()
        low = (1 << bits) - 1
        for i in range(n - 1):
            r = rank(token[i] + token[i + 1])
            if r is not None:
                heap.append((r << bits | i) << bits | 2)
        heapq.heapify(heap)
        while heap:
            x = heapq.heappop(heap)
            i = x >> bits & low
            left, j = token[i], after[i]
            if not left or j >= n or len(left) + len(token[j]) != x & low:
                continue  # stale
            left = token[i] = left + token[j]
            token[j] = ""
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                r = rank(left + token[k])
                if r is not None:
                    heapq.heappush(heap, (r << bits | i) << bits | len(left) + len(token[k]))
            h = before[i]
            if h >= 0:
                r = rank(token[h] + left)
                if r is not None:
                    heapq.heappush(heap, (r << bits | h) << bits | len(token[h]) + len(left))
        return [t for t in token if t]

    def _coded(self, done: str, at: list[int]) -> tuple[list[int], list[int]]:
        """Ids of a normalised text and the source byte at which each ends."""
        ids: list[int] = []
        ends: list[int] = []
        place, lost = 0, False
        for part in self.parts.findall(done):
            for symbol in self.merged(part):
                place += len(symbol)
                found = self.ids.get(symbol)
                if found is not None:
                    ids.append(found)
                    ends.append(at[place])
                elif self.fallback:
                    raw = symbol.encode()
                    ids.extend(self.fallback[b] for b in raw)
                    ends.extend([at[place - len(symbol)]] * (len(raw) - 1) + [at[place]])
                elif lost:
                    ends[-1] = at[place]
                else:
                    ids.append(self.unknown)
                    ends.append(at[place])
                lost = found is None and not self.fallback
        return ids, ends

    def plain(self, text: str) -> list[int]:
        """Ids of a normalised text, without offsets."""
        ids: list[int] = []
        for part in self.parts.findall(text):
            for symbol in self.merged(part):
                found = self.ids.get(symbol)
                if found is not None:
                    ids.append(found)
                else:
                    ids.extend(self.fallback[b] for b in symbol.encode())
        return ids

    def _makes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ids that pairs make, or -1."""
        pair = left << 32 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, self.makes[at], -1)

    def side_by_side(self, parts: list[str]) -> list[bytes | None]:
        """Packed ids of short normalised parts, merged all at once: a row a part, in each round the best pair of every row that has one.  None
        for a part with a character that is no piece."""
        n = np.array([len(x) for x in parts])
        chars = np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")
        kinds, of = np.unique(chars, return_inverse=True)
        ids = np.array([self.ids.get(chr(c), -1) for c in kinds.tolist()], np.int64)[of]
        inside = np.arange(n.max(initial=1)) < n[:, None]
        token = np.full(inside.shape, -1, np.int64)
        token[inside] = ids
        unknown = (inside & (token < 0)).any(axis=1)
        done = np.full_like(token, -1)
        row = np.flatnonzero(~unknown)
        token = token[row]
        none = len(self.rank_of) + 1
        rank = lambda made: np.where(made < 0, none, self.rank_of[made])
        # A -1 at a row's end makes no number that is a pair's.
        best = rank(self._makes(token[:, :-1], token[:, 1:]))
        while len(row):
            at = best.argmin(axis=1) if best.shape[1] else np.zeros(len(row), np.int64)
            line = np.arange(len(row))
            going = best[line, at] < none if best.shape[1] else np.zeros(len(row), bool)
            done[row[~going], : token.shape[1]] = token[~going]
            row, token, best, at = row[going], token[going], best[going], at[going]
            if not len(row):
                break
            line, place = np.arange(len(row)), np.arange(token.shape[1])
            left = self._makes(token[line, at], token[line, at + 1])
            # What lies behind the pair moves up by one.
            token[:, :-1] = np.where(place[:-1] > at[:, None], token[:, 1:], token[:, :-1])
            token[:, -1] = -1
            token[line, at] = left
            best[:, :-1] = np.where(place[:-2] >= at[:, None], best[:, 1:], best[:, :-1])
            best[:, -1] = none
            after = token[line, np.minimum(at + 1, token.shape[1] - 1)]
            best[line, np.minimum(at, best.shape[1] - 1)] = rank(np.where(after < 0, -1, self._makes(left, after)))
            before = np.flatnonzero(at)
            best[before, at[before] - 1] = rank(self._makes(token[before, at[before] - 1], left[before]))
            if not (token[:, -2:] >= 0).any() and token.shape[1] > 2:
                token, best = token[:, :-1].copy(), best[:, :-1].copy()
        kept = done >= 0
        raw, stops = done[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(axis=1)) * 4).tolist()
        return [None if u else raw[a:b] for u, a, b in zip(unknown.tolist(), [0, *stops], stops)]

    def ends(self, ids: np.ndarray) -> np.ndarray:
        """The source bytes at which pieces end, where a space stands for each U+2581: the last byte piece of a character has its width."""
        width, lead = self.width[ids], self.lead[ids]
        first = np.flatnonzero(lead)
        width[first + lead[first] - 1] = lead[first]
        return np.cumsum(width)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids without begin and end, the source byte at which each ends, and at which the first begins."""
        if not text:
            return np.array([], "<u4"), np.array([], np.int64), 0
        if not self.apart or SPACE in text:
            done, at = self.normalised(text)
            ids, ends = self._coded(done, at)
            return np.array(ids, "<u4"), np.array(ends, np.int64), at[0]
        return self._found(self.parts.findall(" " + text if self.dummy else text))

    def _found(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
        found = np.frombuffer(b"".join(map(self.known.__getitem__, parts)), "<u4")
        return found, self.ends(found) - self.dummy, 0

    def encode_all(self, texts: Iterable[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        """What encode gives for each text; parts that are not remembered are merged side by side, for some AT_ONCE characters of text at a time."""
        held: list[str] = []
        size = 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= AT_ONCE:
                yield from self._held(held)
                held, size = [], 0
        yield from self._held(held)

    def _held(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
        if not self.apart:
            yield from map(self.encode, texts)
            return
        cut = [None if SPACE in t or not t else self.parts.findall(" " + t if self.dummy else t) for t in texts]
        self.known.learn(set().union(*filter(None, cut)))
        for t, parts in zip(texts, cut):
            yield self._found(parts) if parts else self.encode(t)

    def decode(self, ids: Iterable[int]) -> str:
        """Text of ids; bytes that are no UTF-8 become U+FFFD each, and a control piece ends a run of bytes."""
        ids = list(ids)
        raw = list(map(self.bytes_.__getitem__, ids))
        if self.dummy or self.strip:
            for k, i in enumerate(ids):
                if self.kinds[i] == CONTROL:
                    continue
                stripped = self.kinds[i] == NORMAL and self.names[i].startswith(SPACE)
                if stripped:
                    raw[k] = raw[k][1:]
                if raw[k] or not self.strip or not stripped:
                    break
        inner = [k for k in range(1, len(ids) - 1) if self.kinds[ids[k]] == CONTROL] if self.controls.intersection(ids[1:-1]) else []
        return "".join(b"".join(raw[a:b]).decode("utf-8", "scriptorium_bytes") for a, b in zip([0, *inner], [*inner, len(raw)]))


class _Parts(dict):
    """Packed ids of parts that merge apart; those in use move to the younger of two generations."""

    def __init__(self, model: Model, most: int) -> None:
        super().__init__()
        self.model, self.most, self.older = model, most, {}

    def learn(self, parts: set[str]) -> None:
        """Remember parts that are now needed, and forget those not met since the last time that there were too many."""
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        new = []
        for part in parts.difference(self):
            packed = self.older.get(part)
            if packed is not None:
                self[part] = packed
            elif len(part) <= CACHED_CHARS:
                new.append(part)
        new.sort(key=len)  # rows of a block are about as long
        for k in range(0, len(new), ROWS):
            block = new[k : k + ROWS]
            made = self.model.side_by_side([x.replace(" ", self.model.escape) for x in block])
            self.update((part, packed) for part, packed in zip(block, made) if packed is not None)

    def __missing__(self, part: str) -> bytes:
        ids = self.model.plain(part.replace(" ", self.model.escape))
        packed = struct.pack(f"<{len(ids)}I", *ids)
        if len(part) <= CACHED_CHARS:
            self[part] = packed
        return packed


def _replace_byte(e: UnicodeError) -> tuple[str, int]:
    return "�", e.start + 1


codecs.register_error("scriptorium_bytes", _replace_byte)


@functools.lru_cache(maxsize=1)
def _model(raw: bytes) -> Model:
    return Model(raw)


def _shipped(df: DataFrame, path: str) -> Callable[[], Model]:
    with open(path, "rb") as f:  # the driver's; executors get the bytes
        sent = df.sparkSession.sparkContext.broadcast(f.read())
    return lambda: _model(sent.value)


def _texts(column: pa.Array) -> Iterator[str]:
    return (x.as_py() or "" for x in column)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, parts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*parts, np.array([], np.int64)]).astype(np.int64)).cast(kind))


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", ends_col: str = "ends", ends: bool = True) -> DataFrame:
    """df with its ids (begin and end ids too if `ends`) in ids_col and in ends_col the source byte at which each ends; a piece begins where the one before
    ends, the first where the text's leading spaces, if the model strips them, end.  text_col stays."""
    model, names = _shipped(df, path), df.columns
    schema = T.StructType([*df.schema, T.StructField(ids_col, T.ArrayType(T.IntegerType())), T.StructField(ends_col, T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        for b in batches:
            coded = list(m.encode_all(_texts(b.column(text_col))))
            around = [(np.concatenate([[m.begin], i, [m.end]]), np.concatenate([[first], e, e[-1:] if len(e) else [first]])) if ends else (i, e) for i, e, first in coded]
            yield pa.RecordBatch.from_arrays([*b.columns, _lists([i for i, _ in around], pa.int32()), _lists([e for _, e in around], pa.int64())], [*names, ids_col, ends_col])

    return df.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "text") -> DataFrame:
    """df with the text of its ids in place of ids_col; null ids give the empty text."""
    model = _shipped(df, path)
    others = [c for c in df.columns if c != ids_col]
    schema = T.StructType([df.schema[c] for c in others] + [T.StructField(text_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        for b in batches:
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in others), pa.array([m.decode(x.as_py() or ()) for x in b.column(ids_col)], pa.string())], [*others, text_col])

    return df.mapInArrow(run, schema)


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, ends_sha256: each text encoded with begin and end ids, its ids decoded, and all hashed, with
    the source bytes at which its pieces end (as little-endian unsigned 32-bit integers), in one pass."""
    model = _shipped(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model()
        head, tail = struct.pack("<I", m.begin), struct.pack("<I", m.end)
        for b in batches:
            rows = []
            for ids, ends, _ in m.encode_all(_texts(b.column(1))):
                shas = (head + ids.tobytes() + tail, m.decode([m.begin, *ids.tolist(), m.end]).encode(), ends.astype("<u4").tobytes())
                rows.append((len(ids) + 2, *(hashlib.sha256(x).hexdigest() for x in shas)))
            columns = [pa.array([r[k] for r in rows], pa.string() if k else pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ends_sha256"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ends_sha256 string")
