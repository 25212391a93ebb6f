"""Toxicity by a linear-chain conditional random field over words.

Two tags, clean and toxic.  A word's emission is the sum of weights of its features (the word, its prefixes and
its last letters, hashed); transitions make toxic words follow each other or not.  Forward-backward
marginals give each word's probability of being toxic; the document's score is a logistic function of
the expected number of toxic words among those of at least FLOOR, and of the odds of the likeliest word, so that documents without a
likely word are ordered too.  Words of at least a half, joined to runs, are the spans.

Words are labelled from document labels: a feature that many toxic training documents and almost no clean one
have marks its words in toxic documents; all other words are clean.  The field is fitted to whole texts, each as one chain, by
the gradient of the likelihood: marginals against labels for weights, pair marginals against pairs for transitions.
The fit uses a sample of labelled rows, brought to the driver, which two parameters bound: about ``sample`` documents of each label, by a
hash of their ids, and ``most_bytes`` of text in all, taken in the order of a hash of id and text, passing over what no longer fits.  No text
is left out for its length, unless it is larger than most_bytes by itself.  Scoring is one pass over all texts without a shuffle.

Defined results: a null text is the empty text and has no toxic words; without labelled rows of both kinds every
score is next to 0; of several labels for a doc_id the largest counts; rows that repeat an id are scored each, and rows that repeat id and
text are learnt from once; texts with the same words have the same score, so they tie, and the order of rows decides nothing; very long texts are scored whole; an empty table gives an empty result; columns other than doc_id and text are
not read, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .rolling import grouped

#: Documents of each label that the field is fitted on, about, and half again at most; a parameter of ``fit`` and ``predictions``.
SAMPLE = 3000
#: Bytes of the texts that the field is fitted on, at most; a parameter likewise.
MOST_BYTES = 64 << 20
SLOTS = 1 << 18
CACHE_WORDS = 200_000
FLOOR = 0.5
CUT = 0.3
GROUP_BYTES = 2 << 20
STEP_WORDS = 1 << 14  # words of whole texts that one step learns from; a longer text is a step by itself
_EDGE = re.compile(r"^\W+|\W+$")


def features(word: str) -> list[int]:
    """Slots of a word's features; none for words without letters."""
    w = _EDGE.sub("", word).lower()
    if not w:
        return []
    b = w.encode()
    found = [b"w" + b, b"e" + b[-3:]]
    found += [b"p" + w[:k].encode() for k in (3, 4, 5, 6) if len(w) >= k]
    return [zlib.crc32(x) & (SLOTS - 1) for x in found]


class Field:
    """The fitted field; a plain object that is sent to executors."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray, start: float, rule: tuple[float, float, float] = (1.0, 0.0, -30.0)) -> None:
        """weights of features for toxic over clean; moves: log weights from a tag (row) to a tag; rule: of a document's score."""
        self.weights, self.moves, self.start = weights.astype(np.float32), moves, start
        self.rule = rule
        self.known: dict[str, float] | None = None

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": None}

    def emissions(self, words: list[str]) -> np.ndarray:
        if self.known is None:
            self.known = _Emissions(self.weights.tolist())
        return np.fromiter(map(self.known.__getitem__, words), np.float64, len(words))

    def score(self, p: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(np.dot(self.rule, _evidence(p)), -30, 30))))

    def marginals(self, emissions: list[np.ndarray]) -> list[np.ndarray]:
        """Of each sequence."""
        lengths = np.array([len(e) for e in emissions], np.int64)
        if not lengths.sum():
            return [np.zeros(0)] * len(emissions)
        ends = np.cumsum(lengths)
        p = _chained(np.concatenate(emissions), (ends - lengths)[lengths > 0], np.exp(self.moves), float(np.exp(self.start)))
        return np.split(p, ends[:-1])


class _Emissions(dict):
    def __init__(self, weights: list[float]) -> None:
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> float:
        value = sum(map(self.weights.__getitem__, features(word)))
        if len(word) < 64:
            if len(self) >= CACHE_WORDS:
                self.clear()
            self[word] = value
        return value


def _evidence(p: np.ndarray) -> tuple[float, float, float]:
    """The logarithm of the expected number of toxic words, the log odds of the likeliest one, and 1."""
    top = float(np.clip(p.max(initial=0.0), 1e-9, 1 - 1e-9))
    return float(np.log(0.01 + p[p >= FLOOR].sum())), float(np.log(top / (1 - top))) / 4, 1.0


def _calibrated(field: Field, toxic: list[str], clean: list[str]) -> Field:
    """The score's rule by logistic regression on documents that the weights were not fitted on."""
    design = np.array([_evidence(p) for p in _words([*toxic, *clean], field)[1]])
    y = np.concatenate([np.ones(len(toxic)), np.zeros(len(clean))])
    prior = np.array([1.0, 0.1, 0.0])
    w = prior.copy()
    for _ in range(50):
        f = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        curve = design.T @ (design * (f * (1 - f))[:, None]) + 0.5 * np.eye(3)
        w = w - np.linalg.solve(curve, design.T @ (f - y) + 0.5 * (w - prior))
    field.rule = (float(max(w[0], 0.05)), float(max(w[1], 0.001)), float(w[2]))
    return field


_BLOCK = 64


def _scan(maps: np.ndarray) -> np.ndarray:
    """Values r[t] = maps[t](r[t-1]) of maps r -> (a r + b) / (c r + d), given as columns a, b, c, d; the first is constant.

    Maps compose as 2 x 2 matrices: blocks of them are composed side by side, a short pass runs over blocks,
    and all blocks are run side by side from there."""
    n = len(maps)
    blocks = -(-n // _BLOCK)
    full = np.concatenate([maps, np.tile([1.0, 0.0, 0.0, 1.0], (blocks * _BLOCK - n, 1))]).reshape(blocks, _BLOCK, 4).transpose(1, 2, 0).copy()
    a, b, c, d = full[0]
    for k in range(1, _BLOCK):
        e, f, g, h = full[k]
        a, b, c, d = e * a + f * c, e * b + f * d, g * a + h * c, g * b + h * d
        top = np.maximum(np.maximum(a, b), np.maximum(c, d))
        a, b, c, d = a / top, b / top, c / top, d / top
    r, before = 0.0, []
    for w, x, y, z in zip(a.tolist(), b.tolist(), c.tolist(), d.tolist(), strict=True):
        before.append(r)
        r = (w * r + x) / (y * r + z)
    value = np.array(before)
    out = np.empty((_BLOCK, blocks))
    for k in range(_BLOCK):
        e, f, g, h = full[k]
        out[k] = value = (e * value + f) / (g * value + h)
    return out.T.ravel()[:n]


def _odds(e: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """exp(e), and the odds of toxic to clean at each place of sequences in one array that begin at first: from what comes up to
    the place, and from what follows it."""
    x = np.exp(np.clip(e, -25, 25))
    (cc, ct), (tc, tt) = moves
    ahead = np.stack([tt * x, ct * x, np.full_like(x, tc), np.full_like(x, cc)], 1)
    ahead[first] = np.stack([np.zeros(len(first)), start * x[first], np.zeros(len(first)), np.ones(len(first))], 1)
    behind = np.stack([tt * x, np.full_like(x, tc), ct * x, np.full_like(x, cc)], 1)
    behind[first] = [0.0, 1.0, 0.0, 1.0]
    # the odds that place t has from what follows it: the map of place t + 1
    behind = np.concatenate([[[0.0, 1.0, 0.0, 1.0]], behind[:0:-1]])
    return x, _scan(ahead), _scan(behind)[::-1]


def _chained(e: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float) -> np.ndarray:
    """P(toxic) at each place."""
    _, forward, behind = _odds(e, first, moves, start)
    odds = forward * behind
    return odds / (1 + odds)


def _pairs(e: np.ndarray, first: np.ndarray, moves: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) at each place, and P(tag, next tag) at each place but the last; what spans two sequences means nothing."""
    x, forward, behind = _odds(e, first, moves, start)
    (cc, ct), (tc, tt) = moves
    odds, ahead = forward * behind, x[1:] * behind[1:]
    pairs = np.array([[np.full_like(ahead, cc), ct * ahead], [forward[:-1] * tc, forward[:-1] * tt * ahead]])
    return odds / (1 + odds), pairs / pairs.sum((0, 1))


def _labelled(toxic: list[list[str]], clean: list[list[str]], tell: float = 0.03, least: int = 3) -> set[int]:
    """Features that mark words of toxic documents as toxic.

    Toxic words are counted by the different pairs of neighbours they stand between, as copies of one document
    would make all its words look toxic."""
    memo: dict[str, list[int]] = {}

    def slots(word: str) -> list[int]:
        f = memo.get(word)
        if f is None:
            f = memo[word] = features(word)
        return f

    def documents(docs: list[list[str]]) -> Counter:
        found: Counter = Counter()
        for words in docs:
            found.update(set().union(*map(slots, set(words))))
        return found

    good, bad = documents(clean), documents(toxic)
    need = max(least, 0.004 * len(toxic))
    places: dict[int, set[int]] = {f: set() for f, n in bad.items() if n >= need and good[f] <= tell * len(clean)}
    for words in filter(None, toxic):
        for before, word, after in zip(["", *words[:-1]], words, [*words[1:], ""], strict=True):
            for f in slots(word):
                if f in places:
                    places[f].add(hash((before, after)))
    return {f for f, found in places.items() if len(found) >= need and (good[f] + 0.5) / max(1, len(clean)) < tell * len(found) / len(toxic)}


def train(toxic: list[str], clean: list[str]) -> Field:
    """Weights from three quarters of the documents, the score's calibration from the rest."""
    part = lambda docs, rest: [t for i, t in enumerate(docs) if (i % 4 == 0) == rest]
    field = train_weights(part(toxic, False), part(clean, False))
    return _calibrated(field, part(toxic, True), part(clean, True)) if toxic and clean else field


def train_weights(toxic: list[str], clean: list[str], epochs: int = 4, rate: float = 0.3, seed: int = 5) -> Field:
    if not toxic or not clean:
        return Field(np.zeros(SLOTS), np.array([[0.0, -30.0], [0.0, -30.0]]), -30.0)
    rng = np.random.default_rng(seed)
    pool: dict[str, str] = {}  # one object for a word, however often it occurs
    bad, good = ([[pool.setdefault(w, w) for w in t.split()] for t in texts] for texts in (toxic, clean))
    marks = _labelled(bad, good)
    # words by number; their features, filled up with a slot that stays at 0
    number: dict[str, int] = {}
    tokens = np.array([number.setdefault(w, len(number)) for words in (*bad, *good) for w in words], np.int64)
    found = [features(w) for w in number]
    slots = np.full((len(found) + 1, 6), SLOTS, np.int64)
    for k, f in enumerate(found):
        slots[k, : len(f)] = f
    telling = np.array([any(f in marks for f in fs) for fs in found] + [False])
    counts = np.array([len(words) for words in (*bad, *good)], np.int64)
    tagged = telling[tokens] & np.repeat(np.arange(len(counts)) < len(bad), counts)
    if not len(tokens):
        return Field(np.zeros(SLOTS), np.array([[0.0, -30.0], [0.0, -30.0]]), -30.0)
    offsets = np.cumsum(counts) - counts
    w, seen = np.zeros(SLOTS + 1), np.full(SLOTS + 1, 1e-3)
    moves, start = np.array([[0.0, -4.0], [0.0, -2.0]]), -4.0
    for _ in range(epochs):
        order = rng.permutation(np.flatnonzero(counts))
        for a, z in grouped(counts[order].tolist(), STEP_WORDS):
            part = order[a:z]
            at = np.concatenate([np.arange(offsets[d], offsets[d] + counts[d]) for d in part])
            first = np.cumsum(counts[part]) - counts[part]
            x, y = slots[tokens[at]], tagged[at].astype(float)
            p, q = _pairs(w[x].sum(1), first, np.exp(moves), np.exp(start))
            grad = np.bincount(x.ravel(), np.repeat(p - y, x.shape[1]), minlength=SLOTS + 1) * (32 / len(at))
            grad[SLOTS] = 0.0
            hit = np.flatnonzero(grad)
            grad[hit] += 1e-6 * w[hit]
            seen[hit] += grad[hit] ** 2
            w[hit] -= rate * grad[hit] / np.sqrt(seen[hit])
            # transitions by the given and the expected counts of neighbours in a text
            both = np.ones(len(at), bool)
            both[first] = False
            both = both[1:]
            scale = 0.5 / max(1.0, both.sum() / 20)
            for tag in (0, 1):
                given = ((y[:-1] if tag else 1 - y[:-1]) * y[1:])[both].sum()
                moves[tag, 1] += scale * (given - q[tag, 1][both].sum())
            start += 0.5 * (y[first].sum() - p[first].sum()) / len(part)
            moves, start = np.clip(moves, -9, 3), float(np.clip(start, -9, 0))
    return Field(w[:SLOTS], moves, start)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = MOST_BYTES) -> Field:
    """From labels (doc_id, toxic) that are not held out: about sample documents of each label, of most_bytes in all."""
    known = labels.where(F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    part = F.lit(0.0)
    for value, n in counts.items():
        part = F.when(F.col("toxic") == value, F.lit(min(1.0, sample / n))).otherwise(part)
    share = F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(13)), 11).cast("double") / float(1 << 53)
    picked = known.where(share < part)  # about 2 * sample rows
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", text.alias("text"), F.octet_length(text).alias("size"), F.xxhash64("doc_id", text).alias("at")).join(F.broadcast(picked), "doc_id")
    chosen, left = [], most_bytes
    for r in rows.select("at", "size").distinct().orderBy("at").limit(3 * sample).collect():
        if r["size"] <= left:
            chosen.append((r["at"],))
            left -= r["size"]
    chosen = F.broadcast(docs.sparkSession.createDataFrame(chosen, "at long"))  # at most 3 * sample numbers
    rows = rows.join(chosen, "at").groupBy("at").agg(F.first("text").alias("text"), F.first("toxic").alias("toxic")).orderBy("at").collect()
    return train([r["text"] for r in rows if r["toxic"] == 1], [r["text"] for r in rows if r["toxic"] == 0])


def _words(texts: Iterable[str], field: Field) -> tuple[list[list[str]], list[np.ndarray]]:
    words = [t.split() for t in texts]
    return words, field.marginals([field.emissions(w) for w in words])


def text_spans(text: str, p: np.ndarray) -> list[tuple[int, int, float]]:
    """Runs of words of at least a half, as offsets into the text with their largest marginal."""
    out: list[list] = []
    before = -2
    for k, m in enumerate(re.finditer(r"\S+", text)) if (p >= 0.5).any() else ():
        if p[k] >= 0.5:
            if before == k - 1:
                out[-1][1:] = m.end(), max(out[-1][2], float(p[k]))
            else:
                out.append([m.start(), m.end(), float(p[k])])
            before = k
    return [tuple(x) for x in out]


def predictions(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, held_out, score, predicted, spans: array of (start, end, probability), offsets in code points."""
    sent = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, sample, most_bytes))
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("probability", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = sent.value
        for b in batches:
            column, scores, found = b.column(1), [], []
            sizes = [n or 0 for n in pa.compute.binary_length(column).to_pylist()]
            for a, z in grouped(sizes, GROUP_BYTES):
                texts = [t.as_py() or "" for t in column.slice(a, z - a)]
                p = _words(texts, field)[1]
                scores += map(field.score, p)
                found += [[dict(zip(("start", "end", "probability"), s, strict=True)) for s in text_spans(t, x)] for t, x in zip(texts, p, strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(scores, pa.float64()), pa.array(found, kind)], ["doc_id", "score", "spans"])

    rows = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double, spans array<struct<start: int, end: int, probability: double>>")
    return rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "spans")
