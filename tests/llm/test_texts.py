import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.llm import byte_bpe, chat_roles, crf_toxicity, mixing, pu_quality, spot_signatures

@pytest.fixture(scope="module")
def reference():
    P, tiktoken = pytest.importorskip("public_tokenizers"), pytest.importorskip("tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), byte_bpe.Coder(ranks, P.PATTERN)


def test_bpe_like_the_library(reference):
    library, coder = reference
    rng = random.Random(1)
    letters = "aab  \n\t'sd²½Ⅷ一二é_　\x1c\x85 \U0001f600.,#١"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(2000)]
    for t in [*texts, "a" * 30_000 + "!" * 30_000, "<|endoftext|> x", " " * 500, "x \n \n y", "  lead"]:
        ids = np.frombuffer(coder.encode(t), "<u4").tolist()
        assert ids == library.encode_ordinary(t), repr(t[:80])
        assert coder.decode(ids) == t.encode()


def test_bpe_tables(odd, odd_rows, nothing, reference):
    import public_tokenizers as P

    library, _ = reference
    got = byte_bpe.digests(odd, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).collect()
    want = sorted((str(i), len(ids := library.encode_ordinary(t or "")), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in odd_rows)
    assert sorted((str(r[0]), *r[1:]) for r in got) == want
    coded = byte_bpe.encode(odd, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    back = byte_bpe.decode(coded.select("doc_id", "ids"), P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    assert sorted(bytes(r.bytes) for r in back.collect()) == sorted((t or "").encode() for _, t, *_ in odd_rows)
    assert byte_bpe.digests(nothing, P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN).count() == 0


def _targets(sizes):
    names = sorted((n for n in sizes if n is not None)) + [None] * (None in sizes)
    weight = {n: i % 3 + 1 for i, n in enumerate(names)}
    rest, free, out = float(sum(sizes.values())), set(names), {}
    while free:
        total = sum(weight[n] for n in free)
        over = [n for n in free if rest * weight[n] / total > 3 * sizes[n]]
        for n in over or free:
            out[n] = 3.0 * sizes[n] if over else rest * weight[n] / total
        if not over:
            break
        rest -= sum(out[n] for n in over)
        free -= set(over)
    return out


def test_mixing(spark, odd, odd_rows, nothing):
    first = sorted(mixing.mix(odd).collect(), key=str)
    assert first == sorted(mixing.mix(odd.repartition(5)).collect(), key=str)
    sizes = {}
    for _, t, _, s, _ in odd_rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").encode().split())
    want = _targets(sizes)
    assert sorted((r.source_size, round(r.target, 6)) for r in first) == sorted((sizes[s], round(want[s], 6)) for _, _, _, s, _ in odd_rows)
    assert all(r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0) for r in first)
    assert mixing.repeat(odd).columns == odd.columns and mixing.mix(nothing).count() == 0


def test_mixing_meets_targets(spark):
    rng = random.Random(5)
    rows = [(i, "w " * rng.randint(1, 300), f"s{rng.randrange(7)}") for i in range(3000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(got) == 7 and all(abs(r.taken - r.target) < 0.005 * r.target for r in got)


def test_mixing_goes_on_after_a_large_document(spark):
    u = mixing.uniform(7, F.lit("a"), F.col("id") + 100_000, F.xxhash64(F.lit(7), F.lit("w " * 12_000)))
    large = spark.range(1000).where((u > 0.36) & (u < 0.45)).first().id + 100_000
    rows = [(i, "w w", "a") for i in range(12_000)] + [(large, "w " * 12_000, "a")] + [(20_000 + i, "w " * 12, "b") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(got) == 2 and all(r.target - 12 < r.taken <= r.target for r in got)


def _plain_mix(rows, order):
    """Words taken of each (id, source), by a Pareto sample of each source: q, ranked whole, one document after another."""
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want, target = {}, _targets(sizes)
    for s, n in sizes.items():
        own = [(i, len(t.split())) for i, t, x in rows if x == s]
        whole = int(target[s] / n + 1e-12)
        room = target[s] - whole * n
        low, high = 0.0, 1.0  # of c in p = min(1, c * digits)
        for _ in range(200):
            c = (low + high) / 2
            low, high = (c, high) if sum(min(1, c * size.bit_length()) * size for _, size in own) < room else (low, c)
        sure = {size for _, size in own if low * size.bit_length() > 1 - 1e-9}
        left = room - sum(size for _, size in own if size in sure)
        ranked = []
        for i, size in own:
            p, u = min(1, low * size.bit_length()), order[i, s]
            want[i, s] = want.get((i, s), 0) + size * (whole + (size in sure))
            if size not in sure:
                ranked.append((u / (1 - u) / (p / (1 - p)), i, size))
        for _, i, size in sorted(ranked):
            more = size <= left
            left -= size * more
            want[i, s] += size * more
    return want


def _uniforms(df):
    return {(r.doc_id, r.source): r.u for r in df.select("doc_id", "source", mixing.uniform(7, F.col("source"), F.col("doc_id"), F.xxhash64(F.lit(7), "text")).alias("u")).collect()}


def test_mixing_like_one_pass(spark, monkeypatch):
    rng = random.Random(11)
    rows = [(i, "w " * rng.choice([3, 5, 8, 400, 900]), f"s{rng.randrange(3)}") for i in range(900)]
    rows += [rows[k] for k in range(0, 900, 9)] * 4
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    monkeypatch.setattr(mixing, "TRY", 20)  # many rounds
    got = {(r.doc_id, r.source): r.taken for r in mixing.with_copies(df).groupBy("doc_id", "source").agg(F.sum(F.col("__mix_copies") * F.col("__mix_size")).alias("taken")).collect()}
    assert got == _plain_mix(rows, _uniforms(df))


def test_mixing_of_ids_in_two_sources(spark):
    """The same ids and texts in two sources, rows in two orders, and rows that differ in another column only."""
    rows = [(i, "w " * (i + 1), "a", "x") for i in range(400)] + [(i, "w " * (i + 1), "b", "x") for i in range(100, 300)]
    rows += [(i, "w " * (i + 1), "b", lang) for i in range(100, 300, 3) for lang in "yz"]
    schema = "doc_id long, text string, source string, lang string"
    one, two = (spark.createDataFrame(r, schema).repartition(n) for r, n in ((rows, 2), (rows[::-1], 5)))
    first = sorted(mixing.repeat(one).collect())
    assert first == sorted(mixing.repeat(two).collect())
    sums = mixing.mix(one).groupBy("source_size").agg(F.first("target").alias("target"), F.sum("taken").alias("taken")).collect()
    assert len(sums) == 2 and all(r.target - 400 < r.taken <= r.target + 1e-6 for r in sums)
    got = {}
    for i, t, s, _ in first:
        got[i, s] = got.get((i, s), 0) + len(t.split())
    want = _plain_mix([r[:3] for r in rows], _uniforms(one))
    assert got == {k: n for k, n in want.items() if n}


def test_mixing_includes_by_odds(spark):
    """Documents of a size are taken as often as their inclusion probability says, up to chance (five deviations)."""
    rows = [(i, "w " * (1 + i % 4 * 20), "a") for i in range(8000)] + [(10_000 + i, "w " * 31, "b") for i in range(8000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mean = {r["__mix_size"]: r.n for r in mixing.with_copies(df).where("source = 'a'").groupBy("__mix_size").agg(F.avg("__mix_copies").alias("n")).collect()}
    target = (2000 * 124 + 8000 * 31) / 3
    c = target / (2000 * sum(n * n.bit_length() for n in (1, 21, 41, 61)))
    for n in (1, 21, 41, 61):
        p = c * n.bit_length()
        assert abs(mean[n] - p) < 5 * (p * (1 - p) / 2000) ** 0.5, (n, mean, p)


def test_quality(odd, odd_rows, labels, nothing):
    got = pu_quality.predictions(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    assert pu_quality.predictions(nothing, labels).count() == 0
    assert {r.score for r in pu_quality.predictions(odd, labels.where("quality > 1")).collect()} == {0.5}
    assert pu_quality.accepted(odd, labels).columns == odd.columns


def test_class_prior_and_risk():
    """The prior of a known mixture, and weights at which the non-negative risk's own gradient, taken by differences, is followed."""
    rng = np.random.default_rng(4)
    for prior in (0.2, 0.5, 0.8):
        n = 4000
        p, hidden = rng.normal(3, 1, n), rng.random(n) < prior
        u = np.where(hidden, rng.normal(3, 1, n), rng.normal(-3, 1, n))
        assert abs(pu_quality.class_prior(p, u) - prior) < 0.05
        x = lambda v: np.stack([v, np.ones(len(v))], 1).astype(np.float32)
        w = pu_quality._fit(x(p), x(u), prior, 300)
        found = 1 / (1 + np.exp(-(x(u) @ w)))
        assert ((found > 0.5) == hidden).mean() > 0.97

    def risk(w, p, u, prior):
        log = lambda z: np.logaddexp(0, z).mean()
        negative = log(u @ w) - prior * log(p @ w)
        return prior * log(-(p @ w)) + negative if negative >= 0 else -negative

    p, u = (rng.normal(m, 1, (50, 3)).astype(np.float32) for m in (1, 0))
    for prior in (0.3, 0.97):  # the second makes the negative part fall below zero
        w, steps = np.array([0.1, -0.2, 0.3]), []
        class Step:
            def __init__(self, n, rate):
                pass

            def step(self, g):
                steps.append(g.copy())
                return np.zeros_like(g)

        old, pu_quality._Adam = pu_quality._Adam, Step
        zeros, pu_quality.np.zeros = pu_quality.np.zeros, lambda n, t=float: w.astype(t) if n == 3 else zeros(n, t)
        try:
            pu_quality._fit(p, u, prior, 1, l2=0.0)
        finally:
            pu_quality._Adam, pu_quality.np.zeros = old, zeros
        want = [(risk(w + d, p, u, prior) - risk(w - d, p, u, prior)) / 2e-4 for d in np.eye(3) * 1e-4]
        assert np.allclose(steps[0], want, atol=2e-3), prior


def _area(y, s):
    order = np.argsort(s, kind="stable")
    rank = np.empty(len(s))
    rank[order] = np.arange(len(s))
    return (rank[y].sum() - y.sum() * (y.sum() - 1) / 2) / (y.sum() * (~y).sum())


def test_quality_and_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, marks = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    q = pu_quality.predictions(docs, marks).where("held_out").join(marks, "doc_id").select("quality", "score", "predicted").toPandas()
    assert _area(q.quality.to_numpy() == 1, q.score.to_numpy()) > 0.93 and (q.quality == q.predicted).mean() > 0.93
    t = crf_toxicity.predictions(docs, marks).where("held_out").join(marks, "doc_id").select("toxic", "score", "predicted").toPandas()
    assert _area(t.toxic.to_numpy() == 1, t.score.to_numpy()) > 0.9 and (t.toxic == t.predicted).mean() > 0.9


def test_toxicity_tables(odd, odd_rows, labels, nothing):
    got = crf_toxicity.predictions(odd, labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert crf_toxicity.predictions(nothing, labels).count() == 0
    assert max(r.score for r in crf_toxicity.predictions(odd, labels.where("toxic > 1")).collect()) < 0.01
    both = labels.unionByName(labels.withColumn("toxic", F.lit(0)))  # of several labels the largest counts
    assert sorted(map(str, crf_toxicity.predictions(odd, both).collect())) == sorted(map(str, got))


def _chains(e: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray]:
    """P(toxic) at each place of padded columns, by forward and backward odds of toxic to clean; and P(tag, next tag)."""
    x = np.exp(np.clip(e, -25, 25))
    n = len(x)
    (cc, ct), (tc, tt) = moves
    forward, behind = np.empty_like(x), np.ones_like(x)
    r = start * x[0]
    forward[0] = r
    for t in range(1, n):
        r = x[t] * (ct + r * tt) / (cc + r * tc)
        forward[t] = r
    for t in range(n - 1, 0, -1):
        y = x[t] * behind[t]
        behind[t - 1] = np.where(t < lengths, (tc + tt * y) / (cc + ct * y), 1.0)
    odds = forward * behind
    ahead = x[1:] * behind[1:]
    pairs = np.array([[np.full_like(ahead, cc), ct * ahead], [forward[:-1] * tc, forward[:-1] * tt * ahead]])
    return odds / (1 + odds), pairs / pairs.sum((0, 1))


def test_marginals_by_enumeration():
    import itertools

    rng = np.random.default_rng(0)
    moves, start, e = np.exp(np.array([[0, -1.8], [0, -1.4]])), float(np.exp(-4)), rng.normal(0, 2, 8)
    every = [(y, (start if y[0] else 1) * np.exp(sum(v for v, k in zip(e, y) if k)) * np.prod([moves[a, b] for a, b in zip(y, y[1:])])) for y in itertools.product((0, 1), repeat=8)]
    want = sum(w * np.array(y) for y, w in every) / sum(w for _, w in every)
    assert np.allclose(crf_toxicity._chained(e, np.array([0]), moves, start), want)
    seqs = [rng.normal(-2, 5, n) for n in rng.integers(1, 300, 30)]
    ends = np.cumsum([len(s) for s in seqs])
    p = crf_toxicity._chained(np.concatenate(seqs), ends - [len(s) for s in seqs], moves, start)
    assert np.allclose(p, np.concatenate([_chains(s[:, None], np.array([len(s)]), moves, start)[0][:, 0] for s in seqs]))
    p, q = _chains(np.stack([e, np.where(np.arange(8) < 5, e, 9.0)], 1), np.array([8, 5]), moves, start)
    assert np.allclose(p[:, 0], want)
    total = sum(w for _, w in every)
    for t in range(7):
        for a in (0, 1):
            for b in (0, 1):
                assert np.isclose(q[a, b, t, 0], sum(w for y, w in every if (y[t], y[t + 1]) == (a, b)) / total)
    short = [(y, (start if y[0] else 1) * np.exp(sum(v for v, k in zip(e, y) if k)) * np.prod([moves[a, b] for a, b in zip(y, y[1:])])) for y in itertools.product((0, 1), repeat=5)]
    assert np.allclose(p[:5, 1], sum(w * np.array(y) for y, w in short) / sum(w for _, w in short))


def test_training_learns_late_words():
    """Words far behind the others of a long text are learnt from like them."""
    rng = random.Random(2)
    plain = [f"w{k}" for k in range(300)]
    prose = lambda n: [rng.choice(plain) for _ in range(n)]
    toxic = [" ".join([*prose(20), *[rng.choice(["vile", "foul"]) for _ in range(60)], *prose(1200), "hateful", *prose(20)]) for _ in range(60)]
    field = crf_toxicity.train_weights(toxic, [" ".join(prose(300)) for _ in range(60)])
    p = crf_toxicity._words(["w1 w2 hateful w3"], field)[1][0]
    assert p[2] > 0.5 > max(p[[0, 1, 3]])


def test_pairs_of_whole_chains():
    rng = np.random.default_rng(4)
    moves, sizes = np.exp(rng.normal(size=(2, 2))), [1, 70, 3, 200]
    seqs = [rng.normal(size=n) * 3 for n in sizes]
    first = np.cumsum(sizes) - sizes
    p, q = crf_toxicity._pairs(np.concatenate(seqs), first, moves, 0.3)
    for s, a in zip(seqs, first):
        one, two = _chains(s[:, None], np.array([len(s)]), moves, 0.3)
        assert np.allclose(p[a : a + len(s)], one[:, 0]) and np.allclose(q[:, :, a : a + len(s) - 1], two[..., 0])


def test_toxicity_learns_from_very_long_texts(spark):
    """The only texts that name a word as toxic have over a megabyte; too few bytes for them leave it unknown."""
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "omega"]) + str(rng.randrange(40)) for _ in range(n))
    rows = [(i, prose(170_000) + "".join(f" {prose(3)} vile {prose(1)}" for _ in range(30)), 1) for i in range(8)] + [(100 + i, prose(60), 0) for i in range(80)]
    assert all(len(t) > 1 << 20 for _, t, y in rows if y)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(8)
    marks = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    slot = [k for k in crf_toxicity.features("vile")]
    assert crf_toxicity.fit(docs, marks).weights[slot].sum() > 1
    assert not crf_toxicity.fit(docs, marks, most_bytes=1 << 20).weights[slot].any()


def test_spans():
    p = np.array([0.1, 0.9, 0.7, 0.2, 0.6])
    assert crf_toxicity.text_spans("a bad word is  here", p) == [(2, 10, 0.9), (15, 19, 0.6)]


def test_fingerprints(odd, odd_rows, nothing, spark):
    docs = odd.where("doc_id < 60 and doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted((r.doc_id, r.text or "") for r in docs.select("doc_id", "text").collect())
    got = {r.doc_id: r for r in spot_signatures.fingerprints(docs).collect()}
    cut = lambda s: {s[k : k + 8] for k in range(0, len(s), 8)}
    for k, (i, t) in enumerate(rows):
        after = rows[(k + 1) % len(rows)]
        half = len(t) // 2
        edited = t[: len(t) - half] + after[1][:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        for near, other in ((r.near_edited, r.edited_fingerprint), (r.near_next, got[after[0]].fingerprint)):
            a, b = cut(r.fingerprint), cut(other)
            assert near == pytest.approx(len(a & b) / len(a | b) if a | b else 1.0)
    assert len({got[k].fingerprint for k in range(10, 14)}) == 1
    assert spot_signatures.fingerprints(odd).count() == len(odd_rows) and spot_signatures.fingerprints(nothing).count() == 0
    pairs, _ = spot_signatures.similar(docs)
    sets = {i: cut(got[i].fingerprint) for i, _ in rows}
    each = list({r.fingerprint: i for i, r in got.items() if r.fingerprint}.values())
    assert pairs.count() == sum(len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) for k, a in enumerate(each) for b in each[:k])


def test_signatures_like_a_plain_spot_finder(spark):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["the", "of", "La", "und", "Wort", "word", "x1", "y2", "--", "é"]) for _ in range(rng.randint(0, 40))) for _ in range(60)]
    anchors = set(spot_signatures.ANCHORS)
    want = []
    for t in texts:
        w = "".join(c if c.isalnum() else " " for c in t.lower()).split()
        anchor, chains = "", [("", [])]
        for k, x in enumerate(w):
            if x in anchors and k + 1 < len(w):
                anchor = x
                chains.append((anchor, []))
            else:
                chains[-1][1].append(x)
        chains = [c for c in chains if c[1]]
        found = set()
        for (anchor, chain), following in zip(chains, [*chains[1:], ("", ["\u0002"])]):
            chain = [*chain, following[1][0]]
            found |= {(anchor, chain[k], chain[k + 1]) for k in range(0, len(chain) - 1, 2)}
        want.append(found)
    hashes = spark.createDataFrame(sorted({x for f in want for x in f}), "anchor string, a string, b string")
    hashes = {(r.anchor, r.a, r.b): r.h for r in hashes.withColumn("h", F.hash("anchor", "a", "b")).collect()}
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", spot_signatures.signatures(F.col("t")).alias("s")).collect()
    for r in got:
        assert r.s == sorted({hashes[x] for x in want[r.i]}), texts[r.i]
        assert r.s or not any(c.isalnum() for c in texts[r.i])


def test_chunks_of_ids_that_lie_far_apart(spark):
    ids = [*range(2000), *(2**60 + 7 * k for k in range(2000)), -(2**63) + 5, -(2**62) - (2**61), 2**62 + 2**61, 2**63 - 1]
    df = spark.createDataFrame([(i, f"text {i}") for i in ids], "id long, t string")
    rows, _, chunks = spot_signatures.chunked(df)
    sizes = sorted(r["count"] for r in rows.groupBy("chunk").count().collect())
    assert sum(sizes) == len(ids) and len(sizes) == chunks and sizes[-1] <= 2 * spot_signatures.CHUNK_ROWS
    got = {r.doc_id: r.edited_sha256 for r in spot_signatures.fingerprints(df.toDF("doc_id", "text")).collect()}
    order = sorted(ids)
    for i, j in zip(order, [*order[1:], order[0]]):
        t, u = f"text {i}", f"text {j}"
        assert got[i] == hashlib.sha256((t[: len(t) - len(t) // 2] + u[: len(t) // 2]).encode()).hexdigest()


def test_fingerprints_of_near_copies_with_few_spots(spark):
    for n in (7, 8, 9):
        words = [f"w{k}" for k in range(60)]
        for k in range(n):
            words[6 * k + 3] = "the"
        edited = [*words[:9], "edited", *words[10:]]
        docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(edited))], "doc_id long, text string").coalesce(1)
        assert spot_signatures.fingerprints(docs).first().near_next > 0.8, n
        pairs, _ = spot_signatures.similar(docs)
        assert pairs.count() == 1, n


def _cost(roles):
    """Cheapest legal repair by trying every sequence of steps."""
    best = {0: 0}
    for role in roles:
        nxt = {}
        for a, c in best.items():
            for to in (1, 2, 3):
                relabel = 0 if to == role else 1 if role is None else 3
                ways = [relabel] * ((a, to) in chat_roles.LEGAL) + [relabel + 1] * (a == to) + [relabel + 2] * any((a, m) in chat_roles.LEGAL and (m, to) in chat_roles.LEGAL for m in (1, 2, 3))
                if ways:
                    nxt[to] = min(nxt.get(to, 1 << 40), c + min(ways))
        best = nxt
    return min(c + (0 if s in (2, 3) else 2) for s, c in best.items())


def test_chat_repair(spark):
    rng = random.Random(8)
    names = {None: "narrator", 1: "system", 2: " User ", 3: "assistant"}
    rows, want = [], {}
    for conv in range(120):
        roles = [rng.choice([None, 1, 2, 2, 3, 3]) for _ in range(rng.randint(1, 7) if conv else 400)]
        want[conv] = _cost(roles)
        rows += [(conv, k, names[r], f"text {k}") for k, r in enumerate(roles)]
    got = chat_roles.formatted(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)).collect()
    assert len(got) == len(rows)
    for conv in want:
        mine = sorted((r for r in got if r.conv_id == conv), key=lambda r: r.turn)
        shown = "".join(r.rendered for r in mine)
        roles = [x.split("|>")[0] for x in shown.split("<|")[1::2]]
        states = [chat_roles.NAMES.index(x) for x in roles]
        assert all(e in chat_roles.LEGAL for e in zip([0, *states], states)) and states[-1] in chat_roles.FINAL
        extra = 2 if mine[-1].new_role == "system" else 0
        assert sum(r.cost for r in mine) + extra == want[conv]


def test_chat_costs_of_every_sequence():
    """Against all ways to keep, relabel, merge or put a turn in between, spelt out here."""
    import itertools

    follows = {None: "su", "s": "u", "u": "a", "a": "u"}
    ids = {"s": 1, "u": 2, "a": 3, "?": None}

    def cheapest(roles):
        best = []
        ways = [(to, way) for to in "sua" for way in ("plain", "merge", *"sua")]
        for choice in itertools.product(ways, repeat=len(roles)):
            last, cost = None, 0
            for role, (to, way) in zip(roles, choice):
                cost += 0 if role == to else 1 if role == "?" else 3
                if way == "plain":
                    ok = to in follows[last]
                elif way == "merge":
                    ok, cost = last == to, cost + 1
                else:
                    ok, cost = way in follows[last] and to in follows[way], cost + 2
                if not ok:
                    break
                last = to
            else:
                best.append(cost + (0 if last in "ua" else 2))
        return min(best)

    for n in (1, 2, 3):
        for roles in itertools.product("sua?", repeat=n):
            numbers = [ids[r] for r in roles]
            path = chat_roles.states([chat_roles.matrix(numbers)])
            steps = chat_roles.repair(numbers, path[0], path[1])
            assert sum(x.cost for x in steps) + (0 if path[1] in chat_roles.FINAL else chat_roles.INSERT) == cheapest(roles) == _cost(numbers), roles


def test_chat_trees_and_full_chunks(spark, monkeypatch):
    """Long conversations by small chunks and fans, and many turns of one number, cost as much as in one chunk."""
    rng = random.Random(3)
    names = {None: "narrator", 1: "system", 2: " User ", 3: "assistant"}
    rows = [(1, k, names[rng.choice([None, 1, 2, 3])], f"t{k}") for k in range(900)] + [(2, None, names[rng.choice([None, 1, 2, 3])], f"u{k}") for k in range(600)]
    rows += [(None, 7, names[rng.choice([1, 2, 3])], f"v{k}") for k in range(300)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    for fan in (64, 3):
        monkeypatch.setattr(chat_roles, "FAN", fan)
        got = chat_roles.formatted(df).collect()
        assert len(got) == len(rows)
        for conv in (1, 2, None):
            mine = [r for r in got if r.conv_id == conv]
            place = {r.text: r.place for r in df.where(F.col("conv_id").eqNullSafe(F.lit(conv))).withColumn("place", F.xxhash64("role", "text")).collect()}
            order = sorted(mine, key=lambda r: (r.turn or 0, next(p for t, p in place.items() if t in r.rendered.replace("<", "\n").split("\n"))))
            roles = [chat_roles.role_of(r.role) for r in order]
            extra = 2 if order[-1].new_role == "system" else 0
            assert sum(r.cost for r in order) + extra == _cost(roles)


def test_chat_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, chunk string, place string"
    rows = [(None, None, None, None, "x", "y"), (None, None, None, None, "x", "y"), (1, 5, "system", "", "x", "y"), (2, 0, "user", "z" * 100_000, "x", "y"), (2, 0, "user", "a", "x", "y")]
    assert chat_roles.formatted(spark.createDataFrame(rows, schema)).count() == 5
    assert chat_roles.formatted(spark.createDataFrame([], schema)).count() == 0
