import hashlib
import random
import re
from collections import Counter

import numpy as np

from scriptorium.llm import byte_repeats, exact_dedup, near_dedup, packed, word_windows
from scriptorium.llm.components import components
from scriptorium.llm.rolling import every
from scriptorium.llm.shared import written
from scriptorium.llm.suffix_arrays import common_prefixes, suffix_array

LOW = -(1 << 63)


def _id(i):
    return LOW if i is None else i


def test_exact(odd, odd_rows, nothing):
    got = Counter(tuple(r) for r in exact_dedup.decisions(odd).collect())
    groups = {}
    for i, t, *_ in odd_rows:
        groups.setdefault(t or "", []).append(_id(i))
    kept = Counter()
    for (_, keep, size, stays, sha), n in got.items():
        ids = next(g for t, g in groups.items() if hashlib.sha256(t.encode()).hexdigest() == sha)
        assert (_id(keep), size) == (max(ids), len(ids))
        kept[sha] += n * stays
    assert set(kept.values()) == {1} and len(kept) == len(groups) and sum(got.values()) == len(odd_rows)
    out = exact_dedup.keep_one(odd)
    assert out.columns == odd.columns and out.count() == len(groups)
    assert exact_dedup.decisions(nothing).count() == 0


def test_directory_splits_overfull_buckets(spark):
    """Keys that are spread, and keys that agree on their first forty bits."""
    for column, capacity in (("xxhash64(id)", 100), ("shiftleft(77L, 50) + shiftleft(id, 10)", 100), ("xxhash64(id)", 1)):
        keys = spark.range(3000).selectExpr(f"{column} as key")
        slots, depth = exact_dedup.directory(keys, capacity)
        rows = slots.collect()
        cells = Counter((r["key"] & (2**64 - 1)) >> (64 - depth) for r in keys.collect())
        sizes, depths = Counter(), {}
        assert len(rows) == len(cells)
        for r in rows:
            sizes[r.bucket] += cells[r.cell]
            depths[r.bucket] = r.local_depth
            assert r.cell >> (depth - r.local_depth) << (depth - r.local_depth) == r.bucket
        assert max(sizes.values()) <= capacity and sum(sizes.values()) == 3000
        for b, local in depths.items():  # the bucket above each was overfull
            top = b >> (depth - local + 1)
            assert sum(n for c, n in cells.items() if c >> (depth - local + 1) == top) > capacity


def test_exact_in_small_buckets(odd):
    want = sorted(map(str, exact_dedup.decisions(odd).collect()))
    assert sorted(map(str, exact_dedup.decisions(odd, capacity=2).collect())) == want


def _words_brute(rows):
    first = {}
    docs = [(_id(i), (t or "").encode().split()) for i, t, *_ in rows]
    for i, w in docs:
        for j in range(len(w) - 49):
            k = tuple(w[j : j + 50])
            first[k] = min(first.get(k, i), i)
    out = Counter()
    for i, w in docs:
        gone = [False] * len(w)
        for j in range(len(w) - 49):
            if first[tuple(w[j : j + 50])] < i:
                gone[j : j + 50] = [True] * 50
        out[i, len(w), sum(gone), hashlib.sha256(b" ".join(x for x, g in zip(w, gone) if not g)).hexdigest()] += 1
    return out


def test_word_windows_twice_in_a_later_document(spark):
    """A passage that stands twice in a document, a multiple of the period apart, or in two rows of one id, goes each time where another task has the smaller id."""
    rng = random.Random(11)
    words = lambda n: [f"w{rng.randrange(10**9)}" for _ in range(n)]
    passage = words(63)
    tasks = [[(1, words(40) + passage)], [(5, words(17) + passage + words(92) + passage + words(5))], [(7, passage + words(33)), (7, words(186) + passage)]]
    rows = [[(i, " ".join(w)) for i, w in task] for task in tasks]
    docs = spark.createDataFrame(spark.sparkContext.parallelize(rows, 3).flatMap(lambda task: task), "doc_id long, text string")
    got = Counter((_id(r.doc_id), *r[1:]) for r in word_windows.digests(docs).collect())
    assert got == _words_brute([r for task in rows for r in task])


def test_word_windows(odd, odd_rows, nothing):
    got = Counter((_id(r.doc_id), *r[1:]) for r in word_windows.digests(odd).collect())
    assert got == _words_brute(odd_rows)
    assert word_windows.digests(nothing).count() == 0
    kept = Counter((_id(r.doc_id), hashlib.sha256(r.text.encode()).hexdigest()) for r in word_windows.removed(odd).collect())
    want = Counter()
    for (i, _, _, sha), n in got.items():
        want[i, sha] += n
    assert kept == want


def test_words_whose_polynomial_hashes_collide(spark):
    """Thue-Morse words: every polynomial modulo 2**64 in an odd base takes them for equal."""
    one = "".join("ab"[bin(k).count("1") % 2] for k in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    assert len(set(every(np.frombuffer((one + other).encode(), np.uint8), 2048)[[0, 2048]].tolist())) == 1
    around = [f"w{k}" for k in range(49)]
    rows = [(1, " ".join([*around[:25], one, *around[25:]])), (2, " ".join([*around[:25], other, *around[25:]])), (3, " ".join([*around[:25], one, *around[25:]]))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in word_windows.digests(df).collect()} == {1: 0, 2: 0, 3: 50}
    x = near_dedup.shingles([t for _, t in rows])
    assert (x[1][:46] == x[1][46:92]).sum() == 41 and (x[1][:46] == x[1][92:]).all()


def test_pieces_of_long_texts(monkeypatch):
    rng = np.random.default_rng(3)
    text = rng.integers(97, 101, 5000, dtype=np.uint8).tobytes()
    words = b" ".join(b"w%d" % k for k in rng.integers(0, 9, 3000))

    def places():
        byte, word = set(), set()
        for d, rows, base in byte_repeats._groups([b"x" * 120, text]):
            byte |= set(zip(rows[d.owner].tolist(), (d.starts - d.offsets[d.owner] + base[d.owner]).tolist(), d.seeds[d.minimizer].tolist()))
        for w, rows in word_windows._groups([b"too short", words]):
            at, hashes = w.anchors()
            word |= set(zip(rows[w.owner[at]].tolist(), w.place[at].tolist(), hashes.tolist()))
        return byte, word

    whole = places()
    monkeypatch.setattr(packed, "PIECE", 700)
    assert places() == whole


def test_packing(nothing):
    rng = np.random.default_rng(1)
    columns = [rng.integers(-(1 << 62), 1 << 62, 1000) for _ in range(3)]
    assert all((a == b).all() for a, b in zip(packed.unpack(packed.pack(*columns), 3), columns))
    strings = [b"", b"abc", b"\0" * 9]
    assert packed.unpack_strings(packed.pack_strings(strings), np.array([0, 3, 9])) == strings
    assert packed.packed_texts(packed.documents(nothing)[0], 5).count() == 0


def test_difference_cover():
    c, v = word_windows.COVER, word_windows.PERIOD
    assert {(a - b) % v for a in c for b in c} == set(range(v))


def _bytes_brute(rows):
    seen, out = {}, Counter()
    docs = [(_id(i), (t or "").encode()) for i, t, *_ in rows]
    for i, w in docs:
        for j in range(len(w) - 99):
            seen.setdefault(w[j : j + 100], set()).add((i, w, j)) if len(w) < 30_000 else None
    return seen, out, docs


def test_byte_repeats(spark, odd_rows, nothing):
    rows = [r for r in odd_rows if r[1] is None or len(r[1]) < 30_000]
    seen, _, docs = _bytes_brute(rows)
    want = Counter()
    for i, w in docs:
        gone = bytearray(len(w))
        for j in range(len(w) - 99):
            if any(a < i or (a == i and x == w and k < j) for a, x, k in seen[w[j : j + 100]]):
                gone[j : j + 100] = b"\1" * 100
        kept = bytes(x for x, g in zip(w, gone) if not g)
        want[i, len(w), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()] += 1
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    for hot in (8192, 2):  # with and without common minimizers
        byte_repeats.HOT, old = hot, byte_repeats.HOT
        try:
            assert Counter((_id(r.doc_id), *r[1:]) for r in byte_repeats.digests(df).collect()) == want, hot
        finally:
            byte_repeats.HOT = old
    assert byte_repeats.digests(nothing).count() == 0


def test_byte_repeats_of_rows_in_one_task(spark):
    rng = random.Random(6)
    own, passage = ("".join(rng.choice("abcdefgh") for _ in range(n)) for n in (300, 150))
    rows = [(7, own + passage), (7, own + passage), (9, passage + own[:40]), (9, passage + own[:40])]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    assert Counter((r.doc_id, r.n_removed) for r in byte_repeats.digests(df).collect()) == {(7, 0): 2, (9, 150): 2}


def test_byte_repeats_takes_everything(odd, odd_rows):
    want = Counter((r.doc_id, r.kept_sha256) for r in byte_repeats.digests(odd).collect())
    assert Counter((r.doc_id, hashlib.sha256(r.kept).hexdigest()) for r in byte_repeats.removed(odd).collect()) == want
    assert sum(want.values()) == len(odd_rows)


def test_suffix_arrays():
    rng = random.Random(3)
    for _ in range(400):
        s = np.array([rng.randint(0, rng.choice([1, 2, 4])) for _ in range(rng.randint(1, 50))])
        order = suffix_array(s)
        want = sorted(range(len(s)), key=lambda i: s[i:].tolist())
        assert order.tolist() == want
        shared = common_prefixes(s, order).tolist()
        for k in range(1, len(s)):
            a, b = s[want[k - 1] :].tolist(), s[want[k] :].tolist()
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == n


def _multiset(text):
    w = (text or "").encode().split()
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def test_near_duplicates(odd, odd_rows, nothing):
    sets = [(_id(i), _multiset(t)) for i, t, *_ in odd_rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if x == y or (x and y and sum((x & y).values()) >= 0.8 * sum((x | y).values())):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(sets):
        least[find(k)] = min(i, least.get(find(k), i))
    want = Counter((i, least[find(k)]) for k, (i, _) in enumerate(sets))
    got = near_dedup.decisions(odd).collect()
    assert Counter((_id(r.doc_id), _id(r.class_id)) for r in got) == want
    out = near_dedup.keep_one(odd)
    assert out.columns == odd.columns and out.count() == len(least)
    assert near_dedup.decisions(nothing).count() == 0 and near_dedup.keep_one(nothing).count() == 0


def test_near_duplicates_in_blocks(spark, monkeypatch):
    rng = random.Random(9)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for i in range(60):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(200)] = f"x{rng.random()}"
        rows.append((i, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {tuple(r) for r in near_dedup.decisions(df).select("doc_id", "class_id").collect()}
    # small blocks and levels, and groups that fall into parts
    for block, few in ((7, 100), (7, 1), (4, 1)):
        monkeypatch.setattr(near_dedup, "BLOCK", block)
        monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", block - 1)
        monkeypatch.setattr(near_dedup, "FEW", few)
        assert {tuple(r) for r in near_dedup.decisions(df).select("doc_id", "class_id").collect()} == whole, (block, few)


def test_rows_of_a_large_family(spark, monkeypatch):
    """Every class of a family reaches the comparison a few times, not once for each block of it."""
    monkeypatch.setattr(near_dedup, "CLUSTER_BLOCK", 16)
    n = 2000
    registers = np.random.default_rng(1).integers(0, 1 << 16, near_dedup.REGISTERS, dtype=np.uint16)
    rows = []
    for k in range(n):
        own = registers.copy()
        own[k % 70] = k
        rows.append((1, n, k.to_bytes(16, "big"), own.tobytes()))
    df = spark.createDataFrame(rows, "grp long, n long, cls binary, registers binary")
    seen = spark.sparkContext.accumulator(0)

    def counted(t):
        seen.add(len(t))
        return near_dedup._by_registers(t)

    edges = near_dedup._linked(df, 16, ["registers"], counted, "family")
    assert components(edges).select("root").distinct().count() == 1
    assert seen.value < 3 * n


def test_signatures_are_unbiased():
    rng, off = np.random.default_rng(0), []
    for _ in range(60):
        a = {int(k): int(rng.integers(1, 7)) for k in range(60)}
        b = {k: max(1, v + int(rng.integers(-1, 2))) for k, v in a.items() if rng.random() < 0.95}
        same = sum(min(a[k], b.get(k, 0)) for k in a) / sum(max(a[k], b.get(k, 0)) for k in a)
        x, y = (near_dedup.signatures(np.zeros(len(c), np.int64), near_dedup.mix(np.array(list(c), np.uint64)), np.array(list(c.values())), 1) for c in (a, b))
        off.append((x == y).mean() - same)
    assert abs(np.mean(off)) < 0.03


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(250)] + [(1000 + k, 1001 + k) for k in range(60)]
    edges = [(a, b) for a, b in edges if a != b]
    got = components(written(spark.createDataFrame(edges, "a long, b long"), "edges")).collect()
    root = {r.node: r.root for r in got}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    assert len(got) == len(parent)
    assert {(find(a) == find(b)) == (root[a] == root[b]) for a in list(parent)[:60] for b in parent} == {True}
