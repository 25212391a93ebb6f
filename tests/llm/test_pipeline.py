import base64
import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import mixing, near_dedup, pu_quality

from test_repeats import _multiset
from test_texts import _targets

pytest.importorskip("public_tokenizers")


def _one_a_group(rows, same):
    """The first row of each group of rows that are alike, directly or over others."""
    groups = []
    for r in rows:
        mine = [g for g in groups if any(same(r, x) for x in g)]
        groups = [g for g in groups if g not in mine] + [[x for g in mine for x in g] + [r]]
    return [min(g, key=lambda x: rows.index(x)) for g in groups]


def test_stages_against_plain_versions(spark, odd, odd_rows, labels, tmp_path):
    import corpus_pipeline as cp
    import public_tokenizers as P
    import tiktoken

    odd.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    docs, kept = spark.read.parquet(str(tmp_path / "documents.parquet")), {}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, str(tmp_path))
        out.write.parquet(str(tmp_path / name))
        kept[name], docs = out, spark.read.parquet(str(tmp_path / name))
        if name != cp.STAGES[-1][0]:
            assert docs.columns == odd.columns
    rows = {n: [(r.doc_id, r.text or "", r.source) for r in spark.read.parquet(str(tmp_path / n)).collect()] for n in list(kept)[:-1]}
    scores = pu_quality.scored(odd, pu_quality.fit(odd, labels), ["doc_id", "text", "source"]).collect()
    want = [(r.doc_id, r.text or "", r.source) for r in scores if r.score >= pu_quality.CUT]
    assert Counter(rows["quality classifier"]) == Counter(want) and want
    low = -(1 << 63)
    order = lambda r: low if r[0] is None else r[0]
    last = {}
    for r in sorted(want, key=order):
        last[r[1]] = r
    assert {(r[0], r[1]) for r in rows["exact dedup"]} == {(r[0], r[1]) for r in last.values()} and len(rows["exact dedup"]) == len(last)

    def near(a, b):
        x, y = _multiset(a[1]), _multiset(b[1])
        return x == y or (x and y and sum((x & y).values()) >= near_dedup.THRESHOLD * sum((x | y).values()))

    left = _one_a_group(sorted(rows["exact dedup"], key=order), near)
    assert {(r[0], r[1]) for r in rows["near dedup"]} == {(r[0], r[1]) for r in left} and len(rows["near dedup"]) == len(left)
    sizes = Counter()
    for _, t, s in rows["near dedup"]:
        sizes[s] += len(t.encode().split())
    targets, copies = _targets(sizes), Counter(rows["mixing"])
    got = Counter()
    for (i, t, s), n in copies.items():
        size = len(t.encode().split())
        assert (i, t, s) in rows["near dedup"] and 0 < n <= mixing.MOST and size
        got[s] += n * size
    for s, target in targets.items():
        assert got[s] <= target + 1e-6 and got[s] >= int(target // max(1, sizes[s])) * sizes[s]
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(P.path("byte_bpe_multi_50k.tiktoken"), "rb"))}
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = Counter((r.doc_id, tuple(r.ids), r.decoded_sha256) for r in docs.collect())
    assert coded == Counter((i, tuple(library.encode_ordinary(t)), hashlib.sha256(t.encode()).hexdigest()) for i, t, _ in rows["mixing"])
    assert "text" not in docs.columns


def test_run_and_empty_tables(spark, nothing, labels, tmp_path):
    import corpus_pipeline as cp

    nothing.write.parquet(str(tmp_path / "documents.parquet"))
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    out = cp.run(spark, str(tmp_path))
    assert out.count() == 0 and out.columns == ["doc_id", "lang", "source", "n_chars", "ids", "decoded_sha256"]
    small = cp.run(spark, "/root/testdata/sf0.001")
    assert small.where(F.size("ids") == 0).count() == 0 and small.count() > 50
