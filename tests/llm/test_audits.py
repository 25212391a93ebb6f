import itertools
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scriptorium.llm import filter_audit, source_divergence

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def _audit(rows, marks):
    """Every order walked row by row."""
    texts = [t or "" for _, t, *_ in rows]
    least = {}
    for (i, *_), t in zip(rows, texts):
        least[t] = min(least.get(t, (i is not None, i or 0)), (i is not None, i or 0))
    fails = []
    for (i, *_), t in zip(rows, texts):
        w = WORDS.findall(t)
        fails.append({"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 3 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": (i is not None, i or 0) > least[t]})
    out = {}
    for order in map("".join, itertools.permutations("ABCDE")):
        left = set(range(len(rows)))
        for step, x in enumerate(order, 1):
            gone = {k for k in left if fails[k][x]}
            for part in {r[2] or "" for r in rows}:
                inside = {k for k, r in enumerate(rows) if (r[2] or "") == part}
                marked = [marks.get(rows[k][0], (0, 0)) for k in gone & inside]
                out[part, order, step] = (
                    len((left - gone) & inside), len(gone & inside), len({k for k in inside if fails[k][x]} - left),
                    len({k for k in inside if fails[k][x] and sum(fails[k].values()) == 1}), sum(q for q, _ in marked), sum(t for _, t in marked))
            left -= gone
    shapley = Counter()
    for (part, order, step), v in out.items():
        shapley[part, order[step - 1]] += v[1]
    return {(*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_filters_like_every_order_walked(spark, odd, odd_rows, labels, nothing):
    marks = {r.doc_id: (int(r.quality == 1), int(r.toxic == 1)) for r in labels.collect()}
    twice = labels.unionByName(labels.withColumns({"quality": F.lit(0), "toxic": F.lit(None).cast("int")})).withColumn("part", F.lit("x"))
    got = {tuple(r) for r in filter_audit.audit(odd, twice).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley").collect()}
    assert got == _audit(odd_rows, marks)
    extra = [(100, "$ 5 & more", "en"), (99, "$ 5 & more", "xx"), (101, "SHOUT " * 300, None), (102, "SHOUT " * 300, "xx"), (103, "ÀÉ" * 50 + "AB", "")]
    rows = [(i, t, lang, "s", 0) for i, t, lang in extra]
    got = {tuple(r) for r in filter_audit.audit(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), labels).collect()}
    assert len(got) == 3 * 600 and {r[3] for r in got if r[0] == "xx" and r[2] == 5} == {0}
    assert filter_audit.audit(nothing, labels).count() == 0


def _divergence(rows, least):
    p1 = lambda n, total, v: 1 + 10**9 * (n + 2) // (total + 2 * v)
    f = lambda p, q: (p - q) ** 2 // (p + q)
    docs = [((lang or ""), (source or ""), Counter(TERMS.findall(re.sub("[A-Z]", lambda x: x[0].lower(), t or "")))) for _, t, lang, source, _ in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(t for d in own for t in d[2])
        kept = sorted(t for t in df if df[t] >= least)
        groups = {s: sum((d[2] for d in own if d[1] == s), Counter()) for s in {d[1] for d in own}}
        total = {s: sum(c[t] for t in kept) for s, c in groups.items()}
        p = {s: {t: p1(c[t], total[s], len(kept)) for t in kept} for s, c in groups.items()}
        whole = {t: sum(c[t] for c in groups.values()) for t in kept}
        q = {t: p1(whole[t], sum(whole.values()), len(kept)) for t in kept}
        for s, c in groups.items():
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in groups if o != s]
            telling = [(t, f(p[s][t], q[t])) for t in kept if c[t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", telling, 10)):
                for rank, (item, value) in enumerate(sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most], 1):
                    out.add((lang, s, part, item, value, rank))
    return out


@pytest.mark.parametrize("chunk,block,segment", [(4096, 32, 8), (40, 2, 2)])
def test_divergence_like_all_pairs(spark, small, odd, odd_rows, nothing, monkeypatch, chunk, block, segment):
    for name, value in (("CHUNK", chunk), ("BLOCK", block), ("SEGMENT", segment)):
        monkeypatch.setattr(source_divergence, name, value)
    got = [tuple(r) for r in source_divergence.audit(odd, least=3).collect()]
    assert len(got) == len(set(got)) and set(got) == _divergence(odd_rows, 3)
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").where("doc_id < 90")
    rows = [tuple(r) for r in docs.collect()] + [(-1, None, "none", "a", 0), (-2, "!", "none", "b", 0), (-3, "alone", "one", None, 0)]
    got = [tuple(r) for r in source_divergence.audit(spark.createDataFrame(rows, docs.schema), least=4).collect()]
    assert len(got) == len(set(got)) and set(got) == _divergence(rows, 4)
    assert source_divergence.audit(nothing).count() == 0


def test_counts_given_on_early(odd):
    want = sorted(tuple(r) for r in source_divergence.counts(odd).collect())
    assert want and want == sorted(tuple(r) for r in source_divergence.counts(odd, held=1).collect())


def test_division_in_two_steps(spark):
    rows = [(0, 0, 0), (5, 7, 3), (9_000_000_000_000, 80_000_000_000_000, 1_000_000), (12_345_678_901, 99_999_999_999, 77)]
    got = [r[0] for r in spark.createDataFrame(rows, "n long, total long, v long").select(source_divergence.portion("n", "total", "v")).collect()]
    assert got == [1 + 10**9 * (n + 2) // max(total + 2 * v, 1) for n, total, v in rows]
