import difflib
import random

from pyspark.sql import functions as F

from scriptorium.functions import text
from scriptorium.operators import joins


def _texts(spark, small, n):
    """Sentences of the given documents, and copies of some with a few characters changed."""
    found = spark.read.parquet(f"{small}/documents.parquet").select(F.explode(F.split("text", r"(?<=[.!?])\s+")).alias("t")).where("length(t) BETWEEN 20 AND 120").select(F.lower(F.trim(F.regexp_replace("t", r"\s+", " "))).alias("t"))
    rng, base = random.Random(3), sorted({r.t for r in found.collect()})
    base = rng.sample(base, n)
    changed = ["".join(c for c in t if rng.random() > 0.05) for t in base[: n // 10]]
    return base, changed + rng.sample(base, n - len(changed))


def test_subsequences_bound_the_ratio():
    rng = random.Random(1)
    for _ in range(3000):
        a, b = ("".join(rng.choice("abc d") for _ in range(rng.randint(1, 30))) for _ in range(2))
        table = [[0] * (len(b) + 1)]
        for x in a:
            row = [0]
            for j, y in enumerate(b):
                row.append(table[-1][j] + 1 if x == y else max(row[-1], table[-1][j + 1]))
            table.append(row)
        assert text.common_subsequence(a, b) == table[-1][-1]
        ratio = difflib.SequenceMatcher(None, a, b).ratio()
        assert text.reaches(a, b, ratio) and not text.reaches(a, b, 2 * table[-1][-1] / (len(a) + len(b)) + 0.01)


def test_few_pairs_reach_the_ratio(spark, small):
    left, right = _texts(spark, small, 250)
    reached = sum(text.reaches(a, b, joins.FUZZY) for a in left for b in right)
    assert 250 < reached * 10 < len(left) * len(right)


def test_alike_like_all_pairs(spark, small):
    left, right = _texts(spark, small, 120)
    left, right = [*left, "", "  ", None, "x", left[0].upper()], [*right, "", None, "x", "xy"]
    frame = lambda rows, side: spark.createDataFrame([(k % 2 or None, k, t) for k, t in enumerate(rows)], f"b int, {side}_id int, {side}_text string")
    tidy = lambda t: " ".join((t or "").lower().split())
    for least in (0.05, 0.5, joins.FUZZY, 1.0):
        want = {}
        for i, a in enumerate(left):
            for j, b in enumerate(right):
                if i % 2 and j % 2 and tidy(a) and tidy(b):  # a null block is no block
                    ratio = difflib.SequenceMatcher(None, tidy(a), tidy(b)).ratio()
                    if ratio >= least:
                        want[i, j] = ratio
        got = {(r.l_id, r.r_id): r.ratio for r in joins.alike(frame(left, "l"), frame(right, "r"), "b", least).collect()}
        assert got == want and (want or least == 1.0)
    assert joins.alike(frame(left, "l"), frame(right, "r"), "b", 0.5).columns == ["b", "l_id", "l_text", "r_id", "r_text", "ratio"]
