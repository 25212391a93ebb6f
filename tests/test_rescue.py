import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scriptorium.operators import rescue, validate

ROWS = "paper int, seq int, label string, body string, urls array<string>, warnings array<string>, needs_review boolean"


def test_rescue_in_rounds(spark):
    rows = [(1, 0, "2.a", "2(a) both", ["u"], ["w"], False), (1, 1, "2.a", "again", [], [], False), (2, 0, "3", "3 alone", [], [], False), (None, 0, "2.a", "no paper", [], [], False)]
    pages = [
        (1, 0, "12(a)(i) not this one 2(a)(i) short 2 (a) (ii)  Work out\n the sum f(x). (b) other"),
        (1, 1, "2(a)(i) Find the whole angle. 2(a)(iii)(b) Show that it holds. (ii) Explain it in words."),
        (2, 0, "2(a)(i) a page of another paper"), (2, 1, None), (None, 0, "2(a)(i) a page of no paper"),
    ]
    expected = [(1, x) for x in ("2.a.i", "2.a.ii", "2.a.iii", "2.a.iii.b", "2.a.iii.b.ii", "2.a.iii.b.ii", "9.a", None)] + [(2, "3.a"), (None, "2.a.i")]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    args = spark.createDataFrame(expected, "paper int, id string"), spark.createDataFrame(pages, "paper int, page int, page_text string")
    got = {(r.label, r.round): r for r in rescue.rescued(df, *args).where("paper = 1 AND round > 0").collect()}
    assert {k: r.body for k, r in got.items()} == {
        ("2.a.i", 1): "2(a)(i) Find the whole angle.", ("2.a.ii", 1): "2(a)(ii) Work out the sum f(x).",
        ("2.a.iii.b", 1): "2(a)(iii)(b) Show that it holds.", ("2.a.iii.b.ii", 2): "2(a)(iii)(b)(ii) Explain it in words."}
    one = got["2.a.i", 1]
    assert one.urls == [] and one.needs_review and one.warnings == ["w", "split from 2.a with page text"]
    assert {r.round for r in rescue.rescued(df, *args, most_rounds=1).collect()} == {0, 1}
    assert rescue.rescued(df.limit(0), *args).count() == 0
    assert rescue.rescued(df, args[0].limit(0), args[1]).count() == len(rows)


@pytest.mark.parametrize("text,leaves", [
    ("(i) x = 2 [1]\n(ii) y = 3 [1]\n(iii) z = 4 [1]", [("8.a.i", "x = 2 [1]"), ("8.a.ii", "y = 3 [1]"), ("8.a.iii", "z = 4 [1]")]),
    ("M1 (I) f(x) and f(v), see (i) ( II ) then (iv)", [("8.a.i", "f(x) and f(v), see (i)"), ("8.a.ii", "then"), ("8.a.iv", None)]),
    ("(i) alone (i) again", None), ("nothing", None), (None, None), ("", None),
])
def test_leaves_of_groups(spark, text, leaves):
    rows = spark.createDataFrame([(0, "8.a", text, None), (1, "8", text, ["w"]), (2, "8.a.i", text, None), (3, None, text, None)], "k int, label string, body string, warnings array<string>")
    got = rescue.group_leaves(rows, "label", "body", "warnings").orderBy("k", "leaf").collect()
    assert [(r.label, r.body) for r in got if r.k == 0] == ([("8.a", text)] if leaves is None else [(x, text if t is None else t) for x, t in leaves])
    assert [(r.label, r.body, r.warnings, r.leaf) for r in got if r.k] == [("8", text, ["w"], 0), ("8.a.i", text, None, 0), (None, text, None, 0)]
    assert all(r.warnings == ["expanded from 8.a"] for r in got if r.k == 0 and r.leaf)


def test_consistency_like_plain_cosines(spark):
    rows = [(1, "Find the derivative of sin 12", "derivative is cos 12"), (2, "one two", "three 4"), (3, None, "word"), (4, "", ""), (5, "same words here", "same words here"), (6, "the sum 7 7", "the sum 8")]
    words = lambda t: Counter(re.findall(r"[a-z]{3,}|\d+", (t or "").lower()))
    df = Counter(w for _, *texts in rows for t in texts for w in words(t))
    weight = {w: math.log((1 + 2 * len(rows)) / (1 + n)) + 1 for w, n in df.items()}
    got = {r.k: r for r in validate.semantic_consistency(spark.createDataFrame(rows, "k int, a string, b string"), "k", "a", "b").collect()}
    for k, *texts in rows:
        a, b = ({w: n * weight[w] for w, n in words(t).items()} for t in texts)
        norm = math.sqrt(sum(v * v for v in a.values()) * sum(v * v for v in b.values()))
        assert got[k].cosine == pytest.approx(sum(v * b.get(w, 0) for w, v in a.items()) / norm if norm else 0, abs=2e-6) and got[k].terms == len(a.keys() & b.keys())
    assert [got[k].verdict for k in (2, 3, 5)] == ["block", "block", "ok"] and not got[6].numbers and got[6].verdict == "review"


@pytest.mark.parametrize("common", [(100_000, 40), (2, 40), (100_000, 4), (0, 40)])
def test_consistency_with_few_common_words(spark, common):
    """Which weights are sent to all tasks changes nothing, and words that all are common are not shuffled."""
    rows = [(1, "the sum of 12 sines", "sines are 12"), (2, "the tangent", "the cosine 4"), (3, None, "the"), (4, "same words the the", "same words the")]
    df = spark.createDataFrame(rows, "k int, a string, b string")
    found = validate.semantic_consistency(df, "k", "a", "b", *common)
    weight = {w: math.log(9 / (1 + n)) + 1 for w, n in Counter(w for r in rows for t in r[1:] for w in set(re.findall(r"[a-z]{3,}|\d+", t or ""))).items()}
    for r in found.collect():
        a, b = (Counter(re.findall(r"[a-z]{3,}|\d+", t or "")) for t in rows[r.k - 1][1:])
        dot = lambda x, y: sum(n * y[w] * weight[w] ** 2 for w, n in x.items())
        assert r.cosine == pytest.approx(dot(a, b) / math.sqrt(dot(a, a) * dot(b, b)) if a and b else 0, abs=2e-6) and (r.terms, r.numbers) == (len(a.keys() & b.keys()), r.k != 2)
    joins = re.findall(r"SortMergeJoin.*", found.select("terms")._jdf.queryExecution().sparkPlan().toString())
    assert any("word" in j for j in joins) == (common != (100_000, 40))
