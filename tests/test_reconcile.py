import pytest

from scriptorium.operators import reconcile

ROWS = "paper int, seq int, label string, body string, urls array<string>, warnings array<string>, needs_review boolean"
#: Families of ids whose outcome is given, and some of our own behind them.
CASES = [
    (["5.a", "5.i", "5.i.a", "5.i.b", "5.ii.a", "5.ii.b"], ["5.a", "5.b"], ["5.a", "5.b.i", "5.b.i.a", "5.b.i.b", "5.b.ii.a", "5.b.ii.b"]),
    (["7.i", "7.i.a", "7.ii.a", "7.ii.b"], ["7.a.i", "7.a.ii", "7.a.ii.a", "7.a.ii.b"], ["7.a.i", "7.a.i.a", "7.a.ii.a", "7.a.ii.b"]),
    (["5.i"], ["5.a.i", "5.b.i"], ["5.i"]),
    (["5.b.i", "5.i"], ["5.b.i", "5.b.ii"], ["5.b.i", "5.i"]),
    (["5.a", "5.b", "5.ii"], ["5.a.ii", "5.b.ii"], ["5.a", "5.b", "5.b.ii"]),  # the current letter decides between two
    (["5.ii", "5.a.ii"], ["5.a.ii"], ["5.a.ii", "5.a.ii"]),  # only rows before it take an id
    (["5.x"], ["5.a.x"], ["5.x"]),
    (["2.ii", "2.ii"], ["2.c.ii"], ["2.c.ii", "2.ii"]),
]


@pytest.mark.parametrize(("ids", "expected", "want"), CASES)
def test_lost_letters(ids, expected, want):
    rows = [reconcile.Row(k, tuple(i.split(".")), "text", [], [], False) for k, i in enumerate(ids)]
    assert [".".join(r.parts) for r in reconcile.decided(rows, expected)] == want


def test_tables(spark):
    rows = [
        (1, 0, "7", "7 Table (a) Find x", [], [], False),
        (2, 0, "7", "7 A stem with a picture", ["http://d"], [], False),
        (2, 1, "7.a", "7(a) Find y", ["http://own"], [], False),
        (3, 0, "5.i", "5(i) text", [], ["QP embedded subpart guard corrected 5.a to 5.i."], True),
        (4, 0, "1", "alone", [], [], True),
        (None, 0, "5.i", "5(i) no paper", [], [], False),
        (None, 1, "5.i", "5(i) no paper", [], [], False),
    ]
    expected = [(1, 0, "7.a"), (1, 1, "7.c.i"), (2, 0, "7.a"), (3, 0, "5.b.i")]
    df = spark.createDataFrame(rows, ROWS).repartition(3)
    out = reconcile.reconciled(df, spark.createDataFrame(expected, "paper int, pos int, id string")).orderBy("paper", "seq").collect()
    assert [(r.paper, r.label) for r in out] == [(None, "5.i"), (None, "5.i"), (1, "7.a"), (2, "7.a"), (3, "5.b.i"), (4, "1")]
    assert out[3].body == "7(a) A stem with a picture Find y" and out[3].urls == ["http://own", "http://d"]
    assert out[4].body == "5(b)(i) text" and out[4].warnings == [] and not out[4].needs_review and out[5].needs_review
    assert reconcile.reconciled(df.limit(0), spark.createDataFrame(expected, "paper int, pos int, id string")).count() == 0


def test_split_hints(spark):
    rows = spark.createDataFrame([(1, 0, "2.a.ii", "2(a)(ii) Both: 2 (a)(i) find, 2(a)(ii) show", [], [], False), (1, 1, "3.a", "other", [], [], False)], ROWS)
    missing = spark.createDataFrame([(1, "2.a.i"), (1, "9.a")], "paper int, id string")
    assert [tuple(r) for r in reconcile.split_hints(rows, missing).collect()] == [(1, "2.a.i", "2.a.ii", 1)]
