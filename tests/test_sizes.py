import itertools
import re

import pytest

from scriptorium.operators import filters, joins, reconcile, rescue, skeleton
from scriptorium.plans import lifecycle

ROWS = "paper int, seq int, label string, body string, urls array<string>, warnings array<string>, needs_review boolean"


def _plan(df):
    return df._jdf.queryExecution().sparkPlan().toString()


@pytest.fixture
def filed(spark, tmp_path):
    """Rows read from a small file, which Spark would send whole."""

    def run(rows, schema):
        path = str(tmp_path / str(len(list(tmp_path.iterdir()))))
        spark.createDataFrame(rows, schema).write.parquet(path)
        return spark.read.schema(schema).parquet(path)

    return run


def test_boxes_are_not_sent_whole(filed):
    left = filed([(1, 1, 0.0, 0.0, 5.0, 5.0)], "page int, id int, x0 double, y0 double, x1 double, y1 double")
    right = filed([(1, 2, 1.0, 1.0, 9.0, 9.0)], "page int, d_id int, d_x0 double, d_y0 double, d_x1 double, d_y1 double")
    found = filters.overlaps(left, right, ["page"])
    assert "Broadcast" not in _plan(found) and [r.common for r in found.collect()] == [16.0]


def test_missing_ids_are_not_sent_whole(filed):
    rows = filed([(1, 0, "2.a", "2(a) both", [], [], False)], ROWS)
    missing = filed([(1, "2.a.i")], "paper int, id string")
    pages = filed([(1, 0, "2(a)(i) Find the whole angle.")], "paper int, page int, page_text string")
    found = rescue.split_rows(rows, missing, pages)
    assert "Broadcast" not in _plan(found) and [r.body for r in found.collect()] == ["2(a)(i) Find the whole angle."]


TASK = "find the area of the whole shape"


def test_copied_tasks_of_many_rows_are_one_link(spark):
    """Rows that repeat a task are not met in pairs."""
    rows = [(1, f"7.{c}", f"7({c}) {TASK}{end}") for c, end in (("a", ""), ("b", ""), ("c", "s"), ("d", " and of nothing else")) for _ in range(300)]
    df = spark.createDataFrame([*rows, (2, "7.e", f"7(e) {TASK}"), (None, "7.f", f"7(f) {TASK}")], "paper int, label string, body string").cache()
    got = sorted(tuple(r) for r in joins.copied_tasks(df.where("label <> '7.b'"), df).collect())
    assert got == [(1, a, b) for a, b in (("7.a", "7.b"), ("7.a", "7.c"), ("7.c", "7.a"), ("7.c", "7.b"))]


def test_papers_are_not_sent_whole(filed):
    rows = filed([(1, 0, "2.a", "2(a) both (b) too", [], [], False)], ROWS)
    expected = filed([(1, 0, "2.a"), (1, 1, "2.b")], "paper int, pos int, id string")
    lines = filed([(1, 0, 0, 50.0, 10.0, "2(a) Find the angle")], "paper int, page int, line_no int, x0 double, y0 double, line string")
    hints = reconcile.split_hints(rows, expected.where("id = '2.b'"))
    plans = [skeleton.skeleton(lines, expected), skeleton.page_roots(lines, expected), reconcile.reconciled(rows, expected), hints, reconcile.split_warnings(rows, hints)]
    assert not [k for k, df in enumerate(plans) if "Broadcast" in _plan(df)]
    raw = filed([(1, 0, "2(a)")], "paper int, pos int, value string")
    answers = filed([(1, 9, "2.a", "2(a) again")], "paper int, seq int, label string, body string")
    out = lifecycle.question_paper(lines, raw, answers)
    assert "Broadcast" not in _plan(out) and [[q.body for q in r.questions] for r in out.collect()] == [["2(a) Find the angle"]]


def test_rescues_meet_the_different_tasks_only(spark):
    """Before the tasks of rows meet, they are made distinct."""
    rescued = spark.createDataFrame([(1, 0, f"7.{c}", f"7({c}) {t}", ["u"], [], False) for c, t in (("a", "find the first area"), ("b", "find the second area"), ("b", "find the second area"))], ROWS)
    rows = spark.createDataFrame([(1, "7.c", "7(c) Find the first area!")] * 50, "paper int, label string, body string")
    missing = spark.createDataFrame([(1, "7.a"), (1, "7.b")], "paper int, id string")
    found = filters.accepted_rescues(rescued, missing, rows)
    assert sorted(r.label for r in found.collect()) == ["7.b", "7.b"]
    assert re.search(r"Aggregate \[paper#\d+, parent#\d+, sibling_task#\d+\]", found._jdf.queryExecution().optimizedPlan().toString())


def test_coords_meet_the_lowest_row_of_a_key(spark):
    """Of a key one row goes into the join, not all of them with all of its coords."""
    wanted = spark.createDataFrame([("k", s, p, f"{s}-{p}") for s in (9, 4, 4, 7) for p in (2, 1)] + [("l", 3, None, "l"), ("m", 1, 1, "m"), (None, 0, 0, "none")], "key string, seq int, priority int, name string")
    coords = spark.createDataFrame([("k", 1), ("k", 2), ("l", 2), ("n", 3), (None, 4)], "key string, coord_id int")
    found = joins.consumed_once(wanted, coords, "key")
    assert sorted(found.columns) == ["coord_id", "key", "name", "priority", "seq"]
    assert sorted((r.coord_id, r.key, r.seq, r.priority, r.name) for r in found.collect()) == [(1, "k", 4, 1, "4-1"), (2, "l", 3, None, "l")]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "min_by" in plan and plan.index("Join") < plan.index("min_by")


def test_parity_in_one_aggregate(filed):
    ids = lambda *x: filed([(i,) for i in x], "k string")
    found = joins.parity(ids("a", "b", "b", None), ids("b", "c", None, None), "k")
    assert sorted(tuple(r) for r in found.where("k IS NOT NULL").collect()) == [("a", "extra"), ("b", "exact"), ("c", "missing")]
    assert sorted(r.status for r in found.where("k IS NULL").collect()) == ["extra", "missing"]
    assert "Join" not in _plan(found)


def test_tasks_are_read_from_the_different_texts_only(spark):
    """Labels are looked for once a text, not in each row that repeats it."""
    df = spark.createDataFrame([(1, f"7.{c}", f"7({c}) {TASK}") for c in "ab" for _ in range(50)], "paper int, label string, body string")
    found = joins.copied_tasks(df, df)
    plan = found._jdf.queryExecution().optimizedPlan().toString().splitlines()
    depth = lambda line: len(re.match(r"[\s:+-]*", line)[0])
    once = [k for k, line in enumerate(plan) if re.search(r"Aggregate \[paper#\d+, label#\d+, body#\d+\]", line)]
    under = [line for k in once for line in itertools.takewhile(lambda x, k=k: depth(x) > depth(plan[k]), plan[k + 1 :])]
    assert once and under and not [line for line in under if "regexp_replace" in line]
    assert sorted(tuple(r) for r in found.collect()) == [(1, "7.a", "7.b"), (1, "7.b", "7.a")]


def test_a_paper_is_told_its_ids_once():
    """Of a paper's lines the first has the expected ids."""
    scan = skeleton.Scan()
    got = [scan(*line)[0] for line in (("1 Work it out", 40.0, "1", None, "1 Work it out", ["1", "1.a"]), ("(a) Find x", 50.0, "", ["a"], "Find x", None), ("9 no such", 40.0, "9", None, "9 no such", None))]
    assert got == ["1\x1f1 Work it out", "1.a\x1f1 Work it out 1(a) Find x", "1.a\x1f9 no such"]


def test_long_thin_boxes_meet_what_is_near(spark):
    """Wide flat boxes and narrow tall ones share few cells with boxes that they do not overlap, also where both sides are the same table."""
    sizes = "CASE id % 3 WHEN 0 THEN 700.0D WHEN 1 THEN 3.0D ELSE 12.0D END AS w", "CASE id % 3 WHEN 0 THEN 4.0D WHEN 1 THEN 900.0D ELSE 9.0D END AS h"
    boxes = spark.range(3000).selectExpr("id", "0 AS page", "(id * 37 % 2000) * 1.0D AS x0", "(id * 91 % 3000) * 1.0D AS y0", *sizes).selectExpr("page", "id", "x0", "y0", "x0 + w AS x1", "y0 + h AS y1")
    marks = boxes.toDF(*(c if c == "page" else f"d_{c}" for c in boxes.columns))
    pairs = boxes.join(marks, "page").where("x0 < d_x1 AND d_x0 < x1 AND y0 < d_y1 AND d_y0 < y1").select("id", "d_id")
    want, got = ({tuple(r) for r in df.collect()} for df in (pairs, filters.overlaps(boxes, marks, ["page"], 8.0).select("id", "d_id")))
    one, other = filters.celled(boxes, marks, 8.0)
    assert got == want and one.join(other, ["page", "__level", "__x", "__y"]).count() < 6 * len(want) < 3000 * 3000 // 2


def test_all_rounds_go_through_the_pages_once(filed):
    """Ids, labels and pages are brought together once, not once a round; nothing is written on the way."""
    rows = filed([(1, 0, "2.a", "2(a) both", [], None, False), (1, 1, "2.a", "again", [], ["w"], False)], ROWS)
    expected = filed([(1, x) for x in ("2.a", "2.a.i", "2.a.ii.b", "2.a.ii.b.i", "2", "7.a")], "paper int, id string")
    pages = filed([(1, None, "2(a)(i) Another page, without a number."), (1, 0, "2(a)(i) Find the angle. 2(a)(ii)(b) Show that it holds. (i) Explain the rule.")], "paper int, page int, page_text string")
    found = rescue.rescued(rows, expected, pages)
    plan = _plan(found)
    assert len(re.findall(r"FileScan parquet \[[^\]]*page_text", plan)) == 1 and "Broadcast" not in plan and "ExistingRDD" not in plan
    got = {r.label: r for r in found.where("round > 0").collect()}
    assert {k: r.round for k, r in got.items()} == {"2.a.i": 1, "2.a.ii.b": 1, "2.a.ii.b.i": 2}
    assert got["2.a.i"].body == "2(a)(i) Find the angle."
    assert got["2.a.ii.b.i"].warnings == ["split from 2.a with page text", "split from 2.a.ii.b with page text"] and got["2.a.ii.b.i"].seq == 0


def test_rounds_take_the_first_source():
    """Siblings in order before parents, parents before grandparents, of the rows before the round."""
    run = lambda held, ids, most=9: [(ids[x["n"]], x["round"], x["at"], x["sources"]) for x in rescue.in_rounds(held, ids, most)]
    assert run(["2", "2.b", "2.a", "2.b"], ["2.c", "2.b", "2.b.i", "2.b.ii.c", "3", "3.a"]) == [("2.c", 1, 1, ["2.b"]), ("2.b.i", 1, 1, ["2.b"]), ("2.b.ii.c", 1, 1, ["2.b"])]
    assert run(["2.a"], ["2.a.i.b.c.d", "2.a.i.b", "2.a.i.b.c", "2.a.i.b.i"]) == [("2.a.i.b", 1, 0, ["2.a"]), ("2.a.i.b.c.d", 2, 0, ["2.a", "2.a.i.b"]), ("2.a.i.b.c", 2, 0, ["2.a", "2.a.i.b"]), ("2.a.i.b.i", 2, 0, ["2.a", "2.a.i.b"])]
    assert [x[0] for x in run(["2.a"], ["2.a.i.b", "2.a.i.b.c"], 1)] == ["2.a.i.b"] and run([], ["2.a"]) == run(["2.a"], []) == []
