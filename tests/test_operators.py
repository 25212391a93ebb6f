import glob
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from scriptorium.functions import labels
from scriptorium.operators import aggregates, filters, joins, sequence, sets, validate, windows
from scriptorium.plans import queries
from scriptorium.sources import tables
from scriptorium.streaming import ledger

duckdb = pytest.importorskip("duckdb")


@pytest.fixture(scope="session")
def duck(small):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for f in glob.glob(f"{small}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if v != v else round(v, 6)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return round(float(v), 6) if type(v).__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query_like_its_sql(spark, small, duck, name):
    df = queries.QUERIES[name](spark, small)
    columns = sorted(df.columns)
    assert len(set(columns)) == len(columns)
    got = Counter(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    if name not in queries.SQL:
        assert name in ("fuzzy_match", "duplicate_guard") and got
        return
    found = duck.execute(queries.SQL[name])
    names = [x[0] for x in found.description]
    assert sorted(names) == columns
    assert got == Counter(tuple(_plain(r[names.index(c)]) for c in columns) for r in found.fetchall()) and got


def test_parity_and_coverage(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "k string")
    p = joins.parity(ids("a", "b", "b"), ids("b", "c"), "k")
    assert {(r.k, r.status) for r in p.collect()} == {("a", "extra"), ("b", "exact"), ("c", "missing")}
    assert tuple(aggregates.coverage(p).first()) == (1, 1, 1, 0.5)


def test_gaps(spark):
    df = spark.createDataFrame([(1, 1), (1, 4), (2, 1), (2, 2)], "g int, n int")
    assert [tuple(r) for r in aggregates.gaps(df, "g", "n").collect()] == [(1, 2, 2)]
    assert [tuple(r) for r in validate.gap_objects(df, "g", "n").orderBy("expected").collect()] == [(1, 2, 1, 4), (1, 3, 1, 4)]


def test_duplicate_guard(spark):
    rows = [(1, k, x) for k, x in enumerate(["5", "5.c.i", "5.c.i", "5.c.i", "5", "5.z", "5.z"])]
    df = spark.createDataFrame(rows, "p int, s int, label string")
    out = sequence.ordered_pass(df, "p", ["s"], "label", sequence.DuplicateGuard).orderBy("s").collect()
    assert [r.new_label for r in out] == ["5", "5.c.i", "5.c.ii", "5.c.iii", "5", "5.z", "5.z"]


def test_root_tracker(spark):
    rows = [(1, k, x) for k, x in enumerate(["5.c.ii", "iii", "4.a", "6", "b"])]
    out = sequence.ordered_pass(spark.createDataFrame(rows, "p int, s int, label string"), "p", ["s"], "label", sequence.RootTracker).orderBy("s").collect()
    assert [r.new_label for r in out] == ["5.c.ii", "5.c.iii", "5.a", "6", "6.b"]


def test_packing(spark):
    df = spark.createDataFrame([(1, k, n) for k, n in enumerate([5, 5, 20, 1, 1, 1])], "g int, s int, n int")
    assert [r.bin for r in sequence.packed(df, "g", ["s"], "n", 10, 2).orderBy("s").collect()] == [0, 0, 1, 2, 2, 3]


def test_regions(spark):
    df = spark.createDataFrame([(2, 1.0, 50.0), (1, 10.0, 50.0), (2, 10.0, 11.0), (2, 20.0, 60.0)], "page_num int, y0 double, y1 double")
    assert {(r.p0, r.p1, r.clipping_risk) for r in filters.valid_regions(df).collect()} == {(5.0, 60.0, True), (10.0, 70.0, False)}


def test_clusters(spark):
    df = spark.createDataFrame([(1, 0.0, 10.0), (1, 40.0, 50.0), (1, 5.0, 200.0), (1, 251.0, 260.0)], "g int, a double, b double")
    assert [(r.lo, r.hi, r.n) for r in aggregates.clusters(df, "g", "a", "b", 50.0).orderBy("lo").collect()] == [(0.0, 200.0, 3), (251.0, 260.0, 1)]


def test_windows(spark):
    long = "x" * 80
    df = spark.createDataFrame([(1, 0, long + " first remainder text"), (1, 1, long + " second remainder text")], "g int, s int, t string")
    out = windows.compacted(df, "g", "s", "t").orderBy("s").collect()
    assert [r.t for r in out] == [long + " first remainder text", "second remainder text"]


def test_cascade_uses_a_source_once(spark):
    m = lambda rows, side: spark.createDataFrame([(1, *r) for r in rows], f"paper int, {side}_id int, {side}_label string, {side}_text string")
    left = m([(1, "1.a", "x"), (2, "1.b", "A text of some length"), (3, "1.c", "A text of some length here")], "l")
    right = m([(10, "1.a", "whatever"), (11, "9.z", "A text of some length")], "r")
    assert {tuple(r) for r in joins.match_cascade(left, right, "paper").select("l_id", "r_id", "kind").collect()} == {(1, 10, "exact"), (2, 11, "fuzzy")}


def test_fuzzy_best_like_all_pairs(spark, small):
    import difflib

    c = spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").limit(60).collect()
    rows = [(r.conv_id % 3, r.conv_id * 100 + r.turn, (r.text or "")[:90]) for r in c]
    left, right = rows[::2], rows[1::2]
    want = {}
    for least in (0.3, 0.62):
        for b, i, t in left:
            scores = [(difflib.SequenceMatcher(None, " ".join(t.lower().split()), " ".join(u.lower().split())).ratio(), -j) for k, j, u in right if k == b and t.strip() and u.strip()]
            if scores and max(scores)[0] >= least:
                want[least, i] = (-max(scores)[1], round(max(scores)[0], 9))
        got = joins.fuzzy_best(spark.createDataFrame(left, "b int, l_id int, l_text string"), spark.createDataFrame(right, "b int, r_id int, r_text string"), "b", least).collect()
        assert {(least, r.l_id): (r.r_id, round(r.ratio, 9)) for r in got} == {k: v for k, v in want.items() if k[0] == least}
    assert want


def test_retry(spark):
    import pytest

    pages = spark.createDataFrame([(1, False), (2, True)], "page int, failed boolean")
    assert sets.retried(pages, spark.createDataFrame([(2, False)], "page int, failed boolean"), "page").count() == 2
    with pytest.raises(Exception, match="failed twice"):
        sets.retried(pages, spark.createDataFrame([(2, True)], "page int, failed boolean"), "page").collect()


def test_table_cells(spark):
    rows = [(1, 0, ["Question", "Answer", "Marks", "Partial"]), (1, 1, ["1(a)", "5", "2", "M1"]), (2, 0, ["x", "y", "z", "w"]), (3, 0, ["Question", None, "Answer", "", "Marks", "", "Partial", ""])]
    out = tables.table_cells(spark.createDataFrame(rows, "table_id int, row_no int, cells array<string>")).collect()
    assert [(r.question, r.answer, r.marks, r.partial) for r in out] == [("1(a)", "5", "2", "M1")]


def test_model_rows(spark):
    raw = spark.createDataFrame([(1, '[{"id": "1.a"}, {"id": "1.b"}]'), (2, "broken")], "page int, body string")
    out = tables.model_rows(raw, ["page"], "body", "id string").collect()
    assert {(r.page, r.id, r.page_failed) for r in out} == {(1, "1.a", False), (1, "1.b", False), (2, None, True)}


def test_streaming_rollup_equals_batch(spark, small, tmp_path):
    schema = spark.read.parquet(f"{small}/events.parquet").schema
    folder = tmp_path / "in"
    spark.read.parquet(f"{small}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).repartition(1).write.parquet(str(folder))
    stream = spark.readStream.schema(spark.read.parquet(str(folder)).schema).parquet(str(folder))
    ledger.run_once(ledger.rollup(stream, "ts", "event_type", "value"), str(tmp_path / "out"), str(tmp_path / "cp"))
    got, want = spark.read.parquet(str(tmp_path / "out")), ledger.rollup(spark.read.parquet(str(folder)), "ts", "event_type", "value")
    last = spark.read.parquet(str(folder)).agg((F.max("ts") - F.expr("interval 2 hours")).alias("t")).first().t
    done = want.where(F.col("window_start") < F.lit(last))  # later windows are open until the watermark passes them
    assert got.exceptAll(want).count() == 0 and done.exceptAll(got).count() == 0 and done.count() > 0
    assert schema is not None
