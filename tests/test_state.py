import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from scriptorium.functions import coerce
from scriptorium.operators import filters, guarded, sequence

TOKENS = ["a", "b", "c", "i", "ii", "iii", "iv", "x", "v"]


def _parts(rng, roots=(1, 2, 3, 4, 5, 6, 7, 8, 9, 66)):
    own = [] if rng.random() < 0.3 else [str(rng.choice(roots))]
    return own + [rng.choice(TOKENS) for _ in range(rng.choice([0, 1, 1, 2]))]


def test_what_rows_do_composes():
    rng = random.Random(1)
    for _ in range(2000):
        rows = [(_parts(rng), rng.choice([None, 2, 3, 4]), rng.random() < 0.1) for _ in range(rng.randint(0, 12))]
        cuts = sorted(rng.randint(0, len(rows)) for _ in range(2))
        tables = []
        for run in (rows[: cuts[0]], rows[cuts[0] : cuts[1]], rows[cuts[1] :]):
            table = guarded.identity()
            for r in run:
                table = guarded.composed(table, lambda root: (*guarded.step(root, *r)[:3], None))
            tables.append(table)
        a, b, c = tables
        one, other = guarded.joined(guarded.joined(a, b), c), guarded.joined(a, guarded.joined(b, c))
        assert all(guarded.effect_at(one, r) == guarded.effect_at(other, r) for r in (None, *range(51)))
        root = rng.choice([None, 0, 1, 3, 50])
        was = () if root is None else rng.choice([(), ("a",), ("a", "ii"), ("ii",), ("a", "b", "iii")])
        got = guarded._entered(guarded._loaded(guarded._dumped(guarded.joined(guarded.joined(a, b), c))), root, was)
        for r in rows:
            root, kind, tail, _ = guarded.step(root, *r)
            was = guarded.below(kind, tail, was)
        assert got == (root, was)


@pytest.mark.parametrize("labels,printed,want", [
    (["3.a", "9", "4.a", "4.b"], 9, ["3.a", "3", "4.a", "4.b"]),  # a page's number is no root
    (["3.a", "9", "4.a", "4.b"], None, ["3.a", "9", "4.a", "4.b"]),  # a bare leap stays, and does not drag what follows
    (["2", "3.b", "3.a"], 3, ["2", "2.b", "3.a"]),  # the next root begins with a, if it is the page's number too
    (["66", "2.a", "130.b"], None, ["", "2.a", "2.b"]),  # totals of marks
    (["5.c", "4.b", "ii"], None, ["5.c", "5.b", "5.c.ii"]),  # what was replaced moves nothing
])
def test_guards(labels, printed, want):
    walk = sequence.RootTracker()
    assert [walk(x, printed)[0] for x in labels] == want
    assert sequence.RootTracker()("x", None) == ("x", False) and walk("2.a", None, True) == ("2.a", False) and walk("b")[0] == "2.b"


@pytest.mark.parametrize("many,lines", [(4096, 1000), (1, 2), (8, 3)])
def test_guarded_like_the_plain_loop(spark, many, lines):
    rng = random.Random(2)
    rows = [(paper, page, line, _parts(rng), rng.choice([None, page + 1]), rng.choice([None, False, False, True])) for paper in (None, "", "q") for page in range(40 if paper else 3) for line in range(rng.randint(0, 9))]
    df = spark.createDataFrame(rows, "paper string, page int, line int, parts array<string>, printed int, hinted boolean").withColumn("at", F.lit("x")).repartition(5)
    want = set()
    for paper in (None, "", "q"):
        walk = sequence.RootTracker()
        want |= {(paper, r[1], r[2], walk(".".join(r[3]), r[4], bool(r[5]))[0]) for r in rows if r[0] == paper}
    got = guarded.guarded(df, "paper", "page", "line", "parts", "printed", "hinted", many, lines).select("paper", "page", "line", "label").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(rows)
    assert guarded.guarded(df.limit(0), "paper", "page", "line", "parts", "printed", "hinted", many, lines).count() == 0


def test_papers_of_one_chunk_are_walked_as_they_are(spark):
    """Without tables of what their rows do; a paper of more rows has them."""
    rng = random.Random(3)
    rows = [(paper, k // 2, k % 2, _parts(rng), rng.choice([None, 2]), rng.random() < 0.2) for paper, n in ((1, 8), (2, 9), (3, 1), (None, 8), (4, 60)) for k in range(n)]
    df = spark.createDataFrame(rows, "paper int, page int, line int, parts array<string>, printed int, hinted boolean").repartition(3)
    want, walks = set(), {}
    for paper, page, line, parts, *other in rows:
        want.add((paper, page, line, walks.setdefault(paper, sequence.RootTracker())(".".join(parts), *other)[0]))
    whole = guarded.guarded(df.where("paper IS NULL OR paper IN (1, 3)"), "paper", "page", "line", "parts", "printed", "hinted", lines=8)
    plan = whole._jdf.queryExecution().sparkPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan and whole.count() == 17
    for many in (1, 4096):
        got = guarded.guarded(df, "paper", "page", "line", "parts", "printed", "hinted", many=many, lines=8).collect()
        assert len(got) == len(rows) and {tuple(r)[:4] for r in got} == want


def _healed(text):
    """Doubles a backslash wherever the parser stops at an escape, until it stops no more."""
    while True:
        try:
            return json.loads(text)
        except json.JSONDecodeError as e:
            if "escape" not in str(e):
                return None
            at = text.rindex("\\", 0, e.pos + 1)
            text = text[:at] + "\\" + text[at:]


def test_healing_like_a_loop_over_the_parser(spark):
    rng = random.Random(4)
    units = ["\\", "\\", "\\\\", "u", "u12", "u00e9", "n", "t", "alpha", "b", " ", "x", '"', "/"]
    bodies = ["".join(rng.choice(units) for _ in range(rng.randint(0, 12))) for _ in range(800)] + ["\\u" * 500]
    rows = [(k, '{"a": "' + x + '"}') for k, x in enumerate(bodies)]
    got = {r.k: r.v for r in spark.createDataFrame(rows, "k int, raw string").select("k", coerce.parsed_json(F.col("raw"), "a string")["a"].alias("v")).collect()}
    for k, raw in rows:
        want = _healed(raw)
        assert got[k] == (want or {}).get("a"), raw


def test_answers_strict_and_lenient(spark):
    rows = [(0, '{"metadata": {"k": 1}, "rows": [{"t": "\\underline x"}]}'), (1, '{"rows": [{"t": '), (2, " "), (3, None), (4, "```json\n{\"rows\": []}\n```")]
    df = spark.createDataFrame(rows, "k int, raw string")
    for strict in (True, False):
        x = coerce.read_answer(F.col("raw"), "metadata map<string,string>, rows array<struct<t string>>", strict)
        got = {r.k: r.x for r in df.select("k", x.alias("x")).collect()}
        assert got[0].value.rows[0].t == "\\underline x" and got[0].error is None
        assert (got[1].value is None and got[1].error.stage == "parse" and got[1].error.preview.startswith('{"rows"')) if strict else (got[1].value.rows == [] and got[1].error is None)
        assert all(got[k].value.rows == [] and got[k].error is None for k in (2, 3, 4))


def test_overlaps_like_all_pairs(spark):
    rng = np.random.default_rng(3)
    n = 4000
    low = rng.uniform(-300, 900, (2 * n, 2))
    size = np.exp(rng.uniform(-3, 7, (2 * n, 2)))
    size[:5] = 0
    high = low + size
    frame = lambda a, b, name: spark.createDataFrame([(0, int(k), *map(float, (*low[k], *high[k]))) for k in range(a, b)], f"page int, {name}id int, {name}x0 double, {name}y0 double, {name}x1 double, {name}y1 double")
    got = {(r.id, r.d_id): r.common for r in filters.overlaps(frame(0, n, ""), frame(n, 2 * n, "d_"), ["page"], 4.0).collect()}
    want = {}
    for i in range(n):
        w = np.minimum(high[i], high[n:]) - np.maximum(low[i], low[n:])
        want |= {(i, n + int(j)): w[j, 0] * w[j, 1] for j in np.flatnonzero((w > 0).all(axis=1)) if (size[i] > 0).all()}
    assert got.keys() == want.keys() and all(abs(got[k] - v) <= 1e-9 * max(1, v) for k, v in want.items())
    assert filters.overlaps(frame(0, n, "").limit(0), frame(n, 2 * n, "d_"), ["page"]).count() == 0


def _lives(rows, seconds, last_instant):
    """Kept rows and ended lives of one key, by a plain loop; times are seconds."""
    taken, lives = [], []
    for at, value in sorted(rows):
        if not lives or not (at - lives[-1][0] <= seconds if last_instant else at - lives[-1][0] < seconds):
            lives.append([at, value, 0])
        lives[-1][1:] = [value, lives[-1][2] + 1]
        taken.append((at, "again" if lives[-1][2] > 1 else "first", lives[-1][0]))
    return taken, lives


@pytest.mark.parametrize("seconds,last_instant", [(3600, True), (4 * 3600, False)])
def test_lives_in_any_batches(spark, tmp_path, seconds, last_instant):
    """Rows out of order in several files, a file a batch; what comes too late is dropped; lives that the watermark has not passed stay open."""
    from datetime import datetime, timedelta

    from scriptorium.streaming import expiring

    rng, base = random.Random(6), datetime(2024, 1, 1)
    rows = [(rng.choice(["a", "b", "c", None]), t + rng.randint(-200, 0) if rng.random() < 0.3 else t, rng.choice(["x", "y", None])) for t in range(0, 60_000, 97)]
    rows += [("edge", 600, "x"), ("edge", 600 + seconds, "y"), ("edge", 600 + 2 * seconds + 1, "z")]
    rows.sort(key=lambda r: r[1] + rng.randint(0, 300))
    folder = tmp_path / "in"
    for k in range(0, len(rows), 150):
        part = spark.createDataFrame([(key, base + timedelta(seconds=t), v) for key, t, v in rows[k : k + 150]], "key string, ts timestamp, value string")
        part.coalesce(1).write.mode("append").parquet(str(folder))
    late = spark.createDataFrame([("a", base + timedelta(seconds=5), "late")], "key string, ts timestamp, value string")
    late.coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(late.schema).option("maxFilesPerTrigger", 1).parquet(str(folder))
    got = expiring.settled(expiring.lives(stream, "key", "ts", "value", seconds, last_instant), str(tmp_path / "out")).collect()
    now = max(t for _, t, _ in rows) - 600
    second = lambda x: int((x - base).total_seconds())
    want = []
    for key in {r[0] for r in rows}:
        taken, lives = _lives([(t, v or "") for k, t, v in rows if k == key and t <= now], seconds, last_instant)
        want += [(key or "", kind, at, born) for at, kind, born in taken]
        want += [(key or "", "end", born + seconds, born) for born, _, _ in lives if born + seconds < now]
    assert sorted((r.key, r.kind, second(r.at), second(r.born)) for r in got) == sorted(want)


def test_lives_in_few_calls_of_the_state():
    """Rows of a key go to its state in packs, and only the kinds asked for come out."""
    from types import SimpleNamespace as Told

    from scriptorium.streaming import expiring

    held, calls = {"waiting": [], "life": None}, []

    class Held:
        def __init__(self, name):
            self.name = name

        def appendValue(self, value):  # noqa: N802
            calls.append("append")
            held[self.name].append(value)

        def get(self):
            return iter(held[self.name]) if self.name == "waiting" else held[self.name]

        def exists(self):
            return held[self.name] is not None

        def put(self, values):
            held[self.name] = values

        update = put

        def clear(self):
            held[self.name] = [] if self.name == "waiting" else None

    handle = Told(getListState=lambda n, _: Held(n), getValueState=lambda n, _: Held(n), registerTimer=lambda ms: calls.append(ms))
    lives = expiring.Lives(3600, True, ("end",))
    lives.init(handle)
    rows = [Told(micros=t * 1_000_000, value=None if t % 2 else "x") for t in range(0, 25_000, 10)]
    assert list(lives.handleInputRows(("k",), iter(rows), None)) == []
    assert calls == ["append"] * 3 + [0]
    got = list(lives.handleExpiredTimer(("k",), Told(getCurrentWatermarkInMs=lambda: 10_000_000), None))
    assert [(r.kind, r.born // 1_000_000, r.rows) for r in got] == [("end", 0, 361), ("end", 3610, 361)]
    assert held["life"][:1] == (7_220_000_000,) and sum(len(m) for m, _ in held["waiting"]) == 1499 and len(held["waiting"]) == 2
