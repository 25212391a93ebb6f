"""Queries of passes with state, of healing and of joins with geometry, over the given tables."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import coerce
from ..operators import filters, guarded, rescue, sequence, validate
from ..sources import store, tables
from ..streaming import capture, expiring
from .registry import query

#: Orders as rows of papers: a customer's orders are a paper, 5,000 order numbers a page.
_ROWS_SQL = """l AS (SELECT o_custkey AS paper, o_orderkey // 5000 AS page, o_orderkey % 5000 AS line, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k,
      CASE WHEN o_orderkey % 11 = 0 THEN 66 WHEN o_orderkey % 5 != 0 THEN 1 + o_orderkey // 3 % 9 END AS own,
      CASE o_orderkey % 7 WHEN 0 THEN [] WHEN 1 THEN ['a'] WHEN 2 THEN ['b'] WHEN 3 THEN ['ii'] WHEN 4 THEN ['i'] WHEN 5 THEN ['a', 'ii'] ELSE ['iii'] END AS tail,
      1 + o_orderkey // 4 % 9 AS printed, o_orderkey % 13 = 0 AS hinted FROM orders)"""
#: One row after the other: what becomes of the label, then the root and what lies below it.
_WALK_SQL = f"""WITH RECURSIVE {_ROWS_SQL},
    w AS (SELECT paper, CAST(0 AS BIGINT) AS k, CAST(NULL AS BIGINT) AS page, CAST(NULL AS BIGINT) AS line, CAST(NULL AS BIGINT) AS root, CAST([] AS VARCHAR[]) AS was, '' AS label, 'start' AS change FROM l WHERE k = 1
      UNION ALL
      SELECT paper, k, page, line, CASE WHEN change = 'move' THEN own ELSE root END, b,
             CASE change WHEN 'join' THEN array_to_string(list_prepend(CAST(root AS VARCHAR), b), '.') WHEN 'replace' THEN array_to_string(list_prepend(CAST(root AS VARCHAR), tail), '.') WHEN 'reject' THEN ''
                         ELSE array_to_string(CASE WHEN own IS NULL THEN tail ELSE list_prepend(CAST(own AS VARCHAR), tail) END, '.') END,
             CASE WHEN change = 'move' THEN 'keep' ELSE change END
      FROM (SELECT *, CASE WHEN change = 'move' THEN tail WHEN change = 'join' AND tail[1] = 'i' THEN list_concat(was[1:1], tail)
                           WHEN change = 'join' AND tail[1] IN ('ii', 'iii') THEN list_concat(CASE WHEN len(was) > 1 AND was[len(was)] IN ('i', 'ii', 'iii') THEN was[1:len(was) - 1] ELSE was END, tail)
                           WHEN change = 'join' THEN tail ELSE was END AS b
            FROM (SELECT l.*, w.root, w.was, CASE WHEN own IS NULL THEN CASE WHEN len(tail) = 0 OR root IS NULL THEN 'keep' ELSE 'join' END
                         WHEN own > 50 THEN CASE WHEN root IS NULL THEN 'reject' ELSE 'replace' END WHEN root IS NULL THEN 'move'
                         WHEN own = printed AND own != root AND (own != root + 1 OR (len(tail) > 0 AND tail[1] != 'a')) THEN 'replace'
                         WHEN hinted OR own = root OR own = root + 1 OR (own > root AND len(tail) > 0) THEN 'move' WHEN own > root THEN 'keep' ELSE 'replace' END AS change
                  FROM w JOIN l ON l.paper = w.paper AND l.k = w.k + 1)))"""


def _paper_rows(spark, d):
    k = F.col("o_orderkey")
    own = F.when(k % 11 == 0, F.array(F.lit("66"))).when(k % 5 != 0, F.array((1 + F.floor(k / 3) % 9).cast("string"))).otherwise(F.array().cast("array<string>"))
    ends = F.array(*(F.array(*map(F.lit, x)).cast("array<string>") for x in ([], ["a"], ["b"], ["ii"], ["i"], ["a", "ii"], ["iii"])))
    return tables.parquet(spark, d, "orders").select(
        F.col("o_custkey").alias("paper"), F.floor(k / 5000).alias("page"), (k % 5000).alias("line"), F.concat(own, F.get(ends, (k % 7).cast("int"))).alias("parts"),
        (1 + F.floor(k / 4) % 9).alias("printed"), (k % 13 == 0).alias("hinted"))


@query(f"{_WALK_SQL} SELECT paper, page, line, label, change FROM w WHERE k > 0")
def guarded_roots(spark, d):
    """The guarded scan as tables of what rows do, composed as a tree."""
    return guarded.guarded(_paper_rows(spark, d), "paper", "page", "line", "parts", "printed", "hinted")


@query(f"{_WALK_SQL} SELECT paper, page, line, label FROM w WHERE k > 0")
def tracked_roots(spark, d):
    """The same scan, a paper at a time."""
    rows = _paper_rows(spark, d).withColumn("label", F.array_join("parts", "."))
    return sequence.ordered_pass(rows, "paper", ["page", "line"], ["label", "printed", "hinted"], sequence.RootTracker).select("paper", "page", "line", F.col("new_label").alias("label"))


#: What a model's answer writes, and what is meant, by JSON's escapes and where TeX is kept.  Turns of conversations are dealt to them.
_WRITTEN = [r"\underline", r"\alpha", r"\u12", "\\" + "u0041", r"\\frac", r"\\\sum", r"\theta", r"\n\pi"]
_MEANT = [r"\underline", r"\alpha", r"\u12", "A", r"\frac", r"\\sum", "\theta", "\n\\pi"]
_MEANT_TEX = [*_MEANT[:3], _WRITTEN[3], *_MEANT[4:6], r"\theta", "\n\\pi"]


def _one_of(values: list[str], at: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), at.cast("int"))


def _listed(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("\t", "' || chr(9) || '").replace("\n", "' || chr(10) || '") + "'" for v in values) + "]"


def _answers(spark, d):
    """Answers with the turn's words behind what is written; every ninth is cut short, every fifth fenced."""
    c = tables.parquet(spark, d, "conversations")
    k = F.col("conv_id") * 7 + F.col("turn")
    words = F.regexp_replace(F.coalesce("text", F.lit("")), "[^A-Za-z0-9]+", " ")
    body = F.concat(F.lit('{"questions_array": [{"question_id": "'), F.col("conv_id").cast("string"), F.lit('", "question_latex": "'), _one_of(_WRITTEN, F.pmod(k, F.lit(8))), F.lit(" "), words, F.when(k % 9 == 0, F.lit('"')).otherwise(F.lit('"}]}')))
    return c.select("conv_id", "turn", k.alias("k"), F.when(k % 5 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body).alias("answer"))


_ANSWERS_SQL = r"""WITH c AS (SELECT conv_id, turn, conv_id * 7 + turn AS k, regexp_replace(coalesce(text, ''), '[^A-Za-z0-9]+', ' ', 'g') AS words FROM conversations)
    SELECT conv_id, turn, CASE WHEN k %% 9 != 0 THEN CAST(conv_id AS VARCHAR) END AS question_id, CASE WHEN k %% 9 != 0 THEN %s[k %% 8 + 1] || ' ' || words END AS latex, %s FROM c"""
_SCHEMA = "questions_array array<struct<question_id string, question_latex string>>"


@query(_ANSWERS_SQL % (_listed(_MEANT), "CASE WHEN k % 9 = 0 THEN 'json_decode_error' END AS reason, CASE WHEN k % 9 = 0 THEN least(500, 60 + length(CAST(conv_id AS VARCHAR)) + " + "[" + ", ".join(str(len(x)) for x in (r"\\underline", r"\\alpha", r"\\u12", _WRITTEN[3], r"\\frac", r"\\\\sum", r"\theta", r"\n\\pi")) + "][k % 8 + 1] + 1 + length(words) + 1) END AS preview"))
def answers_healed(spark, d):
    """Strict: answers that can't be read are error rows."""
    found = coerce.read_answer(F.col("answer"), _SCHEMA, strict=True)
    first = F.get(F.col("x.value.questions_array"), F.lit(0))
    return _answers(spark, d).withColumn("x", found).select("conv_id", "turn", first["question_id"].alias("question_id"), first["question_latex"].alias("latex"), F.col("x.error.reason").alias("reason"), F.length("x.error.preview").alias("preview"))


@query(_ANSWERS_SQL % (_listed(_MEANT_TEX), "CASE WHEN k % 9 = 0 THEN 0 ELSE 1 END AS n"))
def answers_tex(spark, d):
    """Lenient, with TeX kept: answers that can't be read are empty envelopes."""
    found = coerce.read_answer(F.col("answer"), _SCHEMA, strict=False, keep="tex")
    first = F.get(F.col("x.value.questions_array"), F.lit(0))
    return _answers(spark, d).withColumn("x", found).select("conv_id", "turn", first["question_id"].alias("question_id"), first["question_latex"].alias("latex"), F.size("x.value.questions_array").alias("n"))


@query("""WITH r AS (SELECT o_orderkey AS id, o_custkey % 3 AS page, CAST(floor(o_totalprice) AS BIGINT) % 2000 AS x0, o_orderkey % 3000 AS y0, CASE WHEN o_orderkey % 50 = 0 THEN 700 ELSE 3 + o_orderkey % 17 END AS w, 2 + o_custkey % 11 AS h FROM orders),
      d AS (SELECT p_partkey AS d_id, p_partkey % 3 AS page, p_partkey * 37 % 2000 AS d_x0, p_partkey * 91 % 3000 AS d_y0, 1 + p_size % 40 AS d_w, CASE WHEN p_partkey % 40 = 0 THEN 900 ELSE 1 + p_size % 13 END AS d_h FROM part)
      SELECT id, d_id, CAST((least(x0 + w, d_x0 + d_w) - greatest(x0, d_x0)) * (least(y0 + h, d_y0 + d_h) - greatest(y0, d_y0)) AS DOUBLE) AS common FROM r JOIN d USING (page)
      WHERE x0 < d_x0 + d_w AND d_x0 < x0 + w AND y0 < d_y0 + d_h AND d_y0 < y0 + h""")
def overlapping_boxes(spark, d):
    """Boxes of three pages that overlap, by a grid of several levels."""
    k, p = F.col("o_orderkey"), F.col("p_partkey")
    boxes = tables.parquet(spark, d, "orders").select(k.alias("id"), (F.col("o_custkey") % 3).alias("page"), (F.floor("o_totalprice") % 2000).alias("x0"), (k % 3000).alias("y0"), F.when(k % 50 == 0, 700).otherwise(3 + k % 17).alias("w"), (2 + F.col("o_custkey") % 11).alias("h"))
    marks = tables.parquet(spark, d, "part").select(p.alias("d_id"), (p % 3).alias("page"), (p * 37 % 2000).alias("d_x0"), (p * 91 % 3000).alias("d_y0"), (1 + F.col("p_size") % 40).alias("d_w"), F.when(p % 40 == 0, 900).otherwise(1 + F.col("p_size") % 13).alias("d_h"))
    boxes = boxes.select("id", "page", *(F.col(c).cast("double").alias(c) for c in ("x0", "y0")), (F.col("x0") + F.col("w")).cast("double").alias("x1"), (F.col("y0") + F.col("h")).cast("double").alias("y1"))
    marks = marks.select("d_id", "page", *(F.col(c).cast("double").alias(c) for c in ("d_x0", "d_y0")), (F.col("d_x0") + F.col("d_w")).cast("double").alias("d_x1"), (F.col("d_y0") + F.col("d_h")).cast("double").alias("d_y1"))
    return filters.overlaps(boxes, marks, ["page"], 8.0).select("id", "d_id", "common")


#: Lives of a user's events: the first one's time, then that of the first event beyond the time to live.
_LIVES_SQL = """WITH RECURSIVE e AS (SELECT CAST(user_id AS VARCHAR) AS key, ts, event_type AS value FROM events),
    b AS (SELECT key, min(ts) AS born FROM e GROUP BY 1 UNION ALL SELECT b.key, min(e.ts) FROM b JOIN e ON e.key = b.key AND e.ts {beyond} b.born + INTERVAL {hours} HOUR GROUP BY b.key, b.born),
    w AS (SELECT max(ts) - INTERVAL 10 MINUTE AS now FROM e)"""


def _lives(spark: SparkSession, d: str, seconds: int, last_instant: bool, *kinds: str) -> DataFrame:
    found = expiring.lives(tables.streamed(spark, d, "events"), "user_id", "ts", "event_type", seconds, last_instant, kinds=kinds)
    return expiring.settled(found, f"{tables.workspace(spark)}/lives-{uuid.uuid4().hex}")


@query(_LIVES_SQL.format(beyond=">", hours=1) + """ SELECT b.key, epoch_us(born) AS born, arg_max(value, {'ts': ts, 'value': value}) AS status, count(*) AS rows
    FROM b JOIN w ON born + INTERVAL 1 HOUR < now JOIN e ON e.key = b.key AND ts BETWEEN born AND born + INTERVAL 1 HOUR GROUP BY 1, 2""")
def jobs_expired(spark, d):
    """Jobs that have expired, an hour after their first event, by a stream's watermark."""
    ended = _lives(spark, d, expiring.JOB_SECONDS, True, "end")
    return ended.select("key", F.unix_micros("born").alias("born"), F.col("value").alias("status"), "rows")


@query(_LIVES_SQL.format(beyond=">=", hours=4) + """ SELECT e.key, epoch_us(ts) AS at, count(b.born) = 0 AS hit FROM e JOIN w ON ts <= now LEFT JOIN b ON b.key = e.key AND b.born = e.ts GROUP BY e.key, ts""")
def results_cached(spark, d):
    """Requests that find their key's result younger than four hours, and those that make it."""
    taken = _lives(spark, d, expiring.RESULT_SECONDS, False, "first", "again")
    return taken.groupBy("key", F.unix_micros("at").alias("at")).agg((F.min("kind") == "again").alias("hit"))


@query("""WITH c AS (SELECT CAST(user_id AS VARCHAR) AS key, count(*) AS n, bool_or(event_type = 'signup') AS early FROM events GROUP BY 1)
    SELECT key, CAST(n AS VARCHAR) AS answer, early AS first_hit, true AS again_hit FROM c""")
def cache_written(spark, d):
    """Counts of users' events through a store: a run for users who signed up, one for all of them, and that one again."""
    events = tables.parquet(spark, d, "events").select(F.col("user_id").cast("string").alias("key"), "event_type", "ts")
    counts = lambda rest: events.join(rest.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.count(F.lit(1)).cast("string").alias("answer"))
    now = F.lit(events.agg(F.max("ts")).first()[0])
    kept = store.Store(spark, f"{tables.workspace(spark)}/store-{uuid.uuid4().hex}", 4)
    kept.answered(events.where("event_type = 'signup'"), counts, now)
    first = kept.answered(events, counts, now).select("key", "answer", F.col("hit").alias("first_hit"))
    again = kept.answered(events, counts, now).select("key", "answer", F.col("hit").alias("again_hit"))
    return first.join(again, ["key", "answer"])


@query("""SELECT l_linestatus AS component, CASE WHEN l_returnflag = 'N' THEN 'other' ELSE l_returnflag END AS model, count(*) AS calls, CAST(sum(CASE WHEN l_discount < 0.03 THEN 0 ELSE l_quantity END) AS BIGINT) AS prompt_tokens,
    CAST(sum(CASE WHEN l_discount < 0.03 THEN 0 ELSE l_linenumber END) AS BIGINT) AS output_tokens, count_if(l_discount < 0.03) AS failures FROM lineitem GROUP BY 1, 2""")
def ledger_captured(spark, d):
    """Lines as calls of two components, counted while they are written."""
    calls = tables.parquet(spark, d, "lineitem").select("l_linestatus", "l_returnflag", F.col("l_quantity").cast("long").alias("prompt"), "l_linenumber", (F.col("l_discount") < 0.03).alias("failed"))
    kept = capture.Ledger(spark, f"{tables.workspace(spark)}/ledger-{uuid.uuid4().hex}", ["A", "R"])
    for component in ("F", "O"):
        watched = kept.watch(calls.where(F.col("l_linestatus") == component), component, "l_returnflag", "prompt", "l_linenumber", "failed")
        watched.write.format("noop").mode("overwrite").save()
    kept.settle()
    return kept.totals().drop("inr")


#: A customer's orders as pages of a paper; a page shows a question with parts three and four deep.
_ASKED_SQL = """WITH o AS (SELECT o_custkey AS paper, o_orderkey AS page, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r, o_orderkey % 3 AS k, o_orderpriority AS a, o_orderkey % 4 AS m FROM orders),
    q AS (SELECT *, CASE WHEN m = 0 THEN 'no.' ELSE 'Find the order of ' || a || '.' END AS t1, 'Show that it is ' || CAST(page AS VARCHAR) || ' of f(x).' AS t2, 'Explain why ' || a || ' is so.' AS t3 FROM o WHERE r < 100)"""


@query(_ASKED_SQL + """ SELECT paper, r || '.a' AS label, 'given' AS body, 0 AS round FROM q WHERE k != 0
    UNION ALL SELECT paper, r || '.a.i', r || '(a)(i) ' || t1, 1 FROM q WHERE k != 0 AND m != 0
    UNION ALL SELECT paper, r || '.a.ii.b', r || '(a)(ii)(b) ' || t2, 1 FROM q WHERE k != 0
    UNION ALL SELECT paper, r || '.a.ii.b.i', r || '(a)(ii)(b)(i) ' || t3, 2 FROM q WHERE k != 0""")
def rows_rescued(spark, d):
    """Rows for missing ids, split from page texts in rounds: a part of a part is found when the part has been."""
    o = tables.parquet(spark, d, "orders")
    r = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey")).cast("string")
    k, a = F.col("o_orderkey"), F.col("o_orderpriority")
    first = F.when(k % 4 == 0, "no.").otherwise(F.concat(F.lit("Find the order of "), a, F.lit(".")))
    shown = F.concat(F.col("r"), F.lit("(a)\n"), F.col("r"), F.lit("(a) (i)  "), first, F.lit("\n"), F.col("r"), F.lit(" (a)(ii)(b) Show  that it is "), k.cast("string"), F.lit(" of f(x).\n(i) Explain why "), a, F.lit(" is so."))
    q = o.withColumn("r", r).where(F.col("r").cast("int") < 100).select(F.col("o_custkey").alias("paper"), k.alias("page"), "r", (k % 3 != 0).alias("given"), shown.alias("page_text"))
    none = F.array().cast("array<string>")
    rows = q.where("given").select("paper", F.col("page").alias("seq"), F.concat("r", F.lit(".a")).alias("label"), F.lit("given").alias("body"), none.alias("urls"), none.alias("warnings"), F.lit(False).alias("needs_review"))
    ends = F.array(*map(F.lit, (".a", ".a.i", ".a.ii", ".a.ii.b", ".a.ii.b.i")))
    expected = q.select("paper", F.explode(F.transform(ends, lambda x: F.concat("r", x))).alias("id"))
    return rescue.rescued(rows, expected, q.select("paper", "page", "page_text")).select("paper", "label", "body", "round")


@query("""WITH p AS (SELECT p_partkey AS k, p_name AS a, p_type AS b, CAST(p_size AS VARCHAR) AS c, p_partkey % 4 AS m FROM part)
    SELECT k, CAST(leaf AS INTEGER) AS leaf, CASE WHEN leaf = 0 THEN CASE WHEN m = 3 THEN '8' ELSE '8.a' END ELSE '8.a.' || ['i', 'ii', 'iii'][leaf] END AS label,
           CASE WHEN leaf = 0 THEN CASE m WHEN 0 THEN '(i) ' || a || ' only (i) twice' ELSE 'M1 (i) ' || a || chr(10) || '(ii) ' || b || ' see (i) (iii) ' || c END
                ELSE [a, b || ' see (i)', c][leaf] END AS body, leaf > 0 AS warned
    FROM p JOIN (SELECT unnest([0, 1, 2, 3]) AS leaf) ON (m IN (0, 3)) = (leaf = 0)""")
def scheme_leaves(spark, d):
    """Grouped entries of schemes as a row for each leaf."""
    p = tables.parquet(spark, d, "part")
    k, m = F.col("p_partkey"), F.col("p_partkey") % 4
    three = F.concat(F.lit("M1 (i) "), F.col("p_name"), F.lit("\n(ii) "), F.col("p_type"), F.lit(" see (i) (iii) "), F.col("p_size").cast("string"))
    one = F.concat(F.lit("(i) "), F.col("p_name"), F.lit(" only (i) twice"))
    rows = p.select(k.alias("k"), F.when(m == 3, "8").otherwise("8.a").alias("label"), F.when(m == 0, one).otherwise(three).alias("body"), F.lit(None).cast("array<string>").alias("warnings"))
    return rescue.group_leaves(rows, "label", "body", "warnings").select("k", "leaf", "label", "body", F.col("warnings").isNotNull().alias("warned"))


@query(r"""WITH n AS (SELECT count(*) AS n FROM benchmark), p AS (SELECT doc_id, d.text AS a, b.text AS b FROM documents d JOIN n ON true JOIN (SELECT row_number() OVER (ORDER BY item_id) - 1 AS at, text FROM benchmark) b ON b.at = doc_id % n),
    s AS (SELECT doc_id, 0 AS side, unnest(regexp_extract_all(lower(coalesce(a, '')), '([a-z]{3,}|\d+)')) AS word FROM p UNION ALL SELECT doc_id, 1, unnest(regexp_extract_all(lower(coalesce(b, '')), '([a-z]{3,}|\d+)')) FROM p),
    c AS (SELECT doc_id, word, CAST(count_if(side = 0) AS DOUBLE) AS n0, CAST(count_if(side = 1) AS DOUBLE) AS n1 FROM s GROUP BY 1, 2),
    w AS (SELECT word, ln((1 + 2 * (SELECT count(*) FROM p)) / (1 + CAST(sum(CAST(n0 > 0 AS INT) + CAST(n1 > 0 AS INT)) AS DOUBLE))) + 1 AS w FROM c GROUP BY 1),
    g AS (SELECT doc_id, sum(n0 * n1 * w * w) AS ab, sum(n0 * n0 * w * w) AS aa, sum(n1 * n1 * w * w) AS bb, count_if(n0 > 0 AND n1 > 0) AS terms, count_if(n0 = 0 AND n1 > 0 AND regexp_matches(word, '^\d')) AS unmet FROM c JOIN w USING (word) GROUP BY 1),
    r AS (SELECT doc_id, round(coalesce(CASE WHEN aa > 0 AND bb > 0 THEN ab / sqrt(aa * bb) END, 0), 6) AS cosine, coalesce(terms, 0) AS terms, coalesce(unmet, 0) = 0 AS numbers FROM p LEFT JOIN g USING (doc_id))
    SELECT *, CASE WHEN cosine < 0.05 THEN 'block' WHEN cosine < 0.3 OR NOT numbers THEN 'review' ELSE 'ok' END AS verdict FROM r""")
def semantic_consistency(spark, d):
    """Documents against items of the benchmark, dealt by turns: cosines of weighed words."""
    bench = tables.parquet(spark, d, "benchmark")
    n = bench.count()
    numbered = bench.select((F.row_number().over(Window.orderBy("item_id")) - 1).alias("at"), F.col("text").alias("b"))
    docs = tables.parquet(spark, d, "documents").select("doc_id", F.col("text").alias("a"), (F.col("doc_id") % n).alias("at"))
    return validate.semantic_consistency(docs.join(numbered, "at"), "doc_id", "a", "b")
