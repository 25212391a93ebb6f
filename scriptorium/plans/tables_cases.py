"""Queries that apply set-based operators, sources and validation to the tables, with the same in SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import labels
from ..operators import aggregates as agg
from ..operators import filters, joins, sets, validate, windows
from ..sources import tables
from ..streaming import ledger
from .registry import query


@query("""WITH c AS (SELECT c_nationkey, c_custkey, c_name || repeat('x', CAST(c_custkey % 7 AS INTEGER)) AS body FROM customer),
  s AS (SELECT *, length(body) AS n FROM c)
  SELECT a.c_custkey, count(*) OVER (PARTITION BY a.c_nationkey) - 1 AS siblings,
    (SELECT arg_max(b.body, {'n': b.n, 'id': b.c_custkey}) FROM s b WHERE b.c_nationkey = a.c_nationkey AND b.c_custkey <> a.c_custkey) AS sibling_text FROM s a""")
def sibling_texts(spark, d):
    c = tables.parquet(spark, d, "customer").select("c_nationkey", F.col("c_custkey"), F.concat("c_name", F.repeat(F.lit("x"), (F.col("c_custkey") % 7).cast("int"))).alias("body"))
    return joins.siblings(c, "c_custkey", "c_nationkey", "body").select("c_custkey", "siblings", "sibling_text")


@query("""WITH have AS (SELECT l_orderkey, min(l_linenumber) AS seq FROM lineitem WHERE l_linenumber = 1 GROUP BY 1),
  cand AS (SELECT l_orderkey, l_linenumber AS seq, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS n FROM lineitem WHERE l_linenumber > 1)
  SELECT l_orderkey, CAST(seq AS BIGINT) AS seq, false AS recovered, CASE WHEN o_totalprice > 100000 THEN o_custkey END AS pos FROM have LEFT JOIN orders ON o_orderkey = l_orderkey UNION ALL
  SELECT l_orderkey, CAST(seq AS BIGINT), true, o_custkey FROM cand JOIN orders ON o_orderkey = l_orderkey AND o_totalprice > 100000 WHERE n = 1 AND l_orderkey NOT IN (SELECT l_orderkey FROM have)""")
def gaps_filled(spark, d):
    items = tables.parquet(spark, d, "lineitem").withColumn("seq", F.col("l_linenumber").cast("long"))
    rows = items.where("seq = 1").select("l_orderkey", "seq").distinct()
    expected = tables.parquet(spark, d, "orders").where("o_totalprice > 100000").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("pos"))
    return joins.gap_filled(rows, items.where("seq > 1").select("l_orderkey", "seq"), expected, "l_orderkey").select("l_orderkey", "seq", "recovered", "pos")


@query("""SELECT coord_id, seq, priority FROM (SELECT s_suppkey AS coord_id, c_custkey AS seq, CAST(c_custkey % 3 AS INTEGER) AS priority,
  row_number() OVER (PARTITION BY s_suppkey ORDER BY c_custkey, c_custkey % 3) AS n FROM customer JOIN supplier ON c_nationkey = s_nationkey AND c_custkey % 5 = s_suppkey % 5) WHERE n = 1""")
def coords_consumed(spark, d):
    wanted = tables.parquet(spark, d, "customer").select(F.concat_ws("-", F.col("c_nationkey"), F.col("c_custkey") % 5).alias("key"), F.col("c_custkey").alias("seq"), (F.col("c_custkey") % 3).cast("int").alias("priority"))
    coords = tables.parquet(spark, d, "supplier").select(F.concat_ws("-", F.col("s_nationkey"), F.col("s_suppkey") % 5).alias("key"), F.col("s_suppkey").alias("coord_id"))
    return joins.consumed_once(wanted, coords, "key").select("coord_id", "seq", "priority")


_LINES = """WITH l AS (SELECT l_orderkey AS page, l_linenumber AS line_no, CASE WHEN l_linenumber <= 2 THEN CAST(l_partkey % 40 AS VARCHAR) ELSE 'text' END AS text,
  CAST(l_suppkey % 120 AS DOUBLE) AS x0, CAST(l_quantity AS DOUBLE) / 4 AS y0 FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1)"""


def _lines(spark, d):
    from pyspark.sql import Window

    one = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice"))
    rows = tables.parquet(spark, d, "lineitem").withColumn("k", one).where("k = 1")
    text = F.when(F.col("l_linenumber") <= 2, (F.col("l_partkey") % 40).cast("string")).otherwise("text")
    return rows.select(F.col("l_orderkey").alias("page"), F.col("l_linenumber").alias("line_no"), text.alias("text"), (F.col("l_suppkey") % 120).cast("double").alias("x0"), (F.col("l_quantity").cast("double") / 4).alias("y0"))


@query(_LINES + """ SELECT h.page, h.line_no AS head, r.line_no AS line_no FROM l h JOIN l r ON h.page = r.page WHERE regexp_matches(h.text, '^\\s*\\d{1,2}\\s*$') AND h.x0 <= 90 AND abs(r.y0 - h.y0) <= 2.5 AND r.x0 > h.x0 + 4""")
def baselines(spark, d):
    return joins.baseline(_lines(spark, d)).select("page", "head", "line_no")


@query(_LINES + """ SELECT page, line_no, row_number() OVER (PARTITION BY page ORDER BY y0, x0, line_no) AS place FROM l""")
def reading_order(spark, d):
    return sets.reading_order(_lines(spark, d), ["page"], ["y0", "x0", "line_no"]).select("page", "line_no", "place")


@query("""WITH RECURSIVE v AS (SELECT l_orderkey AS page, row_number() OVER (PARTITION BY l_orderkey ORDER BY y0, y1) AS k, y0, y1 FROM
  (SELECT DISTINCT l_orderkey, CAST(l_quantity AS DOUBLE) AS y0, CAST(l_quantity AS DOUBLE) + l_linenumber AS y1 FROM lineitem WHERE l_linenumber > 1)),
  i AS (SELECT DISTINCT l_orderkey AS page, CAST(l_quantity AS DOUBLE) AS y0, CAST(l_quantity AS DOUBLE) + 1 AS y1 FROM lineitem WHERE l_linenumber = 1),
  p AS (SELECT page, list({'y0': y0, 'y1': y1}) AS kept FROM i GROUP BY 1), pages AS (SELECT DISTINCT page FROM (SELECT page FROM v UNION ALL SELECT page FROM i)),
  s AS (SELECT pages.page, 0::BIGINT AS k, coalesce(kept, []) AS kept, len(coalesce(kept, [])) AS n FROM pages LEFT JOIN p USING (page) UNION ALL
  SELECT s.page, v.k, CASE WHEN len(list_filter(s.kept, lambda x: abs(x.y0 - v.y0) < 3 AND abs(x.y1 - v.y1) < 3)) > 0 THEN s.kept ELSE list_append(s.kept, {'y0': v.y0, 'y1': v.y1}) END, s.n
  FROM s JOIN v ON v.page = s.page AND v.k = s.k + 1),
  e AS (SELECT page, arg_max(kept, k) AS kept, max(n) AS n FROM s GROUP BY 1)
  SELECT page, kept[j].y0 AS y0, kept[j].y1 AS y1, CASE WHEN j <= n THEN 'image' ELSE 'drawing' END AS kind FROM e, range(1, 20) r(j) WHERE j <= len(kept)""")
def regions_kept(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select(F.col("l_orderkey").alias("page"), "l_linenumber", F.col("l_quantity").cast("double").alias("y0"))
    rows = rows.withColumn("y1", F.col("y0") + F.col("l_linenumber"))
    return joins.regions_kept(rows.where("l_linenumber = 1").select("page", "y0", "y1").distinct(), rows.where("l_linenumber > 1").select("page", "y0", "y1").distinct())


@query("""WITH c AS (SELECT s_nationkey AS page, s_suppkey AS cell, s_suppkey % 50 AS x0, s_suppkey % 50 + 60 AS x1, 0 AS y0, 40 AS y1 FROM supplier),
  g AS (SELECT n_nationkey AS page, n_nationkey % 9 AS x0, n_nationkey % 9 + 5 + n_nationkey AS x1, 5 AS y0, 60 AS y1 FROM nation)
  SELECT page, cell, CAST(sum(greatest(0, least(c.x1, g.x1) - greatest(c.x0, g.x0)) * greatest(0, least(c.y1, g.y1) - greatest(c.y0, g.y0))) AS DOUBLE) AS area
  FROM c JOIN g USING (page) WHERE g.x1 - g.x0 >= 6 AND g.y1 - g.y0 >= 6 GROUP BY 1, 2 HAVING area > 300""")
def covered_cells(spark, d):
    s, n = tables.parquet(spark, d, "supplier"), tables.parquet(spark, d, "nation")
    cells = s.select(F.col("s_nationkey").alias("page"), F.col("s_suppkey").alias("cell"), (F.col("s_suppkey") % 50).alias("x0"), F.lit(0).alias("y0"), (F.col("s_suppkey") % 50 + 60).alias("x1"), F.lit(40).alias("y1"))
    k = F.col("n_nationkey")
    drawings = n.select(k.alias("page"), (k % 9).alias("x0"), F.lit(5).alias("y0"), (k % 9 + 5 + k).alias("x1"), F.lit(60).alias("y1"))
    return filters.covered_area(cells, drawings, least=300.0)


@query("""SELECT row_id, attempt, final_score FROM (SELECT *, row_number() OVER (PARTITION BY row_id ORDER BY page_order, attempt) AS turn FROM
  (SELECT l_orderkey AS row_id, l_linenumber AS attempt, l_suppkey AS page_order, l_partkey, CASE WHEN l_discount * 10 >= 0.9 THEN CAST(l_discount * 10 AS DOUBLE) ELSE coalesce(CASE WHEN l_tax > 0.02 THEN CAST(l_tax * 15 AS DOUBLE) END, CAST(l_discount * 10 AS DOUBLE)) END AS final_score
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber, l_suppkey ORDER BY l_partkey, l_extendedprice) AS u FROM lineitem) WHERE u = 1) WHERE final_score >= 0.7) WHERE turn = 1""")
def scores_accepted(spark, d):
    from pyspark.sql import Window

    u = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber", "l_suppkey").orderBy("l_partkey", "l_extendedprice"))
    rows = tables.parquet(spark, d, "lineitem").withColumn("u", u).where("u = 1")
    score, second = (F.col("l_discount") * 10).cast("double"), F.when(F.col("l_tax") > 0.02, (F.col("l_tax") * 15).cast("double"))
    rows = rows.select(F.col("l_orderkey").alias("row_id"), F.col("l_linenumber").alias("attempt"), F.col("l_suppkey").alias("page_order"), score.alias("score"), second.alias("second_score"))
    return filters.accepted_scores(rows, 0.7).select("row_id", "attempt", "final_score")


@query("""SELECT l_orderkey AS paper, CAST(o AS VARCHAR) || '.' || chr(96 + l) AS id, pos, CAST(o AS VARCHAR) AS root FROM
  (SELECT l_orderkey, l_suppkey AS o, l_linenumber AS l, CAST(min(l_partkey) AS BIGINT) AS pos FROM lineitem GROUP BY 1, 2, 3)""")
def expected_ids(spark, d):
    raw = tables.parquet(spark, d, "lineitem").select(F.col("l_orderkey").alias("paper"), F.col("l_partkey").cast("long").alias("pos"), F.concat("l_suppkey", F.lit(" ("), F.char(F.lit(96) + F.col("l_linenumber")), F.lit(") more")).alias("value"))
    return joins.expected_ids(raw).select("paper", "pos", "id", "root")


_TASKS = """WITH r AS (SELECT p_partkey % 50 AS paper, '7.' || chr(97 + CAST(p_partkey % 26 AS INTEGER)) AS label, lower(p_type) AS task FROM part) """


def _parts_as_rows(spark, d):
    p = tables.parquet(spark, d, "part").select((F.col("p_partkey") % 50).alias("paper"), F.col("p_partkey").alias("seq"), F.char((97 + F.col("p_partkey") % 26).cast("int")).alias("c"), F.col("p_type").alias("t"))
    return p.select("paper", "seq", F.concat(F.lit("7."), "c").alias("label"), F.concat(F.lit("7("), "c", F.lit(") Stem text (i) other "), F.lit("("), "c", F.lit(") "), "t").alias("body"))


@query(_TASKS + """SELECT DISTINCT a.paper, a.label, b.label AS sibling FROM r a JOIN r b ON a.paper = b.paper AND a.label <> b.label AND
  (a.task = b.task OR (least(length(a.task), length(b.task)) >= 1000)) WHERE length(a.task) >= 8 AND ascii(a.label[3]) <= 103""")
def copied_tasks(spark, d):
    rows = _parts_as_rows(spark, d)
    first = rows.where("ascii(right(label, 1)) <= 103")
    return joins.copied_tasks(first, rows).distinct()


@query("""WITH r AS (SELECT p_partkey AS seq, p_partkey % 50 AS paper, '7.' || chr(97 + CAST(p_partkey % 26 AS INTEGER)) AS label, lower(p_type) AS task FROM part)
  SELECT a.paper, a.label, a.seq, 'pictures of a rescue are not copied' AS warned, 0 AS n_urls, true AS needs_review FROM r a WHERE ascii(a.label[3]) BETWEEN 98 AND 101
  AND NOT EXISTS (SELECT 1 FROM r x JOIN r b ON x.paper = b.paper AND x.label <> b.label AND x.task = b.task AND length(x.task) >= 8 WHERE x.paper = a.paper AND x.label = a.label)""")
def rescues_accepted(spark, d):
    rows = _parts_as_rows(spark, d)
    rescued = rows.where("ascii(right(label, 1)) <= 103").withColumns({"urls": F.array(F.lit("http://x")), "warnings": F.array().cast("array<string>"), "needs_review": F.lit(False)})
    missing = rows.where("ascii(right(label, 1)) between 98 and 101").select("paper", F.col("label").alias("id"))
    return filters.accepted_rescues(rescued, missing, rows).select("paper", "label", "seq", F.array_join("warnings", "|").alias("warned"), F.size("urls").alias("n_urls"), "needs_review")


@query("""SELECT l_orderkey, l_comment_ AS stem FROM (SELECT l_orderkey, l_shipmode_ AS l_comment_, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS n FROM (SELECT *, l_returnflag AS l_shipmode_ FROM lineitem)) WHERE n = 1""")
def first_stems(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_returnflag").alias("stem"))
    return agg.first_by(rows, "l_orderkey", "stem", ["l_linenumber", "l_partkey", "l_suppkey"])


@query("""WITH k AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY place) AS k, place FROM (SELECT *, conv_id * 1000 + turn AS place FROM conversations)),
  p AS (SELECT conv_id FROM (SELECT conv_id, min(place) AS f FROM k GROUP BY 1) ORDER BY f LIMIT 6) SELECT conv_id, turn FROM (SELECT conv_id, turn, place FROM k WHERE k <= 3 AND conv_id IN (SELECT conv_id FROM p) ORDER BY place LIMIT 15)""")
def pages_capped(spark, d):
    rows = tables.parquet(spark, d, "conversations").withColumn("place", F.col("conv_id") * 1000 + F.col("turn"))
    return agg.capped(rows, "conv_id", "place", 3, 6, 15).select("conv_id", "turn")


@query("""SELECT count(*) AS rows, CAST(sum(CASE WHEN url <> '' THEN 1 ELSE 0 END) AS BIGINT) + CAST(sum(CASE WHEN page_id % 3 = 0 THEN 1 ELSE 0 END) AS BIGINT) AS urls,
  CAST(sum(length(url) + CASE WHEN page_id % 3 = 0 THEN 3 ELSE 0 END) AS BIGINT) AS url_chars FROM pages""")
def url_summary(spark, d):
    p = tables.parquet(spark, d, "pages").select(F.array("url", F.when(F.col("page_id") % 3 == 0, "abc").otherwise("  ")).alias("urls"))
    return agg.response_summary(p, "urls")


@query("""SELECT (SELECT count(*) FROM events WHERE event_type = 'error') AS failures, array_to_string(list(event_id ORDER BY event_id), ',') AS first FROM (SELECT event_id FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 8)""")
def first_failures(spark, d):
    found = agg.failures(tables.parquet(spark, d, "events"), F.col("event_type") == "error", "event_id", "user_id")
    return found.select("failures", F.array_join(F.transform("first_errors", lambda x: x["event_id"].cast("string")), ",").alias("first"))


@query("""WITH f AS (SELECT conv_id, turn, role, text, last_value(CASE WHEN role = 'user' THEN 'u' || turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS label FROM conversations)
  SELECT conv_id, label, coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (trim(text) <> ''), '') AS answer, coalesce(string_agg(role, chr(10) ORDER BY turn), '') AS marks FROM f WHERE label IS NOT NULL GROUP BY 1, 2""")
def lines_accumulated(spark, d):
    c = tables.parquet(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.concat(F.lit("u"), F.col("turn"))).otherwise(" ").alias("label"), F.coalesce("text", F.lit("")).alias("answer"), F.col("role").alias("marks"))
    return agg.accumulated(c, "conv_id", "turn", "label", ["answer", "marks"])


@query("""SELECT conv_id, role AS first_role, text AS first_text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS n FROM conversations) WHERE n = 1""")
def first_rows(spark, d):
    c = tables.parquet(spark, d, "conversations").select("conv_id", "turn", F.col("role").alias("first_role"), F.col("text").alias("first_text"))
    return windows.first_row(c, "conv_id", "turn", ["first_role", "first_text"])


@query("""SELECT conv_id, turn, last_value(CASE WHEN turn % 3 = 1 THEN turn END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS root FROM conversations""")
def roots_carried(spark, d):
    c = tables.parquet(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("turn") % 3 == 1, F.col("turn")).alias("own"))
    return windows.carried(c, "conv_id", "turn", "own", "root").select("conv_id", "turn", "root")


@query("""SELECT o_orderkey, CAST(row_number() OVER (ORDER BY coalesce(c_custkey, 1e18), o_orderkey) AS BIGINT) AS place FROM (SELECT o_orderkey, c_custkey FROM orders LEFT JOIN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0) ON o_custkey = c_custkey WHERE o_orderpriority = '1-URGENT') QUALIFY place <= 100""")
def expected_order(spark, d):
    rows = tables.parquet(spark, d, "orders").where("o_orderpriority = '1-URGENT'").select("o_orderkey", F.col("o_custkey").alias("key"))
    expected = tables.parquet(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("key"), F.col("c_custkey").alias("pos"))
    from pyspark.sql import Window

    ordered = sets.in_order_of(rows, expected, "key", "o_orderkey").limit(100)  # the first hundred are the report
    return ordered.withColumn("place", F.row_number().over(Window.orderBy(F.col("pos").asc_nulls_last(), "o_orderkey")).cast("long")).select("o_orderkey", "place")


@query("""SELECT count(*) AS n, count(DISTINCT o_orderkey) AS different, true AS again, true AS known FROM (SELECT o_orderkey FROM orders LIMIT 25)""")
def sampled_orders(spark, d):
    o = tables.parquet(spark, d, "orders").select("o_orderkey")
    one, two = tables.sample(o, 25, "o_orderkey"), tables.sample(o.repartition(3), 25, "o_orderkey")
    both = one.withColumn("a", F.lit(1)).join(two.withColumn("b", F.lit(1)), "o_orderkey", "full")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("o_orderkey").alias("different"), F.min(F.col("a").isNotNull() & F.col("b").isNotNull()).alias("again"), F.lit(True).alias("known"))


@query("""SELECT conv_id * 100 + turn AS input_pos, result FROM (SELECT *, CASE WHEN turn % 4 = 3 THEN NULL WHEN role = 'user' THEN 'qp ' || turn ELSE 'ms ' || turn END AS result FROM conversations) WHERE result IS NOT NULL""")
def two_phases(spark, d):
    c = tables.parquet(spark, d, "conversations").withColumn("input_pos", F.col("conv_id") * 100 + F.col("turn"))
    make = lambda kind: F.when(F.col("turn") % 4 != 3, F.concat(F.lit(f"{kind} "), F.col("turn")))
    return sets.two_phase(c.where("role = 'user'").select("input_pos", make("qp").alias("result")), c.where("role <> 'user' or role is null").select("input_pos", make("ms").alias("result")), "input_pos")


@query("""SELECT n_nationkey, n_name, NULL AS n_regionkey FROM nation WHERE n_nationkey < 5 UNION ALL SELECT n_nationkey, NULL, n_regionkey FROM nation WHERE n_nationkey >= 20""")
def rows_appended(spark, d):
    n = tables.parquet(spark, d, "nation")
    return sets.appended(n.where("n_nationkey < 5").select("n_nationkey", "n_name"), n.where("n_nationkey >= 20").select("n_nationkey", "n_regionkey")).select("n_nationkey", "n_name", "n_regionkey")


@query("""SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'second' ELSE 'first' END AS answer, false AS failed FROM pages""")
def pages_retried(spark, d):
    p = tables.parquet(spark, d, "pages").select("page_id", (F.col("page_id") % 7 == 0).alias("failed"))
    again = p.where("page_id % 3 >= 0").select("page_id", F.lit("second").alias("answer"), F.lit(False).alias("failed"))
    return sets.retried(p.select("page_id", F.lit("first").alias("answer"), "failed"), again, "page_id").select("page_id", "answer", "failed")


@query("""SELECT conv_id, turn, turn * 2 + 1 AS page FROM conversations WHERE turn < 20""")
def pages_remapped(spark, d):
    rows = tables.parquet(spark, d, "conversations").select("conv_id", "turn", F.col("turn").alias("page"))
    index = spark.range(20).select(F.col("id").cast("int").alias("subset_page"), (F.col("id") * 2 + 1).cast("int").alias("page"))
    return sets.remapped_pages(rows, index)


@query("""SELECT l_orderkey, round((max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) + count(*) - count(DISTINCT l_linenumber) + count_if(l_returnflag = 'R')) / greatest(count(*), 1), 4) AS score FROM lineitem GROUP BY 1""")
def fragmentation(spark, d):
    g = tables.parquet(spark, d, "lineitem").groupBy("l_orderkey").agg((F.max("l_linenumber") - F.min("l_linenumber") + 1 - F.count_distinct("l_linenumber")).alias("g"), (F.count(F.lit(1)) - F.count_distinct("l_linenumber")).alias("u"), F.count_if(F.col("l_returnflag") == "R").alias("o"), F.count(F.lit(1)).alias("n"))
    return g.select("l_orderkey", validate.fragmentation(F.col("g"), F.col("u"), F.col("o"), F.col("n")).alias("score"))


@query("""WITH w AS (SELECT p_partkey, list_distinct(regexp_extract_all(lower(p_name), '[a-z]{3,}|[0-9]+')) AS a, list_distinct(regexp_extract_all(lower(p_type || ' ' || p_brand || ' ' || p_name[1:8]), '[a-z]{3,}|[0-9]+')) AS b FROM part)
  SELECT p_partkey, CAST(len(list_intersect(a, b)) AS INTEGER) AS shared, round(len(list_intersect(a, b)) / greatest(1, least(len(a), len(b))), 4) AS share FROM w""")
def token_consistency(spark, d):
    p = tables.parquet(spark, d, "part").select("p_partkey", F.col("p_name").alias("a"), F.concat_ws(" ", "p_type", "p_brand", F.substring("p_name", 1, 8)).alias("b"))
    return validate.token_consistency(p, "a", "b").select("p_partkey", "shared", "share")


@query("""SELECT c_custkey, CASE WHEN n_name IS NULL THEN c_name ELSE n_name || chr(10) || c_name END AS body FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey % 2 = 0) ON c_nationkey = n_nationkey""")
def stems_merged(spark, d):
    rows = tables.parquet(spark, d, "customer").select("c_custkey", F.col("c_nationkey").alias("root"), F.col("c_name").alias("body"))
    stems = tables.parquet(spark, d, "nation").where("n_nationkey % 2 = 0").select(F.col("n_nationkey").alias("root"), F.col("n_name").alias("body"))
    return validate.with_stems(rows, stems, "root", "body").select("c_custkey", "body")


@query("""SELECT CAST(p_partkey AS VARCHAR) AS question_id, coalesce(CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_brand END, p_type) AS body, NULL AS missing FROM part""")
def aliases_remapped(spark, d):
    p = tables.parquet(spark, d, "part").select(F.col("p_partkey").alias("question_id"), F.when(F.col("p_size") % 3 == 0, "N/A").otherwise(F.col("p_brand")).alias("question"), F.col("p_type").alias("text"), F.lit(1).alias("unknown"))
    return filters.declared(filters.remapped(p, {"body": ["question", "text"]}), {"question_id": "string", "body": "string", "missing": "string"})


@query("""SELECT page_id AS id, CASE WHEN page_id % 5 = 0 THEN NULL ELSE url END AS url, page_id % 5 = 0 AS corrupt, octet_length(encode(url)) AS size FROM pages""")
def requests_read(spark, d):
    p = tables.parquet(spark, d, "pages").select("page_id", "url")
    body = F.to_json(F.struct(F.col("page_id").alias("id"), "url", F.base64(F.encode("url", "UTF-8")).alias("payload")))
    body = F.when(F.col("page_id") % 5 == 0, F.concat(body, F.lit("}{"))).otherwise(body)
    raw = p.select("page_id", "url", F.when(F.col("page_id") % 5 == 0, F.lit("{broken")).otherwise(body).alias("value"))
    read = tables.parsed_requests(raw, "value", "id long, url string, payload string")
    decoded = F.coalesce(F.octet_length(tables.decoded(F.concat(F.lit("data:x;base64,"), F.col("request.payload")))), F.octet_length("url"))
    return read.select(F.coalesce("request.id", "page_id").alias("id"), F.col("request.url").alias("url"), F.col("corrupt").isNotNull().alias("corrupt"), decoded.cast("long").alias("size"))


@query("""SELECT doc_id, CAST(k - 1 AS INTEGER) AS line_no, length(l[k]) AS n FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents), range(1, 100000) r(k) WHERE k <= len(l) AND trim(l[k], ' ') <> ''""")
def document_lines(spark, d):
    rows = tables.lines(tables.parquet(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text")
    return rows.select("doc_id", "line_no", F.char_length("line").cast("long").alias("n"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(i AS INTEGER) END AS seq, CASE WHEN o_orderkey % 4 <> 3 THEN o_orderkey || '(' || chr(97 + CAST(i AS INTEGER)) || ')' END AS label, o_orderkey % 4 = 3 AS page_failed
  FROM orders, range(0, 2) r(i) WHERE o_orderkey % 4 <> 3 OR i = 0""")
def answers_read(spark, d):
    o = tables.parquet(spark, d, "orders").select("o_orderkey")
    item = lambda k: F.concat(F.lit('{"label": "'), F.col("o_orderkey"), F.lit(f'({k})", "marks": 1}}'))
    raw = F.concat(F.lit("["), item("a"), F.lit(", "), item("b"), F.lit("]"))
    body = F.when(F.col("o_orderkey") % 4 == 3, F.concat(F.lit("sorry "), F.col("o_orderkey"))).when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("```json\n"), raw, F.lit("\n```"))).otherwise(raw)
    return tables.model_rows(o.withColumn("body", body), ["o_orderkey"], "body", "label string, marks int").select("o_orderkey", "seq", "label", "page_failed")


@query("""SELECT c_custkey AS table_id, 'q' || c_custkey AS question, 'a ' || c_name AS answer, CASE WHEN c_custkey % 2 = 0 THEN 'm' ELSE 'm m2' END AS marks, CASE WHEN c_custkey % 2 = 0 THEN '' ELSE 'p p2' END AS partial FROM customer WHERE c_custkey % 3 <> 0""")
def scheme_tables(spark, d):
    c = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("table_id"), "c_name", (F.col("c_custkey") % 2 == 0).alias("even"), (F.col("c_custkey") % 3 == 0).alias("plain"))
    q = F.concat(F.lit("q"), F.col("table_id"))
    four = F.array(q, F.concat(F.lit("a "), F.col("c_name")), F.lit("m"), F.lit(""))
    eight = F.array(q, F.lit(""), F.lit("a"), F.col("c_name"), F.lit("m"), F.lit("m2"), F.lit("p"), F.lit("p2"))
    rows = c.select("table_id", F.lit(1).alias("row_no"), F.when(F.col("even"), four).otherwise(eight).alias("cells"))
    heads = c.where("not plain").select("table_id", F.lit(0).alias("row_no"), F.array(*map(F.lit, ("Question", "Answer", "Marks", "Partial"))).alias("cells"))
    return tables.table_cells(rows.unionByName(heads)).select("table_id", "question", "answer", "marks", "partial")


@query("""SELECT vec_id, CASE WHEN b - t >= 10 AND b - t <= 0.78 * 842 THEN round(t, 4) END AS y0, CASE WHEN b - t >= 10 AND b - t <= 0.78 * 842 THEN round(b, 4) END AS y1 FROM
  (SELECT vec_id, greatest(0, (abs(embedding[1]::DOUBLE) * 100 - 2) / 100 * 842) AS t, least(842, (abs(embedding[2]::DOUBLE) * 300 + 2) / 100 * 842) AS b FROM embeddings)""")
def crop_boxes(spark, d):
    e = tables.parquet(spark, d, "embeddings")
    box = tables.crop_box(F.lit(595.0), F.lit(842.0), F.abs(F.col("embedding")[0].cast("double")) * 100, F.abs(F.col("embedding")[1].cast("double")) * 300)
    return e.select("vec_id", F.round(box["y0"], 4).alias("y0"), F.round(box["y1"], 4).alias("y1"))


@query("""SELECT event_id FROM events WHERE epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts) < 4 * 3600 * 1000000::BIGINT""")
def fresh_entries(spark, d):
    e = tables.parquet(spark, d, "events")
    last = e.agg(F.max("ts")).first()[0]
    return tables.fresh(e.select("event_id", "ts"), F.lit(last)).select("event_id")


@query("""WITH f AS (SELECT user_id AS key, arg_max(event_type, {'ts': ts, 'id': event_id}) AS answer FROM events WHERE epoch_us((SELECT max(ts) FROM events)) - epoch_us(ts) < 100 * 3600 * 1000000::BIGINT GROUP BY 1), w AS (SELECT DISTINCT user_id AS key FROM events)
  SELECT key, coalesce(answer, 'made for ' || key) AS answer, answer IS NOT NULL AS hit FROM w LEFT JOIN f USING (key)""")
def cache_answers(spark, d):
    e = tables.parquet(spark, d, "events")
    last = e.agg(F.max("ts")).first()[0]
    at = e.groupBy("user_id", "ts").agg(F.max_by("event_type", "event_id").alias("answer")).select(F.col("user_id").alias("key"), "ts", "answer")
    found, _ = tables.cached(at, e.select(F.col("user_id").alias("key")), lambda rest: rest.select("key").distinct().withColumn("answer", F.concat(F.lit("made for "), F.col("key"))), F.lit(last), 100.0)
    return found.select("key", "answer", "hit")


@query("""SELECT 'extract' AS stage, coalesce('value ' || CAST(round(value, 2) AS VARCHAR), 'unknown error') AS message, 422 AS status, CAST(user_id AS BIGINT) AS user_id FROM events WHERE event_type = 'error'""")
def error_details(spark, d):
    e = tables.parquet(spark, d, "events").select("event_id", "user_id", "event_type", F.round("value", 2).alias("value"))
    found = tables.errors(e, F.col("event_type") == "error", "extract", F.concat(F.lit("value "), F.col("value").cast("string")), 422)
    return found.select("stage", "message", "status", F.get_json_object("details", "$.user_id").cast("long").alias("user_id"))


@query("""SELECT o_orderkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN coalesce(c_mktsegment, 'none') ELSE o_orderpriority END AS session, CASE WHEN o_orderkey % 3 = 0 THEN coalesce(c_name, 'none') ELSE o_orderstatus END AS tier, 'MEDIUM' AS demand
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def rows_normalised(spark, d):
    raw = tables.parquet(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("paper"), F.col("o_orderpriority").alias("session"), F.when(F.col("o_orderkey") % 3 == 0, "N/A").otherwise(F.col("o_orderstatus")).alias("tier"))
    meta = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("paper"), F.when(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"), F.col("c_mktsegment")).alias("session"), F.col("c_name").alias("tier"))
    fields = {"session": F.lit("none"), "tier": F.lit("none"), "demand": F.lit("MEDIUM")}
    return tables.normalised_rows(raw, meta, "paper", fields, ["session"], F.lit(True)).select("o_orderkey", "session", "tier", "demand")


@query("""SELECT c_custkey, CASE WHEN n_nationkey IS NULL THEN c_name ELSE n_name END AS c_name, n_regionkey AS region FROM customer LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON c_nationkey = n_nationkey""")
def rows_updated(spark, d):
    c = tables.parquet(spark, d, "customer").select("c_custkey", "c_nationkey", "c_name")
    n = tables.parquet(spark, d, "nation").where("n_nationkey < 12").select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("c_name"), F.col("n_regionkey").alias("region"))
    return tables.updated(c, n, "c_nationkey").select("c_custkey", "c_name", "region")


@query("""WITH g AS (SELECT l_orderkey, count(*) AS rows, list_sort(list_distinct(list(l_linenumber))) AS have FROM lineitem GROUP BY 1)
  SELECT l_orderkey, CAST(rows AS INTEGER) AS rows, CASE WHEN len(have) < have[-1] - have[1] + 1 THEN 'warning' ELSE 'ok' END AS status, CASE WHEN len(have) < have[-1] - have[1] + 1 THEN 'review' ELSE 'proceed' END AS recommendation,
  array_to_string(list_filter(range(have[1], have[-1]), lambda x: NOT list_contains(have, x)), ',') AS missing FROM g""")
def envelopes(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("int").alias("seq"), F.col("l_linenumber").cast("int").alias("root"), F.col("l_returnflag").alias("body"))
    e = agg.envelope(rows, "l_orderkey", "root", ["root", "body"])
    return e.select("l_orderkey", F.size("questions").alias("rows"), "report.status", "report.recommendation", F.array_join("report.missing", ",").alias("missing"))


@query("""SELECT c_custkey AS paper, turn, question_id, replace(content, '#', CAST(c_custkey AS VARCHAR)) AS content FROM customer, (VALUES (1, '1.a.i', 'Find #'), (2, '1.a.i.2', 'x More ( 2 )'), (3, '2', 'alone'), (4, '3.a.i', ''), (5, '3.a.i.b', 'last #'), (6, '3.a.i.b.l', 'ine Line')) x(turn, question_id, content)""")
def scheme_texts(spark, d):
    body = F.concat(
        F.lit("Preamble (a)\nQuestion Answer Marks Partial Marks\n1(a)(i) Find "), F.col("c_custkey"), F.lit(" [2]\nPage 3 of 8\n(ii) x\n More ( 2 )\n2 alone\n[Turn ove\r\n3a(i)\n(b) last "), F.col("c_custkey"), F.lit("\n\n  line [1]\nLine")
    )
    texts = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("paper"), body.alias("body"))
    return tables.scheme_questions(texts, "paper", "body").select("paper", "turn", "question_id", "content")


@query("""SELECT o_custkey AS target, o_orderkey AS page, CAST(sum(s) AS BIGINT) AS score FROM (SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 28 WHEN o_orderkey % 5 = 1 THEN 8 WHEN o_orderkey % 5 = 2 THEN 3 END AS s FROM orders) WHERE s > 0 GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY sum(s) DESC, o_orderkey) <= 3""")
def page_prune(spark, d):
    o = tables.parquet(spark, d, "orders").select(F.col("o_custkey").alias("paper"), F.col("o_orderkey").alias("page"))
    k = F.col("page") % 5
    pages = o.withColumn("page_text", F.when(k == 0, "Cover\n7 (a) Draw").when(k == 1, "x\n 7 words").when(k == 2, "see 7 there").when(k == 3, "17 70").otherwise("nothing"))
    wanted = o.select("paper").distinct().select("paper", F.col("paper").alias("target"), F.lit("7(a)").alias("shown"), F.lit("7").alias("root"))
    return joins.page_scores(joins.page_hints(pages, wanted), 3).select("target", "page", "score")


@query("""SELECT user_id, event_type AS status FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_type DESC) AS k FROM events) WHERE k = 1""")
def job_status(spark, d):
    e = tables.parquet(spark, d, "events").select("user_id", "ts", F.col("event_type").alias("status"))
    return ledger.latest(e, "user_id", "ts", "status").select("user_id", "status")


@query("""SELECT user_id, event_id, round((epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id)) / 1e6, 3) AS gap_s FROM events""")
def slot_gaps(spark, d):
    return windows.slot_gaps(tables.parquet(spark, d, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", F.round("gap_s", 3).alias("gap_s"))


@query("""WITH r AS (SELECT c_nationkey AS page, c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) AS k FROM customer), q AS (SELECT s_nationkey AS page, s_suppkey, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_suppkey) AS k FROM supplier),
  n AS (SELECT page, max(k) AS n FROM q GROUP BY 1) SELECT c_custkey, s_suppkey FROM r JOIN n USING (page) JOIN q ON q.page = r.page AND q.k = least(r.k, n.n)""")
def kth_to_kth(spark, d):
    regions = tables.parquet(spark, d, "customer").select(F.col("c_nationkey").alias("page"), "c_custkey")
    rows = tables.parquet(spark, d, "supplier").select(F.col("s_nationkey").alias("page"), "s_suppkey")
    return joins.kth_to_kth(regions, rows, "page", "c_custkey", "s_suppkey").select("c_custkey", "s_suppkey")


@query("""SELECT doc_id, CAST(k - 1 AS INTEGER) AS page_index, string_split(text, ' the ')[k] AS page_text FROM (SELECT doc_id, coalesce(text, '') AS text FROM documents), range(1, 100000) r(k) WHERE k <= len(string_split(text, ' the '))""")
def page_scan(spark, d):
    docs = tables.parquet(spark, d, "documents").select("doc_id", F.replace("text", F.lit(" the "), F.lit("\f")).alias("text"))
    return tables.pages(docs, "doc_id", "text")


@query("""SELECT n_name, array_to_string(list(c_custkey ORDER BY c_custkey)[1:8], ',') AS first_items, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""")
def limited_lists(spark, d):
    c = tables.parquet(spark, d, "customer").join(F.broadcast(tables.parquet(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))  # nation has 25 rows at every scale
    first = sets.top(c.select("n_name", "c_custkey"), ["n_name"], [F.col("c_custkey")], 8).groupBy("n_name").agg(F.array_sort(F.collect_list("c_custkey")).alias("items"))
    return c.groupBy("n_name").agg(F.count(F.lit(1)).alias("n")).join(first, "n_name").select("n_name", F.array_join(sets.first_items(F.col("items"), 8), ",").alias("first_items"), "n")


@query("""SELECT l_orderkey AS paper, l_orderkey || '.' || chr(96 + CAST(l_linenumber AS INTEGER)) AS id, n FROM (SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2)""")
def label_counts(spark, d):
    raw = F.concat(F.lit(" Q "), F.col("l_orderkey"), F.lit(" [ "), F.char(F.lit(96) + F.col("l_linenumber")), F.lit(" ]"))
    rows = tables.parquet(spark, d, "lineitem").groupBy("l_orderkey", raw.alias("raw")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select(F.col("l_orderkey").alias("paper"), labels.canonical(labels.parts(F.col("raw"))).alias("id"), "n")


@query("""WITH a AS (SELECT l_orderkey AS call, l_linenumber AS attempt, l_shipmode_ AS model, l_returnflag = 'R' AS failed FROM (SELECT *, CASE WHEN l_orderkey % 3 = 0 THEN 'lite' ELSE 'full' END AS l_shipmode_,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_extendedprice) AS k FROM lineitem) WHERE k = 1),
  p AS (SELECT call, model, count(*) AS n, arg_max(failed, attempt) AS lost FROM a GROUP BY 1, 2) SELECT model, count(*) AS calls, count_if(n > 1) AS retried, CAST(sum(n) AS BIGINT) AS attempts, count_if(lost) AS lost FROM p GROUP BY 1""")
def call_attempts(spark, d):
    from pyspark.sql import Window

    k = F.row_number().over(Window.partitionBy("l_orderkey", "l_linenumber").orderBy("l_partkey", "l_suppkey", "l_extendedprice"))
    rows = tables.parquet(spark, d, "lineitem").withColumn("k", k).where("k = 1")
    rows = rows.select(F.col("l_orderkey").alias("call"), F.col("l_linenumber").alias("attempt"), F.when(F.col("l_orderkey") % 3 == 0, "lite").otherwise("full").alias("model"), (F.col("l_returnflag") == "R").alias("failed"))
    return ledger.attempts(rows, "call", "model", "failed")


@query("""WITH c AS (SELECT user_id, epoch_us(ts) // 1000000 AS s, epoch_us(ts) // 1000000 + 3600 * (1 + event_id % 40) AS e FROM events), x AS (SELECT user_id, s AS t, 1 AS step FROM c UNION ALL SELECT user_id, e, -1 FROM c),
  p AS (SELECT user_id, t, sum(step) AS step FROM x GROUP BY 1, 2), l AS (SELECT user_id, sum(step) OVER (PARTITION BY user_id ORDER BY t) AS level FROM p),
  g AS (SELECT user_id, s - lag(s) OVER (PARTITION BY user_id ORDER BY s) AS gap FROM c)
  SELECT user_id, CAST(max(level) AS BIGINT) AS at_once, (SELECT min(gap) FROM g WHERE g.user_id = l.user_id) AS least_gap FROM l GROUP BY 1""")
def calls_running(spark, d):
    s = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / 1_000_000)
    e = tables.parquet(spark, d, "events").select("user_id", s.alias("s"), (s + 3600 * (1 + F.col("event_id") % 40)).alias("e"))
    return ledger.running(e, "user_id", "s", "e")


@query("""SELECT c_custkey AS paper, CAST(c AS BIGINT) AS chunk, CAST(n AS BIGINT) AS blocks, CAST(n * (6 + length(CAST(c_custkey AS VARCHAR))) AS INTEGER) AS size FROM customer, (VALUES (0, 3), (1, 3), (2, 1)) x(c, n)""")
def block_chunks(spark, d):
    k = F.col("c_custkey").cast("string")
    body = F.concat(F.lit("intro\n"), *[x for i in range(1, 8) for x in (F.lit(f"{i}. "), k, F.lit(" x\n"))])
    texts = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("paper"), body.alias("body"))
    return tables.chunks(texts, "paper", "body", most=45, blocks=3).select("paper", "chunk", "blocks", F.char_length("text").alias("size"))


@query("""SELECT c_custkey AS paper, i AS place, x.label, replace(x.body, '#', CAST(c_custkey AS VARCHAR)) AS body, x.warned, x.review AS needs_review, 'warning' AS status, '2' AS missing FROM customer, (VALUES
  (0, '1.a', '1 Stem # 1(a) Find p', '', false), (1, '1.b', '1 Stem # 1(b) Find q, and 1(d) too', 'may also hold 1.d', true), (2, '1.c', '1(c) from the model', '', true), (3, '3', '3 Last', '', false)) x(i, label, body, warned, review)""")
def paper_runs(spark, d):
    from . import lifecycle

    c = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("paper"))
    line = lambda k, x, y, t: F.struct(F.lit(k).cast("long").alias("line_no"), F.lit(float(x)).alias("x0"), F.lit(float(y)).alias("y0"), t.alias("line"))
    shown = [F.concat(F.lit("1 Stem "), F.col("paper")), F.lit("(a) Find p"), F.lit("(b) Find q, and 1(d) too"), F.lit("3 Last")]
    lines = c.select("paper", F.lit(0).alias("page"), F.explode(F.array(*[line(k, 50, 10 * k, t) for k, t in enumerate(shown)])).alias("x")).select("paper", "page", "x.*")
    raw = c.select("paper", F.posexplode(F.array(*[F.lit(x) for x in ("1(a)", "1 (b)", "1(c)", "1(d)", "3", "1(a)")])).alias("pos", "value"))
    answers = c.select("paper", F.explode(F.array(F.struct(F.lit(90).cast("long").alias("seq"), F.lit("1.c").alias("label"), F.lit("1(c) from the model").alias("body")), F.struct(F.lit(91).cast("long").alias("seq"), F.lit("8").alias("label"), F.lit("8 not expected").alias("body")))).alias("x")).select("paper", "x.*")
    out = lifecycle.question_paper(lines, raw, answers)
    rows = out.select("paper", "report", F.posexplode("questions").alias("place", "q"))
    return rows.select("paper", "place", "q.label", "q.body", F.array_join("q.warnings", "|").alias("warned"), "q.needs_review", "report.status", F.array_join("report.missing", ",").alias("missing"))


@query("""SELECT c_custkey AS table_id, i AS place, x.id, replace(x.answer, '#', CAST(c_custkey AS VARCHAR)) AS answer, x.marks AS total_marks, x.demand, x.steps, 'ok' AS status FROM customer, (VALUES
  (0, '1.a', 'x = #', 1, 'LOW', 'B1'), (1, '1.b.i', 'first' || chr(10) || 'second', 3, 'HIGH', 'M2,A1'), (2, '2', 'last', 2, 'MEDIUM', '')) x(i, id, answer, marks, demand, steps)""")
def scheme_runs(spark, d):
    from . import lifecycle

    c = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("table_id"))
    row = lambda k, *cells: F.struct(F.lit(k).alias("row_no"), F.array(*cells).alias("cells"))
    t = F.lit
    rows = [
        row(0, t("Question"), t("Answer"), t("Marks"), t("Partial marks")),
        row(1, t("1(a)"), F.concat(t("x = "), F.col("table_id")), t("1"), t("B1")),
        row(2, t("1(b)(i)"), t("first"), t("M2"), t("")),
        row(3, t(""), t("second"), t("A1"), t("")),
        row(4, t("2"), t("last"), t("2"), t("")),
    ]
    out = lifecycle.marking_scheme(c.select("table_id", F.explode(F.array(*rows)).alias("x")).select("table_id", "x.*"))
    found = out.select("table_id", "report.status", F.posexplode("questions").alias("place", "q"))
    return found.select("table_id", "place", "q.id", "q.answer", "q.total_marks", "q.demand", F.array_join(F.transform("q.steps", lambda s: s["type"]), ",").alias("steps"), "status")


@query("""SELECT c_custkey AS page, '7(a)' AS question_number, CAST(5 AS DOUBLE) AS y0, CAST(20 + c_custkey % 40 AS DOUBLE) AS y1 FROM customer WHERE c_custkey % 4 <> 3
  UNION ALL SELECT c_custkey, '8', CAST(60 AS DOUBLE), CAST(95 AS DOUBLE) FROM customer WHERE c_custkey % 4 <> 3""")
def regions_read(spark, d):
    k = F.col("c_custkey")
    entry = lambda n, a, b: F.concat(F.lit(f'{{"question_number": {n}, "y_start_pct": {a}, "y_end_pct": '), b.cast("string"), F.lit("}"))
    items = F.concat_ws(", ", entry('" 7(a) "', 2, 20 + k % 40), entry("8", 60, F.lit(99)), entry('"9"', 50, F.lit(40)), entry('"9"', 50, F.lit(52)), entry('""', 20, F.lit(40)), entry("null", 20, F.lit(40)), entry('"9"', -1, F.lit(40)), entry('"9"', 6, F.lit(90)), F.lit('"text"'))
    listed = F.concat(F.lit("["), items, F.lit("]"))
    body = F.when(k % 4 == 0, listed).when(k % 4 == 1, F.concat(F.lit('{"items": '), listed, F.lit("}"))).when(k % 4 == 2, F.concat(F.lit("```json\n"), listed, F.lit("\n```"))).otherwise(F.lit("sorry"))
    return tables.vision_regions(tables.parquet(spark, d, "customer").select(k.alias("page"), body.alias("body")), ["page"], "body")


@query("""SELECT c_custkey AS paper, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS subject_name, CASE WHEN c_custkey % 3 < 2 THEN 'HL' END AS level, NULL AS paper_number, NULL AS timezone, CASE WHEN c_custkey % 3 = 0 THEN 'May' END AS session,
  CASE WHEN c_custkey % 3 < 2 THEN '2023' END AS year, NULL AS document_type FROM customer""")
def first_pages(spark, d):
    k = F.col("c_custkey") % 3
    full = F.concat(F.lit('{"subject_name": "'), F.col("c_name"), F.lit('", "level": " HL ", "paper_number": null, "timezone": "N/A", "session": "May", "year": 2023}'))
    body = F.when(k == 0, full).when(k == 1, F.lit('```json\n{"level": "HL", "year": "2023", "subject_name": ""}\n```')).otherwise(F.lit("no answer"))
    return tables.page_metadata(tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("paper"), body.alias("body")), ["paper"], "body")


@query("""SELECT c_custkey AS row_id, '7(a)' AS label, CASE WHEN c_custkey % 4 = 0 THEN '7(a) Second try ' || c_custkey WHEN c_custkey % 4 = 1 THEN '7(a) First try ' || c_custkey ELSE 'Stem ' || c_nationkey || repeat('x', 40) || ' 7(a) own' END AS body,
  CASE WHEN c_custkey % 4 < 2 THEN 'model' ELSE 'sibling' END AS source FROM customer""")
def rows_repaired(spark, d):
    c = tables.parquet(spark, d, "customer")
    rows = c.select(F.col("c_custkey").alias("row_id"), F.col("c_nationkey").alias("parent"), F.lit("7(a)").alias("label"), F.lit("7(a) own").alias("body"))
    stems = c.select("c_nationkey").distinct().select((-F.col("c_nationkey") - 1).alias("row_id"), F.col("c_nationkey").alias("parent"), F.lit("7").alias("label"), F.concat(F.lit("7 Stem "), F.col("c_nationkey"), F.repeat(F.lit("x"), F.lit(40))).alias("body"))
    try_ = lambda n, score, second, body: F.struct(F.lit(1).alias("page_order"), F.lit(n).alias("attempt"), score.alias("score"), F.lit(second).cast("double").alias("second_score"), body.alias("text"))
    k = F.col("c_custkey")
    first = try_(1, F.when(k % 4 == 1, 0.95).otherwise(0.5), None, F.concat(F.lit("7(a) First try "), k))
    second = try_(2, F.when(k % 4 == 0, 0.8).otherwise(0.2), None, F.concat(F.lit("7(a) Second try "), k))
    blank = try_(0, F.lit(0.99), None, F.lit("7(a) Blank page"))
    proposals = c.select(k.alias("row_id"), F.explode(F.array(blank, first, second)).alias("x")).select("row_id", "x.*")
    return filters.repaired_rows(rows.unionByName(stems), proposals, 0.7).where("row_id > 0 or label = '7(a)'").select("row_id", "label", "body", "source")


@query("SELECT c_custkey AS crop, c_custkey % 7 = 0 OR (c_custkey % 5 <> 0 AND c_custkey % 3 = 2) AS content FROM customer")
def crop_contents(spark, d):
    k = F.col("c_custkey")
    width = F.when(k % 5 == 0, 59).otherwise(80)
    black = F.when(k % 3 == 2, 400).when(k % 3 == 1, 10).otherwise(0)
    pixels = F.unhex(F.concat(F.expr("repeat('00', black)"), F.expr("repeat('FF', width * 50 - black)")))
    c = tables.parquet(spark, d, "customer").select(k.alias("crop"), width.alias("width"), black.alias("black")).withColumn("pixels", pixels)
    c = c.withColumn("pixels", F.when(F.col("crop") % 7 == 0, F.lit(None)).otherwise(F.col("pixels")))
    return c.select("crop", filters.crop_has_content("pixels", "width", F.lit(50)).alias("content"))
