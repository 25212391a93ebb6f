"""Driver queries of the engine's own operators, with the same in DuckDB's SQL where it can be expressed.

Labels are made from lineitem: l_orderkey(letter of l_linenumber)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import coerce, keys, labels, text
from ..operators import aggregates as agg
from ..operators import filters, joins, sequence, sets, validate, windows
from ..sources import tables
from ..streaming import ledger
from . import cases, state_cases, tables_cases  # noqa: F401  they register their queries
from .registry import QUERIES, SQL, query  # noqa: F401

def _label() -> Column:
    return F.concat(F.col("l_orderkey").cast("string"), F.lit("("), F.char(F.lit(96) + F.col("l_linenumber")), F.lit(")"))


_LABEL = "concat(l_orderkey, '(', chr(96 + l_linenumber), ')')"


@query("""SELECT l_orderkey, max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS n_missing,
  min(l_linenumber) + (SELECT min(k) FROM range(1, 8) r(k) WHERE NOT list_contains(list(DISTINCT l_linenumber), min(l_linenumber) + k)) AS first_missing
  FROM lineitem GROUP BY 1 HAVING n_missing > 0""")
def gap_report(spark, d):
    return agg.gaps(tables.parquet(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_ids(spark, d):
    return agg.duplicates(tables.parquet(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def _parity(spark, d):
    qp = tables.parquet(spark, d, "lineitem").where("l_linenumber > 1").select(F.col("l_orderkey").alias("key"))
    ms = tables.parquet(spark, d, "orders").where("o_totalprice > 50000").select(F.col("o_orderkey").alias("key"))
    return joins.parity(qp, ms, "key")


_PARITY = """WITH q AS (SELECT DISTINCT l_orderkey AS key FROM lineitem WHERE l_linenumber > 1),
  m AS (SELECT DISTINCT o_orderkey AS key FROM orders WHERE o_totalprice > 50000),
  p AS (SELECT coalesce(q.key, m.key) AS key, CASE WHEN m.key IS NULL THEN 'extra' WHEN q.key IS NULL THEN 'missing' ELSE 'exact' END AS status
  FROM q FULL JOIN m ON q.key = m.key) """


@query(_PARITY + "SELECT key, status FROM p")
def parity_ids(spark, d):
    return _parity(spark, d)


@query(_PARITY + """SELECT CAST(count_if(status = 'exact') AS BIGINT) AS exact, CAST(count_if(status = 'missing') AS BIGINT) AS missing, CAST(count_if(status = 'extra') AS BIGINT) AS extra,
  round(count_if(status = 'exact') / greatest(1, count_if(status <> 'extra')), 4) AS ratio FROM p""")
def parity_summary(spark, d):
    return agg.coverage(_parity(spark, d))


@query(f"""SELECT DISTINCT {_LABEL} AS label FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def prefix_cover(spark, d):
    ids = tables.parquet(spark, d, "lineitem").select(_label().alias("label")).distinct()
    known = tables.parquet(spark, d, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").cast("string").alias("id"))
    return joins.covered(ids, known, labels.prefixes(labels.parts(F.col("label"))), "label", "id")


@query(f"""SELECT {_LABEL} AS label, concat(l_orderkey, '.', chr(96 + l_linenumber)) AS canonical, CAST(l_orderkey AS VARCHAR) AS root,
  CAST(l_orderkey AS VARCHAR) AS above, 2 AS depth, concat(l_orderkey, chr(96 + l_linenumber)) AS squashed,
  concat(l_orderkey, '(', chr(96 + l_linenumber), ')') AS shown, count(*) AS n FROM lineitem GROUP BY ALL""")
def label_parse(spark, d):
    rows = tables.parquet(spark, d, "lineitem").groupBy(_label().alias("label")).agg(F.count(F.lit(1)).alias("n"))
    rows, p = rows.withColumn("p", labels.parts(F.col("label"))), F.col("p")
    return rows.select("label", labels.canonical(p).alias("canonical"), labels.root(p).alias("root"), labels.immediate_parent(p).alias("above"), labels.metadata(p)["depth"].alias("depth"), labels.squashed(F.col("label")).alias("squashed"), labels.shown(p).alias("shown"), "n")


@query("""SELECT l_orderkey, l_linenumber, concat(l_orderkey, '.', chr(97 + l_linenumber)) AS following, concat('text of ', l_comment) AS remainder
  FROM (SELECT DISTINCT l_orderkey, l_linenumber, l_returnflag AS l_comment FROM lineitem)""")
def label_increment(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").distinct()
    raw = F.concat(F.col("l_orderkey").cast("string"), F.lit("("), F.char(F.lit(96) + F.col("l_linenumber")), F.lit(") text of "), F.col("l_returnflag"))
    rows = rows.withColumn("raw", raw)
    rows = rows.withColumns({"p": labels.parts(F.col("raw")), "span": labels.span(F.col("raw"))}).withColumn("next", labels.incremented(F.col("p")))
    return rows.select("l_orderkey", "l_linenumber", labels.canonical(F.col("next")).alias("following"), labels.behind(F.col("raw"), F.col("span")).alias("remainder"))


@query("""SELECT o_orderkey, coalesce(CASE WHEN c_mktsegment = 'BUILDING' THEN NULL ELSE c_mktsegment END, o_orderpriority) AS segment, c_nationkey
  FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def metadata_inherit(spark, d):
    registry = tables.parquet(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.when(F.col("c_mktsegment") == "BUILDING", "N/A").otherwise(F.col("c_mktsegment")).alias("segment"), "c_nationkey")
    rows = tables.parquet(spark, d, "orders").select("o_orderkey", "o_custkey", F.col("o_orderpriority").alias("segment"))
    registry = registry.withColumn("c_nationkey", F.col("c_nationkey").cast("string"))
    out = joins.inherited(rows, registry, "o_custkey", ["segment", "c_nationkey"], "segment")
    return out.select("o_orderkey", "segment", F.col("c_nationkey").cast("int").alias("c_nationkey"))


@query("SELECT event_type, count(*) AS calls, round(sum(coalesce(value, 0)), 4) AS value FROM events WHERE event_type <> 'error' GROUP BY 1")
def cost_rollup(spark, d):
    return agg.cost_rollup(tables.parquet(spark, d, "events"), ["event_type"], ["value"], F.col("event_type") != "error")


@query("SELECT event_type, count(*) AS count FROM events GROUP BY 1")
def type_counts(spark, d):
    return agg.counts(tables.parquet(spark, d, "events"), "event_type")


@query("""SELECT event_id, round((p * 0.1::DOUBLE + o * 0.4::DOUBLE) / 1e6, 6) AS usd FROM (SELECT event_id, 10 * CAST(user_id AS BIGINT) AS p, 10 * CAST(floor(abs(value)) AS BIGINT) AS o FROM events)
  WHERE o > 0""")
def token_cost(spark, d):
    e = tables.parquet(spark, d, "events").select("event_id", (10 * F.col("user_id").cast("long")).alias("p"), (10 * F.floor(F.abs("value"))).alias("o")).where("o > 0")
    return e.select("event_id", coerce.token_cost(F.lit("flash-lite"), F.col("p"), F.col("o"), F.lit(0), F.lit(0))["usd"].alias("usd"))


@query("""SELECT conv_id, role, string_agg(text, chr(10) ORDER BY turn) AS merged, CAST(sum(turn) AS BIGINT) AS marks, count(*) AS rows
  FROM conversations GROUP BY ALL""")
def rowspan_merge(spark, d):
    return agg.merged_spans(tables.parquet(spark, d, "conversations"), ["conv_id", "role"], "turn", "text", "turn")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn) AS label FROM conversations""")
def fill_forward(spark, d):
    c = tables.parquet(spark, d, "conversations")
    return windows.filled_forward(c, "conv_id", "turn", F.when(F.col("role") == "user", F.col("text"))).select("conv_id", "turn", "label")


@query("""SELECT conv_id, CAST(segment AS BIGINT) AS segment, string_agg(text, chr(10) ORDER BY turn) AS segment_text, min(turn) AS first FROM
  (SELECT *, sum(CASE WHEN role = 'user' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn) AS segment FROM conversations) WHERE segment > 0 GROUP BY 1, 2""")
def marker_segments(spark, d):
    return windows.segments(tables.parquet(spark, d, "conversations"), "conv_id", "turn", F.col("role") == "user", "text")


@query("""SELECT conv_id, turn, CASE WHEN turn > 0 THEN coalesce(arg_min(CASE WHEN role = 'user' THEN text END, turn) FILTER (role = 'user') OVER (PARTITION BY conv_id), text) ELSE text END AS text FROM conversations""")
def metadata_sync(spark, d):
    return windows.synced(tables.parquet(spark, d, "conversations"), "conv_id", "turn", F.col("role") == "user", "text").select("conv_id", "turn", "text")


@query("""WITH e AS (SELECT user_id, event_id, epoch_us(ts) / 1e6 AS t FROM events), c AS (SELECT *, CASE WHEN t > max(t) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 86400 THEN 1 ELSE 0 END AS cut FROM e),
  s AS (SELECT *, 1 + sum(cut) OVER (PARTITION BY user_id ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS cluster FROM c)
  SELECT user_id, CAST(cluster AS BIGINT) AS cluster, min(t) AS lo, max(t) AS hi, count(*) AS n FROM s GROUP BY 1, 2""")
def interval_cluster(spark, d):
    e = tables.parquet(spark, d, "events").select("user_id", (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("t"))
    return agg.clusters(e.withColumn("t1", F.col("t")), "user_id", "t", "t1", 86400.0)


@query("""SELECT source, doc_id, n_chars, place FROM (SELECT source, d.doc_id, n_chars, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, d.doc_id) AS place
  FROM documents d JOIN labels USING (doc_id)) WHERE place <= 5""")
def topk_pages(spark, d):
    docs = tables.parquet(spark, d, "documents").join(tables.parquet(spark, d, "labels"), "doc_id")
    return sets.top(docs, ["source"], [F.desc("n_chars"), F.col("doc_id")], 5).select("source", "doc_id", "n_chars", "place")


@query("""SELECT doc_id, count(*) AS lines, CAST(count_if(NOT (regexp_matches(l, 'turn over|blank page|copyright|do not write|candidate number', 'i') OR (length(l) >= 8 AND length(regexp_replace(l, '[\\x{20}-\\x{FF}]', '', 'g')) / length(l) > 0.25))) AS BIGINT) AS kept
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l FROM documents) WHERE trim(l, ' ') <> '' GROUP BY 1""")
def line_noise(spark, d):
    rows = tables.lines(tables.parquet(spark, d, "documents").select("doc_id", "text"), ["doc_id"], "text")
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("lines"), F.count_if(~filters.is_noise_line(F.col("line"))).alias("kept"))


@query("SELECT page_id, regexp_matches(html, '\\b(diagram|graph|grid|figure|sketch|drawn|draw|shown|shows|plot|axes|triangle|circle|scale drawing|net|map)\\b', 'i') AS visual FROM pages")
def visual_words(spark, d):
    return tables.parquet(spark, d, "pages").select("page_id", filters.is_visual(F.col("html")).alias("visual"))


@query("""SELECT conv_id, array_to_string(list(role ORDER BY first), ',') AS roles FROM (SELECT conv_id, role, min(turn) AS first FROM conversations GROUP BY 1, 2) GROUP BY 1""")
def ordered_distinct(spark, d):
    return sets.ordered_distinct(tables.parquet(spark, d, "conversations"), "conv_id", "turn", "role").select("conv_id", F.array_join("values", ",").alias("roles"))


@query("SELECT p_partkey, CAST(i - 1 AS INTEGER) AS place, string_split(p_type, ' ')[i] AS word FROM part, range(1, 6) r(i) WHERE i <= len(string_split(p_type, ' '))")
def explode_merge(spark, d):
    return sets.multiplied(tables.parquet(spark, d, "part").select("p_partkey", "p_type"), F.split("p_type", " "), "word").drop("p_type")


@query("""SELECT doc_id, clones, first_clone FROM (SELECT doc_id, s, count(*) OVER w AS clones, min(doc_id) OVER w AS first_clone FROM
  (SELECT doc_id, source, trim(regexp_replace(lower(text), '[ \\t\\n\\r\\f\\v]+', ' ', 'g'), ' ') AS s FROM documents) WINDOW w AS (PARTITION BY source, s)) WHERE clones > 1 AND length(s) >= 8""")
def clone_siblings(spark, d):
    return joins.clones(tables.parquet(spark, d, "documents"), "doc_id", "source", "text").select("doc_id", "clones", "first_clone")


@query("""SELECT vec_id, round(greatest(y0 - 0, 0), 6) AS y0, round(y1, 6) AS y1 FROM (SELECT vec_id, greatest(5.0, a) AS y0, least(95.0, b) AS y1 FROM
  (SELECT vec_id, abs(embedding[1]::DOUBLE) * 40 AS a, abs(embedding[1]::DOUBLE) * 40 + abs(embedding[2]::DOUBLE) * 60 AS b FROM embeddings) WHERE a < b AND b <= 100 AND b - a BETWEEN 2 AND 70) WHERE y1 - y0 >= 2
  AND least(95.0, y1 + 10) - greatest(5.0, y0 - 10) <= 85""")
def region_clamp(spark, d):
    e = tables.parquet(spark, d, "embeddings").select("vec_id", F.lit(2).alias("page_num"), (F.abs(F.col("embedding")[0].cast("double")) * 40).alias("y0"), F.abs(F.col("embedding")[1].cast("double")).alias("h"))
    e = e.withColumn("y1", F.col("y0") + F.col("h") * 60)
    return filters.valid_regions(e).select("vec_id", F.round(F.greatest("y0", F.lit(5.0)), 6).alias("y0"), F.round(F.least("y1", F.lit(95.0)), 6).alias("y1"))


@query("""SELECT o_orderkey, round(least(100, v / CASE WHEN v > 100 AND v <= 1000 THEN 10 WHEN v > 1000 AND v <= 3000 THEN v / 100 ELSE 1 END), 6) AS pct FROM (SELECT o_orderkey, o_totalprice / 100 AS v FROM orders)""")
def percent_rescale(spark, d):
    v = F.col("o_totalprice") / 100
    return tables.parquet(spark, d, "orders").select("o_orderkey", F.round(filters.rescaled_percent([v, v])[0], 6).alias("pct"))


@query("""SELECT l_orderkey, CAST(e AS INTEGER) AS expected, found_before, found_after FROM (SELECT l_orderkey, l_linenumber AS found_before, lead(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber) AS found_after
  FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)), range(1, 8) r(e) WHERE e > found_before AND e < found_after""")
def gap_objects(spark, d):
    return validate.gap_objects(tables.parquet(spark, d, "lineitem"), "l_orderkey", "l_linenumber")


@query("""SELECT l, r, round(abs(l - r) / greatest(1, l, r), 4) AS off, CASE WHEN abs(l - r) / greatest(1, l, r) > 0.1 THEN 'block' ELSE 'ok' END AS decision
  FROM (SELECT (SELECT count(DISTINCT o_orderkey) FROM orders) AS l, (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS r)""".replace("SELECT l, r,", "SELECT l AS left_ids, r AS right_ids,"))
def count_parity(spark, d):
    return validate.count_parity(tables.parquet(spark, d, "orders").select(F.col("o_orderkey").alias("k")), tables.parquet(spark, d, "lineitem").select(F.col("l_orderkey").alias("k")), "k")


@query("""SELECT source, CASE max(CASE WHEN n_chars < 100 THEN 2 WHEN n_chars < 300 THEN 1 ELSE 0 END) WHEN 2 THEN 'block' WHEN 1 THEN 'review' ELSE 'ok' END AS decision FROM documents GROUP BY 1""")
def decision_precedence(spark, d):
    rows = tables.parquet(spark, d, "documents").withColumn("result", F.when(F.col("n_chars") < 100, "block").when(F.col("n_chars") < 300, "review").otherwise("ok"))
    return validate.decision(rows, "source", "result")


@query("""SELECT o_orderkey, o_orderstatus, CAST(l AS BIGINT) AS rows FROM (SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM orders EXCEPT SELECT l_orderkey FROM lineitem WHERE l_linenumber = 2)), (SELECT 1 AS l)""")
def expected_missing(spark, d):
    o = tables.parquet(spark, d, "orders")
    gone = sets.difference(o.select("o_orderkey"), tables.parquet(spark, d, "lineitem").where("l_linenumber = 2").select(F.col("l_orderkey").alias("o_orderkey")))
    return o.join(gone, "o_orderkey", "left_semi").select("o_orderkey", "o_orderstatus", F.lit(1).cast("long").alias("rows"))


@query("""SELECT o_custkey, o_orderkey, CAST(floor((row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) / 10) AS BIGINT) AS batch FROM orders""")
def fixed_batches(spark, d):
    return sets.batches(tables.parquet(spark, d, "orders"), "o_custkey", ["o_orderkey"], 10).select("o_custkey", "o_orderkey", "batch")


@query("""SELECT page_id, lower(regexp_replace(regexp_replace(url, '^https?://', ''), '[/:?#].*$', '')) AS host, sha256(html) AS cache_key FROM pages""")
def cache_keys(spark, d):
    host = F.lower(F.regexp_replace(F.regexp_replace("url", "^https?://", ""), "[/:?#].*$", ""))
    return tables.parquet(spark, d, "pages").select("page_id", host.alias("host"), tables.cache_key(F.col("html")).alias("cache_key"))


@query("SELECT 'customer' AS name, count(*) AS rows FROM customer UNION ALL SELECT 'nation', count(*) FROM nation UNION ALL SELECT 'orders', count(*) FROM orders UNION ALL SELECT 'region', count(*) FROM region")
def table_catalog(spark, d):
    return tables.catalog(spark, d, ["customer", "nation", "orders", "region"])


@query("""SELECT conv_id, turn, lag(turn, 1) OVER w AS before_1, lag(turn, 2) OVER w AS before_2, lead(turn, 1) OVER w AS after_1, lead(turn, 2) OVER w AS after_2 FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def sibling_neighbours(spark, d):
    return joins.neighbours(tables.parquet(spark, d, "conversations"), "conv_id", "turn", "turn").drop("role", "text")


@query("""SELECT l_orderkey, root_before, l_linenumber FROM (SELECT l_orderkey, l_linenumber, lag(l_linenumber) OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_partkey, l_suppkey, l_linenumber) AS root_before FROM lineitem) WHERE l_linenumber < root_before""")
def backward_roots(spark, d):
    rows = tables.parquet(spark, d, "lineitem").withColumn("order", F.struct("l_shipdate", "l_partkey", "l_suppkey", "l_linenumber"))
    return windows.backward(rows, "l_orderkey", "order", "l_linenumber").select("l_orderkey", "root_before", "l_linenumber")


@query("""SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS coerced_text, CASE WHEN o_orderstatus IN ('F') THEN true ELSE false END AS flag, CAST(o_orderkey AS INTEGER) AS number FROM orders""")
def coercions(spark, d):
    o = tables.parquet(spark, d, "orders")
    flag = F.when(F.col("o_orderstatus") == "F", " Yes ").otherwise("no")
    return o.select("o_orderkey", F.element_at(coerce.to_list(F.col("o_custkey")), 1).alias("coerced_text"), coerce.to_bool(flag).alias("flag"), coerce.to_int(F.concat(F.lit(" "), F.col("o_orderkey").cast("string"), F.lit(" "))).alias("number"))


@query("""SELECT o_orderkey, concat('igcse_', lpad(CAST(o_custkey % 10000 AS VARCHAR), 4, '0'), '_', l, lpad(CAST(year(o_orderdate) % 100 AS VARCHAR), 2, '0'), '_', CAST(o_orderkey % 4 + 1 AS VARCHAR), '2') AS unified,
  CAST(2000 + year(o_orderdate) % 100 AS INTEGER) AS year, l AS session FROM (SELECT *, ['s', 'w', 'm'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS l FROM orders)""")
def paper_keys(spark, d):
    two = F.lpad((F.year("o_orderdate") % 100).cast("string"), 2, "0")
    letter = F.element_at(F.array(*map(F.lit, "swm")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    name = F.concat(F.lpad((F.col("o_custkey") % 10000).cast("string"), 4, "0"), F.lit("_"), letter, two, F.lit("_QP_"), (F.col("o_orderkey") % 4 + 1).cast("string"), F.lit("(Extended)2 (1).pdf"))
    rows = tables.parquet(spark, d, "orders").select("o_orderkey", keys.paper_key(name).alias("key"))
    parts = keys.key_parts(F.col("key"))
    return rows.select("o_orderkey", keys.unified_key(F.col("key")).alias("unified"), parts["year"].alias("year"), parts["session"].alias("session"))


@query("""SELECT l_orderkey, chr(97) AS x, string_agg(l_linenumber, ',' ORDER BY l_linenumber) AS children FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) GROUP BY 1""")
def children_by_parent(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", _label().alias("label")).distinct()
    rows, p = rows.withColumn("p", labels.parts(F.col("label"))), F.col("p")
    ids = rows.select(labels.canonical(p).alias("id"), F.col("l_linenumber").alias("pos"), labels.prefixes(p).alias("prefixes"))
    out = agg.children(ids, F.col("prefixes"), "id", "pos")
    number = F.transform("children", lambda c: (F.ascii(F.substring_index(c, ".", -1)) - 96).cast("string"))
    return out.select(F.col("ancestor").cast("long").alias("l_orderkey"), F.lit("a").alias("x"), F.array_join(number, ",").alias("children"))


@query()
def fuzzy_match(spark, d):
    """Of each user's turn the answer of its conversation that is most like it; the tests hold it against all pairs."""
    c = tables.parquet(spark, d, "conversations")
    left = c.where("role = 'user'").select("conv_id", F.col("turn").alias("l_id"), F.col("text").alias("l_text"))
    right = c.where("role <> 'user'").select("conv_id", F.col("turn").alias("r_id"), F.col("text").alias("r_text"))
    return joins.fuzzy_best(left, right, "conv_id", 0.3).select("conv_id", "l_id", "r_id", F.round("ratio", 6).alias("ratio"))


@query()
def duplicate_guard(spark, d):
    rows = tables.parquet(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", labels.canonical(labels.parts(_label())).alias("label"))
    return sequence.ordered_pass(rows, "l_orderkey", ["l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"], "label", sequence.DuplicateGuard)


@query("""WITH RECURSIVE s AS (SELECT o_custkey, o_orderkey, CAST(floor(o_totalprice / 50) AS BIGINT) AS n, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS k FROM orders),
  b AS (SELECT o_custkey, o_orderkey, n, k, 0::BIGINT AS bin, n AS total, 1 AS held FROM s WHERE k = 1 UNION ALL
  SELECT s.o_custkey, s.o_orderkey, s.n, s.k, CASE WHEN b.total + s.n > 7500 OR b.held >= 8 THEN b.bin + 1 ELSE b.bin END, CASE WHEN b.total + s.n > 7500 OR b.held >= 8 THEN s.n ELSE b.total + s.n END,
  CASE WHEN b.total + s.n > 7500 OR b.held >= 8 THEN 1 ELSE b.held + 1 END FROM b JOIN s ON s.o_custkey = b.o_custkey AND s.k = b.k + 1) SELECT o_custkey, o_orderkey, bin FROM b""")
def batch_pack(spark, d):
    rows = tables.parquet(spark, d, "orders").select("o_custkey", "o_orderkey", F.floor(F.col("o_totalprice") / 50).cast("long").alias("n"))
    return sequence.packed(rows, "o_custkey", ["o_orderkey"], "n", 7500, 8).select("o_custkey", "o_orderkey", "bin")


@query("""SELECT conv_id, to_json({'questions': list({'turn': CAST(turn AS VARCHAR), 'role': coalesce(role, 'N/A')} ORDER BY turn)}) AS document FROM conversations GROUP BY 1""")
def nested_output(spark, d):
    turns = tables.parquet(spark, d, "conversations").select("conv_id", "turn", "role").withColumn("seq", F.col("turn"))
    return tables.nested(turns, "conv_id", "seq", ["turn", "role"])


@query("""SELECT event_id, CAST(len(regexp_extract_all(props, '[0-9]+')) AS INTEGER) AS numbers, CASE WHEN value <= 1 THEN 'LOW' WHEN value = 2 THEN 'MEDIUM' WHEN value IS NULL THEN 'MEDIUM' ELSE 'HIGH' END AS demand FROM events""")
def demand_from_marks(spark, d):
    return tables.parquet(spark, d, "events").select("event_id", F.size(F.regexp_extract_all("props", F.lit("([0-9]+)"), F.lit(1))).alias("numbers"), text.demand(F.col("value")).alias("demand"))


@query("""SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event_type, count(*) AS calls, round(sum(value), 4) AS cost FROM events GROUP BY 1, 2""")
def ledger_hours(spark, d):
    """The batch form of the streaming rollup."""
    return ledger.rollup(tables.parquet(spark, d, "events"), "ts", "event_type", "value")
