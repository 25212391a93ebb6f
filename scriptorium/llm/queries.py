"""Queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import byte_bpe, byte_repeats, chat_roles, crf_toxicity, exact_dedup, filter_audit, mixing, near_dedup, pu_quality, sentence_pieces, source_divergence, spot_signatures, word_windows
from .shared import table


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


def op1_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.decisions(table(spark, sf_dir, "documents"))


def op2_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return crf_toxicity.predictions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_byte_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_repeats.digests(table(spark, sf_dir, "documents"))


def op5_chat_roles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat_roles.formatted(table(spark, sf_dir, "conversations"))


def op6_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spot_signatures.fingerprints(table(spark, sf_dir, "documents"))


def op7_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_windows.digests(table(spark, sf_dir, "documents"))


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op11_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return sentence_pieces.digests(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_near_dedup, op2_pu_quality, op3_byte_repeats, op4_crf_toxicity, op5_chat_roles, op6_spot_signatures, op7_word_windows, op8_byte_bpe, op9_exact_dedup, op10_mixing, op11_sentence_pieces, op12_source_divergence, op13_filter_audit)}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_near_dedup": r"""
            WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
            s AS (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
            c AS (SELECT doc_id, md5(g) AS g, count(*) AS n FROM s GROUP BY 1, 2),
            t AS (SELECT d.doc_id, coalesce(sum(n), 0) AS m FROM d LEFT JOIN c USING (doc_id) GROUP BY 1),
            p AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.n, b.n)) AS o FROM c a JOIN c b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
            e AS (SELECT a, b FROM p JOIN t x ON x.doc_id = a JOIN t y ON y.doc_id = b WHERE o >= CAST(0.8 AS DOUBLE) * (x.m + y.m - o) - 1e-9
                  UNION ALL SELECT x.doc_id, y.doc_id FROM t x JOIN t y ON x.m = 0 AND y.m = 0 AND x.doc_id < y.doc_id),
            f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
            r AS (SELECT doc_id AS n, doc_id AS r FROM d UNION SELECT f.b, r.r FROM r JOIN f ON f.a = r.n),
            k AS (SELECT n AS doc_id, min(r) AS class_id, count(*) AS class_size FROM r GROUP BY 1)
            SELECT doc_id, class_id, class_size, doc_id = class_id AS kept FROM k""",
        "op3_byte_repeats": """
            WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
            s AS (SELECT doc_id, i, md5(substring(h, 2 * i - 1, 200)) AS k
                  FROM (SELECT doc_id, h, unnest(range(1, length(h) // 2 - 98)) AS i FROM d)),
            r AS (SELECT doc_id, i FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS n FROM s) WHERE n > 1),
            b AS (SELECT doc_id, h, unnest(range(1, length(h) // 2 + 1)) AS j FROM d),
            g AS (SELECT b.doc_id, j, substring(h, 2 * j - 1, 2) AS x,
                         max(r.i) OVER (PARTITION BY b.doc_id ORDER BY j ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
                  FROM b LEFT JOIN r ON r.doc_id = b.doc_id AND r.i = b.j),
            e AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY j), false) AS head FROM g),
            a AS (SELECT doc_id, count(*) AS n, CAST(count_if(gone) AS BIGINT) AS m, CAST(count_if(head) AS BIGINT) AS p,
                         sha256(unhex(coalesce(string_agg(x, '' ORDER BY j) FILTER (NOT gone), ''))) AS sha FROM e GROUP BY doc_id)
            SELECT doc_id, coalesce(n, 0) AS n_bytes, coalesce(m, 0) AS n_removed, coalesce(p, 0) AS n_spans, coalesce(sha, sha256('')) AS kept_sha256
            FROM d LEFT JOIN a USING (doc_id)""",
        "op7_word_windows": r"""
            WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
            s AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
                  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
            r AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY k) AS m FROM s) WHERE doc_id > m),
            b AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS x FROM d),
            g AS (SELECT b.doc_id, j, x, max(r.i) OVER (PARTITION BY b.doc_id ORDER BY j ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
                  FROM b LEFT JOIN r ON r.doc_id = b.doc_id AND r.i = b.j),
            a AS (SELECT doc_id, count(*) AS n, CAST(count_if(gone) AS BIGINT) AS m,
                         sha256(coalesce(string_agg(x, ' ' ORDER BY j) FILTER (NOT gone), '')) AS sha FROM g GROUP BY doc_id)
            SELECT doc_id, coalesce(n, 0) AS n_words, coalesce(m, 0) AS n_removed, coalesce(sha, sha256('')) AS kept_sha256
            FROM d LEFT JOIN a USING (doc_id)""",
        "op9_exact_dedup": """
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
                   doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
            FROM d WINDOW g AS (PARTITION BY t)""",
        "op12_source_divergence": r"""
            WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
            g AS (SELECT DISTINCT lang, source FROM d),
            o AS (SELECT lang, source, i, unnest(w) AS term FROM d),
            k AS (SELECT lang, term, count(*) AS n_lang FROM o GROUP BY 1, 2 HAVING count(DISTINCT i) >= 10),
            c AS (SELECT lang, source, term, count(*) AS n FROM o GROUP BY 1, 2, 3),
            l AS (SELECT lang, count(*) AS v, sum(n_lang) AS total FROM k GROUP BY 1),
            e AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, n_lang FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
            s AS (SELECT lang, source, sum(n) AS total FROM e GROUP BY 1, 2),
            x AS (SELECT e.lang, e.source, term, n, CAST(1 + 1000000000 * (n + 2) // (s.total + 2 * v) AS HUGEINT) AS p,
                         CAST(1 + 1000000000 * (n_lang + 2) // (l.total + 2 * v) AS HUGEINT) AS q
                  FROM e JOIN s USING (lang, source) JOIN l ON l.lang = e.lang),
            f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
                  FROM x a JOIN x b ON a.lang = b.lang AND a.term = b.term AND a.source != b.source GROUP BY 1, 2, 3),
            r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
                  FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
                  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM x WHERE n > 0 AND p > q),
            z AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
            SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM z WHERE part = 'pair' OR rank <= 10""",
        "op13_filter_audit": r"""
            WITH d AS (SELECT doc_id, coalesce(text, '') AS t, coalesce(lang, '') AS part, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
            m AS (SELECT doc_id, part, concat(
                         CASE WHEN len(w) < 200 THEN 'A' END, CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' END,
                         CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 'C' END, CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' END,
                         CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' END) AS f FROM d),
            y AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY 1),
            c AS (SELECT part, f, count(*) AS n, count_if(coalesce(good, false)) AS good, count_if(coalesce(toxic, false)) AS toxic FROM m LEFT JOIN y USING (doc_id) GROUP BY 1, 2),
            l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
            o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a JOIN l b ON a.x != b.x JOIN l c ON c.x NOT IN (a.x, b.x)
                  JOIN l d ON d.x NOT IN (a.x, b.x, c.x) JOIN l e ON e.x NOT IN (a.x, b.x, c.x, d.x)),
            s AS (SELECT filter_order, step, filter_order[step] AS own, list_transform(range(1, step), lambda i: filter_order[i]) AS gone FROM o, range(1, 6) r(step)),
            h AS (SELECT part, filter_order, step, own, f, n, good, toxic, contains(f, own) AS fails, list_has_any(gone, string_split(f, '')) AS gone FROM c, s),
            r AS (SELECT part, filter_order, step, own, sum(CASE WHEN NOT gone AND NOT fails THEN n ELSE 0 END) AS kept, sum(CASE WHEN NOT gone AND fails THEN n ELSE 0 END) AS removed,
                         sum(CASE WHEN gone AND fails THEN n ELSE 0 END) AS redundant, sum(CASE WHEN f = own THEN n ELSE 0 END) AS unique_fails,
                         sum(CASE WHEN NOT gone AND fails THEN good ELSE 0 END) AS good_lost, sum(CASE WHEN NOT gone AND fails THEN toxic ELSE 0 END) AS toxic_lost
                  FROM h GROUP BY 1, 2, 3, 4)
            SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
                   CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
                   CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley FROM r""",
    }
