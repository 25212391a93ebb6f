from pyspark.sql import functions as F

from scriptorium.functions import coerce, keys, labels, text


def _each(spark, values, make, kind="string"):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(make(F.col("v"))).collect()]


def test_labels(spark):
    raw = ["10 (a) f(x) = 2x - 3", "8 A solid cuboid", "9(d) (ii)", "4(a)(i)", "1(a)(iv)(a)", "4 a i", "7(b) (x) find", "(iii) z", "", None]
    assert _each(spark, raw, lambda v: labels.canonical(labels.parts(v))) == ["10.a", "8", "9.d.ii", "4.a.i", "1.a.iv.a", "4", "7.b", "iii", "UNKNOWN", "UNKNOWN"]
    assert _each(spark, raw[:2], labels.remainder) == ["f(x) = 2x - 3", "A solid cuboid"]
    assert _each(spark, ["4(a)(i)", "4 a i"], labels.squashed) == ["4ai", "4"]
    assert _each(spark, raw[:4], lambda v: labels.shown(labels.parts(v))) == ["10(a)", "8", "9(d)(ii)", "4(a)(i)"]
    assert _each(spark, ["(iii) z", "9(d)(ii)"], lambda v: labels.metadata(labels.parts(v))["is_orphaned"]) == [True, False]
    assert _each(spark, ["4(a)(i)", "4(a)", "4", "4(z)", "4(v)"], lambda v: labels.canonical(labels.incremented(labels.parts(v)))) == ["4.a.ii", "4.b", None, None, "4.vi"]


def test_orphans(spark):
    found = spark.range(1).select(
        labels.canonical(labels.orphan_candidate(labels.orphan_tokens(F.lit("(a) (i) Find an expression")), F.array(F.lit("9")))),
        labels.canonical(labels.orphan_candidate(labels.orphan_tokens(F.lit("(ii) Find the number")), F.array(F.lit("9"), F.lit("c"), F.lit("i")))),
    ).first()
    assert tuple(found) == ("9.a.i", "9.c.ii")


def test_keys(spark):
    cases = {"Maximum Mark 130": None, "May/June Maximum Mark 130": "s", "March 2024 examination": "m", "February/March session": "m", "Summer examination": None, "feb mar session": None, "Winter examination period": None}
    assert _each(spark, list(cases), keys.session_of_text) == list(cases.values())
    codes = {"2225-7106M": "2225-7106", "7106/1_HL_May_2025": "7106", "2225-7106": "2225-7106", "7106M": "7106", "7106/1": "7106"}
    assert _each(spark, list(codes), keys.reference_code) == list(codes.values())
    assert _each(spark, ["0580_s18_qp_22.pdf", "0580_s18_ms_22 (1).pdf", "x"], keys.paper_key) == ["igcse_0580_s18_qp_22", "igcse_0580_s18_ms_22", None]
    assert _each(spark, ["igcse_0580_s18_qp_22", "x_qpaper_1"], keys.unified_key) == ["igcse_0580_s18_22", "x_qpaper_1"]
    assert _each(spark, ["igcse_0580_s18_qp_22", "igcse_0580_s18_qp_13"], keys.tier_of_key) == ["Extended", "Core"]


def test_coercion(spark):
    assert _each(spark, ["12.5", " 12 ", "x", None], coerce.to_int) == [0, 12, 0, 0]
    assert _each(spark, ["true", "1", "Yes", "no", None], coerce.to_bool) == [True, True, True, False, False]
    assert _each(spark, ["", "N/A", "null", "a", None], coerce.nullif_blank) == [None, None, None, "a", None]
    assert _each(spark, ["unknown", "N/A", "?", "unknown_2", "4.a"], coerce.is_placeholder) == [True, True, True, True, False]
    assert _each(spark, ['[{"a": 1}]', '```json\n[{"a": 2}]\n```', "nothing"], lambda v: coerce.parsed_json(v, "array<struct<a int>>")[0]["a"]) == [1, 2, None]
    assert _each(spark, [[["http://a", None, "x"], [""], ["https://b"]]], coerce.clean_urls, "array<array<string>>") == [["http://a", "https://b"]]


def test_text(spark):
    assert _each(spark, ["2\nM1", "M1 A1\nB2", "oe"], lambda v: text.inferred_marks(v, F.lit(""))) == [2, 4, 0]
    assert _each(spark, ["intro\n1. one\n2) two", "none"], text.numbered_blocks) == [["1. one\n", "2) two"], ["none"]]
    rows = spark.createDataFrame([("Find the  Value", "find the value"), ("", "x"), (None, None)], "a string, b string")
    assert [round(r[0], 3) for r in rows.select(text.similarity("a", "b")).collect()] == [1.0, 0.0, 0.0]
    assert _each(spark, [0, 1, 2, 3, None], text.demand, "int") == ["LOW", "LOW", "MEDIUM", "HIGH", "MEDIUM"]
    assert _each(spark, ["(a b)\n(c d)", "plain"], text.matrix_stack) == ["\\begin{pmatrix}a b\\\\c d\\end{pmatrix}", "plain"]


def test_may_be_is_no_month(spark):
    cases = {"m18 marks may be awarded for 2024": None, "2023 marks may not be given": None, "May 2024": "s", "2024 in May": "s", "May be 2024 or June 2023": "s"}
    assert _each(spark, list(cases), keys.session_of_text) == list(cases.values())


def test_numbers_that_are_no_years(spark):
    cases = {"other 2022": "ib_math_hl_s24_qp", "other 12022": "ib_math_hl_s24_qp", "math 12022": "ib_math_hl_s24_qp", "math 2022": "ib_math_hl_s22_qp", "x_SL_2019.pdf": "ib_math_sl_s19_qp", "may2023": "ib_math_hl_s23_qp"}
    assert _each(spark, list(cases), keys.course_key) == list(cases.values())


def test_what_follows_is_named_once(spark):
    following = {"a": "b", "h": "i", "i": "ii", "v": "vi", "x": "xi", "y": "z", "z": None, "xix": "xx", "xx": None, "7": "8", "iii": "iv", "w": "x", "u": "v"}
    found = spark.createDataFrame([(k, ["4", k]) for k in following], "k string, p array<string>").select("k", F.array_join(labels.incremented(F.col("p")), "."))
    assert dict(tuple(r) for r in found.collect()) == {k: v and f"4.{v}" for k, v in following.items()}
    assert str(labels.incremented(F.col("p"))).lower().count("try_cast") <= 1 and str(labels.incremented(F.col("p"))).lower().count("rlike") == 1
