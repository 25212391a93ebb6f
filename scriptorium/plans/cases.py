"""Queries that apply functions and ordered passes to worked cases, each for every customer.

A case's strings hold {k}, which stands for the customer's key, so that results depend on rows.  The SQL side knows cases by
number and has what each must give."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import coerce, keys, labels, text
from ..operators import filters, joins, reconcile, sequence, skeleton
from ..sources import tables
from .registry import QUERIES, SQL

Cell = str | None


def _sql(value: Cell) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _values(rows: list[tuple], names: list[str]) -> str:
    """A relation of strings, the first column a number."""
    return "(VALUES " + ", ".join("(" + ", ".join([str(r[0]), *map(_sql, r[1:])]) + ")" for r in rows) + f") x({', '.join(names)})"


def _customers(spark: SparkSession, d: str, n: int) -> DataFrame:
    return tables.parquet(spark, d, "customer").select(F.col("c_custkey").cast("long").alias("k")).withColumn("case_no", (F.col("k") % n).cast("int"))


def _filled(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: F.replace(c, F.lit("{k}"), F.col("k").cast("string")) for c in columns})


def scalar(name: str, inputs: dict[tuple[Cell, ...], tuple[Cell, ...]], out: list[str], make: Callable[..., list[Column]], first: Callable[[Column], Column] | None = None) -> None:
    """Each input (a, b, ..) with what make(a, b, ..) must give, as strings; make gets first(a) in place of a."""
    width = len(next(iter(inputs)))
    given = [chr(97 + i) for i in range(width)]

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = spark.createDataFrame([(i, *x) for i, x in enumerate(inputs)], "case_no int, " + ", ".join(f"{c} string" for c in given))
        rows = _filled(_customers(spark, d, len(inputs)).join(F.broadcast(rows), "case_no"), given)  # a row for each case
        if first:
            rows = rows.withColumn("a", first(F.col("a")))
        found = make(*map(F.col, given))
        return rows.select("k", *[c.cast("string").alias(o) for o, c in zip(out, found, strict=True)])

    QUERIES[name] = run
    expected = [(i, *want) for i, want in enumerate(inputs.values())]
    SQL[name] = f"SELECT c_custkey AS k, {', '.join(f'replace(x.{o}, chr(123) || chr(107) || chr(125), CAST(c_custkey AS VARCHAR)) AS {o}' for o in out)} FROM customer JOIN {_values(expected, ['case_no', *out])} ON c_custkey % {len(inputs)} = x.case_no"


def papers(name: str, cases: list[tuple[list[tuple[Cell, ...]], list[tuple[Cell, ...]]]], given: list[str], out: list[str], make: Callable[[DataFrame], DataFrame]) -> None:
    """Each case is a paper: its rows in order, and the rows that make(rows with paper, seq) must give, as strings."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        rows = [(i, s, *r) for i, (have, _) in enumerate(cases) for s, r in enumerate(have)]
        rows = spark.createDataFrame(rows, "case_no int, seq long, " + ", ".join(f"{c} string" for c in given))
        # some rows for each case; customers are few files, so they are dealt to tasks before
        rows = _filled(_customers(spark, d, len(cases)).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "k").join(F.broadcast(rows), "case_no"), given)
        return make(rows.withColumnRenamed("k", "paper")).select(F.col("paper").alias("k"), *[F.col(c).cast("string").alias(c) for c in out])

    QUERIES[name] = run
    expected = [(i, *r) for i, (_, want) in enumerate(cases) for r in want]
    SQL[name] = f"SELECT c_custkey AS k, {', '.join(f'replace(x.{o}, chr(123) || chr(107) || chr(125), CAST(c_custkey AS VARCHAR)) AS {o}' for o in out)} FROM customer JOIN {_values(expected, ['case_no', *out])} ON c_custkey % {len(cases)} = x.case_no"


def _joined(c: Column) -> Column:
    return F.array_join(c, "|", "-")


# --- labels -------------------------------------------------------------------------------------------------------------
_P = lambda c: labels.parts(c)

scalar(
    "label_metadata",
    {
        ("{k}(a)(ii) Find x",): ("{k}", "a|ii", "3", "false", "{k}.a", "a:false:true,ii:true:false"),
        ("{k} Solve it",): ("{k}", "", "1", "false", "{k}", ""),
        ("(iii) z{k}",): (None, "iii", "2", "true", "iii", "iii:true:false"),
        ("q {k} (b)",): ("{k}", "b", "2", "false", "{k}", "b:false:true"),
        ("nothing {k}",): (None, "", "1", "true", "", ""),
    },
    ["parent", "subparts", "depth", "orphan", "above", "kinds"],
    lambda p: [
        labels.metadata(p)["parent"],
        _joined(labels.metadata(p)["subparts"]),
        labels.metadata(p)["depth"],
        labels.metadata(p)["is_orphaned"],
        labels.immediate_parent(p),
        F.array_join(F.transform(labels.metadata(p)["subparts"], lambda x: F.concat_ws(":", x, labels.is_roman(x).cast("string"), labels.is_letter(x).cast("string"))), ","),
    ],
    first=labels.parts,
)

scalar(
    "label_rewrite",
    {
        ("{k}(a) Find the area", "{k}(b)"): ("{k}(b) Find the area", "{k}(a) Find the area", "true"),
        ("{k}(c)", "{k}(d)"): ("{k}(d)", "{k}(c)", "true"),
        ("Find x{k}", "{k}(a)"): ("{k}(a) Find x{k}", "{k}(a) Find x{k}", "false"),
        ("{k} ( a ) ( ii ) Show", "{k}(a)(iii)"): ("{k}(a)(iii) Show", "{k} ( a ) ( ii ) Show", "true"),
    },
    ["relabelled", "ensured", "found"],
    lambda a, b: [labels.with_leading_label(a, b), labels.ensure_label(a, F.when(F.size(_P(a)) > 0, _P(a)).otherwise(_P(b))), F.regexp_like(a, labels.label_pattern(F.when(F.size(_P(a)) > 0, _P(a)).otherwise(_P(b))))],
)

scalar(
    "orphan_labels",
    {
        ("(a) (i) Find {k}", "{k}"): ("a|i", "{k}.a.i"),
        ("(ii) Find {k}", "{k}.c.i"): ("ii", "{k}.c.ii"),
        ("(b) Draw {k}", "{k}.a.ii"): ("b", "{k}.b"),
        ("Find {k}", "{k}.a"): ("", "{k}.a"),
        ("(iii) Work out", "{k}.b"): ("iii", "{k}.b.iii"),
    },
    ["tokens", "candidate"],
    lambda a, b: [_joined(labels.orphan_tokens(a)), F.array_join(labels.orphan_candidate(labels.orphan_tokens(a), F.split(b, r"\.")), ".")],
)

scalar(
    "natural_order",
    {("{k}.a",): ("2:{k},1:1",), ("{k}.ii",): ("2:{k},0:2",), ("{k}.x",): ("2:{k},0:10",), ("{k}.b.iv",): ("2:{k},1:2,0:4",), ("{k}.12",): ("2:{k},2:12",)},
    ["ranks"],
    lambda a: [F.array_join(F.transform(labels.natural_key(F.split(a, r"\.")), lambda x: F.concat_ws(":", x["kind"], x["rank"])), ",")],
)

# --- keys ---------------------------------------------------------------------------------------------------------------
scalar(
    "file_stems",
    {
        ("0580_s18_ms_4 (Extended)2 (1).PDF",): ("0580_s18_ms_42.pdf", "igcse_0580_s18_ms_42", "igcse_0580_s18_42", "Extended"),
        ("0580_w2{k} x",): ("0580_w2{k}x", None, None, None),
        ("0580_s18_qp_4 (Higher)2.pdf",): ("0580_s18_qp_42.pdf", "igcse_0580_s18_qp_42", "igcse_0580_s18_42", "Extended"),
        ("0580_m19_QP_1(foundation)3.pdf",): ("0580_m19_qp_13.pdf", "igcse_0580_m19_qp_13", "igcse_0580_m19_13", "Core"),
        ("0607 _ w21 _ er _ 2 (core)",): ("0607_w21_er_2", "igcse_0607_w21_er_2", "igcse_0607_w21_2", None),
        (None,): ("", None, None, None),
    },
    ["stem", "paper", "unified", "tier"],
    lambda a: [keys.file_stem(a), keys.paper_key(a), keys.unified_key(keys.paper_key(a)), keys.tier_of_key(keys.paper_key(a))],
)

scalar(
    "sessions",
    {
        ("Maximum Mark 130 of {k}", "0580_s18_qp_22.pdf"): (None, "s", "igcse_0580_s18_qp_22"),
        ("May/June {k}", "0580_w18_qp_22.pdf"): ("s", "s", "igcse_0580_s18_qp_22"),
        ("July 2023", "x{k}"): ("s", "s", None),
        ("Summer 2024 examination", "x{k}"): ("s", "s", None),
        ("Winter 2021", "0580_s18_ms_4.pdf"): ("w", "w", "igcse_0580_w18_ms_4"),
        (" M ", "0580_s18_ms_4.pdf"): ("m", "m", "igcse_0580_m18_ms_4"),
        ("m18 marks may be awarded for {k}", "0580_s18_ms_4.pdf"): (None, "s", "igcse_0580_s18_ms_4"),
        ("2024 paper of November", "x"): ("w", "w", None),
        ("November and much more than that before 2024", "x"): (None, "N/A", None),
        ("February / March session {k}", "x"): ("m", "m", None),
        (None, "0607_w19_qp_1.pdf"): (None, "w", "igcse_0607_w19_qp_1"),
    },
    ["of_text", "normalised", "paper"],
    lambda a, b: [keys.session_of_text(a), keys.normalised_session(F.lit(None).cast("string"), a, b, keys.paper_key(b)), keys.paper_key(b, keys.session_of_text(a))],
)

scalar(
    "course_keys",
    {
        ("Mathematics_analysis_and_approaches_paper_1__TZ2_HL 2023.pdf",): ("ib_aa_hl_s23_qp_p1_tz2",),
        ("mathematics applications-and-interpretation paper 2 SL nov 2022 markscheme.pdf",): ("ib_ai_sl_w22_ms_p2",),
        ("other {k}",): ("ib_math_hl_s24_qp",),
        ("Math standard paper_3 2021",): ("ib_math_sl_s21_qp_p3",),
    },
    ["course"],
    lambda a: [keys.course_key(a)],
)

scalar(
    "reference_codes",
    {
        ("2225–7106M", "page {k}"): ("2225-7106", None),
        ("7106/1_HL_{k}", "2225-7106 2224-7105M"): ("7106", "2224-7105M"),
        (" 2225-7106 ", "x 8822-7206 y"): ("2225-7106", "8822-7206"),
        (None, None): ("", None),
    },
    ["code", "found"],
    lambda a, b: [keys.reference_code(a), keys.code_in(F.lit(""), b)],
)

scalar(
    "key_consistency",
    {
        ("igcse_0580_s18_qp_22", "0580", "2018", "s"): ("", "0580|s|2018|2"),
        ("igcse_0580_s18_qp_22", "0607", "2019", "s"): ("subject|year", "0580|s|2018|2"),
        ("igcse_0607_w21_43", "N/A", None, "m"): ("session", "0607|w|2021|4"),
        ("other_{k}", "0580", "2018", "s"): ("", "-|-|-|-"),
    },
    ["differs", "parts"],
    lambda a, b, c, d: [_joined(keys.inconsistencies(a, b, c.try_cast("int"), d)), _joined(F.array(*[keys.key_parts(a)[f].cast("string") for f in ("subject", "session", "year", "paper")]))],
)

# --- texts --------------------------------------------------------------------------------------------------------------
scalar(
    "text_cleanup",
    {
        ("Find x ...... for {k}\nTurn over\nNow y",): ("Find x for {k}\nNow y", "find x ...... for {k} turn over now y"),
        ("A  B\t{k}____C\n\n\n7\nEnd",): ("A B {k} C\nEnd", "a b {k}____c 7 end"),
        ("page 3 of 12\nReal {k}",): ("Real {k}", "page 3 of 12 real {k}"),
        ("  plain {k} ",): ("plain {k}", "plain {k}"),
    },
    ["cleaned", "squeezed"],
    lambda a: [text.clean(a), text.squeezed(a)],
)

scalar(
    "text_slices",
    {
        ("Stem (a) find {k} (b) draw it", r"\(a\)", r"\([b-z]\)"): ("find {k}",),
        ("Stem (a) find (b) draw {k}", r"\(b\)", r"\(c\)"): ("draw {k}",),
        ("Stem {k}", r"\(a\)", r"\(b\)"): (None,),
        ("(i) one\n(ii) two {k} (iii) three", r"\(ii\)", r"\(iii\)"): ("two {k}",),
    },
    ["between"],
    lambda a, b, c: [text.between(a, b, c)],
)

scalar(
    "text_blocks",
    {
        ("intro\n1. one {k}\n2) two", "2\nM1 done"): ("1. one {k}\n|2) two", "M1", "2", "M1:M1 done"),
        ("none {k}", "M1 A1 x\nB2 y"): ("none {k}", "M1|A1|B2", "4", "M1:M1 A1 x|A1:M1 A1 x|B2:B2 y"),
        ("1 . a\n 3 ) b", "oe cao {k}"): ("1 . a\n| 3 ) b", "oe|cao", "0", "oe:oe cao {k}|cao:oe cao {k}"),
        ("1.\nx", "12"): ("1.\nx", "", "12", ""),
    },
    ["blocks", "codes", "marks", "steps"],
    lambda a, b: [_joined(text.numbered_blocks(a)), _joined(text.mark_codes(b)), text.inferred_marks(b, F.lit("")), _joined(F.transform(text.method_steps(b, F.lit(None).cast("string")), lambda x: F.concat_ws(":", x["type"], x["description"])))],
)

scalar(
    "text_scores",
    {
        ("Higher Level {k}", "a b c d e f g h i j k l", "Find the  Value", "find the value"): ("HL", "1.0", "1.0"),
        ("Paper SL", "x = y + 2 and then the word w{k} again goes on here", "abcd", "bcde"): ("SL", "0.4286", "0.75"),
        ("core {k}", "short", "", "x"): ("Core", "0.0", "0.0"),
        ("Extended", "one two three four five six seven eight nine ten eleven twelve", "same {k}", "same {k}"): ("Extended", "0.0", "1.0"),
        ("none {k}", None, None, None): ("N/A", "0.0", "0.0"),
    },
    ["tier", "noise", "ratio"],
    lambda a, b, c, d: [text.tier(a), F.round(text.math_noise(b), 4), F.round(text.similarity(c, d), 4)],
)

scalar(
    "math_repair",
    {
        ("x ^ 2 + 3 / 4<=y{k}",): ("x^2 + 3/4 <= y{k}", "false"),
        ("a b c d e f g {k}",): ("a b c d e f g {k}", "true"),
        ("(a ) ^ n=1",): ("(a )^n = 1", "false"),
        ("ends with {k} ^",): ("ends with {k} ^", "true"),
    },
    ["repaired", "risky"],
    lambda a: [text.repaired_math(a), text.risky_math(a)],
)

scalar(
    "glyph_matrices",
    {
        ("(a b)\n(c {k})",): ("\\begin{pmatrix}a b\\\\c {k}\\end{pmatrix}",),
        ("1 2\n3 4",): ("\\begin{pmatrix}1 2\\\\3 4\\end{pmatrix}",),
        ("plain {k}",): ("plain {k}",),
        ("(one)\nline",): ("(one)\nline",),
    },
    ["stacked"],
    lambda a: [text.matrix_stack(a)],
)

# --- values -------------------------------------------------------------------------------------------------------------
scalar(
    "json_repair",
    {
        ('{"a": {k}, "b": "x"}',): ("{k}", "x"),
        ('```json\n{"a": 2, "b": "y{k}"}\n```',): ("2", "y{k}"),
        (r'{"a": 3, "b": "\frac \alpha"}',): ("3", "\\frac \\alpha".replace("\\f", "\f")),
        ("no json {k}",): (None, None),
    },
    ["first", "second"],
    lambda a: [coerce.parsed_json(a, "a int, b string")["a"], coerce.parsed_json(a, "a int, b string")["b"]],
)

scalar(
    "value_lists",
    {
        ("old|new {k}", "new {k}", "http://a,x,//c,data:image/png;q,https://b{k}"): ("old|new {k}", "old|new {k}", "http://a|//c|data:image/png;q|https://b{k}", "false", "false"),
        ("numbering off|keep", "more {k}", ""): ("numbering off|keep|more {k}", "keep", "", "false", "false"),
        (None, "first {k}", None): ("first {k}", "", "", "true", "true"),
        ("a", "N/A", "[NEEDS_CROP],res.cloudinary.com/{k}"): ("a|N/A", "a", "[NEEDS_CROP]|res.cloudinary.com/{k}", "false", "false"),
        ("", "unknown_{k}", "  ,ftp://x"): ("|unknown_{k}", "", "", "true", "true"),
    },
    ["warned", "filtered", "urls", "blank", "placeholder"],
    lambda a, b, c: [
        _joined(coerce.with_warning(F.split(a, r"\|"), b)),
        _joined(coerce.without_warnings(F.split(a, r"\|"), "numbering")),
        _joined(coerce.clean_urls(F.array(F.split(c, ",")))),
        coerce.is_blank(a),
        coerce.is_placeholder(a),
    ],
)

scalar(
    "variable_names",
    {
        ('["x", " y{k} ", "", null]',): ("x|y{k}",),
        ('[{"name": "n{k}"}, {"symbol": " s "}, {"label": "l", "variable": "v"}]',): ("n{k}|s|v",),
        ('[{"options": ["a", " b ", ""]}, 7, {"other": 1}]',): ("a|b|7",),
        ("not a list {k}",): ("",),
        (None,): ("",),
    },
    ["names"],
    lambda a: [_joined(coerce.variable_names(a))],
)

# --- predicates ---------------------------------------------------------------------------------------------------------
scalar(
    "row_predicates",
    {
        ("3(a)(i)(a)", "3(a)(i)(a) see ( c ) and (b) and f(d) {k}", "10", "82"): ("b", "true", "true", "true"),
        ("4(a)(i)(b)", "4(a)(i)(b) Draw (b) {k}", "10", "83"): (None, "true", "true", "false"),
        ("51", "51 Solve {k}", "-1", "20"): (None, "true", "false", "false"),
        ("7(a)", "7(a) BLANK   PAGE", "90", "101"): (None, "false", "true", "false"),
        ("3(b)", "3(b)", "50", "40"): (None, "false", "true", "false"),
        ("3(b)", "3(b) .?", "50", "60"): (None, "false", "true", "true"),
        ("nothing", "(a) x {k}", "0", "1"): (None, "true", "true", "true"),
    },
    ["deep", "valid", "allowed", "crop"],
    lambda a, b, c, d: [filters.wrong_deep_terminal(_P(a), b), filters.valid_repair(b), filters.root_allowed(_P(a)), filters.crop_allowed(c.cast("double"), d.cast("double"))],
)

scalar(
    "repair_candidates",
    {
        ("7(a)", "The diagram shows {k}", "true", ""): ("true",),
        ("7(a)", "The diagram shows {k}", "false", ""): ("false",),
        ("7(a)", "Plain words {k}", "false", "Local QP skeleton created this row"): ("true",),
        ("7", "The diagram shows {k}", "true", "local qp skeleton created"): ("false",),
        ("7(b)", "a b c d e f g h i j k l m", "true", ""): ("true",),
        ("7(b)", "7(a) first and then 7(b) second {k}", "true", ""): ("true",),
        ("7(b)", "A long text in which the angle of the whole thing is named, and more than eighty characters {k}", "true", ""): ("true",),
    },
    ["candidate"],
    lambda a, b, c, d: [filters.repair_candidate(_P(a), b, c == "true", F.array().cast("array<string>"), F.array(d))],
)

scalar(
    "scheme_predicates",
    {
        ("1", "A1 {k}", "List of formulas"): ("true", "false", "true"),
        ("2", "A1 {k}", "Instructions: answer all questions"): ("false", "false", "true"),
        ("1", "M1 {k}", "Instructions only"): ("false", "false", "false"),
        ("0", "oe cao", "page {k} find the value [3]"): ("true", "true", "false"),
        ("1", "plain words {k}", "some ....... dots"): ("true", "true", "false"),
    },
    ["continuation", "tail", "cover"],
    lambda a, b, c: [filters.ms_continuation(a.try_cast("int"), b), filters.contaminated_tail(c), filters.is_cover_page(c)],
)

scalar(
    "sibling_trim",
    {
        ("4(b) " + "Work out the size of the angle marked with x here. " + "4(a)(iii) Find the value of y{k}", "4.b", "4.a.iii|4.b|5"): ("4(b) Work out the size of the angle marked with x here",),
        ("4(b) " + "Work out the size of the angle marked with x here. " + "5 Calculate the total area {k}", "4.b", "4.a.iii|4.b|5"): ("4(b) Work out the size of the angle marked with x here",),
        ("4(b) short 4(a)(iii) Find y{k}", "4.b", "4.a.iii|4.b"): ("4(b) short 4(a)(iii) Find y{k}",),
        ("4(b) " + "Work out the size of the angle marked with x here. " + "4(a)(iii) is named", "4.b", "4.a.iii|4.b"): ("4(b) Work out the size of the angle marked with x here. 4(a)(iii) is named",),
        ("4 " + "Work out the size of the angle marked with x here. 5 Calculate {k}", "4", "4|5"): ("4 Work out the size of the angle marked with x here. 5 Calculate {k}",),
    },
    ["trimmed"],
    lambda a, b, c: [text.trimmed_siblings(a, b, F.split(c, r"\|"))],
)

# --- ordered passes -----------------------------------------------------------------------------------------------------
papers(
    "reconciled_ids",
    [
        (
            [("5.a", "5(a) Write the ratio {k}", "", "", "5.a,5.b"), ("5.ii.a", "5(ii)(a) Mark the midpoint", "", "", ""), ("5.ii.b", "5(ii)(b) Mark the midpoint", "guard of {k}", "", "")],
            [("0", "5.a", "5(a) Write the ratio {k}", "", "", "false"), ("1", "5.b.ii.a", "5(b)(ii)(a) Mark the midpoint", "", "", "false"), ("2", "5.b.ii.b", "5(b)(ii)(b) Mark the midpoint", "guard of {k}", "", "true")],
        ),
        ([("7", "7 Heights of {k} trees. (a) Estimate the median.", "", "", "7.a,7.c.i")], [("0", "7.a", "7(a) Heights of {k} trees. (a) Estimate the median.", "", "", "false")]),
        (
            [("7", "7 A pond holds {k} fish.", "", "diagram-{k}", "7.a"), ("7.a", "7(a) Give the range.", "", "own", "")],
            [("1", "7.a", "7(a) A pond holds {k} fish. Give the range.", "", "own|diagram-{k}", "false")],
        ),
        ([("5.i", "5(i) Either half {k}", "", "", "5.a.i,5.b.i")], [("0", "5.i", "5(i) Either half {k}", "", "", "false")]),
        ([("5.b.i", "5(b)(i) Sketch it", "", "", "5.b.i,5.b.ii"), ("5.i", "5(i) Taken already {k}", "", "", "")], [("0", "5.b.i", "5(b)(i) Sketch it", "", "", "false"), ("1", "5.i", "5(i) Taken already {k}", "", "", "false")]),
        ([("5.i", "5(i) Text", "QP embedded subpart guard corrected 5.a to 5.i.", "", "5.b.i")], [("0", "5.b.i", "5(b)(i) Text", "", "", "false")]),
        ([("5.b", "5(b) One", "", "", "5.a.ii,5.b.ii"), ("5.ii", "5(ii) Two {k}", "", "", "")], [("0", "5.b", "5(b) One", "", "", "false"), ("1", "5.a.ii", "5(a)(ii) Two {k}", "", "", "false")]),
        ([("6", "6 Alone {k}", "w", "", "")], [("0", "6", "6 Alone {k}", "w", "", "true")]),
        ([("9", "9 Not expected {k}", "", "", "8.a")], [("0", "9", "9 Not expected {k}", "", "", "false")]),
    ],
    ["label", "body", "warnings", "urls", "expected"],
    ["seq", "label", "body", "warnings", "urls", "needs_review"],
    lambda rows: _reconciled(rows),
)


def _split(c: str) -> Column:
    return F.filter(F.split(F.coalesce(F.col(c), F.lit("")), r"\|"), lambda x: x != "")


def _reconciled(rows: DataFrame) -> DataFrame:
    expected = rows.where("seq = 0 and expected <> ''").select("paper", F.posexplode(F.split("expected", ",")).alias("pos", "id"))
    held = rows.withColumns({"warnings": _split("warnings"), "urls": _split("urls")}).withColumn("needs_review", F.size("warnings") > 0)
    out = reconcile.reconciled(held, expected)
    return out.withColumns({"warnings": F.array_join("warnings", "|"), "urls": F.array_join("urls", "|")})


def _pass(values: list[str], guard: Callable) -> Callable[[DataFrame], DataFrame]:
    return lambda rows: sequence.ordered_pass(rows, "paper", ["seq"], values, guard)


def _lines(*rows: tuple[Cell, ...]) -> tuple[list[tuple[Cell, ...]], list[tuple[Cell, ...]]]:
    """Rows whose last value is what they become."""
    return [r[:-1] for r in rows], [(str(i), r[-1]) for i, r in enumerate(rows)]


papers(
    "duplicates_advanced",
    [
        _lines(("{k}.c.i", "Find a", "{k}.c.i"), ("{k}.c.i", "Find b", "{k}.c.ii"), ("{k}.c.i", "Find b", "{k}.c.iii")),
        _lines(("{k}.c", "", "{k}.c"), ("{k}.c", "", "{k}.c"), ("{k}", "x", "{k}"), ("{k}", "y", "{k}")),
        _lines(("{k}.z", "p", "{k}.z"), ("{k}.z", "q", "{k}.z"), ("{k}.a", "p", "{k}.a"), ("{k}.b", "p", "{k}.b"), ("{k}.a", "r", "{k}.c")),
    ],
    ["label", "body"],
    ["seq", "new_label"],
    _pass(["label", "body"], sequence.DuplicateGuard),
)

papers(
    "visible_labels",
    [
        _lines(("6.b.i", "6(c) Complete {k}", "6.c"), ("6.c", "6(c) Again", "6.c"), ("6.d", "6(c) Once more", "6.d")),
        _lines(("{k}.a", "no label", "{k}.a"), ("{k}.b", "{k}(b) same", "{k}.b")),
    ],
    ["label", "body"],
    ["seq", "new_label"],
    lambda rows: _pass(["label", "visible"], sequence.VisibleLabel)(rows.withColumn("visible", F.when(F.size(_P(F.col("body"))) > 0, labels.canonical(_P(F.col("body")))))),
)

_STEM = "A bowl is the shape of half a ball of radius nine centimetres and full of water to the rim. "
papers(
    "embedded_subparts",
    [
        _lines(("9", "A plot of land {k} (a) Calculate the perimeter", "9.a"), ("9.c", _STEM + "(i) Calculate the area", "9.c.i"), ("9.d", _STEM + "(ii) Calculate the volume", "9.c.ii"), ("9.e", "Something else (iii) entirely new and short {k}", "9.e.iii")),
        _lines(("{k}.b", "Plain text", "{k}.b"), ("{k}.i", "With (ii) inside", "{k}.i"), ("{k}", "Only (x) here", "{k}"), ("ii", "(a) orphan", "ii")),
    ],
    ["label", "rest"],
    ["seq", "new_label"],
    _pass(["label", "rest"], sequence.EmbeddedSubpart),
)

papers(
    "expected_anchors",
    [
        _lines(("8.a.i", "6.a.i,6.a.ii,8.b", "", "6.a.i"), ("9.ii", "6.a.i,6.a.ii,8.b", "", "6.a.ii"), ("13.b", "6.a.i,6.a.ii,8.b", "", "8.b"), ("13.c", "6.a.i,6.a.ii,8.b", "", "13.c")),
        _lines(("12.c.iii", "11.a,12.b.iv", "12.b.iv", "12.b.iv"), ("11.a", "11.a,12.b.iv", "", "11.a"), ("{k}.q", "", "", "{k}.q")),
    ],
    ["label", "expected", "page"],
    ["seq", "new_label"],
    lambda rows: _pass(["label", "expected", "page"], sequence.ExpectedAnchor)(rows.withColumns({c: F.filter(F.split(c, ","), lambda x: x != "") for c in ("expected", "page")})),
)

papers(
    "orphan_context",
    [_lines(("{k}", "{k}"), ("a", "{k}.a"), ("i", "{k}.a.i"), ("ii", "{k}.a.ii"), ("b", "{k}.b"), ("iii", "{k}.b.iii")), _lines(("ii", "ii"), ("4.c", "4.c"), ("i", "4.c.i"), ("iv", "4.c.iv"))],
    ["label"],
    ["seq", "new_label"],
    _pass(["label"], sequence.OrphanContext),
)

def _shifted(rows: DataFrame) -> DataFrame:
    def run(paper: list[dict]) -> list[dict]:
        given = [{"label": r["label"], "text": r["body"], "marks": int(r["marks"]), "method": r["kind"] == "method", "answer": r["kind"] == "answer"} for r in paper]
        return [{"paper": paper[0]["paper"], "label": r["label"], "body": r["text"], "marks": r["marks"]} for r in sequence.shifted_romans(given)]

    schema = T.StructType([T.StructField("paper", T.LongType()), T.StructField("label", T.StringType()), T.StructField("body", T.StringType()), T.StructField("marks", T.IntegerType())])
    return reconcile.by_paper(rows, "paper", ["seq"], run, schema)


papers(
    "shifted_romans",
    [
        (
            [("8.a.i", "M1 {k}", "1", "method"), ("8.a.ii", "A1", "1", "answer"), ("8.a.iii", "real two", "2", "-"), ("8.a.iv", "real three", "1", "-"), ("8.b.i", "other", "1", "method")],
            [("8.a.i", "M1 {k}\nA1", "2"), ("8.a.ii", "real two", "2"), ("8.a.iii", "real three", "1"), ("8.b.i", "other", "1")],
        ),
        ([("{k}.i", "M1", "1", "-"), ("{k}.ii", "A1", "1", "answer"), ("{k}.iii", "x", "1", "-")], [("{k}.i", "M1", "1"), ("{k}.ii", "A1", "1"), ("{k}.iii", "x", "1")]),
    ],
    ["label", "body", "marks", "kind"],
    ["label", "body", "marks"],
    _shifted,
)

papers(
    "compacted_preambles",
    [
        _lines(
            (_STEM + "(i) Find the area {k}", _STEM + "(i) Find the area {k}"),
            (_STEM + "(ii) Find the volume of the water {k}", "(ii) Find the volume of the water {k}"),
            ("Different {k}", "Different {k}"),
        )
    ],
    ["body"],
    ["seq", "body"],
    lambda rows: _compacted(rows),
)


def _compacted(rows: DataFrame) -> DataFrame:
    from ..operators import windows

    return windows.compacted(rows, "paper", "seq", "body")


papers(
    "split_sources",
    [
        (
            [("4.b", "4(b) text", "4.c,4.b.ii,9.a"), ("4", "4 stem {k}", ""), ("4.a", "4(a) first holds 4(c) too {k}", "")],
            [("4.c", "4.b", "sibling"), ("4.b.ii", "4.b", "parent")],
        )
    ],
    ["label", "body", "missing"],
    ["missing_id", "source_id", "kind"],
    lambda rows: reconcile.rescue_sources(rows.select("paper", "seq", "label", "body"), rows.where("missing <> ''").select("paper", F.explode(F.split("missing", ",")).alias("id"))),
)

papers(
    "split_hint_rows",
    [
        (
            [("4.a", "4(a) holds 4(c) too {k}", "4.c,4.e"), ("4.d", "4(d) text", ""), ("5.a", "5(a) far {k}", "")],
            [("4.a", "4(a) holds 4(c) too {k}", "may also hold 4.c", "true"), ("4.d", "4(d) text", "may also hold 4.e", "true"), ("5.a", "5(a) far {k}", "", "false")],
        )
    ],
    ["label", "body", "missing"],
    ["label", "body", "warned", "needs_review"],
    lambda rows: _hinted(rows),
)


def _hinted(rows: DataFrame) -> DataFrame:
    have = rows.select("paper", "seq", "label", "body", F.array().cast("array<string>").alias("warnings"), F.lit(False).alias("needs_review"))
    hints = reconcile.split_hints(have, rows.where("missing <> ''").select("paper", F.explode(F.split("missing", ",")).alias("id")))
    return reconcile.split_warnings(have, hints).withColumn("warned", F.array_join("warnings", "|"))


_PAGES = [
    ("0", "50", "10", "INSTRUCTIONS answer all questions 1 (a) no", "1,2.a.i,2.a.ii,2.b,3.a"),
    ("1", "40", "10", "1 Work out {k}", ""),
    ("1", "60", "30", "when x is one.", ""),
    ("1", "40", "50", "2 A bag holds balls.", ""),
    ("1", "50", "60", "(a) (i) Find p.", ""),
    ("1", "50", "70", "(ii) Find q {k}", ""),
    ("1", "200", "72", "(b) too far right", ""),
    ("1", "50", "800", "below the page", ""),
    ("4", "50", "5", "Turn over", ""),
    ("4", "50", "10", "(b) Draw it", ""),
    ("4", "40", "20", "3", ""),
    ("4", "45", "25", "A tree stands.", ""),
    ("4", "60", "30", "(a) How tall?", ""),
]
_FOUND = [
    ("0", "1", "1 Work out {k} when x is one."),
    ("1", "2.a.i", "2 A bag holds balls. 2(a)(i) Find p."),
    ("2", "2.a.ii", "2 A bag holds balls. 2(a)(ii) Find q {k} (b) too far right"),
    ("3", "2.b", "2 A bag holds balls. 2(b) Draw it"),
    ("4", "3.a", "3 A tree stands. 3(a) How tall?"),
]


def _paper_lines(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    lines = rows.select("paper", F.col("page").cast("int").alias("page"), F.col("seq").alias("line_no"), F.col("x0").cast("double").alias("x0"), F.col("y0").cast("double").alias("y0"), "line")
    return lines, rows.where("expected <> ''").select("paper", F.posexplode(F.split("expected", ",")).alias("pos", "id"))


papers("paper_skeletons", [(_PAGES, _FOUND)], ["page", "x0", "y0", "line", "expected"], ["pos", "id", "body"], lambda rows: skeleton.skeleton(*_paper_lines(rows)))

papers(
    "page_roots",
    [(_PAGES[1:4] + [("2", "90", "1", "nothing here", "1,2.a,2.b,3"), ("3", "30", "9", "3 Draw", ""), ("3", "30", "8", "9 Unknown", "")], [("1", "1", "1"), ("2", "1", "1"), ("3", "3", "3")])],
    ["page", "x0", "y0", "line", "expected"],
    ["page", "root", "shown"],
    lambda rows: skeleton.page_roots(*_paper_lines(rows)).withColumn("shown", F.array_join("ids", ",")),
)


def _cascade(rows: DataFrame) -> DataFrame:
    left = rows.where("side = 'want'").select("paper", F.col("seq").alias("l_id"), F.col("id").alias("l_label"), F.col("body").alias("l_text"))
    right = rows.where("side = 'have'").select("paper", F.col("seq").alias("r_id"), F.col("id").alias("r_label"), F.col("body").alias("r_text"))
    return joins.match_cascade(left, right, "paper")


papers(
    "match_cascade",
    [
        (
            [("want", "{k}.a", "Find the value of x"), ("want", "{k}.b", "Draw the graph of the function on the grid"), ("want", "9.c.ii", "Find y"), ("want", "7", "zzz qqq"),
             ("have", "{k}.a", "Find the value of x"), ("have", "4.z", "draw  the GRAPH of the function on the grid"), ("have", "8.c.ii", "Find x"), ("have", "8.d", "nothing of the kind")],
            [("0", "4", "exact", "1.0"), ("1", "5", "fuzzy", "1.0"), ("2", "6", "suffix", "0.9167")],
        ),
        ([("want", "1.a", "Same text in both rows {k}"), ("want", "1.b", "Same text in both rows {k}"), ("have", "5.x", "same text in both rows {k}")], [("0", "2", "fuzzy", "1.0")]),
    ],
    ["side", "id", "body"],
    ["l_id", "r_id", "kind", "score"],
    lambda rows: _cascade(rows),
)
