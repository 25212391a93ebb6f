"""Sources and sinks: tables, request files, caches, samples and nested output."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import coerce


def parquet(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


_own: list[str] = []


def workspace(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which the driver and all executors share.  Only a local session may leave it unset, and gets a temporary one."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local(\[[^,]*(,\s*\d+)?\])?$", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        if not _own:
            _own.append(tempfile.mkdtemp(prefix="scriptorium-"))
            atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
        found = _own[0]
    return found.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Rows that are used again, computed once: a checkpoint in the workspace."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(workspace(df.sparkSession))
    return df.checkpoint()


def shuffled(df: DataFrame) -> DataFrame:
    """A side of a join that is never sent whole through the driver: of rows that were exploded or cut, Spark guesses the size from the files
    that they came from, which is many times too small."""
    return df.hint("merge")


def streamed(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table as a stream of its files.  The pattern lets the table be one file, which a path of a stream may not be."""
    return spark.readStream.schema(parquet(spark, folder, name).schema).parquet(f"{folder}/{name}.parque[t]")


def requests(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of requests; rows that can't be read keep their text in _corrupt_record."""
    return spark.read.schema(f"{schema}, _corrupt_record string").option("mode", "PERMISSIVE").json(path)


def parsed_requests(rows: DataFrame, body: str, schema: str) -> DataFrame:
    """rows with request (parsed from JSON text) and corrupt (the text, where it can't be read)."""
    found = F.from_json(F.col(body), f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    return rows.withColumn("request", found).withColumn("corrupt", F.col("request._corrupt_record"))


def binary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def decoded(payload: Column) -> Column:
    """Bytes of base64 text, without a data: prefix."""
    return F.unbase64(F.regexp_replace(payload, r"^data:[^,]*,", ""))


def pages(texts: DataFrame, paper: str, body: str) -> DataFrame:
    """A row for each page of a text dump; form feeds part pages, a null text is one empty page."""
    return texts.select(paper, F.posexplode(F.split(F.coalesce(body, F.lit("")), "\f")).alias("page_index", "page_text"))


def lines(page_rows: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Non-blank lines in order."""
    return page_rows.select(*keys, F.posexplode(F.split(body, "\n")).alias("line_no", "line")).where(F.trim("line") != "")


def model_rows(raw: DataFrame, keys: list[str], body: str, schema: str) -> DataFrame:
    """Rows of model answers: JSON arrays of structs, healed where needed; an unreadable answer gives one failed row."""
    parsed = raw.withColumn("__rows", coerce.parsed_json(F.col(body), f"array<struct<{schema}>>"))
    good = parsed.where(F.col("__rows").isNotNull()).select(*keys, F.posexplode("__rows").alias("seq", "row")).select(*keys, "seq", "row.*", F.lit(False).alias("page_failed"))
    bad = parsed.where(F.col("__rows").isNull()).select(*keys, F.lit(True).alias("page_failed"))
    return good.unionByName(bad, allowMissingColumns=True)


#: Keys under which a model may put its list of regions, the zone that is cut off, and the heights that are kept.
REGION_KEYS, REGION_EDGE, REGION_HEIGHTS = ("diagrams", "coordinates", "vision_results", "items"), 5.0, (5.0, 65.0)


def vision_regions(raw: DataFrame, keys: list[str], body: str) -> DataFrame:
    """Regions (keys, question_number, y0, y1) of model answers: a JSON list, or an object with one; entries without a number or
    with bounds that are no percents go, others are clamped to the page's inside and kept if neither thin nor nearly the page."""
    items = "array<string>"
    text = F.trim(F.regexp_replace(F.regexp_replace(F.coalesce(body, F.lit("")), r"^\s*```[a-z]*\n?", ""), r"```\s*$", ""))
    held = F.from_json(text, "struct<" + ", ".join(f"{k}: {items}" for k in REGION_KEYS) + ">")
    listed = F.coalesce(F.when(text.startswith("["), F.from_json(text, items)), *[held[k] for k in REGION_KEYS])
    entry = F.from_json("entry", "question_number string, y_start_pct string, y_end_pct string")
    rows = raw.select(*keys, F.explode(listed).alias("entry")).select(*keys, entry.alias("e"))
    y = lambda f: F.col(f"e.{f}").try_cast("double")
    rows = rows.select(*keys, F.trim("e.question_number").alias("question_number"), y("y_start_pct").alias("a"), y("y_end_pct").alias("b"))
    rows = rows.where("question_number <> '' and a < b and a >= 0 and b <= 100")
    rows = rows.select(*keys, "question_number", F.greatest("a", F.lit(REGION_EDGE)).alias("y0"), F.least("b", F.lit(100 - REGION_EDGE)).alias("y1"))
    return rows.where((F.col("y1") - F.col("y0")).between(*REGION_HEIGHTS))


#: What the first page of the second board's papers tells.
PAGE_FIELDS = ("subject_name", "level", "paper_number", "timezone", "session", "year", "document_type")


def page_metadata(raw: DataFrame, keys: list[str], body: str) -> DataFrame:
    """The fields of a JSON answer on a first page; blank ones, and all of an unreadable answer, are null."""
    found = coerce.parsed_json(F.col(body), ", ".join(f"{f} string" for f in PAGE_FIELDS))
    return raw.select(*keys, found.alias("m")).select(*keys, *[coerce.nullif_blank(F.trim(F.col(f"m.{f}"))).alias(f) for f in PAGE_FIELDS])


def table_cells(cells: DataFrame) -> DataFrame:
    """Rows (table_id, row_no, cells) folded to question, answer, marks, partial; tables without that header go."""
    c = F.filter(F.col("cells"), lambda x: x.isNotNull())
    n = F.size(c)
    per = F.when(n % 4 == 0, n / 4).when(n == 11, F.lit(3)).otherwise(F.lit(1)).cast("int")
    part = lambda k: F.trim(F.array_join(F.slice(c, F.least(per * k + 1, n + 1), F.when((n == 11) & F.lit(k == 3), F.lit(2)).otherwise(per)), " "))
    rows = cells.where(F.size("cells") >= 4).select("*", *[part(k).alias(name) for k, name in enumerate(("question", "answer", "marks", "partial"))])
    head = F.lower(F.col("question")).startswith("question") & F.lower(F.col("answer")).startswith("answer") & F.lower(F.col("marks")).startswith("mark")
    from pyspark.sql import Window

    rows = rows.withColumn("__head", head).withColumn("__ok", F.max(head).over(Window.partitionBy("table_id")))
    return rows.where("__ok and not __head").drop("__head", "__ok")


def chunks(texts: DataFrame, paper: str, body: str, most: int = 7500, blocks: int = 8) -> DataFrame:
    """Numbered blocks of texts packed in order into chunks of at most so many characters and blocks (one longer block alone)."""
    from ..functions import text
    from ..operators import sequence

    rows = texts.select(paper, F.posexplode(text.numbered_blocks(F.col(body))).alias("seq", "block")).withColumn("n", F.char_length("block").cast("long"))
    packed = sequence.packed(rows, paper, ["seq"], "n", most, blocks)
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("seq", "block"))), lambda x: x["block"]), "")
    return packed.groupBy(paper, F.col("bin").alias("chunk")).agg(joined.alias("text"), F.count(F.lit(1)).alias("blocks"))


def cache_key(payload: Column) -> Column:
    return F.sha2(payload, 256)


def fresh(entries: DataFrame, now: Column, hours: float = 4.0) -> DataFrame:
    """Cache entries younger than so many hours."""
    return entries.where(F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col("ts").cast("timestamp")) < int(hours * 3600e6))


def cached(entries: DataFrame, wanted: DataFrame, compute, now: Column, hours: float = 4.0) -> tuple[DataFrame, DataFrame]:
    """(answers, new entries): wanted (key, ...) from entries (key, ts, answer) that are fresh, the rest by compute(rest) -> key, answer.

    Of several fresh entries the latest answers."""
    kept = fresh(entries, now, hours).groupBy("key").agg(F.max_by("answer", "ts").alias("answer"))
    keys = wanted.select("key").distinct()
    new = compute(wanted.join(kept.select("key"), "key", "left_anti")).select("key", "answer")
    held = kept.join(keys, "key", "left_semi").withColumn("hit", F.lit(True))
    return held.unionByName(new.withColumn("hit", F.lit(False))), new.withColumn("ts", now)


def errors(rows: DataFrame, failed: Column, stage: str, message: Column, status: int = 500) -> DataFrame:
    """A detail for each failed row: stage, message, status and the row itself."""
    detail = F.struct(F.lit(stage).alias("stage"), F.coalesce(message, F.lit("unknown error")).alias("message"), F.lit(status).alias("status"), F.to_json(F.struct(*rows.columns)).alias("details"))
    return rows.where(failed).select(detail.alias("error")).select("error.*")


def normalised_rows(raw: DataFrame, metadata: DataFrame, paper: str, fields: dict[str, Column], identity: list[str], forced: Column) -> DataFrame:
    """raw rows with the metadata of their paper: a field is the row's own value, else the paper's, else its default; where
    forced holds, identity fields are the paper's if it has them."""
    m = metadata.select(F.col(paper).alias("__paper"), *[F.col(f).alias(f"__{f}") for f in metadata.columns if f != paper])
    joined = raw.join(m, raw[paper] == F.col("__paper"), "left")
    known = set(metadata.columns)

    def value(f: str, default: Column) -> Column:
        theirs = coerce.nullif_blank(F.col(f"__{f}")) if f in known else F.lit(None)
        own = coerce.nullif_blank(F.col(f)) if f in raw.columns else F.lit(None)
        first, second = (F.when(forced, theirs), F.coalesce(own, theirs)) if f in identity else (own, theirs)
        return F.coalesce(first, second, default)

    return joined.withColumns({f: value(f, d) for f, d in fields.items()}).drop("__paper", *[f"__{f}" for f in metadata.columns if f != paper])


def updated(rows: DataFrame, payload: DataFrame, key: str) -> DataFrame:
    """rows overwritten by the columns of payload, where it has the key; new columns are added."""
    mine = [c for c in payload.columns if c != key]
    p = payload.select(key, *[F.col(c).alias(f"__{c}") for c in mine], F.lit(True).alias("__hit"))
    out = rows.join(p, key, "left")
    out = out.withColumns({c: F.when(F.col("__hit"), F.col(f"__{c}")).otherwise(F.col(c)) if c in rows.columns else F.col(f"__{c}") for c in mine})
    return out.drop("__hit", *[f"__{c}" for c in mine])


def sample(df: DataFrame, n: int, key: str, seed: int = 7) -> DataFrame:
    """n rows at random, the same ones in every run."""
    return df.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


#: Furniture of a marking scheme, symbols without a glyph, and the line from which on it is read.
SCHEME_FURNITURE = r"(?i)^\s*page\s\d+\s+of\s+\d+\s*$|^(?:www\.exam-mate\.com|\[turn ove\r|© ucles \d{4}\s+page\s\d+\s+of\s+\d+\s*|\d{6}/\d{2}\s+cambridge\s+igcse\s+–\s+mark\s+scheme\s+published\s+may/june\s+\d{4}|generic marking principles|maths-specific marking principles(?:\s+\d+)?|question answer marks partial marks)$"
SCHEME_SYMBOLS = "\uf028\uf029\uf03d\uf0b4\uf02b\uf02d\uf0e6\uf0f6\uf0e7\uf0f7\uf0e8\uf0f8"
SCHEME_BEGINS = r"^\s*1\s*\(a\)\(i\)"
_SCHEME_ID = re.compile(r"^\s*(\d+)(?:([a-z]))?(?:\(([ivx]+|\d+)\))?(?:\(([a-z])\))?(?:\(([ivx]+|\d+)\))?(?![a-zA-Z0-9])")
_SCHEME_PART = re.compile(r"^\s*\(?([ivx]+|[a-z])\)?\s*(.*)$")
_ROMAN = {r: str(k) for k, r in enumerate("i ii iii iv v vi vii viii ix x".split(), 1)}


def scheme_lines(texts: DataFrame, paper: str, body: str) -> DataFrame:
    """Lines of marking schemes without furniture, symbols and [marks], from the first question on."""
    rows = lines(texts, [paper], body).where(~F.col("line").rlike(SCHEME_FURNITURE))
    clean = F.translate(F.regexp_replace("line", "\\s*\uf0b7\\s*", ""), SCHEME_SYMBOLS, "")
    rows = rows.withColumn("line", F.trim(F.regexp_replace(clean, r"\[\d+\]", ""))).where("line <> ''")
    from pyspark.sql import Window

    begun = F.max(F.col("line").rlike(SCHEME_BEGINS)).over(Window.partitionBy(paper).orderBy("line_no"))
    return rows.withColumn("__begun", begun).where("__begun").drop("__begun")


class SchemeLabel:
    """The id that a line of a marking scheme belongs to, and what of the line is text."""

    def __init__(self) -> None:
        self.id = ""

    def __call__(self, line: str) -> tuple[str, str]:
        own = _SCHEME_ID.match(line)
        if own:
            self.id = ".".join(p if p.isdigit() or len(p) == 1 else _ROMAN.get(p, p) for p in own.groups() if p)
            return self.id, line[own.end() :].strip()
        part = _SCHEME_PART.match(line)
        if part and self.id and part[2].strip():
            self.id = f"{self.id}.{_ROMAN.get(part[1], part[1])}"
            return self.id, part[2].strip()
        return self.id, line


def scheme_questions(texts: DataFrame, paper: str, body: str) -> DataFrame:
    """paper, question_id, content: what a marking scheme's text says of each id, in one piece for each time it is begun."""
    from ..operators import sequence

    def guard():
        state, last, n = SchemeLabel(), [""], [0]

        def step(line: str) -> tuple[str, bool]:
            before = state.id
            found, rest = state(line)
            fresh = _SCHEME_ID.match(line) is not None or found != before
            n[0] += fresh
            last[0] = found
            return f"{n[0]}\x1f{found}\x1f{rest}", fresh

        return step

    rows = sequence.ordered_pass(scheme_lines(texts, paper, body), paper, ["line_no"], "line", guard)
    part = F.split("new_label", "\x1f")
    rows = rows.select(paper, "line_no", F.get(part, F.lit(0)).cast("int").alias("turn"), F.get(part, F.lit(1)).alias("question_id"), F.get(part, F.lit(2)).alias("rest"))
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "rest"))), lambda x: x["rest"]), " ")
    out = rows.where("question_id <> ''").groupBy(paper, "turn", "question_id").agg(F.trim(F.regexp_replace(joined, r"\s+", " ")).alias("content"))
    return out


def catalog(spark: SparkSession, folder: str, names: list[str]) -> DataFrame:
    """Names and row counts, from the files' footers."""
    parts = [parquet(spark, folder, n).agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("name"), "rows") for n in sorted(names)]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionAll(p)
    return out


def nested(rows: DataFrame, group: str, order: str, fields: list[str], default: str = "N/A") -> DataFrame:
    """A JSON document for each group with its rows in order; blanks become the default."""
    row = F.struct(F.col(order), *[F.coalesce(coerce.nullif_blank(F.col(f).cast("string")), F.lit(default)).alias(f) for f in fields])
    return rows.groupBy(group).agg(F.to_json(F.struct(F.transform(F.array_sort(F.collect_list(row)), lambda r: F.struct(*[r[f].alias(f) for f in fields])).alias("questions"))).alias("document"))


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def crop_box(page_w: Column, page_h: Column, y0: Column, y1: Column, pad: float = 2.0) -> Column:
    """Points of a crop in percents of a page; null where it is nearly the page or degenerate."""
    top, bottom = F.greatest(F.lit(0.0), (y0 - pad) / 100 * page_h), F.least(page_h, (y1 + pad) / 100 * page_h)
    return F.when((bottom - top >= 10) & (bottom - top <= 0.78 * page_h), F.struct(F.lit(0.0).alias("x0"), top.alias("y0"), page_w.alias("x1"), bottom.alias("y1")))
