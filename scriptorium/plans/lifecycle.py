"""Whole runs of the engine, composed of its operators: from the lines of a paper, or the cells of a scheme, to a response."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import labels, text
from ..operators import aggregates as agg
from ..operators import joins, reconcile, sets, skeleton
from ..sources import tables


def question_paper(lines: DataFrame, raw: DataFrame, answers: DataFrame) -> DataFrame:
    """Lines of papers, expected ids (paper, pos, value) and model rows (paper, seq, label, body) -> a response for each paper: the skeleton's
    rows, with gaps filled by model rows of expected ids, reconciled, hints on rows that may hold what is still missing, and the report."""
    expected = tables.cut(joins.expected_ids(raw))
    local = tables.cut(skeleton.skeleton(lines, expected).select("paper", F.col("pos").cast("long").alias("seq"), F.col("id").alias("label"), "body"))
    known = expected.select("paper", F.col("id").alias("label"), F.col("pos").alias("place"))
    more = answers.join(tables.shuffled(known), ["paper", "label"], "left_semi").join(tables.shuffled(local.select("paper", "label")), ["paper", "label"], "left_anti")
    rows = sets.appended(local.withColumn("recovered", F.lit(False)), more.select("paper", "seq", "label", "body").withColumn("recovered", F.lit(True)))
    rows = rows.withColumns({"urls": F.array().cast("array<string>"), "warnings": F.array().cast("array<string>"), "needs_review": F.col("recovered")})
    rows = tables.cut(reconcile.reconciled(rows, expected.select("paper", "pos", "id")))
    missing = expected.select("paper", F.col("id")).join(tables.shuffled(rows.select("paper", F.col("label").alias("id"))), ["paper", "id"], "left_anti")
    rows = reconcile.split_warnings(rows, reconcile.split_hints(rows, missing))
    rows = rows.join(tables.shuffled(known), ["paper", "label"], "left").withColumns({"seq": F.coalesce(F.col("place"), F.lit(1 << 30)), "root": F.substring_index("label", ".", 1).try_cast("int")})
    return agg.envelope(rows, "paper", "root", ["label", "body", "warnings", "needs_review"])


def marking_scheme(cells: DataFrame) -> DataFrame:
    """Cells (table_id, row_no, cells) of schemes -> a response for each table: lines under the last label shown, with marks, steps and demand."""
    lines = tables.table_cells(cells)
    shown = F.when(F.size(labels.parts(F.col("question"))) > 0, F.col("question")).otherwise("")
    held = agg.accumulated(lines.withColumn("label", shown), "table_id", "row_no", "label", ["answer", "marks", "partial"])
    marks = text.inferred_marks(F.col("marks"), F.col("partial"))
    p = labels.parts(F.col("label"))
    rows = held.withColumns({"id": labels.canonical(p), "seq": F.xxhash64("label"), "total_marks": marks, "demand": text.demand(marks), "steps": text.method_steps(F.col("marks"), F.col("partial"))})
    rows = rows.withColumns({"root": F.substring_index("id", ".", 1).try_cast("int"), "seq": labels.natural_key(F.split("id", r"\."))})
    return agg.envelope(rows, "table_id", "root", ["id", "answer", "total_marks", "demand", "steps"])
