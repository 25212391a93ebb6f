"""What runs use, captured as they run: calls, tokens and failures by model, appended to a ledger.

The counts are observed on the rows of the run itself (Dataset.observe), so no second pass reads them, and they are of all rows that the run's
action read.  Batches are asked for them after the action; a stream gives them with its progress, to a listener.  A run adds one row a named model
and one for all others, whatever the number of calls."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from ..functions import coerce

SCHEMA = "run string, component string, model string, calls long, prompt_tokens long, output_tokens long, failures long"
OTHER = "other"
_COUNTS = ("calls", "prompt_tokens", "output_tokens", "failures")


def _observed(models: list[str], model: Column, prompt: Column, output: Column, failed: Column) -> list[Column]:
    """calls_0, prompt_tokens_0, ... by place of the model; what is none of them, null too, comes last."""
    out = []
    known = F.coalesce(model.isin(*models), F.lit(False)) if models else F.lit(False)
    for k, own in enumerate([*(F.coalesce(model == m, F.lit(False)) for m in models), ~known]):
        values = (F.lit(1), F.when(failed, 0).otherwise(F.coalesce(prompt, F.lit(0))), F.when(failed, 0).otherwise(F.coalesce(output, F.lit(0))), F.when(failed, 1).otherwise(0))
        out += [F.sum(F.when(own, v).otherwise(0)).cast("long").alias(f"{name}_{k}") for name, v in zip(_COUNTS, values)]
    return out


class Ledger:
    """A ledger in a shared folder, and the runs that are watched for it."""

    def __init__(self, spark: SparkSession, folder: str, models: list[str]) -> None:
        self.spark, self.folder, self.models = spark, folder, models
        self.watched: list[tuple[str, str, Observation]] = []

    def _append(self, run: str, component: str, counts: dict) -> None:
        rows = [(run, component, m, *(int(counts.get(f"{c}_{k}") or 0) for c in _COUNTS)) for k, m in enumerate([*self.models, OTHER])]
        rows = [r for r in rows if r[3]]
        if rows:
            self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.folder)

    def watch(self, calls: DataFrame, component: str, model: str, prompt: str, output: str, failed: str) -> DataFrame:
        """calls, to be used in one action.  A failed call counts no tokens; a null `failed` is none."""
        seen = Observation()
        self.watched.append((uuid.uuid4().hex, component, seen))
        return calls.observe(seen, *_observed(self.models, F.col(model), F.col(prompt), F.col(output), F.coalesce(F.col(failed), F.lit(False))))

    def settle(self) -> None:
        """Append what the watched runs used; each must have had its action."""
        while self.watched:
            run, component, seen = self.watched.pop(0)
            self._append(run, component, seen.get)

    def watch_stream(self, calls: DataFrame, component: str, model: str, prompt: str, output: str, failed: str) -> DataFrame:
        """calls of a stream; `listener` appends a run for each of its batches."""
        return calls.observe(f"ledger:{component}", *_observed(self.models, F.col(model), F.col(prompt), F.col(output), F.coalesce(F.col(failed), F.lit(False))))

    def listener(self) -> StreamingQueryListener:
        """To be added to spark.streams.  A batch that is repeated after a failure has the same run (query and batch), so `rows` counts it once."""
        ledger = self

        class Listener(StreamingQueryListener):
            def onQueryStarted(self, event) -> None:  # noqa: N802
                pass

            def onQueryProgress(self, event) -> None:  # noqa: N802
                p = event.progress
                for name, row in p.observedMetrics.items():
                    if name.startswith("ledger:"):
                        ledger._append(f"{p.id}-{p.batchId}", name[7:], row.asDict())

            def onQueryIdle(self, event) -> None:  # noqa: N802
                pass

            def onQueryTerminated(self, event) -> None:  # noqa: N802
                pass

        return Listener()

    def rows(self) -> DataFrame:
        """The ledger's rows; of one run, component and model one."""
        return self.spark.read.schema(SCHEMA).parquet(self.folder).dropDuplicates(["run", "component", "model"])

    def totals(self) -> DataFrame:
        """component, model and the sums over all runs, with what they cost."""
        total = self.rows().groupBy("component", "model").agg(*(F.sum(c).alias(c) for c in _COUNTS))
        nothing = F.lit(0).cast("long")
        cost = coerce.token_cost(F.col("model"), F.col("prompt_tokens"), F.col("output_tokens"), nothing, F.col("prompt_tokens") + F.col("output_tokens"))
        return total.withColumn("inr", cost["inr"])
