"""Values that live for a while after they are first met, as a stream: jobs by their status, cached results by their requests.

Rows of a key wait in its state until the watermark has passed their time and are then taken in the order of time, so the outcome does not depend on the
order or the batches in which they came, as long as they came within the allowed lateness; later rows are dropped by the watermark.  A key's first row begins a life; rows
within the time to live belong to it, and the first one beyond begins the next.  A timer ends a life when the watermark passes its time, so
state holds open lives and rows that wait, not the history.  A key has one timer for its first row that waits and one for its life's end, and all that the
watermark allows is taken at once, so a key of many rows is sorted once.  Rows go to the state in packs, and only the kinds that are asked for come out: each
call of the state, and each row that leaves Python, costs more than a row's turn.

The state needs Spark's RocksDB provider: `settled` sets it for its own run; who starts a stream of `lives` otherwise sets PROVIDER first."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from . import ledger

#: Seconds that a job and a cached result live.
JOB_SECONDS, RESULT_SECONDS = 3600, 4 * 3600
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
SETTING = "spark.sql.streaming.stateStore.providerClass"
SCHEMA = "key string, kind string, at timestamp, born timestamp, value string, rows long"
KINDS = ("first", "again", "end")
#: Fixed value: rows a pack.
PACK = 1000
#: SCHEMA with times as microseconds, as rows leave Python.
_TOLD = "key string, kind string, at long, born long, value string, rows long"
_Told = Row("key", "kind", "at", "born", "value", "rows")


class Lives(StatefulProcessor):
    """Rows (key, micros, value) to rows of SCHEMA, with times in microseconds: kind 'first' or 'again' for each row taken, with its life's beginning, and 'end' for each life
    that ended, with its last value and number of rows."""

    def __init__(self, seconds: int, last_instant: bool, kinds: tuple[str, ...] = KINDS) -> None:
        """last_instant: whether a row exactly so many seconds after the first belongs to its life; kinds: those that are told."""
        self.micros, self.last_instant = seconds * 1_000_000, last_instant
        self.kinds = frozenset(kinds)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "micros array<long>, value array<string>")
        self.life = handle.getValueState("life", "born long, last long, value string, rows long")

    def _within(self, born: int, at: int) -> bool:
        return at - born <= self.micros if self.last_instant else at - born < self.micros

    def _timer(self, micros: int) -> None:
        self.handle.registerTimer(-(-micros // 1000))

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        first, rows = None, iter(rows)
        while pack := [(r.micros, r.value) for r in islice(rows, PACK)]:
            micros, values = map(list, zip(*pack))
            self.waiting.appendValue((micros, values))
            first = min(micros) if first is None else min(first, *micros)
        if first is not None:
            self._timer(first)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = [r for pack in self.waiting.get() for r in zip(*pack)]
        ready = sorted((r for r in waiting if r[0] <= now), key=lambda r: (r[0], r[1] is not None, r[1] or ""))
        life = self.life.get() if self.life.exists() else None
        life = list(life) if life is not None else None
        out, begun = [], False
        for micros, value in ready:
            if life and not self._within(life[0], micros):
                self._end(out, key[0], life)
                life = None
            if life:
                life[1:] = [micros, value, life[3] + 1]
            else:
                life, begun = [micros, micros, value, 1], True
            kind = "again" if life[3] > 1 else "first"
            if kind in self.kinds:
                out.append(_Told(key[0], kind, micros, life[0], value, life[3]))
        if life and not self._within(life[0], now):
            self._end(out, key[0], life)
            life = None
        if life:
            self.life.update(tuple(life))
            if begun:
                self._timer(life[0] + self.micros + (1000 if self.last_instant else 0))
        elif self.life.exists():
            self.life.clear()
        left = [r for r in waiting if r[0] > now]
        if ready and left:
            self.waiting.put([tuple(map(list, zip(*left[k : k + PACK]))) for k in range(0, len(left), PACK)])
            self._timer(min(r[0] for r in left))
        elif ready:
            self.waiting.clear()
        return iter(out)

    def _end(self, out: list[Row], key: str, life: list) -> None:
        if "end" in self.kinds:
            out.append(_Told(key, "end", life[0] + self.micros, life[0], life[2], life[3]))

    def close(self) -> None:
        pass


def lives(stream: DataFrame, key: str, ts: str, value: str, seconds: int, last_instant: bool = True, late: str = "10 minutes", kinds: tuple[str, ...] = KINDS) -> DataFrame:
    """What becomes of a stream's keys, as rows of SCHEMA of the kinds asked for.  A null key is the key ''; a null time is dropped; values may be null; rows of one time are
    taken by value, null first; a repeated row counts again."""
    rows = stream.where(F.col(ts).isNotNull()).select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.col(ts).cast("timestamp").alias("ts"), F.col(value).cast("string").alias("value"))
    rows = rows.withColumn("micros", F.unix_micros("ts")).withWatermark("ts", late)
    told = rows.groupBy("key").transformWithState(Lives(seconds, last_instant, kinds), _TOLD, "Append", "EventTime")
    return told.withColumns({c: F.timestamp_micros(c) for c in ("at", "born")})


def settled(df: DataFrame, folder: str) -> DataFrame:
    """What a stream gives for all that is there now, through files in a folder that the driver and the executors share."""
    spark = df.sparkSession
    before = spark.conf.get(SETTING, None)
    spark.conf.set(SETTING, PROVIDER)
    try:
        ledger.run_once(df, f"{folder}/out", f"{folder}/state")
    finally:
        spark.conf.set(SETTING, before) if before else spark.conf.unset(SETTING)
    return spark.read.schema(df.schema).parquet(f"{folder}/out")
