"""Streaming extensions: the per-row transforms run unchanged; duplicates and counts are bounded by watermarks."""

from __future__ import annotations

import pickle

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor
from pyspark.sql.types import StructType

from ..functions import fixed_values as V
from ..plans import guard, pii

EVENTS = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def read_stream(spark: SparkSession, folder: str, schema: str, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def anonymized(docs: DataFrame, settings: pii.PiiSettings = pii.PiiSettings()) -> DataFrame:
    """Final records of a stream of documents; ids must be in the rows."""
    return pii.sanitized(pii.anonymize(docs, settings, row_id=F.lit(0)))


def guarded(prompts: DataFrame, settings: guard.GuardSettings = guard.GuardSettings()) -> DataFrame:
    return guard.decisions(prompts, settings)


def first_of_each(rows: DataFrame, key: str, ts: str, late: str = "1 hour") -> DataFrame:
    """One row of each key; a key is forgotten once the watermark has passed it."""
    return rows.withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def decision_counts(decided: DataFrame, ts: str, window: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Decisions of each time window; a window is emitted once it is complete."""
    d = F.col("decision")
    rows = decided.withWatermark(ts, late).groupBy(F.window(ts, window))
    return rows.agg(F.count_if(d == V.PASS).alias("passed"), F.count_if(d == V.BLOCK).alias("blocked"), F.count_if(d == V.REVIEW).alias("reviewed")).select("window.start", "window.end", "passed", "blocked", "reviewed")


#: Where Spark keeps state that timers belong to.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Last(StatefulProcessor):
    """Of each key the row of the greatest place so far, given out by a timer."""

    def __init__(self, schema: StructType, order: list[str], hold: int):
        self.schema, self.order, self.hold = schema, order, hold

    def init(self, handle) -> None:
        self.handle = handle
        # as bytes: values come back from state in other types than they come in rows (times with and without a zone)
        self.last = handle.getValueState("last", "row binary")

    def _place(self, row: tuple) -> tuple:
        at = self.schema.fieldNames()
        return tuple((row[at.index(c)] is not None, row[at.index(c)]) for c in self.order)

    def handleInputRows(self, key, rows, timerValues):
        held = pickle.loads(self.last.get()[0]) if self.last.exists() else None
        best = held
        for row in rows:
            row = tuple(row)
            if best is None or self._place(row) >= self._place(best):
                best = row
        if best is not held:
            self.last.update((pickle.dumps(best),))
            for timer in list(self.handle.listTimers()):
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(best[-1] + self.hold)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.last.exists():
            yield Row(**dict(zip(self.schema.fieldNames(), pickle.loads(self.last.get()[0]))))
            self.last.clear()

    def close(self) -> None:
        pass


def last_of_each(rows: DataFrame, key: str, ts: str, order: list[str] | None = None, late: str = "1 hour", hold_seconds: int = 3600) -> DataFrame:
    """The last row of each key, by ``order`` (the time by default), in any order of arrival.

    A row is given out when the watermark, ``late`` behind the latest time seen, has passed its time by
    ``hold_seconds``, and its key is then forgotten: state holds the keys of that span only, a row each. A key that comes
    again later is a new one. Of equal places the row that arrives last wins; rows without a key or a time are left out. Needs ``STATE_STORE``.
    """
    names = rows.columns
    timed = rows.where(F.col(key).isNotNull() & F.col(ts).isNotNull()).withColumn("_ms", F.unix_millis(ts)).withWatermark(ts, late)
    processor = _Last(timed.schema, order or [ts], hold_seconds * 1000)
    found = timed.groupBy(key).transformWithState(statefulProcessor=processor, outputStructType=timed.schema, outputMode="append", timeMode="eventTime")
    return found.select(*names)
