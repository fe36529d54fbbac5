"""The hold of collapsed counts, as a stream with state and as a batch over sorted rows: both feed one Judge in order.

A reading of a unit is held if it is below a share of the accepted count before it, unless a later reading is near it.  So
only readings from the first open hold on can still change; a Judge keeps these, everything before is one number.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Judge:
    """Readings of one unit in order.  add() returns what is new or has changed: (place, at, n, accepted before, held)."""

    floor: int = 10
    shrink: float = 0.5
    agree: float = 0.25
    accepted: int | None = None
    place: int = 0
    #: From the first open hold on: [place, at, n, accepted before, held, has a later reading near it].
    open: list[list] = field(default_factory=list)

    def _judged(self, row: list, accepted: int | None) -> int | None:
        """Judges a row after an accepted count; what is accepted after it."""
        low = accepted is not None and accepted >= self.floor and row[2] < self.shrink * accepted
        row[3], row[4] = accepted, low and not row[5]
        return accepted if row[4] else row[2]

    def add(self, at, n: int) -> list[tuple]:
        first = None  # the earliest held reading that this one releases
        for i, row in enumerate(self.open):
            if not row[5] and abs(n - row[2]) <= self.agree * max(row[2], 1):
                row[5] = True
                first = i if first is None and row[4] else first
        new = [self.place, at, n, None, False, False]
        self.place += 1
        self.open.append(new)
        told = [new]
        if first is None:
            self.accepted = self._judged(new, self.accepted)
        else:
            accepted = self.open[first][3]
            for row in self.open[first:-1]:
                was = (row[3], row[4])
                accepted = self._judged(row, accepted)
                if (row[3], row[4]) != was:
                    told.append(row)
            self.accepted = self._judged(new, accepted)
        start = next((i for i, row in enumerate(self.open) if row[4]), len(self.open))
        del self.open[:start]
        return [tuple(row[:5]) for row in told]

    def text(self) -> str:
        return json.dumps([self.accepted, self.place, self.open])

    def restore(self, text: str) -> Judge:
        self.accepted, self.place, self.open = json.loads(text)
        return self


def judged(readings: DataFrame, group: str, at: str, n: str, **rules) -> DataFrame:
    """readings with `accepted` and `held`.  Units are dealt to tasks and read in order as a stream; a task holds of one unit
    what is still open."""
    kind = dict(readings.dtypes)
    rows = readings.select(group, at, F.col(n).cast("bigint").alias(n)).repartition(group).sortWithinPartitions(group, at, n)
    arrow = {}

    def batch(out: list[tuple], types) -> pa.RecordBatch:
        columns = [*zip(*out)] or [()] * 5
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (*types, pa.int64(), pa.int64(), pa.bool_()))], [group, at, n, "accepted", "held"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, judge, last = None, None, {}
        for b in batches:
            types, out = (b.schema.field(0).type, b.schema.field(1).type), []
            arrow["types"] = types
            for g, t, x in zip(*(c.to_pylist() for c in b.columns)):
                if judge is None or g != key:
                    out += [(key, *r[1:]) for r in last.values()]
                    key, judge, last = g, Judge(**rules), {}
                for r in judge.add(t, x):
                    last[r[0]] = r
                begin = judge.open[0][0] if judge.open else judge.place
                out += [(key, *last.pop(p)[1:]) for p in [p for p in last if p < begin]] if len(last) > len(judge.open) else []
            yield batch(out, types)
        if last:
            yield batch([(key, *r[1:]) for r in last.values()], arrow["types"])

    return rows.mapInArrow(run, f"`{group}` {kind[group]}, `{at}` {kind[at]}, `{n}` bigint, accepted bigint, held boolean")


def _processor(rules: dict):
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    class Holds(StatefulProcessor):
        """Readings wait until the watermark has passed them, so that late ones take their place; then they are judged in order."""

        def init(self, handle) -> None:
            self.handle = handle
            self.state = handle.getValueState("judge", "text string")
            self.waiting = handle.getMapState("waiting", "at long, n long", "copies int")

        def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
            for frame in rows:
                for at, n in zip(frame["at"].astype("int64") // 1000 if frame["at"].dtype == "datetime64[ns]" else frame["at"].astype("datetime64[us]").astype("int64"), frame["n"]):
                    k = (int(at), int(n))
                    self.waiting.updateValue(k, ((self.waiting.getValue(k)[0] if self.waiting.containsKey(k) else 0) + 1,))
                    self.handle.registerTimer(int(at) // 1000 + 1)
            return iter(())

        def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
            now = timerValues.getCurrentWatermarkInMs()
            due = sorted(k for k in self.waiting.keys() if k[0] // 1000 < now)
            if not due:
                return
            judge = Judge(**rules)
            if self.state.exists():
                judge.restore(self.state.get()[0])
            told = []
            for k in due:
                for _ in range(self.waiting.getValue(k)[0]):
                    turn = judge.place
                    told += [(key[0], *r, turn) for r in judge.add(*k)]
                self.waiting.removeKey(k)
            self.state.update((judge.text(),))
            out = pd.DataFrame(told, columns=["unit", "place", "at", "n", "accepted", "held", "turn"])
            out["accepted"] = out["accepted"].astype("Int64")
            yield out

        def close(self) -> None:
            pass

    return Holds()


def stream(readings: DataFrame, late: str = "10 days", **rules) -> DataFrame:
    """unit, place, at (microseconds), n, accepted, held, turn of a stream readings(unit string, at timestamp, n): a row for each
    reading once the watermark has passed it, and another one when a later reading changes it.  The row of the highest turn
    holds for a place: see latest().  The session needs the state store of STORE."""
    timed = readings.select("unit", "at", "n").withWatermark("at", late)
    return timed.groupBy("unit").transformWithStateInPandas(_processor(rules), "unit string, place long, at long, n long, accepted long, held boolean, turn long", "Append", "EventTime")


#: The state store that keeps state of such operators.
STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def latest(told: DataFrame) -> DataFrame:
    """What holds of each reading in the end."""
    return told.groupBy("unit", "place").agg(F.max_by(F.struct("at", "n", "accepted", "held"), "turn").alias("x")).select("unit", F.timestamp_micros("x.at").alias("at"), "x.n", "x.accepted", "x.held")
