"""The ledger's doctor as a stream: records and files come as versions, late, repeated or withdrawn, and every chunk's flags are kept up to date.

A chunk's state is the last version of its record and of its file. An older version than the last changes nothing, nor does
one that comes again, so the state is that of all events in whatever order they came. A withdrawal is a version too: it hides what
came before, and later versions bring the chunk back. Hidden sides are remembered until the watermark has passed them by ``keep``;
then a timer clears them, as no older version can come any more.

After each batch, the last row of each chunk has the flags that ``operators.corpus.reconcile_records`` gives for the same versions (chunks
without a record have no flags).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

#: What a stream of events must have: which side (``record`` or ``file``), its version and time, and what it says.
EVENTS = "chunk string, side string, version long, at timestamp, withdrawn boolean, status string, source_hash string, output_hash string"
FLAGS = ("missing", "orphan", "edited", "stale", "unstamped")
OUT = "chunk string, known boolean, " + ", ".join(f"{f} boolean" for f in FLAGS)
_SIDE = "version bigint, at_ms bigint, withdrawn boolean, status string, source_hash string, output_hash string"

#: One side of a chunk: version, time, withdrawn, status, source hash, output hash.
Side = tuple


def flags(record: Side | None, file: Side | None) -> tuple:
    """``known`` and the flags of one chunk, from the last version of either side."""
    if record is None or record[2]:
        return (False, *[False] * len(FLAGS))
    _, _, _, status, source, output = record
    source_now, output_now = (None, None) if file is None or file[2] else (file[4], file[5])
    done, there = status is not None and status != "pending", output_now is not None
    edited = there and output is not None and output != output_now
    stale = done and source is not None and source_now is not None and source != source_now
    return True, done and not there, status == "pending" and there, edited, stale, done and output is None


class Doctor(StatefulProcessor):
    """State and timers of one chunk."""

    def __init__(self, keep_ms: int) -> None:
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.sides = {side: handle.getValueState(side, _SIDE) for side in ("record", "file")}

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last = {side: tuple(state.get()) if state.exists() else None for side, state in self.sides.items()}
        before = dict(last)
        for frame in rows:
            for r in frame.sort_values("version").itertuples(index=False):
                if r.side in last and (last[r.side] is None or r.version > last[r.side][0]):
                    text = lambda v: None if pd.isna(v) else v
                    last[r.side] = (int(r.version), int(r.at.value // 1_000_000), bool(r.withdrawn), text(r.status), text(r.source_hash), text(r.output_hash))
        for side, value in last.items():
            if value != before[side]:
                self.sides[side].update(value)
                if value[2]:
                    self.handle.registerTimer(value[1] + self.keep_ms)
        yield pd.DataFrame([(key[0], *flags(last["record"], last["file"]))], columns=["chunk", "known", *FLAGS])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        for state in self.sides.values():
            if state.exists():
                now = tuple(state.get())
                if now[2] and now[1] + self.keep_ms <= expiredTimerInfo.getExpiryTimeInMs():
                    state.clear()
        yield from ()

    def close(self) -> None:
        pass


def watched(events: DataFrame, delay: str = "10 minutes", keep_ms: int = 3_600_000) -> DataFrame:
    """A stream of ``EVENTS`` to rows of ``OUT``, one for each chunk that a batch touches (update mode).

    The session must keep state in RocksDB (``spark.sql.streaming.stateStore.providerClass``). Events without a chunk belong to the null chunk.
    """
    return events.withWatermark("at", delay).groupBy("chunk").transformWithStateInPandas(Doctor(keep_ms), outputStructType=OUT, outputMode="Update", timeMode="EventTime")
