"""Failure streaks of attempts that arrive out of order, kept in the state store."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..operators.crawlplan import FAILURE_LIMIT
from ..session import state_store

#: Slices of the delay in which attempts wait together.
SLICES = 16
#: Groups of sources that keep their state together. A step of the state costs far more than a row.
BUCKETS = 512
OUTPUT = "source string, ts timestamp, ord long, streak long, open boolean"
_WAITING = pa.schema([("source", pa.string()), ("us", pa.int64()), ("ord", pa.int64()), ("fail", pa.bool_())])


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as writer:
        writer.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(data))).read_all()


def _running(rows: pa.Table, before: dict[str, int], limit: int) -> tuple[pd.DataFrame, dict[str, int]]:
    """Output rows of the attempts of a slice, and the open streaks of all sources behind it."""
    rows = rows.sort_by([(name, "ascending") for name in rows.column_names])
    source, fail = rows.column("source").to_pandas().to_numpy(), rows.column("fail").to_numpy()
    first = np.append(True, source[1:] != source[:-1])
    failed = np.cumsum(fail, dtype=np.int64)
    # Failures counted up to where the streak of a row begins; a source's first row goes on with what it had before.
    base = np.where(fail, failed - 1, failed)
    base[first] -= np.where(fail[first], [before.get(s, 0) for s in source[first]], 0)
    streak = failed - base[np.maximum.accumulate(np.where(first | ~fail, np.arange(len(fail)), 0))]
    last = np.append(first[1:], True)
    after = {**before, **dict(zip(source[last].tolist(), streak[last].tolist()))}
    out = pd.DataFrame({
        "source": source, "ts": pd.to_datetime(rows.column("us").to_numpy(), unit="us", utc=True),
        "ord": rows.column("ord").to_pandas(), "streak": streak, "open": streak >= limit})
    return out, {s: n for s, n in after.items() if n}


class _Streaks(StatefulProcessor):
    """Attempts wait until the watermark has passed their time and are then counted in order.

    State of a bucket of sources: the open streaks, and the waiting attempts under the end of their slice of time in
    milliseconds, a part for each time that some came. A timer stands at each of these ends, so a timer reads the attempts of one slice only.
    """

    def __init__(self, limit: int, slice_ms: int):
        self.limit, self.slice_ms = limit, slice_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.streak = handle.getValueState("streak", "source array<string>, streak array<long>")
        self.parts = handle.getMapState("parts", "ms long", "parts long")
        self.waiting = handle.getMapState("waiting", "ms long, part long", "rows binary")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for frame in rows:
            frame = frame[frame["source"].notna()]
            ms = (frame["us"].to_numpy() // (1000 * self.slice_ms) + 1) * self.slice_ms
            order = np.argsort(ms, kind="stable")
            table = pa.Table.from_pandas(frame, _WAITING, preserve_index=False).take(pa.array(order))
            ends, starts = np.unique(ms[order], return_index=True)
            for end, at, upto in zip(ends.tolist(), starts.tolist(), [*starts.tolist()[1:], len(ms)]):
                held = 0
                if self.parts.containsKey((end,)):
                    held = self.parts.getValue((end,))[0]
                else:
                    self.handle.registerTimer(end)
                self.waiting.updateValue((end, held), (_packed(table.slice(at, upto - at)),))
                self.parts.updateValue((end,), (held + 1,))
        return iter([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs()
        found = []
        for part in range(self.parts.getValue((end,))[0]):
            found.append(_unpacked(self.waiting.getValue((end, part))[0]))
            self.waiting.removeKey((end, part))
        self.parts.removeKey((end,))
        before = dict(zip(*self.streak.get())) if self.streak.exists() else {}
        out, after = _running(pa.concat_tables(found), before, self.limit)
        if after != before:
            self.streak.update((list(after), list(after.values())))
        yield out

    def close(self) -> None:
        pass


def streak_state_stream(attempts: DataFrame, out: str, checkpoint: str, delay: str = "1 hour",
                        limit: int = FAILURE_LIMIT) -> StreamingQuery:
    """Running failure streak per source of a stream ``(source, ts, ord, fail)`` whose files come in any order.

    An attempt is counted once the watermark (latest ``ts`` seen less ``delay``) has passed the slice of time it lies in (a
    sixteenth of the delay: a bucket of sources costs a few steps of its state a slice, whatever it holds), so the rows are
    those of the batch operator ordered by (``ts``, ``ord``), however files mix within the delay. An attempt that comes
    later than that changes no streak and has no row; the query's progress counts it (``numRowsDroppedByWatermark``).
    A NULL ``fail`` is no failure. Rows with a NULL source only move the watermark: one of them far enough ahead
    closes a feed. Rows without a time are left out.

    A batch touches the state of the buckets of its own sources and of expired timers; waiting attempts are written once, the open
    streaks of a bucket with every slice of it. All attempts of a bucket in one batch meet in one task, some slices at a time:
    a source that holds a large part of a *table* is the batch operator's (`failure_streaks`), or `streak_stream`'s for an ordered feed.

    The state has several variables, which only the store on disk holds: the stream takes it in any session.
    """
    timed = attempts.withColumn("ts", F.col("ts").cast("timestamp")).filter("ts is not null").withWatermark("ts", delay)
    rows = timed.select(
        F.pmod(F.xxhash64("source"), F.lit(BUCKETS)).cast("int").alias("bucket"),
        "source", "ts", F.unix_micros("ts").alias("us"), "ord", F.coalesce("fail", F.lit(False)).alias("fail"))
    span = attempts.sparkSession.range(1).select(F.unix_millis(F.timestamp_seconds(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]
    counted = rows.groupBy("bucket").transformWithStateInPandas(
        _Streaks(limit, max(1, span // SLICES)), OUTPUT, "Append", "EventTime")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with state_store(attempts.sparkSession):
        return counted.writeStream.foreachBatch(write).outputMode("append").option("checkpointLocation", checkpoint).trigger(
            availableNow=True).start()
