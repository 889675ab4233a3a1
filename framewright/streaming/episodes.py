"""Gripper states and no-ops of episodes as their frames arrive, equal to the batch operators once an episode is closed.

Frames of an episode may arrive in any order within ``delay`` of its own clock ``ts``: they wait until the episode has a
frame later by more than that, and are then taken in order. A frame older than what was taken is late: it comes out marked,
without results, for a side table (``split_late``). An episode closes when nothing of it has arrived for ``idle_ms`` on the
stream's watermark, the column ``arrived``; its state is then let go, and what arrives afterwards begins a new episode.

State lives in Spark's state store by episode: frames that wait for their turn, frames that wait for the gripper's next
state or first move, and a row of what is carried. It is restored from the checkpoint like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_FRAME = "ts long, id long, grip double, move double, arm double"
_WAITS = "ts long, id long, noop boolean, state double, absolute double"
#: taken: the last frame taken; newest: the latest seen; before: the gripper of the last frame; carried: its absolute state.
_CARRIED = "taken long, taken_id long, newest long, moved boolean, before double, carried double, timer long"

_OUT = Row("episode", "ts", "id", "state", "absolute", "noop", "late")


class _Frames(StatefulProcessor):
    def __init__(self, delay: int, idle_ms: int, high: float, low: float, step: float, rest: float):
        self.delay, self.idle_ms, self.high, self.low, self.step, self.rest = delay, idle_ms, high, low, step, rest

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pending = handle.getListState("pending", _FRAME)
        self.waiting = handle.getListState("waiting", _WAITS)
        self.carried = handle.getValueState("carried", _CARRIED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        taken, taken_id, newest, moved, before, carried, timer = self.carried.get() if self.carried.exists() else (None, None, None, False, None, None, None)
        pending = [tuple(p) for p in self.pending.get()] if self.pending.exists() else []
        arrived = 0
        for r in rows:
            arrived = max(arrived, r.arrived)
            if taken is not None and (r.ts, r.id) <= (taken, taken_id):
                yield _OUT(*key, r.ts, r.id, None, None, None, True)
                continue
            pending.append((r.ts, r.id, r.grip, r.move, r.arm))
            newest = r.ts if newest is None else max(newest, r.ts)
        pending.sort(key=lambda p: p[:2])
        ready = [p for p in pending if p[0] < newest - self.delay] if newest is not None else []
        state = [taken, taken_id, newest, moved, before, carried, timer]
        yield from self._take(key, ready, state)
        self.pending.put(pending[len(ready) :]) if len(pending) > len(ready) else self.pending.clear()
        due = arrived + self.idle_ms
        if timer is None or due > timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self.handle.registerTimer(due)
            state[6] = due
        self.carried.update(tuple(state))

    def _take(self, key, frames: list[tuple], state: list) -> Iterator[Row]:
        """Frames in order: what is decided comes out, the rest waits."""
        if not frames:
            return
        waiting = [list(w) for w in self.waiting.get()] if self.waiting.exists() else []
        _, _, _, moved, before, carried, _ = state
        for ts, i, grip, move, arm in frames:
            rests = None if arm is None else arm < self.rest
            same = True if not moved else None if grip is None or before is None else grip == before
            noop = False if rests is False or same is False else None if rests is None or same is None else True
            turn = None if move is None else 1.0 if move < -self.step else -1.0 if move > self.step else None
            if turn is not None:
                if carried is None:
                    for w in waiting:
                        w[4] = -turn / 2.0 + 0.5
                carried = turn
            waiting.append([ts, i, noop, None, None if carried is None else carried / 2.0 + 0.5])
            reached = None if grip is None else 1.0 if grip > self.high else 0.0 if grip < self.low else None
            if reached is not None:
                for w in waiting:
                    w[3] = reached if w[3] is None else w[3]
            moved, before = moved or rests is False, grip
            done = 0
            while done < len(waiting) and waiting[done][3] is not None and waiting[done][4] is not None:
                ts0, i0, noop0, state0, absolute0 = waiting[done]
                yield _OUT(*key, ts0, i0, state0, absolute0, noop0, False)
                done += 1
            waiting = waiting[done:]
        state[0], state[1], state[3], state[4], state[5] = frames[-1][0], frames[-1][1], moved, before, carried
        self.waiting.put([tuple(w) for w in waiting]) if waiting else self.waiting.clear()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        """Nothing has come for long: what is pending is taken, what waits gets what the end decides."""
        if not self.carried.exists():
            return
        state = list(self.carried.get())
        yield from self._take(key, sorted((tuple(p) for p in self.pending.get()), key=lambda p: p[:2]) if self.pending.exists() else [], state)
        for ts, i, noop, reached, absolute in list(self.waiting.get()) if self.waiting.exists() else []:
            yield _OUT(*key, ts, i, state[4] if reached is None else reached, 1.0 if absolute is None else absolute, noop, False)
        self.pending.clear()
        self.waiting.clear()
        self.carried.clear()

    def close(self) -> None:
        pass


def frame_states(stream: DataFrame, episode: str, ts: str, frame_id: str, grip: str, move: str, arm: str, arrived: str, delay: int, idle_ms: int, lateness: str = "0 seconds", high: float = 0.95, low: float = 0.05, step: float = 0.1, rest: float = 1e-4) -> DataFrame:
    """(episode, ts, id, state, absolute, noop, late) of a stream of frames.

    ts: a whole number, the episode's clock; frame_id tells frames of one time apart and orders them; arrived: a
    timestamp that watermarks go by. state: the binary gripper; absolute: the gripper from relative moves; noop: whether
    the arm rests and the gripper is as in the frame before (or nothing has moved yet). Frames with a null ts are late.
    """
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    kind = stream.schema[episode].dataType.simpleString()
    v = stream.withWatermark(arrived, lateness).select(
        F.col(episode).alias("episode"), F.coalesce(F.col(ts).cast("long"), F.lit(-(1 << 62))).alias("ts"), F.col(frame_id).cast("long").alias("id"), F.col(grip).cast("double").alias("grip"),
        F.col(move).cast("double").alias("move"), F.col(arm).cast("double").alias("arm"), F.unix_millis(arrived).alias("arrived"), F.col(arrived).alias("__clock"),
    )
    out = f"episode {kind}, ts long, id long, state double, absolute double, noop boolean, late boolean"
    return v.groupBy("episode").transformWithState(_Frames(delay, idle_ms, high, low, step, rest), out, "Append", "EventTime")


def split_late(states: DataFrame, target: str, late: str, checkpoint: str):
    """A query that appends results to one table and late frames to another, each batch once.

    A batch's rows are written under its number, so a batch that is taken again after a failure replaces itself.
    """

    def put(batch: DataFrame, number: int) -> None:
        batch.persist()
        for where, part in ((target, batch.where("not late").drop("late")), (late, batch.where("late").select("episode", "ts", "id"))):
            part.write.mode("overwrite").parquet(f"{where}/batch={number}")
        batch.unpersist()

    return states.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).outputMode("append")


def by_batches(frames: Callable[[], DataFrame], target: str, late: str, checkpoint: str) -> None:
    """Take all there is so far, then stop; called again, go on where the checkpoint says."""
    split_late(frames(), target, late, checkpoint).trigger(availableNow=True).start().awaitTermination()
