"""As-of values on streams: actions and changes of two streams meet in event-time order.

Users are dealt into buckets. Rows wait in the state of their bucket, by stretch of event time, until the watermark passes the
end of the stretch. Then no row of it can come any more; the stretch is sorted and folded, and the values in force for each
user after it stay in the state. Calls to the state grow with buckets and stretches, not with users or rows. So the result does not depend on the order of arrival, as long as no row is more than ``delay`` late; later rows
are dropped. A task holds the rows of one bucket's stretch. Rows without a time count when they arrive.

A bounded stream must end with a row that moves the clock on, such as a heartbeat; what waits for the watermark is not
lost, but not told either.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from operator import itemgetter

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from tempera.functions.clock import micros
from tempera.operators import sequence
from tempera.streaming.stretches import BUCKETS, DELAY, bucket_of, with_state_variables

STRETCH_SECONDS = 3600.0
CHANGE, ACTION = 0, 1
ROWS = ["at", "kind", "has_id", "id", "key", "action", "change"]
HELD_ROWS = 100_000  # rows that a task gathers before it writes them to the state, or tells them


class Meet(StatefulProcessor):
    """Rows of a bucket by stretch until their time has passed, then the values in force for each action.

    The values in force are one text for each user. One timer waits for the end of the first stretch.
    """

    def __init__(self, initial: dict[str, object], width_ms: int):
        self.initial, self.width = json.dumps(initial), width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.now = handle.getValueState("now", "users string")
        self.waiting = handle.getMapState("waiting", "stretch bigint, part bigint", "many string")
        self.parts = handle.getMapState("parts", "stretch bigint", "n bigint")
        self.until = handle.getValueState("until", "until bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        untimed: list[tuple] = []
        came: dict[int, list[tuple]] = defaultdict(list)
        held, first = 0, None
        for batch in rows:
            for timed, row in zip(batch["timed"].tolist(), zip(*(batch[c].tolist() for c in ROWS), strict=True), strict=True):
                if timed:
                    came[row[0] // (self.width * 1000)].append(row)
                else:
                    untimed.append(row)
            held += len(batch)
            if held >= HELD_ROWS:
                first = self._keep(came, first)
                held = 0
        first = self._keep(came, first)
        if untimed:
            users = self._users()
            yield self._told(users, untimed)
            self._put(users)
        if first is not None:
            self._wait(first)

    def _keep(self, came: dict[int, list[tuple]], first: int | None) -> int | None:
        """Write rows to the state, each stretch as another part; the first stretch so far."""
        for stretch, rows in came.items():
            old = self.parts.getValue((stretch,)) if self.parts.exists() and self.parts.containsKey((stretch,)) else None
            part = 0 if old is None else int(old[0])
            self.waiting.updateValue((stretch, part), (json.dumps(rows),))
            self.parts.updateValue((stretch,), (part + 1,))
        first = min((s for s in (first, *came) if s is not None), default=None)
        came.clear()
        return first

    def _wait(self, stretch: int, fired: int | None = None) -> None:
        """Have the timer at the end of ``stretch`` unless it is earlier. One that has ``fired`` deletes itself."""
        until, old = (stretch + 1) * self.width, self.until.get()[0] if self.until.exists() else None
        if old is None or old == fired or until < old:
            if old is not None and old != fired:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(until)
            self.until.update((until,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Tell all stretches that are past, in the order of time, and wait for the next one."""
        passed = timerValues.getCurrentWatermarkInMs() // self.width
        stretches = sorted(int(k[0]) for k in self.parts.keys())
        users, rows = self._users(), []
        for stretch in (s for s in stretches if s < passed):
            for part in range(int(self.parts.getValue((stretch,))[0])):
                rows += json.loads(self.waiting.getValue((stretch, part))[0])
                self.waiting.removeKey((stretch, part))
            self.parts.removeKey((stretch,))
            if len(rows) >= HELD_ROWS:
                yield self._told(users, rows)
                rows = []
        if rows:
            yield self._told(users, rows)
        self._put(users)
        later = [s for s in stretches if s >= passed]
        if later:
            self._wait(later[0], expiredTimerInfo.getExpiryTimeInMs())
        else:
            self.until.clear()

    def _users(self) -> dict[str | None, str]:
        return dict(json.loads(self.now.get()[0])) if self.now.exists() else {}

    def _put(self, users: dict[str | None, str]) -> None:
        if users:
            self.now.update((json.dumps(list(users.items())),))

    def _told(self, users: dict[str | None, str], rows: list[tuple]) -> pd.DataFrame:
        """Fold rows of whole stretches in order. At equal times a change comes before an action, and a row without an id first."""
        out = []
        for _, kind, _, _, user, action, change in sorted(rows, key=itemgetter(0, 1, 2, 3)):
            if kind == ACTION:
                out.append((action, users.get(user, self.initial)))
            else:  # NULL values are not in the text: they changed nothing
                users[user] = json.dumps({**json.loads(users.get(user, self.initial)), **json.loads(change)})
        return pd.DataFrame(out, columns=["action", "change"])

    def close(self) -> None:
        pass


EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def stream_as_of(
    actions: DataFrame,
    changes: DataFrame,
    values: dict[str, object],
    key: str = "user_id",
    ts: str = "ts",
    order_id: str = "event_id",
    delay: str = DELAY,
    stretch_seconds: float = STRETCH_SECONDS,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``sequence.as_of`` on two streams: adds to each action the values in force at its time.

    Actions come out when the watermark has passed their stretch.
    """
    with_state_variables(actions.sparkSession)
    told_as = actions.schema, changes.select(*values).schema
    nothing = F.lit(None).cast("string")

    def rows(stream: DataFrame, kind: int, action: Column, change: Column) -> DataFrame:
        # Rows travel as text: a frame would turn whole numbers beside NULLs into floats.
        timed = stream.withColumn("event_time", F.col(ts).cast("timestamp")).withWatermark("event_time", delay)
        nought = F.lit(0).cast(stream.schema[order_id].dataType)
        return timed.select(
            F.col(key).cast("string").alias("key"),  # see ``stretches.cut``
            "event_time",
            # A number beside a NULL one would reach Python as a float.
            F.col(ts).isNotNull().alias("timed"),
            F.coalesce(micros(ts), F.lit(0)).alias("at"),
            F.lit(kind).alias("kind"),
            F.col(order_id).isNotNull().alias("has_id"),
            F.coalesce(F.col(order_id), nought).alias("id"),
            action.alias("action"),
            change.alias("change"),
        ).withColumn("bucket", bucket_of("key", buckets))

    mine = rows(actions, ACTION, F.to_json(F.struct(*actions.columns), EXACT), nothing)
    both = mine.unionByName(rows(changes, CHANGE, nothing, F.to_json(F.struct(*values), EXACT)))
    processor = Meet(dict(values), round(stretch_seconds * 1000))
    told = both.groupBy("bucket").transformWithStateInPandas(processor, "action string, change string", "append", "EventTime")
    read = [F.from_json(c, t, EXACT).alias(c) for c, t in zip(("action", "change"), told_as, strict=True)]
    return told.select(*read).select("action.*", "change.*")


def stream_refresh_requests(
    clicks: DataFrame,
    detections: DataFrame,
    resets: DataFrame | None = None,
    preferences: tuple[DataFrame, dict[str, object]] | None = None,
    delay: str = DELAY,
) -> DataFrame:
    """``sequence.refresh_requests`` on streams; with the stream of ``preferences`` and their first values also what
    they are at the time of a click, in the same pass."""

    def find(actions: DataFrame, changes: DataFrame, values: dict[str, object]) -> DataFrame:
        if preferences:
            changes = changes.unionByName(preferences[0], allowMissingColumns=True)
            values = {**preferences[1], **values}
        return stream_as_of(actions, changes, values, delay=delay)

    return sequence.refresh_requests(clicks, detections, resets, find=find)
