"""Alert rules on a stream: pending, firing and resolved, and targets that fall silent.

Requests are counted natively per key and step; only these few counts reach the state. The
state is one row a key: the counts of the longest window, and since when each rule holds.
Event-time timers go on evaluating a key for which nothing arrives, so a run ends, or a
target counts as down, while it is still silent.
"""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.streaming.query import StreamingQuery

from hourgrid.operators.alerts import LATENCY_BOUNDS, bucket_counts
from hourgrid.streaming.jobs import LATENESS, append_to

KEYED_STATE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@dataclass(frozen=True)
class Rule:
    """``measure`` over the trailing ``span`` seconds above ``limit``, for ``hold`` seconds on end.

    Measures: ``rate`` (requests a second), ``ratio`` (failed of all), ``quantile`` (the
    ``q``-quantile of the histogram of values; unknown above its last bound).
    """

    name: str
    measure: str
    limit: float
    span: int
    hold: int
    q: float = 0.95

    def holds(self, counts: Sequence[int], bounds: Sequence[float]) -> bool:
        requests, failed, *buckets = counts
        if not requests:
            return False
        if self.measure == "rate":
            return requests / float(self.span) > self.limit
        if self.measure == "ratio":
            return failed / requests > self.limit
        value = histogram_quantile(buckets, bounds, self.q)
        return value is not None and value > self.limit


def histogram_quantile(buckets: Sequence[int], bounds: Sequence[float], q: float) -> float | None:
    """Quantile interpolated in its bucket; unknown if it lies above the last bound."""
    rank, below, lower = sum(buckets) * q, 0, 0.0
    for count, upper in zip(buckets, bounds):
        if count and below + count >= rank:
            return lower + (upper - lower) * (rank - below) / count
        below, lower = below + count, upper
    return None


class AlertState(StatefulProcessor):
    """Evaluates all rules of a key at every step that the watermark has passed."""

    def __init__(self, keys: Sequence[str], rules: Sequence[Rule], step: int, bounds: Sequence[float]):
        self.change = Row(*keys, "rule", "state", "at", "since")
        self.rules, self.step, self.bounds = list(rules), step, list(bounds)
        self.span = max(r.span for r in rules)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("alerts", "state string")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self._advance(key, [(r.pane_end, list(r.counts)) for r in rows], timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._advance(key, [], timerValues.getCurrentWatermarkInMs())

    def _advance(self, key, new: list[tuple[int, list[int]]], watermark: int) -> Iterator[Row]:
        """Evaluate up to the watermark; all counts of steps that end before it have arrived."""
        known = json.loads(self.state.get()[0]) if self.state.exists() else {"next": None, "panes": [], "since": {}, "firing": []}
        since, firing, at = known["since"], set(known["firing"]), known["next"]
        coming = deque(sorted([*map(tuple, known["panes"]), *new]))
        window: deque[tuple[int, list[int]]] = deque()
        at = coming[0][0] if at is None and coming else at
        while at is not None and at * 1000 <= watermark:
            while coming and coming[0][0] <= at:
                window.append(coming.popleft())
            while window and window[0][0] <= at - self.span:
                window.popleft()
            for rule in self.rules:
                inside = [counts for end, counts in window if end > at - rule.span]
                if rule.holds([sum(c) for c in zip(*inside)] or [0, 0], self.bounds):
                    if rule.name not in since:
                        since[rule.name] = at
                        yield self.change(*key, rule.name, "pending", at, at)
                    if rule.name not in firing and at - since[rule.name] >= rule.hold:
                        firing.add(rule.name)
                        yield self.change(*key, rule.name, "firing", at, since[rule.name])
                elif rule.name in since:
                    state = "resolved" if rule.name in firing else "lapsed"
                    firing.discard(rule.name)
                    yield self.change(*key, rule.name, state, at, since.pop(rule.name))
            at += self.step
            if not window and not since:  # nothing can hold before something arrives
                at = max(at, coming[0][0]) if coming else None
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if at is None:
            self.state.clear()
            return
        self.state.update((json.dumps({"next": at, "panes": [*window, *coming], "since": since, "firing": sorted(firing)}),))
        self.handle.registerTimer(at * 1000)

    def close(self) -> None:
        pass


class SilenceState(StatefulProcessor):
    """Says that a target is down once it has been silent for ``limit``, and when it is up again."""

    def __init__(self, keys: Sequence[str], limit: int):
        self.change = Row(*keys, "state", "at", "last_seen")
        self.limit = limit * 1_000_000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("beat", "last long, down boolean")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last, down = self.state.get() if self.state.exists() else (None, False)
        for r in sorted(rows, key=lambda r: r.first):
            if last is not None and r.first - last > self.limit:
                if not down:
                    yield self.change(*key, "down", last + self.limit, last)
                yield self.change(*key, "up", r.first, last)
                down = False
            last = r.last if last is None else max(last, r.last)
        yield from self._wait(key, last, down, timerValues.getCurrentWatermarkInMs())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        last, down = self.state.get()
        yield from self._wait(key, last, down, timerValues.getCurrentWatermarkInMs())

    def _wait(self, key, last: int, down: bool, watermark: int) -> Iterator[Row]:
        """Down at last beat + limit, said once no beat before that can still come out of its slot."""
        certain = (last // self.limit + 2) * self.limit // 1000
        if not down and certain <= watermark:
            down = True
            yield self.change(*key, "down", last + self.limit, last)
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        self.state.update((last, down))
        if not down:
            self.handle.registerTimer(certain)

    def close(self) -> None:
        pass


def alert_changes(requests: DataFrame, keys: Sequence[str], ts: str, rules: Sequence[Rule], failed: Column,
                  value: Column | None = None, step: int = 60, bounds: Sequence[float] = tuple(LATENCY_BOUNDS),
                  lateness: str = LATENESS) -> DataFrame:
    """(keys, rule, state, at, since): every change of a rule's state, on a stream of requests.

    A rule is evaluated for a key at the end of every step, once the watermark has passed
    it. It is ``pending`` when it first holds, ``firing`` once it has held for its hold,
    and then ``resolved``, or ``lapsed`` if it did not last. A window without requests
    holds nothing. Spans and holds are whole numbers of steps. Requests behind the
    watermark are left out, and counted in the metrics of the query.
    """
    if any(r.span % step or r.hold % step for r in rules):
        raise ValueError("spans and holds must be whole numbers of steps")
    counters = [F.count(F.lit(1)).alias("__n"), F.count_if(failed).alias("__f")]
    counters += bucket_counts(value, bounds) if value is not None else []
    names = ["__n", "__f", *(f"__b{i}" for i in range(len(counters) - 2))]
    panes = requests.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, f"{step} seconds").alias("__w")).agg(*counters)
    panes = panes.select(*keys, F.window_time("__w").alias("__t"), F.unix_seconds("__w.end").alias("pane_end"),
                         F.array(*names).alias("counts"))
    kinds = ", ".join(f"{c} {panes.schema[c].dataType.simpleString()}" for c in keys)
    changes = panes.groupBy(*keys).transformWithState(
        AlertState(keys, rules, step, bounds), f"{kinds}, rule string, state string, at long, since long", "append", "EventTime")
    return changes.withColumns({c: F.timestamp_seconds(c) for c in ("at", "since")})


def silences(beats: DataFrame, keys: Sequence[str], ts: str, limit: int, lateness: str = LATENESS) -> DataFrame:
    """(keys, state, at, last_seen): when a target goes ``down`` and comes ``up``, on a stream of beats.

    A target is down ``limit`` seconds after its last beat; that is said by a timer, while it
    is still silent. Beats are first reduced to the first and last one per slot of ``limit``
    seconds: no longer silence fits inside a slot.
    """
    slots = beats.withWatermark(ts, lateness).groupBy(*keys, F.window(ts, f"{limit} seconds").alias("__w")).agg(
        F.unix_micros(F.min(ts)).alias("first"), F.unix_micros(F.max(ts)).alias("last"))
    slots = slots.select(*keys, F.window_time("__w").alias("__t"), "first", "last")
    kinds = ", ".join(f"{c} {slots.schema[c].dataType.simpleString()}" for c in keys)
    changes = slots.groupBy(*keys).transformWithState(
        SilenceState(keys, limit), f"{kinds}, state string, at long, last_seen long", "append", "EventTime")
    return changes.withColumns({c: F.timestamp_micros(c) for c in ("at", "last_seen")})


@contextmanager
def keyed_state(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep timers, which need the state store made for them."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, KEYED_STATE)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def append_changes(changes: DataFrame, path: str, checkpoint: str,
                   start: Callable[[DataFrame, str, str], StreamingQuery] = append_to) -> StreamingQuery:
    """Start a stream of ``alert_changes`` or ``silences`` into a Parquet folder."""
    with keyed_state(changes.sparkSession):
        return start(changes, path, checkpoint)
