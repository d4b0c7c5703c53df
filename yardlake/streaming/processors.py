"""Stateful operators of the streams, one key at a time, over RocksDB state: what a batch does for a key depends on its new
events and on what lies next to them in time, not on how much the key keeps."""

from __future__ import annotations

import json
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from yardlake.operators.status import ATTRIBUTES

#: Width of a bucket of event times, in microseconds.
BUCKET = 6 * 3600 * 1_000_000


def less(a: str | None, b: str | None) -> str | None:
    """Of two trucks at one time the least; none comes last."""
    return a if b is None or (a is not None and a <= b) else b


class Timeline:
    """INs and OUTs of a key by time, in buckets that are loaded when they are needed.

    A side is a sorted list of the buckets that it has something in, and the buckets: time -> truck. It is read by `load`; what
    has changed is in `dirty`.
    """

    def __init__(self, index: dict[str, list[int]], load):
        self.index, self.load = index, load
        self.held: dict[tuple[str, int], dict[int, str | None]] = {}
        self.dirty: set[tuple[str, int]] = set()

    def copy(self) -> Timeline:
        out = Timeline({s: list(v) for s, v in self.index.items()}, self.load)
        out.held = {k: dict(v) for k, v in self.held.items()}
        return out

    def bucket(self, side: str, b: int) -> dict[int, str | None]:
        if (side, b) not in self.held:
            at = bisect_left(self.index[side], b)
            known = at < len(self.index[side]) and self.index[side][at] == b
            self.held[side, b] = self.load(side, b) if known else {}
        return self.held[side, b]

    def put(self, side: str, t: int, truck: str | None) -> None:
        b = t // BUCKET
        times = self.bucket(side, b)
        if not times:
            at = bisect_left(self.index[side], b)
            if at == len(self.index[side]) or self.index[side][at] != b:
                insort(self.index[side], b)
        times[t] = less(times[t], truck) if t in times else truck
        self.dirty.add((side, b))

    def last_at_or_before(self, side: str, t: int) -> int | None:
        buckets = self.index[side]
        for at in range(bisect_right(buckets, t // BUCKET) - 1, -1, -1):
            if found := [x for x in self.bucket(side, buckets[at]) if x <= t]:
                return max(found)
        return None

    def first_at_or_after(self, side: str, t: int) -> int | None:
        buckets = self.index[side]
        for at in range(bisect_left(buckets, t // BUCKET), len(buckets)):
            if found := [x for x in self.bucket(side, buckets[at]) if x >= t]:
                return min(found)
        return None

    def match(self, i: int) -> tuple[str | None, int | None, str | None] | None:
        """Truck of the IN at i, time and truck of its OUT: the first from it on and before the next IN. None: no IN there."""
        ins = self.bucket("in", i // BUCKET)
        if i not in ins:
            return None
        o, after = self.first_at_or_after("out", i), self.first_at_or_after("in", i + 1)
        if o is None or (after is not None and o >= after):
            return ins[i], None, None
        return ins[i], o, self.bucket("out", o // BUCKET)[o]

    def drop_before(self, side: str, t: int) -> None:
        """What lies before t goes."""
        buckets = self.index[side]
        while buckets and buckets[0] < t // BUCKET:
            b = buckets.pop(0)
            self.held[side, b] = {}
            self.dirty.add((side, b))
        if buckets and buckets[0] == t // BUCKET:
            b = buckets[0]
            times = self.bucket(side, b)
            if any(x < t for x in times):
                self.held[side, b] = {x: v for x, v in times.items() if x >= t}
                self.dirty.add((side, b))
                if not self.held[side, b]:
                    buckets.pop(0)

    def last(self) -> int | None:
        """The time of the last event."""
        ends = [max(self.bucket(s, self.index[s][-1])) for s in ("in", "out") if self.index[s]]
        return max(ends) if ends else None

    def settle(self, floor: int) -> int | None:
        """Lets go of what can no more count: before the floor only the last IN stays and what follows it, and if all is before it and
        that IN is closed, nothing. The time of the last event that may still count by its place, if any."""
        last_in = self.last_at_or_before("in", floor - 1)
        for side in ("in", "out"):
            self.drop_before(side, floor if last_in is None else last_in)
        last = self.last()
        if last is None or last >= floor:
            return last
        if last_in is not None and self.match(last_in)[1] is not None:
            for side in ("in", "out"):
                self.drop_before(side, last + 1)
        return None


class MatchCycles(StatefulProcessor):
    """Input: t (microseconds), is_out, truck. Output: the INs whose match a batch has changed, with the match before it.

    State: a map of buckets of event times, composite by side and bucket, and the lists of buckets. A timer at the last event finds keys
    that get no more events.
    """

    OUTPUT = "container_no_norm string, facility string, i long, in_truck string, o long, out_truck string, was_known boolean, was_in_truck string, was_o long, was_out_truck string"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.index = handle.getValueState("index", "buckets string")
        self.buckets = handle.getMapState("buckets", "side string, bucket long", "times string")

    def timeline(self) -> Timeline:
        load = lambda side, b: {int(t): truck for t, truck in json.loads(self.buckets.getValue((side, b))[0])}
        return Timeline(json.loads(self.index.get()[0]) if self.index.exists() else {"in": [], "out": []}, load)

    def store(self, line: Timeline, last: int | None) -> None:
        for side, b in line.dirty:
            if times := line.held[side, b]:
                self.buckets.updateValue((side, b), (json.dumps(sorted(times.items())),))
            elif self.buckets.containsKey((side, b)):
                self.buckets.removeKey((side, b))
        if line.index["in"] or line.index["out"]:
            self.index.update((json.dumps(line.index),))
        else:
            self.index.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer if isinstance(timer, int) else timer[0])
        if last is not None:
            self.handle.registerTimer(last // 1000 + 1)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        line = self.timeline()
        before, touched = line.copy(), set()
        for frame in rows:
            for t, out, truck in zip(frame["t"], frame["is_out"], frame["truck"], strict=True):
                line.put("out" if out else "in", int(t), None if truck is None or truck != truck else truck)
                touched.add(int(t))
        # the IN at or before a new event, and the one before that, which may have lost its OUT to it
        near = {line.last_at_or_before("in", t) for t in touched}
        near |= {line.last_at_or_before("in", i - 1) for i in near if i is not None and i in touched}
        changed = [(i, line.match(i), before.match(i)) for i in sorted(x for x in near if x is not None)]
        changed = [(i, now, was) for i, now, was in changed if now != was]
        floor = timerValues.getCurrentWatermarkInMs() * 1000
        self.store(line, line.settle(floor))
        if changed:
            yield self.rows(key, changed)

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        line = self.timeline()
        self.store(line, line.settle(timerValues.getCurrentWatermarkInMs() * 1000))
        yield from ()

    @staticmethod
    def rows(key: tuple, changed: list) -> pd.DataFrame:
        now, was = [n for _, n, _ in changed], [w or (None, None, None) for _, _, w in changed]
        column = lambda rows, k, kind: pd.array([r[k] for r in rows], kind)
        return pd.DataFrame({
            "container_no_norm": key[0], "facility": key[1], "i": pd.array([i for i, _, _ in changed], "int64"), "in_truck": column(now, 0, object), "o": column(now, 1, "Int64"), "out_truck": column(now, 2, object),
            "was_known": [w is not None for _, _, w in changed], "was_in_truck": column(was, 0, object), "was_o": column(was, 1, "Int64"), "was_out_truck": column(was, 2, object),
        })

    def close(self) -> None:
        pass


class KeepStatus(StatefulProcessor):
    """Input: t (microseconds), event_type_norm, event_id_generated, facility and the attributes. Output: what the container's status
    is now and what it was, if a batch has changed it. State: one value a key, as status.state() has it."""

    PARTS = ["newest", *ATTRIBUTES]
    SIDE = ["t", "type", "facility", *ATTRIBUTES]
    OUTPUT = "container_no_norm string, was_known boolean, " + ", ".join(f"{side}_{c} {'long' if c == 't' else 'string'}" for side in ("now", "was") for c in ("t", "type", "facility", *ATTRIBUTES))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("status", "told string")

    @staticmethod
    def place(t: int, kind: str | None, event_id: str | None) -> list:
        """Sorts as status.current() orders events; null comes first."""
        return [t, kind is not None, kind or "", event_id is not None, event_id or ""]

    @classmethod
    def shown(cls, told: dict) -> list:
        at, facility = told["newest"]
        return [at[0], at[2] if at[1] else None, facility, *(told[a][1] if a in told else None for a in ATTRIBUTES)]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        told = json.loads(self.state.get()[0]) if self.state.exists() else {}
        was = self.shown(told) if told else None
        for frame in rows:
            frame = frame.astype(object).where(frame.notna(), None)
            for t, kind, event_id, facility, *values in frame[["t", "event_type_norm", "event_id_generated", "facility", *ATTRIBUTES]].itertuples(index=False):
                at = self.place(int(t), kind, event_id)
                for part, value in zip(self.PARTS, [facility, *values], strict=True):
                    # of rows of one event the greater value, none being the least
                    if (part == "newest" or value is not None) and (part not in told or (at, value is not None, value or "") > (told[part][0], told[part][1] is not None, told[part][1] or "")):
                        told[part] = [at, value]
        self.state.update((json.dumps(told),))
        now = self.shown(told)
        if now != was:
            sides = {f"{side}_{c}": pd.array([v], "Int64" if c == "t" else object) for side, row in (("now", now), ("was", was or [None] * len(now))) for c, v in zip(self.SIDE, row, strict=True)}
            yield pd.DataFrame({"container_no_norm": pd.array([key[0]], object), "was_known": [was is not None], **sides})

    def close(self) -> None:
        pass
