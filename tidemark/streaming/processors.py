"""``transformWithState`` processors: keyed Value, List and Map state (V2-V5), event-time timers, two connected
streams and state handed over from a batch table.

Running sums, lists and triggers of hot keys run as blocked scans instead (``blocked.py``). Each processor sees, per key and micro-batch, the key's new rows; where
order matters it sorts them by ``(time, event_id)``, rows without a time first (arrival order inside a micro-batch is not defined), folds
them through its state and emits one output row per input row, like the
reference's ``processElement``. Across micro-batches rows arrive in batch order,
so a replay of time-ordered files equals the batch operators in ``operators/state.py``.

A processor's plain name takes and gives pandas frames (``transformWithStateInPandas``), one of each per key; its form
``...Rows`` takes and gives rows (``transformWithState``). Both fold the same way over the same state. A
micro-batch of many keys with few rows each wants rows: a frame per key costs more than what is done with it. So does each
call of a state variable, as it goes to the JVM and back: what can be known without asking isn't asked for.
Null keys need the rows form: over frames Spark deals a null number as NaN, no key of its own, whose rows meet those of
other keys in one state.

State is per key in the RocksDB state store and is checkpointed with the query,
so a restart resumes from the last committed batch (V8).

Memory: a processor that orders holds one key's rows *of one micro-batch*, never
the key's history; bound it with the source's per-trigger limit
(``maxFilesPerTrigger`` / ``maxOffsetsPerTrigger``), sized so a hot key's share of a
micro-batch fits a task. Per-key history lives in the state store.
"""

from __future__ import annotations

import datetime as dt
import sys
from bisect import bisect_right, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Row
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

ORDER = ["time", "event_id"]

# Classes here run inside Python workers. Pickle them by value so executors do not
# need this package installed (the driver may import it from anywhere).
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _get(state, default):
    """ValueState read in one round trip (``get`` is None when unset)."""
    v = state.get()
    return default if v is None else v[0]


def _rows(batches: Iterator[pd.DataFrame]) -> pd.DataFrame:
    pdf = pd.concat(list(batches), ignore_index=True)
    return pdf.sort_values(ORDER, kind="stable", na_position="first").reset_index(drop=True)


def _in_order(rows: Iterator[Row]) -> list[Row]:
    """What ``_rows`` does, for rows."""
    return sorted(rows, key=lambda r: (r["time"] is not None, r["time"], r["event_id"] is not None, r["event_id"]))


def _ids(ids: pd.Series) -> pd.Series:
    """Ids as 64-bit numbers: a column with a null has come as floats."""
    return ids.astype("Int64")


def _micros(moment: dt.datetime | None) -> int | None:
    """A row's time, with a zone or without (UTC), as microseconds."""
    return None if moment is None else (moment - dt.datetime(1970, 1, 1, tzinfo=moment.tzinfo and dt.timezone.utc)) // dt.timedelta(microseconds=1)


def _millis(us: int) -> int:
    """Microseconds as the next whole millisecond, the unit of timers."""
    return -(-us // 1000)


class RunningCount(StatefulProcessor):
    """V2 ValueState: events per key so far. Output: event_id, user_id, n.

    A key may start from a count that a batch has made: the initial state's column ``n``.
    """

    SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("n", T.LongType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        yield pd.DataFrame({"event_id": _ids(pdf["event_id"]), "user_id": pd.array([key[0]] * len(pdf), "Int64"), "n": self._counted(len(pdf))})

    def _counted(self, rows: int) -> range:
        """The count at each of the key's next ``rows`` rows."""
        n = _get(self.count, 0)
        self.count.update((n + rows,))
        return range(n + 1, n + rows + 1)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.count.update((int(initialState["n"].sum()),))

    def close(self) -> None:
        pass


class RunningCountRows(RunningCount):
    """``RunningCount`` over rows."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows, out = _in_order(rows), Row(*self.SCHEMA.names)
        yield from (out(r["event_id"], key[0], n) for r, n in zip(rows, self._counted(len(rows)), strict=True))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        self.count.update((_get(self.count, 0) + initialState["n"],))


class TypeCountMap(StatefulProcessor):
    """V4 MapState: count per event type per key; emits ``type=n, ...`` (sorted) per row."""

    SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("counts", T.StringType())])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getMapState("per_type", "event_type string", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        counts = self._counted([None if pd.isna(t) else t for t in pdf["event_type"]])
        yield pd.DataFrame({"event_id": _ids(pdf["event_id"]), "user_id": pd.array([key[0]] * len(pdf), "Int64"), "counts": counts})

    def _counted(self, types: list[str | None]) -> list[str]:
        """The counts at each of the key's next rows, whose types these are; a null type is none."""
        current = {k[0]: v[0] for k, v in self.counts.iterator()}
        names, out = sorted(current), []
        for t in types:
            if t is not None:
                if t not in current:
                    insort(names, t)
                current[t] = current.get(t, 0) + 1
            out.append(", ".join(f"{k}={current[k]}" for k in names))
        for t in {*types} - {None}:  # only the entries this micro-batch changed
            self.counts.updateValue((t,), (current[t],))
        return out

    def close(self) -> None:
        pass


class TypeCountMapRows(TypeCountMap):
    """``TypeCountMap`` over rows."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows, out = _in_order(rows), Row(*self.SCHEMA.names)
        yield from (out(r["event_id"], key[0], counts) for r, counts in zip(rows, self._counted([r["event_type"] for r in rows]), strict=True))


class RecentList(StatefulProcessor):
    """V3/V5 ListState: append, read the list, clear when it has more than ``clear_above``
    elements (sizes cycle 1..clear_above+1).

    With ``ttl_us`` a list that was not written for so long or longer is gone when the next element comes. Whether it
    is shows from the time of the last write, kept beside the list, so the answer doesn't depend on how rows are dealt to
    micro-batches; an event-time timer, moved on with each write, frees the state of a key
    that gets no more rows. It needs ``timeMode="EventTime"``. Rows without a time neither expire nor let expire.
    """

    SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("list_size", T.IntegerType()), T.StructField("items", T.StringType())])

    def __init__(self, clear_above: int = 10, ttl_us: int | None = None):
        self.clear_above, self.ttl_us = clear_above, ttl_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.items, self.written = handle, handle.getListState("items", "item string"), handle.getValueState("written", "us long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = _rows(rows)
        ids = _ids(pdf["event_id"])
        found = self._listed([None if pd.isna(i) else str(i) for i in ids], [None if pd.isna(t) else t.value // 1000 for t in pdf["time"]])
        sizes, rendered = zip(*found, strict=True)
        yield pd.DataFrame({"event_id": ids, "user_id": pd.array([key[0]] * len(pdf), "Int64"),
                            "list_size": pd.array(sizes, dtype="int32"), "items": rendered})

    def _listed(self, new: list[str | None], times: list[int | None]) -> list[tuple[int, str]]:
        """Size and text of the list at each of the key's next rows, whose items and times (microseconds) these are."""
        period = self.clear_above + 1
        held, before = [t[0] for t in self.items.get()], _get(self.written, None)
        items, last = [*held, *(i or "" for i in new)], before
        begins = [0] * len(held)  # for each item the number of its list's first one
        for at, us in enumerate(times, start=len(held)):
            expired = self.ttl_us is not None and None not in (us, last) and us - last >= self.ttl_us
            life = at if expired or at == 0 else begins[-1]
            begins.append(at if at - life >= period else life)
            last = last if us is None else us
        starts = begins[len(held):]
        sizes = [at - b + 1 for at, b in enumerate(starts, start=len(held))]
        left = items[starts[-1]:] if sizes[-1] < period else []
        if left:
            self.items.put([(x,) for x in left])
        elif held:
            self.items.clear()
        if last != before:
            self.written.update((last,))
            if self.ttl_us is not None:  # the timer always stands at the last write and the time to live
                if before is not None:
                    self.handle.deleteTimer(_millis(before + self.ttl_us))
                self.handle.registerTimer(_millis(last + self.ttl_us))
        return [(n, ", ".join(x for x in items[b:b + n] if x)) for b, n in zip(starts, sizes, strict=True)]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.items.clear()
        self.written.clear()
        yield from ()

    def close(self) -> None:
        pass


class RecentListRows(RecentList):
    """``RecentList`` over rows."""

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        rows, out = _in_order(rows), Row(*self.SCHEMA.names)
        found = self._listed([None if r["event_id"] is None else str(r["event_id"]) for r in rows], [_micros(r["time"]) for r in rows])
        yield from (out(r["event_id"], key[0], *f) for r, f in zip(rows, found, strict=True))


class WindowTimer(StatefulProcessor):
    """A window's counts, given out by the window's own timer when the watermark has passed its end.

    Keys are (window_start, window_end, share): a window that holds most of the rows is counted in shares, and whoever reads the
    output adds them up. Rows are only counted, so a micro-batch's rows are never held together.
    """

    SCHEMA = T.StructType([T.StructField("window_start", T.TimestampNTZType()), T.StructField("window_end", T.TimestampNTZType()),
                           T.StructField("registrations", T.LongType()), T.StructField("events", T.LongType())])

    def __init__(self, counted: str):
        self.counted = counted

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.counts = handle, handle.getValueState("counts", "registrations long, events long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        held = self.counts.get()
        registrations, events = held or (0, 0)
        for pdf in rows:
            events += len(pdf)
            registrations += int((pdf["event_type"] == self.counted).sum())
        self.counts.update((registrations, events))
        if held is None:
            self.handle.registerTimer(_millis(pd.Timestamp(key[1]).value // 1000))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        registrations, events = self.counts.get()
        self.counts.clear()
        yield pd.DataFrame({"window_start": [pd.Timestamp(key[0])], "window_end": [pd.Timestamp(key[1])], "registrations": [registrations], "events": [events]})

    def close(self) -> None:
        pass


class AsOfControl(StatefulProcessor):
    """Two connected streams, data rows and control rows, in one stateful operator.

    Data rows wait until the watermark has passed their time: only then every control row that was in force is there. The
    control rows' history is kept by the time from which they hold, back to the one in force at the watermark. Keys are
    shares of the data; each control row is sent to every share. Rows have ``kind`` 0 (control: time, value; a null
    value only moves the watermark) or 1 (data: time, value, event_id, user_id). A data row without a time, or before
    any control row, meets ``default``. Output: the data rows whose value is above the one in force, and that.
    """

    SCHEMA = T.StructType([T.StructField("event_id", T.LongType()), T.StructField("user_id", T.LongType()),
                           T.StructField("quantity", T.IntegerType()), T.StructField("threshold", T.IntegerType())])

    def __init__(self, default: int):
        self.default = default

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.control = handle.getMapState("control", "us long", "value int")
        self.waiting = handle.getListState("waiting", "us long, event_id long, user_id long, value int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        at_once, latest = [], None
        for pdf in rows:
            control = pdf[(pdf["kind"] == 0) & pdf["value"].notna() & pdf["time"].notna()]
            for moment, value in zip(control["time"], control["value"], strict=True):
                self.control.updateValue((moment.value // 1000,), (int(value),))
            data = pdf[(pdf["kind"] == 1) & pdf["value"].notna()]
            fields = [[None if pd.isna(v) else int(v) for v in data[c]] for c in ("event_id", "user_id", "value")]
            found = [(None if pd.isna(t) else t.value // 1000, *f) for t, *f in zip(data["time"], *fields, strict=True)]
            at_once += [f for f in found if f[0] is None]
            timed = [f for f in found if f[0] is not None]
            if timed:
                self.waiting.appendList(timed)
                latest = max(f[0] for f in (*timed, *([(latest,)] if latest is not None else [])))
        if latest is not None:
            self.handle.registerTimer(_millis(latest) + 1)
        yield from self._judged(at_once, [])
        yield from self._due(timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._due(timerValues)

    def _due(self, timerValues) -> Iterator[pd.DataFrame]:
        """The waiting rows before the watermark; control rows that no later row can meet go."""
        until = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = list(self.waiting.get())
        due = [w for w in waiting if w[0] < until]
        if not due:
            return
        history = sorted((k[0], v[0]) for k, v in self.control.iterator())
        yield from self._judged(due, history)
        if len(due) < len(waiting):
            self.waiting.put([w for w in waiting if w[0] >= until])
        else:
            self.waiting.clear()
        over = [us for us, _ in history if us < until]
        for us in over[:-1]:
            self.control.removeKey((us,))

    def _judged(self, rows: list[tuple], history: list[tuple]) -> Iterator[pd.DataFrame]:
        times = [us for us, _ in history]
        out = []
        for us, event_id, user_id, value in rows:
            n = 0 if us is None else bisect_right(times, us)
            limit = history[n - 1][1] if n else self.default
            if value > limit:
                out.append((event_id, user_id, value, limit))
        if out:
            pdf = pd.DataFrame(out, columns=["event_id", "user_id", "quantity", "threshold"])
            yield pdf.astype({"event_id": "Int64", "user_id": "Int64", "quantity": "int32", "threshold": "int32"})

    def close(self) -> None:
        pass
