"""Stateful processors. Rows of a key come unordered within a micro-batch, so each rule orders
what it needs by `order` itself. Days arrive as a ready `_day` column (days since epoch).

Every look at state is a round trip to the executor, which takes longer than the rule itself. So but
for `Bounce` a rule is called for a bucket of keys, and reads and writes the bucket's state at once.
The entries of a bucket lie in it many to a value (`Packed`), as each value is sent by itself."""

from __future__ import annotations

import pickle
from collections.abc import Iterable, Iterator
from decimal import Decimal
from itertools import islice
from operator import itemgetter

import pandas as pd
from pyspark.sql import Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


DAY_MS = 86_400_000


# Entries in one value of a bucket's state.
PACKED = 4096


class Packed:
    """A list state of tuples that are kept in values of up to PACKED each, so that reading and
    writing a bucket costs by its bytes and hardly by its entries."""

    def __init__(self, handle: StatefulProcessorHandle, name: str):
        self.state = handle.getListState(name, "entries binary")

    def get(self) -> Iterator[tuple]:
        for (value,) in (self.state.get() if self.state.exists() else ()):
            yield from pickle.loads(value)

    @staticmethod
    def _values(entries: Iterable[tuple]) -> list[tuple]:
        rest = iter(entries)
        return [(pickle.dumps(part, 5),) for part in iter(lambda: list(islice(rest, PACKED)), [])]

    def put(self, entries: Iterable[tuple]) -> None:
        values = self._values(entries)
        if values:
            self.state.put(values)
        elif self.state.exists():
            self.state.clear()

    def append(self, entries: Iterable[tuple]) -> None:
        self.state.appendList(self._values(entries))


class _Rule(StatefulProcessor):
    def __init__(self, order: list[str], columns: list[str]):
        self.order, self.columns = order, columns

    def close(self) -> None:
        pass


class _Bucket(_Rule):
    """A rule on a bucket of keys. `keys` are (column, type) of the key columns.

    Rows become plain tuples of `columns` first, as a field of a Row is looked up by its name each time.
    A `plain` rule, one in a `Framed`, gets and gives tuples.
    """

    plain, added = False, ()

    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str]):
        super().__init__(order, columns)
        self.keys = [c for c, _ in keys]
        self.key_at, self.order_at = [columns.index(c) for c in self.keys], [columns.index(c) for c in order]
        self.ms_at, self.rows_of = self.order_at[0], {}

    def _key(self, row: tuple) -> tuple:
        return tuple([row[p] for p in self.key_at])

    def _place(self, row: tuple) -> tuple:
        return tuple([row[p] for p in self.order_at])

    def _tuples(self, rows: Iterator, columns: list[str]) -> Iterator[tuple]:
        if self.plain:
            yield from rows
            return
        take = None
        for row in rows:
            if take is None:
                places = [row.__fields__.index(c) for c in columns]
                take = itemgetter(*places) if len(places) > 1 else itemgetter(slice(places[0], places[0] + 1))
            yield take(tuple(row))

    def _row(self, values: tuple, **added) -> Row | tuple:
        """A row of all columns and the added ones."""
        if self.plain:
            return (*values, *[added[c] for c in self.added])
        names = tuple(added)
        if names not in self.rows_of:
            self.rows_of[names] = Row(*self.columns, *names)
        return self.rows_of[names](*values, *added.values())

    def _emit(self, row: tuple, **added) -> Row | tuple:
        """A row that ends with its day, without it."""
        return self._row(row[:-1], **added)

    def _keyed(self, stored: Packed) -> dict[tuple, tuple]:
        """Stored rows by key."""
        n = len(self.keys)
        return {s[:n]: s[n:] for s in stored.get()}


# what the texts of a type are in a rule, where a column's order counts
ORDERED = {"bigint": int, "int": int, "smallint": int, "tinyint": int, "timestamp": int, "double": float, "float": float,
           "decimal": Decimal}
FRAME_ROWS = 50_000


class Framed(StatefulProcessor):
    """A rule whose rows come and go as pandas frames, as a cell of a Row costs more than the rule.

    All cells are texts or null, since a frame's numbers turn to floats where one is null; only a rule's
    order and day are numbers in it. The column `time` leaves as a time, from its microseconds.
    """

    def __init__(self, rule: _Bucket, types: list[str], dated: bool, time: str | None):
        self.rule, self.dated, self.time = rule, dated, time
        rule.plain = True
        self.reads = {p: ORDERED[types[p]] for p in rule.order_at if types[p] in ORDERED}
        if dated:
            self.reads[len(rule.columns)] = int

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rule.init(handle)

    def close(self) -> None:
        pass

    def _tuples(self, frames: Iterator[pd.DataFrame]) -> Iterator[tuple]:
        for frame in frames:
            cells = [frame.iloc[:, p].tolist() for p in range(len(self.rule.columns) + self.dated)]
            for p, read in self.reads.items():
                cells[p] = [None if c is None else read(c) for c in cells[p]]
            yield from zip(*cells)

    def _frames(self, rows: Iterator[tuple]) -> Iterator[pd.DataFrame]:
        names = [*self.rule.columns, *self.rule.added]
        rows = iter(rows)
        while part := list(islice(rows, FRAME_ROWS)):
            cells = dict(zip(names, map(list, zip(*part))))
            for p in self.reads:
                if p < len(self.rule.columns):
                    cells[names[p]] = [None if c is None else str(c) for c in cells[names[p]]]
            columns = {c: pd.Series(v, dtype="int64" if c in self.rule.added else object) for c, v in cells.items()}
            if self.time:
                micros = pd.to_numeric(columns[self.time])
                columns[self.time] = pd.to_datetime(micros, unit="us", utc=True)
            yield pd.DataFrame(columns)

    def handleInputRows(self, key, rows, timerValues):
        yield from self._frames(self.rule.handleInputRows(key, self._tuples(rows), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._frames(self.rule.handleExpiredTimer(key, timerValues, expiredTimerInfo))


class DaySet(_Bucket):
    """State shared by the rules that act on a key's first row of a day: the days it has had.

    A day is new whatever the order in which days arrive. Where rows carry event time, days before
    the watermark's are forgotten but for the last, as no row of them can come any more; without,
    a key keeps one number for each of its days.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = Packed(handle, "days")

    def _days(self) -> dict[tuple, list[int]]:
        return {k: list(v[0]) for k, v in self._keyed(self.seen).items()}

    def _keep(self, known: dict[tuple, list[int]], changed: set[tuple], timerValues) -> None:
        passed = (timerValues.getCurrentWatermarkInMs() or 0) // DAY_MS
        for key in changed:
            days = sorted(known[key])
            open_from = next((i for i, d in enumerate(days) if d >= passed - 1), len(days))
            known[key] = days[max(0, open_from - 1):]
        if changed:
            self.seen.put((*k, v) for k, v in known.items())

    def _dated(self, rows: Iterator[Row]) -> Iterator[tuple]:
        return self._tuples(rows, [*self.columns, "_day"])

    def _day_heads(self, rows: Iterator[Row]) -> dict[tuple, dict[int, tuple]]:
        """The first row of each key and day. Holds one row for each."""
        heads: dict[tuple, dict[int, tuple]] = {}
        for row in self._dated(rows):
            mine = heads.setdefault(self._key(row), {})
            head = mine.get(row[-1])
            if head is None or self._place(row) < self._place(head):
                mine[row[-1]] = row
        return heads

    def _others(self, rows: Iterator[Row], known: dict[tuple, list[int]], heads: dict[tuple, tuple]) -> Iterator[tuple]:
        """Puts rows among the day heads; the rows that aren't one, or no longer."""
        for row in self._dated(rows):
            key, day = self._key(row), row[-1]
            if day in known.get(key, ()):
                yield row
                continue
            head = heads.setdefault((key, day), row)
            if head is row:
                continue
            if self._place(row) < self._place(head):
                heads[key, day] = row
                yield head
            else:
                yield row

    def _new_days(self, rows: Iterator[Row], timerValues) -> Iterator[tuple[tuple, list[int]]]:
        """The first row of each day not seen before, oldest day first, with the days known until then."""
        known, changed = self._days(), set()
        for key, heads in self._day_heads(rows).items():
            days = known.get(key, [])
            fresh = [d for d in sorted(heads) if d not in days]
            for day in fresh:
                yield heads[day], days
                days.append(day)
            if fresh:
                known[key] = days
                changed.add(key)
        self._keep(known, changed, timerValues)


class FirstPerDay(DaySet):
    """Emit the first row of a day not seen before."""

    def handleInputRows(self, key, rows, timerValues):
        for row, _ in self._new_days(rows, timerValues):
            yield self._emit(row)


class Returning(DaySet):
    """First row of each new day, with the returning-user counter."""

    added = ("back_ct", "uu_ct")

    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str], away_days: int):
        super().__init__(keys, order, columns)
        self.away_days = away_days

    def _flags(self, day: int, days: list[int]) -> dict[str, int]:
        before = max((d for d in days if d < day), default=None)
        return {"back_ct": int(before is not None and day - before >= self.away_days), "uu_ct": 1}

    def handleInputRows(self, key, rows, timerValues):
        for row, days in self._new_days(rows, timerValues):
            yield self._emit(row, **self._flags(row[-1], days))


class DailyFirsts(DaySet):
    """First row of each new day, with is_new on the key's first row ever."""

    added = ("is_new", "is_unique")

    def _flags(self, day: int, days: list[int]) -> dict[str, int]:
        return {"is_new": int(not days), "is_unique": 1}

    def handleInputRows(self, key, rows, timerValues):
        for row, days in self._new_days(rows, timerValues):
            yield self._emit(row, **self._flags(row[-1], days))


class UniqueAndNew(DailyFirsts):
    """Every row, with the day's first row flagged. Only the day heads are held back."""

    def handleInputRows(self, key, rows, timerValues):
        known, heads = self._days(), {}
        for other in self._others(rows, known, heads):
            yield self._emit(other, is_unique=0, is_new=0)
        changed = set()
        for (k, day) in sorted(heads, key=lambda place: place[1]):
            days = known.setdefault(k, [])
            yield self._emit(heads[k, day], **self._flags(day, days))
            days.append(day)
            changed.add(k)
        self._keep(known, changed, timerValues)


class _HeldHeads(DaySet):
    """The first row of each key and day, held until the watermark passes its time, so that what is
    emitted doesn't depend on the order of arrival: no earlier row can come any more. order[0] is
    epoch ms.

    A row is due one ms early: it is on its way before the operators behind call it late. A bucket has
    one timer, of its earliest row; it goes off with all rows that are due by then, and sets the next.
    """

    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str], row_schema: str):
        DaySet.__init__(self, keys, order, columns)
        self.row_schema = row_schema

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.handle = handle
        self.pending = Packed(handle, "heads")

    def _heads(self) -> dict[tuple, tuple]:
        return {(self._key(row), row[-1]): row for row in self.pending.get()}

    def _time_next(self, heads: dict[tuple, tuple]) -> None:
        due = min((row[self.ms_at] for row in heads.values()), default=None)
        set_for = list(self.handle.listTimers())
        for ms in set_for:
            if due is None or ms != due - 1:
                self.handle.deleteTimer(ms)
        if due is not None and due - 1 not in set_for:
            self.handle.registerTimer(due - 1)

    def _hold(self, rows: Iterator[Row]) -> Iterator[tuple]:
        """Keeps the heads of days still open; all other rows come back."""
        known, heads = self._days(), self._heads()
        before = dict(heads)
        yield from self._others(rows, known, heads)
        if any(row is not before.get(place) for place, row in heads.items()):
            self.pending.put(heads.values())
            self._time_next(heads)

    def handleInputRows(self, key, rows, timerValues):
        for _ in self._hold(rows):
            pass
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        passed = timerValues.getCurrentWatermarkInMs()
        known, heads, changed = self._days(), self._heads(), set()
        for k, day in sorted((p for p, row in heads.items() if row[self.ms_at] <= passed), key=lambda p: p[1]):
            days = known.setdefault(k, [])
            yield self._emit(heads.pop((k, day)), **self._flags(day, days))
            days.append(day)
            changed.add(k)
        if changed:
            self.pending.put(heads.values())
            self._keep(known, changed, timerValues)
        # the timer that went off is gone by itself
        due = min((row[self.ms_at] for row in heads.values()), default=None)
        if due is not None:
            self.handle.registerTimer(due - 1)


class HeldReturning(_HeldHeads, Returning):
    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str], row_schema: str,
                 away_days: int):
        _HeldHeads.__init__(self, keys, order, columns, row_schema)
        self.away_days = away_days


class HeldDailyFirsts(_HeldHeads, DailyFirsts):
    """First row of each new day, with is_new, once the watermark has passed it."""


class HeldUniqueAndNew(_HeldHeads, UniqueAndNew):
    """Rows that aren't a day's first go out at once, and so does a head that loses its place."""

    def handleInputRows(self, key, rows, timerValues):
        for row in self._hold(rows):
            yield self._emit(row, is_unique=0, is_new=0)


class NewFlagRepair(_Bucket):
    """Clear the new-visitor flag on every day but the first. Every row goes in and out again, so rows
    come as pandas frames. Of a key's rows only those of its first micro-batch are held."""

    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str], flag: str):
        super().__init__(keys, order, columns)
        self.flag = flag

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.first = Packed(handle, "first")

    def _fixed(self, rows: pd.DataFrame, keys: pd.Series, days: dict[tuple, int]) -> pd.DataFrame:
        first = keys.map(days)
        wrong = (rows[self.flag] == "1") & first.notna() & rows["_day"].notna() & (first != rows["_day"])
        return rows[self.columns].assign(**{self.flag: rows[self.flag].mask(wrong, "0")})

    def handleInputRows(self, key, rows, timerValues):
        known = {k: v[0] for k, v in self._keyed(self.first).items()}
        fresh: list[tuple[pd.DataFrame, pd.Series]] = []
        days: dict[tuple, tuple] = {}
        for frame in rows:
            # names that begin with an underscore don't arrive
            frame.columns = [*self.columns, "_day", *frame.columns[len(self.columns) + 1:]]
            keys = pd.Series(list(zip(*(frame[c] for c in self.keys))), index=frame.index, dtype=object)
            old = keys.isin(known.keys())
            if old.any():
                yield self._fixed(frame[old], keys[old], known)
            if not old.all():
                frame, keys = frame[~old], keys[~old]
                fresh.append((frame, keys))
                flags = frame[self.flag] == "1"
                timed = frame[self.order[0]].notna()
                for k, ms, flag, day in zip(keys[timed], frame[self.order[0]][timed], flags[timed], frame["_day"][timed]):
                    place = (ms, bool(flag), int(day))
                    days[k] = min(days.get(k, place), place)
        first = {k: day if flag else day - 1 for k, (_, flag, day) in days.items()}
        for frame, keys in fresh:
            yield self._fixed(frame, keys, first)
        if first:
            self.first.append((*k, day) for k, day in first.items())


class LatestVersion(_Bucket):
    """Keep the newest version of a key; emit it once, a fixed time after the first one.

    A mark of the key stays, so later versions are silent. Time is the watermark and
    the rows' own ms if `event_time`, else the clock.
    """

    def __init__(self, keys: list[tuple[str, str]], order: list[str], columns: list[str], row_schema: str,
                 wait_ms: int, event_time: bool):
        super().__init__(keys, order, columns)
        self.row_schema, self.wait_ms = row_schema, wait_ms
        self.event_time = event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # the newest versions with the time when each is due, and the marks of those emitted
        self.best, self.done = Packed(handle, "best"), Packed(handle, "done")

    def _now(self, timerValues) -> int:
        return (timerValues.getCurrentWatermarkInMs() if self.event_time
                else timerValues.getCurrentProcessingTimeInMs())

    def _waiting(self) -> dict[tuple, tuple]:
        """(version, due) of each key, as stored."""
        return {self._key(s): (s[:-1], s[-1]) for s in self.best.get()}

    def _wait(self, waiting: dict[tuple, tuple]) -> None:
        self.best.put((*version, due) for version, due in waiting.values())

    def handleInputRows(self, key, rows, timerValues):
        done, waiting = set(self.done.get()), self._waiting()
        start, timed, touched = self._now(timerValues), min((d for _, d in waiting.values()), default=None), False
        firsts: dict[tuple, int] = {}
        for version in self._tuples(rows, self.columns):
            k = self._key(version)
            if k in done:
                continue
            held, touched = waiting.get(k), True
            if held is None or k in firsts:
                ms = version[self.ms_at]
                firsts[k] = ms if k not in firsts else min(firsts[k], ms)
            if held is None:
                waiting[k] = (version, None)
            elif self._place(version) >= self._place(held[0]):
                waiting[k] = (version, held[1])
        for k, first in firsts.items():
            waiting[k] = (waiting[k][0], (max(first, start) if self.event_time else start) + self.wait_ms)
        if touched:
            self._wait(waiting)
        # one timer for a bucket, of its earliest key; a timer that goes off sets the next one
        due = min((waiting[k][1] for k in firsts), default=None)
        if due is not None and (timed is None or due < timed):
            if timed is not None:
                self.handle.deleteTimer(timed)
            self.handle.registerTimer(due)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now, waiting = self._now(timerValues), self._waiting()
        due = [k for k, (_, at) in waiting.items() if at < now or at <= expiredTimerInfo.getExpiryTimeInMs()]
        for k in due:
            version, _ = waiting.pop(k)
            yield self._row(version)
        if due:
            self._wait(waiting)
            self.done.append(due)
        if waiting:
            self.handle.registerTimer(min(at for _, at in waiting.values()))


class Bounce(_Rule):
    """Entry views whose key shows no further page within the gap, decided in event time."""

    def __init__(self, order: list[str], columns: list[str], row_schema: str, gap_ms: int):
        super().__init__(order, columns)
        self.row_schema, self.gap_ms = row_schema, gap_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", self.row_schema + ", _entry boolean")

    def handleInputRows(self, key, rows, timerValues):
        stored = [(*(r[c] for c in self.columns), r["_entry"]) for r in rows]
        if stored:
            waiting = self.open.exists()
            self.open.appendList(stored)
            ms = self.columns.index(self.order[0])
            due = min(s[ms] for s in stored) + self.gap_ms
            # One timer per key is enough; a fired timer sets the next one.
            current = min(self.handle.listTimers(), default=None) if waiting else None
            if current is None or due < current:
                if current is not None:
                    self.handle.deleteTimer(current)
                self.handle.registerTimer(due)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = timerValues.getCurrentWatermarkInMs()
        ms = self.columns.index(self.order[0])
        places = [self.columns.index(c) for c in self.order]
        rows = sorted(self.open.get(), key=lambda r: tuple(r[p] for p in places))
        kept = []
        for row, after in zip(rows, [*rows[1:], None]):
            if row[ms] + self.gap_ms > now:
                kept.append(tuple(row))
            elif row[-1] and (after is None or after[-1] or after[ms] - row[ms] >= self.gap_ms):
                yield Row(**dict(zip(self.columns, row)))
        if kept:
            self.open.put(kept)
            self.handle.registerTimer(kept[0][ms] + self.gap_ms)
        else:
            self.open.clear()
