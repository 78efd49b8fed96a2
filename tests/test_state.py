"""Per-key rules against a plain fold over each key's rows in order."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tillstream.operators import state

DAY = 86_400_000
SCHEMA = "id bigint, mid string, is_new string, page_id string, last_page_id string, ts bigint"
ORDER = ["ts", "id"]


def day(ms):
    return dt.date(1970, 1, 1) + dt.timedelta(milliseconds=ms)


def frame(spark, events):
    return spark.createDataFrame(events, SCHEMA)


def by_key(events):
    keys = defaultdict(list)
    for e in sorted(events, key=lambda e: (e[5], e[0])):
        keys[e[1]].append(e)
    return keys


def ids(df, *columns):
    return sorted(tuple(r) for r in df.select("id", *columns).collect())


# -- the state rules as folds --------------------------------------------------

def fold_new_flag(events):
    out = []
    for rows in by_key(events).values():
        first = None
        for id_, _, new, _, _, ts in sorted(rows, key=lambda e: (e[5], e[2] == "1")):
            if new == "1":
                if first is None:
                    first = day(ts)
                elif first != day(ts):
                    new = "0"
            elif first is None:
                first = day(ts) - dt.timedelta(days=1)
            out.append((id_, new))
    return sorted(out)


def fold_first_per_day(events):
    out = []
    for rows in by_key(events).values():
        last = None
        for e in rows:
            if last is None or last != day(e[5]):
                last = day(e[5])
                out.append((e[0],))
    return sorted(out)


def fold_returning(events):
    out = []
    for rows in by_key(events).values():
        last = None
        for e in rows:
            if last is None:
                out.append((e[0], 1, 0))
            elif last != day(e[5]):
                midnight = (last - dt.date(1970, 1, 1)).days * DAY
                out.append((e[0], 1, int((e[5] - midnight) // DAY >= 8)))
            last = day(e[5])
    return sorted(out)


def fold_unique_and_new(events):
    out = []
    for rows in by_key(events).values():
        last = None
        for e in rows:
            out.append((e[0], int(last is None or last != day(e[5])), int(last is None)))
            last = day(e[5])
    return sorted(out)


def fold_bounces(events, gap):
    out = []
    for rows in by_key(events).values():
        for e, after in zip(rows, [*rows[1:], None]):
            if e[4] is None and (after is None or after[5] - e[5] >= gap or after[4] is None):
                out.append((e[0],))
    return sorted(out)


# -- properties ----------------------------------------------------------------

events_strategy = st.lists(
    st.tuples(st.sampled_from("abcd"), st.sampled_from(["0", "1", None]),
              st.sampled_from(["home", "good_detail", "cart"]),
              st.sampled_from([None, None, "home"]),
              st.one_of(st.integers(0, 40_000), st.integers(0, 30 * DAY),
                        st.integers(DAY - 15_000, DAY + 15_000),
                        st.sampled_from([8 * DAY - 1, 8 * DAY, 9 * DAY, 3_600_000, 3_610_000]))),
    min_size=1, max_size=60).map(
        lambda rows: [(i, *row) for i, row in enumerate(rows)])


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(events=events_strategy)
def test_rules_equal_their_folds(spark, events):
    df = frame(spark, events).repartition(3)
    assert ids(state.repair_new_flag(df), F.coalesce("is_new", F.lit("x"))) == sorted(
        (i, n or "x") for i, n in fold_new_flag(events))
    assert ids(state.first_per_day(df, ["mid"], ORDER)) == fold_first_per_day(events)
    assert ids(state.daily_and_returning(df, ORDER, key="mid"), "uu_ct",
               "back_ct") == fold_returning(events)
    assert ids(state.bounces(df, ORDER)) == fold_bounces(events, 10_000)
    assert ids(state.bounces(df, ORDER, gap_ms=50_000, slice_ms=1)) == fold_bounces(
        events, 50_000)


@settings(max_examples=6, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow])
@given(events=events_strategy)
def test_flags_and_copies_equal_their_folds(spark, events):
    df = frame(spark, events).drop("is_new").repartition(3)
    assert ids(state.unique_and_new(df, ORDER, state.day_of("ts"), "id", key="mid"),
               "is_unique", "is_new") == fold_unique_and_new(events)
    assert ids(state.daily_firsts(df, ORDER, state.day_of("ts"), key="mid"), "is_new") == sorted(
        (i, n) for i, u, n in fold_unique_and_new(events) if u)
    keys = by_key(events)
    assert ids(state.first_per_key(df, "mid", ORDER)) == sorted((r[0][0],) for r in keys.values())
    assert ids(state.latest_per_key(df, "mid", ORDER)) == sorted((r[-1][0],) for r in keys.values())
    pages = [e for e in events if e[3] in ("home", "good_detail")]
    heads = fold_first_per_day([(e[0], e[1] + e[3], *e[2:]) for e in pages])
    assert ids(state.daily_page_counters(df, ORDER)) == heads


# -- corners -------------------------------------------------------------------

def event(i, ts, new="1", last=None, mid="m"):
    return (i, mid, new, "home", last, ts)


def test_unflagged_first_row_spoils_the_same_day(spark):
    df = frame(spark, [event(0, 0, "0"), event(1, 1), event(2, DAY)])
    assert ids(state.repair_new_flag(df), "is_new") == [(0, "0"), (1, "0"), (2, "0")]


@pytest.mark.parametrize("days, back", [(7, 0), (8, 1), (9, 1)])
def test_back_after_eight_days(spark, days, back):
    late, early = DAY - 1, days * DAY + 1
    df = frame(spark, [event(0, late), event(1, early)])
    assert ids(state.daily_and_returning(df, ORDER, key="mid"), "back_ct") == [(0, 0), (1, back)]


@pytest.mark.parametrize("gap, bounced", [(9_999, False), (10_000, True), (10_001, True)])
@pytest.mark.parametrize("start", [0, 3_599_000, 3_600_000 - 9_999])
def test_bounce_gap(spark, start, gap, bounced):
    df = frame(spark, [event(0, start), event(1, start + gap, last="home")])
    assert ids(state.bounces(df, ORDER)) == ([(0,)] if bounced else [])


def test_entry_after_entry_and_last_entry_bounce(spark):
    df = frame(spark, [event(0, 0), event(1, 5), event(2, 10, last="home"), event(3, 11)])
    assert ids(state.bounces(df, ORDER)) == [(0,), (3,)]


def test_hot_key(spark):
    """One key with a third of all rows: same results as the folds."""
    rng = random.Random(7)
    events = [(i, "hot" if i % 3 == 0 else f"k{rng.randrange(900)}", rng.choice("01"), "home",
               rng.choice([None, "home"]), rng.randrange(5 * DAY)) for i in range(9_000)]
    df = frame(spark, events).repartition(8)
    assert ids(state.repair_new_flag(df), "is_new") == fold_new_flag(events)
    assert ids(state.first_per_day(df, ["mid"], ORDER)) == fold_first_per_day(events)
    assert ids(state.bounces(df, ORDER, slice_ms=60_000)) == fold_bounces(events, 10_000)
