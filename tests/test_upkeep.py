"""The fact after late and corrected days equals the one built from all days."""

import datetime as dt
import os
import random

import pytest

from delaylens.plans import fact, upkeep
from delaylens.session import scratch
from tests.test_models import flights_and_weather, staged


def comparable(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r)
                   for r in df.select(*fact.FACT_COLUMNS).collect()), key=repr)


def written(store):
    """Time of writing of every day of the fact."""
    return {d: os.stat(f"{store}/fact/{d}").st_mtime_ns for d in os.listdir(f"{store}/fact")
            if d.startswith("day=")}


@pytest.mark.parametrize("seed", [1, 2])
def test_fact_after_corrections(spark, seed):
    rng = random.Random(seed)
    rows, weather = flights_and_weather(seed, 300)
    day = lambda n: dt.date(2024, 1, 1) + dt.timedelta(days=n)
    store = scratch(spark, "upkeep")
    # at first: no day 2, other delays and tails on day 1, extra flights on day 5, no late weather
    early = [(*r[:5], rng.choice(["T1", "T9"]), *r[6:8], r[8] + 1, *r[9:]) if r[1] == day(1) else r
             for r in rows if r[1] != day(2)]
    early += [(f"x{k}", day(5), k % 4, "AA", k, f"X{k % 2}", "NEW", "A", 5.0, 6.0, 0.0)
              for k in range(3)]
    upkeep.build(*staged(spark, early, [w for w in weather if w[1] != day(9)]), store)

    now = [r for r in rows if r[1] != day(2)]
    assert upkeep.refresh(*staged(spark, now, weather), store, [day(9), day(1), day(5)])
    again = upkeep.refresh(*staged(spark, rows, weather), store, [day(2), None])
    assert {upkeep.NO_DAY, day(2)} <= set(again)
    assert comparable(upkeep.read_fact(spark, store)) == comparable(
        fact.build_fact(*staged(spark, rows, weather)))
    whole = scratch(spark, "whole")
    upkeep.build(*staged(spark, rows, weather), whole)
    for chain in upkeep.DEPTHS:
        kept, built = (sorted(map(repr, spark.read.parquet(f"{p}/{chain}").where(
            "size(_tail) > 0 OR size(_carry) > 0").collect())) for p in (store, whole))
        assert kept == built


def test_only_reached_days_are_written_again(spark):
    """A day with enough flights of each group hides what was before it."""
    days = [dt.date(2024, 3, k) for k in range(1, 9)]
    rows = [(f"{d}{k}", d, k, "AA", k, f"T{k % 2}", "A", "B", 10.0, 5.0, 0.0)
            for d in days for k in range(8)]
    store = scratch(spark, "upkeep")
    upkeep.build(*staged(spark, rows, [("B", days[0], 1, 3.0)]), store)
    before = written(store)
    fixed = [(*r[:8], 99.0, 99.0, r[10]) if r[1] == days[2] else r for r in rows]
    assert upkeep.refresh(*staged(spark, fixed, [("B", days[0], 1, 3.0)]), store, [days[2]]) == days[2:4]
    after = written(store)
    assert sorted(d for d in after if after[d] != before[d]) == [f"day={d}" for d in days[2:4]]
    # the same day again changes only itself; the latest day has nothing after it
    assert upkeep.refresh(*staged(spark, fixed, [("B", days[0], 1, 3.0)]), store, [days[2]]) == [days[2]]
    more = fixed + [("n1", dt.date(2024, 3, 9), 1, "AA", 1, "T1", "A", "B", 1.0, 2.0, 0.0)]
    assert upkeep.refresh(*staged(spark, more, [("B", days[0], 1, 3.0)]), store,
                          [dt.date(2024, 3, 9)]) == [dt.date(2024, 3, 9)]
    got = upkeep.read_fact(spark, store).where("flight_id = 'n1'").first()
    assert (got["lag_1_tail_arr_delay_mins"], got["rolling_6_flight_origin_count"]) == (5.0, 6)


def test_a_day_without_flights_is_refused(spark):
    rows, weather = flights_and_weather(3, 60)
    store = scratch(spark, "upkeep")
    upkeep.build(*staged(spark, rows, weather), store)
    with pytest.raises(ValueError, match="2030-01-01"):
        upkeep.refresh(*staged(spark, rows, weather), store, [dt.date(2030, 1, 1)])
