from __future__ import annotations

import datetime as dt
import random

import pytest
from helpers import bag, plan_text, tuples

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType
from weatherlake import schemas
from weatherlake.operators import trips

START = dt.datetime(2025, 1, 1)
COLUMNS = "event_id long, id long, date timestamp, sur_velo_bool boolean"


def _minute(n):
    return None if n is None else START + dt.timedelta(minutes=n)


def _rides(spark, rows):
    return spark.createDataFrame([(i, key, _minute(m), state) for i, (key, m, state) in enumerate(rows)], COLUMNS)


def _by_hand(rows):
    """Plain restatement: order, previous state, starts, and starts up to each date."""
    ordered = sorted(rows, key=lambda r: (r[1], r[2] is not None, r[2] or START, r[0]))
    changes, starts = {}, {}
    for previous, row in zip([None, *ordered], ordered, strict=False):
        known = previous is not None and previous[1] == row[1] and previous[3] is not None
        changes[row[0]] = int(known and previous[3] != row[3])
        starts[row[0]] = int(changes[row[0]] == 1 and row[3] is True)
    result = []
    for row in ordered:
        upto = sum(
            starts[other[0]]
            for other in ordered
            if other[1] == row[1]
            and (other[2] is None or (row[2] is not None and other[2] <= row[2]))
        )
        result.append((*row, changes[row[0]], starts[row[0]], upto if row[3] else None))
    return result


def test_parse_rides(spark):
    raw = spark.createDataFrame(
        [(1, "2025-01-01 00:00:00", "True", 1.0), (1, "bad", "maybe", 1.0), (1, None, None, None)], schemas.RIDE
    )
    assert tuples(trips.parse_rides(raw).select("date", trips.STATE)) == [
        (START, True), (None, False), (None, None),
    ]


def test_riding_from_the_first_row_is_trip_zero(spark):
    rides = _rides(spark, [(1, 0, True), (1, 5, False), (1, 6, True), (1, 9, True), (1, 12, False)])
    numbered = trips.number_trips(rides, tie=["event_id"])
    assert tuples(numbered.select(*trips.FLAGS).orderBy("event_id")) == [
        (0, 0, 0), (1, 0, None), (1, 1, 1), (0, 0, 1), (1, 0, None),
    ]
    durations = trips.trip_durations(numbered)
    assert bag(durations.select("numero_de_trajet", "duree_trajet_minutes")) == [(0, 0.0), (1, 3.0)]


def test_null_states(spark):
    rides = _rides(spark, [(1, 0, None), (1, 1, True), (1, 2, None), (1, 3, True)])
    numbered = trips.number_trips(rides, tie=["event_id"]).orderBy("event_id")
    assert tuples(numbered.select(*trips.FLAGS)) == [(0, 0, None), (0, 0, 0), (1, 0, None), (0, 0, 0)]


def test_rows_of_one_date_share_their_number(spark):
    rides = _rides(spark, [(1, 0, False), (1, 1, True), (1, 1, False), (1, 1, True)])
    numbered = trips.number_trips(rides, tie=["event_id"]).orderBy("event_id")
    assert [row.numero_de_trajet for row in numbered.collect()] == [None, 2, None, 2]


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("period", ["minute", "hour", "year"])
def test_numbering_by_period(spark, seed, period):
    """One id holds most rows, dates repeat a lot, some are missing."""
    rng = random.Random(seed)
    rows = []
    for i in range(400):
        key = rng.choice([1, 1, 1, None, rng.randrange(2, 9)])
        minute = rng.choice([None, 3, 3, 3, rng.randrange(300)])
        rows.append((i, key, _minute(minute), rng.choice([True, True, False, None])))
    rides = spark.createDataFrame(rows, COLUMNS).repartition(5)
    known = [row for row in rows if row[1] is not None]
    numbered = trips.number_trips(rides, tie=["event_id"], period=period)
    assert sorted(map(str, tuples(numbered.filter("id is not null")))) == sorted(map(str, _by_hand(known)))
    whole = trips.number_trips(rides, tie=["event_id"], period="year")
    assert bag(numbered) == bag(whole)


def test_a_hot_id_is_numbered_by_several_tasks(spark):
    """The rows of one id meet in the window's tasks by period, and building the plan starts no job."""
    rows = [(1, minute, minute % 3 == 0) for minute in range(0, 1440 * 40, 30)]
    rides = _rides(spark, rows)
    started = spark.sparkContext.statusTracker().getJobIdsForGroup()
    numbered = trips.number_trips(rides, tie=["event_id"])
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == started
    period = F.xxhash64("id", F.date_trunc(trips.PERIOD, "date"))
    assert rides.select((F.pmod(period, F.lit(8))).alias("task")).distinct().count() > 3
    plan = plan_text(numbered)
    assert "Exchange hashpartitioning(id" in plan and "_period" in plan


def test_change_flag_equals_a_python_function(spark):
    def detect(current, previous):
        return 0 if previous is None else int(current != previous)

    detect_udf = F.udf(detect, IntegerType())
    states = [None, True, False]
    pairs = spark.createDataFrame([(a, b) for a in states for b in states], "a boolean, b boolean")
    both = pairs.select(trips._changed(F.col("a"), F.col("b")), detect_udf("a", "b"))
    assert all(native == python for native, python in tuples(both))


def test_lag_and_running_sum_share_one_shuffle(spark):
    plan = plan_text(trips.number_trips(_rides(spark, [(1, 0, True)]), tie=["event_id"]))
    # By id and period for the rows (the edges come from the same partitions), by id for the edges.
    assert plan.count("Window [") <= 8


def test_totals_and_selection(spark):
    durations = spark.createDataFrame(
        [(1, 1, 5.0), (1, 0, 2.0), (2, 1, 9.0)], "id long, numero_de_trajet long, duree_trajet_minutes double"
    )
    assert tuples(trips.riding_totals(durations)) == [(2, 9.0), (1, 7.0)]
    assert tuples(trips.trips_of(durations, 1)) == [(1, 0, 2.0), (1, 1, 5.0)]
    rides = _rides(spark, [(1, 0, False), (3, 0, True), (2, 1, True)])
    assert {row.id for row in trips.rides_of_first_rider(rides).collect()} == {2}
    assert tuples(trips.distinct_ids(rides)) == [(3,)]
    assert [row.id for row in trips.ordered_rides(rides).collect()] == [1, 2, 3]
