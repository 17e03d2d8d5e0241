"""Trips from a log of riding / not riding states.

Numbering needs the previous state and a running count per id.  A plain row window would sort
all rows of one id in one task.  Here an id's rows are cut into periods of its dates; each period is
numbered on its own, and what one period passes to the next (last state, trips so far) is worked
out on a table with one row per id and period.  One lazy plan serves every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from weatherlake.constants import RIDE_TIME_FORMAT
from weatherlake.functions.joins import join_null_safe
from weatherlake.functions.text import truth
from weatherlake.functions.times import minutes_between, parse_time
from weatherlake.operators.reports import sorted_by

# Dates that one task numbers together; any unit of ``date_trunc``.
PERIOD = "day"

# Column names of the ride log and of the numbering.
STATE = "sur_velo_bool"
FLAGS = ("changement", "debut_trajet", "numero_de_trajet")


def parse_rides(raw: DataFrame) -> DataFrame:
    """Raw log with a real timestamp and a real boolean state."""
    return raw.withColumns({"date": parse_time("timestamp", RIDE_TIME_FORMAT), STATE: truth("sur_velo")})


def _changed(current: Column, previous: Column) -> Column:
    """1 where the state differs from a known previous state."""
    return F.when(previous.isNull(), 0).otherwise((~current.eqNullSafe(previous)).cast("int"))


def _starts(change: Column) -> Column:
    return F.when((change == 1) & F.col(STATE), 1).otherwise(0)


def number_trips(rides: DataFrame, tie: Sequence[str] = (), period: str = PERIOD) -> DataFrame:
    """Add change flag, trip start flag and trip number to ``id, date, sur_velo_bool`` rows.

    Rows of one id are taken in ``date`` order; ``tie`` names the columns that order rows
    of the same date (the state itself comes last).  Rows of the same date share their
    trip number, riding from the very first row is trip 0, and a row that is not riding
    has no number.  A task holds the rows of one id and ``period``; rows without date come
    first and form a period.
    """
    group = ["id", "_period"]
    order = ["date", *tie, STATE]
    in_order = Window.partitionBy(*group).orderBy(*order)
    local = (
        rides.withColumn("_period", F.date_trunc(period, "date"))
        .withColumn("_first", F.row_number().over(in_order) == 1)
        .withColumn("_change", _changed(F.col(STATE), F.lag(STATE).over(in_order)))
        .withColumn("_start", _starts(F.col("_change")))
        .withColumn("_number", F.sum("_start").over(Window.partitionBy(*group).orderBy("date")))
    )
    # One row per id and period.  All rows of a date are in one period, so a period's starts
    # count for every row of the next.
    position = F.struct(*order)
    edges = local.groupBy(*group).agg(
        F.min(position).alias("head"), F.max(position).alias("tail"), F.sum("_start").alias("starts")
    )
    along = Window.partitionBy("id").orderBy("_period")
    carried = (
        edges.select(*group, "starts", f"head.{STATE}", F.lag(f"tail.{STATE}").over(along).alias("previous"))
        .withColumn("head_change", _changed(F.col(STATE), F.col("previous")))
        .withColumn("head_start", _starts(F.col("head_change")))
        .withColumn("through", F.sum(F.col("starts") + F.col("head_start")).over(along))
        .select(*group, "head_change", "head_start", (F.col("through") - F.col("starts")).alias("before"))
    )
    numbered = join_null_safe(local, carried, group).withColumns(
        {
            "changement": F.when(F.col("_first"), F.col("head_change")).otherwise(F.col("_change")),
            "debut_trajet": F.when(F.col("_first"), F.col("head_start")).otherwise(F.col("_start")),
            "numero_de_trajet": F.when(F.col(STATE), F.col("before") + F.col("_number")),
        }
    )
    return numbered.select(*rides.columns, *FLAGS)


def trip_durations(numbered: DataFrame) -> DataFrame:
    """First and last riding row of every trip and the minutes between them."""
    return (
        numbered.filter(F.col(STATE) & F.col("numero_de_trajet").isNotNull())
        .groupBy("id", "numero_de_trajet")
        .agg(F.min("date").alias("debut_trajet_date"), F.max("date").alias("fin_trajet_date"))
        .withColumn("duree_trajet_minutes", minutes_between("debut_trajet_date", "fin_trajet_date"))
    )


def riding_totals(trips: DataFrame) -> DataFrame:
    """Minutes on the bike per id, longest first."""
    total = F.sum("duree_trajet_minutes").alias("duree_trajet_minutes")
    return trips.groupBy("id").agg(total).orderBy(F.desc("duree_trajet_minutes"), "id")


def trips_of(trips: DataFrame, id_value) -> DataFrame:
    return trips.filter(F.col("id") == F.lit(id_value)).orderBy("numero_de_trajet")


def rides_of_first_rider(rides: DataFrame) -> DataFrame:
    """The rides of the smallest id that has a trip."""
    first = rides.filter(F.col(STATE)).agg(F.min("id").alias("id"))
    return rides.join(first, "id", "left_semi")


def distinct_ids(rides: DataFrame, error: float = 0.0) -> DataFrame:
    """Number of distinct ids; with an ``error`` (relative standard deviation) from a sketch, without a shuffle of the ids."""
    counted = F.approx_count_distinct("id", error) if error else F.count_distinct("id")
    return rides.agg(counted.alias("nb_ids_uniques"))


def ordered_rides(rides: DataFrame, *tie: str) -> DataFrame:
    return sorted_by(rides, "id", "date", *tie)
