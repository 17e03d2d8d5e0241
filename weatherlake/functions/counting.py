"""Counters taken by the job that writes the counted rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation


class Count:
    """``rows`` is the table with an observation on it; ``get`` the counters once it was written.

    A plan that turns out to be empty may be replaced as a whole at run time, observation included; only
    then the counters are taken by a job of their own.
    """

    def __init__(self, df: DataFrame, *counters: Column):
        self._df, self._counters, self._observation = df, counters, Observation()
        self.rows = df.observe(self._observation, *counters)

    def get(self) -> dict:
        try:
            return self._observation.get
        except Py4JJavaError:
            return self._df.agg(*self._counters).first().asDict()
