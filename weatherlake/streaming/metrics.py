"""Row counters measured inside the job that moves the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F
from pyspark.sql.streaming import StreamingQueryListener

from weatherlake.functions.levels import is_alert
from weatherlake.streaming.batches import Totals, message_counters


def _alert_counters():
    return F.count("*").alias("processed"), F.count_if(is_alert()).alias("alerts")


def observe_alerts(classified: DataFrame, observation: Observation) -> DataFrame:
    """Count processed rows and alerts of a bounded table as it is written."""
    return classified.observe(observation, *_alert_counters())


def observe_alert_stream(classified: DataFrame, name: str = "alerts") -> DataFrame:
    """Count processed rows and alerts of every micro-batch under ``name``."""
    return classified.observe(name, *_alert_counters())


def observe_untimed(readings: DataFrame, name: str = "untimed") -> DataFrame:
    """Count the rows without an event time, which no window will contain."""
    return readings.observe(name, F.count_if(F.col("event_timestamp").isNull()).alias("untimed"))


def observe_rejects(decoded: DataFrame, name: str = "messages") -> DataFrame:
    """Count decoded messages and the rejects among them in every micro-batch, under ``name``."""
    return decoded.observe(name, *message_counters())


def observe_sent(messages: DataFrame, observation: Observation) -> DataFrame:
    return messages.observe(observation, F.count("*").alias("sent"))


class TotalsListener(StreamingQueryListener):
    """Adds up counters over micro-batches: what queries observe, and what the watermark drops.

    Rows later than the watermark are counted behind partial aggregation, so several late
    readings of one window and place in one task count once.
    """

    def __init__(self, counters: Totals | None = None) -> None:
        self.counters = counters or Totals()

    @property
    def totals(self) -> dict:
        return self.counters.totals

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            self.counters.add(name, row.asDict())
        late = sum(operator.numRowsDroppedByWatermark for operator in event.progress.stateOperators)
        if late:
            self.counters.add("late", {"dropped": late})

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass
