"""The status of links as a keyed state machine over a stream of events.

A link is found once, with a priority: high ones are pending until their page
has been read, medium ones are queued, low ones are ignored. Reading a page with
enough text makes a pending or queued link scraped; a failed reading changes
nothing. A pending link whose page hasn't been read within `patience` expires: a
timer tells when no event does. Events of one link count in the order of time
and number, so the transitions don't depend on how events fall into batches, as
long as none is later than the watermark.

State per link: its status and when it began. Scraped, ignored and expired links
keep their state, so that finding them again changes nothing.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

FOUND = {"high": "pending", "medium": "queued", "low": "ignored"}
TRANSITION = "link string, at timestamp, before string, after string"
COLUMNS = ["link", "at", "before", "after"]


def advance(status: str | None, since: int, at: int, kind: str, detail: str, patience: int) -> list[tuple[int, str | None, str]]:
    """(when, before, after) of the changes that one event makes; times in microseconds.

    kind: 'found' (detail: its priority), 'read' (detail: 'enough' or anything else).
    """
    changes = []
    if status == "pending" and at > since + patience:
        changes.append((since + patience, status, "expired"))
        status = "expired"
    if kind == "found" and status is None and detail in FOUND:
        changes.append((at, None, FOUND[detail]))
    elif kind == "read" and detail == "enough" and status in ("pending", "queued"):
        changes.append((at, status, "scraped"))
    return changes


class StatusProcessor(StatefulProcessor):
    def __init__(self, patience: int) -> None:
        self.patience = patience

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("status", "status string, since long")

    def _rows(self, link: str, changes: list[tuple[int, str | None, str]]) -> Iterator[pd.DataFrame]:
        if changes:
            at, _, after = changes[-1]
            self.held.update((after, at))
            if after == "pending":
                self.handle.registerTimer((at + self.patience) // 1000 + 1)
            yield pd.DataFrame([(link, pd.Timestamp(t, unit="us"), b, a) for t, b, a in changes], columns=COLUMNS)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        events = pd.concat(list(rows)).sort_values(["at", "number"])
        status, since = self.held.get() if self.held.exists() else (None, 0)
        changes: list[tuple[int, str | None, str]] = []
        for at, kind, detail in zip(events["at"].astype("datetime64[us]").astype("int64"), events["kind"], events["detail"], strict=True):
            made = advance(status, since, int(at), kind, detail, self.patience)
            changes += made
            if made:
                since, _, status = made[-1]
        yield from self._rows(key[0], changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        status, since = self.held.get() if self.held.exists() else (None, 0)
        if status == "pending" and expiredTimerInfo.getExpiryTimeInMs() * 1000 > since + self.patience:
            yield from self._rows(key[0], [(since + self.patience, status, "expired")])

    def close(self) -> None:
        pass


def transitions(events: DataFrame, patience_s: int, late: str = "1 hour") -> DataFrame:
    """Changes of status from a stream of events: link, at, number, kind, detail. Needs a state store that keeps timers."""
    spark = events.sparkSession
    # the driver's own Python worker, which asks the processor for its state first, doesn't see shipped files
    cloudpickle.register_pickle_by_value(sys.modules[__name__])
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    keyed = events.withWatermark("at", late).groupBy("link")
    return keyed.transformWithStateInPandas(StatusProcessor(patience_s * 1_000_000), TRANSITION, "Append", "EventTime")
