"""Completeness of pulls in a stream of landed pages: state per (playlist, snapshot, total).

The warehouse job read every page of a pull or failed. In a stream the pages of
one pull can land in several micro-batches, so a pull is held back until it is
whole: as many items as ``total`` times the number of its last pages
(``check_pages_complete`` has the same rule for a batch).

The state of a pull is two counts and the landed files that hold its pages, not the
pages themselves: they stay in the landing until the pull is whole, and are read
then. So what is shuffled to a key is one narrow row per page, and what a task
holds of a pull is its file names. A pull that stays incomplete for longer than ``patience`` is
reported once by a timer; pages that land later still complete it.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

from ..sources.pages import is_last_page

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

KEY = ("id", "snapshot_id", "total")
PULLS = "id string, snapshot_id string, total int, file string, complete boolean"


def pull_key() -> dict[str, Column]:
    """The key of a page's pull; a page without ``total`` is of a pull that can't be shown to be whole."""
    return {
        "id": F.coalesce("id", F.lit("")),
        "snapshot_id": F.coalesce("snapshot_id", F.lit("")),
        "total": F.coalesce("tracks.total", F.lit(-1)),
    }


class PullState(StatefulProcessor):
    """Counts a pull's items and last pages, and gives out its files when they agree with its total."""

    def __init__(self, patience_ms: int | None = None):
        self.patience = patience_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.counts = handle.getValueState("counts", "items long, last_pages long")
        self.files = handle.getMapState("files", "file string", "pages long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        items, last = self.counts.get() if self.counts.exists() else (0, 0)
        if self.patience is not None and not self.counts.exists():
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.patience)
        landed: dict[str, int] = {}
        for r in rows:
            items, last = items + r.items, last + r.last
            landed[r.file] = landed.get(r.file, 0) + 1
        for file, pages in landed.items():
            self.files.updateValue((file,), ((self.files.getValue((file,))[0] if self.files.containsKey((file,)) else 0) + pages,))
        if last > 0 and items == last * key[2]:
            for (file,) in list(self.files.keys()):
                yield Row(id=key[0], snapshot_id=key[1], total=key[2], file=file, complete=True)
            self._forget()
        else:
            self.counts.update((items, last))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        if self.counts.exists():
            yield Row(id=key[0], snapshot_id=key[1], total=key[2], file=None, complete=False)

    def _forget(self) -> None:
        self.counts.clear()
        self.files.clear()
        if self.patience is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)

    def close(self) -> None:
        pass


def complete_pulls(pages: DataFrame, patience_seconds: float | None = None) -> DataFrame:
    """(``PULLS``) of a stream of pages with their ``file``: the files of every pull that became whole, and the overdue ones."""
    rows = pages.select(
        *(c.alias(n) for n, c in pull_key().items()),
        F.coalesce(F.size("tracks.items"), F.lit(0)).cast("long").alias("items"),
        is_last_page().cast("long").alias("last"), "file")
    patience = None if patience_seconds is None else int(patience_seconds * 1000)
    return rows.groupBy(*KEY).transformWithState(
        statefulProcessor=PullState(patience), outputStructType=PULLS, outputMode="Update",
        timeMode="None" if patience is None else "ProcessingTime")
