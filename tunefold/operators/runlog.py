"""Append-only run log: ``(pipeline_name, run_id, timestamp, status, config, logs)``.

* ``next_run_id(name)``: ``max(run_id) + 1`` for that job, or 1; one filtered
  aggregate. The log is partitioned by job, so only that job's files are read.
* ``next_run_ids()``: the same for every job at once, a grouped aggregate.
* ``log(...)``: append one row; the timestamp defaults to now as
  ``yyyy-MM-dd HH:mm:ss`` (session time zone), taken by Spark, not Python.
* ``append(rows)``: append many rows in one write (``TableStore.compact`` joins small files, between runs).
* ``run_job(...)``: log ``start``, run the work, log ``success`` or ``fail``.

Run ids assume one writer per job name at a time, as the warehouse version
did (``max + 1`` without a lock).
"""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from dataclasses import replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import RUN_LOG
from .load import TableStore

# The three run statuses.
RUN_START = "start"
RUN_SUCCESS = "success"
RUN_FAILURE = "fail"
STATUSES = (RUN_START, RUN_SUCCESS, RUN_FAILURE)

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def next_run_ids(log: DataFrame) -> DataFrame:
    """``(pipeline_name, next_run_id)`` for every job in the log."""
    return log.groupBy("pipeline_name").agg((F.max("run_id") + 1).cast("int").alias("next_run_id"))


def next_run_id_of(log: DataFrame, pipeline_name: str) -> DataFrame:
    """``(pipeline_name, next_run_id)`` of one job, 1 if it never ran; the name is filtered in the scan."""
    return log.where(F.col("pipeline_name") == F.lit(pipeline_name)).agg(
        F.lit(pipeline_name).alias("pipeline_name"),
        (F.coalesce(F.max("run_id"), F.lit(0)) + 1).cast("int").alias("next_run_id"))


class RunLog:
    def __init__(self, store: TableStore, table: str = RUN_LOG.name):
        self.store = store
        self.table = table
        schema = RUN_LOG if table == RUN_LOG.name else replace(RUN_LOG, name=table)
        store.create_tables([schema])

    def rows(self) -> DataFrame:
        return self.store.select_all(self.table)

    def next_run_id(self, pipeline_name: str) -> int:
        return int(next_run_id_of(self.rows(), pipeline_name).first()["next_run_id"])

    def next_run_ids(self) -> DataFrame:
        return next_run_ids(self.rows())

    def append(self, rows: DataFrame) -> None:
        """Append log rows (the composite key must stay unique)."""
        bad = rows.where(~F.col("status").isin(*STATUSES)).limit(1).count()
        if bad:
            raise ValueError(f"status must be one of {STATUSES}")
        self.store.insert(rows, self.table)

    def log(self, pipeline_name: str, run_id: int, status: str = RUN_START, timestamp: str | None = None,
            config: dict | str | None = None, logs: str | None = None) -> None:
        spark = self.store.spark
        cfg = config if config is None or isinstance(config, str) else json.dumps(config, sort_keys=True)
        ts = F.lit(timestamp) if timestamp is not None else F.date_format(F.current_timestamp(), TIMESTAMP_FORMAT)
        row = spark.range(1).select(
            F.lit(pipeline_name).alias("pipeline_name"), F.lit(run_id).cast("int").alias("run_id"),
            ts.alias("timestamp"), F.lit(status).alias("status"),
            F.lit(cfg).cast("string").alias("config"), F.lit(logs).cast("string").alias("logs"))
        self.append(row)


class _Capture(logging.Handler):
    """Collects the ``tunefold`` log records of one run as text."""

    def __init__(self):
        super().__init__(logging.INFO)
        self.lines: list[str] = []
        self.setFormatter(logging.Formatter("%(asctime)s %(levelname)s %(name)s: %(message)s"))

    def emit(self, record: logging.LogRecord) -> None:
        self.lines.append(self.format(record))


def run_job(run_log: RunLog, pipeline_name: str, work: Callable[[], Any], config: dict | None = None,
            raise_on_error: bool = True, logs: Callable[[], str] | None = None) -> Any:
    """Log start, run ``work()``, log success or fail (then re-raise unless ``raise_on_error=False``).

    Messages sent to the ``tunefold`` logger during the run are stored in the
    ``logs`` column of the success / fail row (``logs()`` overrides them).
    """
    run_id = run_log.next_run_id(pipeline_name)
    run_log.log(pipeline_name, run_id, RUN_START, config=config)
    logger = logging.getLogger("tunefold")
    capture = _Capture()
    logger.addHandler(capture)
    old_level = logger.level
    if logger.getEffectiveLevel() > logging.INFO:
        logger.setLevel(logging.INFO)

    def text() -> str | None:
        if logs:
            return logs()
        return "\n".join(capture.lines) or None

    try:
        try:
            result = work()
        except BaseException as e:  # noqa: BLE001 - the failure is logged first
            logger.error("run %s of %s failed: %s: %s", run_id, pipeline_name, type(e).__name__, e)
            run_log.log(pipeline_name, run_id, RUN_FAILURE, config=config, logs=text())
            if raise_on_error:
                raise
            return None
        run_log.log(pipeline_name, run_id, RUN_SUCCESS, config=config, logs=text())
        return result
    finally:
        logger.removeHandler(capture)
        logger.setLevel(old_level)
