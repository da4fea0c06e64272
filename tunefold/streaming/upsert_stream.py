"""The recurring run as a stream: every pull goes through the whole job once it has landed whole.

The warehouse job re-pulled the playlist on a timer and loaded all its tables.
Here new page files are picked up by a file stream. A keyed state per pull
(``pulls.py``) says which pulls have become whole with a micro-batch; their pages
are read from the files that hold them, flattened once and upserted into
``tracks``, ``albums`` and ``artists`` through ``foreachBatch``. A half-landed
pull changes no table. With a job name there are start / success / fail rows in the run log:

* the file source records which files each batch read in the checkpoint
  (kept in the shared folder), so a restarted query resumes after the last
  committed batch and never counts a file twice;
* a batch that is replayed after a failure is upserted again, which changes
  nothing (an upsert is idempotent), so the tables are exactly-once in effect;
* ``trigger(availableNow=True)`` drains what is landed and stops (a scheduled
  run); ``processingTime`` keeps polling (the timer loop).

Within one batch, a track that appears on two pages keeps the row with the
latest ``track_added_at``, an album its latest tuple. Artist documents are read
anew for every batch that loads something, so those that landed with it are found.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.load import TableStore
from ..operators.nested import flatten_items
from ..operators.runlog import RunLog, run_job
from ..plans.job import load_items
from ..schemas import CATALOG_SCHEMAS, PAGE
from ..sources.pages import read_artist_docs, read_playlist_pages
from .pulls import KEY, PROVIDER, ROCKSDB, complete_pulls, pull_key

log = logging.getLogger("tunefold.stream")


def page_stream(spark: SparkSession, landing: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages with the ``file`` that holds each."""
    reader = spark.readStream.schema(PAGE).option("mode", "FAILFAST")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.json(landing).select("*", F.col("_metadata.file_path").alias("file"))


def pages_of(spark: SparkSession, pulls: list) -> DataFrame:
    """The pages of whole pulls, read from their files alone (both lists are as long as the landing's lists of files)."""
    pages = read_playlist_pages(spark, sorted({r["file"] for r in pulls}))
    keys = spark.createDataFrame(sorted({tuple(r[k] for k in KEY) for r in pulls}), "__id string, __snapshot string, __total int")
    same = [c == keys[k] for c, k in zip(pull_key().values(), keys.columns)]
    return pages.join(keys, same, "left_semi")


def stream_catalog(spark: SparkSession, landing: str, artist_docs: str, store: TableStore, checkpoint: str,
                   job_name: str | None = None, max_files_per_trigger: int | None = None,
                   processing_time: str | None = None, query_name: str | None = None,
                   patience_seconds: float | None = None) -> StreamingQuery:
    """Start the stream; with no ``processing_time`` it drains the landing and stops.

    ``patience_seconds``: a pull that is incomplete for longer is reported in the log of the run that notices it.
    It needs a polling stream: timers make a run of every interval, and one that drains would never end.
    """
    if patience_seconds is not None and processing_time is None:
        raise ValueError("patience_seconds needs processing_time")
    store.create_tables(CATALOG_SCHEMAS)
    pulls = complete_pulls(page_stream(spark, landing, max_files_per_trigger), patience_seconds)

    def load_batch(batch: DataFrame, batch_id: int) -> None:
        found = batch.collect()  # one row per file of a pull that became whole
        whole = [r for r in found if r["complete"]]

        def work() -> None:
            for r in found:
                if not r["complete"]:
                    log.warning("pull of %s, snapshot %s, is still incomplete", r["id"], r["snapshot_id"])
            if whole:
                load_items(store, flatten_items(pages_of(spark, whole)), read_artist_docs(spark, artist_docs), "upsert")
            else:
                log.info("no pull became whole")

        if patience_seconds is not None and not found:
            return  # an interval without a landing, or one that completes nothing
        if job_name:
            run_job(RunLog(store), job_name, work, config={"pages": landing, "artists": artist_docs, "batch": batch_id})
        else:
            work()

    writer = pulls.writeStream.outputMode("update").foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(processingTime=processing_time) if processing_time else writer.trigger(availableNow=True)
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)  # the query keeps the settings it starts with
    try:
        return writer.start()
    finally:
        spark.conf.set(PROVIDER, before)
