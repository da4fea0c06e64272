import re

import pytest

from tunefold.operators.load import TableStore
from tunefold.operators.runlog import RUN_FAILURE, RUN_START, RUN_SUCCESS, RunLog, run_job
from tunefold.schemas import RUN_LOG
from tunefold.session import scratch_path
from tunefold.sources.fixtures import derive_artist_docs, materialized_catalog
from tunefold.sources.pages import land_artist_docs, land_pages
from tunefold.streaming.upsert_stream import stream_catalog

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def docs(spark):
    return land_artist_docs(derive_artist_docs(spark, SF_SMALL), scratch_path(spark, "stream-docs"))


def test_stream_loads_all_tables_logs_runs_and_resumes(spark, docs):
    c = materialized_catalog(spark, SF_SMALL)
    landing = scratch_path(spark, "landing")
    land_pages(c.tracks, c.albums, landing, files=3)
    store = TableStore(spark)
    ckpt = scratch_path(spark, "ckpt")
    q = stream_catalog(spark, landing, docs, store, ckpt, job_name="tick", max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    assert rows(store.select_all("tracks")) == rows(c.tracks)
    used = c.albums.join(c.tracks.select("album_id").distinct(), "album_id", "left_semi")
    assert rows(store.select_all("albums")) == rows(used)
    assert store.select_all("artists").count() > 0
    log = RunLog(store).rows()
    assert {(r["run_id"], r["status"]) for r in log.collect()} == {(1, "start"), (1, "success"), (2, "start"), (2, "success")}
    # Restart on the same checkpoint: nothing new to read, table unchanged.
    q2 = stream_catalog(spark, landing, docs, store, ckpt, job_name="tick")
    q2.awaitTermination()
    assert store.select_all("tracks").count() == c.tracks.count() and RunLog(store).next_run_id("tick") == 3


def test_run_log_ids_and_rows(spark):
    store = TableStore(spark)
    log = RunLog(store)
    store.insert(spark.createDataFrame([("a", 1, "2024-01-01 00:00:00", "start", None, None),
                                        ("a", 1, "2024-01-01 00:00:05", "success", None, None),
                                        ("b", 7, "2024-01-01 00:00:00", "fail", None, None)], RUN_LOG.struct),
                 RUN_LOG.name)
    assert (log.next_run_id("a"), log.next_run_id("b"), log.next_run_id("zzz")) == (2, 8, 1)
    log.log("c", 1, RUN_START, config={"x": 1})
    ts = log.rows().where("pipeline_name = 'c'").first()["timestamp"]
    assert re.fullmatch(r"\d{4}-\d\d-\d\d \d\d:\d\d:\d\d", ts)
    with pytest.raises(ValueError):
        log.log("c", 1, "weird")


def test_run_job_logs_success_and_failure(spark):
    log = RunLog(TableStore(spark))
    assert run_job(log, "j", lambda: 42) == 42

    def boom():
        raise RuntimeError("no")

    with pytest.raises(RuntimeError):
        run_job(log, "j", boom)
    assert run_job(log, "j", boom, raise_on_error=False) is None
    got = sorted((r["run_id"], r["status"]) for r in log.rows().collect())
    assert got == [(1, RUN_START), (1, RUN_SUCCESS), (2, RUN_FAILURE), (2, RUN_START), (3, RUN_FAILURE), (3, RUN_START)]


def test_polling_stream_follows_new_landings(spark, docs):
    from pyspark.sql import functions as F

    c = materialized_catalog(spark, SF_SMALL)
    first = c.tracks.where(F.col("playlist_id") <= "3")
    landing = scratch_path(spark, "landing-poll")
    land_pages(first, c.albums, landing, files=1)
    store = TableStore(spark)
    q = stream_catalog(spark, landing, docs, store, scratch_path(spark, "ckpt-poll"), processing_time="1 second")
    try:
        q.processAllAvailable()
        assert rows(store.select_all("tracks")) == rows(first)
        land_pages(c.tracks.where(F.col("playlist_id") > "3"), c.albums, landing, files=1, append=True)
        q.processAllAvailable()
        assert rows(store.select_all("tracks")) == rows(c.tracks)
    finally:
        q.stop()
