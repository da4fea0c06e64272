"""Registry of query keys: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables in full, or what Spark derives from
them: the catalogue tables are derived once per application and written to
the shared folder (as the warehouse keeps its loaded tables), and the page and
artist-document landings are written from them the same way. Load and stream
keys write to a fresh store under the shared folder and return what a reader
of the table sees afterwards.
"""

from __future__ import annotations

import hashlib
import logging
import tempfile
from collections.abc import Callable
from functools import reduce
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import format_duration
from ..operators.catalog import build_catalog, enrich_artists
from ..operators.load import TableStore
from ..operators.nested import collect_artist_ids, distinct_artist_ids, flatten_items
from ..operators.ranking import dense_rank_global, ranked_keys, top_k_with_ties
from ..operators.runlog import RUN_START, RunLog, next_run_id_of, next_run_ids, run_job
from ..schemas import CATALOG_SCHEMAS, RUN_LOG
from ..session import scratch_path, shared_dir, written
from ..sources.fixtures import derive_artist_docs, derive_run_history, materialized_catalog
from ..sources.pages import (
    check_pages_complete,
    is_last_page,
    land_artist_docs,
    land_pages,
    page_rows,
    read_artist_docs,
    read_playlist_pages,
)
from ..sources.paging import land_numbered, read_paged, stream_paged
from ..streaming.upsert_stream import stream_catalog
from . import views as V

QueryFn = Callable[[SparkSession, str], DataFrame]

# Fixed values of the run-log append case.
APPEND_TIMESTAMP = "2024-02-01 00:00:00"
APPEND_CONFIG = '{"source": "events"}'

_LANDED: dict[tuple[str, str, str], str] = {}


#: Files of a landing for each shuffle partition: a file is gzipped, so one task reads it.
FILES_PER_PARTITION = 4


def _landing_files(spark: SparkSession) -> int:
    return FILES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))


def _cat(spark: SparkSession, sf_dir: str):
    return materialized_catalog(spark, sf_dir)


def _landed(spark: SparkSession, sf_dir: str, what: str, land: Callable[[str], str]) -> str:
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), what)
    if key not in _LANDED:
        tag = hashlib.sha1(key[1].encode()).hexdigest()[:10]
        _LANDED[key] = land(f"{shared_dir(spark)}/tunefold-landing/{key[0]}/{tag}/{what}")
    return _LANDED[key]


def landed_pages(spark: SparkSession, sf_dir: str) -> str:
    """The page landing derived from the catalogue, written once per application."""
    def land(path: str) -> str:
        c = _cat(spark, sf_dir)
        return land_pages(c.tracks, c.albums, path, files=_landing_files(spark))

    return _landed(spark, sf_dir, "pages", land)


def landed_docs(spark: SparkSession, sf_dir: str) -> str:
    """The same of the artist documents."""
    return _landed(spark, sf_dir, "artist_docs", lambda path: land_artist_docs(derive_artist_docs(spark, sf_dir), path))


def landing(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    """Page and artist-document landings."""
    return landed_pages(spark, sf_dir), landed_docs(spark, sf_dir)


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_playlist_pages(spark, landed_pages(spark, sf_dir))


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_artist_docs(spark, landed_docs(spark, sf_dir))


def _store(spark: SparkSession, joined_rows: int = 0) -> TableStore:
    """A fresh store; ``joined_rows``: rows of the largest table that views join."""
    store = TableStore(spark, scratch_path(spark, "store"))
    store.create_tables({n: s.joined_with(joined_rows) for n, s in CATALOG_SCHEMAS.items()})
    return store


# -- sources and nested data -------------------------------------------------

def q_read_playlist_pages(spark, sf_dir):
    p = _pages(spark, sf_dir)
    check_pages_complete(p)  # every pull landed whole
    return p.select("id", "name", "snapshot_id", F.size("tracks.items").cast("bigint").alias("n_items"),
                    F.col("tracks.total").cast("bigint").alias("total"), F.col("tracks.next").alias("next_page"))


def _numbered_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with the number of their pull (one a playlist, by id) and their number in it, both from 0."""
    c = _cat(spark, sf_dir)
    pages = written(page_rows(c.tracks, c.albums), "numbered-pages")
    keys = pages.select("id", F.struct("id", "page_no").alias("at"))
    in_order = written(ranked_keys(keys, "at", "n", descending=False).toDF("at", "n"), "page-order")
    pulls = written(ranked_keys(keys, "id", "n", descending=False).toDF("id", "pull_no"), "pull-order")
    first = in_order.groupBy("at.id").agg(F.min("n").alias("first")).join(pulls, "id")
    numbers = in_order.join(first, F.col("at.id") == first["id"]).select(
        F.col("at.id").alias("id"), F.col("at.page_no").alias("page_no"),
        (F.col("pull_no") - 1).alias("pull"), (F.col("n") - F.col("first")).alias("page"))
    return pages.join(numbers, ["id", "page_no"])


def _page_columns() -> list:
    return [F.col("pull"), F.col("page"), F.col("id"), F.size("tracks.items").cast("bigint").alias("n_items"),
            F.col("tracks.total").cast("bigint").alias("total"), F.col("tracks.next").alias("next_page")]


def q_read_paged_source(spark, sf_dir):
    path = land_numbered(_numbered_pages(spark, sf_dir), scratch_path(spark, "paged"), F.col("pull"), F.col("page"))
    return read_paged(spark, path).select(*_page_columns())


def q_stream_paged_source(spark, sf_dir):
    # Page 1 of pull 1 lands last: the first run stops before it, the second one goes on there.
    pages = written(_numbered_pages(spark, sf_dir), "numbered")
    path, out, checkpoint = (scratch_path(spark, f"paged-{x}") for x in ("landing", "out", "checkpoint"))
    late = (F.col("pull") == 1) & (F.col("page") == 1)

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/step={batch_id + 1}")  # a batch run again replaces itself

    for only in (~late, late):
        land_numbered(pages.where(only), path, F.col("pull"), F.col("page"))
        q = stream_paged(spark, path).select(*_page_columns()).writeStream.foreachBatch(keep)
        q = q.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    return spark.read.parquet(out)


def q_flatten_items(spark, sf_dir):
    return flatten_items(_pages(spark, sf_dir)).drop("track_artists")


def q_collect_artist_ids(spark, sf_dir):
    items = flatten_items(_pages(spark, sf_dir))
    return items.select("track_id", collect_artist_ids("track_artists").alias("artist_id"))


def q_distinct_artist_ids(spark, sf_dir):
    return distinct_artist_ids(flatten_items(_pages(spark, sf_dir)))


def q_artist_enrichment(spark, sf_dir):
    ids = distinct_artist_ids(flatten_items(_pages(spark, sf_dir)))
    return enrich_artists(ids, _docs(spark, sf_dir))


def q_catalog_tracks(spark, sf_dir):
    return build_catalog(_pages(spark, sf_dir), _docs(spark, sf_dir), check_artists=False).tracks


def q_catalog_albums(spark, sf_dir):
    return build_catalog(_pages(spark, sf_dir), _docs(spark, sf_dir), check_artists=False).albums


def q_catalog_artists(spark, sf_dir):
    return build_catalog(_pages(spark, sf_dir), _docs(spark, sf_dir)).artists


def q_unnest_track_artists(spark, sf_dir):
    return V.track_artists(_cat(spark, sf_dir).tracks)


def q_unnest_artist_genres(spark, sf_dir):
    return V.artist_genres(_cat(spark, sf_dir).artists)


def q_format_duration(spark, sf_dir):
    t = _cat(spark, sf_dir).tracks
    return t.select("track_id", "track_duration_ms", format_duration("track_duration_ms").alias("track_duration_min"))


def q_top_k_with_ties(spark, sf_dir):
    a = _cat(spark, sf_dir).artists.select("artist_id", "artist_name", "artist_popularity")
    return top_k_with_ties(a, "artist_popularity", V.TOP_ARTISTS, "artist_popularity_rnk")


def q_dense_rank_global(spark, sf_dir):
    t = _cat(spark, sf_dir).tracks.select("track_id", "track_popularity")
    return dense_rank_global(t, "track_popularity", "popularity_rnk")


# -- loads ---------------------------------------------------------------------

def q_load_insert(spark, sf_dir):
    # Two inserts with disjoint keys that together hold every track.
    t = _cat(spark, sf_dir).tracks
    store = _store(spark)
    store.insert(t.where(F.col("track_popularity").isNotNull()), "tracks")
    store.insert(t.where(F.col("track_popularity").isNull()), "tracks")
    return store.select_all("tracks")


def q_load_overwrite(spark, sf_dir):
    # Every track, then replaced by the tracks that are on an album.
    t = _cat(spark, sf_dir).tracks
    store = _store(spark)
    store.overwrite(t, "tracks")
    store.overwrite(t.where(F.col("album_id").isNotNull()), "tracks")
    return store.select_all("tracks")


def _updates(tracks: DataFrame) -> DataFrame:
    """The tracks with a popularity, one higher: on an album they exist already, others are new."""
    rated = tracks.where(F.col("track_popularity").isNotNull())
    return rated.withColumn("track_popularity", F.col("track_popularity") + 1)


def q_load_upsert(spark, sf_dir):
    # Target: tracks on an album. Batch: tracks with a popularity. So some rows are
    # kept (on an album, no popularity), some updated, some inserted.
    t = _cat(spark, sf_dir).tracks
    store = _store(spark)
    store.overwrite(t.where(F.col("album_id").isNotNull()), "tracks")
    store.upsert(_updates(t), "tracks")
    store.upsert(_updates(t), "tracks")  # a second application changes nothing
    return store.select_all("tracks")


def q_load_drop_recreate(spark, sf_dir):
    # A dropped table's rows are gone when a table of its name is created again.
    t = _cat(spark, sf_dir).tracks
    store = _store(spark)
    store.overwrite(t.where(F.col("track_popularity").isNotNull()), "tracks")
    store.drop_table("tracks")
    store.create_tables(CATALOG_SCHEMAS)
    store.insert(t.where(F.col("album_id").isNotNull()), "tracks")
    return store.select_all("tracks")


_STREAMED: dict[tuple[str, str], TableStore] = {}


def _streamed(spark: SparkSession, sf_dir: str) -> TableStore:
    """Two pulls, the second with changed and new tracks, each run through the stream."""
    c = _cat(spark, sf_dir)
    docs = landed_docs(spark, sf_dir)
    pages = scratch_path(spark, "stream-landing")
    store, checkpoint = _store(spark), scratch_path(spark, "stream-checkpoint")
    files = _landing_files(spark)
    for pull, tracks in enumerate((c.tracks.where(F.col("album_id").isNotNull()), _updates(c.tracks))):
        land_pages(tracks, c.albums, pages, files=files, append=pull > 0)
        q = stream_catalog(spark, pages, docs, store, checkpoint, job_name="stream")
        q.awaitTermination()
        if q.exception():
            raise q.exception()
    _STREAMED[spark.sparkContext.applicationId, sf_dir] = store
    return store


def _last_streamed(spark: SparkSession, sf_dir: str) -> TableStore:
    return _STREAMED.get((spark.sparkContext.applicationId, sf_dir)) or _streamed(spark, sf_dir)


def q_stream_upsert(spark, sf_dir):
    return _streamed(spark, sf_dir).select_all("tracks")


def q_stream_albums(spark, sf_dir):
    return _last_streamed(spark, sf_dir).select_all("albums")


def q_stream_artists(spark, sf_dir):
    return _last_streamed(spark, sf_dir).select_all("artists")


def q_stream_half_landed_pull(spark, sf_dir):
    # First all pages but the last one of a playlist, then that one: the playlist's tracks come with it, at once.
    c = _cat(spark, sf_dir)
    docs = landed_docs(spark, sf_dir)
    pages = scratch_path(spark, "half-landing")
    store, checkpoint = _store(spark), scratch_path(spark, "half-checkpoint")
    held = c.tracks.agg(F.min("playlist_id")).first()[0]
    late = (F.col("id") == held) & is_last_page()
    states = []
    for step, only in enumerate((~late, late), 1):
        land_pages(c.tracks, c.albums, pages, files=_landing_files(spark) if step == 1 else None, append=step > 1, only=only)
        q = stream_catalog(spark, pages, docs, store, checkpoint)
        q.awaitTermination()
        if q.exception():
            raise q.exception()
        rows = store.select_all("tracks").select(F.lit(step).alias("step"), "track_id", "track_popularity", "playlist_id")
        states.append(written(rows, "half-state"))
    return states[0].unionByName(states[1])


def q_select_all(spark, sf_dir):
    store = _store(spark)
    store.load({"tracks": _cat(spark, sf_dir).tracks}, method="overwrite")
    return store.select_all("tracks")


# -- run log ---------------------------------------------------------------------

def q_run_log_next_id(spark, sf_dir):
    return next_run_ids(derive_run_history(spark, sf_dir))


def q_run_log_next_id_of_job(spark, sf_dir):
    # One job of the log, and one that never ran.
    log = derive_run_history(spark, sf_dir)
    names = log.agg(F.min("pipeline_name")).first()[0], "never ran"
    one, none = (next_run_id_of(log, n) for n in names)
    return one.unionByName(none)


def q_run_log_append(spark, sf_dir):
    store = TableStore(spark, scratch_path(spark, "runlog"))
    log = RunLog(store)
    # events of one job, user, second and status are as many rows of the history
    store.overwrite(derive_run_history(spark, sf_dir), RUN_LOG.name, repeats=True)
    starts = log.next_run_ids().select(
        "pipeline_name", F.col("next_run_id").alias("run_id"), F.lit(APPEND_TIMESTAMP).alias("timestamp"),
        F.lit(RUN_START).alias("status"), F.lit(APPEND_CONFIG).alias("config"),
        F.lit(None).cast("string").alias("logs"))
    log.append(starts)
    return log.rows()


def q_run_job_log(spark, sf_dir):
    # A job of the history runs again twice, once well and once not; the log's own columns as a reader checks them.
    store = TableStore(spark, scratch_path(spark, "runjob"))
    log = RunLog(store)
    # events of one job, user, second and status are as many rows of the history
    store.overwrite(derive_run_history(spark, sf_dir), RUN_LOG.name, repeats=True)
    job = log.rows().agg(F.min("pipeline_name")).first()[0]
    tracks = _cat(spark, sf_dir).tracks

    def fails():
        raise LookupError("no artist document")

    run_job(log, job, lambda: logging.getLogger("tunefold.job").info("%s tracks", tracks.count()), config={"source": "events"})
    run_job(log, job, fails, raise_on_error=False)
    return log.rows().select(
        "pipeline_name", "run_id", "status", F.col("timestamp").rlike(r"^\d{4}-\d\d-\d\d \d\d:\d\d:\d\d$").alias("is_time"),
        "config", F.regexp_extract("logs", r"INFO tunefold\.job: (\d+ tracks)", 1).alias("said"),
        F.col("logs").contains("LookupError: no artist document").alias("names_error"))


# -- views from SQL files ------------------------------------------------------------

# A user's own file, beside the five that come with the package.
PLAYLISTS_SQL = """
-- Tracks, albums and mean duration of every playlist.
SELECT playlist_id, count(*) AS num_tracks, count(DISTINCT album_id) AS num_albums,
       CAST(sum(track_duration_ms) DIV count(track_duration_ms) AS bigint) AS mean_duration_ms
FROM IDENTIFIER(:tracks) GROUP BY playlist_id;
"""
_FOLDERS: dict[tuple[str, str], TableStore] = {}


def _sql_store(spark: SparkSession, sf_dir: str) -> TableStore:
    """Loaded tables with the views of the package's folder and of a folder with one more file, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    if key not in _FOLDERS:
        c = _cat(spark, sf_dir)
        tables = {"tracks": c.tracks, "albums": c.albums, "artists": c.artists}
        # The views join albums and artists by their keys with the tracks: each is laid out for the most rows.
        store = _store(spark, max(df.count() for df in tables.values()))
        store.load(tables, method="overwrite")
        V.create_views(store)
        with tempfile.TemporaryDirectory() as folder:
            (Path(folder) / "playlists.sql").write_text(PLAYLISTS_SQL, encoding="utf-8")
            V.create_views(store, folder)
        _FOLDERS[key] = store
    return _FOLDERS[key]


def q_sql_folder_views(spark, sf_dir):
    store = _sql_store(spark, sf_dir)
    names = [r["viewName"] for r in spark.sql(f"SHOW VIEWS IN `{store.database}`").where("not isTemporary").collect()]
    counts = [V.read_view(store, n).agg(F.lit(n).alias("view_name"), F.count("*").alias("num_rows")) for n in names]
    return reduce(DataFrame.unionByName, counts)


def q_sql_playlists(spark, sf_dir):
    return V.read_view(_sql_store(spark, sf_dir), "playlists")


def _sql_view(name: str) -> QueryFn:
    return lambda spark, sf_dir: V.read_view(_sql_store(spark, sf_dir), name)


# -- views -------------------------------------------------------------------------

def q_most_popular_tracks_with_duration(spark, sf_dir):
    return V.most_popular_tracks_with_duration(_cat(spark, sf_dir).tracks)


def q_top_5_most_popular_artists_contribution(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return V.top_5_most_popular_artists_contribution(c.tracks, c.artists)


def q_track_popularity_trend_by_release_year_month(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return V.track_popularity_trend_by_release_year_month(c.tracks, c.albums)


def q_album_track_popularity_comparison(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return V.album_track_popularity_comparison(c.tracks, c.albums)


def q_genre_track_and_artist_details(spark, sf_dir):
    c = _cat(spark, sf_dir)
    return V.genre_track_and_artist_details(c.tracks, c.artists)


def q_genre_names(spark, sf_dir):
    """What a writer of the long form would stream, by list: never a whole list in one value."""
    c = _cat(spark, sf_dir)
    return V.genre_names(c.tracks, c.artists).groupBy("genre", "kind").agg(
        F.sum("num_values").alias("num_names"), F.min("first").alias("first_name"), F.max("last").alias("last_name"),
        (F.sum(F.length("text")) + 2 * (F.count("text") - 1)).cast("bigint").alias("num_chars"))


QUERY_KEYS = (
    "read_playlist_pages", "flatten_items", "collect_artist_ids", "distinct_artist_ids",
    "artist_enrichment", "unnest_track_artists", "unnest_artist_genres", "format_duration",
    "top_k_with_ties", "catalog_tracks", "catalog_albums", "catalog_artists", "load_insert",
    "load_overwrite", "load_upsert", "stream_upsert", "stream_albums", "stream_artists", "select_all",
    "run_log_next_id", "run_log_next_id_of_job", "run_log_append",
    "most_popular_tracks_with_duration", "top_5_most_popular_artists_contribution",
    "track_popularity_trend_by_release_year_month", "album_track_popularity_comparison",
    "genre_track_and_artist_details", "dense_rank_global",
    "load_drop_recreate", "stream_half_landed_pull", "run_job_log", "sql_folder_views", "sql_playlists",
    "genre_names", "read_paged_source", "stream_paged_source",
)


def all_queries() -> dict[str, QueryFn]:
    g = globals()
    return {k: g[f"q_{k}"] for k in QUERY_KEYS} | {f"sql_{n}": _sql_view(n) for n in V.VIEW_NAMES}

