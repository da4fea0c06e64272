"""The five analytic views over ``tracks`` / ``albums`` / ``artists``.

Each view is a function ``DataFrame... -> DataFrame``; ``register_views``
publishes them in a session. ``create_views`` creates views of the catalog from a
folder of SQL files (create-if-missing, like the warehouse setup step): the five in
``tunefold/sql``, for popularities from 0 to 100, or a user's own. Building a view runs no job.

Shape of every plan (see ``.explain`` / PLANS.md): no window without a
partition, and no aggregate gathers a whole group into one task. The one
exception is the finished name list of a genre, which is itself the output value.

* Global dense ranks go through ``dense_rank_global`` (range-partitioned ranks of
  the distinct key values, joined back).
* Window averages/counts per album or month are partial aggregates joined
  back: a hot album or month is combined map-side instead of sorted in one task.
* The whole-relation average is a one-row scalar subquery.
* Tracks without an album are spread over all tasks in the tracks-albums
  left join instead of hashing to one reducer.
* The genre rollup tags track-side and artist-side rows and runs one distinct
  pass for both counts and one chunked, range-partitioned pass for both name lists.
* Final ``ORDER BY`` keys get a unique tie-breaker, so a range partition is
  never one giant tie.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.agg import joined_chunks, sorted_distinct_chunks
from ..functions.text import (
    array_text_elements,
    explode_list,
    format_duration,
    round_half_away_int,
    year_month,
)
from ..operators.joins import left_join_spread_nulls
from ..operators.ranking import dense_rank_global, top_k_with_ties
from ..operators.setlists import spread_set_lists
from ..schemas import CATALOG_SCHEMAS
from ..session import spread_session

TOP_ARTISTS = 5
#: Partitions of the widest exchange for each shuffle partition.
WIDE = 8


def track_artists(tracks: DataFrame, *extra: str) -> DataFrame:
    """One row per (track, artist id) from the ``', '``-joined id text; no row for NULL or ``''``."""
    return tracks.select("track_id", *extra, explode_list("artist_id").alias("artist_id"))


def artist_genres(artists: DataFrame, *extra: str) -> DataFrame:
    """One row per (artist, genre) parsed from the array text; ``{}`` and NULL give no row."""
    return artists.select("artist_id", *extra, F.explode(array_text_elements("artist_genres")).alias("genre"))


def most_popular_tracks_with_duration(tracks: DataFrame, ordered: bool = True) -> DataFrame:
    t = tracks.select(
        "track_id", "track_name", "track_popularity",
        format_duration("track_duration_ms").alias("track_duration_min"))
    r = dense_rank_global(t, "track_popularity", "popularity_rnk")
    out = r.select("track_id", "track_name", "track_popularity", "track_duration_min", "popularity_rnk")
    return out.orderBy("popularity_rnk", "track_id") if ordered else out


def top_5_most_popular_artists_contribution(tracks: DataFrame, artists: DataFrame,
                                            k: int = TOP_ARTISTS, ordered: bool = True) -> DataFrame:
    # Rank over all artists first (an absent top artist still takes its rank).
    top = top_k_with_ties(artists.select("artist_id", "artist_name", "artist_popularity"),
                          "artist_popularity", k, "artist_popularity_rnk")
    ta = track_artists(tracks)
    j = ta.join(top, "artist_id")
    out = j.groupBy("artist_name", "artist_popularity", "artist_popularity_rnk").agg(
        F.count_distinct("track_id").alias("total_tracks_contributed"))
    return out.orderBy("artist_popularity_rnk", "artist_name", "artist_popularity") if ordered else out


def track_popularity_trend_by_release_year_month(tracks: DataFrame, albums: DataFrame,
                                                 ordered: bool = True) -> DataFrame:
    t = tracks.select("track_id", "album_id", "track_popularity")
    a = albums.select("album_id", "album_name", year_month("album_release_date").alias("album_release_year_month"))
    # The rows and the month totals both read the join: its two shuffles serve both, as both ask for the same
    # columns (the count of names and the last sort key change no result) and Spark reuses what is equal. A hot
    # album stays AQE's to split, so no explicit placement; where the albums are broadcast, nothing is shuffled.
    rows = left_join_spread_nulls(t, a, "album_id", "track_id")
    # Totals are combined map-side by month; never one task per hot month.
    m = (rows.groupBy(F.col("album_release_year_month").alias("__ym"))
         .agg(F.sum("track_popularity").alias("s"), F.count("track_popularity").alias("c"),
              F.count("track_id").alias("n"), F.count("album_name").alias("named"), F.count(F.lit(1)).alias("all"))
         .where("named <= all")
         .select("__ym", round_half_away_int(F.try_divide(F.col("s"), F.col("c")))
                 .alias("avg_release_year_month_track_popularity"),
                 F.col("n").cast("bigint").alias("num_tracks_per_release_year_month")))
    j = rows.join(m, rows["album_release_year_month"].eqNullSafe(m["__ym"]), "left").drop("__ym")
    if ordered:
        j = j.orderBy(F.col("album_release_year_month").desc_nulls_first(), "track_id", "track_popularity")
    return j.select("album_name", "album_release_year_month", "avg_release_year_month_track_popularity",
                    "num_tracks_per_release_year_month")


def album_track_popularity_comparison(tracks: DataFrame, albums: DataFrame, ordered: bool = True) -> DataFrame:
    per_album = tracks.groupBy("album_id").agg(
        F.count("track_id").alias("n"), F.sum("track_popularity").alias("s"),
        F.count("track_popularity").alias("c"))
    am = albums.join(per_album, "album_id", "left").select(
        "album_name", "album_release_date", "album_total_tracks",
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("num_tracks_in_playlist"),
        round_half_away_int(F.try_divide(F.col("s"), F.col("c"))).alias("avg_album_track_popularity"),
        "s", F.coalesce(F.col("c"), F.lit(0)).alias("c"))
    # The distinct tuples with their sums. The rows, the rank's keys and the overall mean all read this
    # one exchange: the filter (a sum is there only where something was counted, so it holds for
    # every row) has each of them ask for the same columns, and Spark reuses what is equal.
    tuples = (am.groupBy("album_name", "album_release_date", "album_total_tracks", "num_tracks_in_playlist",
                         "avg_album_track_popularity")
              .agg(F.sum("s").alias("s"), F.sum("c").alias("c"))
              .where(F.col("c") >= F.when(F.col("s").isNull(), 0).otherwise(1)))
    # avg over the whole join: albums without tracks add nothing to sum or count.
    playlist_avg = tuples.agg(round_half_away_int(F.try_divide(F.sum("s"), F.sum("c")))).scalar()
    metrics = tuples.drop("s", "c").withColumn("avg_playlist_track_popularity", playlist_avg)
    r = dense_rank_global(metrics, "avg_album_track_popularity", "album_track_popularity_rnk")
    out = r.select(
        "album_name", "album_release_date", "album_total_tracks", "num_tracks_in_playlist",
        "avg_album_track_popularity", "album_track_popularity_rnk", "avg_playlist_track_popularity",
        F.when(F.col("avg_album_track_popularity") > F.col("avg_playlist_track_popularity"), 1)
         .otherwise(0).alias("is_more_popular_than_playlist_overall"))
    if ordered:
        out = out.orderBy("album_track_popularity_rnk", "album_name", "album_release_date",
                          "album_total_tracks", "num_tracks_in_playlist")
    return out


def _wide(df: DataFrame) -> int:
    """Partitions for an exchange of many more rows than the tables have."""
    return WIDE * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def genre_rows(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """Distinct (genre, kind, id, name): the tracks (kind ``t``) and the artists with a track (``a``) of every genre."""
    ta = track_artists(tracks, "track_name")
    ag = artist_genres(artists, "artist_name").where(F.col("genre").isNotNull())
    # The left join's NULL genres are filtered, so it is an inner join. Artist
    # outputs need only the artists that have a track: a semi join against the
    # distinct artist ids (map-side combined), never the (track x genre) rows.
    used = ag.join(ta.select("artist_id").distinct(), "artist_id", "left_semi")
    tg = ta.join(ag.select("artist_id", "genre"), "artist_id")
    rows = (tg.select("genre", F.lit("t").alias("kind"), F.col("track_id").alias("id"),
                      F.col("track_name").alias("name"))
            .unionByName(used.select("genre", F.lit("a").alias("kind"), F.col("artist_id").alias("id"),
                                     F.col("artist_name").alias("name"))))
    # One shuffle by id, which spreads a hot genre, serves the counts (no further exchange of rows) and
    # the lists. The count keeps this aggregate, and with it the shuffle's columns, the same for both.
    # These are the most rows of all (tracks times artists times genres), and a task holds its distinct ones.
    return (rows.repartition(_wide(tracks), "genre", "kind", "id").groupBy("genre", "kind", "id", "name")
            .agg(F.count(F.lit(1)).alias("n")).where("n > 0").drop("n"))


def genre_names(tracks: DataFrame, artists: DataFrame) -> DataFrame:
    """The name lists of every genre in long form: genre, kind, chunk, first, last, num_values, text (``sorted_distinct_chunks``)."""
    return sorted_distinct_chunks(genre_rows(tracks, artists), ["genre", "kind"], "name", n_chunks=_wide(tracks))


def genre_track_and_artist_details(tracks: DataFrame, artists: DataFrame, ordered: bool = True) -> DataFrame:
    # Track-side and artist-side rows travel together, tagged by kind, so both
    # distinct counts take one pass and both name lists one chunked aggregation.
    rows = genre_rows(tracks, artists)
    counts = rows.select("genre", "kind", "id").distinct().groupBy("genre").agg(
        F.count_if(F.col("kind") == "t").alias("num_tracks"),
        F.count_if(F.col("kind") == "a").alias("num_artists"))
    # Both lists of a genre are put together where its chunks meet: a finished list is not moved once more.
    chunks = sorted_distinct_chunks(rows, ["genre", "kind"], "name", n_chunks=_wide(tracks))
    lists = chunks.groupBy("genre").agg(
        joined_chunks(F.col("kind") == "t").alias("track_names"), joined_chunks(F.col("kind") == "a").alias("artist_names"))
    out = (counts.join(lists, "genre", "left")
           .select("genre", "num_tracks", "num_artists", "track_names", "artist_names"))
    if ordered:
        out = out.orderBy(F.col("num_tracks").desc(), F.col("num_artists").desc(), "genre")
    return out


VIEW_NAMES = (
    "top_5_most_popular_artists_contribution",
    "most_popular_tracks_with_duration",
    "track_popularity_trend_by_release_year_month",
    "album_track_popularity_comparison",
    "genre_track_and_artist_details",
)


def view_builders(tracks: DataFrame, albums: DataFrame, artists: DataFrame) -> dict:
    """``name -> () -> DataFrame``; building a view runs no job."""
    return {
        "top_5_most_popular_artists_contribution": lambda: top_5_most_popular_artists_contribution(tracks, artists),
        "most_popular_tracks_with_duration": lambda: most_popular_tracks_with_duration(tracks),
        "track_popularity_trend_by_release_year_month":
            lambda: track_popularity_trend_by_release_year_month(tracks, albums),
        "album_track_popularity_comparison": lambda: album_track_popularity_comparison(tracks, albums),
        "genre_track_and_artist_details": lambda: genre_track_and_artist_details(tracks, artists),
    }


def build_views(tracks: DataFrame, albums: DataFrame, artists: DataFrame) -> dict[str, DataFrame]:
    return {name: build() for name, build in view_builders(tracks, albums, artists).items()}


def register_views(spark: SparkSession, tracks: DataFrame, albums: DataFrame, artists: DataFrame,
                   replace: bool = False, only: set[str] | None = None) -> list[str]:
    """Publish each view as a temp view; an existing view is kept unless ``replace``.

    Only the views that get (re)registered are built. Returns their names.
    """
    created = []
    for name, build in view_builders(tracks, albums, artists).items():
        if only is not None and name not in only:
            continue
        if replace:
            build().createOrReplaceTempView(name)
            created.append(name)
        elif not spark.catalog.tableExists(name):
            build().createTempView(name)
            created.append(name)
    return created


CATALOG_TABLES = ("tracks", "albums", "artists")
#: The views' SQL files; a file's name without ``.sql`` is the view's.
SQL_FOLDER = Path(__file__).resolve().parent.parent / "sql"
#: Views that collect sets beside several distinct counts; they are read in a session of their own (``spread_session``).
SPREAD_VIEWS = ("genre_track_and_artist_details",)


def sql_views(folder: str | Path = SQL_FOLDER) -> dict[str, str]:
    """View name -> query text, for every ``.sql`` file of a folder on the driver."""
    return {f.stem: f.read_text(encoding="utf-8").strip().rstrip(";") for f in sorted(Path(folder).glob("*.sql"))}


def create_views(store, folder: str | Path = SQL_FOLDER, replace: bool = False) -> list[str]:
    """Creates a view of the store's database for each SQL file of the folder, unless it exists; returns the new ones.

    A query names the catalogue's tables by parameters (``IDENTIFIER(:tracks)``), so it holds for any
    database. No job runs; a view shows the tables as they are when it is read. An existing
    view stays as it is, whatever its file says now, unless ``replace``.
    """
    tables = {t: store.name(t) for t in store.schemas}
    created = []
    for name, query in sql_views(folder).items():
        if not replace and store.table_exists(name):
            continue
        store.spark.sql(f"CREATE OR REPLACE VIEW {store.name(name)} AS {query}", args=tables)
        created.append(name)
    return created


def read_view(store, name: str, folder: str | Path = SQL_FOLDER) -> DataFrame:
    """A view over the current tables; one that only has a file is created.

    One of ``SPREAD_VIEWS`` has as many shuffle partitions as the rows of the largest table ask for, which are counted now.
    Its lists of distinct names are put together from chunks (``spread_set_lists``), the rest of its statement runs as it is.
    """
    store.create_tables({n: store.schemas.get(n, s) for n, s in CATALOG_SCHEMAS.items()})  # as they are laid out
    if not store.table_exists(name) and name in sql_views(folder):
        create_views(store, folder)
    if not store.table_exists(name):
        raise LookupError(f"no view {name!r} in {store.database} or {folder}")
    if name not in SPREAD_VIEWS:
        return store.spark.table(store.name(name))
    rows = max(store.select_all(t).count() for t in CATALOG_TABLES)
    spread = spread_set_lists(spread_session(store.spark, rows, join_small=True).table(store.name(name)))
    return spread_session(store.spark, rows).table(store.name(name)) if spread is None else spread


def publish_views(spark: SparkSession, store, replace: bool = False, folder: str | Path = SQL_FOLDER) -> list[str]:
    """Creates the folder's views (``create_views``) and points this session's temp views of the five names at the current tables."""
    if not all(store.table_exists(t) for t in CATALOG_TABLES):
        return []
    created = create_views(store, folder, replace)
    register_views(spark, *(store.select_all(t) for t in CATALOG_TABLES), replace=True)
    return created
