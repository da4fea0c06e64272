"""Landed playlist pages and artist documents (JSON lines) as DataFrames.

The warehouse loader fetched pages over HTTP, one request per page, following
``tracks.next``. Here pages are landed files: one JSON page per line. Plain
files are split into tasks; of gzipped ones each is a task. A page line is

    {"id", "name", "snapshot_id", "tracks": {"items": [item, ...], "next"}}

where ``tracks`` also has the playlist's ``total`` of items, and the last page of
each pull has no ``next`` (NULL or empty, either ended the fetch loop). Reading many page files
at once is the bag union of their items; the order of pages is not needed
because no output depends on it.

``land_pages`` builds such a landing from the catalogue tables (for tests and
the registered queries): items are grouped into pages of ``page_size``
consecutive track keys per playlist, so every page holds a bounded array.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import int_div, split_list
from ..operators.joins import left_join_spread_nulls
from ..schemas import ARTIST_DOC, PAGE

PAGE_SIZE = 100


class IncompleteLanding(ValueError):
    pass


def read_playlist_pages(spark: SparkSession, path: str | list[str], fail_fast: bool = True) -> DataFrame:
    """Pages with the declared schema; a malformed line fails the read (``FAILFAST``)."""
    reader = spark.read.schema(PAGE)
    if fail_fast:
        reader = reader.option("mode", "FAILFAST")
    return reader.json(path)


def is_last_page():
    return F.coalesce(F.col("tracks.next"), F.lit("")) == ""


def check_pages_complete(pages: DataFrame) -> None:
    """Every pull must have landed whole: as many items as its pages' ``total`` says, and one last page.

    One aggregate job, a few numbers per (playlist, snapshot, total). A snapshot
    that was pulled n times has n last pages and n times its items. A page without
    ``total`` proves nothing and is refused.
    """
    items = F.coalesce(F.size("tracks.items"), F.lit(0))
    per = pages.groupBy("id", "snapshot_id", F.col("tracks.total").alias("total")).agg(
        F.sum(is_last_page().cast("int")).alias("last_pages"), F.sum(items).alias("n"))
    whole = F.col("last_pages") * F.col("total") == F.col("n")
    bad = per.where(~F.coalesce(whole & (F.col("last_pages") > 0), F.lit(False))).limit(5).collect()
    if bad:
        raise IncompleteLanding(f"pulls that did not land whole (items, last pages, total): "
                                f"{[(r['id'], r['n'], r['last_pages'], r['total']) for r in bad]}")


def read_artist_docs(spark: SparkSession, path: str) -> DataFrame:
    """Documents, with the time their file landed: of repeated ids the latest counts."""
    docs = spark.read.schema(ARTIST_DOC).option("mode", "FAILFAST").json(path)
    return docs.select("*", F.col("_metadata.file_modification_time").alias("landed_at"))


def page_rows(tracks: DataFrame, albums: DataFrame, page_size: int = PAGE_SIZE, files: int | None = None) -> DataFrame:
    """Page rows (``PAGE`` layout plus ``page_no``) from flat catalogue tables; ``files``: dealt by page to so many partitions."""
    a = albums.select("album_id", "album_name", "album_release_date", "album_total_tracks")
    t = left_join_spread_nulls(tracks, a, "album_id", "track_id")
    album = F.when(F.col("album_id").isNotNull(), F.struct(
        F.col("album_id").alias("id"), F.col("album_name").alias("name"),
        F.col("album_release_date").alias("release_date"), F.col("album_total_tracks").alias("total_tracks")))
    artists = F.transform(split_list("artist_id"), lambda i: F.struct(i.alias("id")))
    item = F.struct(
        F.col("track_added_at").alias("added_at"),
        F.struct(F.col("track_id").alias("id"), F.col("track_name").alias("name"),
                 F.col("track_popularity").alias("popularity"), F.col("track_duration_ms").alias("duration_ms"),
                 album.alias("album"), artists.alias("artists")).alias("track"))
    seq = F.col("track_id").cast("bigint")
    items = t.select("playlist_id", "playlist_name", "snapshot_id",
                     int_div(seq, page_size).alias("page_no"), seq.alias("seq"), item.alias("item"))
    if files:  # the items travel once, to where their page is written
        items = items.repartition(files, "playlist_id", "page_no")
    # At most page_size items per page: a bounded collect per group.
    pages = items.groupBy("playlist_id", "playlist_name", "snapshot_id", "page_no").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("seq", "item"))), lambda s: s["item"]).alias("items"))
    # Last page per playlist, from the narrow key columns only (one row per playlist).
    last = tracks.groupBy("playlist_id").agg(
        F.max(int_div(F.col("track_id").cast("bigint"), page_size)).alias("last_page"),
        F.count("*").cast("int").alias("total"))
    pages = pages.join(last, "playlist_id")
    nxt = F.when(F.col("page_no") < F.col("last_page"),
                 F.concat(F.lit("playlists/"), F.col("playlist_id"), F.lit("/tracks?after="),
                          F.col("page_no").cast("string")))
    return pages.select(
        F.col("playlist_id").alias("id"), F.col("playlist_name").alias("name"), "snapshot_id", "page_no",
        F.struct(F.col("total"), F.col("items"), nxt.alias("next")).alias("tracks"))


def land_pages(tracks: DataFrame, albums: DataFrame, path: str, files: int | None = None,
               page_size: int = PAGE_SIZE, append: bool = False, by: str = "page", only: Column | None = None) -> str:
    """Write page rows as gzipped JSON lines under ``path``.

    ``files`` output files, pages hashed to them by page (``by="page"``) or by
    playlist (``by="playlist"``: every file holds whole playlists, as one pull of
    one playlist would land). A file is read by one task, so ``files`` should grow with the
    landing. ``append`` adds files to an existing landing; ``only``: the
    pages that land now, by a condition on page rows.
    """
    pages = page_rows(tracks, albums, page_size, files if by == "page" else None)
    if only is not None:
        pages = pages.where(only)
    if files and by != "page":
        pages = pages.repartition(files, "id")
    pages.drop("page_no").write.mode("append" if append else "errorifexists").json(path, compression="gzip")
    return path


def land_artist_docs(docs: DataFrame, path: str) -> str:
    docs.write.mode("errorifexists").json(path)
    return path
