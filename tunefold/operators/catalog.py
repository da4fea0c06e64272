"""From pages and artist documents to the three catalogue tables.

``build_catalog(pages, artist_docs)`` returns ``tracks``, ``albums``,
``artists`` plus the ``rejected`` items:

* tracks: one row per item, renamed, artist ids joined with ``', '`` in list
  order, playlist header columns from the page;
* albums: distinct album tuples of all items (NULLs compare equal), and where an
  album changed between pulls the tuple of the latest ``added_at``; items without
  an album are rejected instead of loaded as an all-NULL key;
* artists: the distinct artist ids of all items, looked up in the artist
  documents by a join (one lookup per distinct id, the latest landed document);
  an id without a document fails the build, as a failed lookup failed the
  warehouse run. The check is part of the plan, not a job before it.

Items whose track is NULL are rejected (counted), never looked up.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import array_to_text
from ..schemas import ALBUMS, ARTISTS, TRACKS
from .nested import collect_artist_ids, distinct_artist_ids, flatten_items


class MissingArtist(LookupError):
    """Named in the error of a query that meets an artist id without a document."""


@dataclass(frozen=True)
class BuiltCatalog:
    tracks: DataFrame
    albums: DataFrame
    artists: DataFrame
    rejected: DataFrame  # (reason, playlist_id, added_at, track_id)


def catalog_tracks(items: DataFrame) -> DataFrame:
    ok = items.where(F.col("track_id").isNotNull())
    return ok.select(
        F.col("track_id"), F.col("track_name"), F.col("track_popularity"), F.col("track_duration_ms"),
        F.col("added_at").alias("track_added_at"), F.col("track_album_id").alias("album_id"),
        collect_artist_ids("track_artists").alias("artist_id"),
        "playlist_id", "playlist_name", "snapshot_id",
    ).select(*TRACKS.columns)


def catalog_albums(items: DataFrame) -> DataFrame:
    tuples = items.where(F.col("track_album_id").isNotNull()).groupBy(
        F.col("track_album_id").alias("album_id"), F.col("track_album_name").alias("album_name"),
        F.col("track_album_release_date").alias("album_release_date"),
        F.col("track_album_total_tracks").alias("album_total_tracks"),
    ).agg(F.max("added_at").alias("__at"))  # a row per tuple, combined map-side
    row = F.struct(*ALBUMS.columns)
    rank = F.struct(F.col("__at").isNotNull(), "__at", row.alias("row"))
    return tuples.groupBy("album_id").agg(F.max(rank).alias("__best")).select("__best.row.*")


def enrich_artists(ids: DataFrame, artist_docs: DataFrame, check: bool = True) -> DataFrame:
    """``ids (artist_id)`` left-joined to the documents; every id must find its document."""
    landed = F.col("landed_at") if "landed_at" in artist_docs.columns else F.lit(None).cast("timestamp")
    docs = artist_docs.select(
        F.col("id").alias("artist_id"), F.col("name").alias("artist_name"),
        array_to_text("genres").alias("artist_genres"), F.col("popularity").alias("artist_popularity"),
        landed.alias("__at"))
    row = F.struct(*ARTISTS.columns)
    best = F.max(F.struct(F.col("__at").isNotNull(), "__at", row.alias("row")))
    latest = docs.groupBy("artist_id").agg(best.alias("__best")).select("artist_id", F.col("__best.row").alias("__row"))
    joined = ids.join(latest, "artist_id", "left")
    found = F.col("__row")
    if check:
        message = F.concat(F.lit(f"{MissingArtist.__name__}: no artist document for id "), F.col("artist_id"))
        found = F.when(found.isNull(), F.raise_error(message)).otherwise(found)
    # the id comes from the checked row too, so that no column can be had without the check
    named = joined.select(F.col("artist_id").alias("__id"), found.alias("__row"))
    artist_id = F.coalesce("__row.artist_id", "__id").alias("artist_id")
    return named.select(artist_id, *(f"__row.{c}" for c in ARTISTS.columns if c != "artist_id")).select(*ARTISTS.columns)


def build_catalog(pages: DataFrame, artist_docs: DataFrame, check_artists: bool = True) -> BuiltCatalog:
    return build_from_items(flatten_items(pages), artist_docs, check_artists)


def build_from_items(items: DataFrame, artist_docs: DataFrame, check_artists: bool = True) -> BuiltCatalog:
    """The same from flattened items (written once by callers that load several of the tables)."""
    rejected = items.where(F.col("track_id").isNull()).select(
        F.lit("null track").alias("reason"), "playlist_id", "added_at", "track_id")
    rejected = rejected.unionByName(items.where(
        F.col("track_id").isNotNull() & F.col("track_album_id").isNull()).select(
        F.lit("null album").alias("reason"), "playlist_id", "added_at", "track_id"))
    ids = distinct_artist_ids(items.where(F.col("track_id").isNotNull()))
    return BuiltCatalog(
        tracks=catalog_tracks(items),
        albums=catalog_albums(items),
        artists=enrich_artists(ids, artist_docs, check_artists),
        rejected=rejected,
    )
