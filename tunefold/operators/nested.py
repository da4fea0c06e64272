"""Nested-document operators: flatten structs, explode page items, artist id lists.

All of it is ``select``/``explode``/``transform`` over declared struct types,
so it stays inside whole-stage codegen and is narrow (no shuffle) except for
``distinct_artist_ids``, whose hash aggregate combines map-side first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def flatten_struct(df: DataFrame, sep: str = "_") -> DataFrame:
    """Flatten nested struct columns into top-level ``parent_child`` columns; arrays are left as they are."""

    def walk(schema: StructType, path: list[str]) -> list[Column]:
        cols = []
        for f in schema.fields:
            p = path + [f.name]
            if isinstance(f.dataType, StructType):
                cols.extend(walk(f.dataType, p))
            else:
                cols.append(F.col(".".join(f"`{x}`" for x in p)).alias(sep.join(p)))
        return cols

    return df.select(*walk(df.schema, []))


def explode_items(pages: DataFrame) -> DataFrame:
    """One row per playlist item with the playlist header carried along (bag union of all pages)."""
    return pages.select(
        F.col("id").alias("playlist_id"), F.col("name").alias("playlist_name"), "snapshot_id",
        F.explode("tracks.items").alias("item"))


def flatten_items(pages: DataFrame) -> DataFrame:
    """Items as flat columns: header, ``added_at``, ``track_id`` ... ``track_album_id`` ..., ``track_artists``."""
    return flatten_struct(explode_items(pages).select("playlist_id", "playlist_name", "snapshot_id", "item.*"))


def collect_artist_ids(artists: Column | str, sep: str = ", ") -> Column:
    """Artist list ``[{id}, ...]`` -> ``'id1, id2'`` in list order; NULL list -> NULL, ``[]`` -> ``''``."""
    arr = F.col(artists) if isinstance(artists, str) else artists
    return F.array_join(arr.getField("id"), sep)


def distinct_artist_ids(items: DataFrame, artists_col: str = "track_artists") -> DataFrame:
    """Distinct artist ids over all items, straight from the array (no string round trip)."""
    ids = items.select(F.explode(F.col(artists_col).getField("id")).alias("artist_id"))
    return ids.where(F.col("artist_id").isNotNull()).distinct()
