"""Declared schemas: landed documents (pages, artist docs) and the published tables.

JSON inference would type every integer as ``long``; the tables are fixed, so
the page schema is declared and integers are read as ``int`` directly.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql.types import (
    ArrayType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

S, I = StringType(), IntegerType()

ALBUM = StructType([
    StructField("id", S),
    StructField("name", S),
    StructField("release_date", S),
    StructField("total_tracks", I),
])

TRACK = StructType([
    StructField("id", S),
    StructField("name", S),
    StructField("popularity", I),
    StructField("duration_ms", I),
    StructField("album", ALBUM),
    StructField("artists", ArrayType(StructType([StructField("id", S)]))),
])

ITEM = StructType([
    StructField("added_at", S),
    StructField("track", TRACK),
])

# One landed page of a playlist: the playlist header plus a paging object.
PAGE = StructType([
    StructField("id", S),
    StructField("name", S),
    StructField("snapshot_id", S),
    StructField("tracks", StructType([
        StructField("offset", I),
        StructField("total", I),
        StructField("items", ArrayType(ITEM)),
        StructField("next", S),
    ])),
])

ARTIST_DOC = StructType([
    StructField("id", S),
    StructField("name", S),
    StructField("genres", ArrayType(S)),
    StructField("popularity", I),
])


#: The partition column of tables that are partitioned by a hash of their key.
KEY_PART = "key_part"
#: Rows of the largest table in a join that a bucket of any table in it should have at most.
ROWS_PER_BUCKET = 250_000


@dataclass(frozen=True)
class TableSchema:
    """A published table: column types, primary key, and how it is laid out.

    ``parts``: partitions by a hash of the key; a load reads and replaces whole ones, so more of
    them make small loads into a big table cheaper. ``buckets``: buckets by key within a partition,
    the tasks of a key match. ``partition_by``: columns of the key to partition by instead (no buckets then).
    """

    name: str
    struct: StructType
    primary_key: tuple[str, ...]
    parts: int = 8
    buckets: int = 4
    partition_by: tuple[str, ...] = ()

    def __post_init__(self):
        if not set(self.partition_by) <= set(self.primary_key):
            raise ValueError(f"{self.name}: only key columns can partition a table, a key must stay in its partition")

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.struct.fields]

    @property
    def partition_columns(self) -> tuple[str, ...]:
        return self.partition_by or (KEY_PART,)

    @property
    def bucket_columns(self) -> tuple[str, ...]:
        return () if self.partition_by else self.primary_key

    @property
    def stored(self) -> StructType:
        """Columns in the order of the stored table: partition columns last."""
        last = [self.struct[c] for c in self.partition_by] or [StructField(KEY_PART, I)]
        return StructType([f for f in self.struct.fields if f.name not in self.partition_by] + last)

    def laid_out(self, table_bytes: int, file_bytes: int = 512 << 20, part_bytes: int = 64 << 30) -> TableSchema:
        """The same table with partitions and files of about the given sizes, for a table of ``table_bytes``."""
        parts = max(self.parts, -(-table_bytes // part_bytes))
        return replace(self, parts=parts, buckets=max(self.buckets, -(-table_bytes // (parts * file_bytes))))

    def joined_with(self, rows: int) -> TableSchema:
        """The same table for joins by its key with up to ``rows`` rows: Spark gives them a task per bucket, whatever the other side has.

        It has the fewer partitions, so its files don't get many more; loads of a few keys then replace more of it.
        """
        buckets = max(self.buckets, -(-rows // ROWS_PER_BUCKET))
        return replace(self, buckets=buckets, parts=max(1, self.parts * self.buckets // buckets))


TRACKS = TableSchema("tracks", StructType([
    StructField("track_id", S, False),
    StructField("track_name", S),
    StructField("track_popularity", I),
    StructField("track_duration_ms", I),
    StructField("track_added_at", S),
    StructField("album_id", S),
    StructField("artist_id", S),
    StructField("playlist_id", S),
    StructField("playlist_name", S),
    StructField("snapshot_id", S),
]), ("track_id",), parts=16)

ALBUMS = TableSchema("albums", StructType([
    StructField("album_id", S, False),
    StructField("album_name", S),
    StructField("album_release_date", S),
    StructField("album_total_tracks", I),
]), ("album_id",))

ARTISTS = TableSchema("artists", StructType([
    StructField("artist_id", S, False),
    StructField("artist_name", S),
    StructField("artist_genres", S),
    StructField("artist_popularity", I),
]), ("artist_id",))

RUN_LOG = TableSchema("pipeline_logs", StructType([
    StructField("pipeline_name", S, False),
    StructField("run_id", I, False),
    StructField("timestamp", S, False),
    StructField("status", S, False),
    StructField("config", S),
    StructField("logs", S),
]), ("pipeline_name", "run_id", "timestamp", "status"), partition_by=("pipeline_name",))

CATALOG_SCHEMAS = {t.name: t for t in (TRACKS, ALBUMS, ARTISTS)}
