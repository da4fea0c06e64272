"""The large-data code paths, forced on small data and checked against the oracle.

On a big cluster the derived tables are too large to broadcast. Here no side is
broadcast by size, so every such join is a shuffle join; the answers must not
change. (Ranks have one plan for every size.)
"""

import pytest

import __spark_entry__ as E

from .test_entry_and_oracle import _bag, duck  # noqa: F401  (fixture)
from .conftest import SF_SMALL

KEYS = ["most_popular_tracks_with_duration", "top_5_most_popular_artists_contribution",
        "track_popularity_trend_by_release_year_month", "album_track_popularity_comparison",
        "genre_track_and_artist_details", "dense_rank_global", "top_k_with_ties", "load_upsert",
        "catalog_artists", "read_playlist_pages", "load_insert", "artist_enrichment", "catalog_albums",
        "distinct_artist_ids"]


@pytest.fixture()
def no_broadcasts(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", KEYS)
def test_shuffle_paths_match_oracle(spark, duck, no_broadcasts, name):  # noqa: F811
    df = E.queries()[name](spark, SF_SMALL)
    got = df.collect()
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert _bag(df.columns, got) == _bag(ocols, res.fetchall())
