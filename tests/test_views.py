from tunefold.plans import views as V

TRACK = "track_id string, track_name string, track_popularity int, track_duration_ms int, album_id string, artist_id string"


def test_album_tuples_collapse(spark):
    albums = spark.createDataFrame([("a1", "Same", "2020-01-01", 3), ("a2", "Same", "2020-01-01", 3)],
                                   "album_id string, album_name string, album_release_date string, album_total_tracks int")
    tracks = spark.createDataFrame([("t1", "x", 50, 1000, "a1", None), ("t2", "y", 50, 1000, "a2", None)], TRACK)
    out = V.album_track_popularity_comparison(tracks, albums).collect()
    assert len(out) == 1
    r = out[0]
    assert (r["num_tracks_in_playlist"], r["avg_album_track_popularity"], r["album_track_popularity_rnk"],
            r["avg_playlist_track_popularity"], r["is_more_popular_than_playlist_overall"]) == (1, 50, 1, 50, 0)


def test_album_without_tracks_ranks_first(spark):
    albums = spark.createDataFrame([("a1", "A", "2020-01-01", 3), ("a2", "B", "2021-01-01", 1)],
                                   "album_id string, album_name string, album_release_date string, album_total_tracks int")
    tracks = spark.createDataFrame([("t1", "x", 40, 1000, "a1", None), ("t2", "y", 61, 1000, "a1", None)], TRACK)
    got = {r["album_name"]: (r["num_tracks_in_playlist"], r["avg_album_track_popularity"], r["album_track_popularity_rnk"])
           for r in V.album_track_popularity_comparison(tracks, albums).collect()}
    assert got == {"B": (0, None, 1), "A": (2, 51, 2)}


def test_top_artists_merge_by_name_and_rank_before_join(spark):
    artists = spark.createDataFrame(
        [("r1", "Same", "{pop}", 90), ("r2", "Same", "{pop}", 90), ("r3", "Absent", "{}", 95), ("r4", "Low", "{}", 10)],
        "artist_id string, artist_name string, artist_genres string, artist_popularity int")
    tracks = spark.createDataFrame([("t1", "x", 1, 1, None, "r1, r2"), ("t2", "y", 1, 1, None, "r2"),
                                    ("t3", "z", 1, 1, None, "r4")], TRACK)
    got = sorted(tuple(r) for r in V.top_5_most_popular_artists_contribution(tracks, artists, k=2).collect())
    # "Absent" holds rank 1 but has no tracks; the two "Same" artists are one row with 2 distinct tracks.
    assert got == [("Same", 90, 2, 2)]


def test_genres_and_durations(spark):
    tracks = spark.createDataFrame([("k7", "Harbour", 12, 61_500, "al3", "p4, p9"), ("k8", "Dune", 44, 3_599_000, "al3", "p9")], TRACK)
    artists = spark.createDataFrame([("p4", "Quartet Nord", '{"deep house",dub}', 33), ("p9", "Ilse", "{dub}", 51)],
                                    "artist_id string, artist_name string, artist_genres string, artist_popularity int")
    got = [tuple(r) for r in V.genre_track_and_artist_details(tracks, artists).collect()]
    assert got == [("dub", 2, 2, "Dune, Harbour", "Ilse, Quartet Nord"), ("deep house", 1, 1, "Harbour", "Quartet Nord")]
    dur = [(r["track_id"], r["track_duration_min"], r["popularity_rnk"]) for r in V.most_popular_tracks_with_duration(tracks).collect()]
    assert dur == [("k8", "59:59", 1), ("k7", "1:01", 2)]


def test_view_orderings(spark):
    """Rows come in each view's own order."""
    from tunefold.sources.fixtures import materialized_catalog

    from .conftest import SF_SMALL

    c = materialized_catalog(spark, SF_SMALL)
    built = V.build_views(c.tracks, c.albums, c.artists)
    ranks = {"most_popular_tracks_with_duration": "popularity_rnk", "top_5_most_popular_artists_contribution": "artist_popularity_rnk",
             "album_track_popularity_comparison": "album_track_popularity_rnk"}
    for name, column in ranks.items():
        found = [r[column] for r in built[name].collect()]
        assert found == sorted(found) and len(set(found)) > 1, name
    months = [r["album_release_year_month"] for r in built["track_popularity_trend_by_release_year_month"].collect()]
    assert months == sorted(months, key=lambda m: m or "9999", reverse=True) and None in months  # latest first, none before all
    genres = [(r["num_tracks"], r["num_artists"]) for r in built["genre_track_and_artist_details"].collect()]
    assert genres == sorted(genres, reverse=True) and len(set(genres)) > 1


def test_month_trend_keeps_one_row_per_track(spark):
    albums = spark.createDataFrame([("a1", "A", "2023-01-05", 1), ("a2", "B", "2023-01-20", 1)],
                                   "album_id string, album_name string, album_release_date string, album_total_tracks int")
    tracks = spark.createDataFrame([("t1", "x", 10, 1, "a1", None), ("t2", "y", 15, 1, "a2", None),
                                    ("t3", "z", 7, 1, None, None)], TRACK)
    got = sorted(tuple(r) for r in V.track_popularity_trend_by_release_year_month(tracks, albums).collect()
                 if r[0] is not None)
    assert got == [("A", "2023-01", 13, 2), ("B", "2023-01", 13, 2)]
    nulls = [tuple(r) for r in V.track_popularity_trend_by_release_year_month(tracks, albums).collect() if r[0] is None]
    assert nulls == [(None, None, 7, 1)]


def test_register_views_keeps_existing_unless_replace(spark):
    tracks = spark.createDataFrame([("t1", "x", 50, 1000, None, None)], TRACK)
    albums = spark.createDataFrame([], "album_id string, album_name string, album_release_date string, "
                                       "album_total_tracks int")
    artists = spark.createDataFrame([], "artist_id string, artist_name string, artist_genres string, "
                                        "artist_popularity int")
    spark.range(3).createOrReplaceTempView("most_popular_tracks_with_duration")
    created = V.register_views(spark, tracks, albums, artists)
    assert "most_popular_tracks_with_duration" not in created
    assert spark.table("most_popular_tracks_with_duration").columns == ["id"]  # left alone
    created = V.register_views(spark, tracks, albums, artists, replace=True)
    assert set(created) == set(V.VIEW_NAMES)
    assert spark.table("most_popular_tracks_with_duration").count() == 1
