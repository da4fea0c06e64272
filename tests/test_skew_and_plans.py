"""Hot keys (a third of all rows on one value) and plan shapes.

The results must stay whole and exact under skew; the plans must keep the
big table out of single-partition exchanges and read only needed columns.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunefold.functions.agg import sorted_distinct_chunks, sorted_distinct_join
from tunefold.operators.load import TableStore
from tunefold.operators.ranking import dense_rank_global
from tunefold.plans import views as V
from tunefold.schemas import TRACKS
from tunefold.sources.fixtures import materialized_catalog

from .conftest import SF_SMALL
from .plan_shape import executed

N = 6000


def _skewed_tracks(spark):
    # A third of all tracks share one album, one popularity and one artist list.
    return spark.range(N).select(
        F.col("id").cast("string").alias("track_id"),
        F.concat(F.lit("T"), (F.col("id") % 500).cast("string")).alias("track_name"),
        F.when(F.col("id") % 3 == 0, F.lit(50)).otherwise((F.col("id") % 97).cast("int")).alias("track_popularity"),
        (F.col("id") * 37 % 400000).cast("int").alias("track_duration_ms"),
        F.lit("2024-01-01").alias("track_added_at"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 200).cast("string")).alias("album_id"),
        F.when(F.col("id") % 3 == 0, F.lit("a1, a2")).otherwise((F.col("id") % 40).cast("string")).alias("artist_id"),
        F.lit("p").alias("playlist_id"), F.lit("p").alias("playlist_name"), F.lit("s").alias("snapshot_id"))


def _albums(spark):
    ids = [("hot", "Hot", "2020-05-01", 9)] + [(str(i), f"A{i}", f"20{10 + i % 12}-0{1 + i % 9}-01", i) for i in range(200)]
    return spark.createDataFrame(ids, "album_id string, album_name string, album_release_date string, album_total_tracks int")


def test_rank_with_hot_value_matches_window(spark):
    t = _skewed_tracks(spark).select("track_id", "track_popularity")
    got = {r["track_id"]: r["r"] for r in dense_rank_global(t, "track_popularity", "r").collect()}
    want = {r["track_id"]: r["r"] for r in t.select(
        "track_id", F.dense_rank().over(Window.orderBy(F.col("track_popularity").desc_nulls_first())).alias("r")
    ).collect()}
    assert got == want and len(got) == N


def test_month_trend_with_hot_album_is_whole(spark):
    t, a = _skewed_tracks(spark), _albums(spark)
    out = V.track_popularity_trend_by_release_year_month(t, a, ordered=False)
    assert out.count() == N
    hot = out.where(F.col("album_name") == "Hot").select("num_tracks_per_release_year_month").distinct().collect()
    expected = t.join(a, "album_id").where(F.col("album_release_date").startswith("2020-05")).count()
    assert [r[0] for r in hot] == [expected]


def test_distinct_names_with_hot_group(spark):
    df = _skewed_tracks(spark).select(F.when(F.col("album_id") == "hot", "hot").otherwise("cold").alias("g"),
                                      "track_name")
    got = {r["g"]: r["names"] for r in sorted_distinct_join(df, ["g"], "track_name", "names", n_chunks=7).collect()}
    want = {r["g"]: r["names"] for r in df.groupBy("g").agg(
        F.array_join(F.array_sort(F.collect_set("track_name")), ", ").alias("names")).collect()}
    assert got == want


def test_keep_latest_with_hot_key(spark):
    store = TableStore(spark)
    store.create_tables([TRACKS])
    batch = _skewed_tracks(spark).withColumn(
        "track_id", F.when(F.col("album_id") == "hot", F.lit("same")).otherwise(F.col("track_id"))
    ).withColumn("track_added_at", F.format_string("2024-01-%02d", (F.col("track_duration_ms") % 28 + 1).cast("int")))
    store.upsert(batch, "tracks", on_duplicate="keep_latest", order_by="track_added_at")
    out = store.select_all("tracks")
    assert out.count() == N - N // 3 + 1
    latest = batch.where(F.col("track_id") == "same").agg(F.max("track_added_at")).first()[0]
    assert out.where(F.col("track_id") == "same").first()["track_added_at"] == latest


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_views_read_only_needed_columns(spark):
    c = materialized_catalog(spark, SF_SMALL)
    plan = _plan(V.most_popular_tracks_with_duration(c.tracks))
    assert "ReadSchema: struct<track_id:string,track_name:string,track_popularity:int,track_duration_ms:int>" in plan
    assert "artist_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_big_side_never_in_a_single_partition(spark):
    c = materialized_catalog(spark, SF_SMALL)
    for df in (V.most_popular_tracks_with_duration(c.tracks, ordered=False),
               V.track_popularity_trend_by_release_year_month(c.tracks, c.albums, ordered=False),
               V.album_track_popularity_comparison(c.tracks, c.albums, ordered=False)):
        plan = df._jdf.queryExecution().executedPlan()
        # A SinglePartition exchange may only take a partial aggregate (one row per
        # task) or the sizes of the rank ranges (one row each).
        text = plan.toString()
        for block in text.split("Exchange SinglePartition")[1:]:
            lines = block.split("\n")
            child = lines[1] if len(lines) > 1 else ""
            assert "partial_" in child or "__rank_part" in child, child


def test_key_check_and_fixture_plans(spark):
    """The key check hashes, and deriving the tracks shuffles lineitem once."""
    from tunefold.operators.load import TableStore as Store
    from tunefold.sources.fixtures import derive_tracks

    tracks = derive_tracks(spark, SF_SMALL)
    per_key = tracks.groupBy("track_id").agg(F.count(F.lit(1)).alias("n"))
    assert "SortAggregate" not in _plan(per_key)
    Store.check_keys(tracks.select("track_id"), TRACKS)
    plan = _plan(tracks)
    assert plan.count("hashpartitioning(l_orderkey") == 1


def test_views_read_their_tables_once(spark):
    """With shuffled joins, as for large tables: scans of the executed plans; an exchange that is reused reads nothing."""
    c = materialized_catalog(spark, SF_SMALL)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        trend = executed(V.track_popularity_trend_by_release_year_month(c.tracks, c.albums))
        albums = executed(V.album_track_popularity_comparison(c.tracks, c.albums))
        genres = executed(V.genre_track_and_artist_details(c.tracks, c.artists))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        if adaptive is None:
            spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")
        else:
            spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", adaptive)
    assert trend["FileSourceScanExec"] == 2, trend
    assert albums["FileSourceScanExec"] == 2, albums
    assert genres["FileSourceScanExec"] <= 4, genres


def test_long_form_of_names_joins_to_the_lists(spark):
    """Chunks in order are the view's list, also where one genre holds nearly all names and a name is NULL or repeated."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 9 == 0, F.lit("rare")).otherwise(F.lit("hot")).alias("genre"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("n"), (F.col("id") % 1100).cast("string"))).alias("name"))
    chunks = sorted_distinct_chunks(rows, ["genre"], "name", n_chunks=8).collect()
    lists = {r["genre"]: r["names"] for r in sorted_distinct_join(rows, ["genre"], "name", "names", n_chunks=8).collect()}
    for genre in ("hot", "rare"):
        own = sorted((r for r in chunks if r["genre"] == genre), key=lambda r: r["chunk"])
        want = sorted({r["name"] for r in rows.where(F.col("genre") == genre).collect()} - {None})
        assert ", ".join(r["text"] for r in own) == ", ".join(want) == lists[genre]
        assert sum(r["num_values"] for r in own) == len(want)
        assert (own[0]["first"], own[-1]["last"]) == (want[0], want[-1])
    assert len([r for r in chunks if r["genre"] == "hot"]) > 1  # a hot list is in several tasks


def test_long_form_of_nothing_and_of_nulls_is_empty(spark):
    nulls = spark.createDataFrame([("g", None)], "genre string, name string")
    assert sorted_distinct_chunks(nulls, ["genre"], "name").count() == 0
    assert sorted_distinct_chunks(nulls.limit(0), ["genre"], "name").count() == 0
    assert sorted_distinct_join(nulls, ["genre"], "name", "names").count() == 0
