from pyspark.sql import functions as F

from tunefold.operators.load import TableStore
from tunefold.operators.runlog import RunLog
from tunefold.plans.job import JobConfig, run_catalog_job
from tunefold.plans.views import publish_views
from tunefold.schemas import CATALOG_SCHEMAS
from tunefold.session import scratch_path
from tunefold.sources.fixtures import derive_artist_docs, materialized_catalog
from tunefold.sources.pages import land_artist_docs, land_pages

from .conftest import SF_SMALL


def test_job_runs_twice_and_views_follow_the_tables(spark):
    c = materialized_catalog(spark, SF_SMALL)
    docs = land_artist_docs(derive_artist_docs(spark, SF_SMALL), scratch_path(spark, "docs"))
    first = land_pages(c.tracks, c.albums, scratch_path(spark, "pages1"), files=2)
    store = TableStore(spark)
    rejected = run_catalog_job(spark, store, JobConfig(first, docs, replace_views=True))
    n = c.tracks.count()
    assert store.select_all("tracks").count() == n
    assert rejected.get("null album", 0) == c.tracks.where(F.col("album_id").isNull()).count()
    assert spark.table("most_popular_tracks_with_duration").count() == n

    # Second run: the same pages plus copies under new ids; views must see them.
    extra = c.tracks.withColumn("track_id", (F.col("track_id").cast("bigint") + 1_000_000).cast("string"))
    second = land_pages(c.tracks.unionByName(extra), c.albums, scratch_path(spark, "pages2"), files=2)
    run_catalog_job(spark, store, JobConfig(second, docs))
    assert store.select_all("tracks").count() == 2 * n
    assert spark.table("most_popular_tracks_with_duration").count() == 2 * n
    trend = spark.table("track_popularity_trend_by_release_year_month")
    assert trend.count() == 2 * n

    log = RunLog(store).rows()
    assert sorted((r["run_id"], r["status"]) for r in log.collect()) == [
        (1, "start"), (1, "success"), (2, "start"), (2, "success")]
    texts = [r["logs"] for r in log.where("status = 'success'").collect()]
    assert all("building the catalogue" in t and "rejected items" in t for t in texts)


def test_command_line_one_shot(spark):
    import uuid

    from tunefold.__main__ import main

    c = materialized_catalog(spark, SF_SMALL)
    docs = land_artist_docs(derive_artist_docs(spark, SF_SMALL), scratch_path(spark, "cli-docs"))
    pages = land_pages(c.tracks, c.albums, scratch_path(spark, "cli-pages"), files=2)
    root = f"{scratch_path(spark, 'cli')}-{uuid.uuid4().hex[:8]}"
    for _ in range(2):  # the same landing again, as a restart would run it
        main(["--pages", pages, "--artists", docs, "--root", root, "--method", "upsert"], spark=spark)
    store = TableStore(spark, root)
    store.create_tables(CATALOG_SCHEMAS)
    assert store.select_all("tracks").count() == c.tracks.count()
    assert [r["status"] for r in RunLog(store).rows().orderBy("run_id", "status").collect()] == ["start", "success"] * 2
    main(["--show", "genre_track_and_artist_details", "--root", root], spark=spark)


def test_creating_views_runs_no_job(spark):
    store = TableStore(spark)
    store.create_tables(CATALOG_SCHEMAS)
    spark.sparkContext.setJobGroup("views", "")
    publish_views(spark, store, replace=True)
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("views")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs


def test_a_changed_second_pull(spark):
    """The same playlist pulled again: a track and its album changed, a track with a new album and artist."""
    import json

    def item(track, name, pop, album, album_name, artist, at):
        return {"added_at": at, "track": {"id": track, "name": name, "popularity": pop, "duration_ms": 61_000, "artists": [{"id": artist}],
                                          "album": {"id": album, "name": album_name, "release_date": "1998-03", "total_tracks": 4}}}

    def pull(items, snapshot):
        return json.dumps({"id": "pl", "name": "Evening", "snapshot_id": snapshot, "tracks": {"total": len(items), "items": items, "next": ""}})

    first = [item("k1", "Rain", 7, "al1", "Weather", "ar1", "2020-05-01"), item("k2", "Snow", 3, "al1", "Weather", "ar1", "2020-05-01")]
    second = [item("k1", "Rain", 9, "al1", "Weather II", "ar1", "2020-06-01"), item("k3", "Fog", 5, "al2", "Mist", "ar2", "2020-06-01")]
    pages, docs = scratch_path(spark, "pulls"), scratch_path(spark, "pull-docs")
    doc = [(json.dumps({"id": f"ar{i}", "name": f"Duo {i}", "genres": ["dub"], "popularity": i}),) for i in (1, 2, 1)]
    spark.createDataFrame(doc, "value string").write.text(docs)
    store = TableStore(spark)
    for k, lines in enumerate(([pull(first, "s1")], [pull(second, "s2"), pull(first, "s1")])):
        spark.createDataFrame([(x,) for x in lines], "value string").write.mode("append").text(pages)
        run_catalog_job(spark, store, JobConfig(pages, docs, publish_views=False))
    assert sorted((r.track_id, r.track_popularity) for r in store.select_all("tracks").collect()) == [("k1", 9), ("k2", 3), ("k3", 5)]
    assert sorted((r.album_id, r.album_name) for r in store.select_all("albums").collect()) == [("al1", "Weather II"), ("al2", "Mist")]
    assert sorted(r.artist_id for r in store.select_all("artists").collect()) == ["ar1", "ar2"]
