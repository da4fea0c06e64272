"""Views from a folder of SQL files, and the keyed state of streamed pulls."""

import json
import re

import pytest
from pyspark.sql import functions as F

from tunefold import schemas
from tunefold.operators.load import TableStore
from tunefold.operators.runlog import RunLog
from tunefold.operators.setlists import spread_set_lists
from tunefold.plans import queries as Q
from tunefold.plans import views as V
from tunefold.schemas import CATALOG_SCHEMAS
from tunefold.session import scratch_path
from tunefold.sources.fixtures import Catalog, materialized_catalog
from tunefold.streaming.upsert_stream import stream_catalog

from .conftest import SF_SMALL, rows


@pytest.fixture(scope="module")
def store(spark):
    c, s = materialized_catalog(spark, SF_SMALL), TableStore(spark)
    s.create_tables(CATALOG_SCHEMAS)
    s.load({"tracks": c.tracks, "albums": c.albums, "artists": c.artists}, method="overwrite")
    return s


def test_the_files_are_the_five_views(store):
    assert set(V.sql_views()) == set(V.VIEW_NAMES)
    V.create_views(store)
    built = V.build_views(*(store.select_all(t) for t in V.CATALOG_TABLES))
    for name in V.VIEW_NAMES:
        view = V.read_view(store, name)
        assert view.dtypes == built[name].dtypes, name
        assert rows(view) == rows(built[name]), name


def test_a_sixth_file_becomes_a_view_without_a_job(spark, store, tmp_path):
    V.create_views(store)
    (tmp_path / "albums_of_year.sql").write_text("-- own\nSELECT left(album_release_date, 4) AS y, count(*) AS n FROM IDENTIFIER(:albums) GROUP BY 1;\n")
    (tmp_path / "notes.txt").write_text("no view")
    spark.sparkContext.setJobGroup("folder", "")
    assert V.create_views(store, tmp_path) == ["albums_of_year"]
    assert V.create_views(store, tmp_path) == []
    jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("folder")
    spark.sparkContext.setJobGroup("", "")
    assert not jobs
    assert sum(r.n for r in V.read_view(store, "albums_of_year", tmp_path).collect()) == store.select_all("albums").count()
    # an existing view stays as it is until it is replaced
    (tmp_path / "albums_of_year.sql").write_text("SELECT 1 AS one")
    assert V.create_views(store, tmp_path) == [] and V.read_view(store, "albums_of_year", tmp_path).columns == ["y", "n"]
    assert V.create_views(store, tmp_path, replace=True) == ["albums_of_year"]
    assert V.read_view(store, "albums_of_year", tmp_path).columns == ["one"]
    with pytest.raises(LookupError, match="no view 'absent'"):
        V.read_view(store, "absent", tmp_path)


def test_joins_of_the_views_have_more_tasks_where_the_tables_have_more_rows(spark, monkeypatch):
    tracks = [(f"t{i}", f"n{i}", i % 100, 61_000, "2024", f"al{i % 40}" if i % 10 else None, "ar1, ar2", "p", "p", "s") for i in range(900)]
    albums = [(f"al{i}", f"a{i}", f"20{i % 9 + 10}-01-01", 3) for i in range(40)]
    artists = [("ar1", "one", '{pop,"hip hop"}', 5), ("ar2", "two", "{pop}", 6)]
    frames = {n: spark.createDataFrame(r, CATALOG_SCHEMAS[n].struct) for n, r in (("tracks", tracks), ("albums", albums), ("artists", artists))}
    monkeypatch.setattr(schemas, "ROWS_PER_BUCKET", 100, raising=False)
    monkeypatch.setattr(Q, "_FOLDERS", {})
    monkeypatch.setattr(Q, "_cat", lambda *_: Catalog(**frames))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with tables too large for it
    try:
        store = Q._sql_store(spark, "a test's own rows")
        for name, key in (("track_popularity_trend_by_release_year_month", "album_id"), ("genre_track_and_artist_details", "artist_id")):
            view = V.read_view(store, name)
            plan = spark._jvm.PythonSQLUtils.explainString(view._jdf.queryExecution(), "simple")
            assert re.search(rf"hashpartitioning\({key}#\d+, 9\)", plan), plan
            assert not re.search(rf"hashpartitioning\({key}#\d+, 4\)", plan), plan
            assert rows(view) == rows(V.build_views(*frames.values())[name]), name
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(store.select_all("tracks").inputFiles()) <= 64 and store.select_all("tracks").count() == 900
    assert store.schemas["tracks"].buckets == 9  # reading a view leaves the layout as it is


def test_a_view_with_sets_beside_distinct_counts_has_more_partitions_where_there_are_more_rows(spark):
    names = "spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold"
    artists = [("ar1", "one", '{pop,"hip hop"}', 5), ("ar2", "two", "{pop}", 6), ("ar3", None, None, None)]
    before = {n: spark.conf.get(n) for n in names}
    for number in (100, 10_000):
        tracks = [(f"t{i}", f"n{i % 7000}" if i % 9 else None, 1, 61_000, "2024", None, "ar1, ar2" if i % 5 else "ar3", "p", "p", "s") for i in range(number)]
        frames = {n: spark.createDataFrame(r, CATALOG_SCHEMAS[n].struct) for n, r in (("tracks", tracks), ("albums", []), ("artists", artists))}
        store = TableStore(spark)
        store.create_tables(CATALOG_SCHEMAS)
        store.load(frames, method="overwrite")
        spark.conf.set(names[-1], "1b")  # what the caller set holds for the view too
        try:
            view = V.read_view(store, "genre_track_and_artist_details")
        finally:
            spark.conf.set(names[-1], before[names[-1]])
        plan = spark._jvm.PythonSQLUtils.explainString(view._jdf.queryExecution(), "simple")
        partitions = {int(n) for n in re.findall(r"hashpartitioning\(genre#\d+, [^)]*gid#\d+, (\d+)\)", plan)}
        assert partitions == {max(int(before[names[0]]), int((number / 4) ** 0.5))}, plan
        assert rows(view) == rows(V.build_views(*frames.values())["genre_track_and_artist_details"])
        assert [r.num_tracks for r in view.collect()] == [number * 4 // 5] * 2  # in order, both genres
    assert view.sparkSession.conf.get(names[-1]) == "1b"
    assert {n: spark.conf.get(n) for n in names} == before  # the caller's session is as it was


def test_lists_of_names_are_put_together_from_chunks(spark):
    genres = ["{pop}", '{pop,"hip hop"}', "{nameless}", "{empty}", "{}", None]
    artists = [(f"ar{i}", None if i == 2 else "" if i == 3 else f"a, {i % 4}", g, 5) for i, g in enumerate(genres)]
    of = [None, "ar0", "ar0, ar1", "ar1, ar4", "ar5, ar9, ar1", ""]
    tracks = [(f"t{i}", f"n{i % 60}" if i % 5 else None, 1, 1, "2024", None, of[i % 6], "p", "p", "s") for i in range(300)]
    tracks += [(f"x{i}", [None, "", "é, 東"][i % 3], 1, 1, "2024", None, ["ar0, ar2", "ar3", "ar1"][i % 3], "p", "p", "s") for i in range(9)]
    store = TableStore(spark)
    store.create_tables(CATALOG_SCHEMAS)
    store.load({n: spark.createDataFrame(r, CATALOG_SCHEMAS[n].struct) for n, r in (("tracks", tracks), ("albums", []), ("artists", artists))}, method="overwrite")
    view = V.read_view(store, "genre_track_and_artist_details")
    as_written = spark.table(store.name("genre_track_and_artist_details"))
    assert "collect_set" in as_written._jdf.queryExecution().toString()
    assert "collect_set" not in view._jdf.queryExecution().toString()
    assert view.dtypes == as_written.dtypes
    got = view.collect()
    assert got == as_written.collect()  # in order, too
    found = {r.genre: r for r in got}
    assert list(found) == ["pop", "hip hop", "empty", "nameless"]
    assert found["nameless"].track_names is None and found["empty"].track_names is None
    assert found["hip hop"].track_names.endswith(", é, 東") and found["hip hop"].artist_names == "a, 1"


LIST = "array_join(array_sort(collect_set({})), '{}')"


@pytest.mark.parametrize("statement", [
    f"SELECT g, nullif({LIST.format('v', ', ')}, '') AS l, count(DISTINCT v) AS n, count(DISTINCT w) AS m FROM odd GROUP BY g ORDER BY n DESC, g",
    f"SELECT {LIST.format('v', '|')} AS l, upper(nullif({LIST.format('concat(v, w)', '|')}, '')) AS u, concat(g, h) AS k FROM odd GROUP BY g, h",
    f"SELECT g || '!' AS k, nullif({LIST.format('v', '')}, 'b') AS l, max(w) AS w, sum(length(v)) FILTER (WHERE h = 1) AS s FROM odd GROUP BY g ORDER BY l, k LIMIT 100",
    f"SELECT length(l) AS n, l FROM (SELECT h, {LIST.format('w', ', ')} AS l FROM odd WHERE g IS NOT NULL GROUP BY h) ORDER BY n, l",
    f"SELECT g, h, grouping_id() AS i, {LIST.format('v', ', ')} AS l, count(DISTINCT w) AS n FROM odd GROUP BY CUBE (g, h)",
    f"WITH o AS (SELECT * FROM odd UNION ALL SELECT * FROM odd) SELECT h, {LIST.format('o.v', ', ')} AS l, first(2) AS two FROM o GROUP BY h",
])
def test_a_statement_gives_the_rows_it_gives_by_itself(spark, statement):
    odd = [(g, h, v, w) for g in ("x", "y", None, "z") for h in (1, 2, None) for v in (("b", "a", "", None, "ä", ", ") if g != "z" else ("", None)) for w in ("w", None)]
    spark.createDataFrame(odd, "g string, h int, v string, w string").createOrReplaceTempView("odd")
    plain = spark.sql(statement)
    spread = spread_set_lists(plain)
    assert (spread is None) == ("LIMIT" in statement)
    if spread is not None:
        assert "collect_set" not in spread._jdf.queryExecution().toString()
        assert spread.dtypes == plain.dtypes and rows(spread) == rows(plain)
        assert "ORDER BY" not in statement or spread.collect() == plain.collect()


def test_other_statements_are_left_as_they_are(spark):
    spark.createDataFrame([("x", "b"), ("x", "a")], "g string, v string").createOrReplaceTempView("other")
    of = "other GROUP BY g"
    for lists, source in [
        ("array_join(array_sort(collect_set(v), (a, b) -> CASE WHEN a < b THEN 1 WHEN a > b THEN -1 ELSE 0 END), ', ')", of),
        ("array_join(collect_set(v), ', ')", of),
        ("array_join(array_sort(collect_set(v)), ', ', 'none')", of),
        ("array_join(array_sort(collect_set(v)), max(v))", of),
        ("array_join(array_sort(collect_set(v) FILTER (WHERE v > 'a')), ', ')", of),
        ("array_join(array_sort(collect_list(v)), ', ')", of),
        (f"{LIST.format('v', ', ')}, {LIST.format('v', ';')}", of),
        (LIST.format("v", ", "), "(SELECT g, concat(v, rand()) AS v FROM other) GROUP BY g"),
        (LIST.format("v", ", "), "(SELECT * FROM other LIMIT 1) GROUP BY g"),  # which row, two reads might not agree
        (LIST.format("v", ", "), "other GROUP BY g HAVING count(*) > 1"),
    ]:
        assert spread_set_lists(spark.sql(f"SELECT g, {lists} FROM {source}")) is None, (lists, source)
    assert spread_set_lists(spark.sql(f"SELECT {LIST.format('v', ', ')} FROM other")) is None


def test_a_view_shows_later_loads(spark):
    s = TableStore(spark)
    s.create_tables(CATALOG_SCHEMAS)
    V.create_views(s)
    view = "most_popular_tracks_with_duration"
    assert V.read_view(s, view).count() == 0
    row = ("t1", "n", 5, 61_000, "2024", None, None, "p", "p", "s")
    s.insert(spark.createDataFrame([row], CATALOG_SCHEMAS["tracks"].struct), "tracks")
    assert [tuple(r) for r in V.read_view(s, view).collect()] == [("t1", "n", 5, "1:01", 1)]


def _page(playlist, snapshot, tracks, total, last=False):
    items = [{"added_at": "2020", "track": {"id": t, "name": t, "popularity": 1, "duration_ms": 1, "artists": [],
                                            "album": {"id": f"al-{t}", "name": "a", "release_date": "2020", "total_tracks": 1}}} for t in tracks]
    return json.dumps({"id": playlist, "name": "n", "snapshot_id": snapshot, "tracks": {"total": total, "items": items, "next": "" if last else "more"}})


def test_a_pull_is_loaded_when_its_last_page_lands(spark):
    pages, docs, ckpt = (scratch_path(spark, n) for n in ("half", "half-docs", "half-ckpt"))
    spark.createDataFrame([(json.dumps({"id": "x", "name": "x", "genres": [], "popularity": 1}),)], "value string").write.text(docs)
    store = TableStore(spark)

    def land(*lines, files=1):
        spark.createDataFrame([(x,) for x in lines], "value string").repartition(files).write.mode("append").text(pages)
        q = stream_catalog(spark, pages, docs, store, ckpt, job_name="job")
        q.awaitTermination()
        assert q.exception() is None
        return sorted(r.track_id for r in store.select_all("tracks").collect())

    # a: two of three pages in different files; b: whole; c: last page first
    assert land(_page("a", "s", ["a1"], 3), _page("b", "s", ["b1", "b2"], 2, True), _page("c", "s", ["c2"], 2, True), files=3) == ["b1", "b2"]
    assert land(_page("a", "s", ["a2"], 3)) == ["b1", "b2"]
    assert [r.status for r in RunLog(store).rows().orderBy("run_id", "status").collect()] == ["start", "success"] * 2
    assert land(_page("a", "s", ["a3"], 3, True), _page("a", "s2", ["a9"], 2)) == ["a1", "a2", "a3", "b1", "b2"]
    assert land(_page("c", "s", ["c1"], 2)) == ["a1", "a2", "a3", "b1", "b2", "c1", "c2"]
    # the same snapshot pulled again, half; then the rest of both
    assert "a4" not in land(_page("a", "s", ["a1", "a4"], 3))
    assert land(_page("a", "s", ["a3"], 3, True), _page("a", "s2", ["a10"], 2, True)) == [
        "a1", "a10", "a2", "a3", "a4", "a9", "b1", "b2", "c1", "c2"]


def test_an_overdue_pull_is_reported_once_and_may_still_land(spark):
    import time

    pages, docs = scratch_path(spark, "late"), scratch_path(spark, "late-docs")
    spark.createDataFrame([(json.dumps({"id": "x", "name": "x", "genres": [], "popularity": 1}),)], "value string").write.text(docs)
    store = TableStore(spark)
    store.create_tables(CATALOG_SCHEMAS)
    log = RunLog(store)

    def land(*lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(pages)

    def reports():
        return [r.run_id for r in log.rows().where("logs like '%pull of half, snapshot s, is still incomplete%'").collect()]

    def until(condition):
        end = time.time() + 60
        while not condition() and time.time() < end:
            time.sleep(0.5)
        return condition()

    land(_page("half", "s", ["h1"], 2))
    with pytest.raises(ValueError, match="processing_time"):
        stream_catalog(spark, pages, docs, store, scratch_path(spark, "late-ckpt"), patience_seconds=1)
    q = stream_catalog(spark, pages, docs, store, scratch_path(spark, "late-ckpt"), job_name="job", processing_time="1 second", patience_seconds=1)
    try:
        assert until(reports)
        assert store.select_all("tracks").count() == 0
        land(_page("half", "s", ["h2"], 2, True))
        assert until(lambda: store.select_all("tracks").count() == 2)
        assert len(reports()) == 1
    finally:
        q.stop()


def test_one_jobs_runs_are_one_partition_of_the_log(spark):
    log = RunLog(TableStore(spark))
    for job in ("a", "b", "c"):
        log.log(job, 1, "start")
    plan = log.rows().where("pipeline_name = 'b'").agg(F.max("run_id"))
    assert len(plan.select("*").inputFiles()) >= 1
    files = log.rows().where("pipeline_name = 'b'").inputFiles()
    scan = plan._sc._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(pipeline_name" in scan and "pipeline_name=b" in scan and "pipeline_name=a" not in scan, scan
    assert files and log.next_run_id("b") == 2
