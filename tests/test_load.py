import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tunefold.operators.load import KeyViolation, TableStore
from tunefold.schemas import ALBUMS, CATALOG_SCHEMAS, TableSchema


def _albums(spark, rows):
    return spark.createDataFrame(rows, ALBUMS.struct)


@pytest.fixture()
def store(spark):
    s = TableStore(spark)
    s.create_tables(CATALOG_SCHEMAS)
    return s


def test_insert_then_key_checks(spark, store):
    store.insert(_albums(spark, [("a", "A", "2020", 1)]), "albums")
    with pytest.raises(KeyViolation):
        store.insert(_albums(spark, [("a", "A2", "2020", 1)]), "albums")
    with pytest.raises(KeyViolation):
        store.insert(_albums(spark, [("b", "B", "2020", 1), ("b", "B", "2020", 1)]), "albums")
    with pytest.raises(KeyViolation):
        store.insert(spark.createDataFrame([(None, "N", "2020", 1)], "album_id string, album_name string, "
                                           "album_release_date string, album_total_tracks int"), "albums")
    assert store.select_all("albums").count() == 1


def test_upsert_source_wins_and_is_idempotent(spark, store):
    store.overwrite(_albums(spark, [("a", "A", "2020", 1), ("b", "B", "2020", 2)]), "albums")
    batch = _albums(spark, [("b", "B2", "2021", 3), ("c", "C", "2022", 4)])
    store.upsert(batch, "albums")
    first = sorted(tuple(r) for r in store.select_all("albums").collect())
    store.upsert(batch, "albums")
    assert sorted(tuple(r) for r in store.select_all("albums").collect()) == first == [
        ("a", "A", "2020", 1), ("b", "B2", "2021", 3), ("c", "C", "2022", 4)]


def test_upsert_rejects_repeated_or_null_keys(spark, store):
    with pytest.raises(KeyViolation):
        store.upsert(_albums(spark, [("a", "A", "2020", 1), ("a", "B", "2020", 1)]), "albums")
    with pytest.raises(KeyViolation):
        store.upsert(spark.createDataFrame([(None, "A", "2020", 1)], "album_id string, album_name string, "
                                           "album_release_date string, album_total_tracks int"), "albums")


def test_upsert_keep_latest(spark, store):
    batch = _albums(spark, [("a", "old", "2020-01-01", 1), ("a", "new", "2021-01-01", 1)])
    store.upsert(batch, "albums", on_duplicate="keep_latest", order_by="album_release_date")
    assert [tuple(r) for r in store.select_all("albums").collect()] == [("a", "new", "2021-01-01", 1)]


def test_overwrite_replaces_every_partition(spark, store):
    store.overwrite(_albums(spark, [(f"k{i}", "A", "2020", 1) for i in range(50)]), "albums")
    assert store.overwrite(_albums(spark, [("z", "Z", "2020", 1)]), "albums") == 1
    assert [r["album_id"] for r in store.select_all("albums").collect()] == ["z"]
    assert len(store.select_all("albums").inputFiles()) == 1
    assert spark.sql(f"show partitions {store.name('albums')}").count() == 1
    store.overwrite(_albums(spark, []), "albums")
    assert store.select_all("albums").collect() == []


def test_load_dispatch_errors(spark, store):
    df = _albums(spark, [("a", "A", "2020", 1)])
    with pytest.raises(ValueError, match="unknown load method"):
        store.load({"albums": df}, method="merge")
    with pytest.raises(ValueError, match="no schema declared for table 'nope'"):
        store.load({"nope": df}, method="insert")


def test_drop_and_recreate(spark, store):
    store.insert(_albums(spark, [("a", "A", "2020", 1)]), "albums")
    store.drop_table("albums")
    assert not store.table_exists("albums")
    store.create_tables([ALBUMS])
    assert store.select_all("albums").where(F.col("album_id") == "a").count() == 0


def _tracks(spark, rows):
    from tunefold.schemas import TRACKS

    full = [(k, f"n{k}", pop, 1000, "2024-01-01", None, None, pl, pl, "s") for k, pop, pl in rows]
    return spark.createDataFrame(full, TRACKS.struct)


def _got(store):
    return sorted((r["track_id"], r["track_popularity"], r["playlist_id"]) for r in store.select_all("tracks").collect())


def test_upsert_reads_and_rewrites_only_the_batchs_partitions(spark, store):
    store.overwrite(_tracks(spark, [(f"k{i}", 1, "P1") for i in range(500)]), "tracks")
    before = set(store.select_all("tracks").inputFiles())
    batch = _tracks(spark, [("k3", 2, "P2"), ("new", 2, "P1")])  # k3 moves to another playlist
    assert store.upsert(batch, "tracks") == 2
    after = set(store.select_all("tracks").inputFiles())
    part = lambda f: f.split("key_part=")[1].split("/")[0]
    touched = {part(f) for f in before - after}
    assert 1 <= len(touched) <= 2 and touched == {part(f) for f in after - before} and len({part(f) for f in before}) == 16
    assert _got(store) == sorted([(f"k{i}", 1, "P1") for i in range(500) if i != 3] + [("k3", 2, "P2"), ("new", 2, "P1")])
    assert store.select_all("tracks").columns == store.schemas["tracks"].columns


def _above_scans(plan: str, table: str) -> list[str]:
    """The operators over each scan of a table, in the formatted plan's tree."""
    lines = plan.split("\n\n")[0].splitlines()
    out = []
    for k, line in enumerate(lines):
        if table in line and "Scan parquet" in line:
            depth, above = len(line) - len(line.lstrip(" :+-")), []
            for up in reversed(lines[:k]):
                d = len(up) - len(up.lstrip(" :+-"))
                if d < depth:
                    above.append(up.strip(" :+-"))
                    depth = d
            out.append(" < ".join(above))
    return out


@pytest.mark.parametrize("broadcasts", ["10485760", "-1"])
def test_an_upsert_moves_the_batch_and_not_the_table(spark, store, broadcasts):
    """The stored side of the key match is read by buckets: no exchange over its scan."""
    store.overwrite(_tracks(spark, [(f"k{i}", 1, "P1") for i in range(500)]), "tracks")
    s = store.schemas["tracks"]
    batch, _ = store._staged(_tracks(spark, [("k3", 2, "P2"), ("new", 2, "P1")]), s, True)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcasts)
    try:
        merged = store.merged(batch, s)
        plan = merged._sc._jvm.PythonSQLUtils.explainString(merged._jdf.queryExecution(), "formatted")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    (above,) = _above_scans(plan, f"{store.database}.tracks")
    assert "SortMergeJoin" in above and "Exchange" not in above, plan
    assert plan.split("\n\n")[0].count("Exchange") == 1 and "Bucketed: true" in plan
    assert "PartitionFilters" in plan


def test_insert_after_upsert_and_null_playlist(spark, store):
    store.insert(_tracks(spark, [("a", 1, "it's"), ("n", 1, None)]), "tracks")
    store.upsert(_tracks(spark, [("a", 5, "it's"), ("b", 1, "x"), ("n", 2, None)]), "tracks")
    store.insert(_tracks(spark, [("c", 1, "P7")]), "tracks")
    assert sorted(_got(store), key=repr) == sorted([("a", 5, "it's"), ("b", 1, "x"), ("c", 1, "P7"), ("n", 2, None)], key=repr)


@pytest.mark.parametrize("method", ["insert", "overwrite", "upsert"])
def test_a_batch_that_fails_leaves_the_table_alone(spark, store, method):
    old = [("x", 1, "P1"), ("y", 1, "P2")]
    store.overwrite(_tracks(spark, old), "tracks")
    bad = _tracks(spark, [("x", 2, "P9"), ("z", 2, "P1")]).withColumn(
        "track_name", F.when(F.col("track_id") == "z", F.raise_error(F.lit("broken row"))).otherwise(F.col("track_name")))
    with pytest.raises(Exception, match="broken row"):
        getattr(store, method)(bad, "tracks")
    assert _got(store) == sorted(old)


@pytest.mark.parametrize("method", ["overwrite", "upsert"])
def test_a_load_that_fails_while_the_table_is_written_leaves_it_alone(spark, store, monkeypatch, method):
    """The partitions are replaced by Spark's commit at the end of the write, or not at all."""
    store.overwrite(_tracks(spark, [(f"k{i}", 1, "P1") for i in range(40)]), "tracks")
    want, real = _got(store), TableStore._replace
    monkeypatch.setattr(TableStore, "_replace", lambda self, rows, s: real(self, rows.withColumn(
        "track_name", F.when(F.col("track_id") == "k7", F.raise_error(F.lit("stopped"))).otherwise(F.col("track_name"))), s))
    with pytest.raises(Exception, match="stopped"):
        getattr(store, method)(_tracks(spark, [(f"k{i}", 2, "P2") for i in range(30)]), "tracks")
    monkeypatch.undo()
    assert _got(store) == want
    getattr(store, method)(_tracks(spark, [(f"k{i}", 2, "P2") for i in range(30)]), "tracks")  # the load is repeated
    kept = [(f"k{i}", 1, "P1") for i in range(30, 40)] if method == "upsert" else []
    assert _got(store) == sorted([(f"k{i}", 2, "P2") for i in range(30)] + kept)


def test_tables_partitioned_by_key_columns(spark, store):
    """Quotes, signs and an overwrite that leaves a partition out."""
    s = TableSchema("by_job", StructType([StructField("v", IntegerType()), StructField("job", StringType()), StructField("run", IntegerType())]),
                    ("job", "run"), partition_by=("job",))
    rows = lambda *r: spark.createDataFrame(r, "job string, run int, v int")
    store.create_tables([s])
    names = ["plain", "it's", "a/b=c %", "back\\slash"]
    store.insert(rows(*((j, 1, 1) for j in names)), "by_job")
    store.upsert(rows(("it's", 1, 5), ("it's", 2, 6), ("new", 1, 7)), "by_job")
    got = lambda: sorted((r.job, r.run, r.v) for r in store.select_all("by_job").collect())
    assert got() == sorted([("plain", 1, 1), ("it's", 1, 5), ("it's", 2, 6), ("a/b=c %", 1, 1), ("back\\slash", 1, 1), ("new", 1, 7)])
    assert store.select_all("by_job").columns == ["v", "job", "run"]
    store.overwrite(rows(("plain", 9, 9)), "by_job")
    assert got() == [("plain", 9, 9)]
    with pytest.raises(ValueError, match="only key columns"):
        TableSchema("bad", s.struct, ("run",), partition_by=("job",))


def test_layout_grows_with_the_table():
    big = CATALOG_SCHEMAS["tracks"].laid_out(100 << 40)
    assert big.parts * big.buckets * (512 << 20) >= 100 << 40 and big.parts >= 1600 and big.buckets >= 128
    assert CATALOG_SCHEMAS["tracks"].laid_out(1) == CATALOG_SCHEMAS["tracks"]


def test_many_playlists_load_as_few_files(spark, store):
    rows = spark.range(15_000).selectExpr(
        "cast(id as string) track_id", "'n' track_name", "1 track_popularity", "1 track_duration_ms", "'2024' track_added_at",
        "'a' album_id", "'r' artist_id", "cast(id % 3000 as string) playlist_id", "'p' playlist_name", "'s' snapshot_id")
    store.overwrite(rows, "tracks")
    s = store.schemas["tracks"]
    assert len(store.select_all("tracks").inputFiles()) <= s.parts * s.buckets
    store.upsert(rows.where("playlist_id = '7'"), "tracks")
    assert store.select_all("tracks").count() == 15_000


def test_compact_keeps_the_table(spark, store):
    for i in range(4):
        store.insert(_tracks(spark, [(f"k{j}", i, "P") for j in range(10 * i, 10 * i + 10)]), "tracks")
    want, files = _got(store), len(store.select_all("tracks").inputFiles())
    store.compact("tracks")
    assert _got(store) == want and len(store.select_all("tracks").inputFiles()) < files


def test_another_process_sees_tables_views_and_run_ids(spark, tmp_path):
    """Two processes after another on one folder, with nothing shared but the files."""
    import os
    import subprocess
    import sys

    code = """
import sys
from tunefold.operators.load import TableStore
from tunefold.operators.runlog import RunLog
from tunefold.plans.views import create_views, read_view
from tunefold.schemas import CATALOG_SCHEMAS, TRACKS
from tunefold.session import local_session
spark = local_session(2, shuffle_partitions=2)
store = TableStore(spark, sys.argv[1])
store.create_tables(CATALOG_SCHEMAS)
store.upsert(spark.createDataFrame([(sys.argv[2], 'n', 1, 61000, 'd', None, None, 'p', 'p', 's')], TRACKS.struct), 'tracks')
create_views(store)
assert not create_views(store)
log = RunLog(store)
run = log.next_run_id('job')
log.log('job', run)
print('SAW', run, sorted(r.track_id for r in store.select_all('tracks').collect()),
      sorted(r.track_duration_min for r in read_view(store, 'most_popular_tracks_with_duration').collect()))
"""
    env = os.environ | {"PYTHONPATH": os.path.dirname(os.path.dirname(os.path.abspath(__file__)))}
    said = []
    for key in ("t1", "t2"):
        out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "store"), key], env=env, capture_output=True, text=True)
        said += [line for line in out.stdout.splitlines() if line.startswith("SAW")] or [out.stderr[-500:]]
    assert said == ["SAW 1 ['t1'] ['1:01']", "SAW 2 ['t1', 't2'] ['1:01', '1:01']"]


def test_a_large_load_has_more_tasks_than_buckets(spark, store, monkeypatch):
    """A task has one bucket of some partitions: what it sorts does not grow with the whole table."""
    from tunefold.operators import load

    monkeypatch.setattr(load, "ROWS_PER_TASK", 10)
    s = store.schemas["tracks"]
    store.overwrite(_tracks(spark, [(f"k{i}", 1, "P1") for i in range(700)]), "tracks")
    assert len(store.select_all("tracks").inputFiles()) <= s.parts * s.buckets
    new = _tracks(spark, [(f"k{i}", 2, "P2") for i in range(500, 900)])
    batch, n = store._staged(new, s, True, by_part=True)
    assert n == 400 and store.merged(batch, s, n).rdd.getNumPartitions() == 10 * s.buckets
    assert store._by_bucket(batch, s, n).rdd.getNumPartitions() == 10 * s.buckets
    store.upsert(new, "tracks")
    assert _got(store) == sorted([(f"k{i}", 1, "P1") for i in range(500)] + [(f"k{i}", 2, "P2") for i in range(500, 900)])
    assert len(store.select_all("tracks").inputFiles()) <= s.parts * s.buckets
    with pytest.raises(KeyViolation):
        store.insert(_tracks(spark, [(f"k{i}", 3, "P1") for i in range(899, 1300)]), "tracks")
    store.insert(_tracks(spark, [(f"k{i}", 3, "P1") for i in range(900, 1300)]), "tracks")
    assert store.select_all("tracks").count() == 1300


def test_a_kept_log_may_repeat_its_keys(spark, store, monkeypatch):
    """Two messages of one run, second and status are two rows of a history; a NULL key is still refused."""
    from tunefold.operators import load
    from tunefold.operators.runlog import RunLog

    monkeypatch.setattr(load, "ROWS_PER_TASK", 10)
    log = RunLog(store)
    row = lambda job, text: (job, 1, "2024-01-01 00:00:00", "start", None, text)
    history = spark.createDataFrame([row("a", str(i)) for i in range(30)] + [row("b", "x")], store.schemas[log.table].struct)
    with pytest.raises(KeyViolation, match="repeated"):
        store.overwrite(history, log.table)
    store.overwrite(history, log.table, repeats=True)
    assert log.rows().count() == 31 and log.next_run_id("a") == 2
    with pytest.raises(KeyViolation, match="NULL"):
        store.overwrite(history.withColumn("status", F.lit(None).cast("string")), log.table, repeats=True)
