from pyspark.sql import functions as F

from tunefold.functions.agg import sorted_distinct_join
from tunefold.functions.text import (
    array_text_elements,
    array_to_text,
    explode_list,
    format_duration,
    round_half_away_int,
    year_month,
)


def test_format_duration(spark):
    df = spark.createDataFrame([(180000,), (185999,), (59999,), (0,), (None,)], "ms int")
    got = [r[0] for r in df.select(format_duration("ms")).collect()]
    assert got == ["3:00", "3:05", "0:59", "0:00", ":"]


def test_explode_list_counts(spark):
    df = spark.createDataFrame([(1, "x, y"), (2, "x"), (3, ""), (4, None)], "id int, s string")
    got = {r["id"]: r["n"] for r in df.select("id", explode_list("s").alias("v")).groupBy("id").agg(
        F.count("v").alias("n")).collect()}
    assert got == {1: 2, 2: 1}


def test_array_text_parse(spark):
    df = spark.createDataFrame([(1, '{"lo-fi beats",jazz}'), (2, "{}"), (3, None)], "id int, g string")
    got = sorted((r["id"], r["genre"]) for r in df.select("id", F.explode(array_text_elements("g")).alias("genre")).collect())
    assert got == [(1, "jazz"), (1, "lo-fi beats")]


def test_array_to_text_quotes_like_the_warehouse(spark):
    df = spark.createDataFrame([(["pop", "lo-fi beats", "", "NULL", 'a"b', "x,y"],), ([],), (None,)], "g array<string>")
    got = [r[0] for r in df.select(array_to_text("g")).collect()]
    assert got == ['{pop,"lo-fi beats","","NULL","a\\"b","x,y"}', "{}", None]


def test_array_text_round_trip_on_plain_genres(spark):
    df = spark.createDataFrame([(["pop", "rock", "UNITED STATES"],)], "g array<string>")
    back = df.select(array_text_elements(array_to_text("g")).alias("b")).first()["b"]
    assert back == ["pop", "rock", "UNITED STATES"]


def test_round_half_away_from_zero(spark):
    df = spark.createDataFrame([(2.5,), (-2.5,), (2.4,), (None,)], "x double")
    assert [r[0] for r in df.select(round_half_away_int("x")).collect()] == [3, -3, 2, None]


def test_year_month(spark):
    df = spark.createDataFrame([("2023-01-01",), ("2023",), (None,)], "d string")
    assert [r[0] for r in df.select(year_month("d")).collect()] == ["2023-01", "2023", None]


def test_sorted_distinct_join(spark):
    df = spark.createDataFrame([("g", "b"), ("g", "a"), ("g", "b"), ("g", None), ("h", None)], "k string, v string")
    got = {r["k"]: r["out"] for r in sorted_distinct_join(df, ["k"], "v", "out").collect()}
    assert got == {"g": "a, b"}


def test_sorted_distinct_join_many_chunks_matches_single_sort(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("k"), F.format_string("v%05d", F.col("id") * 7919 % 5000).alias("v"))
    got = {r["k"]: r["out"] for r in sorted_distinct_join(df, ["k"], "v", "out", n_chunks=16).collect()}
    want = {r["k"]: r["out"] for r in df.groupBy("k").agg(
        F.array_join(F.array_sort(F.collect_set("v")), ", ").alias("out")).collect()}
    assert got == want


def test_cluster_conf_scales_partitions():
    from tunefold.session import cluster_conf

    big = cluster_conf(100 << 40, 8000)  # 100 TiB on 8000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (256 << 20)
    small = cluster_conf(1 << 20, 8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16
