import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunefold.operators.ranking import dense_rank_global, top_k_with_ties


def test_dense_rank_desc_nulls_first(spark):
    df = spark.createDataFrame([("a", 3), ("b", 1), ("c", None), ("d", 3)], "id string, k int")
    got = {r["id"]: r["r"] for r in dense_rank_global(df, "k", "r").collect()}
    assert got == {"c": 1, "a": 2, "d": 2, "b": 3}


def _window_form(df, descending):
    order = F.col("k").desc_nulls_first() if descending else F.col("k").asc_nulls_last()
    return {r["id"]: r["r"] for r in df.select("id", F.dense_rank().over(Window.orderBy(order)).alias("r")).collect()}


def test_range_rank_equals_window_form(spark):
    rnd = random.Random(7)
    data = [(i, None if rnd.random() < 0.05 else rnd.randint(-300, 300)) for i in range(3000)]
    df = spark.createDataFrame(data, "id int, k int")
    for descending in (True, False):
        got = {r["id"]: r["r"] for r in dense_rank_global(
            df, "k", "r", descending=descending).collect()}
        assert got == _window_form(df, descending)


def test_rank_of_every_orderable_type(spark):
    rnd = random.Random(3)
    numbers = [None if rnd.random() < 0.05 else rnd.randint(-200, 200) for _ in range(2000)]
    df = spark.createDataFrame(list(enumerate(numbers)), "id int, n int")
    casts = {"string": "cast(n as string)", "date": "date_add(date'2024-01-01', n)", "decimal": "cast(n / 7 as decimal(12,4))",
             "double": "if(n % 9 = 0, double('NaN'), n / 3)", "boolean": "n > 0", "timestamp": "timestamp_seconds(n)"}
    for expr in casts.values():
        typed = df.selectExpr("id", f"{expr} as k")
        for descending in (True, False):
            got = {r["id"]: r["r"] for r in dense_rank_global(typed, "k", "r", descending).collect()}
            assert got == _window_form(typed, descending), expr


def test_building_a_rank_runs_no_job(spark):
    df = spark.range(1000).selectExpr("id", "id % 7 as k")
    spark.sparkContext.setJobGroup("rank-plan", "")
    dense_rank_global(df, "k", "r")
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("rank-plan")
    spark.sparkContext.setJobGroup("", "")


def test_ranges_cut_twice_fail_instead_of_misranking(spark):
    """Without exchange reuse the two cuts may differ; then the query must not answer."""
    df = spark.createDataFrame([(i, i * 7919 % 5003) for i in range(4000)], "id int, k int")
    old = spark.conf.get("spark.sql.exchange.reuse", "true")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = {r["id"]: r["r"] for r in dense_rank_global(df, "k", "r").collect()}
    except Exception as e:
        assert "cut twice" in str(e)
    else:
        assert got == _window_form(df, True)
    finally:
        spark.conf.set("spark.sql.exchange.reuse", old)


def test_top_k_with_ties_keeps_ties(spark):
    df = spark.createDataFrame([("a", 9), ("b", 9), ("c", 8), ("d", 7), ("e", None)], "id string, k int")
    got = sorted((r["id"], r["r"]) for r in top_k_with_ties(df, "k", 2, "r").collect())
    assert got == [("a", 2), ("b", 2), ("e", 1)]
