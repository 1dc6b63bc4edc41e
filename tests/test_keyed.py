import pytest
from conftest import rows
from pyspark.sql import Window
from pyspark.sql import functions as F

from parcelworks.operators import keyed


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, a third without a key."""
    return spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot")
        .when(F.col("id") % 3 == 1, F.concat(F.lit("k"), (F.col("id") % 50).cast("string")))
        .alias("key"),
        F.col("id").alias("n"),
        (F.col("id") % 7).cast("double").alias("price"),
    )


def test_group_stats_equals_window(skewed):
    got = keyed.group_stats(
        skewed, "key", {"total": F.sum("price"), "top": F.max("n")}, ["n"]
    )
    w = Window.partitionBy("key")
    want = skewed.withColumns(
        {
            "total": F.when(F.col("key").isNotNull(), F.sum("price").over(w)),
            "top": F.when(F.col("key").isNotNull(), F.max("n").over(w)),
        }
    )
    assert rows(got, *want.columns) == rows(want)


def test_lookup_keeps_every_row(spark, skewed):
    right = spark.createDataFrame([("hot", 1), ("k1", 2), ("zz", 3)], "rk string, v int")
    got = keyed.lookup(skewed, right, "key", "rk", ["v"], ["n"])
    want = skewed.join(right, skewed["key"] == right["rk"], "left").drop("rk")
    assert rows(got, *want.columns) == rows(want)
    # A hot key that the right side lacks.
    got = keyed.lookup(skewed, right.where("v > 1"), "key", "rk", ["v"])
    assert got.where("key = 'hot'").where("v is null").count() == 300


def test_repeated_right_keys_fan_out(spark, skewed):
    right = spark.createDataFrame([("hot", 1), ("hot", 2), ("k1", 3)], "rk string, v int")
    got = keyed.lookup(skewed, right, "key", "rk", ["v"], ["n"])
    want = skewed.join(right, skewed["key"] == right["rk"], "left").drop("rk")
    assert rows(got, *want.columns) == rows(want)


def test_anti_join_keeps_null_keys(spark, skewed):
    gone = spark.createDataFrame([("hot",), (None,)], "key string")
    got = keyed.anti_join(skewed, gone, "key")
    assert rows(got) == rows(skewed.where("key is null or key <> 'hot'"))


def test_left_join_fans_out_and_keeps_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("c", 4)], "k string, n int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), (None, "z")], "rk string, v string")
    got = keyed.left_join(left, right, "k", "rk", spread=["n"]).select("n", "v")
    assert rows(got) == [(1, "x"), (1, "y"), (2, None), (3, None), (4, None)]


def test_rows_without_key_are_spread(skewed):
    """No partition of the join holds the bulk of the null-key rows."""
    spark = skewed.sparkSession
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = keyed.group_stats(skewed, "key", {"n_rows": F.count("*")}, ["n"])
        parts = (
            got.where("key is null")
            .groupBy(F.spark_partition_id().alias("p"))
            .count()
            .collect()
        )
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(parts) == 4
    assert max(r["count"] for r in parts) < 250


def test_presence_and_duplicates(spark):
    a = spark.createDataFrame([("x", 1), ("x", 0), ("y", 1), (None, 1)], "k string, f int")
    b = spark.createDataFrame([("y",), ("z",)], "k string")
    got = keyed.key_presence({"a": (a, "k", {"flag": F.col("f")}), "b": (b, "k", {})})
    assert rows(got, "key", "n_a", "flag", "n_b") == [
        ("x", 2, 1, 0), ("y", 1, 1, 1), ("z", 0, 0, 1),
    ]
    assert rows(keyed.duplicate_keys(a, "k")) == [("x", 2)]


def test_hot_key_of_a_plain_join_is_split_at_run_time(spark):
    """Two thirds of the left rows under one real key: the engine cuts that partition."""
    left = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, F.concat(F.lit("k"), F.col("id").cast("string")))
        .otherwise("hot")
        .alias("k"),
        F.col("id").alias("n"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    right = spark.range(60_000).select(
        F.when(F.col("id") == 0, "hot")
        .otherwise(F.concat(F.lit("k"), F.col("id").cast("string")))
        .alias("rk"),
        F.col("id").alias("v"),
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = keyed.left_join(left, right, "k", "rk", spread=["n"])
        assert len(got.collect()) == 60_000
        assert "skew=true" in got._jdf.queryExecution().executedPlan().toString()
        assert got.where("k = 'hot' and v = 0").count() == 40_000
    finally:
        for key in settings:
            spark.conf.unset(key)
