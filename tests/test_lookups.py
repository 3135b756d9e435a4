from pyspark.sql import functions as F

from helpers import plan_of, rows
from rolecast.operators.lookups import fits_broadcast, hot_keys, lookup_join, salted_join


def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") < 1200, "hot").when(F.col("id") < 2000, F.lit(None)).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        "id",
    )
    right = spark.range(40).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("v"))
    return left, right.unionByName(spark.createDataFrame([("hot", 7), ("nobody", 8)], "k string, v long"))


def test_hot_keys_are_found(spark):
    left, _ = sides(spark)
    assert hot_keys(left, "k", 500) == ["hot"]
    assert hot_keys(left, "k", 5000) == []


def test_salted_join_equals_plain_join(spark):
    left, right = sides(spark)
    for how in ("left", "inner"):
        salted = salted_join(left, right, "k", ["id"], how, hot_rows=500)
        assert rows(salted, "k", "id", "v") == rows(left.join(right, "k", how), "k", "id", "v")


def test_hot_key_is_spread(spark):
    left, right = sides(spark)
    salted = salted_join(left, right, "k", ["id"], hot_rows=500)
    assert "_salt" in plan_of(salted)


def test_size_decides(spark):
    left, right = sides(spark)
    assert fits_broadcast(right)
    assert not fits_broadcast(right, max_rows=3)
    assert not fits_broadcast(right, max_bytes=10)
    small = lookup_join(left, right, "k", ["id"])
    large = lookup_join(left, right, "k", ["id"], max_rows=0, hot_rows=500)
    assert "BroadcastHashJoin" in plan_of(small)
    assert rows(small, "k", "id", "v") == rows(large, "k", "id", "v")
