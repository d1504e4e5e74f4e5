"""Hot keys and the filter in front of joins, against plain joins."""

from pyspark.sql import functions as F

from caudalix.operators import prefilter, skew


def test_hot_keys_and_joins_like_plain_ones(spark):
    big = spark.range(6_000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 101 == 0, None).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), (F.col("id") % 2).alias("p"))
    other = spark.createDataFrame([("hot", 1, i) for i in range(3)] + [("hot", 0, 9), ("k7", 1, 5), (None, 1, 6), ("absent", 0, 7)], "k string, p long, v int")
    hot = skew.hot_keys(big, ["k"])
    assert list(hot.values()) == [2] and hot == skew.hot_counted(big.where("k is not null").groupBy("k").count(), ["k"], "count")
    for how in ("inner", "left"):
        for on, right in ((["k"], other.drop("p")), (["k", "p"], other)):
            want = sorted(map(str, big.join(right, on, how).select("id", "k", "v").collect()))
            assert sorted(map(str, skew.salted_join(big, right, on, "id", how).select("id", "k", "v").collect())) == want
    spread = skew.salted_join(big, other.drop("p"), ["k"], "id", hot={next(iter(hot)): 4})
    assert spread.count() == big.join(other.drop("p"), "k", "left").count()
    assert skew.hot_keys(big.where("false"), ["k"]) == {} == skew.hot_counted(big.groupBy("k").count().where("false"), ["k"], "count")
    assert skew.salted_join(big.where("false"), other.drop("p"), ["k"], "id").count() == 0


def test_a_hot_key_is_spread_evenly(spark):
    """With a third of the rows under one key no task holds more than three times the median."""
    big = spark.range(120_000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    other = spark.range(120_000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = skew.salted_join(big, other, ["k"], "id")
        sizes = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id().alias("t")).agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 120_000 and sizes[-1] <= 3 * sizes[len(sizes) // 2]


def test_prefilter_drops_only_rows_without_a_partner(spark):
    rows = spark.range(20_000).select("id", F.xxhash64("id").alias("h")).union(spark.createDataFrame([(-1, None)], "id long, h long"))
    keys = spark.range(0, 20_000, 400).select(F.xxhash64("id").alias("h"))
    kept = prefilter.maybe_in(rows, "h", prefilter.bitmap(keys, "h"))
    assert kept.columns == ["id", "h"]
    ids = {r["id"] for r in kept.collect()}
    assert set(range(0, 20_000, 400)) <= ids and len(ids) < 200
    assert prefilter.maybe_in(rows, "h", prefilter.bitmap(keys.where("false"), "h")).count() == 0
