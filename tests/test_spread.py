"""Joins on keys of few values and shuffles of large inputs keep all tasks busy."""

from pyspark.sql import functions as F

from delaylens import session as SE
from delaylens.operators import lookups as E
from delaylens.operators import ml as M
from delaylens.operators import tables as TB
from delaylens.sources import flights as FL
from delaylens.sources.tables import table_bytes

SF = "/root/testdata/sf0.001"




def _no_planner_broadcast(spark, fn):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        return fn()
    finally:
        spark.conf.set(key, before)


def _rows(spark):
    return spark.range(200).select("id", (F.col("id") % 2).cast("int").alias("c"),
                                   F.when(F.col("id") % 9 > 0, F.concat(F.lit("s"), F.col("id") % 4)).alias("s"),
                                   (F.col("id") % 3).alias("h"), F.lit(True).alias("is_train"),
                                   (F.col("id") * 1.0).alias("DepDelayMinutes"))


def test_joins_by_class_and_label_do_not_shuffle_the_rows(spark):
    df = _rows(spark)

    def joined():
        for out in (M.balanced_weights(df, "c"), M.stratified_split(df, "c", cols=["id"]), M.label_encode(df, ["s"]),
                    E.attach_group_stats(df, "s", {"n": F.count(F.lit(1))}), E.train_priors(df, keys=[("s", "p")]),
                    E.train_traffic_prior(df, keys=["s", "h"])):
            assert out.count() == 200
            assert "SortMergeJoin" not in out._jdf.queryExecution().sparkPlan().toString()
    _no_planner_broadcast(spark, joined)


def test_many_keys_are_left_to_the_planner(spark, monkeypatch):
    monkeypatch.setattr(TB, "FEW_ROWS", 3)
    df = _rows(spark)
    out = _no_planner_broadcast(spark, lambda: E.attach_group_stats(df, "s", {"n": F.count(F.lit(1))}).collect())
    few = E.attach_group_stats(df, "h", {"n": F.count(F.lit(1))})
    assert sorted((r["id"], r["n"]) for r in out if r["s"] is None) == [(i, None) for i in range(0, 200, 9)]
    assert few.where("n = 67").count() == 134


def test_partitions_follow_the_input(spark, monkeypatch):
    first, size = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(first, None), spark.conf.get(size)
    total = table_bytes(spark, SF, "lineitem") + table_bytes(spark, SF, "orders")
    try:
        spark.conf.unset(first)
        SE.spread_shuffles(spark, 1000)
        assert spark.conf.get(first, None) is None and spark.conf.get(size) == before[1]
        assert total > 1000
        monkeypatch.setattr(SE, "INPUT_BYTES", total // 500)
        n = FL.flights(spark, SF).count()
        assert SE.shuffle_parts(spark) >= 500 and int(spark.conf.get(size).rstrip("b")) <= SE.SHUFFLED_BYTES
        SE.spread_shuffles(spark, 1000)         # a smaller input leaves it
        assert SE.shuffle_parts(spark) >= 500
    finally:
        spark.conf.unset(first)
        spark.conf.set(size, before[1])
    assert FL.flights(spark, SF).count() == n


def test_sizes_are_read_in_all_units():
    assert [SE._bytes(x) for x in ("8m", "64MB", "67108864b", "1024", "256k")] == [8 << 20, 64 << 20, 64 << 20, 1024, 256 << 10]
