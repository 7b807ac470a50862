"""Hot keys: the plans that must split or pre-aggregate them do so."""

import pytest
from pyspark.sql import functions as F

from docsheaf.operators import collapse, look_up, roll_up, unknown_references
from docsheaf.sources import one_per_id, related_rows

ROWS = 60_000
SETTINGS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.shuffle.partitions": "8",
}


@pytest.fixture
def hot(spark):
    """Settings under which small data is skewed data, and no broadcasts."""
    before = {k: spark.conf.get(k, None) for k in SETTINGS}
    for k, v in SETTINGS.items():
        spark.conf.set(k, v)
    yield spark.range(ROWS, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias("v"),
        F.sha1(F.col("id").cast("string")).alias("pad"))
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    rows = df.collect()
    return rows, df._jdf.queryExecution().executedPlan().toString()


def test_related_rows_splits_a_hot_parent(spark, hot):
    parents = spark.range(1001).select(F.col("id"), F.lit("p").alias("name"))
    rows, plan = final_plan(related_rows(parents, hot, "id", "k", "child"))
    assert "skew=true" in plan
    assert len(rows) == ROWS + 1 and sum(r["child"]["v"] for r in rows if r["child"]) == ROWS * (ROWS - 1) // 2


def test_related_rows_sorts_no_children(spark, hot):
    """What a task holds grows with the parents dealt to it, not with their children."""
    parents = spark.range(1001).select(F.col("id"), F.lit("p").alias("name"))
    rows, plan = final_plan(related_rows(parents, hot, "id", "k", "child"))
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" in plan
    assert sum(r["child"] is None for r in rows) == 1 and sum(r["id"] == 7 for r in rows) == ROWS // 3 + ROWS // 1000 - ROWS // 3000


def test_lookup_splits_a_hot_value(spark, hot):
    side = spark.range(900).select(F.col("id").alias("s"), F.lit("x").alias("name"))
    rows, plan = final_plan(look_up(hot, side, F.col("k"), "s", {"name": "name"}))
    assert "skew=true" in plan and len(rows) == ROWS


@pytest.mark.parametrize("build", [
    lambda hot, spark: one_per_id(hot, ["k"]),
    lambda hot, spark: collapse(hot, "k", F.col("v")),
    lambda hot, spark: unknown_references(hot, "k", spark.range(10).withColumnRenamed("id", "s"), "s"),
    lambda hot, spark: roll_up(hot, "k", spark.range(1000).withColumn("p", F.lit(1)), "id", "p",
                               spark.range(1, 2).selectExpr("id AS pk", "'n' AS lvl"), "pk", "lvl"),
])
def test_groups_are_reduced_before_the_shuffle(spark, hot, build):
    _, plan = final_plan(build(hot, spark))
    assert "partial_" in plan
