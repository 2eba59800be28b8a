"""A shuffle's partitions are many before adaptive execution packs them."""

import re

import pytest
from pyspark.sql import functions as F

from loanloom.session import FIRST_PARTITIONS, tune

FIRST = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


@pytest.fixture
def unset(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.unset(FIRST)
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)
    spark.conf.unset(FIRST)
    tune(spark)


def counted(spark):
    return spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").count()


def begun_with(spark):
    plan = counted(spark)._jdf.queryExecution().executedPlan().toString()
    return int(re.search(r"hashpartitioning\(k#\w+, (\d+)\)", plan)[1])


def test_few_partitions_are_cut_further(spark, unset):
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert begun_with(tune(spark)) == FIRST_PARTITIONS
    assert counted(spark).rdd.getNumPartitions() < FIRST_PARTITIONS  # and packed again


def test_more_partitions_and_an_own_setting_stay(spark, unset):
    spark.conf.set("spark.sql.shuffle.partitions", "5000")
    assert begun_with(tune(spark)) == 5000
    spark.conf.set(FIRST, "7")
    assert begun_with(tune(spark)) == 7
