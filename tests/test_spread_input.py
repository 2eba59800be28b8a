import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from loanloom.sources.sample_views import _spread, table


def test_rows_of_one_row_group_are_spread(spark, tmp_path):
    """The splits of a file are many, but all its rows come in one of them."""
    n = 20000
    customers = pa.table({
        "c_custkey": pa.array(range(n), pa.int64()), "c_name": [f"Customer#{i:09}" for i in range(n)],
        "c_nationkey": pa.array([i % 25 for i in range(n)], pa.int32()), "c_acctbal": [i / 7 for i in range(n)],
        "c_mktsegment": ["M"] * n,
    })
    pq.write_table(customers, tmp_path / "customer.parquet", row_group_size=n)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    try:
        read = table(spark, str(tmp_path), "customer")
        assert read.rdd.getNumPartitions() >= cores
        spread = _spread(spark, read)
        sizes = [r[0] for r in spread.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1))).select("count(1)").collect()]
        assert len(sizes) >= cores and max(sizes) <= 2 * n / cores
        assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, read.collect()))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    # Nothing is sorted for it in the task that reads the file.
    assert spark.conf.get("spark.sql.execution.sortBeforeRepartition") == "false"
