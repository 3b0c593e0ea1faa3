"""Session helpers: cluster sizing and package shipping."""


def test_cluster_conf_sizes_partitions():
    from tickwise.session import cluster_conf
    c = cluster_conf(input_bytes=100 << 40, executors=1000, cores_per_executor=4, executor_memory_gb=16)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 4000 == 0 and parts >= (100 << 40) // (256 << 20)
    assert c["spark.sql.files.maxPartitionBytes"] == "256m"
    small = cluster_conf(input_bytes=1 << 30, executors=2, cores_per_executor=4, executor_memory_gb=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 24      # 3 waves over 8 cores


def test_package_is_shipped_once(spark):
    from tickwise.session import ship_package
    ship_package(spark)
    ship_package(spark)
    assert getattr(spark.sparkContext, "_tickwise_shipped", False)
    # a Python task importing the package from a worker succeeds
    rdd = spark.sparkContext.parallelize([1], 1)
    assert rdd.map(lambda _: __import__("tickwise.operators.series").__name__).collect() == ["tickwise"]
