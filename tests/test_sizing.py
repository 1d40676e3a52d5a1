from carelake.sizing import cluster_conf


def test_hundred_terabytes_profile():
    c = cluster_conf(100 << 40, executors=1000, cores_per_executor=8)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert parts % 8000 == 0 and parts >= (50 << 40) // (256 << 20)
    assert int(c["spark.sql.adaptive.autoBroadcastJoinThreshold"]) == 64 << 20


def test_small_input_still_fills_the_cluster():
    c = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(c["spark.sql.shuffle.partitions"]) == 80
