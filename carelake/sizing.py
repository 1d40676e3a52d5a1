"""Cluster settings derived from the data volume (the 100 TB profile).

Local tests use ``shuffle.partitions = 2 x cores``.  On a cluster the right
numbers follow from bytes, not cores: scan splits of ``split_mb``, shuffle
partitions sized so one reduce task handles ``target_partition_mb`` of
shuffled data (AQE coalesces small ones, splits skewed ones), and a
broadcast threshold that is a hard, measured bound.
"""

from __future__ import annotations

import math


def cluster_conf(input_bytes: int, executors: int, cores_per_executor: int,
                 shuffle_ratio: float = 0.5, split_mb: int = 256,
                 target_partition_mb: int = 256, broadcast_mb: int = 64) -> dict[str, str]:
    """Settings for a job reading ``input_bytes``.

    ``shuffle_ratio``: shuffled bytes / scanned bytes after pruning and
    partial aggregation (0.5 is conservative for these jobs: ranking and
    the fact joins shuffle projected rows; counts shuffle almost nothing).
    """
    slots = executors * cores_per_executor
    shuffle_bytes = input_bytes * shuffle_ratio
    parts = max(slots * 2, math.ceil(shuffle_bytes / (target_partition_mb << 20)))
    parts = int(math.ceil(parts / slots) * slots)          # whole waves
    return {
        "spark.sql.files.maxPartitionBytes": str(split_mb << 20),
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_mb << 20),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_mb << 20),
        # a side is broadcast only when its measured size is under this bound
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(broadcast_mb << 20),
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.session.timeZone": "UTC",
    }
