"""Session settings that suit the jobs in this package."""

from __future__ import annotations


MB = 1024 * 1024


def session_conf(
    shuffle_bytes: int | None = None,
    cores: int | None = None,
    partition_bytes: int = 200 * MB,
    scan_bytes: int = 128 * MB,
) -> dict[str, str]:
    """Settings for ``SparkSession.builder.config(map=...)``.

    ``shuffle_bytes`` is the size of the larger side of the diff. Shuffle partitions hold about
    ``partition_bytes`` at any size and there are at least two per core; AQE merges those that
    turn out small. Scan tasks read ``scan_bytes``. Map and reduce tasks multiply to shuffle
    blocks, so from some 10 TB on larger values of both are worth a try.
    """
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # A run writes one open and one closed file per task: two writers at once
        # spare the sort by partition column before the write.
        "spark.sql.maxConcurrentOutputFileWriters": "4",
    }
    if shuffle_bytes is not None or cores is not None:
        by_size = -(-(shuffle_bytes or 0) // partition_bytes)
        conf["spark.sql.shuffle.partitions"] = str(max(by_size, 2 * (cores or 0), 1))
    if shuffle_bytes is not None:
        conf["spark.sql.files.maxPartitionBytes"] = str(scan_bytes)
        # Merge up to full partitions instead of down to the parallelism: each writing task
        # leaves a file of closed rows, a small share of its input.
        conf["spark.sql.adaptive.coalescePartitions.parallelismFirst"] = "false"
        conf["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = str(partition_bytes)
    return conf
