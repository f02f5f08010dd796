"""Session settings the plans are written for."""

from __future__ import annotations

MB = 1 << 20

# A shuffle here carries keys, ids and counts, at most about a quarter of the text it came from.
INPUT_PER_SHUFFLE_PARTITION = 512 * MB
INPUT_SPLIT = 128 * MB
# Dimensions are broadcast up to this size in memory. Spark knows the size of their files, so
# it is told how much they may grow when read; repetitive text is packed tightly.
BROADCAST_MEMORY = 64 * MB
MEMORY_PER_FILE_BYTE = 20


def session_settings(
    cores: int,
    input_bytes: int = 0,
    input_per_shuffle_partition: int = INPUT_PER_SHUFFLE_PARTITION,
    input_split: int = INPUT_SPLIT,
) -> dict[str, str]:
    """Settings for a cluster of so many cores reading so many bytes.

    Shuffles start with at least two partitions per core, and adaptive execution merges them by
    their real sizes; it also splits skewed joins and rebalanced writes. Whoever wants fewer,
    larger tasks for a very large input raises the last two numbers. Text times have no zone,
    so the session must not have one with clock changes. Building a model compiles more stages
    than the default code cache keeps.
    """
    partitions = max(2 * cores, -(-input_bytes // input_per_shuffle_partition))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.autoBroadcastJoinThreshold": str(BROADCAST_MEMORY),
        "spark.sql.sources.fileCompressionFactor": str(MEMORY_PER_FILE_BYTE),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(input_split),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.codegen.cache.maxEntries": "1000",
    }
