"""Session settings that follow from the size of the input."""

from __future__ import annotations

from math import ceil

# Bytes one shuffle task should hold: sorts stay in memory on executors of a few GB per core.
TASK_BYTES = 128 * 1024**2


def tuning(input_bytes: int, cores: int) -> dict[str, str]:
    """Settings for a run over ``input_bytes`` on ``cores`` task slots.

    The shuffle starts with one partition per ``TASK_BYTES`` and at least one per
    core; adaptive execution merges what turns out small and splits what turns
    out skewed. Concurrent writers spare the sort before the write by reason.
    """
    partitions = max(cores, ceil(input_bytes / TASK_BYTES))
    return {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(TASK_BYTES),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.files.maxPartitionBytes": str(TASK_BYTES),
        "spark.sql.maxConcurrentOutputFileWriters": "8",
        "spark.sql.session.timeZone": "UTC",
    }


def apply(spark, input_bytes: int, cores: int | None = None) -> None:
    """Apply ``tuning`` to a session."""
    for key, value in tuning(input_bytes, cores or spark.sparkContext.defaultParallelism).items():
        spark.conf.set(key, value)
