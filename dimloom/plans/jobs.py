"""Jobs that run at the same time."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Writes that start together; each already spreads over the cluster, this only keeps it busy
# through their last tasks.
SIDE_BY_SIDE = 4


def side_by_side(spark: SparkSession, *writes: Callable[[], None]) -> None:
    """The jobs keep the caller's job group, scheduler pool and tags."""
    in_thread = inheritable_thread_target(spark)
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        list(pool.map(in_thread(lambda write: write()), writes))
