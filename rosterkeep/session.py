"""Session settings the jobs are written for."""

from __future__ import annotations

import math
from contextlib import contextmanager

from pyspark.sql import SparkSession

#: Settings that hold for a laptop and for a cluster alike.
COMMON_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "128m",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
}


def shuffle_partitions_for(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Number of shuffle partitions to start from: about ``target_bytes`` each, never fewer than the cores.

    Adaptive execution merges small partitions afterwards, so the figure only has to be large enough.
    """
    return max(cores, math.ceil(input_bytes / target_bytes))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int):
    """Within it shuffles start from as many partitions as the input needs, if that is more than the session has.

    Adaptive execution merges small partitions and splits joins, but it never splits an aggregate.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    wanted = shuffle_partitions_for(input_bytes, spark.sparkContext.defaultParallelism)
    if wanted > int(before):
        spark.conf.set(key, str(wanted))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(
    app: str = "rosterkeep",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Get or create a session; ``master`` is left to spark-submit unless it is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(COMMON_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
