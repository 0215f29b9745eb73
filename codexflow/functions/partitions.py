"""Partitioning of small inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """A table's scan over all cores: a file of one row group is one task however much work its rows are.

    A table with a partition for each core, as any large one has, stays as it is: nothing is shuffled at scale. ``scan`` has
    to be a plain scan, as the partitions of other plans are only known once they have run.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan
