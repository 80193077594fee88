"""Intermediate tables in the folder that all executors share.

A written table cuts lineage and survives lost executors: later stages read
files, not another executor's memory.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tilewright.scratch import new_dir as new_path
from tilewright.scratch import shared_dir  # noqa: F401


def stage(df: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and return it as read back."""
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def stage_by(df: DataFrame, key: str, n_buckets: int, label: str) -> DataFrame:
    """:func:`stage` as a table bucketed by ``key``, so that tables of the same buckets join without a shuffle.

    Its files are in the shared folder; its name is dropped at once, as only the returned DataFrame needs it.
    """
    spark, name = df.sparkSession, f"staged_{uuid.uuid4().hex}"
    df.write.bucketBy(n_buckets, key).option("path", new_path(spark, label)).format("parquet").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return table
