"""Running totals over a whole table without putting it into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tilewright.llm.scratch import stage


def running_totals(df: DataFrame, order: list[str], values: dict[str, str]) -> DataFrame:
    """Add, for each ``values`` item ``column -> name``, the sum over all rows before this one.

    Rows are range-partitioned by ``order`` (which must identify a row for the
    result to be unique) and written; each range is summed by a window of its
    own, and the sums of the ranges before it are added. Only one total per
    range reaches the driver, so its share is bounded by the partition count.
    An empty table gives an empty table; null values count as zero.
    """
    spark = df.sparkSession
    ranged = stage(df.repartitionByRange(*order).withColumn("range_no", F.spark_partition_id()), "ranges")
    sums = [F.sum(c).alias(n) for c, n in values.items()]
    totals = sorted(ranged.groupBy("range_no").agg(*sums).collect())
    before, rows = [0] * len(values), []
    for total in totals:
        rows.append((total["range_no"], *before))
        before = [b + (total[n] or 0) for b, n in zip(before, values.values())]
    names = [f"before_{n}" for n in values.values()]
    base = spark.createDataFrame(rows, "range_no int, " + ", ".join(f"{n} long" for n in names))
    w = Window.partitionBy("range_no").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = ranged.join(F.broadcast(base), "range_no")  # one row for each range
    for (column, name), first in zip(values.items(), names):
        out = out.withColumn(name, F.col(first) + F.coalesce(F.sum(column).over(w), F.lit(0)))
    return out.drop("range_no", *names)
