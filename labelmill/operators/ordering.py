"""A total order over a table of any size: every row's place in it, without one task that sees all rows.

The rows are dealt out by range of the order, sorted where they are, and numbered
within their partition; one count per partition gives the rows before it. What is
collected to one place has as many rows as there are partitions.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the folder that ``spark.checkpoint.dir`` names; a temporary one only where it names none, as in tests."""
    spark = df.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="spark-"))
    return df.checkpoint(eager=True)


def numbered(df: DataFrame, *order: Column | str, name: str = "number") -> DataFrame:
    """``df`` with its rows' places in the order, from 0 without a gap, in column ``name``, partitions and rows in that order.

    Rows that the order does not tell apart take their places in any order, once
    for all: the places are fixed by a checkpoint. Nulls stand where the columns of
    ``order`` say. One hot value of the first column is no hot task as long as later
    columns tell its rows apart. An empty table stays empty.
    """
    before, part, at = f"_{name}_before", f"_{name}_part", f"_{name}_at"
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    # the id is the partition, shifted by 33 bits, and the row's place in it
    placed = cut(dealt.withColumn(at, F.monotonically_increasing_id()))
    counts = placed.groupBy(F.shiftright(at, 33).alias(part)).agg(F.count(F.lit(1)).alias("n"))
    # one row per partition, whatever the size of the table
    offsets = counts.select(part, (F.sum("n").over(Window.orderBy(part)) - F.col("n")).alias(before))
    met = placed.withColumn(part, F.shiftright(at, 33)).join(F.broadcast(offsets), part)
    return met.withColumn(name, F.col(before) + F.col(at).bitwiseAND((1 << 33) - 1)).drop(before, part, at)
