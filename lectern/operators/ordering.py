"""Order over all rows or within groups of any size, without a task that holds a whole group.

Rows are range-partitioned once; row numbers give blocks of bounded size. A
window runs over a block, and what passes from one block to the next is
carried by a window over one row for each block.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.session import materialize

BLOCK = 1 << 16


def numbered(rows: DataFrame, *order: str, name: str = "row") -> DataFrame:
    """``rows`` with their rank from 0 by ``order``: numbers within each range partition, offset by the sizes of the ranges before it."""
    ranged = materialize(rows.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "ranged")
    sizes = ranged.groupBy("_range").agg(F.count("*").alias("_rows"))
    # one row for each range partition: a window over these is small
    before = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_rows")
    within = F.row_number().over(Window.partitionBy("_range").orderBy(*order)) - 1
    return ranged.withColumn(name, within).join(before, "_range").withColumn(name, F.col(name) + F.col("_before")).drop("_range", "_before")


def blocked(rows: DataFrame, group: str, *order: str, size: int = BLOCK) -> DataFrame:
    """``rows`` with ``_n``, their rank within the group, and ``_block``, that of the ``size`` rows they stand among. A null group is a group."""
    ranked = numbered(rows.withColumn("_group", F.coalesce(F.col(group).cast("string"), F.lit("\x00"))), "_group", *order, name="_n")
    first = ranked.groupBy("_group").agg(F.min("_n").alias("_first"))
    return ranked.join(first, "_group").withColumn("_n", F.col("_n") - F.col("_first")).withColumn("_block", F.floor(F.col("_n") / size)).drop("_first")


def in_block(upto_here: bool = False) -> Window:
    """The window over a block's rows in order, all of them or those up to the current one."""
    w = Window.partitionBy("_group", "_block").orderBy("_n")
    return w.rowsBetween(Window.unboundedPreceding, 0) if upto_here else w


def over_blocks() -> Window:
    """The window over one row for each block of a group."""
    return Window.partitionBy("_group").orderBy("_block")


def plain(rows: DataFrame) -> DataFrame:
    return rows.drop("_group", "_block", "_n")
