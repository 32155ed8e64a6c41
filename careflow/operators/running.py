"""Running totals over a whole table, without bringing it into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from careflow.sources.scratch import checkpointed


def with_total_before(df: DataFrame, order: Sequence[str], amount: Column) -> DataFrame:
    """``_before``: the sum of ``amount`` over all rows that come before in ``order``.

    Rows are dealt out by ranges of ``order`` once and settled, so that a row keeps its range; each
    range is summed, and only these sums (one per range) are added up in one place.  ``order`` must
    settle every tie.  A column that is called ``_before`` already is replaced; any other stays.
    """
    taken = {c.lower() for c in df.columns}

    def free(name: str) -> str:
        while name in taken:
            name += "_"
        return name

    value, part, total, offset, inside = map(free, ("_amount", "_range", "_sum", "_offset", "_inside"))
    ranged = checkpointed(df.withColumn(value, amount).repartitionByRange(*order))
    placed = ranged.withColumn(part, F.spark_partition_id())
    sums = placed.groupBy(part).agg(F.sum(value).alias(total))
    earlier = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(part, F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(offset))
    within = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn(inside, F.coalesce(F.sum(value).over(within), F.lit(0)))
        .join(F.broadcast(offsets), part)
        .withColumn("_before", F.col(offset) + F.col(inside))
        .drop(part, inside, offset, value)
    )
