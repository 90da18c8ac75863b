"""Running totals over an ordered column by distributed prefix sums.

One plan for every size. Rows are dealt once into ranges of (group, order) and written with the
number of their range. Totals per range and group, at most ranges + groups rows, give each range
its starting value; the starting row joins its range as the first row, and one window inside the
range adds up. A group may span all ranges and a range many groups, so neither one large group nor
very many small ones meet in a task. The cuts only steer the work: totals are exact for any cuts.
They are written, because a range sampled again may be cut a little differently.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgercast.session import stage_path
from ledgercast.sources.stages import staged

RANGE = "_range"


def in_ranges(df: DataFrame, group: str, order: str, name: str, ranges: int | None = None) -> DataFrame:
    """A staged copy with the number of each row's range; ``ranges`` defaults to the shuffle partitions."""
    spark = df.sparkSession
    count = ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.repartitionByRange(count, F.col(group), F.col(order))
    return staged(dealt.withColumn(RANGE, F.spark_partition_id()), stage_path(spark, name))


def running_totals(dealt: DataFrame, group: str, order: str, values: list[str]) -> DataFrame:
    """Add ``{v}_upto`` (this row included) and ``{v}_total`` for each value column.

    ``dealt`` comes from :func:`in_ranges` and holds one row per ``(group, order)``, so equal values
    are one row and no range can be flooded by repeats. Null groups and null orders are values like
    any other, the nulls first; a null value adds nothing.
    """
    everything = Window.partitionBy(group)
    earlier = everything.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    parts = dealt.groupBy(group, RANGE).agg(*[F.sum(v).alias(v) for v in values])
    totals = {f"{v}_total": F.coalesce(F.sum(v).over(everything), F.lit(0)) for v in values}
    starts = {v: F.coalesce(F.sum(v).over(earlier), F.lit(0)) for v in values}
    opening = parts.withColumns(totals | starts).withColumn("_row", F.lit(0))

    rows = dealt.withColumn("_row", F.lit(1)).unionByName(opening, allowMissingColumns=True)
    inside = Window.partitionBy(group, RANGE).orderBy("_row", order).rowsBetween(Window.unboundedPreceding, 0)
    sums = {f"{v}_upto": F.sum(v).over(inside) for v in values}
    known = {f"{v}_total": F.first(f"{v}_total").over(inside) for v in values}
    return rows.withColumns(sums | known).where("_row = 1").drop("_row", RANGE)
