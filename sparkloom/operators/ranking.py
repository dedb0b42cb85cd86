"""Positions and cuts of a total order without a single-task sort.

``Window.orderBy`` without a partition, and an ordered limit of many rows, bring rows of every
partition into one task. Here rows are dealt into ranges of the order, numbered inside their
range and shifted by the sizes of the ranges before; the k-th largest number is found from
histograms of at most 256 bars.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def numbered(rows: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``rows`` with their position (from 1) in a total ``order``, as a long column ``name``."""
    from sparkloom.session import materialize

    dealt = materialize(rows.repartitionByRange(*order).withColumn("__range", F.spark_partition_id()))
    sizes = {r["__range"]: r["count"] for r in dealt.groupBy("__range").count().collect()}  # one row per partition
    ranges = sorted(sizes)
    before = dict(zip(ranges, accumulate([0] + [sizes[i] for i in ranges[:-1]])))
    shift = F.lit(0).cast("long")
    if ranges:
        shift = F.element_at(F.create_map(*(F.lit(x) for i in ranges for x in (i, before[i]))), F.col("__range"))
    place = F.row_number().over(Window.partitionBy("__range").orderBy(*order))
    return dealt.withColumn(name, (place + shift).cast("long")).drop("__range")


def kth_largest(rows: DataFrame, value: str, k: int) -> tuple[int, int] | None:
    """(the k-th largest of the positive longs in ``value``, how many are larger); None when
    there are fewer than ``k``. The search narrows from the number's length in bits to 256
    bars at a time, so a count of n bits takes 1 + n / 8 aggregations of ``rows``."""

    def pick(bars: dict[int, int], above: int) -> tuple[int, int] | None:
        for bar in sorted(bars, reverse=True):
            if above + bars[bar] >= k:
                return bar, above
            above += bars[bar]
        return None

    def histogram(of: Column, within: DataFrame) -> dict[int, int]:
        return {r["bar"]: r["count"] for r in within.groupBy(of.alias("bar")).count().collect()}

    found = pick(histogram(F.length(F.bin(F.col(value))), rows), 0)
    if found is None:
        return None
    low, above = 1 << (found[0] - 1), found[1]
    width = low
    while width > 1:
        step = max(1, width // 256)
        inside = rows.filter((F.col(value) >= low) & (F.col(value) <= low + (width - 1)))
        bar, above = pick(histogram(F.call_function("div", F.col(value) - F.lit(low), F.lit(step)), inside), above)
        low, width = low + bar * step, step
    return low, above
