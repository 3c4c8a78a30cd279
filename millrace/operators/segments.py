"""Running values over ordered groups of any size: rows are dealt by ranges of group and order, each range is scanned by itself, and what is open at a
range's end is carried into the ranges that follow.

Carrying works on one row for each range and group, so a group may hold most of the rows without meeting in one task. Rows are stored once; order
decides between rows of a group, and should leave no ties.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..sources.scratch import stored

PART = "segment__part"


def dealt(rows: DataFrame, by: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """rows with PART, the number of their range; ranges: how many, else as many as there are shuffle partitions."""
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    spread = rows.repartitionByRange(ranges, *keys) if ranges else rows.repartitionByRange(*keys)
    return stored(spread.withColumn(PART, F.spark_partition_id()), "ranges")


def _within(by: list[str], order: list[str]) -> WindowSpec:
    return Window.partitionBy(PART, *by).orderBy(*order)


def _attach(rows: DataFrame, carried: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """rows with the columns names of carried, which has a row for each range and group that something is carried into."""
    keys = [PART, *by]
    own = carried.select(*[F.col(k).alias(f"segment__{i}") for i, k in enumerate(keys)], *names)
    meets = F.lit(True)
    for i, k in enumerate(keys):
        meets = meets & F.col(k).eqNullSafe(F.col(f"segment__{i}"))
    return rows.join(own, meets, "left").drop(*[f"segment__{i}" for i in range(len(keys))])


def streaks(rows: DataFrame, is_empty: Column, by: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """rows with streak: how many empty ones, this included, have followed each other in their group."""
    d = dealt(rows.withColumn("segment__empty", F.coalesce(is_empty, F.lit(False))), by, order, ranges)
    w = _within(by, order)
    marked = d.withColumn("segment__island", F.sum(F.when(F.col("segment__empty"), 0).otherwise(1)).over(w))
    inner = Window.partitionBy(PART, *by, "segment__island").orderBy(*order)
    own = F.when(F.col("segment__empty"), F.sum(F.col("segment__empty").cast("long")).over(inner)).otherwise(F.lit(0).cast("long"))
    local = marked.withColumn("streak", own)
    ends = local.groupBy(PART, *by).agg(F.max_by("streak", F.struct(*order)).alias("tail"), F.bool_and("segment__empty").alias("whole"))
    before = Window.partitionBy(*by).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = ends.withColumn("upto", F.coalesce(F.sum("tail").over(before), F.lit(0)))
    # What is open comes from the last range that isn't all empty, and from the ranges after it.
    since = F.max(F.when(~F.col("whole"), F.struct(PART, "upto"))).over(before)
    carry = sums.withColumn("segment__carry", F.col("upto") - F.coalesce(since["upto"], F.lit(0))).filter("segment__carry > 0")
    met = _attach(local, carry, by, ["segment__carry"])
    opened = F.col("segment__empty") & (F.col("segment__island") == 0)
    out = met.withColumn("streak", F.col("streak") + F.when(opened, F.coalesce("segment__carry", F.lit(0))).otherwise(0))
    return out.drop("segment__empty", "segment__island", "segment__carry", PART)


def before(rows: DataFrame, value: Column, by: list[str], order: list[str], name: str, ranges: int | None = None) -> DataFrame:
    """rows with name, a struct (value) of the row before in the group; null for the first of a group."""
    d = dealt(rows.withColumn("segment__value", F.struct(value.alias("value"))), by, order, ranges)
    local = d.withColumn(name, F.lag("segment__value").over(_within(by, order)))
    last = d.groupBy(PART, *by).agg(F.max_by("segment__value", F.struct(*order)).alias("segment__last"))
    carry = last.withColumn("segment__carry", F.lag("segment__last").over(Window.partitionBy(*by).orderBy(PART))).filter("segment__carry IS NOT NULL")
    met = _attach(local, carry, by, ["segment__carry"])
    return met.withColumn(name, F.coalesce(name, "segment__carry")).drop("segment__value", "segment__carry", PART)


def changed(rows: DataFrame, value: Column, by: list[str], order: list[str], ranges: int | None = None) -> DataFrame:
    """rows with changed: the value isn't that of the row before in the group, or there is none; nulls are alike."""
    held = before(rows.withColumn("segment__own", value), F.col("segment__own"), by, order, "segment__before", ranges)
    alike = F.col("segment__before").isNotNull() & F.col("segment__own").eqNullSafe(F.col("segment__before.value"))
    return held.withColumn("changed", ~alike).drop("segment__own", "segment__before")
