"""Ranks and first rows in the order of a key, without putting all rows into one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import written


def numbered(rows: DataFrame, *keys: str, name: str = "rank", ranges: int | None = None) -> DataFrame:
    """rows with their place, from 0, in the order of keys; rows with equal keys are ordered among themselves by a hash.

    One sort by ranges, written once: each row gets its number within its range while it is written. The sizes of the ranges before
    it are a running sum over a row per range. ranges: how many; the session's shuffle partitions where none is given. Rows of one
    frequent key lie in several ranges, and so do equal rows.
    """
    cut = [*keys, "_tie", "_any"]
    tied = rows.withColumns({"_tie": F.xxhash64(*rows.columns), "_any": F.rand(17)})
    spread = tied.repartitionByRange(*cut) if ranges is None else tied.repartitionByRange(ranges, *cut)
    # the id holds the partition above 33 bits and the row's number in it below
    placed = spread.sortWithinPartitions(*cut).withColumn("_at", F.monotonically_increasing_id()).drop("_tie", "_any")
    table = written(placed.withColumns({"_range": F.shiftright("_at", 33), "_within": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_at"), "numbered")
    sizes = table.groupBy("_range").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return table.join(sizes, "_range").withColumn(name, F.col("_before") + F.col("_within")).drop("_range", "_within", "_before")


def positions(rows: DataFrame, group: str, *order: str) -> DataFrame:
    """group, the order columns and position (from 1) of each row within its group."""
    sorted_ = rows.groupBy(group).agg(F.array_sort(F.collect_list(F.struct(*order))).alias("_a"))
    return sorted_.select(group, F.posexplode("_a").alias("_p", "_e")).select(group, *(F.col(f"_e.{c}").alias(c) for c in order), (F.col("_p") + 1).cast("long").alias("position"))


def first_keys(rows: DataFrame, key: str, n: int | None) -> DataFrame:
    """Rows of the n smallest keys; all rows where n is None."""
    return rows if n is None else rows.join(rows.select(key).distinct().orderBy(key).limit(n), key, "left_semi")


def longest(rows: DataFrame, items: str, key: str, n: int | None = None) -> DataFrame:
    """Rows by the number of their items, most first, then by key; the first n."""
    ordered = rows.orderBy(F.size(items).desc(), key)
    return ordered if n is None else ordered.limit(n)


def by_number(rows: DataFrame, column: str, *then: str) -> DataFrame:
    """Rows in the order of a column's whole number, such as a count of cores that was read as text; what is no number comes last."""
    return rows.orderBy(F.col(column).cast("string").try_cast("long").asc_nulls_last(), *then)
