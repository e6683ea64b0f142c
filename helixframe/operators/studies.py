"""Figures of performance studies, read from logs and report pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import percent_difference


def embedded_json(html: Column) -> Column:
    """The JSON that a report page carries in its first script element of that type."""
    return F.regexp_extract(html, r'(?s)<script[^>]*type="application/json"[^>]*>\s*(.*?)\s*</script>', 1)


def report_tasks(pages: DataFrame, schema: str = "array<struct<task:string,seconds:double>>") -> DataFrame:
    """page_id, task, seconds of pages (page_id, html)."""
    rows = pages.select("page_id", F.explode(F.from_json(embedded_json(F.col("html")), schema)).alias("t"))
    return rows.select("page_id", "t.*")


def averages_under_headers(lines: DataFrame, header: str, value: str, by: str = "file", order: str = "line_no") -> DataFrame:
    """name, n, mean: values of lines (by, order, line) averaged by the name that the last header line before them gives.

    header and value are patterns with one group; lines before the first header count under no name and are left out.
    """
    named = F.nullif(F.regexp_extract("line", header, 1), F.lit(""))
    before = Window.partitionBy(by).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = lines.withColumn("name", F.last(named, ignorenulls=True).over(before)).withColumn("v", F.regexp_extract("line", value, 1).try_cast("double"))
    return rows.where("name IS NOT NULL AND v IS NOT NULL").groupBy("name").agg(F.count("*").alias("n"), F.avg("v").alias("mean"))


def mean_difference(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """n and the mean percent difference of b's values to a's, over keys that both have."""
    both = a.select(key, F.col(value).alias("x")).join(b.select(key, F.col(value).alias("y")), key)
    return both.agg(F.count("*").alias("n"), F.avg(percent_difference(F.col("x"), F.col("y"))).alias("mean_percent"))


def advice(ratio: Column) -> Column:
    """What a ratio of times, new to old, suggests: within 5 % no matter, beyond 10 % clearly."""
    change = (ratio - 1) * 100
    return F.when(F.abs(change) <= 5, "either").when(change < -10, "new, clearly").when(change < 0, "new").when(change > 10, "old, clearly").otherwise("old")
