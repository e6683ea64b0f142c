"""The index report: statistics as JSON inside one HTML page."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import batch_of_path, dataset_identity
from ..operators.catalog import index_stats
from ..operators.ordering import numbered
from ..sources import readers

_PAGE = """<!doctype html><meta charset="utf-8"><title>{title}</title><h1>{title}</h1><input id="f" placeholder="filter by dataset"><table id="t"></table>
<script type="application/json" id="d">{data}</script>
<script>const d=JSON.parse(document.getElementById("d").textContent),t=document.getElementById("t"),f=document.getElementById("f");
const draw=()=>{{t.replaceChildren();for(const r of d.filter(r=>!f.value||(r.slug||"").includes(f.value))){{const e=t.insertRow();for(const k of ["level","index_type","slug","batch","files","proteins"])e.insertCell().textContent=r[k]??""}}}};f.oninput=draw;draw()</script>"""


def index_report(index: DataFrame, title: str = "Index report") -> str:
    """The page for an index (index_type, slug, batch, path, protein_id). It holds aggregates: a row per type, dataset and batch."""
    rows = [r.asDict() for r in index_stats(index).orderBy("level", "index_type", "slug", "batch").collect()]
    return _PAGE.format(title=title, data=json.dumps(rows).replace("</", "<\\/"))


def write_report(index: DataFrame, path: str, title: str = "Index report", each: int = 5000) -> None:
    """The same as pages of `each` rows in a folder, `page=0` and so on, each with a link to the next; no row of them passes through the driver."""
    ordered = numbered(index_stats(index), "level", "index_type", "slug", "batch", name="place").withColumn("page", F.floor(F.col("place") / each))
    last = F.max("page").over(Window.partitionBy())
    data = F.to_json(F.transform(F.array_sort(F.collect_list(F.struct("place", "level", "index_type", "slug", "batch", "files", "proteins"))), lambda r: r.dropFields("place")), {"ignoreNullFields": "false"})
    pages = ordered.groupBy("page").agg(data.alias("data")).withColumn("last", last)
    head, tail = _PAGE.format(title=title, data="\0").split("\0")
    link = F.when(F.col("page") < F.col("last"), F.concat(F.lit('<a href="../page='), (F.col("page") + 1).cast("string"), F.lit('">next</a>'))).otherwise("")
    html = F.concat(F.lit(head), F.replace("data", F.lit("</"), F.lit("<\\/")), F.lit(tail), link)
    pages.select("page", html.alias("value")).write.mode("overwrite").partitionBy("page").text(path)


def described_index(entries: DataFrame) -> DataFrame:
    """index_type, slug, batch, path, protein_id of index entries (index_type, path, protein_id), told by their paths."""
    own = F.regexp_extract("path", r"/dataset_id=[^/]*-([^-/]*)/batch=\d+$", 1)
    slug = F.coalesce(dataset_identity(F.col("path"))["slug"], F.nullif(own, F.lit("")))
    batch = F.coalesce(batch_of_path(F.col("path"), F.col("index_type")), F.nullif(F.regexp_extract("path", r"/batch=(\d+)$", 1), F.lit("")))
    slug = F.when(F.col("path").contains("/dataset_id="), F.nullif(own, F.lit(""))).otherwise(slug)
    return entries.select("index_type", slug.alias("slug"), batch.alias("batch"), "path", "protein_id")


# The kinds of index files in a dataset's folder.
INDEX_FILES = ("embeddings", "coordinates", "sequences", "distograms", "dataset")


def discovered_index(spark: SparkSession, folder: str) -> DataFrame:
    """The same from the JSON index files (`<type>.idx`) that lie in a dataset's folder; reversed ones are left out."""
    text = spark.read.option("pathGlobFilter", "*.idx").text(folder, wholetext=True)
    kind = F.regexp_extract("_metadata.file_name", r"^(\w+)\.idx$", 1)
    rows = text.select(kind.alias("index_type"), F.col("value").alias("json")).where(F.col("index_type").isin(*INDEX_FILES))
    return described_index(readers.index_items(rows, keep="index_type"))
