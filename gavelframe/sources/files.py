"""Folders of records: whole text files, listings, and packages of pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def packet_texts(spark: SparkSession, root: str) -> DataFrame:
    """(code, path, text): each packet folder's text of its own name, `root/<code>/<code>.txt`; other files are left out."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.txt").text(root, wholetext=True)
    named = files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))
    parts = F.split("path", "/")
    folder, name = F.element_at(parts, -2), F.element_at(parts, -1)
    return named.select(F.url_decode(folder).alias("code"), "path", "text", name.alias("name")).where(F.col("name") == F.concat(F.element_at(F.split("path", "/"), -2), F.lit(".txt"))).drop("name")


def listing(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path, created, pulled, n_bytes, document): files below a folder whose names match the expression (groups: document, created and
    pulled as yyyyMMdd), by these and the path. Contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", F.col("length").alias("n_bytes"))
    part = lambda i: F.regexp_extract("path", name, i)
    typed = files.where(F.col("path").rlike(name)).select("path", F.try_to_date(part(2), "yyyyMMdd").alias("created"), F.try_to_date(part(3), "yyyyMMdd").alias("pulled"), "n_bytes", part(1).alias("document"))
    return typed.orderBy("created", "pulled", "path")


def write_package(pages: DataFrame, words: DataFrame, lines: DataFrame, run: DataFrame, root: str) -> None:
    """A run's package: pages with their words and lines nested, flat pages, words and lines, and the run's row, as JSON lines. Spark's
    commit protocol leaves each folder whole; _SUCCESS in the run's folder, which is written last, marks the package."""
    nested = words.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.col("reading_order"), *[c for c in words.columns if c not in ("page_id", "reading_order")]))).alias("words"))
    page_lines = lines.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct(F.col("reading_order"), *[c for c in lines.columns if c not in ("page_id", "reading_order")]))).alias("lines"))
    whole = pages.join(nested, "page_id", "left").join(page_lines, "page_id", "left")
    whole.write.mode("overwrite").json(f"{root}/pages_nested")
    for name, df in (("pages", pages), ("words", words), ("lines", lines)):
        df.write.mode("overwrite").json(f"{root}/{name}")
    run.coalesce(1).write.mode("overwrite").json(f"{root}/run")


def append_log(rows: DataFrame, path: str, metrics: dict[str, float]) -> None:
    """Appends log rows as JSON lines, each with the host's metrics and the time of writing."""
    stamped = rows.withColumn("logged_at", F.current_timestamp()).withColumn("host", F.struct(*[F.lit(float(v)).alias(k) for k, v in sorted(metrics.items())]))
    stamped.write.mode("append").json(path)
