"""Caption files as rows: one row per payload line, with the start time of its cue."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TIME = r"(?:(\d{1,2}):)?(\d{2}):(\d{2}\.\d{3})"


def read(spark: SparkSession, path: str) -> DataFrame:
    """(code, content): whole files, the code being the file's name without its ending."""
    files = spark.read.text(path, wholetext=True).select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("name"), F.col("value").alias("content"))
    return files.select(F.regexp_replace("name", r"\.[^.]*$", "").alias("code"), "content")


def unescape(x: Column) -> Column:
    """The entities that captions use."""
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        x = F.replace(x, F.lit(a), F.lit(b))
    return x


def plain(x: Column) -> Column:
    """A line without its time and style tags, with entities resolved."""
    return unescape(F.trim(F.regexp_replace(x, "<[^>]+>", "")))


def payload(files: DataFrame) -> DataFrame:
    """(code, n, line): the lines that are no header, no time and not empty, without tags, numbered from 1."""
    lines = files.select("code", F.posexplode(F.split("content", r"\r?\n")).alias("pos", "raw")).where(~F.col("raw").contains("-->") & ~F.col("raw").rlike("^(WEBVTT|Kind:|Language:)"))
    text = lines.withColumn("line", F.trim(F.regexp_replace("raw", "<[^>]+>", ""))).where("line <> ''")
    return text.select("code", F.row_number().over(Window.partitionBy("code").orderBy("pos")).cast("long").alias("n"), "line")


def cues(files: DataFrame) -> DataFrame:
    """(code, cue_idx, ts, text). A line with --> sets the clock; each later line that is no header and not empty is a row."""
    lines = files.select("code", F.posexplode(F.split("content", r"\r?\n")).alias("pos", "raw")).withColumn("line", unescape(F.col("raw")))
    is_time = F.col("line").contains("-->")
    part = lambda i: F.nullif(F.regexp_extract("line", TIME, i), F.lit("")).cast("double")
    stamp = F.when(is_time & F.col("line").rlike(TIME), F.coalesce(part(1), F.lit(0.0)) * 3600 + part(2) * 60 + part(3))
    w = Window.partitionBy("code").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    timed = lines.withColumn("ts", F.last(stamp, ignorenulls=True).over(w)).where(~is_time & F.col("ts").isNotNull() & ~F.col("raw").rlike("^(WEBVTT|Kind:|Language:)"))
    text = timed.withColumn("text", F.trim(F.regexp_replace("line", "<[^>]+>", ""))).where("text <> ''")
    return text.select("code", (F.row_number().over(Window.partitionBy("code").orderBy("pos")) - 1).alias("cue_idx"), "ts", "text")


def valid(files: DataFrame) -> DataFrame:
    """(code, has_payload): at least one timing line and one payload line."""
    lines = files.select("code", F.explode_outer(F.split("content", r"\r?\n")).alias("line"))
    time = F.col("line").contains("-->")
    payload = ~time & (F.trim("line") != "") & ~F.col("line").rlike("^(WEBVTT|Kind:|Language:)")
    return lines.groupBy("code").agg((F.coalesce(F.bool_or(time), F.lit(False)) & F.coalesce(F.bool_or(payload), F.lit(False))).alias("has_payload"))


def sentence_parts(cue_rows: DataFrame, gap: float = 1.5) -> DataFrame:
    """A full stop behind a cue that a silence of more than `gap` seconds follows and that has no end mark."""
    w = Window.partitionBy("code").orderBy("cue_idx")
    pause = F.coalesce(F.lead("ts").over(w) - F.col("ts") > gap, F.lit(False))
    return cue_rows.withColumn("text", F.when(pause & ~F.col("text").rlike(r"[.!?]$"), F.concat("text", F.lit("."))).otherwise(F.col("text")))
