"""Streams: new files as they land, idempotent and gated sinks, jobs, speakers with state, and windows over events."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.operators import folds


def caption_files(spark: SparkSession, path: str, max_files: int = 100) -> DataFrame:
    """(name, content, sha256) of files in a folder, each once."""
    files = spark.readStream.schema("value string").option("wholetext", True).option("maxFilesPerTrigger", max_files).text(path)
    return files.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("content"), F.sha2("value", 256).alias("sha256"))


class DigestStore:
    """Digests seen so far, in folders by their first two characters, so that a batch reads only the folders of its own digests."""

    def __init__(self, spark: SparkSession, path: str, digest: str = "sha256"):
        self.spark, self.path, self.digest = spark, path, digest

    def new(self, batch: DataFrame) -> DataFrame:
        """The batch's rows with digests that were not seen, one each."""
        rows = batch.dropDuplicates([self.digest])
        prefixes = [r[0] for r in rows.select(F.substring(self.digest, 1, 2)).distinct().collect()]  # at most 256
        seen = self.seen().where(F.col("p").isin(prefixes)).select(self.digest)
        return rows.join(seen, self.digest, "left_anti").select(*batch.columns)

    def seen(self) -> DataFrame:
        """Empty before the first write."""
        try:
            return self.spark.read.schema(f"{self.digest} string, p string").parquet(self.path)
        except AnalysisException:
            return self.spark.createDataFrame([], f"{self.digest} string, p string")

    def add(self, rows: DataFrame) -> None:
        rows.select(self.digest, F.substring(self.digest, 1, 2).alias("p")).write.partitionBy("p").mode("append").parquet(self.path)


def once_per_digest(stream: DataFrame, sink: Callable[[DataFrame, int], None], store: DigestStore):
    """A writer that hands each batch's rows to the sink unless their digest was seen. The digests are added after the sink has written,
    so a batch that runs again hands on the same rows: the sink must put them where it put them before (by the batch's number)."""

    def batch(df: DataFrame, number: int) -> None:
        fresh = store.new(df).persist()
        sink(fresh, number)
        store.add(fresh)
        fresh.unpersist()

    return stream.writeStream.foreachBatch(batch)


class GateFailed(RuntimeError):
    """A batch did not pass its gate; the stream stops in front of it."""


def gated(stream: DataFrame, gate: Callable[[DataFrame], bool], sink: Callable[[DataFrame, int], None]):
    """A writer that stops at the first batch that fails its gate. What the gate refuses is not committed, so a later start tries it again."""

    def batch(df: DataFrame, number: int) -> None:
        held = df.persist()
        ok = gate(held)
        if ok:
            sink(held, number)
        held.unpersist()
        if not ok:
            raise GateFailed(f"batch {number}")

    return stream.writeStream.foreachBatch(batch)


def job_requests(spark: SparkSession, path: str, schema: str, max_files: int = 4) -> DataFrame:
    """Jobs dropped as JSON files into a folder; rows that are no job of the schema have its columns null and go to the reject sink."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(path)


def submitted(jobs: DataFrame, run: Callable[[DataFrame, int], None], rejects: Callable[[DataFrame, int], None], required: list[str]):
    """A writer that runs each batch of whole jobs and hands the others to the reject sink."""
    whole = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in required])

    def batch(df: DataFrame, number: int) -> None:
        run(df.where(whole), number)
        rejects(df.where(~whole), number)

    return jobs.writeStream.foreachBatch(batch)


def speaker_stream(turns: DataFrame) -> DataFrame:
    """Phases and speakers of turns (doc, i, text) as they arrive: each meeting's phase and roster are kept as state between batches, and
    the turns of a batch are taken in order. Turns that come after a later one of their meeting was seen are judged where they arrive."""
    out = "doc long, i long, text string, phase string, role string, name string, confidence double"
    state = "main string, members array<string>, others array<string>"

    def judge(key, batches, held):
        rows = sorted((r for b in batches for r in b.to_dict("records")), key=lambda r: r["i"])
        main, members, others = held.get if held.exists else (folds.PHASES[0], [], [])
        roster = folds.Roster(members, others)
        said = list(folds.speakers(rows, main, roster))
        if said:
            held.update((said[-1]["main"], list(roster.members), list(roster.others)))
            yield pd.DataFrame(said)[["doc", "i", "text", "phase", "role", "name", "confidence"]]

    return turns.groupBy("doc").applyInPandasWithState(judge, out, state, "append", "NoTimeout")


def utterances(cues: DataFrame, silence: str = "1500 milliseconds", late: str = "10 seconds") -> DataFrame:
    """Cues (code, at, text) of a stream put together where no silence is between them, in order of time."""
    w = cues.withWatermark("at", late).groupBy("code", F.session_window("at", silence).alias("span"))
    said = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda c: c["text"]), " ")
    return w.agg(said.alias("text"), F.count("*").alias("cues"))


def event_windows(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums per window and kind. Extension: timestamps without zone are taken as UTC, as watermarks need a zone."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withWatermark("ts", late).groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Runs of a user's events without a silence of the gap."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return e.withWatermark("ts", late).groupBy("user_id", F.session_window("ts", gap).alias("session")).agg(F.count("*").alias("n"))
