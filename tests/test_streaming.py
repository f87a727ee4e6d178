import json

import pytest
from pyspark.sql import functions as F

from gavelframe.operators import folds
from gavelframe.streaming import ingest
from tests.conftest import SF


def run(writer, tmp_path, name="cp"):
    return writer.option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()


def test_files_arrive_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for name, text in (("a.vtt", "one"), ("b.vtt", "two"), ("c.vtt", "one")):
        (tmp_path / "in" / name).write_text(text)
    out, store = str(tmp_path / "out"), ingest.DigestStore(spark, str(tmp_path / "seen"))

    def go():
        files = ingest.caption_files(spark, str(tmp_path / "in"))
        run(ingest.once_per_digest(files, lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}"), store), tmp_path).awaitTermination(60)
        return sorted(r.content for r in spark.read.parquet(out).collect())

    assert go() == ["one", "two"]
    (tmp_path / "in" / "d.vtt").write_text("three")
    (tmp_path / "in" / "e.vtt").write_text("two")
    assert go() == ["one", "three", "two"] and go() == ["one", "three", "two"]  # nothing comes twice, also after a restart
    assert store.seen().count() == 3


def test_a_failed_gate_stops_the_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.vtt").write_text("good")
    taken = []

    def go(bad):
        files = ingest.caption_files(spark, str(tmp_path / "in"))
        gate = lambda df: not df.where(F.col("content") == bad).count()
        return run(ingest.gated(files, gate, lambda df, _: taken.extend(r.content for r in df.collect())), tmp_path)

    go("bad").awaitTermination(60)
    (tmp_path / "in" / "b.vtt").write_text("bad")
    with pytest.raises(Exception, match="GateFailed"):
        go("bad").awaitTermination(60)
    assert taken == ["good"]
    go("none").awaitTermination(60)
    assert taken == ["good", "bad"]


def test_jobs_and_rejects(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"job": "x", "pages": 3}\n{"pages": 4}\nno json\n')
    done, gone = [], []
    jobs = ingest.job_requests(spark, str(tmp_path / "in"), "job string, pages int")
    run(ingest.submitted(jobs, lambda df, _: done.extend(map(tuple, df.collect())), lambda df, _: gone.extend(map(tuple, df.collect())), ["job"]), tmp_path).awaitTermination(60)
    assert done == [("x", 3)] and len(gone) == 2


def test_speakers_keep_their_state_between_batches(spark, tmp_path):
    said = ["x come to order", "let us pray", "please call the roll Smith Yes", "call the roll Smith", "Jones makes the motion", "state your name", "my name is Ann Lee", "thank you Ann"]
    want = [(1, i, r["phase"], r["role"], r["name"]) for i, r in enumerate(folds.speakers([{"text": x} for x in said]))]
    (tmp_path / "in").mkdir()
    out = str(tmp_path / "out")
    for part in range(4):
        (tmp_path / "in" / f"{part}.json").write_text("".join(json.dumps({"doc": 1, "i": i, "text": said[i]}) + "\n" for i in (2 * part + 1, 2 * part)))
        turns = spark.readStream.schema("doc long, i long, text string").json(str(tmp_path / "in"))
        run(ingest.speaker_stream(turns).writeStream.outputMode("append").foreachBatch(lambda df, n: df.write.mode("overwrite").parquet(f"{out}/batch={n}")), tmp_path).awaitTermination(90)
    got = sorted((r.doc, r.i, r.phase, r.role, r.name) for r in spark.read.parquet(out).collect())
    assert got == want


def test_utterances(spark):
    rows = [("a", 0.0, "one"), ("a", 1.0, "two"), ("a", 4.0, "three"), ("b", 0.0, "four")]
    cues = spark.createDataFrame(rows, "code string, t double, text string").select("code", F.timestamp_seconds("t").alias("at"), "text")
    assert sorted((r.code, r.text, r.cues) for r in ingest.utterances(cues).collect()) == [("a", "one two", 2), ("a", "three", 1), ("b", "four", 1)]


def test_event_windows(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    assert ingest.event_windows(events).agg(F.sum("n")).first()[0] == events.count()
    assert ingest.sessions(events).agg(F.sum("n")).first()[0] == events.count()
