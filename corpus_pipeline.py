"""From raw documents to tokens: five stages of the llm subpackage, each over all that the one before kept.

language ID       rows without any letter go, all others stay; the predicted language takes the place of a missing one
Jaccard join      of each group that links of similarity >= 0.8 on five-word shingles connect, the row with the smallest id stays
suffix arrays     bytes of passages of 200 bytes and more that also start elsewhere go, by whole characters; an emptied text stays empty
source mix        sources are drawn to target weights; a document drawn k times has k rows
SentencePiece     token counts, a digest of the tokens and whether they decode to the text

Empty tables pass through. Null ids count as the largest. Further columns of documents pass through up to the last stage; a table
needs doc_id, text, lang and source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.llm.jaccard_join import Threshold, keep_one
from gavelframe.llm.langid import fit_profiles, predict
from gavelframe.llm.mixing import mix
from gavelframe.llm.sentencepiece_bpe import encode
from gavelframe.llm.suffix_dedup import remove_repeats


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    judged = predict(docs, fit_profiles(docs), names_out=("__pred", "__score"))
    # without any labelled row nothing is predicted, but texts with letters stay
    kept = judged.where((F.col("__pred") != "und") | F.col("text").rlike(r"\p{L}"))
    return kept.withColumn("lang", F.coalesce("lang", F.nullif("__pred", F.lit("und")))).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs, threshold=Threshold(80, 100, 5))


def repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    kept = remove_repeats(docs, as_text=True, tag="__")
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs, places=False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    coded = encode(docs, digest=True)
    return coded.select(*[c for c in ("doc_id", "lang", "source", "n_chars", "n_tokens", "ids_sha256", "round_trip") if c in coded.columns])


STAGES = [("language_id", language), ("jaccard_join", near_duplicates), ("suffix_dedup", repeats), ("source_mix", source_mix), ("sentencepiece", tokens)]

#: The model-based stages and the byte-level ones have no SQL form; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    from gavelframe.llm._store import Folder

    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES[:-1]:
        folder = Folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(f"{folder.uri}/rows.parquet")
        docs = spark.read.parquet(f"{folder.uri}/rows.parquet")
        if before:
            before.remove()  # nothing reads it any more
        before = folder
    return STAGES[-1][1](spark, docs, sf_dir)
