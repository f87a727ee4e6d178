"""Language identification by rank-order n-gram profiles (Cavnar and Trenkle, 1994).

A text's words are its runs of letters, lower-cased one by one, with a boundary sign before and behind; accents and scripts stay as
they are. Its 1- to 5-grams within words, most frequent first, are compared with each language's by the sum of the distances of the
ranks (out-of-place distance; a missing n-gram costs the profile's length). N-grams are named by 63-bit hashes.

Null texts and texts without letters get `und` and score 0. Ties between n-grams go to the lower hash, ties between languages to the
lower name. Repeated rows are judged alike. Without any labelled row every text gets `und`. Empty tables give empty results. Columns
of the names put out are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.llm._store import small_batches
from gavelframe.llm._text import U64, codepoints, mix, pieces

LONGEST = 5
MULTIPLIER = 0x9E3779B97F4A7C15
COUNTED = 500_000  # distinct n-grams of texts that a map task holds before it counts them together
SENT = 1 << 15  # rows of a batch that a map task sends
STRETCH = 1 << 20  # characters of one text that are counted at once
_TABLE: np.ndarray | None = None


def letters() -> np.ndarray:
    """The lower-case letter of each code point, 0 for what is no letter."""
    global _TABLE
    if _TABLE is None:
        t = np.zeros(0x32000, np.uint32)  # the planes above hold no letters
        for c in range(len(t)):
            s = chr(c)
            if s.isalpha():
                t[c] = ord(s.lower()[0])
        _TABLE = t
    return _TABLE


def ngram_counts(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct n-grams' hashes, in order, and how often each occurs; long texts are counted STRETCH characters at a time."""
    cps, off = codepoints(column)
    table = letters()
    c = np.zeros(len(cps), np.uint32)
    for p in range(0, len(cps), STRETCH):
        part = cps[p : p + STRETCH]
        c[p : p + STRETCH] = np.where(part < len(table), table[np.minimum(part, len(table) - 1)], 0)
    if len(off) > 2 or len(c) <= STRETCH:
        for codes in _codes(c, off):
            yield counted(codes)
        return
    have, times, p = np.zeros(0, U64), np.zeros(0, np.int64), 0
    while p < len(c):  # cut where no word is
        end = min(len(c), p + STRETCH)
        gaps = np.flatnonzero(c[p:end] == 0) if end < len(c) else np.zeros(0, np.int64)
        end = p + int(gaps[-1]) + 1 if len(gaps) else end if end == len(c) else end + int(np.argmax(np.append(c[end:], 0) == 0))
        (codes,) = _codes(c[p:end], np.array([0, end - p]))
        more, n = counted(codes)
        have, times = counted(np.concatenate([have, more]), np.concatenate([times, n]))
        p = end
    yield have, times


def _codes(letters_: np.ndarray, off: np.ndarray) -> Iterator[np.ndarray]:
    """The hashes of each text's n-grams within words, repeats included, from its letters."""
    c = letters_.astype(U64)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(off))
    # a boundary stands before each text and in place of each run of other characters
    c, owner = np.insert(c, off[:-1], 0), np.insert(owner, off[:-1], np.arange(len(off) - 1))
    keep = c > 0
    keep[1:] |= c[:-1] > 0
    if len(keep):
        keep[0] = True
    c, owner = np.append(c[keep], U64(0)), np.append(owner[keep], len(off) - 1)
    has = c > 0
    parts, cuts = [], []
    c = c + U64(1)  # a boundary in front must count
    h, inner = c, None
    for n in range(1, LONGEST + 1):
        if n == 1:
            ok = has
        else:
            h = h[:-1] * U64(MULTIPLIER) + c[n - 1 :]
            inner = np.ones(len(h), bool) if n == 2 else inner[:-1] & has[n - 2 : len(has) - 1]
            ok = inner & (has[: len(h)] | has[1 : len(h) + 1])
        at = np.flatnonzero(ok)
        parts.append(mix(h[at] + U64(n)) >> U64(1))  # as positive long integers
        own = owner[np.minimum(at + ~has[at], len(owner) - 1)]  # of the n-gram's first letter
        cuts.append(np.searchsorted(own, np.arange(len(off))))
    for i in range(len(off) - 1):
        yield np.concatenate([p[k[i] : k[i + 1]] for p, k in zip(parts, cuts, strict=True)])


def counted(codes: np.ndarray, times: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(distinct codes in order, how often each occurs)."""
    if times is None:
        codes = np.sort(codes)
    else:
        order = np.argsort(codes)
        codes, times = codes[order], times[order]
    at = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    return codes[at], np.diff(np.append(at, len(codes))) if times is None else np.add.reduceat(times, at) if len(at) else times


def ranked(have: np.ndarray, times: np.ndarray, length: int) -> np.ndarray:
    """The most frequent codes, ties by code."""
    if len(have) > length:
        least = np.partition(times, len(times) - length)[-length]
        more, same = np.flatnonzero(times > least), np.flatnonzero(times == least)
        keep = np.sort(np.concatenate([more, same[: length - len(more)]]))
        have, times = have[keep], times[keep]
    return have[np.argsort(-times, kind="stable")]


def fit_profiles(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id", max_docs: int = 2000, length: int = 500) -> dict[str, list[int]]:
    """Profiles {language: n-gram codes by rank} from rows with a language and a text.

    Fits on a sample of about max_docs rows of each language, chosen by a hash of the id; their whole texts are counted in Spark.
    What reaches the driver are at most `length` numbers a language.
    """
    rows = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.abs(F.xxhash64(F.col(doc_id).cast("string")) % 1_000_003).alias("u"))
    share = F.broadcast(rows.groupBy("lang").agg((F.lit(max_docs) / F.count("*")).alias("share")))
    sample = rows.join(share, "lang").where(F.col("u") < F.col("share") * 1_000_003).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        n = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for name, parts in held.items():
                have, times = counted(*(np.concatenate([p[i] for p in parts]) for i in (0, 1)))
                for i in range(0, len(have), SENT):  # small batches, as both sides hold one whole
                    code = have[i : i + SENT].view(np.int64)
                    yield pa.RecordBatch.from_pydict({"lang": pa.repeat(pa.scalar(name, pa.string()), len(code)), "code": code, "n": times[i : i + SENT]})

        for b in pieces(batches, "text"):
            for name, counts in zip(b["lang"].to_pylist(), ngram_counts(b["text"]), strict=True):
                held.setdefault(name, []).append(counts)
                n += len(counts[0])
            if n >= COUNTED:
                yield from flush()
                held, n = {}, 0
        yield from flush()

    sums = sample.mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    out: dict[str, list[int]] = {}
    for r in sums.withColumn("r", rank).where(F.col("r") <= length).orderBy("lang", "r").collect():
        out.setdefault(r["lang"], []).append(r["code"])
    return out


def predict(docs: DataFrame, profiles: dict[str, list[int]], text: str = "text", length: int = 500, names_out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The rows with lang_pred and score, or names_out: one less the best profile's share of the greatest possible distance."""
    small_batches(docs.sparkSession)
    names = sorted(profiles)
    known = np.array(sorted({c for p in profiles.values() for c in p}), np.int64)
    rank = np.full((len(names), len(known) + 1), -1, np.int32)  # the last column: n-grams of no profile
    for i, n in enumerate(names):
        rank[i, np.searchsorted(known, np.array(profiles[n], np.int64))] = np.arange(len(profiles[n]))
    kept = [c for c in docs.columns if c not in names_out]
    docs = docs.select(*kept)
    table = docs.sparkSession.sparkContext.broadcast((known, rank))  # 12 bytes for each n-gram of a profile, and 4 for each other language
    schema = T.StructType([*docs.schema.fields, T.StructField(names_out[0], T.StringType()), T.StructField(names_out[1], T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, ranks = table.value
        for b in pieces(batches, text):
            pred, score = [], []
            for have, times in ngram_counts(b[text]):
                top = ranked(have, times, length).view(np.int64)
                if not len(top) or not names:
                    pred.append("und")
                    score.append(0.0)
                    continue
                at = np.minimum(np.searchsorted(known, top), max(len(known) - 1, 0))
                theirs = ranks[:, np.where(known[at] == top, at, len(known))]
                far = np.where(theirs < 0, length, np.minimum(np.abs(theirs - np.arange(len(top))), length)).sum(axis=1)
                best = int(far.argmin())
                pred.append(names[best])
                score.append(1.0 - float(far[best]) / (length * len(top)))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())], names=[*b.schema.names, *names_out])

    return docs.mapInArrow(run, schema)


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    profiles = fit_profiles(docs.where(~held))
    return predict(docs.select("doc_id", held.alias("held_out"), "text"), profiles).drop("text")


QUERIES = {"op1_language_id": op1_language_id}
SQL: dict[str, str] = {}
