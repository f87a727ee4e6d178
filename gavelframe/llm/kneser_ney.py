"""Interpolated modified Kneser-Ney n-gram model: counted in Spark, kept as sorted hash arrays, mapped into memory by the scorers.

Tokens are the A-Z-lower-cased words `[^\\x20\\x09-\\x0D]+` and one end per text; before a text stand order - 1 begins. Map tasks
count their n-grams before anything is shuffled; shards are ranges of the n-gram's mixed key, so a frequent word's n-grams lie in all
shards. Each order's reducers write its counts sorted by key to the shared folder and pass on what the order below needs: for each
gram how many different tokens stand before it, and as a context its discount sums.

Words are counted by their 64-bit hashes, on which n_known, train_tokens and base_score rest; n-grams name their tokens by 40 bits
of these, so that fewer bytes are shuffled (of 20 million words some 360 then share their n-gram counts with another).

Null and empty texts consist of one end. Words never seen get the uniform share of the lowest order. With no training text all
tokens have probability 1 / (V + 1) = 1. Repeated rows count and score as often as they occur. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.llm._text import U64, from_planes, low_planes, mix, pieces, words
from gavelframe.llm._store import Folder, lookup, runs, shard_bits, shard_of, shuffles_end

WIDTH = 5  # bytes of a token's name in an n-gram
BEGIN, END = U64(1), U64(2)
FLUSH = 2_000_000  # tokens that a map task holds before it counts and sends them
SUMS = ("count", "after", "types", "a1", "a2")  # distinct tokens before; as a context: tokens behind, different ones, of these seen once, twice
KEPT = ("count", "after", "a1", "a2", "a3")


def tokens(column: pa.Array, order: int = 2) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """(names of the tokens order - 1 to 0 before each token, an end per text; 64-bit hashes of the tokens; offsets)."""
    h, off = words(column)
    full = np.insert(h, off[1:], END) if len(off) > 1 else h
    tok = np.insert((h >> U64(24)) | U64(4), off[1:], END) if len(off) > 1 else h  # the two marks stay free
    off = off + np.arange(len(off))
    cols = [tok]
    for _ in range(order - 1):
        before = np.empty_like(tok)
        before[1:] = cols[0][:-1]
        before[off[:-1]] = BEGIN
        cols.insert(0, before)
    return cols, full, off


def gram_key(cols: list[np.ndarray]) -> np.ndarray:
    if len(cols) == 1:
        return cols[0] << U64(24)
    key = cols[0]
    for c in cols[1:]:
        key = mix(key * U64(0xD6E8FEB86659FD93) + c)
    return key


def _blobs(bits: int, key: np.ndarray, columns: dict[str, tuple[np.ndarray, int]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row a shard; the columns {name: (values, bytes of each)} are sorted by key, those of the other names empty."""
    cut = np.searchsorted(shard_of(key, bits), np.arange((1 << bits) + 1))
    have = np.flatnonzero(np.diff(cut))
    blob = lambda n: [low_planes(columns[n][0][cut[s] : cut[s + 1]], columns[n][1]) if n in columns else b"" for s in have]
    yield pa.RecordBatch.from_pydict({"shard": pa.array(have, pa.int32())} | {n: pa.array(blob(n), pa.binary()) for n in names})


def _by_shard(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
    """(shard, the columns of all its rows) from rows sorted by shard."""
    shard, held = None, {n: [] for n in names}
    for b in batches:
        for i, s in enumerate(b["shard"].to_pylist()):
            if s != shard and shard is not None:
                yield shard, {n: np.concatenate(x) for n, x in held.items()}
                held = {n: [] for n in names}
            shard = s
            for n, x in held.items():
                x.append(from_planes(b[n][i].as_py(), WIDTH if n[0] == "t" and n[1:].isdigit() else 8))
    if shard is not None:
        yield shard, {n: np.concatenate(x) for n, x in held.items()}


def _ranges(df: DataFrame) -> DataFrame:
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(parts, "shard").sortWithinPartitions("shard")


@dataclass
class Model:
    """Names the folder and holds the few constants; the counts stay in files."""

    folder: Folder
    bits: int
    order: int
    n_tokens: int
    n_words: int
    n_types: int  # distinct pairs of a word and the one before
    discounts: list[tuple[float, float, float]]  # of the orders from 1
    rest: float  # what the lowest order's discounts leave for the uniform distribution


def discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of types seen 1 to 4 times (Chen and Goodman, 1998); 0.5, 1, 1.5 where they are undefined."""
    if min(n) <= 0:
        return 0.5, 1.0, 1.5
    y = n[0] / (n[0] + 2 * n[1])
    return tuple(min(max(i + 1 - (i + 2) * y * n[i + 1] / n[i], 0.05), i + 0.95) for i in range(3))


def _sum_grams(cols: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """(keys in order, tokens, sums) of the distinct grams."""
    key = gram_key(cols)
    order = np.argsort(key, kind="stable")
    key = key[order]
    at = runs(key)[:-1]
    return key[at], [c[order][at] for c in cols], [np.add.reduceat(x[order].astype(np.int64), at) if len(at) else x for x in sums]


def _seen(times: np.ndarray) -> np.ndarray:
    """Numbers of types seen 1 to 4 times."""
    return np.bincount(np.minimum(times, 5), minlength=6)[1:5]


def fit(docs: DataFrame, text: str = "text", order: int = 2) -> Model:
    """Counts the texts. order: the longest n-gram, 2 or more; each order more is one more shuffle, of its distinct n-grams."""
    spark = docs.sparkSession
    folder, bits = Folder(spark, "kneser-ney"), shard_bits(spark)
    names = lambda m: [f"t{i}" for i in range(m)]
    top = [*names(order), "times", "word", "n"]
    stats = 4 * order + 3  # numbers of types seen 1 to 4 times by order; tokens, words, pairs

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            cols = [np.concatenate([x[0][i] for x in held]) for i in range(order)]
            key, at, times = np.unique(gram_key(cols), return_index=True, return_counts=True)
            yield from _blobs(bits, key, {c: (x[at], WIDTH) for c, x in zip(names(order), cols, strict=True)} | {"times": (times, 8)}, top)
            word, times = np.unique(np.concatenate([x[1] for x in held]), return_counts=True)
            yield from _blobs(bits, word, {"word": (word, 8), "n": (times, 8)}, top)

        for b in pieces(batches, text):
            cols, full, _ = tokens(b[text], order)
            held.append((cols, full))
            n += len(full)
            if n >= FLUSH:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    def passed_on(m: int, held: list, facts: np.ndarray) -> Iterator[pa.RecordBatch]:
        """What the grams of order m, (tokens, counts) each, tell those of order m - 1; and the facts so far."""
        down = [*names(m - 1), *SUMS, "facts"]
        if held:
            _, cols, sums = _sum_grams([np.concatenate([x[0][i] for x in held]) for i in range(m - 1)], [np.concatenate([x[1][i] for x in held]) for i in range(len(SUMS))])
            yield from _blobs(bits, gram_key(cols), {c: (x, WIDTH) for c, x in zip(names(m - 1), cols, strict=True)} | {c: (x, 8) for c, x in zip(SUMS, sums, strict=True)}, down)
        yield pa.RecordBatch.from_pydict({"shard": pa.array([-1], pa.int32())} | {c: pa.array([b"" if c != "facts" else low_planes(facts, 8)], pa.binary()) for c in down})

    def lower(cols: list[np.ndarray], times: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """The grams without their first token (which counts one token before them) and without their last (contexts), summed."""
        one, none = np.ones(len(times), np.int64), np.zeros(len(times), np.int64)
        both = [np.concatenate([a, b]) for a, b in zip(cols[1:], cols[:-1], strict=True)]
        return _sum_grams(both, [np.concatenate(x) for x in ((one, none), (none, times), (none, one), (none, times == 1), (none, times == 2))])[1:]

    def reduce_top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, facts = [], np.zeros(stats, np.int64)
        for shard, x in _by_shard(batches, top):
            word, _, (n,) = _sum_words(x["word"], x["n"])
            folder.save(f"word-{shard}", word)
            folder.save(f"n-{shard}", n)
            key, cols, (times,) = _sum_grams([x[c] for c in names(order)], [x["times"]])
            folder.save(f"key{order}-{shard}", key)
            folder.save(f"count{order}-{shard}", times)
            facts[4 * order - 4 : 4 * order] += _seen(times)
            facts[-3:-1] += int(n.sum()), len(word)
            held.append(lower(cols, times))
        yield from passed_on(order, held, facts)

    def reduce(m: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, facts = [], np.zeros(stats, np.int64)
            for shard, x in _by_shard(batches, [*names(m), *SUMS, "facts"]):
                if shard < 0:
                    facts += x["facts"].astype(np.int64).reshape(-1, stats).sum(axis=0)
                    continue
                key, cols, (times, after, types, a1, a2) = _sum_grams([x[c] for c in names(m)], [x[c].astype(np.int64) for c in SUMS])
                folder.save(f"key{m}-{shard}", key)
                for name, v in zip(KEPT, (times, after, a1, a2, types - a1 - a2), strict=True):
                    folder.save(f"{name}{m}-{shard}", v)
                facts[4 * m - 4 : 4 * m] += _seen(times)
                if m == 1:
                    facts[-1] += times.sum()
                else:
                    real = np.flatnonzero(times)  # a gram of begins alone is a context only
                    held.append(lower([c[real] for c in cols], times[real]))
            if m > 1:
                yield from passed_on(m, held, facts)
            else:
                yield pa.RecordBatch.from_pydict({"x": pa.array([facts.tolist()], pa.list_(pa.int64()))})

        return run

    binary = lambda cols: "shard int, " + ", ".join(f"{n} binary" for n in cols)
    rows = _ranges(docs.select(text).mapInArrow(count, binary(top))).mapInArrow(reduce_top, binary([*names(order - 1), *SUMS, "facts"]))
    for m in range(order - 1, 0, -1):
        rows = _ranges(rows).mapInArrow(reduce(m), binary([*names(m - 1), *SUMS, "facts"]) if m > 1 else "x array<long>")
    found = rows.select(*[F.col("x")[i].alias(f"x{i}") for i in range(stats)]).agg(*[F.sum(f"x{i}").alias(f"x{i}") for i in range(stats)]).first()
    x = [v or 0 for v in found]
    folder.seal()
    cuts = [discounts(x[4 * m : 4 * m + 4]) for m in range(order)]
    n_tokens, n_words, n_types = x[-3:]
    low = cuts[0]
    rest = (low[0] * x[0] + low[1] * x[1] + low[2] * (n_words - x[0] - x[1])) / n_types if n_types else 1.0
    return Model(folder, bits, order, n_tokens, n_words, n_types, cuts, rest)


def _sum_words(word: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, None, list[np.ndarray]]:
    order = np.argsort(word, kind="stable")
    at = runs(word[order])[:-1]
    return word[order][at], None, [np.add.reduceat(n[order].astype(np.int64), at) if len(at) else n.astype(np.int64)]


def _cut(times: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return times - np.array([0.0, *d])[np.minimum(times, 3)]


def log_probs(model: Model, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(model's and add-one log10 probability of each token, whether training had it, offsets)."""
    cols, full, off = tokens(column, model.order)
    spread, p = 1 / (model.n_words + 1), None
    for m in range(1, model.order + 1):
        # a table of order m has its grams' counts and, for those that are contexts, what stands behind them
        gram = gram_key(cols[-m:])
        context = gram_key(cols[-m - 1 : -1]) if m < model.order else None
        key, at = np.unique(gram if context is None else np.concatenate([gram, context]), return_inverse=True)
        have = KEPT if context is not None else ("count",)
        _, found = lookup(model.folder, model.bits, key, tuple(f"{c}{m}" for c in have), f"key{m}")
        times = found[0][at[: len(gram)]]
        if p is None:
            p = _cut(times, model.discounts[0]) / max(model.n_types, 1) + model.rest * spread
        else:
            p = np.where(after > 0, _cut(times, model.discounts[m - 1]) / np.maximum(after, 1), 0.0) + free * p
        if context is not None:
            _, after, a1, a2, a3 = (c[at[len(gram) :]] for c in found)
            d = model.discounts[m]
            free = np.where(after > 0, (d[0] * a1 + d[1] * a2 + d[2] * a3) / np.maximum(after, 1), 1.0)
    word, at = np.unique(full, return_inverse=True)
    n = lookup(model.folder, model.bits, word, ("n",), "word")[1][0][at]
    base = np.log10((n + 1) / (model.n_tokens + 1 * (model.n_words + 1)))
    return np.log10(p), base, n > 0, off


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """The rows with n_tokens, n_known, train_tokens, base_score, score and perplexity. Columns of those names are replaced."""
    new = {"n_tokens": T.LongType(), "n_known": T.LongType(), "train_tokens": T.LongType(), "base_score": T.DoubleType(), "score": T.DoubleType(), "perplexity": T.DoubleType()}
    docs = docs.select(*[c for c in docs.columns if c not in new])
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in new.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text, 1 << 20):
            p, base, known, off = log_probs(model, b[text])
            add = lambda x: np.add.reduceat(x, off[:-1])  # noqa: E731  every text has an end
            n, s = np.diff(off), add(p)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(n), pa.array(add(known.astype(np.int64))), pa.array(np.full(len(n), model.n_tokens)), pa.array(add(base)), pa.array(s), pa.array(10 ** np.minimum(-s / n, 300))], names=schema.names)

    return docs.mapInArrow(run, schema)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 7 == 2, F.lit(False))


def op9_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    with shuffles_end(spark):
        model = fit(docs.where("NOT held_out"))
    return score(docs, model).drop("text")


QUERIES = {"op9_kneser_ney": op9_kneser_ney}
SQL: dict[str, str] = {}
