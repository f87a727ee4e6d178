"""Document fingerprints by winnowing (Schleimer, Wilkerson and Aiken, 2003), with DataFrame functions only.

Tokens are runs of up to 12 characters that are no white space; a longer run has one for each 12 neighbouring characters, so that
what is put in or left out changes only tokens near it, in scripts without spaces too. Each k tokens t1..tk have the Rabin-Karp hash
(t1 * BASE**(k-1) + ... + tk) mod PRIME of their tokens' hashes. Rolling it along by one token takes the last hash along; as arrays
have no running state, the same numbers are rolled up here by doubling: the hash of 2n tokens is that of the first n times BASE**n
plus that of the next n. Mixed to 36 bits, of every w neighbours the smallest is chosen, the rightmost of equal ones, and kept with
its position. Two texts that share k + w - 1 tokens in a row (within a long run k + w + 10 characters) share a chosen hash, and no
hash of fewer than k shared tokens counts.

Null and empty texts, texts of white space alone and empty tables have empty fingerprints; two empty fingerprints are alike (1), an
empty and another one are not (0). Texts of fewer than k tokens have one hash of all of them. Positions count tokens, up to 2**28.
Repeated rows have equal fingerprints. Extra columns pass through; with_next() replaces its own names only.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

K, W = 4, 4
#: matches a run's last 12 characters or fewer whole, else one character; its group is the token that starts there
TOKEN = r"(?=(\S{1,12}))(?:\S{1,12}+(?!\S)|\S)"
POSITION_BITS = 28
MASK = (1 << POSITION_BITS) - 1
#: a product of a hash and the base stays below 2**62
PRIME, BASE = (1 << 45) - 55, 130_003


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once although then() may use it often or in lambdas."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _neighbours(a: Column, step: int, f: Callable[[Column, Column], Column]) -> Column:
    """f of each element and the one `step` behind it; the array must be longer than step."""
    n = F.size(a) - step
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(step + 1), n), f)


def _windows(a: Column, width: int, f: Callable[[Column, Column, int], Column], step: int = 1) -> Column:
    """f(left half, right half, their width) over every `width` neighbours, by doubling; width must be a power of 2."""
    if step == width:
        return a
    now = _neighbours(a, step, lambda x, y: f(x, y, step))
    return now if step * 2 == width else let(now, lambda x: _windows(x, width, f, step * 2))


def _rolled(left: Column, right: Column, step: int) -> Column:
    """The hash of both halves: left * BASE**step + right."""
    for _ in range(step):
        left = left * F.lit(BASE) % F.lit(PRIME)
    return (left + right) % F.lit(PRIME)


def fingerprint(text: Column, k: int = K, w: int = W) -> Column:
    """array<bigint>, in order of position: hash in the upper 36 bits, 2**28 - 1 - position in the lower ones. k and w are powers of 2."""
    hashes = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(TOKEN), F.lit(1)), lambda t: F.pmod(F.xxhash64(t), F.lit(PRIME)))
    grams = lambda h: F.when(F.size(h) > k - 1, _windows(h, k, _rolled)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    packed = lambda g: F.transform(g, lambda x, i: F.xxhash64(x).bitwiseAND(F.lit(~MASK)).bitwiseOR(F.lit(MASK) - i.cast("bigint").bitwiseAND(F.lit(MASK))))
    least = lambda p: F.when(F.size(p) >= w, _windows(p, w, lambda a, b, _: F.least(a, b))).when(F.size(p) > 0, F.array(F.array_min(p))).otherwise(p)
    return let(hashes, lambda h: let(grams(h), lambda g: let(packed(g), lambda p: F.array_distinct(least(p)))))


def hashes(fp: Column) -> Column:
    return F.transform(fp, lambda x: F.shiftright(x, POSITION_BITS))


def positions(fp: Column) -> Column:
    return F.transform(fp, lambda x: F.lit(MASK) - x.bitwiseAND(F.lit(MASK)))


def digest(fp: Column) -> Column:
    return F.sha2(F.array_join(F.transform(fp, lambda x: F.hex(x)), ""), 256)


def likeness(a: Column, b: Column) -> Column:
    """Jaccard similarity of two arrays of distinct hashes."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(let(both, lambda n: n / (F.size(a) + F.size(b) - n).cast("double")))


def range_bucket(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted bounds are at most key, by two steps of about the root of their number."""
    step = max(1, int(len(bounds) ** 0.5))
    groups = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    if not groups:
        return F.lit(0)
    lits = lambda xs: F.array(*[F.lit(x).cast("bigint") for x in xs])
    group = F.size(F.filter(lits([g[0] for g in groups]), lambda x: x <= key))
    inner = lambda g: F.coalesce((g - 1) * step + F.size(F.filter(F.get(F.array(*[lits(x) for x in groups]), g - 1), lambda x: x <= key)), F.lit(0))
    return let(group, inner)


def with_next(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", add: dict[str, Column] | None = None) -> DataFrame:
    """The rows with _next_<c> for text and the added columns: those of the next row by descending id, after the last the first's.

    One shuffle, by ranges of the id that hold alike many rows; the largest row of a range also goes, as a row to look at, to the
    end of the range above (that of the highest to the lowest). Null ids come last; rows of one id stand in the order of a hash.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(doc_id).cast("bigint"), F.lit(-(2**63)))
    n = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(key.alias("k"))
    found = ids.agg(F.percentile_approx("k", [i / n for i in range(1, n)], 20 * n)).first()[0] or []
    bounds = sorted(set(found))
    heads = [(r["b"], r["k"]) for r in ids.groupBy(range_bucket(F.col("k"), bounds).alias("b")).agg(F.max("k").alias("k")).orderBy("b").collect()]
    add = add or {}
    ranged = docs.select(F.struct(*docs.columns).alias("row"), key.alias("k"), range_bucket(key, bounds).alias("b"))
    if heads:
        above = [(k, heads[(i + 1) % len(heads)][0]) for i, (_, k) in enumerate(heads)]
        ranged = ranged.join(F.broadcast(spark.createDataFrame(above, "k bigint, above int")), "k", "left")
    else:
        ranged = ranged.withColumn("above", F.lit(None).cast("int"))
    own, other = F.struct(F.col("b"), F.lit(0).alias("seen")), F.struct(F.col("above").alias("b"), F.lit(1).alias("seen"))
    to = F.explode(F.when(F.col("above").isNull(), F.array(own)).otherwise(F.array(own, other)))
    dealt = ranged.select("row", "k", to.alias("to")).select("row", "k", "to.b", "to.seen").repartition("b")
    # the added columns are made after the shuffle, in the row's own names
    placed = dealt.select(F.struct("k", "b", "seen").alias("__at"), "row.*")
    with_added = placed.select("__at", *[c for c in docs.columns if c not in add], *[c.alias(n) for n, c in add.items()])
    w = Window.partitionBy("__at.b").orderBy("__at.seen", F.desc("__at.k"), F.xxhash64(text))
    nexts = [f"_next_{n}" for n in (text, *add)]
    kept = [c for c in with_added.columns if c not in nexts]
    return with_added.select(*kept, *[F.lead(n).over(w).alias(f"_next_{n}") for n in (text, *add)]).where("__at.seen = 0").drop("__at")


def op6_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    near = with_next(docs, add={"fp": fingerprint(F.col("text"))})
    half = F.floor(F.length("text") / 2).cast("int")
    edited = near.withColumn("edited", F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), F.substring(F.col("_next_text"), F.lit(1), half)))
    done = edited.select("doc_id", F.length("text").cast("long").alias("n_chars"), "edited", "fp", F.col("_next_fp").alias("next_fp"), fingerprint(F.col("edited")).alias("edited_fp"))
    sets = done.select("doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"), digest(F.col("fp")).alias("fingerprint"), digest(F.col("edited_fp")).alias("edited_fingerprint"), *[F.array_distinct(hashes(F.col(c))).alias(c) for c in ("fp", "next_fp", "edited_fp")])
    return sets.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"), likeness(F.col("fp"), F.col("next_fp")).alias("near_next"))


QUERIES = {"op6_winnowing": op6_winnowing}
SQL: dict[str, str] = {}
