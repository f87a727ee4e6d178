"""Mixing sources to target weights, in words, with a multivariate-hypergeometric splitting tree.

Each source's documents fall into blocks by a hash of their id. A source whose target is e whole passes and a rest has a quota of
all its blocks e times and, for the rest, of as many blocks as the rest holds on average. A binary tree splits all quotas and the
blocks they are drawn from among the output shards: at each node the left half's share of every quota is one
multivariate-hypergeometric draw, and each source's blocks are permuted and divided alike, all with seeds of the node's own. Each
leaf draws its quota from its own blocks in a permuted order and keeps the others in reserve, so the shards' blocks are disjoint.

As blocks differ in words, the leaves take turns: their drawn blocks and then their reserves are taken while they fit the source's
target. The first block that does not fit is taken in part by the shard that owns it, by sub-blocks and then by documents, and a few
single documents of untaken blocks that fit best fill what is left, each in the shard that owns its block. Each shard orders its
rows by a hash.

Null texts have size 0 and are never taken; null sources form one source, the last. A document is taken at most
ceil(target / source size) times. Documents with the same id and text (repeated rows) fall into one block and are taken one by one.
An empty table gives an empty result. Equal seeds give equal results however the input is partitioned. Columns of the input named
_copy or _shard give way to those of the mixture.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gavelframe.llm._store import shared_root

BLOCKS = 64
FILLS = 3
DRAWN = "source string, block int, sub int, copy int, shard int, room double, only long"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sizes: list[tuple[str | None, int]], weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, share: float = 1.0) -> dict[str | None, float]:
    """Target words of each source: by weight in code point order, null last; none above `most` times its size, the excess reshared."""
    order = sorted(sizes, key=lambda x: (x[0] is None, x[0] or ""))
    weight = {s: weights[i % len(weights)] for i, (s, _) in enumerate(order)}
    size, out = dict(order), {}
    left, free = share * sum(size.values()), [s for s, _ in order]
    while free:
        w = sum(weight[s] for s in free)
        full = [s for s in free if left * weight[s] / w > most * size[s]]
        if not full:
            out |= {s: left * weight[s] / w for s in free}
            break
        for s in full:
            out[s] = most * size[s]
        left -= sum(out[s] for s in full)
        free = [s for s in free if s not in out]
    return out


def split_tree(quotas: np.ndarray, pools: list[np.ndarray], shards: int, seed: int) -> list[list[tuple[np.ndarray, np.ndarray]]]:
    """[shard][column] -> (drawn blocks, reserve): every node splits the columns' quotas by one multivariate-hypergeometric draw."""
    out: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in range(shards)]

    def node(q: np.ndarray, pool: list[np.ndarray], lo: int, hi: int) -> None:
        rng = np.random.Generator(np.random.PCG64([seed, lo, hi]))
        pool = [p[rng.permutation(len(p))] for p in pool]
        if hi - lo == 1:
            out[lo] = [(p[:n], p[n:]) for p, n in zip(pool, q.tolist(), strict=True)]
            return
        mid = (lo + hi) // 2
        share = (mid - lo) / (hi - lo)
        left = rng.multivariate_hypergeometric(q, int(round(q.sum() * share)), method="marginals") if q.sum() else q
        cut = [int(n) + int(round((len(p) - m) * share)) for p, n, m in zip(pool, left, q, strict=True)]
        node(left, [p[:c] for p, c in zip(pool, cut, strict=True)], lo, mid)
        node(q - left, [p[c:] for p, c in zip(pool, cut, strict=True)], mid, hi)

    node(np.asarray(quotas, np.int64), pools, 0, shards)
    return out


def _in_turn(parts: list[np.ndarray]) -> list[tuple[int, int]]:
    """(block, shard) of all shards' blocks: first each one's first, then each one's second."""
    return [(b, j) for _, j, b in sorted((i, j, int(b)) for j, p in enumerate(parts) for i, b in enumerate(p))]


def _in(c: Column, part: Column) -> Column:
    return F.pmod(F.xxhash64(c, part), F.lit(BLOCKS)).cast("int")


def plan(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, shards: int = 16, seed: int = 7) -> tuple[DataFrame, dict[str | None, tuple[int, float]]]:
    """(one row (source, block, copy, shard) for each block that a shard draws, {source: (size, target)}).

    sized has source, block, sub, u, size. Sums of blocks and sub-blocks reach the driver: 64 numbers a source each. Within the one
    sub-block of a source that is taken in part, documents are taken in the order of u while the rest lasts.
    """
    spark = sized.sparkSession
    by_block: dict[str | None, np.ndarray] = {}
    for r in sized.groupBy("source", "block").agg(F.sum("size").alias("n")).collect():
        by_block.setdefault(r["source"], np.zeros(BLOCKS, np.int64))[r["block"]] = r["n"]
    want = targets([(s, int(b.sum())) for s, b in by_block.items()], weights, most)
    names = sorted(by_block, key=lambda s: (s is None, s or ""))
    passes, rest, quotas, pools = {}, {}, [], []
    for s in names:
        n = int(by_block[s].sum())
        passes[s] = int(want[s] // n) if n else 0
        rest[s] = want[s] - passes[s] * n
        quotas += [passes[s] * BLOCKS, min(BLOCKS, int(rest[s] * BLOCKS // n)) if n else 0]
        pools += [np.arange(passes[s] * BLOCKS), np.arange(BLOCKS)]
    leaves = split_tree(np.array(quotas, np.int64), pools, shards, seed)
    rows, order, owner, whole = [], {}, {}, {}
    for i, s in enumerate(names):
        for j, leaf in enumerate(leaves):
            rows += [(s, int(x % BLOCKS), None, int(x // BLOCKS), j, None, None) for x in leaf[2 * i][0]]
        turn = _in_turn([leaf[2 * i + 1][0] for leaf in leaves]) + _in_turn([leaf[2 * i + 1][1] for leaf in leaves])
        order[s], owner[s] = np.array([b for b, _ in turn]), dict(turn)
        cum = np.cumsum(by_block[s][order[s]])
        whole[s] = int(np.searchsorted(cum, rest[s], "right"))
        rest[s] -= int(cum[whole[s] - 1]) if whole[s] else 0
        rows += [(s, b, None, passes[s], j, None, None) for b, j in turn[: whole[s]]]
    # the block that is taken in part: first whole sub-blocks, then documents
    edge = {s: int(order[s][whole[s]]) for s in names if whole[s] < BLOCKS and rest[s] > 0}
    if edge:
        part = spark.createDataFrame([(s, b) for s, b in edge.items()], "source string, block int")
        subs: dict[str | None, np.ndarray] = {}
        near = sized.join(F.broadcast(part.withColumnRenamed("source", "s").withColumnRenamed("block", "b")), F.col("source").eqNullSafe(F.col("s")) & (F.col("block") == F.col("b")))
        for r in near.groupBy("source", "sub").agg(F.sum("size").alias("n")).collect():
            subs.setdefault(r["source"], np.zeros(BLOCKS, np.int64))[r["sub"]] = r["n"]
        for s in names:
            if s in edge and s in subs:
                cum = np.cumsum(subs[s])
                k = int(np.searchsorted(cum, rest[s], "right"))
                shard = owner[s][edge[s]]
                rows += [(s, edge[s], j, passes[s], shard, None, None) for j in range(k)]
                rest[s] -= int(cum[k - 1]) if k else 0
                if k < BLOCKS:
                    rows.append((s, edge[s], k, passes[s], shard, float(rest[s]), None))
                    edge[s] = (edge[s], k)
    # undrawn documents that fit best fill the rest
    rank = [(s, int(b), j) for s in names for j, b in enumerate(order[s])]
    ranks = F.broadcast(spark.createDataFrame(rank, "_s string, _b int, _rank int"))
    for turn in range(FILLS):
        if turn == 0:
            cut = [(s, k[1]) for s, k in edge.items() if isinstance(k, tuple)]
            if cut:
                last = _fits(draw_rows(sized, spark.createDataFrame([r for r in rows if r[5] is not None], DRAWN)))
                for r in last.groupBy("source").agg(F.sum("size").alias("n")).collect():
                    rest[r["source"]] -= r["n"]
            undrawn = sized.join(ranks, F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b"))).drop("_s", "_b")
        room = F.broadcast(spark.createDataFrame([(s, whole[s], edge[s][1] if isinstance(edge.get(s), tuple) else BLOCKS, float(rest[s])) for s in names], "_s string, _whole int, _sub int, _room double"))
        free = undrawn.join(room, F.col("source").eqNullSafe(F.col("_s"))).where("(_rank > _whole OR _rank = _whole AND sub > _sub) AND size > 0 AND size <= _room")
        used = [r[6] for r in rows if r[6] is not None]
        if used:
            free = free.where(~F.col("u").isin(used))
        for r in free.groupBy("source").agg(F.max(F.struct("size", "u", "block", "sub")).alias("x")).collect():
            s, x = r["source"], r["x"]
            rows.append((s, x["block"], x["sub"], passes[s], owner[s][x["block"]], None, x["u"]))
            rest[s] -= x["size"]
    return spark.createDataFrame(rows, DRAWN), {s: (int(by_block[s].sum()), float(want[s])) for s in names}


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(id, source, size, block, sub, u) of each row."""
    key = F.col(doc_id).cast("string")
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), _in(F.lit("block"), key).alias("block"), _in(F.lit("sub"), key).alias("sub"), F.xxhash64(F.lit("order"), key).alias("u"))


def draw_rows(sized: DataFrame, drawn: DataFrame) -> DataFrame:
    d = F.broadcast(drawn.withColumnsRenamed({"source": "_s", "block": "_b", "sub": "_u"}))
    on = F.col("source").eqNullSafe(F.col("_s")) & (F.col("block") == F.col("_b")) & F.coalesce(F.col("sub") == F.col("_u"), F.lit(True)) & F.coalesce(F.col("u") == F.col("only"), F.lit(True))
    return sized.where("size > 0").join(d, on).drop("_s", "_b", "_u", "only")


def _fits(took: DataFrame) -> DataFrame:
    """Documents of the sub-blocks taken in part, in the order of u, while they fit."""
    w = Window.partitionBy("source").orderBy("u", "size").rowsBetween(Window.unboundedPreceding, 0)
    return took.where("room IS NOT NULL").withColumn("_at", F.sum("size").over(w)).where("_at <= room").drop("_at")


def draw(sized: DataFrame, drawn: DataFrame) -> DataFrame:
    """A row of `sized` for each time that it is taken, with copy and shard.

    `drawn` has at most 64 * (passes + 2) + 4 rows a source, which bounds what is broadcast.
    """
    took = draw_rows(sized, drawn)
    return took.where("room IS NULL").unionByName(_fits(took)).drop("room")


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, shards: int = 16, seed: int = 7, places: bool = True) -> DataFrame:
    """The mixture: the rows of docs, each as often as it is taken, in hashed order within a shard; with places, also _copy and _shard."""
    shared_root(docs.sparkSession)
    key = F.col(doc_id).cast("string")
    wide = docs.select(F.struct(*docs.columns).alias("_row"), F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), _in(F.lit("block"), key).alias("block"), _in(F.lit("sub"), key).alias("sub"), F.xxhash64(F.lit("order"), key).alias("u"))
    drawn, _ = plan(sizes(docs, doc_id, text, source).checkpoint(), weights, most, shards, seed)
    took = draw(wide, drawn)
    kept = [F.col("_row")[c].alias(c) for c in docs.columns if not (places and c in ("_copy", "_shard"))]
    return took.repartition(F.col("shard"), F.pmod(F.col("u"), F.lit(64))).sortWithinPartitions("shard", F.xxhash64("u", "copy", F.lit(seed))).select(*kept, *[F.col("copy").alias("_copy"), F.col("shard").alias("_shard")][: 2 * places])


def taken(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = (1, 2, 3), most: float = 3.0, shards: int = 16, seed: int = 7) -> DataFrame:
    """One row a document: doc_id, size, source_size, target, taken and shards, those of the output that take it, one for each time."""
    shared_root(docs.sparkSession)
    sized = sizes(docs, doc_id, text, source).checkpoint()
    drawn, want = plan(sized, weights, most, shards, seed)
    took = draw(sized, drawn).groupBy("doc_id", "source", "size", "u").agg(F.array_sort(F.collect_list("shard")).alias("times"))
    # repeated rows of one id are taken together, so each has its share of the shards
    same = sized.groupBy("doc_id", "source", "size", "u").agg(F.count("*").cast("int").alias("rows"))
    per = same.join(took, (same.u == took.u) & same.doc_id.eqNullSafe(took.doc_id) & same.source.eqNullSafe(took.source) & (same["size"] == took["size"]), "left")
    each = per.select(same.doc_id, same.source, same["size"], "rows", "times", F.explode(F.sequence(F.lit(0), F.col("rows") - 1)).alias("i"))
    mine = F.when(F.col("times").isNull(), F.array().cast("array<int>")).otherwise(F.filter("times", lambda x, p: p % F.col("rows") == F.col("i")))
    facts = docs.sparkSession.createDataFrame([(s, n, t) for s, (n, t) in want.items()], "_s string, source_size long, target double")
    known = each.withColumn("shards", mine).join(F.broadcast(facts), F.col("source").eqNullSafe(F.col("_s")))
    return known.select("doc_id", "source", "size", "source_size", "target", (F.col("size") * F.size("shards")).cast("long").alias("taken"), "shards")


def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))


QUERIES = {"op10_source_mix": op10_source_mix}
SQL: dict[str, str] = {}
