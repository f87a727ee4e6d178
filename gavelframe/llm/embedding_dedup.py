"""Embedding near-duplicates: int8 tile products with rigorous quantisation error bounds.

A unit vector u is s * c + e with int8 codes c, scale s and an error e of known length. The dot product of two unit vectors is then
at most s s' (c . c') + |s c| |e'| + |e| |s' c'| + |e| |e'|. Tiles of blocks of vectors take the products of the codes (EXACT
dimensions at a time, whole numbers below 2**24 that single precision holds exactly); only pairs whose bound reaches the threshold are computed again, from the
stored vectors in double precision. Equal vectors count once, with their number. A tile sends link counts and a spanning forest, never
its pairs, and reads its two blocks from the shared folder, so that no block is copied through a shuffle.

All tiles are computed, so the work grows with the square of the number of distinct vectors; that is the method's price for losing
no link. Vectors that are null, zero or hold null or non-finite components link with nothing and are kept. Vectors of different
lengths are not compared. Repeated rows are equal vectors. Null ids take part; their component is the smallest id there is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gavelframe.llm._components import components
from gavelframe.llm._store import Folder, shared_root
from gavelframe.llm._text import U64, mix

BLOCK = 4096
STRIPE = 512
EXACT = 1040  # 127 * 127 * 1040 < 2**24: products of so many codes are exact in single precision
SLACK = 1e-5  # of single precision in the bounds


def vectors(column: pa.Array) -> tuple[list[np.ndarray | None], np.ndarray]:
    """(double vectors, None where one links with nothing; hashes of their values)."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    off = np.asarray(column.offsets)
    values = column.values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    out, key = [], np.zeros(len(column), U64)
    power = np.ones(1, U64)
    for i, null in enumerate(column.is_null().to_pylist()):
        v = values[off[i] : off[i + 1]]
        if null or not len(v) or not np.isfinite(v).all() or not v.any():
            out.append(None)
            continue
        if len(power) < len(v):
            power = mix(np.arange(1, len(v) + 1).astype(U64)) | U64(1)
        out.append(v)
        key[i] = (mix((v + 0.0).view(U64)) * power[: len(v)]).sum(dtype=U64)
    return out, mix(key)


def quantised(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, scale, length of the coded part, length of the error) of the unit vectors."""
    u = v / np.abs(v).max(axis=1, keepdims=True)
    u = u / np.sqrt((u * u).sum(axis=1, keepdims=True))
    scale = np.abs(u).max(axis=1) / 127
    codes = np.rint(u / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    return codes, scale, np.sqrt((coded * coded).sum(axis=1)), np.sqrt(((u - coded) ** 2).sum(axis=1))


def labels(n: int, a: np.ndarray, b: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest node that the pairs (a, b) reach, for nodes 0..n-1, going on from earlier labels."""
    label = np.arange(n) if label is None else label
    while True:
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        now = label.copy()
        np.minimum.at(now, la, low)
        np.minimum.at(now, lb, low)
        now = now[label]
        while not np.array_equal(now, now[now]):
            now = now[now]
        if np.array_equal(now, label):
            return label
        label = now


def tile(folder: Folder, i: int, j: int, threshold: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, numbers of links found here, roots) of the vectors of blocks i and j that have links in the tile."""
    left = {n: folder.load(f"{n}-{i}") for n in ("id", "count", "dim", "vec")}
    right = left if i == j else {n: folder.load(f"{n}-{j}") for n in ("id", "count", "dim", "vec")}
    if left["id"] is None or right["id"] is None:
        return
    width = max(left["vec"].shape[1], right["vec"].shape[1])
    wide = lambda v: np.pad(np.asarray(v), ((0, 0), (0, width - v.shape[1])))
    lv, rv = wide(left["vec"]), wide(right["vec"])
    lc, ls, la, le = quantised(lv)
    rc, rs, ra, re = (lc, ls, la, le) if i == j else quantised(rv)
    r32 = np.ascontiguousarray(rc.astype(np.float32).T)
    rs, ra, re = (x.astype(np.float32) for x in (rs, ra, re))
    nl, nr = len(lv), len(rv)
    links = [np.zeros(nl, np.int64), np.zeros(nr, np.int64)]
    l_norm, r_norm = (np.sqrt((v * v).sum(axis=1)) for v in (lv, rv))
    label = None
    for s in range(0, nl, STRIPE):
        e = min(s + STRIPE, nl)
        bound = lc[s:e, :EXACT].astype(np.float32) @ r32[:EXACT]
        for k in range(EXACT, width, EXACT):  # sums of whole numbers above 2**24 would lose their last bits in single precision
            bound = bound.astype(np.float64) + lc[s:e, k : k + EXACT].astype(np.float32) @ r32[k : k + EXACT]
        bound *= ls[s:e, None].astype(np.float32)
        bound *= rs
        bound += la[s:e, None].astype(np.float32) * re
        bound += le[s:e, None].astype(np.float32) * (ra + re)
        a, b = np.nonzero(bound >= threshold - SLACK)
        a += s
        if i == j:
            a, b = a[a < b], b[a < b]
        for at in range(0, len(a), 1 << 16):
            x, y = a[at : at + (1 << 16)], b[at : at + (1 << 16)]
            ok = np.einsum("ij,ij->i", lv[x], rv[y]) / (l_norm[x] * r_norm[y]) >= threshold
            ok &= np.asarray(left["dim"])[x] == np.asarray(right["dim"])[y]
            x, y = x[ok], y[ok]
            if not len(x):
                continue
            links[0] += np.bincount(x, np.asarray(right["count"])[y], minlength=nl).astype(np.int64)
            links[1] += np.bincount(y, np.asarray(left["count"])[x], minlength=nr).astype(np.int64)
            label = labels(nl + nr, x, y if i == j else y + nl, label)
    if label is not None:
        ids = np.concatenate([left["id"], right["id"]])
        n = np.concatenate([links[0] + links[1], np.zeros(nr, np.int64)]) if i == j else np.concatenate(links)
        have = np.flatnonzero(n)
        yield ids[have], n[have], ids[label[have]]


def embedding_links(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", threshold: float = 0.9) -> DataFrame:
    """One row a vector: vec_id, n_links, component_id, kept."""
    spark = rows.sparkSession
    shared_root(spark)
    folder = Folder(spark, "embeddings")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            vs, key = vectors(b["embedding"])
            yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(key.view(np.int64), mask=np.array([v is None for v in vs], bool)), pa.array([None if v is None else v.tobytes() for v in vs], pa.binary())], names=["vec_id", "key", "vec"])

    read_ = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("embedding")).mapInArrow(read, "vec_id long, key long, vec binary").checkpoint()
    distinct = read_.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("count"), F.first("vec").alias("vec"))
    blocks = max(1, -(-read_.where("key IS NOT NULL").select(F.count_distinct("key")).first()[0] // BLOCK))

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def write() -> None:
            vs = [np.frombuffer(v) for _, _, v in held]
            vec = np.zeros((len(vs), max(map(len, vs))))
            for x, v in zip(vec, vs, strict=True):
                x[: len(v)] = v
            folder.save(f"id-{block}", np.array([k for k, _, _ in held], np.int64).view(U64))
            folder.save(f"count-{block}", np.array([c for _, c, _ in held], np.int64))
            folder.save(f"dim-{block}", np.array([len(v) for v in vs], np.int64))
            folder.save(f"vec-{block}", vec)

        for b in batches:
            for at, *row in zip(*(b[n].to_pylist() for n in ("block", "key", "count", "vec")), strict=True):
                if at != block and held:
                    write()
                    held = []
                block = at
                held.append(row)
        if held:
            write()
        yield pa.RecordBatch.from_pydict({"n": pa.array([1], pa.int64())})

    dealt = distinct.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(blocks)).cast("int")).repartition(parts, "block").sortWithinPartitions("block", "key")
    dealt.select("block", "key", "count", "vec").mapInArrow(save, "n long").agg(F.sum("n")).first()
    folder.seal()

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in b["id"].to_pylist():
                i = int((np.sqrt(8 * t + 1) - 1) // 2)
                i += ((i + 1) * (i + 2) // 2 <= t) - (i * (i + 1) // 2 > t)
                for ids, n, roots in tile(folder, t - i * (i + 1) // 2, i, threshold):
                    yield pa.RecordBatch.from_pydict({"a": ids.view(np.int64), "b": roots.view(np.int64), "n": n})

    tiles = blocks * (blocks + 1) // 2
    found = spark.range(0, tiles, 1, min(tiles, max(parts, blocks))).mapInArrow(compare, "a long, b long, n long").checkpoint()
    folder.remove()
    roots = components(found.select("a", "b"))
    counts = found.groupBy("a").agg(F.sum("n").alias("n"))
    facts = read_.where("key IS NOT NULL").groupBy("key").agg(F.count("*").alias("same"), F.min("vec_id").alias("least"))
    facts = facts.join(counts.withColumnRenamed("a", "key"), "key", "left").join(roots.withColumnRenamed("node", "key"), "key", "left").withColumn("root", F.coalesce("root", "key"))
    facts = facts.join(facts.groupBy("root").agg(F.min("least").alias("component")), "root").select("key", (F.coalesce("n", F.lit(0)) + F.col("same") - 1).alias("n"), "component")
    out = read_.select("vec_id", "key").join(facts, "key", "left")
    component = F.coalesce("component", "vec_id")
    return out.select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"))


QUERIES = {"op3_embedding_dedup": op3_embedding_dedup}
SQL: dict[str, str] = {}
