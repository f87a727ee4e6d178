"""N-gram Jaccard join with PartEnum signatures (Arasu, Ganti and Kaushik, 2006).

A text's set holds the distinct k-word shingles of its words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased; fewer words make one shingle.
Set sizes fall into bands in which sizes differ by the threshold at most; two sets that reach it lie in one band or neighbouring
ones, and differ in at most d elements, d from the band's largest size. The elements are dealt to parts by a hash. More parts than
d can spoil, each cut into n2 pieces of which any n2 - k2 sign the part together, give equal signatures to every such pair.

Signatures of fewer than MIN_ELEMENTS elements would join unrelated sets. There are e parts more than needed, so a set in which at
most e parts have such signatures leaves them out and loses no pair; a set with more of them sends them all.

Sets with a signature in common are compared exactly, one bucket at a time: members that are already connected are not compared
again, large buckets of sets that stay apart are signed anew, and what is sent on is a spanning forest, not all pairs. Every pair of linked sets ends in one component, whatever the
bucket's size. Equal sets count once. Buckets, sets and links stay in tasks and in the shared folder.

Null and empty texts and texts without words have an empty set and link with nothing; a null id is its own component (null).
Repeated rows are equal sets. Columns of the input other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.llm._components import components
from gavelframe.llm._store import Folder, lookup, runs, shard_bits, shard_of, shared_root, shuffles_end
from gavelframe.llm._text import U64, from_planes, give_back, low_planes, mix, pieces, shingles, words

MIN_ELEMENTS = 2
FLUSH = 1_000_000  # signatures that a map task holds before it sends them
SIGN_ANEW = 4096  # a bucket with more members that stay apart is signed anew
BIN_BITS = 8
BINS = 1 << BIN_BITS
ELEMENTS_HELD = 4_000_000  # of sets that a verifying task holds before it starts anew


@dataclass(frozen=True)
class Threshold:
    """Jaccard similarity >= num / den, on shingles of k words."""

    num: int = 80
    den: int = 100
    k: int = 5

    def bands(self) -> np.ndarray:
        """First sizes of the bands: a band's sizes l..floor(l / threshold)."""
        out, low = [], 1
        while low < 1 << 40:
            out.append(low)
            low = low * self.den // self.num + 1
        return np.array(out, np.int64)

    def differ(self, largest: np.ndarray) -> np.ndarray:
        """The most elements in which two such sets of at most that size differ."""
        return 2 * largest * (self.den - self.num) // (self.den + self.num)

    def pieces(self) -> tuple[int, int]:
        """(k2, n2): a part may have k2 different elements; it has n2 pieces."""
        share = self.num / self.den
        return (0, 1) if share >= 0.88 else (1, 3) if share >= 0.7 else (2, 5)


def set_ids(h: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One 64-bit hash a set, of its elements in any order; 0 for empty sets."""
    sums = np.concatenate([np.zeros(1, U64), np.cumsum(mix(h ^ U64(0x5851F42D4C957F2D)), dtype=U64)])
    n = np.diff(off).astype(U64)
    return np.where(n > 0, mix(sums[off[1:]] - sums[off[:-1]] + n) | U64(1), U64(0))


def signatures(h: np.ndarray, off: np.ndarray, t: Threshold, size: np.ndarray | None = None, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(signatures, the set that each belongs to). size: of the whole sets, if h leaves elements out of them (of all sets alike)."""
    starts, (k2, n2) = t.bands(), t.pieces()
    held = np.diff(off)
    size = held if size is None else size
    band = np.searchsorted(starts, size, "right") - 1
    owner = np.repeat(np.arange(len(size)), held)
    bits = mix(h ^ U64(0x14057B7EF767814F + seed))
    out_sig, out_set = [], []
    for up in (0, 1):
        instance = band + up
        differ = t.differ(starts[instance + 1] - 1)
        base = differ // (k2 + 1) + 1
        spare = 1 + base // 16
        parts = np.where((size > 0) & (differ > 0), base + spare, 0)
        first = np.concatenate([[0], np.cumsum(parts)])
        cells = int(first[-1]) * n2
        if not cells:
            continue
        el = np.flatnonzero(parts[owner] > 0)
        o = owner[el]
        part = ((bits[el] >> U64(32)) * parts[o].astype(U64)) >> U64(32)
        piece = ((bits[el] & U64(0xFFFFFFFF)) * U64(n2)) >> U64(32)
        cell = (first[o] + part.astype(np.int64)) * n2 + piece.astype(np.int64)
        order = np.argsort(cell, kind="stable")
        at = runs(cell[order])[:-1]
        total = np.zeros(cells, U64)
        if len(at):
            total[cell[order][at]] = np.add.reduceat(h[el][order], at)
        count = np.bincount(cell, minlength=cells)
        total, count = total.reshape(-1, n2), count.reshape(-1, n2)
        of = np.repeat(np.arange(len(size)), parts)
        number = np.arange(len(of)) - first[of]
        tag = mix((instance[of] * 1_000_003 + number).astype(U64))
        picks = list(combinations(range(n2), n2 - k2))
        sums = [(total[:, c].sum(axis=1, dtype=U64), count[:, c].sum(axis=1)) for c in (list(p) for p in picks)]
        small = np.zeros(len(of), bool)
        for _, n in sums:
            small |= n < MIN_ELEMENTS
        keep_small = np.bincount(of, small, minlength=len(size)) > spare
        for i, (s, n) in enumerate(sums):
            keep = np.flatnonzero((n >= MIN_ELEMENTS) | keep_small[of])
            out_sig.append(mix(s[keep] + tag[keep] * U64(2 * i + 3)))
            out_set.append(of[keep])
    return (np.concatenate(out_sig), np.concatenate(out_set)) if out_sig else (np.zeros(0, U64), np.zeros(0, np.int64))


def _blobs(bits: int, key: np.ndarray, columns: dict[str, tuple[np.ndarray, int]]) -> Iterator[pa.RecordBatch]:
    """One row a shard of the sorted keys; columns {name: (values, bytes of each)}."""
    cut = np.searchsorted(shard_of(key, bits), np.arange((1 << bits) + 1))
    have = np.flatnonzero(np.diff(cut))
    yield pa.RecordBatch.from_pydict({"shard": pa.array(have, pa.int32())} | {n: pa.array([low_planes(x[cut[s] : cut[s + 1]], w) for s in have], pa.binary()) for n, (x, w) in columns.items()})


def _by_shard(batches: Iterator[pa.RecordBatch], columns: dict[str, int]) -> Iterator[tuple[int, list[np.ndarray]]]:
    shard, held = None, [[] for _ in columns]
    for b in batches:
        for i, s in enumerate(b["shard"].to_pylist()):
            if s != shard and shard is not None:
                yield shard, [np.concatenate(x) for x in held]
                held = [[] for _ in columns]
            shard = s
            for x, (n, w) in zip(held, columns.items(), strict=True):
                x.append(from_planes(b[n][i].as_py(), w))
    if shard is not None:
        yield shard, [np.concatenate(x) for x in held]
    give_back()


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard").sortWithinPartitions("shard")


def _tasks(spark: SparkSession, bits: int) -> DataFrame:
    """One row a shard, dealt to as many tasks as a shuffle has."""
    return spark.range(0, 1 << bits, 1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def _buckets(docs: DataFrame, text: str, t: Threshold, folder: Folder, bits: int) -> None:
    """Writes the distinct buckets of sets that share a signature (member-s, size-s), and the ids of their members (cand-s)."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            sig, ids = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            order = np.lexsort((ids, sig))
            sig, ids = sig[order], ids[order]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
            yield from _blobs(bits, sig[new], {"sig": (sig[new] << U64(bits) >> U64(32), 4), "id": (ids[new], 8)})

        for b in pieces(batches, text):
            h, off = shingles(*words(b[text]), t.k)
            ids = set_ids(h, off)
            _, one = np.unique(ids, return_index=True)  # equal sets sign once
            if len(one) < len(ids):
                one = np.sort(one)
                size = np.diff(off)[one]
                h = h[np.repeat(off[one] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(size.sum())]
                off, ids = np.concatenate([[0], np.cumsum(size)]), ids[one]
            sig, own = signatures(h, off, t)
            held.append((sig, ids[own]))
            n += len(sig)
            if n >= FLUSH:
                yield from flush()
                held, n = [], 0
        if n:
            yield from flush()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (sig, ids) in _by_shard(batches, {"sig": 4, "id": 8}):
            order = np.lexsort((ids, sig))
            sig, ids = sig[order], ids[order]
            new = np.ones(len(sig), bool)
            new[1:] = (sig[1:] != sig[:-1]) | (ids[1:] != ids[:-1])
            sig, ids = sig[new], ids[new]
            at = runs(sig)
            size = np.diff(at)
            many = np.flatnonzero(size > 1)
            if not len(many):
                continue
            total = np.add.reduceat(mix(ids), at[:-1])
            name = mix(total + size.astype(U64))[many]
            name, pick = np.unique(name, return_index=True)  # buckets of the same members count once
            many = many[pick]
            shard = shard_of(name, bits)
            for s in np.unique(shard):
                m = many[shard == s]
                member = np.concatenate([ids[at[i] : at[i + 1]] for i in m])
                yield pa.RecordBatch.from_pydict({"shard": pa.array([s], pa.int32()), "name": pa.array([low_planes(name[shard == s], 8)]), "size": pa.array([low_planes(size[m], 8)]), "member": pa.array([low_planes(member, 8)])})

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = []
        for shard, (name, size, member) in _by_shard(batches, {"name": 8, "size": 8, "member": 8}):
            size = size.astype(np.int64)
            at = np.concatenate([[0], np.cumsum(size)])
            _, pick = np.unique(name, return_index=True)
            member = np.concatenate([member[at[i] : at[i + 1]] for i in pick])
            folder.save(f"size-{shard}", size[pick])
            folder.save(f"member-{shard}", member)
            seen.append(np.unique(member))
        if seen:  # a row a shard of the whole task, not of each of its shards
            ids = np.unique(np.concatenate(seen))
            yield from _blobs(bits, ids, {"id": (ids, 8)})

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (ids,) in _by_shard(batches, {"id": 8}):
            ids = np.unique(ids)
            folder.save(f"cand-{shard}", ids)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(ids)], pa.int64())})

    signed = _dealt(docs.select(text).mapInArrow(sign, "shard int, sig binary, id binary"))
    gathered = _dealt(signed.mapInArrow(gather, "shard int, name binary, size binary, member binary"))
    _dealt(gathered.mapInArrow(save, "shard int, id binary")).mapInArrow(candidates, "n long").agg(F.sum("n")).first()
    folder.seal()


def _sets(docs: DataFrame, text: str, t: Threshold, folder: Folder, bits: int) -> None:
    """Writes the sets of the buckets' members: elements in a segment of each map task, places in key-s, place-s, count-s, segment-s."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ctx = TaskContext.get()
        number, held, at, rows = ctx.taskAttemptId(), [], 0, []
        for b in pieces(batches, text):
            h, off = shingles(*words(b[text]), t.k)
            ids, pick = np.unique(set_ids(h, off), return_index=True)
            found, _ = lookup(folder, bits, ids, (), "cand")
            for i, d in zip(ids[found], pick[found], strict=True):
                held.append(h[off[d] : off[d + 1]])
                rows.append((i, at, off[d + 1] - off[d]))
                at += int(off[d + 1] - off[d])
        if rows:
            folder.save(f"segment-{number}", np.concatenate(held))
            ids = np.array([r[0] for r in rows], U64)
            order = np.argsort(ids)
            place, count = (np.array([r[i] for r in rows], U64)[order] for i in (1, 2))
            yield from _blobs(bits, ids[order], {"id": (ids[order], 8), "place": (place, 8), "count": (count, 8), "segment": (np.full(len(ids), number, U64), 8)})

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (ids, *cols) in _by_shard(batches, {"id": 8, "place": 8, "count": 8, "segment": 8}):
            ids, pick = np.unique(ids, return_index=True)
            folder.save(f"key-{shard}", ids)
            for name, c in zip(("place", "count", "number"), cols, strict=True):
                folder.save(f"{name}-{shard}", c[pick].astype(np.int64))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(ids)], pa.int64())})

    _dealt(docs.select(text).mapInArrow(write, "shard int, id binary, place binary, count binary, segment binary")).mapInArrow(index, "n long").agg(F.sum("n")).first()
    folder.seal()


class _Sets:
    """The sets of a task's buckets, with a histogram of each over BINS ranges of the hash, and the smallest place that links reach."""

    def __init__(self):
        self.place: dict[int, int] = {}
        self.ids: list[int] = []
        self.sets: list[np.ndarray] = []
        self.size = np.zeros(0, np.int64)
        self.bins = np.zeros((0, BINS), np.uint16)
        self.root = np.zeros(0, np.int64)

    def add(self, ids: list[int], sets: list[np.ndarray]) -> None:
        first = len(self.ids)
        self.place |= {m: first + i for i, m in enumerate(ids)}
        self.ids += ids
        self.sets += sets
        self.size = np.append(self.size, [len(x) for x in sets])
        self.root = np.append(self.root, np.arange(first, len(self.ids)))
        at = np.concatenate([np.full(len(x), i * BINS) for i, x in enumerate(sets)]) + (np.concatenate(sets) >> U64(64 - BIN_BITS)).astype(np.int64)
        bins = np.bincount(at, minlength=len(sets) * BINS).reshape(-1, BINS)
        self.bins = np.concatenate([self.bins, np.minimum(bins, 65535).astype(np.uint16)])

    def drop(self) -> None:
        """Forgets the sets but not what links them."""
        self.sets = [None] * len(self.ids)


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.concatenate(sets), np.concatenate([[0], np.cumsum([len(x) for x in sets])])


def _linked_to(one: int, others: np.ndarray, s: _Sets, t: Threshold) -> np.ndarray:
    """Which of the sets reach the threshold with this one. Two sets share at most the sum over the bins of the smaller count; those
    that may share enough are compared exactly."""
    size = s.size[others]
    need = -(-t.num * (size + s.size[one]) // (t.num + t.den))
    others = others[need <= np.minimum(size, s.size[one])]
    need = -(-t.num * (s.size[others] + s.size[one]) // (t.num + t.den))
    most = np.concatenate([np.minimum(s.bins[one], s.bins[others[i : i + 4096]]).sum(axis=1, dtype=np.int64) for i in range(0, len(others), 4096)]) if len(others) else np.zeros(0, np.int64)
    may = np.flatnonzero((most >= need) | (s.size[others] > 65535))
    others, need = others[may], need[may]
    out = []
    for i in range(0, len(others), 256):
        part = others[i : i + 256]
        all_, off = _flat([s.sets[m] for m in part])
        own = s.sets[one]
        at = np.minimum(np.searchsorted(own, all_), len(own) - 1)
        out.append(part[np.add.reduceat((own[at] == all_).astype(np.int64), off[:-1]) >= need[i : i + 256]])
    return np.concatenate(out) if out else others


def _compare(members: np.ndarray, s: _Sets, t: Threshold) -> None:
    """Connects all members (places in s) that links connect: each in turn is compared with those that it is not connected with yet.

    Very many members that stay apart, as of a bucket that stands for a common passage, are signed anew by another seed and without the
    elements that most of them have. That leaves no two sets further apart, so linked ones share a signature again; if this leaves
    fewer pairs, only these are compared.
    """
    for i in range(len(members) - 1):
        roots = s.root[members[i:]]
        if (roots == roots[0]).all():
            if i == 0 or (s.root[members] == roots[0]).all():
                return
            continue
        _compare_one(members[i], members[i + 1 :][roots[1:] != roots[0]], s, t)
        if i == 0 and len(members) > SIGN_ANEW:
            left = members[1:]
            pairs = _closer(left, s, t)
            if pairs is not None:
                cut = runs(pairs[:, 0])
                for a, b in zip(cut[:-1], cut[1:], strict=True):
                    one, others = left[pairs[a, 0]], left[pairs[a:b, 1]]
                    _compare_one(one, others[s.root[others] != s.root[one]], s, t)
                return


def _compare_one(one: int, others: np.ndarray, s: _Sets, t: Threshold) -> None:
    for m in _linked_to(one, others, s, t) if len(others) else others:
        a, b = s.root[one], s.root[m]
        if a != b:
            s.root[s.root == max(a, b)] = min(a, b)


def _closer(members: np.ndarray, s: _Sets, t: Threshold) -> np.ndarray | None:
    """Pairs (sorted) of places of members that share a signature without the elements that most members have; None if too many."""
    h, off = _flat([s.sets[m] for m in members])
    element, times = np.unique(h, return_counts=True)
    common = element[2 * times > len(members)]
    keep = np.ones(len(h), bool)
    if len(common):
        keep = common[np.minimum(np.searchsorted(common, h), len(common) - 1)] != h
    sig, own = signatures(h[keep], np.concatenate([[0], np.cumsum(keep)])[off], t, np.diff(off), 1)
    order = np.lexsort((own, sig))
    sig, own = sig[order], own[order]
    at = runs(sig)
    size = np.diff(at)
    many = np.flatnonzero(size > 1)
    if not len(many):
        return np.zeros((0, 2), np.int64)
    many = many[np.unique(np.add.reduceat(mix(own.astype(U64) + U64(1)), at[:-1])[many], return_index=True)[1]]
    if (size[many] * (size[many] - 1)).sum() > len(members) * (len(members) - 1) // 2:
        return None
    codes = [np.add.outer(o * len(members), o)[np.triu_indices(len(o), 1)] for o in (own[at[i] : at[i + 1]] for i in many)]
    code = np.unique(np.concatenate(codes))
    return np.stack([code // len(members), code % len(members)], axis=1)


def _links(spark: SparkSession, t: Threshold, folder: Folder, bits: int) -> DataFrame:
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard in b["id"].to_pylist():
                size, member = folder.load(f"size-{shard}"), folder.load(f"member-{shard}")
                if size is None:
                    continue
                at = np.concatenate([[0], np.cumsum(size.astype(np.int64))])
                held, elements = _Sets(), 0
                for i in np.argsort(-size.astype(np.int64), kind="stable"):
                    ids = member[at[i] : at[i + 1]].tolist()
                    need = [m for m in ids if m not in held.place or held.sets[held.place[m]] is None]
                    if need and elements > ELEMENTS_HELD:
                        held.drop()
                        elements, need = 0, ids
                    if need:
                        need = np.sort(np.array(need, U64))
                        found, (place, count, number) = lookup(folder, bits, need, ("place", "count", "number"))
                        assert found.all()
                        sets = [np.asarray(folder.load(f"segment-{n}", must=True)[p : p + c]) for p, c, n in zip(place, count, number, strict=True)]
                        elements += int(count.sum())
                        new = [j for j, m in enumerate(need.tolist()) if m not in held.place]
                        for j, m in enumerate(need.tolist()):
                            if m in held.place:
                                held.sets[held.place[m]] = sets[j]
                        if new:
                            held.add([int(need[j]) for j in new], [sets[j] for j in new])
                    _compare(np.array([held.place[m] for m in ids]), held, t)
                ids = np.array(held.ids, U64)
                some = np.flatnonzero(held.root != np.arange(len(ids)))
                a, b_ = ids[held.root[some]].view(np.int64), ids[some].view(np.int64)
                yield pa.RecordBatch.from_pydict({"a": a, "b": b_})

    return _tasks(spark, bits).mapInArrow(verify, "a long, b long")


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: Threshold = Threshold()) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the smallest id that links reach) and set_id (null for empty sets)."""
    spark = docs.sparkSession
    shared_root(spark)
    folder, bits = Folder(spark, "jaccard"), shard_bits(spark)

    def facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "text"):
            h, off = shingles(*words(b["text"]), threshold.k)
            ids = set_ids(h, off)
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(np.diff(off)), pa.array(ids.view(np.int64), mask=ids == 0)], names=["doc_id", "n_shingles", "set_id"])

    with shuffles_end(spark):
        _buckets(docs, text, threshold, folder, bits)
        _sets(docs, text, threshold, folder, bits)
    roots = components(_links(spark, threshold, folder, bits)).checkpoint()
    folder.remove()
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(facts, "doc_id long, n_shingles long, set_id long").checkpoint()
    known, known_bits = _components_store(rows, roots), bits

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = pc.fill_null(b["set_id"], 0).to_numpy(zero_copy_only=False).view(U64)
            key, back = np.unique(sets, return_inverse=True)
            found, (root,) = lookup(known, known_bits, key, ("root",), "set")
            root = np.where(found, root.view(U64), key)
            key, of = np.unique(root, return_inverse=True)
            found, (least,) = lookup(known, known_bits, key, ("least",), "component")
            least, has = least[of][back], found[of][back] & (sets != 0)
            component = pc.if_else(pa.array(has), pa.array(least), b["doc_id"])
            yield pa.RecordBatch.from_arrays([b["doc_id"], b["n_shingles"], component, b["set_id"]], names=["doc_id", "n_shingles", "component_id", "set_id"])

    return rows.mapInArrow(assign, "doc_id long, n_shingles long, component_id long, set_id long")


def _components_store(rows: DataFrame, roots: DataFrame) -> Folder:
    """A store of the sets with another root (set-s, root-s) and of the components of several rows (component-s, least-s).

    Rows find their component in it, so that neither a set with very many copies nor a component of very many sets meets in one task.
    """
    spark = rows.sparkSession
    folder, bits = Folder(spark, "jaccard-components"), shard_bits(spark)
    sets = rows.where("set_id IS NOT NULL").groupBy("set_id").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    rooted = sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn("root", F.coalesce("root", "set_id")).checkpoint()
    shard = lambda c: F.shiftrightunsigned(F.col(c), 64 - bits).cast("int").alias("shard")

    def saved(key: str, value: str):
        def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
            for b in batches:
                s, k, v = (b[c].to_numpy(zero_copy_only=False) for c in ("shard", "k", "v"))
                cut = runs(s)
                for i, j in zip(cut[:-1], cut[1:], strict=True):
                    if int(s[i]) not in held:
                        yield from flush(held)
                        held = {int(s[i]): []}
                    held[int(s[i])].append((k[i:j].view(U64), v[i:j].view(U64)))
            yield from flush(held)

        def flush(held: dict[int, list[tuple[np.ndarray, np.ndarray]]]) -> Iterator[pa.RecordBatch]:
            for s, parts in held.items():
                k, v = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
                order = np.argsort(k)
                folder.save(f"{key}-{s}", k[order])
                folder.save(f"{value}-{s}", v[order])
                yield pa.RecordBatch.from_pydict({"n": pa.array([len(k)], pa.int64())})

        return save

    moved = rooted.where("root <> set_id").select(shard("set_id"), F.col("set_id").alias("k"), F.col("root").alias("v"))
    _dealt(moved).mapInArrow(saved("set", "root"), "n long").agg(F.sum("n")).first()
    several = rooted.groupBy("root").agg(F.min("least").alias("least"), F.sum("n").alias("n")).where("n > 1 AND least IS NOT NULL")
    _dealt(several.select(shard("root"), F.col("root").alias("k"), F.col("least").alias("v"))).mapInArrow(saved("component", "least"), "n long").agg(F.sum("n")).first()
    folder.seal()
    return folder


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: Threshold = Threshold()) -> DataFrame:
    """The rows without all but one of each component: that of the smallest id stays; null ids are the largest. Empty sets stay.

    Only ids and set hashes are shuffled: the rows pass once more, and those whose (id, set) is in the stored list go.
    """
    spark = docs.sparkSession
    shared_root(spark)
    last = F.lit(2**63 - 1)
    ids = F.coalesce(F.col(doc_id).cast("long"), last)
    found = jaccard_components(docs.select(ids.alias("doc_id"), F.col(text).alias("text")), threshold=threshold).where("set_id IS NOT NULL")
    sets = found.groupBy("component_id", "doc_id", "set_id").agg(F.count("*").alias("n")).checkpoint()
    # only rows of the component's own id can stay, one set of them; no join brings a component together
    own = sets.where("doc_id = component_id").groupBy("component_id").agg(F.min(F.struct("set_id", "n")).alias("best")).select(F.col("component_id").alias("doc_id"), "best.*")
    goes = sets.where("doc_id <> component_id").select("doc_id", "set_id", F.lit(False).alias("stays"), "n")
    first = sets.where("doc_id = component_id").join(own.select("doc_id", F.col("set_id").alias("best")), "doc_id")
    judged = goes.unionByName(first.select("doc_id", "set_id", (F.col("set_id") == F.col("best")).alias("stays"), "n")).where("NOT stays OR n > 1")
    folder, bits = Folder(spark, "keep-one"), shard_bits(spark)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            key = _row_key(b["doc_id"].to_numpy(), b["set_id"].to_numpy().view(U64))
            order = np.argsort(key)
            yield from _blobs(bits, key[order], {"key": (key[order], 8), "twice": (b["stays"].to_numpy(zero_copy_only=False)[order].astype(U64), 1)})

    def save(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (key, twice) in _by_shard(batches, {"key": 8, "twice": 1}):
            order = np.argsort(key)
            folder.save(f"gone-{shard}", key[order][twice[order] == 0])
            folder.save(f"twice-{shard}", key[order][twice[order] == 1])
            yield pa.RecordBatch.from_pydict({"n": pa.array([int(twice.sum())], pa.int64())})

    repeated = _dealt(judged.mapInArrow(keyed, "shard int, key binary, twice binary")).mapInArrow(save, "n long").agg(F.sum("n")).first()[0]
    folder.seal()
    schema = T.StructType([*docs.schema.fields, T.StructField("__key", T.LongType())])

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text):
            sets_ = set_ids(*shingles(*words(b[text]), threshold.k))
            id_ = pc.fill_null(b[doc_id].cast(pa.int64()), 2**63 - 1).to_numpy()
            key, back = np.unique(_row_key(id_, sets_), return_inverse=True)
            gone, _ = lookup(folder, bits, key, (), "gone")
            twice, _ = lookup(folder, bits, key, (), "twice")
            stays_ = ~gone[back] | (sets_ == 0)
            out = pa.RecordBatch.from_arrays([*b.columns, pa.array(key[back].view(np.int64), mask=~twice[back])], names=schema.names)
            yield out.filter(pa.array(stays_))

    kept = docs.mapInArrow(keep, schema)
    if not repeated:
        return kept.drop("__key")
    return kept.where("__key IS NULL").unionByName(kept.where("__key IS NOT NULL").dropDuplicates(["__key"])).drop("__key")


def _row_key(ids: np.ndarray, sets: np.ndarray) -> np.ndarray:
    return mix(mix(ids.view(U64)) + sets)


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return jaccard_components(docs, threshold=Threshold(90, 100, 3)).drop("set_id")


QUERIES = {"op2_jaccard_join": op2_jaccard_join}
SQL: dict[str, str] = {}
