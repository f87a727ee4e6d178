"""Removal of long repeated byte strings with a logarithmic family of suffix arrays.

Every byte that a `length`-byte string covers which also starts anywhere else is removed, judged on the input. Only suffixes that can
repeat are indexed:

1. A text that occurs more than once repeats whole; one of its rows stands for it in the index.
2. In every window of `length` bytes the 32-byte gram with the smallest hash (the leftmost of equal ones) is its anchor, so that equal
   windows have equal anchors at equal places. An anchor and the windows it belongs to are a context: the bytes from its first window's
   start to its last window's end. Anchors are counted over all texts; one that occurs once has no repeated window.
3. Contexts that are equal as a whole repeat whole. The others of a repeated anchor are dealt by the anchor to the index: one family of
   suffix arrays a shard. The documents come in BATCHES batches. Each gets a suffix array of its contexts' windows, which is
   merge-scanned against every level that earlier batches have left in the shared folder, marking both sides of each match; levels of
   equal size then merge, so that a window is merged at most log2(batches) times and no level is sorted again from nothing.
4. A last pass over the texts finds each context's repeated windows by the context's hash and removes the bytes they cover.

No text is shuffled; levels and marks are sorted arrays in the shared folder. Before anything is dealt, map tasks drop contexts that
they have sent already. An anchor with more than HOT different contexts is dealt by its windows' places before it as well. Equal windows
agree in anchor and place, so suffixes are ordered by these first and bytes are compared only where they agree, WINDOWS_HELD at a
time. Texts of any length are read in stretches of STRETCH windows.

Null texts are empty; texts of fewer than `length` bytes stay. Repeated rows are texts that occur more than once. Matches never cross
texts. Bytes are compared, not characters, so what is kept may be no UTF-8: it is returned as binary. Empty tables give empty results.
Other columns pass through; those with the names of the new ones are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gavelframe.llm._store import Folder, lookup, runs, shard_bits, shard_of, shared_root, shuffles_end
from gavelframe.llm._text import BASE, U64, flat, from_planes, give_back, low_planes, mix, pieces, powers, prefix, span_hash

GRAM = 32
BATCHES = 4
WINDOWS_HELD = 100_000  # windows whose bytes are compared at once
HOT, PLACES = 4096, 32  # an anchor with more contexts is dealt by this many places at a time
STRETCH = 1 << 20  # windows of one text that are read at once
FLUSH = 400_000  # anchors that a map task holds before it sends them
FLUSH_BYTES = 8 << 20  # bytes of contexts likewise


def text_hashes(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """span_hash() of each text, a stretch of STRETCH bytes at a time for long ones."""
    if len(off) > 2 or len(buf) <= STRETCH:
        return span_hash(prefix(buf), off[:-1], off[1:])
    total, power = 0, 1
    for p in range(0, len(buf), STRETCH):
        part = buf[p : p + STRETCH]
        total += int(prefix(part)[-1]) * power
        power = power * pow(BASE, len(part), 1 << 64) % (1 << 64)
    return mix(np.array([(total + len(buf) * 0x632BE59BD9B4E019) % (1 << 64)], U64))


def stretches(column: pa.Array, length: int) -> Iterator[Contexts]:
    """The contexts of a slice of texts; a long text alone comes in stretches that share length - 1 bytes, so each window in one of them."""
    buf, off = flat(column)
    names = text_hashes(buf, off)
    if len(off) > 2 or len(buf) <= STRETCH + length - 1:
        yield Contexts(buf, off, names, length)
        return
    for p in range(0, len(buf) - length + 1, STRETCH):
        part = buf[p : p + STRETCH + length - 1]
        yield Contexts(part, np.array([0, len(part)]), names, length, p)


class Contexts:
    """The anchors of a slice of texts, with the windows that belong to each."""

    def __init__(self, buf: np.ndarray, off: np.ndarray, text: np.ndarray, length: int, shift: int = 0):
        """text: the hashes of the whole texts; shift: where the buffer begins in the text, if it is a stretch of one."""
        self.buf, self.off, self.text, self.shift = buf, off, text, shift
        n = len(self.buf)
        self.sums = prefix(self.buf)
        size = np.diff(self.off)
        windows = n - length + 1
        if windows <= 0 or not (size >= length).any():
            self.first = self.last = self.anchor = self.key = self.doc = np.zeros(0, np.int64)
            self.key = np.zeros(0, U64)
            self.name = np.zeros(0, U64)
            return
        _, inverse = powers(n + 1)
        gram = ((self.sums[GRAM:] - self.sums[:-GRAM]) * inverse[: n - GRAM + 1]) * U64(BASE)
        place = np.arange(len(gram), dtype=U64)
        low = (gram & ~U64((1 << 26) - 1)) | place
        span, step = length - GRAM + 1, 1
        while step * 2 <= span:
            low = np.minimum(low[:-step], low[step:])
            step *= 2
        if step < span:
            low = np.minimum(low[: len(low) - (span - step)], low[span - step :])
        at = (low & U64((1 << 26) - 1)).astype(np.int64)  # of each window
        doc = np.repeat(np.arange(len(size)), size)
        ok = np.flatnonzero(doc[:windows] == doc[length - 1 :])
        at = at[ok]
        new = np.ones(len(ok), bool)
        new[1:] = (at[1:] != at[:-1]) | (ok[1:] != ok[:-1] + 1)
        cut = np.flatnonzero(new)
        self.first = ok[cut]  # first window of each anchor
        self.last = ok[np.append(cut[1:], len(ok)) - 1]
        self.anchor = at[cut]
        self.doc = doc[self.first]
        self.key = mix(gram[self.anchor])
        self.length = length
        ahead = (self.anchor - self.first).astype(U64)
        self.name = mix(span_hash(self.sums, self.first, self.last + length) + ahead * U64(BASE))

    def take(self, keep: np.ndarray) -> None:
        self.first, self.last, self.anchor, self.doc, self.key, self.name = (x[keep] for x in (self.first, self.last, self.anchor, self.doc, self.key, self.name))


def _stands(c: Contexts, batch: pa.RecordBatch, folder: Folder, bits: int) -> np.ndarray:
    """Whether each text of the slice stands for itself in the index: all but the later rows of a text that occurs more than once."""
    keys, back = np.unique(c.text, return_inverse=True)
    found, (row,) = lookup(folder, bits, keys, ("row",), "copy")
    return ~found[back] | (row[back] == batch["_row"].to_numpy(zero_copy_only=False))


def _repeated(c: Contexts, folder: Folder, bits: int) -> np.ndarray:
    keys, back = np.unique(c.text, return_inverse=True)
    return lookup(folder, bits, keys, (), "copy")[0][back]


def _blobs(bits: int, key: np.ndarray, columns: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    cut = np.searchsorted(shard_of(key, bits), np.arange((1 << bits) + 1))
    have = np.flatnonzero(np.diff(cut))
    yield pa.RecordBatch.from_pydict({"shard": pa.array(have, pa.int32())} | {n: pa.array([low_planes(x[cut[s] : cut[s + 1]], 8) for s in have], pa.binary()) for n, x in columns.items()})


def _grouped(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int, list[list[bytes]]]]:
    shard, held = None, [[] for _ in names]
    for b in batches:
        for i, s in enumerate(b["shard"].to_pylist()):
            if s != shard and shard is not None:
                yield shard, held
                held = [[] for _ in names]
            shard = s
            for x, n in zip(held, names, strict=True):
                x.append(b[n][i].as_py())
    if shard is not None:
        yield shard, held
    give_back()


def _ints(blobs: list[bytes]) -> np.ndarray:
    return np.concatenate([from_planes(x, 8) for x in blobs])


@dataclass
class Level:
    """A suffix array over the windows of some contexts.

    Contexts: name, key (of their anchor), ahead (bytes before the anchor), skip (windows of the whole context before the first one
    here) and where they start in body. Windows, in suffix order: group (key and place before the anchor), owner (a context) and at
    (its place in the context).
    """

    name: np.ndarray
    key: np.ndarray
    ahead: np.ndarray
    skip: np.ndarray
    start: np.ndarray  # one more than contexts
    body: np.ndarray
    group: np.ndarray
    owner: np.ndarray
    at: np.ndarray

    CONTEXTS = ("name", "key", "ahead", "skip", "start", "body")
    WINDOWS = ("owner", "at")

    @staticmethod
    def of(name: np.ndarray, key: np.ndarray, ahead: np.ndarray, skip: np.ndarray, size: np.ndarray, body: np.ndarray, length: int) -> tuple[Level, np.ndarray]:
        """The level of these contexts and which of its windows repeat each other."""
        start = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
        n = size - length + 1
        owner = np.repeat(np.arange(len(n)), n)
        at = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        new = Level(name, key, ahead, skip, start, body, Level.groups(key, ahead, owner, at), owner, at)
        return new._ordered(np.argsort(new.group, kind="stable"), length)

    @staticmethod
    def groups(key: np.ndarray, ahead: np.ndarray, owner: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (key[owner] & ~U64(255)) | ((ahead[owner] - at) & 255).astype(U64)

    def _ordered(self, order: np.ndarray, length: int) -> tuple[Level, np.ndarray]:
        """From an order by group to one by group and bytes; neighbours with `length` bytes in common repeat each other."""
        group = self.group[order]
        same = group[1:] == group[:-1]
        repeats = np.zeros(len(order), bool)
        many = np.flatnonzero(np.concatenate([same, [False]]) | np.concatenate([[False], same])) if len(order) else order
        cut = runs(group[many])
        i = 0
        while i < len(cut) - 1:  # whole groups, about WINDOWS_HELD windows
            j = max(i + 1, int(np.searchsorted(cut, cut[i] + WINDOWS_HELD, "right")) - 1)
            here = many[cut[i] : cut[j]]
            text = self._strings(order[here], group[here], length)
            by = np.argsort(text, kind="stable")  # finds the runs of levels in order already, and merges them
            text = text[by]
            twin = np.flatnonzero(text[1:] == text[:-1])
            order[here] = order[here][by]
            repeats[here[twin]] = True
            repeats[here[twin + 1]] = True
            i = j
        return Level(self.name, self.key, self.ahead, self.skip, self.start, self.body, group, self.owner[order], self.at[order]), repeats

    def _strings(self, windows: np.ndarray, group: np.ndarray, length: int) -> np.ndarray:
        """Group and bytes of the windows as strings without zero bytes at their ends (UTF-8 has no byte 255)."""
        begin = self.start[self.owner[windows]] + self.at[windows]
        out = np.empty((len(windows), 8 + length), np.uint8)
        out[:, :8] = group.astype(">u8").view(np.uint8).reshape(-1, 8)
        out[:, 8:] = np.lib.stride_tricks.sliding_window_view(self.body, length)[begin]
        out[:, 8:] += 1
        return out.view(f"S{8 + length}")[:, 0]

    def take(self, windows: np.ndarray) -> Level:
        """Some of the windows, in order, with all contexts."""
        return Level(*(getattr(self, c) for c in self.CONTEXTS), self.group[windows], self.owner[windows], self.at[windows])

    def merged(self, other: Level, length: int) -> tuple[Level, np.ndarray]:
        """Both levels as one, and which of its windows repeat each other; owners of the other's windows count on."""
        contexts = [np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("name", "key", "ahead", "skip")]
        start = np.concatenate([self.start, other.start[1:] + self.start[-1]])
        both = Level(*contexts, start, np.concatenate([self.body, other.body]), np.concatenate([self.group, other.group]), np.concatenate([self.owner, other.owner + len(self.name)]), np.concatenate([self.at, other.at]))
        return both._ordered(np.argsort(both.group, kind="stable"), length)

    def scanned(self, other: Level, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(name, skip and at as a window of the whole context) of both sides' windows that repeat, where groups meet."""
        meet = lambda a, b: np.flatnonzero(b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a) if len(b) else np.zeros(0, np.int64)
        here, there = self.take(meet(self.group, other.group)), other.take(meet(other.group, self.group))
        if not len(here.group):
            return np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        both, repeats = here.merged(there, length)
        return both.marks(repeats)

    def marks(self, repeats: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = self.owner[repeats]
        return self.name[own], self.skip[own].astype(np.int64), self.at[repeats].astype(np.int64)

    def save(self, folder: Folder, number: int, shard: int) -> None:
        if not len(self.name):
            return
        for c in self.CONTEXTS + self.WINDOWS:
            folder.save(f"level{number}.{c}-{shard}", getattr(self, c))

    @staticmethod
    def load(folder: Folder, number: int, shard: int) -> Level | None:
        """Mapped, if the shard has such a level; integers as they are counted with."""
        if folder.load(f"level{number}.name-{shard}") is None:
            return None
        wide = lambda c, x: np.asarray(x) if c in ("name", "key", "body") else np.asarray(x).astype(np.int64)
        x = {c: wide(c, folder.load(f"level{number}.{c}-{shard}")) for c in Level.CONTEXTS + Level.WINDOWS}
        return Level(**x, group=Level.groups(x["key"], x["ahead"], x["owner"], x["at"]))


def levels_before(batch: int) -> list[tuple[int, int]]:
    """(number, batches in it) of the levels that stand when a batch arrives, the latest last; a level has the number of its last batch."""
    out: list[tuple[int, int]] = []
    for b in range(batch):
        n = 1
        while out and out[-1][1] == n:
            n += out.pop()[1]
        out.append((b, n))
    return out


def _dealt(df: DataFrame) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), "shard").sortWithinPartitions("shard")


def build(docs: DataFrame, text: str, length: int, folder: Folder, bits: int) -> None:
    """Writes to the folder: copy-s (texts that occur more than once), context-s with mask-s (repeated windows of contexts)."""
    rows = docs.select("_row", F.col(text).alias("_text"))

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, "_text"):
            buf, off = flat(b["_text"])
            long = np.diff(off) >= length
            h = text_hashes(buf, off)[long]
            yield pa.RecordBatch.from_pydict({"h": h.view(np.int64), "row": b["_row"].to_numpy(zero_copy_only=False)[long]})

    def save_copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (h, row) in _rows(batches, ("h", "row")):
            order = np.argsort(h.view(U64))
            folder.save(f"copy-{shard}", h.view(U64)[order])
            folder.save(f"row-{shard}", row[order].view(U64))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(h)], pa.int64())})

    same = rows.mapInArrow(copies, "h long, row long").groupBy("h").agg(F.min("row").alias("row"), F.count("*").alias("n")).where("n > 1")
    _dealt(same.select(_shard("h", bits), "h", "row")).mapInArrow(save_copies, "n long").agg(F.sum("n")).first()
    folder.seal()

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush() -> Iterator[pa.RecordBatch]:
            key, name = (np.concatenate([x[i] for x in held]) for i in (0, 1))
            order = np.lexsort((name, key))
            key, name = key[order], name[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            at = np.flatnonzero(new)
            yield from _blobs(bits, key[at], {"key": key[at], "name": name[at], "times": np.diff(np.append(at, len(key)))})

        for b in pieces(batches, "_text"):
            for c in stretches(b["_text"], length):
                c.take(_stands(c, b, folder, bits)[c.doc])
                held.append((c.key, c.name))
                n += len(c.key)
                if n >= FLUSH:
                    yield from flush()
                    held, n = [], 0
        if n:
            yield from flush()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _grouped(batches, ("key", "name", "times")):
            key, name, times = (_ints(x) for x in blobs)
            order = np.lexsort((name, key))
            key, name, times = key[order], name[order], times[order].astype(np.int64)
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (name[1:] != name[:-1])
            at = np.flatnonzero(new)
            key, name, times = key[at], name[at], np.add.reduceat(times, at)
            cut = runs(key)
            kinds = np.diff(cut)
            folder.save(f"mixed-{shard}", key[cut[:-1][kinds > 1]])  # anchors with different contexts
            folder.save(f"kinds-{shard}", kinds[kinds > 1])
            whole = np.sort(name[times > 1])
            yield from _blobs(bits, whole, {"name": whole})

    def save_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, blobs in _grouped(batches, ("name",)):
            name = np.unique(_ints(blobs[0]))
            folder.save(f"whole-{shard}", name)
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(name)], pa.int64())})

    counted = _dealt(rows.mapInArrow(anchors, "shard int, key binary, name binary, times binary")).mapInArrow(count, "shard int, name binary")
    _dealt(counted).mapInArrow(save_whole, "n long").agg(F.sum("n")).first()
    folder.seal()

    columns = ("key", "name", "ahead", "skip", "size")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], tuple[int, int, bytes]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            name, skip = (np.fromiter((x[i] for x in held), U64, len(held)) for i in (0, 1))
            key, ahead = (np.array([x[i] for x in held.values()], t) for i, t in ((0, U64), (1, np.int64)))
            body = [x[2] for x in held.values()]
            order = np.argsort(key, kind="stable")
            shard = shard_of(key[order], bits)
            cut = runs(shard)
            col = lambda x: pa.array([low_planes(x[order[a:b]], 8) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())
            numbers = dict(zip(columns, (key, name, ahead, skip, np.array([len(x) for x in body], np.int64)), strict=True))
            yield pa.RecordBatch.from_pydict({"shard": pa.array(shard[cut[:-1]], pa.int32())} | {n: col(x) for n, x in numbers.items()} | {"body": pa.array([b"".join([body[i] for i in order[a:b]]) for a, b in zip(cut[:-1], cut[1:], strict=True)], pa.binary())})

        for b in pieces(batches, "_text"):
            for c in stretches(b["_text"], length):
                c.take(_stands(c, b, folder, bits)[c.doc])
                keys, back = np.unique(c.key, return_inverse=True)
                found, (kinds,) = lookup(folder, bits, keys, ("kinds",), "mixed")
                c.take(found[back])
                hot = (kinds > HOT)[back[found[back]]]
                for name, key, first, last, anchor, many in zip(c.name.tolist(), c.key.tolist(), c.first.tolist(), c.last.tolist(), c.anchor.tolist(), hot.tolist(), strict=True):
                    if (name, 0) in held:
                        continue
                    if not many:
                        held[name, 0] = (key, anchor - first, c.buf[first : last + length].tobytes())
                        size += last + length - first
                        continue
                    w = first
                    while w <= last:  # windows up to the next multiple of PLACES before the anchor
                        block = (anchor - w) // PLACES
                        end = min(last, anchor - block * PLACES)
                        held[name, w - first] = (int(mix(np.array([key + block + 1 & (1 << 64) - 1], U64))[0]), anchor - w, c.buf[w : end + length].tobytes())
                        size += end + length - w
                        w = end + 1
                if size >= FLUSH_BYTES:
                    yield from flush()
                    held, size = {}, 0
        if held:
            yield from flush()

    def index(batch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for shard, (*numbers, body) in _grouped(batches, (*columns, "body")):
                key, name, ahead, skip, size = (_ints(x) for x in numbers)
                ahead, skip, size = (x.astype(np.int64) for x in (ahead, skip, size))
                # a context that several map tasks have sent counts once
                order = np.lexsort((skip, name))
                new = np.ones(len(order), bool)
                new[1:] = (name[order][1:] != name[order][:-1]) | (skip[order][1:] != skip[order][:-1])
                pick = np.sort(order[new])
                start = np.cumsum(size) - size
                text = np.frombuffer(b"".join(body), np.uint8)
                text = text[np.repeat(start[pick] - (np.cumsum(size[pick]) - size[pick]), size[pick]) + np.arange(size[pick].sum())]
                level, repeats = Level.of(name[pick], key[pick], ahead[pick], skip[pick], size[pick], text, length)
                found = [level.marks(repeats)]
                standing = levels_before(batch)
                merging, n = True, 1
                for number, batches_in in reversed(standing):
                    other = Level.load(folder, number, shard)
                    merging = merging and batches_in == n
                    n += batches_in * merging
                    if other is None:
                        continue
                    if merging:
                        level, repeats = other.merged(level, length)
                        found.append(level.marks(repeats))
                    else:
                        found.append(level.scanned(other, length))
                if batch + 1 < BATCHES:
                    level.save(folder, batch, shard)
                yield from _masks([np.concatenate(x) for x in zip(*found, strict=True)], bits, length)
            give_back()

        return run

    def save_masks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, (name, mask) in _grouped(batches, ("name", "mask")):
            name = _ints(name)
            mask = np.frombuffer(b"".join(mask), np.uint8).reshape(len(name), -1)
            order = np.argsort(name, kind="stable")
            at = runs(name[order])[:-1]
            folder.save(f"context-{shard}", name[order][at])
            folder.save(f"mask-{shard}", np.bitwise_or.reduceat(mask[order], at, axis=0))
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(at)], pa.int64())})

    marks = f"{folder.uri}/marks"
    schema = "shard int, " + ", ".join(f"{c} binary" for c in (*columns, "body"))
    # levels of shards without new contexts merge like all others
    every = rows.sparkSession.range(1 << bits).select(F.col("id").cast("int").alias("shard"), *[F.lit(b"").alias(c) for c in (*columns, "body")])
    for batch in range(BATCHES):
        some = rows.where(F.pmod(F.xxhash64("_row"), F.lit(BATCHES)) == batch)
        sent = _dealt(some.mapInArrow(contexts, schema).unionByName(every))
        sent.mapInArrow(index(batch), "shard int, name binary, mask binary").write.mode("append").parquet(marks)
        folder.drop(f"level{n}." for n, _ in set(levels_before(batch)) - set(levels_before(batch + 1)))
        folder.seal()
    found = rows.sparkSession.read.schema("shard int, name binary, mask binary").parquet(marks)
    _dealt(found).mapInArrow(save_masks, "n long").agg(F.sum("n")).first()
    folder.seal()


def _masks(marks: list[np.ndarray], bits: int, length: int) -> Iterator[pa.RecordBatch]:
    """One row a shard: the names of the contexts with repeated windows, and a bit for each of their windows."""
    name, skip, at = marks
    names, back = np.unique(name, return_inverse=True)
    if not len(names):
        return
    mask = np.zeros((len(names), length), bool)
    mask[back, skip + at] = True
    packed, shard = np.packbits(mask, axis=1), shard_of(names, bits)
    cut = runs(shard)
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        yield pa.RecordBatch.from_pydict({"shard": pa.array([shard[a]], pa.int32()), "name": pa.array([low_planes(names[a:b], 8)]), "mask": pa.array([packed[a:b].tobytes()])})


def _shard(column: str, bits: int):
    return F.shiftrightunsigned(F.col(column), 64 - bits).cast("int").alias("shard")


def _rows(batches: Iterator[pa.RecordBatch], names: tuple[str, ...]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(shard, columns) from plain rows sorted by shard."""
    shard, held = None, []
    for b in batches:
        s = b["shard"].to_numpy(zero_copy_only=False)
        cols = [b[n].to_numpy(zero_copy_only=False) for n in names]
        cut = runs(s)
        for lo, hi in zip(cut[:-1], cut[1:], strict=True):
            if s[lo] != shard and held:
                yield int(shard), [np.concatenate([x[i] for x in held]) for i in range(len(names))]
                held = []
            shard = s[lo]
            held.append([c[lo:hi] for c in cols])
    if held:
        yield int(shard), [np.concatenate([x[i] for x in held]) for i in range(len(names))]


def removed(c: Contexts, copies: np.ndarray, folder: Folder, bits: int, length: int) -> np.ndarray:
    """Whether each byte of the slice is removed, as far as its windows tell."""
    repeats = np.zeros(len(c.buf) + 1, np.int32)  # +1 where covered bytes begin, -1 behind them
    names, back = np.unique(c.name, return_inverse=True)
    whole = lookup(folder, bits, names, (), "whole")[0][back]
    found, (mask,) = lookup(folder, bits, names, ("mask",), "context")
    full = np.flatnonzero(whole)
    np.add.at(repeats, c.first[full], 1)
    np.add.at(repeats, c.last[full] + length, -1)
    part = np.flatnonzero(found[back] & ~whole)
    if len(part):
        bits_ = np.unpackbits(mask[back[part]], axis=1)
        i, w = np.nonzero(bits_)
        start = c.first[part][i] + w
        np.add.at(repeats, start, 1)
        np.add.at(repeats, start + length, -1)
    gone = np.cumsum(repeats[:-1]) > 0
    size = np.diff(c.off)
    gone |= np.repeat(copies & (size >= length), size)
    return gone


def remove_repeats(docs: DataFrame, text: str = "text", length: int = 200, as_text: bool = False, digest_only: bool = False, tag: str = "") -> DataFrame:
    """The rows with n_bytes, n_removed, n_spans, kept_sha256 and, unless digest_only, the kept bytes in place of the text.

    as_text: keep valid UTF-8, for which the characters that are removed in part go too. tag: put before the new columns' names.
    docs must give the same rows in the same partitions each time, as a stored table does.
    """
    spark = docs.sparkSession
    shared_root(spark)
    folder, bits = Folder(spark, "suffixes"), shard_bits(spark)
    with shuffles_end(spark):
        build(docs.select(F.col(text).alias("_text"), F.monotonically_increasing_id().alias("_row")), "_text", length, folder, bits)
    new = {f"{tag}n_bytes": T.LongType(), f"{tag}n_removed": T.LongType(), f"{tag}n_spans": T.LongType(), f"{tag}kept_sha256": T.StringType()}
    docs = docs.drop(*new)
    kind = T.StringType() if as_text else T.BinaryType()
    kept_fields = [f if f.name != text else T.StructField(text, kind) for f in docs.schema.fields if f.name != text or not digest_only]
    schema = T.StructType([*kept_fields, *[T.StructField(n, t) for n, t in new.items()]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in pieces(batches, text):
            buf, off = flat(b[text])
            gone = np.zeros(len(buf), bool)
            for c in stretches(b[text], length):
                gone[c.shift : c.shift + len(c.buf)] |= removed(c, _repeated(c, folder, bits), folder, bits, length)
            edge = gone.copy()
            edge[1:] &= ~gone[:-1]
            edge[off[:-1][off[:-1] < len(gone)]] |= gone[off[:-1][off[:-1] < len(gone)]]
            total = lambda x: np.diff(np.concatenate([[0], np.cumsum(x)])[off])
            if as_text:  # a character goes whole
                lead = np.flatnonzero((buf & 0xC0) != 0x80)
                if len(lead):
                    some = np.logical_or.reduceat(gone, lead)
                    kept = ~np.repeat(some, np.diff(np.append(lead, len(gone))))
                else:
                    kept = ~gone
            else:
                kept = ~gone
            at = np.concatenate([[0], np.cumsum(kept)])[off]
            data = buf[kept].tobytes()
            texts = [data[s:e] for s, e in zip(at[:-1], at[1:], strict=True)]
            cols = [b[f.name] if f.name != text else pa.array(texts, pa.binary()).cast(pa.string()) if as_text else pa.array(texts, pa.binary()) for f in kept_fields]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(off)), pa.array(total(gone)), pa.array(total(edge)), pa.array([hashlib.sha256(t).hexdigest() for t in texts])], names=schema.names)

    return docs.mapInArrow(run, schema)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs, digest_only=True)


QUERIES = {"op5_suffix_dedup": op5_suffix_dedup}
SQL: dict[str, str] = {}
