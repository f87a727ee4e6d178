"""SentencePiece encoding and decoding for BPE models with byte fallback, by suffix-array matching.

A text gets a space in front, and each space becomes U+2581. No piece has that sign behind another character, so merges never cross
from a word into the spaces before the next: a text is a row of units, each of spaces and the word behind them, and equal units have
equal tokens. The units that a task has not met yet are encoded together:

1. Their concatenated text gets a suffix array (to the depth of the longest piece).
2. Every piece is looked up in it by binary search; its range holds all its occurrences: the edges of the units' lattices.
3. The edges are sorted by position and relaxed in this order. A prefix of a merged text merges to the tokens of the whole up to
   that place, so each position has one last token: an edge is taken if the position it starts from is reached and its piece and
   the last token there stay apart when their characters are merged by rank. What two pieces do is computed once.
4. Characters without a piece are edges too; they become byte tokens.

The result is that of the library for the same model. Null texts have null tokens, empty ones none. Repeated rows are encoded alike.
Models whose pieces hold U+2581 behind another character, or with a normalisation table, are rejected.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from gavelframe.llm._store import small_batches
from gavelframe.llm._text import U64, flat, give_back, pieces, spans_hashed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
KEPT_UNITS = 700_000  # units whose tokens a task keeps
KEPT_PAIRS = 4_000_000  # pairs of pieces of which a worker knows whether they stay apart
LONG = 512  # bytes; longer units are relaxed one position at a time, in stretches
AT_ONCE = 1 << 17  # bytes of units matched at once
SLICE = 1 << 18  # bytes of text encoded at once


@dataclass
class Bpe:
    """Tables of a model, made once a worker."""

    piece: list[str]
    score: np.ndarray
    byte: np.ndarray  # token of each byte
    rank: dict[str, tuple[float, int]]  # piece -> (score, token)
    text: list[bytes]  # of each token when decoded
    apart_key: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    apart: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))
    unit_key: np.ndarray = field(default_factory=lambda: np.zeros(0, U64))
    unit_at: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    unit_n: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    unit_ids: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))

    @staticmethod
    def read(model: bytes) -> Bpe:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        n = sp.get_piece_size()
        piece = [sp.id_to_piece(i) for i in range(n)]
        normal = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        probe = "  a ﬁ　́e  \t\n"
        if any(MARK in piece[i].lstrip(MARK) for i in normal) or any(sp.is_unused(i) for i in range(n)) or sp.decode(sp.encode(probe)) != probe or sum(sp.is_byte(i) for i in range(n)) != 256:
            raise ValueError("the model is no BPE with byte fallback, a leading space and no normalisation")
        byte = np.zeros(256, np.int32)
        text = [b""] * n
        for i in range(n):
            if sp.is_byte(i):
                byte[int(piece[i][3:5], 16)] = i
                text[i] = bytes([int(piece[i][3:5], 16)])
            elif not sp.is_control(i):
                text[i] = piece[i].replace(MARK, " ").encode()
        score = np.array([sp.get_score(i) for i in range(n)])
        return Bpe(piece, score, byte, {piece[i]: (float(score[i]), i) for i in normal}, text)

    def merged(self, text: str) -> list[str]:
        """The characters merged by rank, the best first and the left of equal ones."""
        parts = list(text)
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = self.rank.get(parts[i] + parts[i + 1])
                if r and (best is None or r[0] > best):
                    best, at = r[0], i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether the pieces stay whole and apart when merged together; left -1 is a unit's start."""
        key = (left + 1).astype(np.int64) * len(self.piece) + right
        ask = np.unique(key)
        at = np.minimum(np.searchsorted(self.apart_key, ask), max(len(self.apart_key) - 1, 0))
        new = ask[self.apart_key[at] != ask] if len(self.apart_key) else ask
        if len(new):
            said = np.empty(len(new), bool)
            for i, k in enumerate(new.tolist()):
                said[i] = self.one_stays_apart(k // len(self.piece) - 1, k % len(self.piece))
            if len(self.apart_key) > KEPT_PAIRS:  # start anew
                self.apart_key, self.apart = np.zeros(0, np.int64), np.zeros(0, bool)
                return self.stay_apart(left, right)
            where = np.searchsorted(self.apart_key, new)
            self.apart_key, self.apart = np.insert(self.apart_key, where, new), np.insert(self.apart, where, said)
        return self.apart[np.searchsorted(self.apart_key, key)]

    def one_stays_apart(self, left: int, right: int) -> bool:
        p = self.piece[right]
        return self.merged(self.piece[left] + p) == [self.piece[left], p] if left >= 0 else self.merged(p) == [p]

    def __post_init__(self):
        normal = sorted(self.rank.items(), key=lambda x: x[0].encode())
        self.sorted_bytes = [p.encode() for p, _ in normal]
        self.sorted_ids = np.array([i for _, (_, i) in normal], np.int64)
        self.depth = max(map(len, self.sorted_bytes))
        self.width = np.array([len(p) for p in self.sorted_bytes], np.int64)
        # the range of the suffixes that a piece begins: from itself to itself with the greatest bytes behind it
        self.low = np.array(self.sorted_bytes, f"S{self.depth}")
        self.high = np.array([p + b"\xff" * (self.depth - len(p)) for p in self.sorted_bytes], f"S{self.depth}")
        del self.sorted_bytes

    def edges(self, buf: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(start, end, token) of every occurrence of a piece within a unit; end: of the unit at each byte."""
        padded = np.concatenate([buf, np.zeros(self.depth, np.uint8)])
        suffix = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, self.depth)[: len(buf)]).view(f"S{self.depth}")[:, 0]
        array = np.argsort(suffix, kind="stable")
        ordered = suffix[array]
        lo, hi = np.searchsorted(ordered, self.low, "left"), np.searchsorted(ordered, self.high, "right")
        n = hi - lo
        which = np.repeat(np.arange(len(n)), n)
        start = array[np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)]
        stop = start + self.width[which]
        ok = stop <= end[start]
        return start[ok], stop[ok], self.sorted_ids[which[ok]]

    def encode_long(self, buf: np.ndarray) -> np.ndarray:
        """Tokens of one unit of any length: the same steps, over stretches of AT_ONCE bytes and the longest piece, one edge after another."""
        n = len(buf)
        last, step = np.full(n + 1, -2, np.int32), np.zeros(n + 1, np.uint8)
        state = [-1]  # the last tokens from the stretch's start on
        memo: dict[tuple[int, int], bool] = {}
        for p in range(0, n, AT_ONCE):
            part = buf[p : p + AT_ONCE + self.depth]
            start, stop, token = self.edges(part, np.full(len(part), len(part)))
            chars = np.flatnonzero((part & 0xC0) != 0x80)
            follow = np.zeros(len(part) + 1, np.int64)
            follow[chars] = np.append(chars[1:], len(part))
            has = np.zeros(len(part) + 1, bool)
            has[start[stop == follow[start]]] = True
            strange = chars[~has[chars]]
            start, stop, token = (np.concatenate(x) for x in ((start, strange), (stop, follow[strange]), (token, np.full(len(strange), -1))))
            order = np.flatnonzero(start < AT_ONCE)
            order = order[np.argsort(start[order], kind="stable")]
            state += [-2] * (len(part) + 1 - len(state))
            size = step[p : p + len(part) + 1]
            for s, e, t in zip(start[order].tolist(), stop[order].tolist(), token[order].tolist(), strict=True):
                left = state[s]
                if left == -2:
                    continue
                if t >= 0:
                    ok = memo.get((left, t))
                    if ok is None:
                        ok = memo[left, t] = self.one_stays_apart(left, t)
                    if not ok:
                        continue
                state[e] = t
                size[e] = e - s
            last[p : p + len(state)] = state
            state = state[AT_ONCE:]
        if last[n] == -2:
            raise AssertionError("a unit has no tokens")
        out, at = [], n  # from the end
        while at:
            t, w = int(last[at]), int(step[at])
            out += [t] if t >= 0 else self.byte[buf[at - w : at]][::-1].tolist()
            at -= w
        return np.array(out[::-1], np.int32)

    def encode_units(self, buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, offsets) of units given as UTF-8 with U+2581 for spaces."""
        size = np.diff(off)
        start, stop, token = self.edges(buf, np.repeat(off[1:], size))
        lead = (buf & 0xC0) != 0x80  # of a character; what is no UTF-8 counts as characters too
        alone = np.zeros(len(buf) + 1, bool)  # a character that is a piece
        chars = np.flatnonzero(lead)
        after = np.append(chars[1:], len(buf))
        single = np.zeros(len(buf), bool)
        follow = np.zeros(len(buf), np.int64)
        follow[chars] = after
        single[start[stop == follow[start]]] = True
        alone[chars] = ~single[chars]
        strange = np.flatnonzero(alone[:-1])
        first = np.repeat(off[:-1], size)
        # the last token: -2 not reached, -1 at a unit's start or behind a character without a piece
        last = np.full(len(buf) + 1, -2, np.int64)
        back = np.full(len(buf) + 1, -1, np.int64)  # where the last token starts
        given = np.full(len(buf) + 1, -1, np.int64)
        begin = np.concatenate([start, strange])
        finish = np.concatenate([stop, follow[strange]])
        kind = np.concatenate([token, np.full(len(strange), -1)])
        depth = begin - first[begin]
        order = np.argsort(depth, kind="stable")
        begin, finish, kind, depth = begin[order], finish[order], kind[order], depth[order]
        cut = np.concatenate([[0], np.flatnonzero(depth[1:] != depth[:-1]) + 1, [len(depth)]]) if len(depth) else np.zeros(1, int)
        # the end of one unit is the start of the next: states of ends are kept apart
        end_last = np.full(len(size), -2, np.int64)
        end_back = np.full(len(size), -1, np.int64)
        unit = np.repeat(np.arange(len(size)), size)
        last[off[:-1][size > 0]] = -1
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            s, e, t = begin[a:b], finish[a:b], kind[a:b]
            here = last[s]
            reached = here > -2
            s, e, t, here = s[reached], e[reached], t[reached], here[reached]
            ok = t == -1
            both = np.flatnonzero(~ok)
            if len(both):
                ok[both] = self.stay_apart(here[both], t[both])
            s, e, t = s[ok], e[ok], t[ok]
            u = unit[s]
            done = e == off[u + 1]
            inner = ~done
            last[e[inner]] = t[inner]
            back[e[inner]] = s[inner]
            given[e[inner]] = t[inner]
            end_last[u[done]] = t[done]
            end_back[u[done]] = s[done]
        # walk back from the ends, all units at once
        out_unit, out_at, out_token = [], [], []
        u = np.flatnonzero(size > 0)
        if (end_last[u] == -2).any():
            raise AssertionError("a unit has no tokens")
        t, s = end_last[u], end_back[u]
        while len(u):
            out_unit.append(u)
            out_at.append(s)
            out_token.append(t)
            more = s > off[u]
            u, s = u[more], s[more]
            t, s = given[s], back[s]
        if not out_unit:
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        at, t = np.concatenate(out_at), np.concatenate(out_token)
        order = np.argsort(at)
        at, t = at[order], t[order]
        # characters without a piece become their bytes
        wide = np.where(t == -1, follow[at] - at, 1)
        which = np.repeat(np.arange(len(at)), wide)
        inside = np.arange(len(which)) - np.repeat(np.cumsum(wide) - wide, wide)
        ids = np.where(t[which] == -1, self.byte[buf[np.minimum(at[which] + inside, len(buf) - 1)]], t[which]).astype(np.int32)
        return ids, np.concatenate([[0], np.cumsum(np.bincount(unit[at], wide, minlength=len(size)))]).astype(np.int64)

    @staticmethod
    def units(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(bytes with a space in front of each text that is not empty, offsets of the texts, start, end and hash of the units).

        A unit goes from the first of some spaces to the next space behind a word.
        """
        raw, off = flat(column)
        size = np.diff(off)
        full = size > 0
        buf = np.insert(raw, off[:-1][full], 32)
        off = off + np.concatenate([[0], np.cumsum(full)])
        space = buf == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[3:] &= ~((buf[:-3] == 0xE2) & (buf[1:-2] == 0x96) & (buf[2:-1] == 0x81))  # a U+2581 of the text's own is as a space
        begin[off[:-1][full]] = True
        start = np.flatnonzero(begin)
        stop = np.append(start[1:], len(buf))[: len(start)]
        return buf, off, start, stop, spans_hashed(buf, start, stop)

    def _unmet(self, units: np.ndarray) -> np.ndarray:
        if not len(self.unit_key):
            return np.arange(len(units))
        at = np.minimum(np.searchsorted(self.unit_key, units), len(self.unit_key) - 1)
        return np.flatnonzero(self.unit_key[at] != units)

    def meet(self, slices: Iterator[pa.Array]) -> None:
        """Encodes the new units of many slices together, as each call looks up all pieces; about AT_ONCE bytes of units are held."""
        held: dict[int, bytes] = {}
        size = 0

        def learn() -> None:
            units, body = np.fromiter(held.keys(), U64, len(held)), list(held.values())
            ends = np.cumsum([len(x) for x in body])
            if len(self.unit_key) + len(units) <= KEPT_UNITS:  # else encode() starts anew
                self._learn(units, np.frombuffer(b"".join(body), np.uint8), ends - [len(x) for x in body], ends)
            held.clear()

        for column in slices:
            buf, _, start, stop, key = self.units(column)
            units, pick = np.unique(key, return_index=True)
            new = self._unmet(units)
            for u, a, b in zip(units[new].tolist(), start[pick[new]].tolist(), stop[pick[new]].tolist(), strict=True):
                if u not in held:
                    held[u] = buf[a:b].tobytes()
                    size += b - a
            if size >= AT_ONCE:
                learn()
                size = 0
        if held:
            learn()

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, offsets) of the texts."""
        buf, off, start, stop, key = self.units(column)
        if not len(buf):
            return np.zeros(0, np.int32), np.zeros(len(off), np.int64)
        units, pick, back = np.unique(key, return_index=True, return_inverse=True)
        new = self._unmet(units)
        if len(new):
            if len(self.unit_key) + len(new) > KEPT_UNITS:  # start anew; those of this slice are all encoded again
                self.forget()
                new = np.arange(len(units))
            self._learn(units[new], buf, start[pick[new]], stop[pick[new]])
        at = np.searchsorted(self.unit_key, units)
        n, where = self.unit_n[at][back], self.unit_at[at][back]
        ends = np.cumsum(n)
        ids = self.unit_ids[np.repeat(where - (ends - n), n) + np.arange(ends[-1])]
        return ids, np.concatenate([[0], ends])[np.searchsorted(start, off)]

    def _learn(self, units: np.ndarray, buf: np.ndarray, start: np.ndarray, stop: np.ndarray) -> None:
        size = stop - start
        which = np.repeat(np.arange(len(units)), size)
        text = buf[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]
        # U+2581 takes three bytes
        wide = np.where(text == 32, 3, 1)
        place = np.cumsum(wide) - wide
        marked = np.zeros(int(wide.sum()), np.uint8)
        for i, b in enumerate(MARK.encode()):
            marked[place[text == 32] + i] = b
        marked[place[text != 32]] = text[text != 32]
        off = np.concatenate([[0], np.cumsum(np.bincount(which, wide, minlength=len(units)))]).astype(np.int64)
        all_ids, all_n = [self.unit_ids], []
        long = np.append(np.flatnonzero(np.diff(off) > LONG), len(units))
        i, at_long = 0, 0
        while i < len(units):
            if i == long[at_long]:
                ids = self.encode_long(marked[off[i] : off[i + 1]])
                j, counts, at_long = i + 1, np.array([len(ids)]), at_long + 1
            else:
                j = max(i + 1, min(int(np.searchsorted(off, off[i] + AT_ONCE, "right")) - 1, int(long[at_long])))
                ids, o = self.encode_units(marked[off[i] : off[j]], off[i : j + 1] - off[i])
                counts = np.diff(o)
            all_ids.append(ids)
            all_n.append(counts)
            i = j
        n = np.concatenate(all_n)
        at = len(self.unit_ids) + np.cumsum(n) - n
        key = np.concatenate([self.unit_key, units])
        order = np.argsort(key)
        self.unit_key, self.unit_at, self.unit_n = key[order], np.concatenate([self.unit_at, at])[order], np.concatenate([self.unit_n, n])[order]
        self.unit_ids = np.concatenate(all_ids)

    def forget(self) -> None:
        """Drops the units; the tables and what pieces do together stay."""
        self.unit_key, self.unit_at, self.unit_n, self.unit_ids = np.zeros(0, U64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def decode(self, ids: np.ndarray, off: np.ndarray) -> list[bytes]:
        """The texts' bytes; the space in front goes."""
        if not hasattr(self, "_blob"):
            self._blob = np.frombuffer(b"".join(self.text), np.uint8)
            self._size = np.array([len(t) for t in self.text], np.int64)
            self._at = np.cumsum(self._size) - self._size
        n = self._size[ids]
        data = self._blob[np.repeat(self._at[ids] - (np.cumsum(n) - n), n) + np.arange(n.sum())].tobytes()
        ends = np.concatenate([[0], np.cumsum(n)])[off]
        return [data[s + 1 if data[s : s + 1] == b" " else s : e] for s, e in zip(ends[:-1], ends[1:], strict=True)]


def slices(batches: Iterator[pa.RecordBatch], text: str, bpe: Bpe) -> Iterator[pa.RecordBatch]:
    """Small slices of the batches, after the encoder has met all units of their batch."""
    for b in batches:
        bpe.meet(p[text] for p in pieces([b], text, SLICE))
        yield from pieces([b], text, SLICE)


_LOADED: dict[str, Bpe] = {}


def _model(key: str, proto: bytes) -> Bpe:
    if key not in _LOADED:
        _LOADED[key] = Bpe.read(proto)
    return _LOADED[key]


def _proto(docs: DataFrame, model: str):
    """The model file's bytes as a broadcast (half a MB; the file's size is fixed)."""
    small_batches(docs.sparkSession)
    with open(model, "rb") as f:
        data = f.read()
    return hashlib.sha256(data).hexdigest(), docs.sparkSession.sparkContext.broadcast(data)


def encode(docs: DataFrame, text: str = "text", model: str = MODEL, digest: bool = False) -> DataFrame:
    """The rows with ids and n_tokens; with digest, ids_sha256 (of 4-byte little-endian ids), decoded_sha256 and round_trip in place of ids and text."""
    key, proto = _proto(docs, model)
    new = [T.StructField("n_tokens", T.LongType())] + ([T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType()), T.StructField("round_trip", T.BooleanType())] if digest else [T.StructField("ids", T.ArrayType(T.IntegerType()))])
    names = {f.name for f in new}
    docs = docs.select(*[c for c in docs.columns if c not in names])
    kept = [f for f in docs.schema.fields if not (digest and f.name == text)]
    schema = T.StructType([*kept, *new])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(key, proto.value)
        for b in slices(batches, text, bpe):
            ids, off = bpe.encode(b[text])
            null = b[text].is_null().to_numpy(zero_copy_only=False)
            out = [*[b[f.name] for f in kept], pa.array(np.diff(off), mask=null)]
            if digest:
                raw, o = flat(b[text])
                raw = raw.tobytes()
                back = bpe.decode(ids, off)
                le = ids.astype("<i4").tobytes()
                none = lambda xs: [None if z else x for x, z in zip(xs, null, strict=True)]
                out.append(pa.array(none([hashlib.sha256(le[4 * s : 4 * e]).hexdigest() for s, e in zip(off[:-1], off[1:], strict=True)]), pa.string()))
                out.append(pa.array(none([hashlib.sha256(t).hexdigest() for t in back]), pa.string()))
                out.append(pa.array(none([t == raw[s:e] for t, s, e in zip(back, o[:-1], o[1:], strict=True)]), pa.bool_()))
            else:
                out.append(pa.ListArray.from_arrays(pa.array(off.astype(np.int32)), pa.array(ids), mask=pa.array(null)))
            yield pa.RecordBatch.from_arrays(out, names=schema.names)
        bpe.forget()  # the worker lives on, for other tasks
        give_back()

    return docs.mapInArrow(run, schema)


def decode(tokens: DataFrame, ids: str = "ids", out: str = "text", model: str = MODEL) -> DataFrame:
    """The rows with the decoded texts in `out`; bytes that are no UTF-8 become U+FFFD. Null ids have null texts."""
    key, proto = _proto(tokens, model)
    fields = [f for f in tokens.schema.fields if f.name != out]
    schema = T.StructType([*fields, T.StructField(out, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _model(key, proto.value)
        for b in batches:
            column = b[ids]
            lists = [x or [] for x in column.to_pylist()]
            off = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int64)
            texts = bpe.decode(np.array([i for x in lists for i in x], np.int64), off)
            yield pa.RecordBatch.from_arrays([*[b[f.name] for f in fields], pa.array([None if z else t.decode("utf-8", "replace") for t, z in zip(texts, column.is_null().to_pylist(), strict=True)], pa.string())], names=schema.names)

    return tokens.mapInArrow(run, schema)


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), digest=True)


QUERIES = {"op4_sentencepiece": op4_sentencepiece}
SQL: dict[str, str] = {}
