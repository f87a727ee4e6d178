"""Vectorised text kernels over Arrow string columns: code points, words, hashes."""

from __future__ import annotations

import ctypes
import platform
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_POW = np.ones(1, U64)
_INV = np.ones(1, U64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_LIBC = ctypes.CDLL("libc.so.6") if sys.platform == "linux" and platform.libc_ver()[0] == "glibc" else None
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def pieces(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 1 << 19) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with at most max_bytes of text each, or one row."""
    for b in batches:
        if not b.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(b[column]), 0).to_numpy(zero_copy_only=False)
        end = np.cumsum(size)
        i = 0
        while i < b.num_rows:
            j = max(i + 1, int(np.searchsorted(end, (end[i - 1] if i else 0) + max_bytes, "right")))
            yield b.slice(i, j - i)
            i = j
    give_back()


def give_back() -> None:
    """Returns what the allocators keep of freed arrays, as a worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    if _LIBC:
        _LIBC.malloc_trim(0)


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if not pa.types.is_binary(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return buf, off - off[0]


def codepoints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(code points, offsets) of a string column; bytes that are no UTF-8 become U+FFFD."""
    buf, off = flat(column)
    try:
        cps = np.frombuffer(buf.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        starts = np.zeros(len(buf) + 1, np.int64)
        np.cumsum((buf & 0xC0) != 0x80, out=starts[1:])
        return cps, starts[off]
    except UnicodeDecodeError:
        parts = [buf[s:e].tobytes().decode("utf-8", "replace") for s, e in zip(off[:-1], off[1:], strict=True)]
        return np.frombuffer("".join(parts).encode("utf-32-le"), np.uint32), np.cumsum([0, *map(len, parts)])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _POW, _INV
    if len(_POW) < n:
        size = max(n, 1 << 16)
        for name, base in (("_POW", BASE), ("_INV", pow(BASE, -1, 1 << 64))):
            a = np.full(size, base, U64)
            a[0] = 1
            globals()[name] = np.multiply.accumulate(a, out=a)
    return _POW, _INV


def prefix(buf: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash, for span_hash()."""
    out = np.zeros(len(buf) + 1, U64)
    power, _ = powers(len(buf) + 1)
    np.cumsum((buf.astype(U64) + U64(1)) * power[: len(buf)], out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, equal for equal bytes wherever they stand."""
    _, inverse = powers(len(sums))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U64) * U64(0x632BE59BD9B4E019))


def spans_hashed(buf: np.ndarray, start: np.ndarray, end: np.ndarray, most: int = 1 << 22) -> np.ndarray:
    """span_hash() of spans that follow each other, about `most` bytes at a time, so that a long text needs no sums of all its bytes."""
    out = np.empty(len(start), U64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + most, "right")))
        lo = start[i]
        out[i:j] = span_hash(prefix(buf[lo : end[j - 1]]), start[i:j] - lo, end[i:j] - lo)
        i = j
    return out


def words(column: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words [^\\x20\\x09-\\x0D]+, offsets of each text's words); A-Z count as a-z if lower."""
    buf, off = flat(column)
    n = len(buf)
    if not n:
        return np.zeros(0, U64), np.zeros(len(off), np.int64)
    gap = SPACE[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True  # a text starts or ends here
    before = np.concatenate([[True], gap[:-1]]) | edge[:-1]
    after = np.concatenate([gap[1:], [True]]) | edge[1:]
    start = np.flatnonzero(~gap & before)
    end = np.flatnonzero(~gap & after) + 1
    return spans_hashed(LOWER[buf] if lower else buf, start, end), np.searchsorted(start, off)


def shingles(hashes: np.ndarray, off: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes, offsets) of each text's k-word shingles; a text of fewer words has one of all its words."""
    count = np.diff(off)
    doc = np.repeat(np.arange(len(count)), count)
    at = np.arange(len(hashes)) - off[doc]
    left = count[doc] - at
    take = (left >= k) | (at == 0)
    h = np.zeros(len(hashes), U64)
    for p in range(k):
        ok = np.flatnonzero(left > p)
        h[ok] += hashes[ok + p] * U64((BASE * (2 * p + 3) ** 5 * 2 + 1) & (2**64 - 1))
    h = mix(h + np.minimum(left, k).astype(U64))[take]
    doc = doc[take]
    order = np.lexsort((h, doc))
    h, doc = h[order], doc[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    h, doc = h[new], doc[new]
    return h, np.searchsorted(doc, np.arange(len(count) + 1))


def low_planes(x: np.ndarray, width: int) -> bytes:
    """The low bytes of unsigned integers, plane by plane (alike bytes stand together and compress)."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes()


def from_planes(data: bytes, width: int) -> np.ndarray:
    a = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((a.shape[1], 8), np.uint8)
    out[:, :width] = a.T
    return out.reshape(-1).view("<u8")
