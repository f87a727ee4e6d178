"""Sorted hash arrays in the shared folder that spark.checkpoint.dir names.

Tasks write each file under another name first and then rename it, so a task that runs twice leaves one whole file. When a store is
whole the driver lists its files in a manifest; a reader that misses one of them raises an error instead of finding nothing. Where the
folder is a mounted path the readers map the files into memory; elsewhere they hold the READ_HELD bytes of files that they used last.
"""

from __future__ import annotations

import atexit
import io
import json
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from itertools import islice
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession

READ_HELD = 256 << 20  # bytes of files that a worker holds where it cannot map them
_OPEN: dict[str, np.ndarray] = {}
_READ: dict[str, np.ndarray] = {}  # in the order of their use
_WHOLE: dict[str, dict[str, np.ndarray]] = {}  # manifests


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Fewer rows an Arrow batch: whole texts are long, and a batch of the default 10,000 stands in memory several times."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))


def shared_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only where none is set, as in tests, a folder of our own."""
    small_batches(spark)
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not root:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="gavelframe-")
        atexit.register(shutil.rmtree, root, True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root


def _fs(uri: str):
    import pyarrow.fs as pfs

    return pfs.FileSystem.from_uri(uri)


def _local(uri: str) -> str | None:
    p = urlparse(uri)
    return (p.path if p.scheme else uri) if p.scheme in ("", "file") else None


class Folder:
    """A new folder in the shared root. Small and picklable; the arrays stay in files."""

    def __init__(self, spark: SparkSession, tag: str):
        self.uri = f"{shared_root(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex[:12]}"
        self.path = _local(self.uri)
        if self.path:
            os.makedirs(self.path, exist_ok=True)
        else:
            fs, p = _fs(self.uri)
            fs.create_dir(p, recursive=True)
        self.sealed = 0
        atexit.register(self.remove)

    def __getstate__(self):
        return {"uri": self.uri, "path": self.path, "sealed": self.sealed}

    def remove(self) -> None:
        if self.path:
            shutil.rmtree(self.path, ignore_errors=True)
        else:
            fs, p = _fs(self.uri)
            fs.delete_dir(p)

    def _names(self) -> list[str]:
        if self.path:
            return os.listdir(self.path)
        from pyarrow.fs import FileSelector

        fs, p = _fs(self.uri)
        return [f.base_name for f in fs.get_file_info(FileSelector(p))]

    def drop(self, prefixes: Iterable[str]) -> None:
        """On the driver: removes the files and folders whose names begin so."""
        begins = tuple(prefixes)
        for name in self._names() if begins else []:
            if name.startswith(begins):
                if self.path:
                    p = f"{self.path}/{name}"
                    shutil.rmtree(p) if os.path.isdir(p) else os.remove(p)
                else:
                    from pyarrow.fs import FileType

                    fs, p = _fs(f"{self.uri}/{name}")
                    fs.delete_dir(p) if fs.get_file_info(p).type == FileType.Directory else fs.delete_file(p)

    def seal(self) -> None:
        """On the driver, after the job that writes files: they are listed, a bit a shard, for the closures made from now on."""
        shards: dict[str, list[int]] = {}
        for name in self._names():
            if name.endswith(".npy") and not name.startswith("."):
                column, _, shard = name[:-4].rpartition("-")
                shards.setdefault(column, []).append(int(shard))
        bits = {c: np.packbits(np.bincount(x)[: max(x) + 1].astype(bool)).tobytes().hex() for c, x in shards.items() if max(x) < 1 << 24}
        self.sealed += 1
        self._write(f"manifest-{self.sealed}.json", lambda f: f.write(json.dumps(bits).encode()))

    def _manifest(self) -> dict[str, np.ndarray]:
        key = f"{self.uri}/manifest-{self.sealed}.json"
        if key not in _WHOLE:
            if len(_WHOLE) > 100:
                _WHOLE.clear()
            if self.path:
                with open(f"{self.path}/manifest-{self.sealed}.json", "rb") as f:
                    data = f.read()
            else:
                fs, p = _fs(key)
                with fs.open_input_stream(p) as f:
                    data = f.read()
            _WHOLE[key] = {c: np.unpackbits(np.frombuffer(bytes.fromhex(x), np.uint8)).astype(bool) for c, x in json.loads(data).items()}
        return _WHOLE[key]

    def _write(self, name: str, write) -> None:
        """Under another name first, so that a file is whole or absent."""
        tmp = f".{uuid.uuid4().hex}-{name}"
        if self.path:
            with open(f"{self.path}/{tmp}", "wb") as f:
                write(f)
            os.replace(f"{self.path}/{tmp}", f"{self.path}/{name}")
        else:
            fs, p = _fs(self.uri)
            with fs.open_output_stream(f"{p}/{tmp}") as f:
                write(f)
            fs.move(f"{p}/{tmp}", f"{p}/{name}")

    def save(self, name: str, array: np.ndarray) -> None:
        """Integers take the narrowest type that holds them (uint64 keys excepted)."""
        if array.dtype == np.int64:
            array = array.astype(np.min_scalar_type(int(array.max(initial=0))))
        self._write(f"{name}.npy", lambda f: np.save(f, array))

    def load(self, name: str, must: bool = False) -> np.ndarray | None:
        """The array; None if the store has none of this name. Raises if a file that it has, or must have, is missing."""
        if not must:
            column, _, shard = name.rpartition("-")
            have = self._manifest().get(column)
            if have is None or int(shard) >= len(have) or not have[int(shard)]:
                return None
        try:
            return self._mapped(name) if self.path else self._read(name)
        except (FileNotFoundError, pa.ArrowInvalid) as e:
            raise FileNotFoundError(f"the store {self.uri} has lost its file {name}.npy") from e

    def _mapped(self, name: str) -> np.ndarray:
        key = f"{self.uri}/{name}"
        if key not in _OPEN:
            if len(_OPEN) > 20_000 or not all(k.startswith(self.uri) for k in islice(_OPEN, 1)):
                _OPEN.clear()  # files of a folder that is done with would stay on disk
            _OPEN[key] = np.load(f"{self.path}/{name}.npy", mmap_mode="r")
        return _OPEN[key]

    def _read(self, name: str) -> np.ndarray:
        key = f"{self.uri}/{name}"
        if key in _READ:
            _READ[key] = _READ.pop(key)
        else:
            fs, p = _fs(self.uri)
            with fs.open_input_file(f"{p}/{name}.npy") as f:
                _READ[key] = np.load(io.BytesIO(f.read()))
            while len(_READ) > 1 and sum(x.nbytes for x in _READ.values()) > READ_HELD:
                del _READ[next(iter(_READ))]
        return _READ[key]


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """Plans made in here drop their shuffle files when their action ends; else these stay until the driver collects its garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def shard_of(keys: np.ndarray, bits: int) -> np.ndarray:
    """Shards are ranges of the key's top bits: sorted keys have sorted shards."""
    return (keys >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(keys), np.int32)


def shard_bits(spark: SparkSession) -> int:
    """About four shards a shuffle partition, so that partitions are even."""
    return max(4, (4 * int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length())


def lookup(folder: Folder, bits: int, keys: np.ndarray, columns: tuple[str, ...], name: str = "key") -> tuple[np.ndarray, list[np.ndarray]]:
    """For sorted distinct keys: (found, the columns' values, 0 where not found)."""
    found = np.zeros(len(keys), bool)
    out: list[np.ndarray | None] = [None] * len(columns)
    cut = np.searchsorted(shard_of(keys, bits), np.arange((1 << bits) + 1))
    for s in np.flatnonzero(np.diff(cut)):
        a, b = cut[s], cut[s + 1]
        have = folder.load(f"{name}-{s}")
        if have is None or not len(have):
            continue
        at = np.minimum(np.searchsorted(have, keys[a:b]), len(have) - 1)
        hit = have[at] == keys[a:b]
        found[a:b] = hit
        for i, c in enumerate(columns):
            v = folder.load(f"{c}-{s}")
            if out[i] is None:
                out[i] = np.zeros((len(keys), *v.shape[1:]), np.int64 if v.ndim == 1 else v.dtype)
            out[i][a:b][hit] = v[at[hit]]
    return found, [np.zeros(len(keys), np.int64) if x is None else x for x in out]


def runs(x: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal neighbours, and the length at the end."""
    if not len(x):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(x[1:] != x[:-1]) + 1, [len(x)]])
