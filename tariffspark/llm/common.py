"""Shared plumbing: tables, shared-folder materialisation, rank tables, batches."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder under spark.checkpoint.dir, which driver and executors share.

    Only where the setting is absent (single-machine tests) is a local folder used.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = _local_root(spark)
    return f"{root.rstrip('/')}/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def _local_root(spark: SparkSession) -> str:
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    root = getattr(_local_root, "path", None)
    if root is None:
        root = _local_root.path = "file://" + tempfile.mkdtemp(prefix="tariffspark-")
    return root


def materialise(df: DataFrame, *spent: DataFrame) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    spent: earlier results of this function that nothing reads any more; their files go.
    """
    spark = df.sparkSession
    path = shared_dir(spark)
    df.write.parquet(path)
    for old in spent:
        target = spark._jvm.org.apache.hadoop.fs.Path(old.inputFiles()[0].rpartition("/")[0]) if old.inputFiles() else None
        if target is not None:
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    return spark.read.schema(df.schema).parquet(path)


def typed(docs: DataFrame, key: str, fields: str) -> StructType:
    """The schema of (key, fields): the key's own type, then the fields of a DDL string."""
    return StructType([StructField(key, docs.schema[key].dataType), *StructType.fromDDL(fields).fields])


def document_texts(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, text) with null texts as empty ones; further columns are left behind."""
    return docs.select(F.col(key), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def sliced(texts: list[str], limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Half-open ranges whose texts hold about `limit` characters (one longer text stands alone)."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > limit:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def text_slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[tuple[int, int, list[str]]]:
    """(from, to, texts) of a string column, about `limit` bytes at a time, so that only these are Python objects."""
    upto = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False), dtype=np.int64)
    start = 0
    while start < len(column):
        done = upto[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(upto, done + limit, side="right")))
        yield start, end, column.slice(start, end - start).to_pylist()
        start = end


class TwoGenerations:
    """Memory of results by key, about 2 * limit bytes of them at most: what was used since the last turnover survives it."""

    def __init__(self, limit: int, longest: int):
        self.limit, self.longest, self.new, self.old, self.size = limit, longest, {}, {}, 0

    def get(self, key: str):
        found = self.new.get(key)
        return self.old.get(key) if found is None else found

    def resolve(self, parts: list[list[str]], make: Callable[[list[str]], dict]) -> list[list]:
        """The value of every part; make gives those of the parts that aren't held. Keys over `longest` aren't kept."""
        get = self.new.get
        have = [list(map(get, own)) for own in parts]
        gaps = [(own, got) for own, got in zip(parts, have, strict=True) if None in got]
        if gaps:
            missing = {p for own, got in gaps for p, g in zip(own, got, strict=True) if g is None}
            found = {p: self.old[p] for p in missing if p in self.old} if self.old else {}
            found.update(make(sorted(missing.difference(found))))
            for own, got in gaps:
                for i, g in enumerate(got):
                    if g is None:
                        got[i] = found[own[i]]
            self.new.update(x for x in found.items() if len(x[0]) <= self.longest)
            self.size += ENTRY_BYTES * len(found) + 3 * sum(map(len, found))
            if self.size > self.limit:
                self.old, self.new, self.size = self.new, {}, 0
        return have


#: What a key and a value take in a dict beside the key's characters.
ENTRY_BYTES = 240
#: Seconds without a task after which a worker drops what it holds.
IDLE = 3.0


class _Held:
    value, users, timer = None, 0, None


_held: dict[tuple, _Held] = {}
_holding = threading.Lock()


@contextmanager
def held(key: tuple, make: Callable[[], object]) -> Iterator:
    """An object that a Python worker keeps between its tasks and drops IDLE seconds after the last one.

    Workers outlive their stage; while others need the executor's memory, idle ones hold nothing.
    """
    pa.set_memory_pool(pa.system_memory_pool())  # whose freed memory _drop can give back
    with _holding:
        own = _held.setdefault(key, _Held())
        own.users += 1
        if own.timer:
            own.timer.cancel()
        if own.value is None:
            own.value = make()
    try:
        yield own.value
    finally:
        with _holding:
            own.users -= 1
            own.timer = threading.Timer(IDLE, _drop, (key,))
            own.timer.daemon = True
            own.timer.start()


def _drop(key: tuple) -> None:
    with _holding:
        if key in _held and not _held[key].users:
            del _held[key]
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc gives freed memory back only when told to
    if trim:
        trim(0)
