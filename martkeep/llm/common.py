"""Helpers the operators share: reading tables, cutting lineage, hashing words in tasks."""

from __future__ import annotations

import ctypes
import gc
import sys
from collections.abc import Callable
from typing import Any

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martkeep.session import shared_folder

#: Rows and bytes of text that a Python worker holds at once.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
}

MASK = np.uint64(0xFFFFFFFFFFFFFFFF)
ODD = np.uint64(0x9E3779B97F4A7C15)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables; also bounds the Arrow batches of this session."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Parquet of rows of many KB: the default looks at sizes after 100 rows, and a task would read all at once.
SMALL_GROUPS = {
    "parquet.block.size": str(1 << 20),
    "parquet.block.size.row.check.min": "4",
    "parquet.page.size": str(256 << 10),
    "parquet.page.size.row.check.min": "4",
    "parquet.enable.dictionary": "false",
}


def staged(df: DataFrame, purpose: str, options: dict[str, str] | None = None) -> DataFrame:
    """``df`` written as Parquet, with the writer's ``options``, to the shared folder and read again.

    Cuts the lineage so that a lost executor costs a read, not a recomputation of all
    that went before. The folder is below ``spark.checkpoint.dir`` and is the caller's to
    clean, like any checkpoint.
    """
    path = shared_folder(df.sparkSession, purpose)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def kept_in_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """What ``make`` gives, made once per Python worker and ``key``: workers outlive their tasks.

    Functions are pickled by value, so a module's own globals would be new in each task.
    """
    kept = sys.__dict__.setdefault("_martkeep_kept", {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


def hold() -> None:
    """No search for cyclic garbage in this task until :func:`release`: words are many and have no cycles."""
    gc.disable()


def release(*keep: tuple) -> None:
    """Give freed memory back at the end of a task: workers are kept and used again.

    Of what :func:`kept_in_worker` has made only the keys ``keep`` stay: all workers of an
    executor take turns, and would hold what earlier steps used for as long as they live.
    """
    kept = sys.__dict__.get("_martkeep_kept", {})
    for key in kept.keys() - set(keep):
        del kept[key]
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the GNU C library
        pass


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Seen(dict):
    """Word -> code, worked out when a word is first asked for."""

    def __init__(self, code: Callable[[bytes], int]):
        super().__init__()
        self.code = code

    def __missing__(self, word: bytes) -> int:
        code = self[word] = self.code(word)
        return code


class Hasher:
    """64-bit hashes of words, kept for words seen before up to a fixed number of them."""

    def __init__(self, keep: int = 100_000):
        self.keep, self.seen = keep, _Seen(self.code)

    @staticmethod
    def code(word: bytes) -> int:
        return xxhash.xxh64_intdigest(word)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        if len(self.seen) > self.keep:
            self.seen.clear()
        return np.fromiter(map(self.seen.__getitem__, words), np.uint64, len(words))


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` words; shorter texts count as one run, empty as none."""
    n = len(hashes)
    if n == 0:
        return hashes
    width = min(width, n)
    out = np.full(n - width + 1, np.uint64(width))
    for i in range(width):
        out = mix(out * ODD + hashes[i : n - width + 1 + i])
    return out


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's signed long."""
    return values.view(np.int64)


def fold(key: str, n: int) -> Column:
    """crc32 of a key as text, modulo ``n``; NULL keys are in no fold."""
    return F.crc32(F.col(key).cast("string")) % n
