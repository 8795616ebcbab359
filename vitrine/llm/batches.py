"""Helpers shared by operators that work on Arrow batches inside tasks."""

from __future__ import annotations

import ctypes
import re
import sys
from collections.abc import Callable, Iterable, Iterator
from types import ModuleType
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from vitrine.session import scratch_dir

# Words of a contract: runs of digits, lower-case ASCII letters and any non-ASCII character. In UTF-8 every byte
# of a non-ASCII character is 0x80 or more, so the split works on bytes.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
WORD_PATTERN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# str.split() and \s of `re` also take these four for blanks; most other tools do not.
ODD_BLANKS = re.compile("[\x1c-\x1f]")


def plain_words(text: bytes | None) -> list[bytes]:
    """Lower-cased (A-Z only) words of a UTF-8 text without ASCII punctuation; none for a missing text."""
    return text.translate(_WORD_BYTES).split() if text else []


def blank_words(text: bytes | None) -> list[bytes]:
    """Words of a UTF-8 text between ASCII blanks (space, 0x09 to 0x0D), unchanged; none for a missing text."""
    return text.split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit values (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolled(words: np.ndarray, size: int, base: int) -> np.ndarray:
    """A 64-bit hash of each run of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            total = total * np.uint64(base) + words[k : k + n]
    return mixed(total)


def rechunked(batches: Iterable[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of the batches whose texts have about ``limit`` bytes, one row at least."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        start, total = 0, 0
        for i, size in enumerate(sizes):
            if i > start and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += int(size)
        if start < batch.num_rows:
            yield batch.slice(start)


def kept_in_worker(name: str, make: Callable[[], Any]) -> Any:
    """An object that this Python worker keeps from task to task.

    Functions travel by value, so a variable of their module would be new in each task.
    """
    state = sys.modules.setdefault("vitrine_llm_worker", ModuleType("vitrine_llm_worker"))
    if not hasattr(state, name):
        setattr(state, name, make())
    return getattr(state, name)


def give_back() -> None:
    """Return what this Python worker has freed to the system: workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library, which has no such call


def stored(spark: SparkSession, df: DataFrame, label: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it again: the lineage ends there."""
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
