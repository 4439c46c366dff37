"""Shared pieces: scratch tables in the cluster's shared folder, word rules and what workers keep."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..sources.scratch import Scratch, scratch_path

__all__ = ["SPACE_CLASS", "Scratch", "held", "lowered", "read_table", "release", "scratch_path", "text_blocks"]

#: Bytes that separate words in the white-space rule: space and \x09-\x0D.
#: ``bytes.split()`` without arguments splits on exactly these.
SPACE_CLASS = "\\x20\\x09-\\x0D"

#: Texts are worked on in blocks of about this many bytes (or one text, if longer).
BLOCK_BYTES = 4 << 20

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def lowered(text: str | None) -> bytes:
    """UTF-8 of the text with only A-Z lower-cased; null counts as empty."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_LOWER)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_blocks(batch: pa.RecordBatch, block_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ``block_bytes`` of text, or of one row."""
    sizes = pc.binary_length(batch.column(batch.schema.get_field_index("text"))).fill_null(0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, done + block_bytes, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def release() -> None:
    """Give back what this worker has freed; Spark keeps workers for later operators."""
    import ctypes
    import gc

    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


class _Held:
    """The one large thing that a Python worker keeps between tasks."""

    kind: str | None = None
    key: object = None
    value: object = None


def held(kind: str, key, make):
    """What ``make`` gives, kept by this worker until another kind or key is asked for.

    Spark reuses workers across operators; tables and caches of one operator would
    otherwise stay beside those of the next.
    """
    if _Held.kind != kind or _Held.key != key:
        _Held.value = None
        release()
        _Held.kind, _Held.key, _Held.value = kind, key, make()
    return _Held.value
