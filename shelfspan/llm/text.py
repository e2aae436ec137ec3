"""Shared helpers: text of Arrow batches as flat arrays, folds, safe inputs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What separates words: the space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 2_000_000


def fold(column: str, parts: int) -> Column:
    """crc32 of the value's text, modulo ``parts``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % parts


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a text column, one after another, and the n + 1 starts; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    values = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    starts = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = values.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[starts[0] : starts[-1]], starts - starts[0]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after another, and the length of each text."""
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32), lengths


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text, or of one row.

    Working memory then follows the longest text, not the number of rows Spark puts in a batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(column))), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(sizes)
        start = 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop


def strings(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch as Python strings; null is empty."""
    values = batch.column(batch.schema.get_field_index(column))
    return pc.fill_null(values.cast(pa.large_string()), "").to_pylist()


def column_of(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def table(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that others cannot clash with derived ones."""
    return df.select(*names)
