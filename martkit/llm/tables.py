"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACES = "\t\n\x0b\x0c\r "
OFFSET_BYTES = (1 << 31) - 1  # that 32-bit offsets reach


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def utf8(col: str | Column) -> Column:
    """A text as bytes; null stays null."""
    return (F.col(col) if isinstance(col, str) else col).cast("binary")


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether crc32 of the id as text falls in the fold; a null id counts as the empty text."""
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(key.cast("binary")) % folds == fold


def fingerprint(col: str | Column) -> Column:
    """128 bits of a text as 16 bytes; null counts as empty."""
    text = F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))
    return F.unhex(F.md5(text.cast("binary")))


def released(run: Callable) -> Callable:
    """An Arrow mapper whose task hands its memory back to the system at the end: workers live on between tasks."""

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
            if trim is not None:
                trim(0)

    return whole


def per_batch(fn: Callable[[pa.RecordBatch], dict], schema: pa.Schema) -> Callable:
    """An Arrow mapper from a function that gives the columns of one batch's result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield record(fn(batch), schema)

    return run


def record(columns: dict, schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c := columns[f.name], pa.Array) else pa.array(c, f.type) for f in schema], schema=schema
    )


def byte_list(column: pa.Array) -> list[bytes]:
    """The values of a binary column, null as empty."""
    return [b"" if v is None else v for v in column.to_pylist()]


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.RecordBatch]:
    """Batches of whole groups from batches sorted by the key: a group that goes on is kept for the next batch."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cut = len(keys) - int(np.argmax(keys[::-1] != keys[-1])) if keys[0] != keys[-1] else 0
        if kept and kept[-1].column(key)[-1].as_py() != keys[0]:
            yield _joined(kept)
            kept = []
        if cut:
            yield _joined([*kept, batch.slice(0, cut)])
            kept = []
        kept.append(batch.slice(cut))
    if kept:
        yield _joined(kept)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch with all rows; columns over 2 GB together get offsets of 64 bits, as Arrow would split them."""
    if len(batches) == 1:
        return batches[0]
    whole = pa.Table.from_batches(batches)
    wide = {pa.binary(): pa.large_binary(), pa.string(): pa.large_string()}
    for i, field in enumerate(whole.schema):
        if field.type in wide and whole.column(i).nbytes >= OFFSET_BYTES:
            whole = whole.set_column(i, field.name, whole.column(i).cast(wide[field.type]))
    (batch,) = whole.combine_chunks().to_batches()
    return batch


def bounds_of(keys: np.ndarray) -> np.ndarray:
    """Where each group starts in sorted keys, and the end."""
    return np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
