"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tally.session import scratch_path

#: Bytes of text that one step of a task's Python code holds at a time (a
#: single longer text is still taken whole).
CHUNK_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, read by Spark."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back.

    Cuts lineage: a lost executor costs re-reading a shared file instead of
    repeating the steps above.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` alone (so no other column can clash); null text is empty."""
    return docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def crc_bucket(col, mod: int):
    """crc32 of the decimal text of an id, modulo ``mod`` (null id: null)."""
    return F.crc32(col.cast("string").cast("binary")) % mod


def give_back() -> None:
    """Return freed memory of this Python worker to the system.

    Workers are reused by later stages; without this each would keep the
    most memory that any earlier stage needed.
    """
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library
        pass


def tidy(run):
    """A function over a task's batches that gives memory back when it ends."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return wrapped


def tidy_group(run):
    """The same for a function over a group's rows."""
    def wrapped(group):
        try:
            return run(group)
        finally:
            give_back()
    return wrapped


def chunks(batch: pa.RecordBatch, text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Row slices of a batch of about ``limit`` bytes of text each."""
    if batch.num_rows == 0:
        return
    col = batch.column(batch.schema.get_field_index(text))
    sizes = np.asarray(pc.fill_null(pc.binary_length(col), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def ragged_take(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenate values[starts[i] : starts[i] + lengths[i]] for every i."""
    total = int(lengths.sum())
    if total == 0:
        return values[:0]
    ends = np.cumsum(lengths)
    return values[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]




def translated(column: pa.Array, byte_table: bytes) -> pa.Array:
    """A string column (null: empty) with every ASCII byte replaced by a table, in one pass over its bytes."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    _, ends, data = column.buffers()
    at = np.frombuffer(ends, np.int64)[column.offset:column.offset + n + 1] if n else np.zeros(1, np.int64)
    text = data[at[0]:at[-1]].to_pybytes() if n and data is not None else b""
    return pa.LargeStringArray.from_buffers(n, pa.py_buffer((at - at[0]).tobytes()),
                                            pa.py_buffer(text.translate(byte_table)))
