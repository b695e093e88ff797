"""What the operators share: whole texts in Arrow batches, names, staged tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adtally.session import stage

__all__ = ["bit_filter", "fresh", "give_back", "in_slices", "join_split", "may_hold", "per_text", "repeat_rows", "small_batches", "stage", "text_or_empty", "without"]

#: Bytes of text that a Python worker turns into objects at a time.
SLICE_BYTES = 1 << 20
#: Bytes that Spark hands to a Python worker at a time where a session leaves it at Spark's default, 64 MB: a batch takes
#: twice that outside the JVM's heap while it grows, and as much in the worker.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20
#: Bits of a filter that is broadcast: at most 2**(FILTER_BITS - 6) rows of 64 bits, 4 MB, whatever the input.
FILTER_BITS = 24
#: Rows of one key from which join_split broadcasts what the key is joined with, and such keys at most.
HOT_ROWS, HOT_KEYS = 4096, 10_000


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def give_back() -> None:
    """Memory that is free goes back to the system: workers live on, and two share an executor's limit."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def small_batches(docs: DataFrame) -> None:
    """Whole texts of the session come to Python in batches of ``BATCH_BYTES``, unless it was told how large."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_SETTING, None) is None:
        conf.set(BATCH_SETTING, str(BATCH_BYTES))


def in_slices(batch: pa.RecordBatch, column: int, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose binary ``column`` holds about ``most`` bytes; a longer row stands alone."""
    sizes = pa.compute.binary_length(batch.column(column)).to_pylist()
    start, held = 0, 0
    for i, size in enumerate(sizes):
        if i > start and held + (size or 0) > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size or 0
    if start < batch.num_rows:
        yield batch.slice(start)


def filter_slot(hashed: str) -> Column:
    """Where the bit of the long column ``hashed`` lies in a filter; filter_bit says which it is there."""
    return F.shiftrightunsigned(F.col(hashed), 64 - (FILTER_BITS - 6)).cast("int")


def filter_bit(hashed: str) -> Column:
    return F.expr(f"shiftleft(1L, cast({hashed} & 63 AS int))")


def bit_filter(hashes: DataFrame) -> DataFrame:
    """slot, bits: a bitmap of the long column ``h``, of bounded size. The more it holds, the less it keeps out."""
    return hashes.groupBy(filter_slot("h").alias("slot")).agg(F.bit_or(filter_bit("h")).alias("bits"))


def may_hold(df: DataFrame, hashed: str, held: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only if the filter ``held`` lacks the long column ``hashed``."""
    slot, bits = fresh(df, "filter_slot"), fresh(df, "filter_bits")
    small = F.broadcast(held.select(F.col("slot").alias(slot), F.col("bits").alias(bits)))
    joined = df.withColumn(slot, filter_slot(hashed)).join(small, slot, "left")
    hit = F.coalesce(F.col(bits).bitwiseAND(filter_bit(hashed)) != 0, F.lit(False))
    return joined.withColumn(name, hit).drop(slot, bits)


def without(df: DataFrame, hash_of: Column, gone: DataFrame, same: Callable[[DataFrame, DataFrame], Column]) -> DataFrame:
    """``df`` without the rows for which ``same(df, gone)`` holds with some row of ``gone``.

    ``gone`` has ``h``, which equals ``hash_of`` for such rows. Only rows that a small bitmap of ``h`` lets through
    are joined, so the texts of most rows aren't shuffled, however long the list is.
    """
    h, hit = fresh(df, "row_hash"), fresh(df, "row_hit")
    marked = may_hold(df.withColumn(h, hash_of), h, bit_filter(gone.select("h")), hit)
    sure = marked.filter(~F.col(hit)).select(*df.columns)
    rest = marked.filter(F.col(hit)).select(*df.columns)
    return sure.unionByName(rest.join(gone, same(rest, gone), "left_anti"))


def join_split(left: DataFrame, right: DataFrame, key: str, rows: int = HOT_ROWS) -> DataFrame:
    """Inner join of ``left`` with the one row that ``right`` has for each ``key``, no key of ``left`` meeting in one task.

    Keys with more than ``rows`` rows on the left, or more than a ``HOT_KEYS``-th of all if that is more, get their right
    row by broadcast, so at most ``HOT_KEYS`` rows are sent; the others meet in a shuffle. ``left`` is read twice.
    """
    least = F.lit(max(rows, left.count() // HOT_KEYS))
    hot = left.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > least).select(key)
    small = F.broadcast(stage(right.join(F.broadcast(hot), key, "left_semi"), "hot-keys"))
    rest = left.join(small.select(key), key, "left_anti").join(right, key)
    return left.join(small, key).unionByName(rest)


def per_text(docs: DataFrame, score: Callable[[list[bytes]], list[pa.Array]], columns: str) -> DataFrame:
    """doc_id and ``columns`` (DDL), which ``score`` gives for a list of whole texts in UTF-8.

    One pass without a shuffle. A null text is empty; every row of ``docs`` gives one row, in any order.
    """
    small_batches(docs)
    narrow = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
    fields = T.StructType.fromDDL(columns)
    schema = T.StructType([narrow.schema["doc_id"], *fields.fields])
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_slices(batch, 1):
                yield pa.RecordBatch.from_arrays([part.column(0), *score(part.column(1).to_pylist())], names=names)
        give_back()

    return narrow.mapInArrow(run, schema)


def repeat_rows(docs: DataFrame, copies: Callable[[pa.RecordBatch, list[bytes]], list[int]]) -> DataFrame:
    """The rows of ``docs``, all columns, each as often as ``copies`` says for a batch and its texts; 0 drops a row.

    One pass without a shuffle or join.
    """
    small_batches(docs)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            binary = pa.RecordBatch.from_arrays([batch.column(at).cast(pa.binary())], names=["text"])
            start = 0
            for part in in_slices(binary, 0):
                rows = batch.slice(start, part.num_rows)
                start += part.num_rows
                times = copies(rows, [t or b"" for t in part.column(0).to_pylist()])
                yield rows.take(pa.array([i for i, n in enumerate(times) for _ in range(n)], pa.int64()))
        give_back()

    return docs.mapInArrow(run, docs.schema)
