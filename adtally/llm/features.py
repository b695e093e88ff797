"""Hashed features of many texts at once, in numpy, and bounded samples of labelled rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adtally.llm.rows import per_text, text_or_empty

_MIX = np.uint64(0x9E3779B97F4A7C15)
_POWERS = np.array([pow(0x100000001B3, i, 1 << 64) for i in range(64)], np.uint64)


def bucket(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Well mixed leading bits of 64-bit hashes."""
    hashes = (hashes ^ (hashes >> np.uint64(29))) * _MIX
    return (hashes >> np.uint64(64 - bits)).astype(np.int64)


#: Line feeds between texts that lie in one array, so that no window of GAP + 1 bytes reaches over two texts.
GAP = 3


def joined(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All bytes of ``texts`` with gaps between and around them, where each begins, and its length."""
    gap = b"\n" * GAP
    data = np.frombuffer(gap + gap.join(texts) + gap, np.uint8)
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    return data, np.cumsum(lengths + GAP) - lengths, lengths


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs without ASCII blanks."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.diff(blank.astype(np.int8))
    return np.flatnonzero(edge == -1) + 1, np.flatnonzero(edge == 1) + 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span: the same bytes give the same hash anywhere."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sizes = ends - starts
    inside = np.repeat(starts - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    place = (inside - np.repeat(starts, sizes)) & 63
    values = (data[inside].astype(np.uint64) + np.uint64(1)) * _MIX
    values = (values ^ (values >> np.uint64(31))) * _POWERS[place]
    first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    return np.add.reduceat(values, first) ^ (sizes.astype(np.uint64) << np.uint64(48))


def fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, limit: int, also: tuple[str, ...] = ()) -> list[tuple]:
    """Texts, labels and the columns ``also`` of at most ``limit`` labelled rows, in the order of a hash of their id.

    A label that is null or no 0 or 1, an id that is null, and an id with both labels teach nothing. Ids are chosen
    first, from the narrow table, so only chosen texts move. Rows that share an id count each, twice the limit at most.
    """
    clean = (
        labels.select("doc_id", F.col(label).cast("int").alias("label")).filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("most")).filter("label = most")
    )
    order = F.xxhash64(F.col("doc_id").cast("string"))
    there = docs.select("doc_id").join(clean.select("doc_id", "label"), "doc_id").distinct()
    chosen = there.orderBy(order, "doc_id").limit(limit)
    texts = docs.select("doc_id", text_or_empty().cast("binary").alias("text"), *also).join(F.broadcast(chosen), "doc_id")
    rows = texts.orderBy(order, "doc_id", "text", *also).limit(2 * limit).select("text", "label", *also).collect()
    return [(bytes(r["text"]), *r[1:]) for r in rows]


def scored(docs: DataFrame, score, held_out: Column) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; ``score`` gives a number from 0 to 1 for each text."""

    def run(texts: list[bytes]) -> list[pa.Array]:
        return [pa.array(np.clip(score(texts), 0.0, 1.0), pa.float64())]

    return per_text(docs, run, "score double").select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
