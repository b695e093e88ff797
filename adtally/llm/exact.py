"""Exact deduplication by an extendible-hash index on shared files (DataFrame functions only).

A text's key is its 64-bit XXH64. The directory starts with one bucket and doubles while a bucket holds more texts
than ``capacity``: a split tells its texts apart by one further leading bit of their keys. Each bucket has one owner
task. It gets the bytes of texts whose key is not their own, compares them, chains different texts of one key, and
says which row of each link stays.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from adtally.llm.rows import filter_bit, filter_slot, fresh, may_hold, stage, text_or_empty, without

#: Different texts that a bucket may hold before it splits; more, if a directory of MOST_BITS can't tell so many apart.
CAPACITY = 16_384
#: Leading key bits that a directory uses at most: it is built on the driver, from as many counts.
MOST_BITS = 14  # of the 18 that the table of counts has
#: Copies of a text that reach its owner are folded into so many rows at most, however many tasks saw some.
FOLDS = 16


def directory(counts: dict[int, int], capacity: int, max_depth: int) -> list[int]:
    """The bucket of every prefix of the directory: 2**depth entries.

    ``counts`` has the number of keys by their first ``max_depth`` bits, so it is bounded by 2**max_depth. A
    bucket is named by its first prefix at full depth; entries of an unsplit bucket point to the same one.
    """
    held = [counts.get(prefix, 0) for prefix in range(1 << max_depth)]
    sums = [0]
    for n in held:
        sums.append(sums[-1] + n)

    def size(prefix: int, bits: int) -> int:
        width = 1 << (max_depth - bits)
        return sums[(prefix + 1) * width] - sums[prefix * width]

    depth, entries = 0, [(0, 0)]  # by prefix: the bucket's own prefix and how many bits it uses
    while depth < max_depth and any(bits == depth and size(p, bits) > capacity for p, bits in entries):
        doubled = []
        for prefix, (own, bits) in enumerate(entries):
            split = bits == depth and size(own, bits) > capacity
            doubled += [(2 * prefix, depth + 1), (2 * prefix + 1, depth + 1)] if split else [(own, bits)] * 2
        entries, depth = doubled, depth + 1
    return [own << (max_depth - bits) for own, bits in entries]


def _prefix(key: Column, bits: int) -> Column:
    return F.shiftrightunsigned(key, 64 - bits).cast("int") if bits else F.lit(0)


def _hashed(docs: DataFrame, key_of: Callable[[Column], Column]) -> DataFrame:
    """doc_id, key, text_sha256 of every row, written once: all but the bytes."""
    text = text_or_empty()
    return stage(docs.select("doc_id", key_of(text).alias("key"), F.sha2(text, 256).alias("text_sha256")), "exact-rows")


def build_index(
    docs: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS, key_of: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """One row per different text, written to the shared folder by the owners of the buckets.

    bucket, key, chain (1 for the first text of a key), text_sha256, keep_id (largest doc_id), group_size.
    """
    return _index(docs, _hashed(docs, key_of), capacity, most_bits, key_of)


def _index(
    docs: DataFrame, rows: DataFrame, capacity: int, most_bits: int, key_of: Callable[[Column], Column]
) -> DataFrame:
    """``build_index`` with the rows that ``_hashed`` wrote.

    Counts come first: the keys by leading bits, a bounded table. It builds the directory on the driver, and a bitmap
    of the keys that more than one row has. Only rows that the bitmap lets through bring their bytes along; others
    have a key of their own. Each task folds its copies of a text before the shuffle, and these meet in FOLDS rows a
    text; so an owner never reads a hot text more often than that.
    """
    repeated = F.when(F.col("count") > 1, filter_bit("key")).otherwise(F.lit(0).cast("long"))
    slots = stage(
        rows.groupBy("key").count().groupBy(filter_slot("key").alias("slot")).agg(
            F.bit_or(repeated).alias("bits"), F.count(F.lit(1)).alias("held"),
            F.min(_prefix(F.col("key"), most_bits)).alias("prefix"),
        ), "exact-slots",
    )
    held = {r["prefix"]: r["held"] for r in slots.groupBy("prefix").agg(F.sum("held").alias("held")).collect()}
    entries = directory(held, max(capacity, sum(held.values()) >> most_bits), most_bits)
    depth = len(entries).bit_length() - 1
    pointers = F.split(F.lit(",".join(map(str, entries))), ",").cast("array<int>")  # folded into a constant
    bucket = F.element_at(pointers, _prefix(F.col("key"), depth) + 1).alias("bucket")
    filled = slots.filter("bits <> 0").select("slot", "bits")
    folded = F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    text = text_or_empty()
    shared = may_hold(docs.select("doc_id", text.alias("text"), key_of(text).alias("key")), "key", filled, "shared")
    fold = F.pmod(F.spark_partition_id(), F.lit(FOLDS)).alias("fold")
    partial = shared.filter("shared").groupBy("key", "text", fold).agg(*folded)
    own = may_hold(rows, "key", filled, "shared").filter(~F.col("shared"))
    buckets = len(set(entries))
    met = partial.select(bucket, "key", "text", "keep_id", "group_size").repartition(buckets, "bucket")
    equal = met.groupBy("bucket", "key", "text").agg(
        F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")
    )
    chained = equal.withColumn("chain", F.row_number().over(Window.partitionBy("bucket", "key").orderBy("text"))).select(
        "bucket", "key", "chain", F.sha2("text", 256).alias("text_sha256"), "keep_id", "group_size"
    )
    alone = own.select(
        bucket, "key", F.lit(1).alias("chain"), "text_sha256", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size")
    ).repartition(buckets, "bucket")
    return stage(chained.unionByName(alone), "exact-index")


def decide(
    docs: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS, key_of: Callable[[Column], Column] = F.xxhash64
) -> DataFrame:
    """For every row of ``docs``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when their bytes are; a null text is empty. Of equal texts the row with the largest doc_id
    stays, and of rows that agree in doc_id and text just one (the others have kept = false). A null doc_id
    loses to any other. Every row counts in group_size. An empty table gives no rows.
    """
    rows = _hashed(docs, key_of)
    index = _index(docs, rows, capacity, most_bits, key_of)
    # What each key's owner decided: its chain, link by link.
    links = index.groupBy("bucket", "key").agg(
        F.sort_array(F.collect_list(F.struct("chain", "text_sha256", "keep_id", "group_size"))).alias("links")
    )
    # Rows that agree in id and text: the first of them is told from the rest by its number.
    same = rows.groupBy("doc_id", "key", "text_sha256").agg(F.count(F.lit(1)).cast("int").alias("times"))
    each = same.withColumn("nth", F.explode(F.sequence(F.lit(1), F.col("times"))))
    found = each.join(links.select("key", "links"), "key").withColumn(
        "link", F.get(F.filter("links", lambda x: x["text_sha256"] == F.col("text_sha256")), F.lit(0))
    )
    return found.select(
        "doc_id", "link.keep_id", "link.group_size",
        (F.col("doc_id").eqNullSafe(F.col("link.keep_id")) & (F.col("nth") == 1)).alias("kept"), "text_sha256",
    )


def deduplicate(docs: DataFrame, capacity: int = CAPACITY, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` that stay, with the columns they have.

    Only rows that a bitmap of the dropped ids lets through are joined with them, so most texts need no shuffle.
    """
    sha = fresh(docs, "text_sha256")
    out = stage(
        decide(docs, capacity, most_bits).filter(~F.col("kept")).select(
            F.xxhash64("doc_id", "text_sha256").alias("h"), F.col("doc_id").alias("gone_id"),
            F.col("text_sha256").alias("gone_sha"), "keep_id",
        ).distinct(), "exact-dropped",
    )
    marked = docs.withColumn(sha, F.sha2(text_or_empty(), 256))

    def same(left: DataFrame, right: DataFrame) -> Column:
        return left[sha].eqNullSafe(right["gone_sha"]) & left["doc_id"].eqNullSafe(right["gone_id"])

    staying = without(marked, F.xxhash64("doc_id", sha), out, same)
    # A row that stays but has twins of its own id and text is in that list too: one of them comes back.
    twins = out.filter(F.col("gone_id").eqNullSafe(F.col("keep_id")))
    if twins.isEmpty():
        return staying.drop(sha)
    back = marked.join(twins, same(marked, twins), "left_semi").dropDuplicates(["doc_id", sha])
    return staying.unionByName(back).drop(sha)


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decide(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP8_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""
